"""Near copies by min-max hashing of word shingles: bands of a signature propose, whole shingle sets decide.

Under each permutation the least and the greatest value are both kept, so half the permutations give a signature of the
same length. Either equals another set's with a probability of their Jaccard similarity, and as the two come from
different shingles, an estimate from both varies less than one from as many independent minima. A band is the pair of
``BAND_PERMUTATIONS`` permutations, ``2 * BAND_PERMUTATIONS`` values.

Texts of equal sets count once. In a bucket every set is first compared with the one that meets most others. Where that
leaves sets of a bucket apart, their shingles are put into one order, rare ones first: two sets that are similar enough
share a shingle among the first ninth of the smaller one and the first fifth of the larger one, and their places there
leave room for the overlap. Only such pairs are compared, so sets that share a template but differ in the rest, which
meet in buckets, hardly ever make a pair, and none that could link is left out.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StructField, StructType

from tidedesk.llm.common import stored
from tidedesk.llm.components import connected_components

SHINGLE_WORDS = 4
#: Hundredths of the union that two linked sets have in common at least.
LEAST_SHARED = 80
#: At similarity s a pair meets with a probability of about 1 - (1 - s ** 6) ** 28: 0.9998 at 0.8.
BANDS = 28
BAND_PERMUTATIONS = 3
#: Shingles that are hashed at a time.
BATCH = 1 << 13
#: Bits of the filter that keeps texts without a pair from being moved; beyond it some more texts are.
FILTER_BITS = 1 << 24
#: Shingle sets that a comparing task remembers.
REMEMBERED = 64

_draw = np.random.default_rng(11)
FACTORS = _draw.integers(0, 1 << 63, BANDS * BAND_PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _draw.integers(0, 1 << 63, BANDS * BAND_PERMUTATIONS, np.uint64)
POSITIONS = _draw.integers(0, 1 << 63, SHINGLE_WORDS, np.uint64) * np.uint64(2) + np.uint64(1)


def _spread(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that leaves no pattern of its input."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: bytes | None) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles; a text of fewer words is one shingle."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(SHINGLE_WORDS, len(words))
    n = len(words) - width + 1
    sums = np.full(n, width, np.uint64)
    for k in range(width):
        sums += hashes[k : k + n] * POSITIONS[k]
    return np.unique(_spread(sums))


def signature(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest value of a set under every permutation."""
    least = np.full(len(FACTORS), np.iinfo(np.uint64).max, np.uint64)
    greatest = np.zeros(len(FACTORS), np.uint64)
    for at in range(0, len(shingles), BATCH):
        values = shingles[None, at : at + BATCH] * FACTORS[:, None] + OFFSETS[:, None]
        np.minimum(least, values.min(axis=1), out=least)
        np.maximum(greatest, values.max(axis=1), out=greatest)
    return least, greatest


def bands(shingles: np.ndarray) -> np.ndarray:
    """A number for each band, equal in two sets if all their least and greatest values in the band are."""
    if not len(shingles):
        return np.zeros(0, np.int64)
    both = np.stack(signature(shingles), axis=1).reshape(BANDS, -1)
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), seed=b) for b, row in enumerate(both)], np.uint64).view(np.int64)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= LEAST_SHARED * (len(a) + len(b) - both)


SKETCH = StructType(
    [StructField("s", BinaryType()), StructField("n", LongType()), StructField("bands", ArrayType(LongType()))]
)


@pandas_udf(SKETCH)
def sketches(texts: pd.Series) -> pd.DataFrame:
    sets = [shingle_set(t) for t in texts]
    names = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
    return pd.DataFrame({"s": names, "n": [len(s) for s in sets], "bands": [bands(s) for s in sets]})


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs (``a``, ``b``, their texts) those whose sets are similar enough."""
    known: dict[bytes, np.ndarray] = {}

    def of(name: bytes, text: pa.Scalar) -> np.ndarray:
        if name not in known:
            if len(known) >= REMEMBERED:
                known.pop(next(iter(known)))
            known[name] = shingle_set(text.as_py())
        return known[name]

    for batch in batches:
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        texts = zip(batch.column(2), batch.column(3))
        close = [linked(of(i, s), of(j, t)) for i, j, (s, t) in zip(a, b, texts)]
        yield batch.select([0, 1]).filter(pa.array(close, pa.bool_()))


def _similar(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    with_a = pairs.join(texts.select(F.col("s").alias("a"), F.col("text").alias("text_a")), "a")
    both = with_a.join(texts.select(F.col("s").alias("b"), F.col("text").alias("text_b")), "b")
    return stored(both.select("a", "b", "text_a", "text_b").mapInArrow(_compare, "a binary, b binary"), "similar")


def _texts_of(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """``s`` and ``text`` for the sets ``wanted`` (``s``, ``t1``, ``t2``), from ``docs`` by two hashes of the text."""
    bit = F.pmod("t1", F.lit(FILTER_BITS))
    value = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("bit", F.lit(32)).cast("int"))
    places = wanted.select(bit.alias("bit")).select(F.shiftright("bit", 5).alias("at"), value.alias("v"))
    held = places.groupBy("at").agg(F.bit_or("v").alias("v")).toArrow()
    filled = np.zeros(FILTER_BITS >> 5, np.int64)
    filled[held["at"].to_numpy()] = held["v"].to_numpy()
    there = wanted.sparkSession.sparkContext.broadcast(filled.astype(np.uint32))

    @pandas_udf(BooleanType())
    def paired(bits: pd.Series) -> pd.Series:
        b = bits.to_numpy()
        return pd.Series((there.value[b >> 5] >> (b & 31).astype(np.uint32) & np.uint32(1)).astype(bool))

    few = docs.select(*_text_names(), "text").where(paired(bit))
    # Copies of a text are reduced to one in each task before they move.
    once = few.groupBy("t1", "t2").agg(F.first("text").alias("text"))
    return stored(once.join(wanted, ["t1", "t2"]).select("s", F.col("text").cast("binary").alias("text")), "paired_texts")


def _text_names() -> list:
    return [F.xxhash64("text").alias("t1"), F.xxhash64(F.lit("second"), "text").alias("t2")]


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for s, text in zip(batch.column(0), batch.column(1)):
            found = shingle_set(text.as_py()).view(np.int64)
            for at in range(0, len(found), BATCH):
                part = found[at : at + BATCH]
                names = pa.array([s.as_py()] * len(part), pa.binary())
                yield pa.RecordBatch.from_arrays([names, pa.array(part)], names=["s", "h"])


def _prefix_pairs(open_sets: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (``a``, ``b``) of ``open_sets`` (``s``, ``n``, ``root``) with different roots that may be similar.

    A shingle that one set alone has comes first in the order and joins nothing, so only the others are carried; how
    many come before them follows from the set's size.
    """
    rows = texts.join(open_sets.select("s"), "s", "left_semi").select("s", "text").mapInArrow(_exploded, "s binary, h long")
    rows = stored(rows, "open_shingles")
    common = stored(rows.groupBy("h").agg(F.count("*").alias("df")).where("df > 1"), "common_shingles")
    rows = stored(rows.join(common, "h"), "carried")
    carried = rows.groupBy("s").agg(F.count("*").alias("m"))
    sizes = stored(open_sets.join(carried, "s").select("s", "n", "root", (F.col("n") - F.col("m")).alias("alone")), "sizes")
    ordered = Window.partitionBy("s").orderBy("df", "h")
    placed = rows.select("s", "h", F.row_number().over(ordered).alias("place")).join(sizes, "s")
    placed = placed.withColumn("place", F.col("place") + F.col("alone"))
    # Of n shingles, n - ceil(8n/9) + 1 of the smaller set, n - ceil(4n/5) + 1 of the larger one.
    prefix = placed.withColumns({"front": F.col("place") <= F.expr("n - (8 * n + 8) div 9 + 1")})
    prefix = stored(prefix.where(F.col("place") <= F.expr("n - (4 * n + 4) div 5 + 1")), "prefixes")
    counts = prefix.groupBy("h", "root").agg(F.count("*").alias("k"))
    mains = counts.groupBy("h").agg(F.max_by("root", F.struct("k", "root")).alias("main"), F.count("*").alias("roots"))
    prefix = stored(prefix.join(mains.where("roots > 1").select("h", "main"), "h"), "met_prefixes")
    sides = prefix.where("root != main")
    fits = (
        (F.col("x.root") != F.col("y.root"))
        & (F.col("x.n") <= F.col("y.n"))
        & (100 * F.col("x.n") >= LEAST_SHARED * F.col("y.n"))
        & (9 * (F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place")) + 1) >= 4 * (F.col("x.n") + F.col("y.n")))
    )
    fronts = prefix.where("front")
    found = []
    # Of two roots one at least is not the shingle's main one.
    for small, large in ((fronts.where("root != main"), prefix), (fronts.where("root = main"), sides)):
        met = small.alias("x").join(large.alias("y"), (F.col("x.h") == F.col("y.h")) & fits)
        found.append(met.select(F.greatest("x.s", "y.s").alias("a"), F.least("x.s", "y.s").alias("b")).distinct())
    return stored(found[0].union(found[1]).distinct(), "pairs")


def set_links(sets: DataFrame, docs: DataFrame) -> DataFrame:
    """Edges (``a``, ``b``) whose components are those of all similar pairs of ``sets`` that meet in a bucket."""
    slots = sets.select("s", "n", F.posexplode("bands").alias("band", "value"))
    members = slots.select("s", "n", F.xxhash64("band", "value").alias("bucket"))
    shared = stored(members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "buckets")
    inside = stored(members.join(shared, "bucket"), "met")
    # The text that the others were made from shares most of their bands, so its buckets are the largest.
    weights = stored(inside.groupBy("s").agg(F.sum("size").alias("weight")), "weights")
    weighed = stored(inside.join(weights, "s").select("bucket", "s", "n", F.struct("weight", "s").alias("rank")), "weighed")
    hubs = stored(weighed.groupBy("bucket").agg(F.max("rank").alias("hub")), "hubs")
    inside = stored(weighed.join(hubs, "bucket").select("bucket", "s", "n", "hub"), "bucketed")
    paired = inside.select("s").distinct().join(sets.select("s", "text.t1", "text.t2"), "s")
    texts = _texts_of(stored(paired, "paired"), docs)
    stars = inside.where("s != hub.s").groupBy(F.col("s").alias("a")).agg(F.max("hub").alias("hub"))
    star = _similar(stored(stars.select("a", F.col("hub.s").alias("b")), "stars"), texts)
    up = star.select(F.col("a").alias("b"), F.col("b").alias("top"))
    roots = stored(star.join(up, "b", "left").select(F.col("a").alias("s"), F.coalesce("top", "b").alias("root")), "roots")
    rooted = inside.select("bucket", "s", "n").join(roots, "s", "left")
    rooted = stored(rooted.select("bucket", "s", "n", F.coalesce("root", "s").alias("root")), "rooted")
    apart = rooted.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
    open_sets = stored(rooted.join(stored(apart.select("bucket"), "apart"), "bucket").select("s", "n", "root").distinct(), "open")
    return star.union(_similar(_prefix_pairs(open_sets, texts), texts))


def near_copies(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The ``keep`` columns of every row of ``docs`` with ``n_shingles``, ``component_id`` and ``kept``.

    ``component_id`` is the least ``doc_id`` that links reach, itself included: of sets with ``LEAST_SHARED`` hundredths
    of their union in common. ``kept`` tells whether it is the row's own. NULL ids are passed over; a component of
    NULL ids alone has none and its rows are kept. NULL, empty and blank texts have no shingles, link with nothing and
    are kept. Rows that repeat an id and a text are all kept or all not. Other columns of ``docs`` are ignored,
    whatever their names; an empty table gives an empty result.
    """
    rows = docs.select(
        F.struct(*[F.col(c) for c in keep]).alias("row"),
        F.col("doc_id").alias("own_id"),
        F.struct(*_text_names()).alias("text"),
        sketches(F.col("text").cast("binary")).alias("sketch"),
    )
    rows = stored(rows.select("row", "own_id", "text", "sketch.*"), "sketches")
    sets = rows.where("n > 0").groupBy("s").agg(
        F.min("own_id").alias("least"), F.min("text").alias("text"), F.first("n").alias("n"), F.first("bands").alias("bands")
    )
    sets = stored(sets, "sets")
    labels = connected_components(set_links(sets, docs.select("text")))
    labelled = sets.select("s", "least").join(labels.select(F.col("node").alias("s"), "label"), "s")
    labelled = stored(labelled, "labelled")
    least = stored(labelled.groupBy("label").agg(F.min("least").alias("linked_least")), "components")
    joined = stored(labelled.join(least, "label").select("s", "linked_least"), "linked")
    classes = sets.select("s", "least").join(joined, "s", "left")
    classes = stored(classes.select("s", F.coalesce("linked_least", "least").alias("component_id")), "classes")
    out = rows.join(classes, "s", "left").select(
        "row.*",
        "own_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("own_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.col("own_id").eqNullSafe(F.col("component_id"))).drop("own_id")


# Workers get these functions by value, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
