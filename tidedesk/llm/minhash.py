"""Near copies by Jaccard similarity of word shingles: MinHash bands propose pairs, whole shingle sets decide them.

Two texts whose similarity is ``SIMILARITY`` share a bucket of one band at least with probability 0.998. Texts of equal
shingles count once. In a bucket each text is first compared with the one that meets most others; what these links
leave apart is then compared pair by pair. So a bucket of n copies costs n comparisons, one of n texts that are alike but
not similar enough costs their square: none that could link is left out.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

from tidedesk.llm.common import stored
from tidedesk.llm.components import connected_components

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: At similarity s a pair meets with probability 1 - (1 - s ** BAND_ROWS) ** BANDS.
BANDS = 16
BAND_ROWS = 5
#: Shingles that are handled at a time.
BATCH = 1 << 14
#: Bits of the filter that keeps texts without a pair from being moved; more pairs let some more texts through.
FILTER_BITS = 1 << 24
#: Shingle sets that a verifying task remembers.
REMEMBERED = 64

_draw = np.random.default_rng(42)
FACTORS = _draw.integers(0, 1 << 63, BANDS * BAND_ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _draw.integers(0, 1 << 63, BANDS * BAND_ROWS, np.uint64)
PLACES = _draw.integers(0, 1 << 63, SHINGLE_WORDS, np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes | None) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles; a text of fewer words is one shingle."""
    words = (text or b"").lower().split()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(SHINGLE_WORDS, len(words))
    if not width:
        return hashes
    n = len(words) - width + 1
    sums = np.zeros(n, np.uint64)
    for k in range(width):
        sums += hashes[k : k + n] * PLACES[k]
    return np.unique(_mixed(sums))


def bands(found: np.ndarray) -> np.ndarray:
    """A number for each band of a shingle set, equal if all least values in the band are; none for an empty set."""
    if not len(found):
        return np.zeros(0, np.int64)
    least = np.full(len(FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), BATCH):
        values = found[at : at + BATCH][None, :] * FACTORS[:, None] + OFFSETS[:, None]
        least = np.minimum(least, values.min(axis=1))
    rows = least.reshape(BANDS, BAND_ROWS)
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), seed=b) for b, r in enumerate(rows)], np.uint64).view(np.int64)


SKETCH = StructType(
    [StructField("s", LongType()), StructField("n", IntegerType()), StructField("bands", ArrayType(LongType()))]
)


@pandas_udf(SKETCH)
def sketches(texts: pd.Series) -> pd.DataFrame:
    sets = [shingles(t) for t in texts]
    keys = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
    return pd.DataFrame({"s": keys, "n": [len(s) for s in sets], "bands": [bands(s) for s in sets]})


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[int, np.ndarray] = {}

    def of(key: int, text: bytes) -> np.ndarray:
        if key not in known:
            if len(known) >= REMEMBERED:
                known.pop(next(iter(known)))
            known[key] = shingles(text)
        return known[key]

    for batch in batches:
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        texts = zip(batch.column(2), batch.column(3))
        close = [similarity(of(i, s.as_py()), of(j, t.as_py())) >= SIMILARITY for i, j, (s, t) in zip(a, b, texts)]
        yield batch.select([0, 1]).filter(pa.array(close, pa.bool_()))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) of sets whose similarity is high enough. ``texts`` has a text for each set ``s``."""
    with_a = pairs.join(texts.select(F.col("s").alias("a"), F.col("text").alias("text_a")), "a")
    both = with_a.join(texts.select(F.col("s").alias("b"), F.col("text").alias("text_b")), "b")
    return stored(both.select("a", "b", "text_a", "text_b").mapInArrow(_verify, "a long, b long"), "verified")


def _texts_of(rows: DataFrame, named: DataFrame) -> DataFrame:
    """``s`` and ``text`` for the few ``rows`` (``s``, ``k``, ``j``), from the table ``named`` by ``k`` and ``j``."""
    bit = F.pmod(F.xxhash64("k", "j"), F.lit(FILTER_BITS))
    value = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("bit", F.lit(32)).cast("int"))
    places = rows.select(bit.alias("bit")).select(F.shiftright("bit", 5).alias("at"), value.alias("v"))
    held = places.groupBy("at").agg(F.bit_or("v").alias("v")).toArrow()
    filled = np.zeros(FILTER_BITS >> 5, np.int64)
    filled[held["at"].to_numpy()] = held["v"].to_numpy()
    there = rows.sparkSession.sparkContext.broadcast(filled.astype(np.uint32))

    @pandas_udf(BooleanType())
    def wanted(bits: pd.Series) -> pd.Series:
        b = bits.to_numpy()
        return pd.Series((there.value[b >> 5] >> (b & 31).astype(np.uint32) & np.uint32(1)).astype(bool))

    few = named.where(wanted(bit)).select("k", "j", F.col("text").cast("binary").alias("text"))
    return stored(few.join(rows, ["k", "j"]).dropDuplicates(["s"]).select("s", "text"), "paired_texts")


def similar_links(sets: DataFrame, named: DataFrame) -> DataFrame:
    """Edges (``a``, ``b``) whose components are those of all pairs of ``sets`` that meet in a bucket and are similar."""
    slots = sets.select("s", "n", F.posexplode("bands").alias("band", "value"))
    members = stored(slots.select("s", "n", F.xxhash64("band", "value").alias("bucket")), "members")
    shared = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    inside = stored(members.join(stored(shared, "buckets"), "bucket"), "met")
    # The text most others were made from has most of their bands, so its buckets are the largest.
    weights = stored(inside.groupBy("s").agg(F.sum("size").alias("weight")), "weights")
    weighed = stored(inside.join(weights, "s").select("bucket", "s", "n", F.struct("weight", "s").alias("rank")), "weighed")
    hubs = stored(weighed.groupBy("bucket").agg(F.max("rank").alias("hub")), "hubs")
    inside = stored(weighed.join(hubs, "bucket").select("bucket", "s", "n", "hub"), "bucketed")
    texts = _texts_of(
        stored(inside.select("s").distinct().join(sets, "s").select("s", "row.k", "row.j"), "paired"), named
    )
    stars = inside.where("s != hub.s").groupBy(F.col("s").alias("a")).agg(F.max("hub").alias("hub"))
    stars = stars.select("a", F.col("hub.s").alias("b"))
    star = _verified(stored(stars, "stars"), texts)
    up = star.select(F.col("a").alias("b"), F.col("b").alias("top"))
    roots = stored(star.join(up, "b", "left").select(F.col("a").alias("s"), F.coalesce("top", "b").alias("root")), "roots")
    inside = inside.join(roots, "s", "left").select("bucket", "s", "n", F.coalesce("root", "s").alias("root"))
    inside = stored(inside, "rooted")
    roots_of = inside.groupBy("bucket").agg(
        F.mode("root").alias("main"), F.min("root").alias("low"), F.max("root").alias("high")
    )
    open_ = stored(roots_of.where("low != high").select("bucket", "main"), "open_buckets")
    rest = stored(inside.join(open_, "bucket"), "open")
    # Of two roots one at least is not the bucket's main one.
    side = rest.where("root != main").select("bucket", F.col("s").alias("x"), F.col("n").alias("m"), F.col("root").alias("own"))
    pairs = side.join(rest, "bucket").where(
        (F.col("own") != F.col("root"))
        & ((F.col("root") == F.col("main")) | (F.col("x") < F.col("s")))
        & (F.least("m", "n") >= SIMILARITY * F.greatest("m", "n"))
    )
    pairs = pairs.select(F.least("x", "s").alias("b"), F.greatest("x", "s").alias("a")).distinct()
    return star.union(_verified(stored(pairs, "pairs"), texts))


def representatives(named: DataFrame) -> DataFrame:
    """``k`` and ``j`` of one row for each group of near copies in ``named`` (``doc_id``, ``text``, ``k``, ``j``).

    It is the row with the least ``doc_id``; NULL ids come last. NULL, empty and blank texts are copies of each other.
    """
    sketch = named.select("doc_id", "k", "j", sketches(F.col("text").cast("binary")).alias("sketch"))
    rows = stored(sketch.select("doc_id", "k", "j", "sketch.*"), "sketches")
    row = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "k", "j")
    sets = rows.groupBy("s").agg(F.min(row).alias("row"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    sets = stored(sets, "sets")
    labels = connected_components(similar_links(sets, named))
    groups = sets.select("s", "row").join(labels, F.col("s") == F.col("node"), "left")
    chosen = groups.groupBy(F.coalesce("label", "s").alias("g")).agg(F.min("row").alias("row"))
    return stored(chosen.select("row.k", "row.j"), "representatives")


# Workers get these functions by value, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
