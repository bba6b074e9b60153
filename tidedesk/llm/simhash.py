"""Near duplicates by SimHash: fingerprints joined with vantage-point trees over Hamming distance.

A vantage-point tree splits fingerprints into those within a radius of a vantage point and the rest. By the
triangle inequality, a fingerprint whose distance from the vantage point is farther than ``LINK_BITS`` from the
radius can link to fingerprints on its own side only; the others visit both sides. The upper levels of one tree,
built from a bounded sample, deal fingerprints out to shards; every shard then builds its own tree and joins
exactly. Each pair that links meets in the home shard of one of the two.
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
from pyspark.sql.types import LongType

from tidedesk.llm.common import stored
from tidedesk.llm.components import connected_components

SHINGLE_WORDS = 3
LINK_BITS = 3
SEED = 42
#: Fingerprints at home in a shard, about.
SHARD_PRINTS = 16_384
#: Sampled fingerprints for each shard; together they are all the driver ever holds, at most ``32 << MAX_LEVELS``.
SAMPLE_PER_SHARD = 32
#: Levels of the upper tree at most. Beyond 67 million fingerprints shards grow instead, and split in their own trees.
MAX_LEVELS = 12
#: Members of a leaf of a shard's tree, which are compared with every visitor one by one.
LEAF = 64
#: Shingles, or fingerprints, that are handled at a time.
BATCH = 1 << 16


def fingerprint(text: bytes | None) -> int:
    """The 64-bit fingerprint of a UTF-8 text: a bit is set if it is in over half of the shingles' XXH64."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    last = min(SHINGLE_WORDS, len(words)) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))[: len(words) - last].tolist()
    ends = ends[last:].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(begins), BATCH):
        pieces = zip(begins[at : at + BATCH], ends[at : at + BATCH])
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in pieces], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(begins), bitorder="little").view(np.uint64)[0])


@pandas_udf(LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))


def distance(prints: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(prints ^ vantage).astype(np.int16)


def _vantage(prints: np.ndarray) -> tuple[np.uint64, int] | None:
    """The one of a few prints whose distances spread most, and their median; None if nothing splits the prints."""
    best = None
    for at in range(0, len(prints), max(1, len(prints) // 8)):
        d = distance(prints, prints[at])
        radius, spread = int(np.median(d)), float(d.std())
        inside = int((d <= radius).sum())
        if inside == len(d):
            radius -= 1
            inside = int((d <= radius).sum())
        if inside and (best is None or spread > best[0]):
            best = spread, prints[at], radius
    return best and best[1:]


def upper_tree(sample: np.ndarray, levels: int) -> list:
    """Nested ``[vantage, radius, inside, outside]`` down to shard numbers, at most ``2 ** levels``."""
    shards = iter(range(1 << levels))

    def grow(prints: np.ndarray, level: int):
        split = _vantage(prints) if level < levels and len(prints) > 1 else None
        if split is None:
            return next(shards)
        inside = distance(prints, split[0]) <= split[1]
        return [*split, grow(prints[inside], level + 1), grow(prints[~inside], level + 1)]

    return grow(sample, 0)


def deal(prints: np.ndarray, tree) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each shard its members and its visitors. Visitors come from higher shards only: their pairs with
    lower shards' members are found there, so each pair between shards is looked at once."""
    home = np.empty(len(prints), np.int32)
    reached: dict[int, np.ndarray] = {}

    def descend(node, which: np.ndarray, own: np.ndarray) -> None:
        if not isinstance(node, list):
            reached[node] = which
            home[which[own]] = node
            return
        vantage, radius, inside, outside = node
        d = distance(prints[which], vantage)
        near, far = d <= radius + LINK_BITS, d > radius - LINK_BITS
        descend(inside, which[near], own[near] & (d[near] <= radius))
        descend(outside, which[far], own[far] & (d[far] > radius))

    descend(tree, np.arange(len(prints)), np.ones(len(prints), bool))
    return {
        shard: (prints[which[home[which] == shard]], prints[which[home[which] > shard]])
        for shard, which in reached.items()
        if len(which)
    }


def _union(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    while True:
        ra, rb = parent[a], parent[b]
        open_ = ra != rb
        if not open_.any():
            return parent
        np.minimum.at(parent, np.maximum(ra, rb)[open_], np.minimum(ra, rb)[open_])
        while not np.array_equal(up := parent[parent], parent):
            parent = up


def links(members: np.ndarray, visitors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between members, or members and visitors, as each linked fingerprint with the root of its set.

    Linked sets inside the shard are joined up at once, so a group of copies gives a star, not all its pairs.
    """
    prints = np.concatenate((members, visitors))
    parent = np.arange(len(prints))
    linked = np.zeros(len(prints), bool)
    stack = [(np.arange(len(members)), np.arange(len(prints)))]
    while stack:
        own, seen = stack.pop()
        split = _vantage(prints[own]) if len(own) > LEAF else None
        if split is not None:
            vantage, radius = split
            d, e = distance(prints[own], vantage), distance(prints[seen], vantage)
            stack.append((own[d <= radius], seen[e <= radius + LINK_BITS]))
            stack.append((own[d > radius], seen[e > radius - LINK_BITS]))
            continue
        step = max(1, (1 << 22) // max(1, len(own)))
        for at in range(0, len(seen), step):
            other = seen[at : at + step]
            close = np.bitwise_count(prints[own][:, None] ^ prints[other][None, :]) <= LINK_BITS
            i, j = np.nonzero(close)
            a, b = own[i], other[j]
            a, b = a[a != b], b[a != b]
            if len(a):
                linked[a] = linked[b] = True
                parent = _union(parent, a, b)
    found = np.nonzero(linked & (parent != np.arange(len(prints))))[0]
    return prints[found], prints[parent[found]]


def _deal_batches(tree):
    schema = pa.schema([("shard", pa.int32()), ("members", pa.binary()), ("visitors", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            shards = deal(np.concatenate(held), tree)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(list(shards), pa.int32()),
                    pa.array([m.tobytes() for m, _ in shards.values()], pa.binary()),
                    pa.array([v.tobytes() for _, v in shards.values()], pa.binary()),
                ],
                schema=schema,
            )

        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            if sum(map(len, held)) >= BATCH:
                yield flush()
        if held:
            yield flush()

    return run


def _join_shard(rows: pd.DataFrame) -> pd.DataFrame:
    members, visitors = (np.frombuffer(b"".join(rows[c]), np.uint64) for c in ("members", "visitors"))
    a, b = links(members, visitors)
    return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})


def print_links(distinct: DataFrame) -> DataFrame:
    """Edges (``a``, ``b``) whose components are those of all pairs of ``distinct.fp`` at ``LINK_BITS`` or fewer bits."""
    spark = distinct.sparkSession
    n = distinct.count()
    levels = min(MAX_LEVELS, max(0, int(np.ceil(np.log2(max(1, n) / SHARD_PRINTS)))))
    sample = distinct.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE_PER_SHARD << levels).collect()
    if not sample:
        return spark.createDataFrame([], "a long, b long")
    tree = upper_tree(np.array([r["fp"] for r in sample], np.int64).view(np.uint64), levels)
    dealt = distinct.select("fp").mapInArrow(_deal_batches(tree), "shard int, members binary, visitors binary")
    return dealt.groupBy("shard").applyInPandas(_join_shard, "a long, b long")


def near_duplicates(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The ``keep`` columns of every row of ``docs`` with its ``fp`` (long) and the ``component_id`` of its links.

    ``component_id`` is the least ``doc_id`` that links of ``LINK_BITS`` or fewer bits reach, itself included;
    NULL ids are passed over, and a component of NULL ids alone has none. NULL, empty and blank texts have
    fingerprint 0 and link like any other; repeated rows are equal texts. Other columns of ``docs`` are
    ignored, whatever their names; an empty table gives an empty result.
    """
    rows = stored(
        docs.select(
            F.struct(*[F.col(c) for c in keep]).alias("row"),
            F.col("doc_id").alias("own_id"),
            fingerprints(F.col("text").cast("binary")).alias("fp"),
        ),
        "fingerprints",
    )
    classes = _classes(rows)
    return rows.join(classes, "fp").select("row.*", "fp", "component_id")


def _classes(rows: DataFrame) -> DataFrame:
    """``fp`` with its ``component_id`` and the ``label`` of its component, for ``rows`` (``own_id``, ``fp``)."""
    distinct = stored(rows.groupBy("fp").agg(F.min("own_id").alias("least")), "prints")
    labels = connected_components(stored(print_links(distinct), "print_links"))
    labelled = stored(distinct.join(labels, F.col("fp") == F.col("node")).select("fp", "least", "label"), "labelled")
    least = stored(labelled.groupBy("label").agg(F.min("least").alias("linked_least")), "components")
    joined = stored(labelled.join(least, "label").select("fp", "linked_least", "label"), "linked")
    found = F.coalesce("linked_least", "least").alias("component_id"), F.coalesce("label", "fp").alias("label")
    return stored(distinct.join(joined, "fp", "left").select("fp", *found), "classes")


def representatives(named: DataFrame) -> DataFrame:
    """``k`` and ``j`` of one row for each component of ``named`` (``doc_id``, ``text``, ``k``, ``j``).

    It is the row with the least ``doc_id``; NULL ids come last. Components that share an id are kept apart, and NULL,
    empty and blank texts are linked like any other.
    """
    rows = named.select("k", "j", F.col("doc_id").alias("own_id"), fingerprints(F.col("text").cast("binary")).alias("fp"))
    rows = stored(rows, "fingerprints")
    row = F.struct(F.col("own_id").isNull().alias("nameless"), "own_id", "k", "j")
    firsts = rows.groupBy("fp").agg(F.min(row).alias("row"))
    chosen = firsts.join(_classes(rows), "fp").groupBy("label").agg(F.min("row").alias("row"))
    return stored(chosen.select("row.k", "row.j"), "representatives")


# Workers get these functions by value, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
