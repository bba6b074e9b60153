"""A Merkle manifest of a dataset: a hash tree per source, whose roots are hashed into one root, and proofs.

Every 16 consecutive nodes of a level are a run; its parent is the hash of their digests. Per level, lag and lead
columns of the fixed offsets 1 to 15, masked by a node's slot in its run and the run's length, hold its siblings, and
the first row of each run hashes the parent. A window holds one run, so a source with most rows is spread like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidedesk.llm.common import stored
from tidedesk.llm.order import in_order

FANOUT = 16
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows whose identifier's CRC-32 this divides are told with a tampered text.
TAMPERED_EVERY = 5
FIELDS = ("doc_id", "source", "lang", "n_chars")


def digest(*parts: str | Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(text: Column) -> Column:
    return digest(*[_field(F.col(name)) for name in FIELDS], _field(text))


def _level(nodes: DataFrame) -> DataFrame:
    """``nodes`` (``tree``, its ``n`` nodes, ``place``, ``digest``) with their ``run`` and the digests ``before`` and ``after`` them in it."""
    nodes = nodes.withColumn("run", F.expr(f"place div {FANOUT}"))
    slot = F.col("place") % FANOUT
    length = F.least(F.lit(FANOUT), F.col("n") - F.col("run") * FANOUT)
    within = Window.partitionBy("tree", "run").orderBy("place")
    none = F.lit("")
    lags = [F.when(slot >= k, F.lag("digest", k).over(within)).otherwise(none) for k in range(FANOUT - 1, 0, -1)]
    leads = [F.when(slot + k < length, F.lead("digest", k).over(within)).otherwise(none) for k in range(1, FANOUT)]
    return nodes.withColumns({"before": F.concat(*lags), "after": F.concat(*leads)})


def _parents(level: DataFrame) -> DataFrame:
    first = level.where((F.col("n") > 1) & (F.col("place") % FANOUT == 0))
    return first.select(
        "tree",
        F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"),
        F.col("run").alias("place"),
        digest("digest", "after").alias("digest"),
    )


def _climb(leaves: DataFrame, largest: int, label: str) -> tuple[list[DataFrame], DataFrame]:
    """The levels above ``leaves``, and the ``digest`` of every tree's root. ``largest``: the leaves of its largest tree."""
    nodes, levels = leaves.select("tree", "n", "place", "digest"), []
    roots = nodes.where("n = 1").select("tree", "digest")
    while largest > 1:
        nodes = stored(_level(_parents(_level(nodes) if not levels else nodes)), f"{label}_level")
        levels.append(nodes)
        roots = roots.union(nodes.where("n = 1").select("tree", "digest"))
        largest = -(-largest // FANOUT)
    return levels, stored(roots, f"{label}_roots")


def _paths(level: DataFrame, above: DataFrame) -> DataFrame:
    """The rows of a level with the siblings on their ``path`` to the root, from ``above`` (``tree``, ``run``)."""
    step = F.array(F.struct("before", "after"))
    joined = level.join(above, ["tree", "run"])
    return joined.withColumn("path", F.when(F.col("n") > 1, F.concat(step, "path")).otherwise(F.col("path")))


def _descend(level: DataFrame, levels: list[DataFrame], tops: DataFrame, label: str) -> DataFrame:
    """``level``, the lowest one, with its rows' paths; ``tops`` has for each ``tree`` what its root's path goes on with."""
    above, told = None, [c for c in tops.columns if c != "tree"]
    for nodes in reversed(levels):
        # Trees that end in this level go on with their top, those with more nodes with the level above.
        ends = nodes.where("n = 1").join(tops, "tree").select("tree", F.col("place").alias("run"), *told)
        if above is not None:
            inner = _paths(nodes.where("n > 1"), above).select("tree", F.col("place").alias("run"), *told)
            ends = ends.union(inner)
        above = stored(ends, f"{label}_paths")
    single = level.where("n = 1").select("tree", "run").join(tops, "tree").select("tree", "run", *told)
    above = single if above is None else above.union(single)
    return _paths(level, above)


def merkle_manifest(docs: DataFrame) -> DataFrame:
    """For every row of ``docs`` its ``leaf``, its source's ``subroot``, the ``root`` and the outcome of a check.

    ``proof_sha256`` is the hash of the siblings from the leaf to the root. ``folded_root`` is what the siblings make of
    the row's leaf, or of a tampered one (the text in small ASCII letters) where ``TAMPERED_EVERY`` divides the CRC-32
    of the decimal ``doc_id``; ``verified`` tells whether that is the root.

    NULL fields hash as ``-``; empty ones have a length of 0. Rows without ``doc_id`` come first in their source and are
    never tampered, rows with the same one follow by their leaf, and repeated rows are leaves of their own. Rows
    without ``source`` are a source of their own, the first. An empty table gives an empty result; other columns are
    ignored, whatever their names.
    """
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % TAMPERED_EVERY == 0, F.lit(False))
    rows = docs.select(
        "doc_id",
        "source",
        leaf_digest(F.col("text")).alias("digest"),
        F.when(tampered, leaf_digest(F.translate("text", CAPITALS, SMALL))).alias("told"),
    )
    rows = in_order(rows, ["source", "doc_id", "digest"], "leaves")
    sources = rows.groupBy("source").agg(F.min("rank").alias("start"), F.count("*").alias("n"))
    sources = in_order(sources, ["start"], "sources").withColumnRenamed("rank", "tree")
    totals = sources.agg(F.max("n").alias("largest"), F.count("*").alias("n")).first()
    named = sources.select(F.col("source").alias("of"), "start", "n", "tree")
    leaves = rows.join(named, F.col("source").eqNullSafe(F.col("of")))
    leaves = leaves.select("doc_id", "digest", "told", "tree", "n", (F.col("rank") - F.col("start")).alias("place"))
    leaves = stored(leaves, "placed")
    levels, subroots = _climb(leaves, totals["largest"] or 0, "source")
    trunk = subroots.select(
        F.lit(0).alias("tree"), F.lit(totals["n"]).alias("n"), F.col("tree").alias("place"), "digest"
    )
    top_levels, root = _climb(trunk, totals["n"], "trunk")
    end = root.select("tree", F.array().cast("array<struct<before string, after string>>").alias("path"), F.col("digest").alias("root"))
    tops = _descend(_level(trunk), top_levels, end, "trunk")
    tops = stored(tops.select(F.col("place").alias("tree"), "path", F.col("digest").alias("subroot"), "root"), "tops")
    proved = _descend(_level(leaves), levels, tops, "source")
    fold = F.aggregate(
        "path", F.coalesce("told", "digest"), lambda child, step: digest(step["before"], child, step["after"])
    )
    siblings = F.array_join(F.transform("path", lambda step: F.concat(step["before"], step["after"])), "")
    return proved.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        F.sha2(siblings, 256).alias("proof_sha256"),
        fold.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
