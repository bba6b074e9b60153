"""Sharding by a hierarchical weighted hash tree.

A row descends from the root over regions and racks to a shard. At every node each child draws a hash
of (row key, path of the child), and the child with the least ``-ln(draw) / weight`` wins, so children
win in proportion to their weights. A child's draw depends on nothing but the key and its own path:
changing a weight moves rows only into or out of the subtrees whose weights change, and a subtree added
at the root takes rows from all others and moves none between them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidedesk.llm.common import stored

#: region -> rack -> shard -> weight. A node weighs what its shards weigh together.
Tree = dict[str, dict[str, dict[int, float]]]

#: Slots are numbered inside hash ranges of a shard and then shifted, so no task holds a whole shard.
SLOT_RANGES = 1024


def even_tree(shards: int, racks_per_region: int = 2, shards_per_rack: int = 2, grown: int = 0) -> Tree:
    """``shards`` shards of weight 1 in full racks and regions, then ``grown`` more, each as a region of its own.

    A shard that joins an existing region would raise that region's weight, and rows drawn by the
    region would spread over all its racks; a region of its own takes rows only into itself.
    """
    tree: Tree = {}
    for shard in range(shards):
        rack = shard // shards_per_rack
        region = tree.setdefault(f"r{rack // racks_per_region}", {})
        region.setdefault(f"k{rack}", {})[shard] = 1.0
    for shard in range(shards, shards + grown):
        tree[f"grown{shard}"] = {"k": {shard: 1.0}}
    return tree


def _weight(node) -> float:
    return sum(map(_weight, node.values())) if isinstance(node, dict) else float(node)


def _draw(key: list[Column], path: str) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(*key, F.lit(path)), 11)
    return (bits.cast("double") + 0.5) / F.lit(2.0**53)


def _winner(key: list[Column], path: str, children: dict) -> Column:
    """The position of the winning child; ties, one in 2**53, go to the first."""
    weights = {name: _weight(node) for name, node in children.items()}
    costs = [
        F.struct((-F.log(_draw(key, f"{path}/{name}")) / F.lit(w)).alias("cost"), F.lit(n).alias("n"))
        for n, (name, w) in enumerate(weights.items())
        if w > 0
    ]
    if not costs:
        raise ValueError(f"no child of {path or 'the root'} has weight")
    return (F.least(*costs) if len(costs) > 1 else costs[0])["n"]


def _descend(key: list[Column], path: str, node: dict) -> Column:
    """The shard below ``node`` that takes the row."""
    names = list(node)
    if not isinstance(node[names[0]], dict):
        shards = F.array(*[F.lit(int(shard)) for shard in names])
        return F.get(shards, _winner(key, path, node))
    winner = _winner(key, path, node)
    below = [_descend(key, f"{path}/{name}", node[name]) if _weight(node[name]) > 0 else None for name in names]
    cases = [(winner == n, column) for n, column in enumerate(below) if column is not None]
    first, *rest = cases
    return reduce(lambda case, nxt: case.when(*nxt), rest, F.when(*first))


def shard_of(key: list[Column], tree: Tree) -> Column:
    """The shard, an int, that ``tree`` gives the row with this key. NULL keys are a key like any other."""
    return _descend(key, "", tree)


def shard_documents(docs: DataFrame, tree: Tree, grown: Tree | None = None) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text``) with its shard, its place there and its shard in ``grown``.

    ``size`` is the text's UTF-8 bytes plus 1 and ``text_crc32`` its CRC (no text: 1 and 0). ``slot``
    counts the rows of a shard from 0 without a gap, in the order of hash range, ``doc_id``, CRC and
    size; rows equal in all of these are interchangeable. Rows with a repeated ``doc_id`` share a
    shard. Further columns are ignored. An empty table gives an empty result.
    """
    key = [F.col("doc_id")]
    text = F.coalesce("text", F.lit(""))
    assigned = stored(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.lit("key").alias("law"),
            shard_of(key, tree).alias("shard"),
            (shard_of(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
        ).withColumn("range", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(SLOT_RANGES)).cast("int")),
        "shards",
    )
    order = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # At most SLOT_RANGES rows for each shard of the tree.
    starts = (
        assigned.groupBy("shard", "range")
        .agg(F.count("*").alias("n"))
        .select("shard", "range", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("start"))
    )
    place = Window.partitionBy("shard", "range").orderBy("doc_id", "text_crc32", "size")
    return (
        assigned.withColumn("place", F.row_number().over(place))
        .join(F.broadcast(starts), ["shard", "range"])
        .select(
            "doc_id", "size", "text_crc32", "law", "shard", (F.col("start") + F.col("place") - 1).alias("slot"), "grown_shard"
        )
    )
