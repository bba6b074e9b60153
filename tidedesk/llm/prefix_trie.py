"""A trie of conversations by their turns, in balanced parentheses.

Conversations are ranked by their turns, so that the trie's nodes, each put to the first conversation through it, lie in
preorder. A shard is a fixed number of nodes in that order, and its depths say where parentheses open and close. Inside
a shard, a tree of range minima over the excess finds the close of every open parenthesis, the number of leaf pairs up
to a place and a cumulative sum of savings give a subtree's totals as differences. What is open at a shard's end is
on the spine that later shards share: there the totals of whole shards and of the rest up to the close are added.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidedesk.llm.common import stored
from tidedesk.llm.order import in_order

#: Of five conversations in a row, four begin with up to ``MOST_SHARED`` turns of the first one.
FAMILY = 5
MOST_SHARED = 8
#: Turns that are handled together when prefixes are hashed, and when sequences are ranked.
BLOCK = 1024
RANKED_TURNS = 32
SHARD_NODES = 1 << 17
#: Bytes of joined identifiers in one row, about.
JOINED_BYTES = 1 << 16
#: Depths under one leaf of the tree of range minima.
EXCESS_BLOCK = 64

# --- Numbered turns and rebuilt conversations ---------------------------------------------------------------


def numbered_turns(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` from 0, ``bytes`` of the text and a 128-bit hash (``g1``, ``g2``) of role and text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text")
    )
    rows = in_order(rows, ["conv_id", "turn", "role", "text"], "turns")
    rows = rows.select(
        "conv_id",
        "rank",
        F.octet_length("text").cast("long").alias("bytes"),
        F.xxhash64("role", "text").alias("g1"),
        F.xxhash64(F.lit("second"), "text", "role").alias("g2"),
    )
    starts = rows.groupBy("conv_id").agg(F.min("rank").alias("start"))
    return stored(
        rows.join(starts, "conv_id").select("conv_id", (F.col("rank") - F.col("start")).alias("place"), "bytes", "g1", "g2"),
        "numbered",
    )


def shared_turns(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string")) % (MOST_SHARED + 1)


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conversations (``c``), and the turns of each rebuilt one (``c``, ``place``, ``bytes``, ``g1``, ``g2``)."""
    counts = stored(turns.groupBy("conv_id").agg((F.max("place") + 1).alias("n")), "counts")
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    convs = counts.select(F.col("conv_id").alias("c"), first.alias("base"), shared_turns(F.col("conv_id")).alias("h"))
    bases = counts.select(F.col("conv_id").alias("base"), F.col("n").alias("there"))
    convs = convs.join(bases, "base", "left").select(
        "c", "base", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("taken")
    )
    convs = stored(convs, "conversations")
    opening = turns.where(F.col("place") < MOST_SHARED).withColumnRenamed("conv_id", "base")
    opening = opening.join(convs.where("taken > 0"), "base").where("place < taken")
    own = turns.withColumnRenamed("conv_id", "c").join(convs, "c").where("place >= h")
    columns = ["bytes", "g1", "g2"]
    rows = opening.select("c", "place", *columns).union(
        own.select("c", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), *columns)
    )
    return convs.select("c"), stored(rows, "rebuilt")


def with_prefixes(rows: DataFrame) -> DataFrame:
    """The turns with 128-bit hashes of the turns up to each (``x1``, ``x2``) and before it (``p1``, ``p2``).

    A prefix is hashed as the exclusive or of its turns' hashes, each mixed with its place. Runs of ``BLOCK`` turns are
    summed up by themselves and then among each other, so a long conversation is spread over tasks.
    """
    mixed = {"m1": F.xxhash64("place", "g1", "g2"), "m2": F.xxhash64("g2", "place", "g1")}
    rows = rows.withColumns({**mixed, "block": F.expr(f"place div {BLOCK}")})
    before = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    long = rows.where(F.col("place") >= BLOCK).select("c").distinct()
    blocks = rows.join(long, "c", "left_semi").groupBy("c", "block").agg(F.bit_xor("m1").alias("b1"), F.bit_xor("m2").alias("b2"))
    blocks = stored(blocks.select("c", "block", *[F.bit_xor(b).over(before).alias(b) for b in ("b1", "b2")]), "blocks")
    within = Window.partitionBy("c", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"w{k}": F.bit_xor(f"m{k}").over(within) for k in (1, 2)}).join(blocks, ["c", "block"], "left")
    full = {f"x{k}": F.col(f"w{k}").bitwiseXOR(F.coalesce(f"b{k}", F.lit(0))) for k in (1, 2)}
    rows = rows.withColumns(full)
    parents = [F.col(f"x{k}").bitwiseXOR(F.col(f"m{k}")).alias(f"p{k}") for k in (1, 2)]
    depth = (F.col("place") + 1).alias("depth")
    return stored(rows.select("c", depth, "bytes", "g1", "g2", "x1", "x2", *parents), "prefixes")


# --- Order ----------------------------------------------------------------------------------------------------


def ranked_sequences(rows: DataFrame) -> DataFrame:
    """``c`` and ``first``: the place of each sequence of turns in an order where common beginnings lie together.

    ``RANKED_TURNS`` turns are taken together and replaced by the rank of their list, until one is left of each.
    """
    symbols = rows.select("c", F.col("place").alias("i"), F.struct(F.col("g1").alias("l"), F.col("g2").alias("r")).alias("s"))
    while True:
        slot = F.struct((F.col("i") % RANKED_TURNS).alias("at"), "s")
        lists = symbols.groupBy("c", F.expr(f"i div {RANKED_TURNS}").alias("i")).agg(F.sort_array(F.collect_list(slot)).alias("s"))
        lists = stored(lists.select("c", "i", F.col("s.s").alias("s")), "lists")
        names = in_order(lists.select("s").distinct(), ["s"], "names")
        named = stored(lists.join(names, "s").select("c", "i", "rank"), "ranks")
        if named.where("i > 0").isEmpty():
            return named.select("c", F.col("rank").alias("first"))
        symbols = named.select("c", "i", F.struct(F.col("rank").alias("l"), F.lit(0).cast("long").alias("r")).alias("s"))


# --- Balanced parentheses -------------------------------------------------------------------------------------


class RangeMinima:
    """The excess of a preorder, as its depths, with minima over blocks and, above them, over pairs of blocks."""

    def __init__(self, depths: np.ndarray):
        self.n = len(depths)
        blocks = max(1, -(-self.n // EXCESS_BLOCK))
        size = 1 << (blocks - 1).bit_length()
        self.padded = np.full(size * EXCESS_BLOCK, np.iinfo(np.int64).max)
        self.padded[: self.n] = depths
        self.levels = [self.padded.reshape(size, EXCESS_BLOCK).min(axis=1)]
        while len(self.levels[-1]) > 1:
            self.levels.append(self.levels[-1].reshape(-1, 2).min(axis=1))

    def findclose(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """For each parenthesis the first place behind ``at`` with a depth of at most ``depth``; ``n`` if there is none."""
        close = np.full(len(at), self.n, np.int64)
        begin = at + 1
        which = np.nonzero(begin < self.n)[0]
        stop = (begin // EXCESS_BLOCK + 1) * EXCESS_BLOCK
        open_ = self._scan(which, begin[which], stop[which], depth, close)
        # Up to the first sibling on the right with a low enough minimum, then down to its first such block.
        block, level = begin[open_] // EXCESS_BLOCK, np.zeros(len(open_), np.int64)
        found = np.full(len(open_), -1, np.int64)
        for k, minima in enumerate(self.levels[:-1]):
            wait = np.nonzero((found < 0) & (block >> k & 1 == 0))[0]
            right = (block[wait] >> k) + 1
            low = minima[right] <= depth[open_[wait]]
            found[wait[low]], level[wait[low]] = right[low], k
        for k in range(len(self.levels) - 2, -1, -1):
            down = np.nonzero((found >= 0) & (level == k + 1))[0]
            left = found[down] * 2
            found[down] = np.where(self.levels[k][left] <= depth[open_[down]], left, left + 1)
            level[down] = k
        there = np.nonzero(found >= 0)[0]
        begin = found[there] * EXCESS_BLOCK
        self._scan(open_[there], begin, begin + EXCESS_BLOCK, depth, close)
        return np.minimum(close, self.n)

    def _scan(self, which, begin, stop, depth, close) -> np.ndarray:
        """Sets ``close`` where a low enough depth lies from ``begin`` to ``stop``; returns those without."""
        missing = [which[:0]]
        for step in range(EXCESS_BLOCK):
            over = begin + step >= stop
            missing.append(which[over])
            which, begin, stop = which[~over], begin[~over], stop[~over]
            hit = self.padded[begin + step] <= depth[which]
            close[which[hit]] = begin[hit] + step
            which, begin, stop = which[~hit], begin[~hit], stop[~hit]
        return np.concatenate([*missing, which])


def shard_totals(depths: np.ndarray, weights: np.ndarray, following: int) -> dict[str, np.ndarray]:
    """Totals of one shard's nodes, and of the spine that it shares, from depths and savings in preorder.

    ``following`` is the depth of the next shard's first node, 0 behind the last one. The spine has the depths whose
    node is open before the shard and that close in it, and one more above them: the parent of the least depth.
    """
    n, least = len(depths), int(depths.min())
    minima = RangeMinima(depths)
    nodes = np.arange(n)
    close = minima.findclose(nodes, depths)
    leaf = np.append(depths[1:], following) <= depths
    leaves = np.concatenate(([0], np.cumsum(leaf)))
    savings = np.concatenate(([0], np.cumsum(weights)))
    # Children of a node are the nodes one deeper before its close; per depth, places are in order.
    order = np.lexsort((nodes, depths))
    base = depths[order].astype(np.int64) * (n + 1) + order

    def children(begin: np.ndarray, stop: np.ndarray, depth: np.ndarray) -> np.ndarray:
        row = (depth.astype(np.int64) + 1) * (n + 1)
        return np.searchsorted(base, row + stop) - np.searchsorted(base, row + begin)

    spine = np.arange(max(0, least - 1), int(depths[0]), dtype=np.int64)
    before = np.full(len(spine), -1, np.int64)
    ends = minima.findclose(before, spine) if len(spine) else before
    return {
        "close": close,
        "n_leaves": leaves[close] - leaves[nodes],
        "saved": savings[close] - savings[nodes],
        "n_children": children(nodes, close, depths),
        "spine": spine,
        "spine_close": ends,
        "spine_leaves": leaves[ends],
        "spine_saved": savings[ends],
        "spine_children": children(np.zeros_like(ends), ends, spine),
        "least": np.array([least]),
        "totals": np.array([leaves[-1], savings[-1]]),
    }


_NODE, _SPINE, _SHARD = 0, 1, 2
_TOTALS = "kind int, shard long, rank long, depth long, open boolean, n_leaves long, saved long, n_children long"
_TOTALS_ARROW = pa.schema(
    [("kind", pa.int32()), ("shard", pa.int64()), ("rank", pa.int64()), ("depth", pa.int64()), ("open", pa.bool_())]
    + [(name, pa.int64()) for name in ("n_leaves", "saved", "n_children")]
)


def _encode(size: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        rank, depth, weight = (table[c].to_numpy().astype(np.int64) for c in ("rank", "depth", "weight"))
        order = np.argsort(rank)
        rank, depth, weight = rank[order], depth[order], weight[order]
        own = rank < (shard + 1) * size
        following = int(depth[~own][0]) if not own.all() else 0
        rank, depth = rank[own], depth[own]
        got = shard_totals(depth, weight[own], following)
        n, m = len(rank), len(got["spine"])
        columns = {
            "kind": np.concatenate((np.full(n, _NODE), np.full(m, _SPINE), [_SHARD])),
            "shard": np.full(n + m + 1, shard),
            "rank": np.concatenate((rank, np.zeros(m + 1, np.int64))),
            "depth": np.concatenate((depth, got["spine"], got["least"])),
            "open": np.concatenate((got["close"] == n, got["spine_close"] == n, [False])),
            "n_leaves": np.concatenate((got["n_leaves"], got["spine_leaves"], got["totals"][:1])),
            "saved": np.concatenate((got["saved"], got["spine_saved"], got["totals"][1:])),
            "n_children": np.concatenate((got["n_children"], got["spine_children"], [0])),
        }
        return pa.table({f.name: pa.array(columns[f.name]).cast(f.type) for f in _TOTALS_ARROW}, schema=_TOTALS_ARROW)

    return run


def _nearest(least: np.ndarray, shard: np.ndarray, depth: np.ndarray, forward: bool) -> np.ndarray:
    """The nearest shard behind (or before) each ``shard`` whose least depth is at most ``depth``; -1 or the number of shards if none."""
    if not forward:
        n = len(least)
        return n - 1 - _nearest(least[::-1], n - 1 - shard, depth, True)
    return RangeMinima(least).findclose(shard, depth)


def _resolve(least: np.ndarray, leaves: np.ndarray, savings: np.ndarray):
    """Adds the shard that opened a spine's node, or the one that closes an open node and the totals up to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, depth = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("shard", "depth"))
            spine = batch.column(batch.schema.get_field_index("kind")).to_numpy() == _SPINE
            born, closing = shard.copy(), np.full(len(shard), -1, np.int64)
            born[spine] = _nearest(least, shard[spine], depth[spine], False)
            closing[~spine] = _nearest(least, shard[~spine], depth[~spine], True)
            stop = np.where(spine, shard + 1, closing)
            between = [total[stop] - total[shard + 1] for total in (leaves, savings)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(born), pa.array(between[0]), pa.array(between[1])],
                names=[*batch.schema.names, "born", "more_leaves", "more_saved"],
            )

    return run


def subtree_totals(nodes: DataFrame, size: int = SHARD_NODES) -> DataFrame:
    """``rank`` with ``n_leaves``, ``saved_tokens`` and ``n_children`` of the subtree of every node.

    ``nodes`` has ``rank`` in preorder, ``depth`` and ``weight``, the node's own saving.
    """
    shard = F.expr(f"rank div {size}").alias("shard")
    given = nodes.select("rank", "depth", "weight")
    # The first node of a shard also tells the one before it whether its last node is a leaf.
    borders = given.where((F.col("rank") % size == 0) & (F.col("rank") > 0)).select(F.expr(f"rank div {size} - 1").alias("shard"), "*")
    dealt = given.select(shard, "*").union(borders)
    encoded = stored(dealt.groupBy("shard").applyInArrow(_encode(size), _TOTALS), "parentheses")
    summary = encoded.where(f"kind = {_SHARD}").select("shard", "depth", "n_leaves", "saved").toArrow().sort_by("shard")
    least, leaves, savings = (summary[c].to_numpy().astype(np.int64) for c in ("depth", "n_leaves", "saved"))
    sums = [np.concatenate(([0], np.cumsum(x))) for x in (leaves, savings)]
    across = encoded.where(f"kind = {_SPINE} OR kind = {_NODE} AND open")
    across = across.mapInArrow(_resolve(least, *sums), f"{_TOTALS}, born long, more_leaves long, more_saved long")
    # A spine's node that stays open has its leaves and savings among the shard's totals.
    closed = F.col("kind").eqNullSafe(_NODE) | ~F.col("open")
    added = {"n_leaves": "more_leaves", "saved": "more_saved"}
    sums = [F.sum(F.when(closed, F.col(c)).otherwise(0) + F.when(F.col("kind") == _NODE, F.col(m)).otherwise(0)).alias(c) for c, m in added.items()]
    rank = F.max(F.when(F.col("kind") == _NODE, F.col("rank"))).alias("rank")
    merged = across.groupBy("born", "depth").agg(rank, *sums, F.sum("n_children").alias("n_children"))
    columns = ["rank", "n_leaves", F.col("saved").alias("saved_tokens"), "n_children"]
    return encoded.where(f"kind = {_NODE} AND NOT open").select(*columns).union(merged.select(*columns))


# --- Ends -----------------------------------------------------------------------------------------------------


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Identifiers of a sequence, in order, as pieces of text that begin with ``least``."""
    now, least, parts, size = None, None, [], 0

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"first": [now], "least": [least], "piece": [",".join(parts)]}, schema=_PIECES)

    for batch in batches:
        for first, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if parts and (first != now or size >= JOINED_BYTES):
                yield flush()
                parts, size = [], 0
            if not parts:
                now, least = first, c
            parts.append(str(c))
            size += len(parts[-1]) + 1
    if parts:
        yield flush()


_PIECES = pa.schema([("first", pa.int64()), ("least", pa.int64()), ("piece", pa.string())])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of the pieces of each sequence, which come in order; one piece is held at a time."""
    now, state = None, None
    schema = pa.schema([("first", pa.int64()), ("ends_sha256", pa.string())])

    def out(firsts: list[int], hashes: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"first": firsts, "ends_sha256": hashes}, schema=schema)

    for batch in batches:
        firsts, hashes = [], []
        for first, piece in zip(batch.column(0), batch.column(2)):
            first = first.as_py()
            if first != now:
                if state is not None:
                    firsts.append(now)
                    hashes.append(state.hexdigest())
                now, state = first, hashlib.sha256()
            else:
                state.update(b",")
            state.update(piece.as_py().encode())
        yield out(firsts, hashes)
    if state is not None:
        yield out([now], [state.hexdigest()])


def end_hashes(ends: DataFrame) -> DataFrame:
    """``first`` and ``ends_sha256`` of the conversations (``c``) of each sequence (``first``)."""
    ordered = ends.select("first", "c").repartitionByRange("first", "c").sortWithinPartitions("first", "c")
    pieces = stored(ordered.mapInArrow(_joined, "first long, least long, piece string"), "pieces")
    dealt = pieces.repartition("first").sortWithinPartitions("first", "least")
    return stored(dealt.mapInArrow(_hashed, "first long, ends_sha256 string"), "ends")


# --- The trie -------------------------------------------------------------------------------------------------


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row for every node of the trie of the rebuilt conversations of ``turns``.

    ``conv_id``: its least member; ``depth``; ``parent_conv_id``; ``n_convs``: its members; ``n_children``; ``n_leaves``:
    childless nodes in its subtree; ``saved_tokens``; ``ends_sha256`` of the members that end in it.

    Turns are in the order of ``turn``, NULL first, equal ones in that of role and text, repeated rows one after
    the other. NULL roles and texts are empty. Rows without ``conv_id`` belong to no conversation and are left out. The
    remainder that finds a conversation's family has the sign of its identifier. An empty table has no root; other
    columns are ignored, whatever their names.
    """
    convs, rows = rebuilt(numbered_turns(turns))
    rows = with_prefixes(rows)
    # Conversations of equal turns are ranked once, by the least of them.
    ends = stored(rows.groupBy("c").agg(F.max_by(F.struct("x1", "x2"), "depth").alias("x"), F.max("depth").alias("depth")), "last")
    whole = stored(ends.groupBy("depth", "x").agg(F.min("c").alias("c")), "sequences")
    alone = rows.join(whole.select("c"), "c").select("c", (F.col("depth") - 1).alias("place"), "g1", "g2")
    ranked = ranked_sequences(alone)
    first = stored(whole.join(ranked, "c").select("depth", "x", F.col("first") + 1), "ranked")
    first = first.toDF("depth", "x", "first")
    placed = stored(ends.join(first, ["depth", "x"]).select("c", "first"), "placed")
    # The root is before all, and is where conversations without turns end.
    members = rows.join(placed, "c").groupBy("depth", "x1", "x2", "p1", "p2")
    nodes = members.agg(F.min("c").alias("conv_id"), F.count("*").alias("n_convs"), F.first("bytes").alias("bytes"), F.min("first").alias("first"))
    root = convs.agg(F.min("c").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = root.select(zero.alias("depth"), zero.alias("x1"), zero.alias("x2"), none.alias("p1"), none.alias("p2"), "conv_id", "n_convs", zero.alias("bytes"), zero.alias("first"))
    nodes = nodes.union(root).withColumn("weight", (F.col("n_convs") - 1) * F.col("bytes"))
    nodes = stored(in_order(nodes, ["first", "depth"], "preorder"), "nodes")
    if nodes.isEmpty():
        totals = nodes.selectExpr("rank", "0L AS n_leaves", "0L AS saved_tokens", "0L AS n_children")
    else:
        totals = stored(subtree_totals(nodes), "totals")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    # Nobody but the root, whose children may be most nodes, has no depth above: its identifier is joined as one row.
    top = F.broadcast(parents.where("depth = 1").select(F.col("parent_conv_id").alias("least")))
    inner = parents.where("depth > 1")
    named = nodes.join(inner, ["depth", "p1", "p2"], "left").join(top, F.col("depth") == 1, "left")
    named = named.select("rank", "depth", "first", "conv_id", "n_convs", F.coalesce("parent_conv_id", "least").alias("parent_conv_id"))
    turnless = convs.join(placed, "c", "left").select("c", F.coalesce("first", zero).alias("first"))
    lengths = first.select("first", "depth").union(nodes.where("depth = 0").select("first", "depth"))
    hashes = end_hashes(turnless).join(lengths, "first")
    out = named.join(totals, "rank").join(hashes, ["first", "depth"], "left")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", empty).alias("ends_sha256"),
    )


# Workers get these functions by value, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
