"""Removal of repeated substrings, found by suffix sorting.

Every 50-byte window of a text is owned by the least of its 24-byte seeds (by hash; the first of equal ones), so equal
windows of two texts are owned by equal seeds at equal places. Work goes in four steps, each dealt out by hash:

1. The hashes of owning seeds meet in shards, which tell the seeds that occur in more than one text.
2. Around these, the bytes of the windows a seed owns make a variant. Equal variants inside one block of documents are
   settled there; of each only the copy with the least ``doc_id`` goes on.
3. In shards of seeds, variants of a seed that are not all equal are suffix-sorted (``suffixes``). Suffixes with equal
   first 50 bytes stand together, and the least ``doc_id`` of each such class decides who keeps the bytes.
4. Back in the blocks of documents, the covered bytes are removed.

A map task sends a seed or a variant once, however often it holds it, so what is frequent is small before it moves.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidedesk.llm.common import stored
from tidedesk.llm.suffixes import suffix_array

WINDOW = 50
SEED_BYTES = 24
#: Texts are hashed in pieces of at most so many bytes; the low bits of a hash carry the place in the piece.
PIECE_BITS = 18
PIECE = 1 << PIECE_BITS
#: Bytes of text in one block of documents, and of one shard of seeds, about.
BLOCK_BYTES = 12 * 1024 * 1024
#: Bytes that a map task gathers before it sends.
SEND_BYTES = 8 * 1024 * 1024
#: Characters that are suffix-sorted together, about; a seed's variants are never parted.
SORT_CHARS = 1 << 16
#: Variants whose windows are compared with the decided ones at a time.
DECIDE_VARIANTS = 1 << 18
#: Bits of a seed's hash that are compared inside a shard. Seeds that agree by chance cost work, not exactness.
LOW = np.uint64(0xFFFFFFFF)

HEARD = pa.schema(
    [("shard", pa.int64()), ("block", pa.int64()), ("ids", pa.binary()), ("known", pa.binary()), ("lows", pa.binary()),
     ("blocks", pa.binary()), ("counts", pa.binary())]
)
HEARD_DDL = "shard long, block long, ids binary, known binary, lows binary, blocks binary, counts binary"
IDS = pa.schema([("block", pa.int64()), ("ids", pa.binary())])
IDS_DDL = "block long, ids binary"
#: Rows of one block from one map task, packed: ids, whether id and text are there, sizes and bytes of the texts.
PACKED = pa.schema(
    [("block", pa.int64()), ("ids", pa.binary()), ("known", pa.binary()), ("sizes", pa.binary()), ("texts", pa.binary())]
)
PACKED_DDL = "block long, ids binary, known binary, sizes binary, texts binary"
SENT = pa.schema(
    [("shard", pa.int64()), ("block", pa.int64()), ("variants", pa.binary()), ("sizes", pa.binary()), ("rels", pa.binary()),
     ("docs", pa.binary()), ("rows", pa.binary()), ("firsts", pa.binary())]
)
SENT_DDL = "shard long, block long, variants binary, sizes binary, rels binary, docs binary, rows binary, firsts binary"


def _packed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _unpacked(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _slide(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    n = 1
    while n * 2 <= width:
        x = np.minimum(x[:-n], x[n:])
        n *= 2
    return np.minimum(x[: len(x) - (width - n)], x[width - n :]) if n < width else x


def _seed_hashes(data: np.ndarray) -> np.ndarray:
    """Mixed polynomial hashes of all seeds."""
    h = data.astype(np.uint64) + np.uint64(1)
    factor, n, by_size = np.array([0x9E3779B97F4A7C15], np.uint64), 1, []
    while True:
        by_size.append((n, h, factor))
        if n * 2 > SEED_BYTES:
            break
        h, factor, n = h[:-n] * factor + h[n:], factor * factor, n * 2
    out, size = by_size[-1][1], by_size[-1][0]
    for n, part, factor in reversed(by_size[:-1]):
        if size + n <= SEED_BYTES:
            out = out[: len(out) - n] * factor + part[size : size + len(out) - n]
            size += n
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


class Owners:
    """The owning seeds of texts laid end to end: ``hash``, ``pos`` in the bytes, ``row`` of the text, and the first
    and last window they own, as places in the bytes."""

    def __init__(self, texts: list[bytes]):
        self.data = b"".join(texts)
        sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(sizes)
        raw = np.frombuffer(self.data, np.uint8)
        parts: list[tuple[np.ndarray, ...]] = []
        step = PIECE - WINDOW
        row_of = np.repeat(np.arange(len(texts)), sizes)
        # Pieces begin at multiples of ``step``; a seed split by one owns two shorter runs of windows.
        for at in range(0, len(raw) - WINDOW + 1, step):
            data = raw[at : at + step + WINDOW - 1]
            hashes = _seed_hashes(data)
            keyed = (hashes >> np.uint64(PIECE_BITS) << np.uint64(PIECE_BITS)) | np.arange(len(hashes), dtype=np.uint64)
            owner = (_slide(keyed, WINDOW - SEED_BYTES + 1) & np.uint64(PIECE - 1)).astype(np.int64)
            windows = np.arange(len(owner)) + at
            whole = windows + WINDOW <= self.ends[row_of[windows]]
            owner, windows = owner[whole], windows[whole]
            if len(owner):
                begins = np.concatenate(([True], (owner[1:] != owner[:-1]) | (windows[1:] != windows[:-1] + 1)))
                first = windows[begins]
                last = windows[np.concatenate((begins[1:], [True]))]
                parts.append((hashes[owner[begins]], owner[begins] + at, row_of[first], first, last))
        columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 5
        self.hash, (self.pos, self.row, self.first, self.last) = columns[0].astype(np.uint64), columns[1:]


def _shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def _ids(hashes: np.ndarray, shards: int) -> np.ndarray:
    """What shards call seeds: the shard and the low bits."""
    return (_shard_of(hashes, shards).astype(np.uint64) << np.uint64(32)) | (hashes & LOW)


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _announce(shards: int):
    """Step 1, map: for each shard the seeds of some texts, once each, with the block of the text; seeds of several
    texts as known. Those are told to their blocks at once; the rows pass through a shard."""

    def send(held: list[tuple[int, int, bytes]]) -> pa.RecordBatch | None:
        owners = Owners([t for _, _, t in held])
        docs, blocks = (np.array([h[i] for h in held], np.int64) for i in (0, 1))
        order = np.argsort(owners.hash, kind="stable")
        hashes, rows = owners.hash[order], owners.row[order]
        if not len(hashes):
            return None
        begins = np.concatenate(([True], hashes[1:] != hashes[:-1]))
        group = np.cumsum(begins) - 1
        first = docs[rows[begins]]
        several = np.zeros(len(first), bool)
        several[group[docs[rows] != first[group]]] = True
        distinct = hashes[begins]
        shard, out = _shard_of(distinct, shards), []
        # Rows that repeat an id with another text may lie in other blocks: a seed is told for each of its blocks.
        alone = ~several[group]
        block, of = np.unique(np.stack((blocks[rows[alone]], group[alone]), axis=1), axis=0).T
        dealt = np.argsort(shard[of], kind="stable")
        block, of = block[dealt], of[dealt]
        shared = np.nonzero(several)[0]
        shared = shared[np.argsort(shard[shared], kind="stable")]
        low = (distinct & LOW).astype(np.uint32)
        for number in np.unique(shard).tolist():
            one = slice(*np.searchsorted(shard[of], [number, number + 1]))
            many = slice(*np.searchsorted(shard[shared], [number, number + 1]))
            to = [x.astype(np.uint32).tobytes() for x in np.unique(block[one], return_counts=True)]
            out.append((number, -1, b"", low[shared[many]].tobytes(), low[of[one]].tobytes(), *to))
        known = several[group]
        pairs = np.unique(np.stack((blocks[rows[known]].astype(np.uint64), _ids(hashes[known], shards)), axis=1), axis=0)
        for part in np.split(pairs, np.nonzero(np.diff(pairs[:, 0]))[0] + 1) if len(pairs) else []:
            to = int(part[0, 0])
            out.append((to % shards, to, np.ascontiguousarray(part[:, 1]).tobytes(), b"", b"", b"", b""))
        return _batch(HEARD, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for doc, block, text in zip(*(batch.column(i) for i in range(3))):
                text = text.as_py()
                if len(text) >= WINDOW:
                    held.append((doc.as_py(), block.as_py(), text))
                    size += len(text)
                if size >= SEND_BYTES:
                    if found := send(held):
                        yield found
                    held, size = [], 0
        if held and (found := send(held)):
            yield found

    return run


def _numbers(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _repeated(heard: pa.Table) -> pa.Table:
    """Step 1, reduce: the seeds of a shard that occur more than once, told to the blocks that announced them."""
    shard = heard["shard"][0].as_py()
    known, lows, blocks, counts = (_numbers(heard[c], np.uint32) for c in ("known", "lows", "blocks", "counts"))
    blocks = np.repeat(blocks, counts)
    order = np.argsort(lows, kind="stable")
    lows, blocks = lows[order], blocks[order]
    twice = np.zeros(len(lows), bool)
    twice[1:] = lows[1:] == lows[:-1]
    twice[:-1] |= twice[1:]
    twice |= np.isin(lows, np.unique(known))
    ids, blocks = lows[twice].astype(np.uint64) | (np.uint64(shard) << np.uint64(32)), blocks[twice]
    order = np.argsort(blocks, kind="stable")
    parts = np.split(order, np.nonzero(np.diff(blocks[order]))[0] + 1) if len(order) else []
    out = [(int(blocks[p[0]]), ids[p].tobytes()) for p in parts]
    out += [(b, i) for b, i in zip(heard["block"].to_pylist(), heard["ids"].to_pylist()) if b >= 0]
    return pa.Table.from_batches([_batch(IDS, out)] if out else [], schema=IDS)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of the same block packed together, as they are shuffled twice."""

    def send(held: dict[int, list[tuple[int | None, bytes | None]]]) -> pa.RecordBatch:
        out = []
        for block, rows in held.items():
            ids = np.array([d or 0 for d, _ in rows], np.int64)
            known = np.array([(d is not None) + 2 * (t is not None) for d, t in rows], np.uint8)
            sizes = np.array([len(t or b"") for _, t in rows], np.uint32)
            texts = b"".join(t or b"" for _, t in rows)
            out.append((block, *(_packed(x) for x in (ids.tobytes(), known.tobytes(), sizes.tobytes(), texts))))
        return _batch(PACKED, out)

    held: dict[int, list] = {}
    size = 0
    for batch in batches:
        for block, doc, text in zip(*(batch.column(i) for i in range(3))):
            text = text.as_py()
            held.setdefault(block.as_py(), []).append((doc.as_py(), text))
            size += len(text or b"")
            if size >= SEND_BYTES:
                yield send(held)
                held, size = {}, 0
    if held:
        yield send(held)


def _rows(docs: pa.Table) -> list[tuple[int | None, bytes | None]]:
    out = []
    for n in range(docs.num_rows):
        ids, known, sizes, texts = (_unpacked(docs[c][n].as_py()) for c in ("ids", "known", "sizes", "texts"))
        ends = np.cumsum(np.frombuffer(sizes, np.uint32), dtype=np.int64).tolist()
        for doc, flags, a, b in zip(np.frombuffer(ids, np.int64).tolist(), known, [0, *ends], ends):
            out.append((doc if flags & 1 else None, texts[a:b] if flags & 2 else None))
    return out


def _sorted_texts(rows: list[tuple[int | None, bytes | None]]) -> tuple[np.ndarray, list[bytes]]:
    """Ids and texts of a block in an order that both visits agree on."""
    known = sorted((d, t) for d, t in rows if d is not None and t is not None)
    return np.array([d for d, _ in known], np.int64), [t for _, t in known]


def _merged(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Unions of the intervals of each row, as rows of (row, start, end)."""
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], end[order]
    if not len(row):
        return np.zeros((0, 3), np.int64)
    # One axis for all rows: far apart, so that no interval reaches into the next row.
    shift = row * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + shift)
    begins = np.concatenate(([True], (start + shift)[1:] > reach[:-1]))
    ends = np.concatenate((begins[1:], [True]))
    return np.stack((row[begins], start[begins], reach[ends] - shift[ends]), axis=1)


def _variants(shards: int):
    """Step 2: variants of repeated seeds in one block. Copies of a variant behind its least ``doc_id`` are settled, and
    their merged intervals pass through a shard as ``rows``; the others go to the seed's shard."""

    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        if not docs.num_rows or not told.num_rows:
            return pa.Table.from_batches([], schema=SENT)
        block = docs["block"][0].as_py()
        ids, texts = _sorted_texts(_rows(docs))
        owners = Owners(texts)
        repeated = np.isin(_ids(owners.hash, shards), np.unique(_numbers(told["ids"], np.uint64)))
        which = np.nonzero(repeated)[0]
        shard = _shard_of(owners.hash[which], shards).tolist()
        first, stop = owners.first[which], owners.last[which] + WINDOW
        begin = owners.ends - np.array([len(t) for t in texts], np.int64)
        rows, rel = owners.row[which], owners.pos[which] - first
        local = (first - begin[rows]).tolist()
        data, least, sent, settled = owners.data, {}, {}, []
        # Rows are in the order of their ids, so the first copy of a variant has the least one.
        for n, (s, a, b, r, row, at) in enumerate(zip(shard, first.tolist(), stop.tolist(), rel.tolist(), rows.tolist(), local)):
            key = (r, data[a:b])
            doc = ids[row]
            if least.setdefault(key, doc) == doc:
                sent.setdefault(s, []).append((key[1], r, row, at))
            else:
                settled.append(n)
        out = []
        for s, found in sent.items():
            pieces, rels, owner, at = zip(*found)
            out.append(
                (s, block, _packed(b"".join(pieces)), _packed(np.array([len(p) for p in pieces], np.uint32).tobytes()),
                 _packed(np.array(rels, np.uint8).tobytes()),
                 *(_packed(np.array(x, np.int64).tobytes()) for x in (ids[list(owner)], owner, at)))
            )
        if settled:
            gone = rows[settled]
            spans = _merged(gone, first[settled] - begin[gone], stop[settled] - begin[gone])
            out.append((block % shards, block, b"", b"", b"", b"", spans.tobytes(), b""))
        return pa.Table.from_batches([_batch(SENT, out)] if out else [], schema=SENT)

    return run


def least_documents(variants: list[bytes], docs: np.ndarray) -> list[np.ndarray]:
    """For every 50-byte window of each variant, the least of ``docs`` that has it in one of its variants."""
    sizes = np.array([len(v) for v in variants], np.int64)
    raw = np.frombuffer(b"\0".join(variants) + b"\0", np.uint8)
    ends = np.cumsum(sizes + 1) - 1
    text = raw.astype(np.int64) + 1
    text[ends] = 0
    variant = np.repeat(np.arange(len(sizes)), sizes + 1)
    order = suffix_array(text)
    order = order[order + WINDOW <= ends[variant[order]]]
    windows = np.lib.stride_tricks.sliding_window_view(raw, WINDOW)
    begins = np.ones(len(order), bool)
    begins[1:] = (windows[order[1:]] != windows[order[:-1]]).any(axis=1)
    own = np.asarray(docs, np.int64)[variant[order]]
    least = np.minimum.reduceat(own, np.nonzero(begins)[0])[np.cumsum(begins) - 1]
    at = np.zeros(len(text), np.int64)
    at[order] = least
    return [at[e - s : e - WINDOW + 1] for s, e in zip(sizes.tolist(), ends.tolist())]


def _lost(found: np.ndarray, begin: np.ndarray, sizes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Runs of windows that a smaller document than the variant's has: rows of (variant, first, last). ``found`` is the
    least document of each window, and a variant's ``sizes`` windows begin there at ``begin``."""
    variant = np.repeat(np.arange(len(sizes)), sizes)
    window = np.arange(len(variant)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    lost = np.nonzero(found[begin[variant] + window] < docs[variant])[0]
    variant, window = variant[lost], window[lost]
    if not len(lost):
        return np.zeros((0, 3), np.int64)
    cut = np.concatenate(([True], (variant[1:] != variant[:-1]) | (window[1:] != window[:-1] + 1)))
    return np.stack((variant[cut], window[cut], window[np.concatenate((cut[1:], [True]))]), axis=1)


def _decide(sent: pa.Table) -> pa.Table:
    """Step 3: which windows of the sent variants a smaller document has, as merged intervals for each block."""
    pieces, rels, parts, out = [], [], [], []
    for n in range(sent.num_rows):
        if not len(sent["sizes"][n].as_py()):
            out.append((sent["block"][n].as_py(), sent["rows"][n].as_py()))
            continue
        sizes = np.frombuffer(_unpacked(sent["sizes"][n].as_py()), np.uint32)
        data, ends = _unpacked(sent["variants"][n].as_py()), np.cumsum(sizes).tolist()
        pieces += [data[a:b] for a, b in zip([0, *ends], ends)]
        rels += list(_unpacked(sent["rels"][n].as_py()))
        doc, row, first = (np.frombuffer(_unpacked(sent[c][n].as_py()), np.int64) for c in ("docs", "rows", "firsts"))
        parts.append((doc, row, first, np.full(len(doc), sent["block"][n].as_py(), np.int64)))
    if not parts:
        return pa.Table.from_batches([_batch(IDS, out)] if out else [], schema=IDS)
    docs, rows, firsts, blocks = (np.concatenate(c) for c in zip(*parts))
    numbers: dict[tuple[int, bytes], int] = {}
    key = np.array([numbers.setdefault(k, len(numbers)) for k in zip(rels, pieces)], np.int64)
    keys = [v for _, v in numbers]
    sizes = np.array([len(v) for v in keys], np.int64)
    least = np.full(len(keys), np.iinfo(np.int64).max)
    np.minimum.at(least, key, docs)
    by_seed: dict[bytes, list[int]] = {}
    for (rel, v), number in numbers.items():
        by_seed.setdefault(v[rel : rel + SEED_BYTES], []).append(number)
    # Where the windows of a sorted variant begin in the decided ones.
    begin, decided, done = np.full(len(keys), -1, np.int64), [np.zeros(0, np.int64)], 0
    held: list[int] = []

    def sort_held() -> None:
        nonlocal done
        if held:
            found = least_documents([keys[k] for k in held], least[held])
            ends = np.cumsum([len(f) for f in found]) + done
            begin[held] = np.concatenate(([done], ends[:-1]))
            done = int(ends[-1])
            decided.extend(found)
            held.clear()

    size = 0
    for same in by_seed.values():
        if len(same) > 1:
            held += same
            size += sum(len(keys[k]) + 1 for k in same)
        if size >= SORT_CHARS:
            sort_held()
            size = 0
    sort_held()
    whole = np.nonzero((begin[key] < 0) & (least[key] < docs))[0]
    spans = [np.stack((blocks[whole], rows[whole], firsts[whole], firsts[whole] + sizes[key[whole]]), axis=1)]
    found, part = np.concatenate(decided), np.nonzero(begin[key] >= 0)[0]
    for at in range(0, len(part), DECIDE_VARIANTS):
        some = part[at : at + DECIDE_VARIANTS]
        which, a, b = _lost(found, begin[key[some]], sizes[key[some]] - WINDOW + 1, docs[some]).T
        some = some[which]
        spans.append(np.stack((blocks[some], rows[some], firsts[some] + a, firsts[some] + b + WINDOW), axis=1))
    gone = np.concatenate(spans)
    gone = gone[np.argsort(gone[:, 0], kind="stable")]
    for of in np.split(gone, np.nonzero(np.diff(gone[:, 0]))[0] + 1) if len(gone) else []:
        out.append((int(of[0, 0]), _merged(*of[:, 1:].T).tobytes()))
    return pa.Table.from_batches([_batch(IDS, out)] if out else [], schema=IDS)


RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()),
     ("kept_sha256", pa.string())]
)
RESULT_DDL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"


def _remove(with_bytes: bool):
    """Step 4: every row of a block without its removed bytes."""

    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        all_rows = _rows(docs)
        ids, texts = _sorted_texts(all_rows)
        spans = np.frombuffer(b"".join(told["ids"].to_pylist()), np.int64).reshape(-1, 3)
        spans = _merged(*spans.T)
        of: dict[int, list[tuple[int, int]]] = {}
        for row, start, end in spans.tolist():
            of.setdefault(row, []).append((start, end))
        # Rows without an id or a text come last; nothing is removed from them.
        rows = list(zip(ids.tolist(), texts))
        rows += [(d, t or b"") for d, t in all_rows if d is None or t is None]
        out = []
        for row, (doc, text) in enumerate(rows):
            cut = of.get(row, [])
            ends = [0, *[e for _, e in cut]]
            kept = b"".join(text[a:b] for a, b in zip(ends, [*[s for s, _ in cut], len(text)]))
            digest = hashlib.sha256(kept).hexdigest()
            out.append((doc, len(text), len(text) - len(kept), len(cut), kept if with_bytes else None, digest))
        return pa.Table.from_batches([_batch(RESULT, out)] if out else [], schema=RESULT)

    return run


def remove_repeats(docs: DataFrame, with_bytes: bool = True) -> DataFrame:
    """Every row of ``docs`` (``doc_id`` integer, ``text``) without the bytes that a 50-byte string covers which also
    starts in a row with a smaller ``doc_id``.

    ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept`` (the remaining bytes, NULL unless
    ``with_bytes``) and their ``kept_sha256``. Strings are judged on the input. Texts under 50 bytes, NULL and
    empty ones lose nothing. Rows with a NULL ``doc_id`` have no place in the order: they lose nothing and take
    nothing. Rows that repeat a ``doc_id`` take nothing from each other. Other columns are ignored; an empty
    table gives an empty result.
    """
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    shards = max(1, -(-int(size) // BLOCK_BYTES))
    # Keyed by text as well: a hot id is dealt out by its texts.
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("bytes"), block.alias("block"))
    placed = rows.where("doc_id is not null and bytes is not null")
    heard = placed.select("doc_id", "block", "bytes").mapInArrow(_announce(shards), HEARD_DDL)
    told = stored(heard.groupBy("shard").applyInArrow(_repeated, IDS_DDL), "repeated_seeds")
    packed = rows.select("block", "doc_id", "bytes").mapInArrow(_pack, PACKED_DDL)
    sent = packed.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_variants(shards), SENT_DDL)
    gone = stored(sent.groupBy("shard").applyInArrow(_decide, IDS_DDL), "repeats")
    return packed.groupBy("block").cogroup(gone.groupBy("block")).applyInArrow(_remove(with_bytes), RESULT_DDL)


# Workers get these functions by value, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
