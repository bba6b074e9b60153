import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tests.llm.samples import words
from tidedesk.llm import prefix_trie as trie
from tidedesk.llm.prefix_trie import RangeMinima

SCHEMA = "conv_id long, turn long, role string, text string, c string, place string, depth string, s string, first string"


def conversations(spark, rows):
    return spark.createDataFrame([(*row, *["x"] * 5) for row in rows], SCHEMA)


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, x) for _, _, r, x in sorted(v, key=lambda t: (t[:2], t[2].encode(), t[3].encode()))] for c, v in own.items()}
    built = {}
    for c in turns:
        n = zlib.crc32(str(c).encode()) % 9
        built[c] = turns.get(c - c % 5, [])[:n] + turns[c][n:]
    members, children = defaultdict(list), defaultdict(list)
    for c, s in built.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    leaves, saved, out = {}, {}, []
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in children[k]) or 1
        own_saving = (len(members[k]) - 1) * len(k[-1][1].encode()) if k else 0
        saved[k] = own_saving + sum(saved[x] for x in children[k])
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(k))
        parent = min(members[k[:-1]]) if k else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(m), len(k), parent, len(m), len(children[k]), leaves[k], saved[k], sha))
    return sorted(out, key=str)


def check(spark, rows):
    got = sorted((tuple(r) for r in trie.prefix_trie(conversations(spark, rows)).collect()), key=str)
    assert got == brute(rows)
    return got


def test_findclose_equals_a_scan():
    draw = random.Random(5)
    for n in (1, 2, 63, 64, 65, 128, 129, 700, 3000):
        depths = [draw.randrange(3)]
        while len(depths) < n:
            depths.append(draw.randrange(max(0, depths[-1] - draw.choice((0, 0, 1, 30))), depths[-1] + 2))
        at = np.arange(-1, n)
        limit = np.array([draw.randrange(6), *depths])
        got = RangeMinima(np.array(depths)).findclose(at, limit)
        assert got.tolist() == [next((j for j in range(a + 1, n) if depths[j] <= x), n) for a, x in zip(at, limit)]


def branching(seed, n, prompts=4):
    """Conversations that share beginnings: copies, beginnings of others, a prompt that most begin with."""
    draw = random.Random(seed)
    rows, made = [], []
    for c in range(n):
        kind = draw.random()
        if made and kind < 0.3:
            turns = draw.choice(made)[: draw.randrange(1, 9)]
        elif made and kind < 0.6:
            other = draw.choice(made)
            turns = other[: draw.randrange(len(other) + 1)] + [("user", words(1000 + c + k, 3)) for k in range(draw.randrange(1, 5))]
        else:
            turns = [("system", f"Prompt {draw.randrange(prompts)} ä")] + [("user", words(c * 9 + k, 2)) for k in range(draw.randrange(9))]
        made.append(turns)
        rows += [(c, k, r, x) for k, (r, x) in enumerate(turns)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("size", [3, 40, 1 << 17])
def test_shards_of_any_size(spark, monkeypatch, size):
    monkeypatch.setattr(trie.subtree_totals, "__defaults__", (size,))
    check(spark, branching(size, 60))


def test_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 16)
    monkeypatch.setattr(trie, "RANKED_TURNS", 4)
    monkeypatch.setattr(trie.subtree_totals, "__defaults__", (50,))
    rows = [(10, k, "user", f"t{k}") for k in range(150)] + [(15, k, "user", f"t{k}" if k < 97 else f"u{k}") for k in range(120)]
    rows += [(20, k, "user", f"t{k}") for k in range(150)] + [(25, 0, "user", "t0")]
    check(spark, rows)


def test_many_equal_conversations_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "JOINED_BYTES", 20)
    got = check(spark, [(c, k, "user", f"t{k}") for c in range(0, 500, 5) for k in range(3)])
    assert max(r[3] for r in got) == 100


def test_awkward_rows_and_empty_table(spark):
    rows = [(1, None, None, None), (1, None, "b", None), (1, None, "a", "z"), (1, 2, "user", ""), (1, 2, "user", ""), (None, 1, "user", "lost")]
    rows += [(7, 0, "user", words(1, 20_000)), (8, 0, "user", words(1, 20_000)), (40, -3, "ä", "Ö"), (40, 0, None, "x"), (12, 0, "user", "only")]
    assert zlib.crc32(b"12") % 9 > 0  # loses its only turn, as its family's first conversation is not there
    got = check(spark, rows)
    assert (8, 0) not in {r[:2] for r in got} and (1, 0) in {r[:2] for r in got}
    assert trie.prefix_trie(conversations(spark, [])).count() == 0
