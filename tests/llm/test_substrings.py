import hashlib
import random

import numpy as np

from tests.llm.samples import awkward, documents
from tidedesk.llm import substrings
from tidedesk.llm.substrings import WINDOW, remove_repeats
from tidedesk.llm.suffixes import lyndon_groups, suffix_array


def naive_order(text):
    def key(i):
        end = text.index(0, i)
        return (*text[i:end], 0), end

    return sorted(range(len(text)), key=key)


def test_suffix_array_equals_sorting():
    draw = random.Random(1)
    for _ in range(600):
        letters = draw.choice((1, 2, 3, 8))
        text = [draw.choice([0] + list(range(1, letters + 1)) * 4) for _ in range(draw.randrange(60))] + [0]
        assert suffix_array(np.array(text)).tolist() == naive_order(text)


def test_groups_are_lyndon_prefixes():
    text = [2, 1, 3, 1, 2, 1, 3, 3, 1, 1, 0]
    group, length = lyndon_groups(np.array(text))
    for i in range(len(text) - 1):
        rest = text[i:]
        smaller = next(k for k in range(1, len(rest)) if rest[k:] < rest)
        assert length[i] == smaller
    for i in range(len(text)):
        for j in range(len(text)):
            a, b = text[i : i + length[i]], text[j : j + length[j]]
            assert (group[i] < group[j]) == (a < b)


def brute(rows):
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        if doc is not None:
            seen = {
                (t or "").encode()[i : i + WINDOW] for d, t in rows if d is not None and d < doc for i in range(len((t or "").encode()) - WINDOW + 1)
            }
            for i in range(len(data) - WINDOW + 1):
                if data[i : i + WINDOW] in seen:
                    gone[i : i + WINDOW] = b"\1" * WINDOW
        kept = bytes(x for x, g in zip(data, gone) if not g)
        spans = sum(g and (not i or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((str(doc), len(data), sum(gone), spans, kept.hex(), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((str(r[0]), r[1], r[2], r[3], bytes(r[4]).hex(), r[5]) for r in df.collect())


def repeats(draw, n):
    passages = ["".join(draw.choices("abcdé \0", k=draw.randrange(45, 130))) for _ in range(8)] + ["a" * 90, "ab" * 60]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(draw.randrange(5)):
            p = draw.choice(passages)
            cut = draw.randrange(10)
            parts += ["".join(draw.choices("abcdé ", k=draw.randrange(30))), p[cut : len(p) - draw.randrange(10)]]
        rows.append((draw.choice((i, i, i, n - i, None)), "".join(parts)))
    return rows


def test_equals_brute_force(spark):
    rows = repeats(random.Random(2), 60)
    assert result(remove_repeats(documents(spark, rows))) == brute(rows)


def test_equals_brute_force_over_many_shards_and_pieces(spark, monkeypatch):
    for name, value in (("BLOCK_BYTES", 2000), ("SEND_BYTES", 1000), ("SORT_CHARS", 500), ("PIECE_BITS", 8), ("PIECE", 256)):
        monkeypatch.setattr(substrings, name, value)
    rows = repeats(random.Random(3), 60)
    assert result(remove_repeats(documents(spark, rows))) == brute(rows)


def test_awkward_rows_and_empty_table(spark):
    docs = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert result(remove_repeats(docs)) == brute(rows)
    assert remove_repeats(documents(spark, [])).count() == 0


def test_an_id_with_several_texts_in_other_blocks(spark, monkeypatch):
    """Every row with the id loses what a smaller id has, whatever tasks and blocks they lie in."""
    monkeypatch.setattr(substrings, "BLOCK_BYTES", 500)
    draw = random.Random(9)
    passage = "".join(draw.choices("abcdefgh ", k=82))
    rows = [(5, f"{''.join(draw.choices('ijklmnop', k=40 + k))} {passage}{'qrstuvwxyz'[k] * 30}") for k in range(8)]
    rows += [(3, f"start {passage} end")] + [(100 + k, "".join(draw.choices("abcdefgh ", k=300))) for k in range(12)]
    docs = documents(spark, rows[:8]).coalesce(1).union(documents(spark, rows[8:]).coalesce(1))
    got = result(remove_repeats(docs))
    assert got == brute(rows)
    assert sum(r[2] >= 82 for r in got) == 8
