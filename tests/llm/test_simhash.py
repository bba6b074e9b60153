import random

import numpy as np
import xxhash

from tests.llm.samples import awkward, documents, words
from tidedesk.llm import simhash
from tidedesk.llm.simhash import deal, fingerprint, links, near_duplicates, print_links, upper_tree


def brute_print(text):
    w = [x for x in (text or b"").lower().replace(b"\t", b" ").replace(b"\n", b" ").split(b" ") if x]
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints):
    label = {p: p for p in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (a ^ b).bit_count() <= 3 and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


def test_fingerprint():
    for text in (None, b"", b" \n", b"One", b"one two", b"one two three", b"A b  c\td\ne " * 9, "Äö é ñ Ä".encode(), words(3, 500).encode()):
        assert fingerprint(text) == brute_print(text)


def clustered(draw, n):
    prints = set()
    while len(prints) < n:
        p = draw.getrandbits(64)
        for _ in range(draw.choice((1, 1, 1, 6))):
            prints.add(p)
            for bit in draw.sample(range(64), draw.randrange(5)):
                p ^= 1 << bit
    return sorted(prints)


def test_links_and_dealing_equal_brute_force(spark, monkeypatch):
    prints = clustered(random.Random(3), 900)
    expected = components(prints)
    a, b = links(np.array(prints[:300], np.uint64), np.array(prints[300:], np.uint64))
    monkeypatch.setattr(simhash, "SHARD_PRINTS", 64)
    tree = upper_tree(np.array(prints, np.uint64), 4)
    assert len(deal(np.array(prints, np.uint64), tree)) > 8
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    edges = print_links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()
    label = {p: p for p in prints}

    def root(p):
        while label[p] != p:
            p = label[p]
        return p

    for r in edges:
        x, y = root(r["a"] % (1 << 64)), root(r["b"] % (1 << 64))
        label[max(x, y)] = min(x, y)
    assert {p: root(p) for p in prints} == expected


def test_near_duplicates_equal_brute_force(spark):
    draw = random.Random(8)
    texts = []
    for n in range(40):
        w = words(n, 300).split()
        texts.append(" ".join(w))
        for _ in range(n % 3):
            w[draw.randrange(300)] = "changed"
            texts.append(" ".join(w))
    rows = [(100 - n, t) for n, t in enumerate(texts)] + [(500, None), (501, ""), (502, texts[0])]
    got = {r["doc_id"]: r for r in near_duplicates(documents(spark, rows), ["doc_id"]).collect()}
    label = components({fingerprint((t or "").encode()) for _, t in rows})
    least = {}
    for d, t in rows:
        key = label[fingerprint((t or "").encode())]
        least[key] = min(d, least.get(key, d))
    for d, t in rows:
        p = fingerprint((t or "").encode())
        assert got[d]["fp"] % (1 << 64) == p and got[d]["component_id"] == least[label[p]]


def test_awkward_rows_and_empty_table(spark):
    docs = awkward(spark)
    out = near_duplicates(docs, ["doc_id", "row"]).collect()
    assert len(out) == docs.count()
    component = {(r["doc_id"], r["fp"]): r["component_id"] for r in out}
    assert component[2, next(r["fp"] for r in out if r["doc_id"] == 2)] == 1
    assert {r["component_id"] for r in out if r["fp"] == 0} == {3}
    assert {r["component_id"] for r in out if r["doc_id"] in (8, 9)} == {8}
    assert near_duplicates(documents(spark, []), ["doc_id"]).count() == 0
