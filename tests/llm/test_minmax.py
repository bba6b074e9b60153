import random
from collections import defaultdict

import numpy as np

from tests.llm.samples import awkward, documents, words
from tidedesk.llm.minmax import near_copies, shingle_set, signature


def brute_set(text):
    w = [x for x in (text or "").lower().replace("\t", " ").replace("\n", " ").split(" ") if x]
    return frozenset(tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))) if w else frozenset()


def brute(rows):
    """Per row (doc_id, n_shingles, component_id, kept), from all pairs."""
    sets = [(d, brute_set(t)) for d, t in rows]
    label = list(range(len(rows)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j][1])
            if both and 100 * both >= 80 * len(a | sets[j][1]):
                label[max(root(i), root(j))] = min(root(i), root(j))
    ids = defaultdict(list)
    for k, (d, _) in enumerate(sets):
        if d is not None:
            ids[root(k)].append(d)
    least = [min(ids[root(k)], default=None) for k in range(len(rows))]
    return sorted(((d, len(s), c, d == c) for (d, s), c in zip(sets, least)), key=str)


def check(spark, rows):
    out = near_copies(documents(spark, rows), ["doc_id"])
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == brute(rows)
    return got


def changed(text, seed, n):
    w, draw = text.split(), random.Random(seed)
    for k in draw.sample(range(len(w)), n):
        w[k] = f"new{seed}x{k}"
    return " ".join(w)


def test_sets_and_signatures():
    for text in (None, "", " \n", "one", "One two", "a b c d", words(1, 700) + " " + words(1, 300)):
        assert len(shingle_set((text or "").encode())) == len(brute_set(text))
    a, b = shingle_set(words(1, 400).encode()), shingle_set(changed(words(1, 400), 2, 12).encode())
    similarity = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    same = np.mean([x == y for x, y in zip(np.stack(signature(a)).ravel(), np.stack(signature(b)).ravel())])
    assert abs(same - similarity) < 0.1


def test_copies_around_the_limit_equal_all_pairs(spark):
    rows = []
    for n in range(30):
        text = words(n, 200 if n % 2 else 60)
        rows.append((500 - n, text))
        rows += [(1000 + 20 * n + k, changed(text, k + 1, 1 + k)) for k in range(8)]
        rows.append((3000 + n, text.upper()))
    got = check(spark, rows)
    assert 0 < sum(not r[3] for r in got) < len(rows)


def test_a_template_with_own_parts_makes_few_pairs(spark):
    template = words(7, 120)
    rows = [(n, f"{template} {words(100 + n, 40)}") for n in range(150)]
    rows += [(1000 + n, f"{template} {words(300 + n, 9)}") for n in range(60)]
    check(spark, rows)


def test_chain_of_similar_texts(spark):
    chain = [words(5, 300)]
    for k in range(8):
        w = chain[-1].split()
        w[k * 30 : k * 30 + 25] = [f"c{k}w{i}" for i in range(25)]
        chain.append(" ".join(w))
    got = check(spark, [(90 - k, t) for k, t in enumerate(chain)])
    assert {r[2] for r in got} == {82}


def test_short_texts_and_repeated_ids(spark):
    rows = [(1, "yes"), (2, "Yes"), (3, "yes no"), (4, "no"), (5, "yes no"), (5, "other text with five words"), (6, "")]
    check(spark, rows)


def test_awkward_rows_and_empty_table(spark):
    docs = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    expected = {r for r in brute(rows) if r[0] is not None}
    got = near_copies(docs, ["doc_id", "row", "label"]).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got if r["doc_id"] is not None} == expected
    assert len(got) == len(rows) and all(r["component_id"] is None and r["kept"] for r in got if r["doc_id"] is None)
    assert near_copies(documents(spark, []), ["doc_id"]).count() == 0
