import math
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tests.llm.samples import awkward, documents, words
from tidedesk.llm import perplexity as P
from tidedesk.llm.perplexity import perplexities

N = P.ORDER


def brute(trusted, texts):
    """Perplexities by the textbook formulas, with dictionaries."""
    grams = [(b"\0" * (N - 1) + t)[i : i + N] for t in trusted for i in range(len(t))]
    count = {N: Counter(grams)}
    for m in range(N - 1, 0, -1):
        count[m] = Counter(g[1:] for g in count[m + 1])
    total, kinds, cut = {}, {}, {}
    for m in range(1, N + 1):
        total[m], kinds[m] = Counter(), defaultdict(Counter)
        of = Counter(min(c, 5) for c in count[m].values())
        for g, c in count[m].items():
            total[m][g[:-1]] += c
            kinds[m][g[:-1]][min(c, 3)] += 1
        cut[m] = {}
        for k in (1, 2, 3):
            d = None
            if of[1] and of[2] and of[k]:
                d = k - (k + 1) * of[1] / (of[1] + 2 * of[2]) * of[k + 1] / of[k]
            cut[m][k] = d if d is not None and 0 < d <= k else 0.5 * k

    def p(g):
        m = len(g)
        below = p(g[1:]) if m > 1 else 1 / 256
        if not total[m][g[:-1]]:
            return below
        c, t = count[m][g], total[m][g[:-1]]
        own = max(c - cut[m][min(c, 3)], 0) / t if c else 0
        return own + sum(cut[m][k] * n for k, n in kinds[m][g[:-1]].items()) / t * below

    return [math.exp(-sum(math.log(p((b"\0" * (N - 1) + t)[i : i + N])) for i in range(len(t))) / len(t)) for t in texts]


def test_equals_brute_force(spark, monkeypatch):
    rows = [(n, words(n, 40, 60)) for n in range(30)] + [(30, "qqqq zzzz é"), (31, "w")]
    labels = spark.createDataFrame([(n, int(n < 20), 0) for n in range(25)], "doc_id long, quality int, toxic int")
    held = {r[0] for r in spark.range(20).where(F.pmod(F.xxhash64("id"), F.lit(P.HELD_OUT)) == 0).collect()}
    assert 0 < len(held) < 20
    want = brute([t.encode() for n, t in rows if n < 20 and n not in held], [t.encode() for _, t in rows])
    got = {r["doc_id"]: r for r in perplexities(documents(spark, rows), labels).collect()}
    for (n, _), w in zip(rows, want):
        assert math.isclose(got[n]["perplexity"], w, rel_tol=1e-5)
    assert not got[30]["kept"]
    # The limit is that of the worst of a few held-out texts, which were not counted.
    assert got[0]["threshold"] == max(got[n]["perplexity"] for n in held)
    assert all(r["kept"] == (r["perplexity"] <= r["threshold"]) for r in got.values())
    monkeypatch.setattr(P, "PART_GRAMS", 400)
    monkeypatch.setattr(P, "COUNT_BYTES", 500)
    monkeypatch.setattr(P, "SCORE_BYTES", 300)
    monkeypatch.setattr(P, "BROADCAST_IDS", 0)
    parts = {r["doc_id"]: r for r in perplexities(documents(spark, rows), labels).collect()}
    for n, _ in rows:
        assert math.isclose(parts[n]["perplexity"], got[n]["perplexity"], rel_tol=1e-5)


def test_awkward_rows_and_empty_tables(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (8, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    out = perplexities(docs, labels).collect()
    assert len(out) == docs.count()
    for r in out:
        assert (r["perplexity"] is None) == (r["n_bytes"] == 0)
        assert r["kept"] or r["perplexity"] > r["threshold"]
    assert all(r["threshold"] is None and r["kept"] for r in out if r["lang"] == "de")
    blank = perplexities(docs, labels.limit(0)).collect()
    assert all(r["kept"] and (r["perplexity"] is None or math.isclose(r["perplexity"], 256, rel_tol=1e-5)) for r in blank)
    assert perplexities(documents(spark, []), labels).count() == 0
