from tests.llm.samples import documents, words
from tidedesk.llm.quality import CUTOFF, quality_rules


def junk(n):
    return " ".join(f"{w}###$$$" for w in words(n, 80).split())


def test_small_groups_are_judged_by_language_then_by_all(spark):
    rows = [(n, words(n, 60 + n % 50), "en", f"s{n % 20}") for n in range(200)]
    rows += [(300 + n, words(300 + n, 70), "fr", "rare") for n in range(5)]
    rows += [(1000 + n, junk(n), lang, source) for n, (lang, source) in enumerate([("en", "s3"), ("en", "new"), ("fr", "rare"), (None, None)])]
    out = {r["doc_id"]: r for r in quality_rules(documents(spark, rows), ["doc_id"]).collect()}
    assert len(out) == len(rows) and all(r["distance"] is not None for r in out.values())
    assert all(out[n]["kept"] for n in out if n < 1000)
    assert all(not out[1000 + n]["kept"] and out[1000 + n]["distance"] > CUTOFF for n in range(4))


def test_large_groups_do_not_depend_on_the_others(spark):
    rows = [(n, words(n, 60 + n % 50), "en", "large") for n in range(100)]
    alone = {r["doc_id"]: r["distance"] for r in quality_rules(documents(spark, rows), ["doc_id"]).collect()}
    rows += [(500 + n, junk(n), "en", f"s{n}") for n in range(30)]
    mixed = {r["doc_id"]: r["distance"] for r in quality_rules(documents(spark, rows), ["doc_id"]).collect()}
    assert all(abs(mixed[n] - alone[n]) < 1e-9 for n in alone)
