import math
from collections import Counter, defaultdict

import pytest

from tests.llm.samples import awkward, documents
from tidedesk.llm.mixing import mix_sources, source_weights


def weights(spark, tokens, **target):
    rows = spark.createDataFrame(list(tokens.items()), "src string, tokens long")
    return {r["src"]: r for r in source_weights(rows, **target).collect()}


def test_repetition_limit_is_met(spark):
    tokens = {"a": 9000, "b": 900, "c": 100}
    out = weights(spark, tokens, max_repetition=2.0)
    t = out["a"]["exponent"]
    z = sum((n / 10_000) ** t for n in tokens.values())
    for src, n in tokens.items():
        assert math.isclose(out[src]["weight"], (n / 10_000) ** t / z, rel_tol=1e-9)
    assert math.isclose(max(out[s]["weight"] * 10_000 / n for s, n in tokens.items()), 2.0, rel_tol=1e-6)


def test_entropy_is_met(spark):
    out = weights(spark, {"a": 9000, "b": 900, "c": 100, "none": 0}, entropy=1.2)
    assert set(out) == {"a", "b", "c"}
    assert math.isclose(-sum(r["weight"] * math.log2(r["weight"]) for r in out.values()), 1.2, rel_tol=1e-6)


def test_one_target(spark):
    with pytest.raises(ValueError):
        weights(spark, {"a": 1})


def test_budgets_and_whole_blocks(spark):
    rows = [(n, "w " * 20, "en", "big") for n in range(1500)] + [(n, "w " * 20, "en", "small") for n in range(1500, 1700)]
    out = mix_sources(documents(spark, rows), ["doc_id", "source"], max_repetition=2.0).collect()
    taken, blocks, weight = Counter(), defaultdict(set), {}
    for r in out:
        taken[r["source"]] += r["tokens"]
        blocks[r["source"], r["block"], r["epoch"]].add(r["doc_id"])
        weight[r["source"]] = r["weight"]
    for src, w in weight.items():
        budget = w * 34_000
        assert budget <= taken[src] <= budget * 1.2
    assert max(Counter(r["doc_id"] for r in out).values()) <= 3
    # A drawn block is whole: every pass that draws it draws all its rows.
    members = defaultdict(set)
    for (src, block, _), ids in blocks.items():
        members[src, block] |= ids
    assert all(ids == members[src, block] for (src, block, _), ids in blocks.items())


def test_awkward_rows(spark):
    docs = awkward(spark)
    out = mix_sources(docs, ["doc_id", "text", "tokens"][:2], max_repetition=1.0).collect()
    # A limit of one pass over every source leaves the natural mixture: every row with its block once.
    assert len(out) == docs.count()


def test_empty_table(spark):
    assert mix_sources(documents(spark, []), ["doc_id"], entropy=1.0).count() == 0
