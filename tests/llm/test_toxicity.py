import random
import zlib

import numpy as np

from tests.llm.samples import awkward, documents, words
from tidedesk.llm import toxicity as T
from tidedesk.llm.toxicity import toxicity

SF_DIR = "/root/testdata/sf0.01"


def test_pairs_are_learned_where_single_terms_tell_nothing():
    """Label 1 is one of two words without the other, which no additive weights separate."""
    draw = random.Random(1)
    rows, labels = [], []
    for _ in range(3000):
        a, b = draw.random() < 0.5, draw.random() < 0.5
        rows.append(T.terms(" ".join(["insult"] * a + ["group"] * b + draw.choices(["x", "y", "z"], k=2)).encode()))
        labels.append(a and b)
    labels = np.array(labels, np.float32)
    model = T.train_calibrated(rows[:2000], labels[:2000])
    assert ((model.scores(rows[2000:]) >= 0.5) == labels[2000:]).mean() > 0.97


def labelled(spark, n):
    draw = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        w = words(i, draw.randrange(5, 80), 400).split()
        bad = i % 6 == 0
        for _ in range(draw.randrange(1, 4) if bad else 0):
            w.insert(draw.randrange(len(w)), draw.choice(("idiota", "moron")))
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    rows, labels = labelled(spark, 1500)
    out = toxicity(documents(spark, rows), labels).collect()
    assert len(out) == 1500
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    held = [r for r in out if r["held_out"]]
    assert sum(r["predicted"] == (r["doc_id"] % 6 == 0) for r in held) / len(held) > 0.95


def test_scores_depend_on_the_text_alone(spark):
    rows, labels = labelled(spark, 200)
    docs = documents(spark, rows).unionByName(awkward(spark))
    by_text = {}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in toxicity(docs, labels).collect():
        if r["doc_id"] is not None and r["doc_id"] > 9:
            by_text.setdefault(texts[r["doc_id"]], set()).add(r["score"])
    assert all(len(s) == 1 for s in by_text.values())


def test_awkward_rows_and_empty_tables(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(1, 1, None), (2, 1, 7), (None, 1, 1)], "doc_id long, quality int, toxic int")
    out = toxicity(docs, labels).collect()
    assert len(out) == docs.count() and {r["score"] for r in out} == {0.5}
    assert all(r["held_out"] for r in out if r["doc_id"] is None)
    assert toxicity(documents(spark, []), labels).count() == 0
    assert toxicity(docs, labels.limit(0)).count() == docs.count()
