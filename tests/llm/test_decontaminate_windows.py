"""Every window within the tolerance is found: brute force over windows, without masks."""

from itertools import combinations

from pyspark.sql import functions as F

from tests.llm.samples import documents, words
from tidedesk.llm.decontaminate import SUBSTITUTIONS, WINDOW, overlaps


def brute(docs, items):
    best = {}
    for doc, text in docs:
        d = text.split()
        for item, other in items:
            b = other.split()
            window = min(WINDOW, len(b))
            for s in range(len(b) - window + 1):
                for i in range(1 - window, len(d)):
                    same = sum(0 <= i + k < len(d) and d[i + k] == b[s + k] for k in range(window))
                    if same >= window - SUBSTITUTIONS * window // WINDOW:
                        best[doc, item] = max(same, best.get((doc, item), 0))
    return best


def test_every_pattern_of_every_length(spark):
    items, docs = [], []
    for n in [*range(1, 16), 17]:
        text = words(n, n, 100_000).split()
        items.append((n, " ".join(text)))
        for k in range(4):
            for at in combinations(range(n), k):
                if k < 3 or at[0] % 5 == 0 and at[2] % 4 == 0:
                    inside = " ".join("other" if i in at else w for i, w in enumerate(text))
                    docs.append((len(docs), f"before {inside} after"))
                    if n in (7, 9, 13):
                        docs.append((len(docs), inside))
    found = overlaps(
        documents(spark, docs).repartition(8),
        spark.createDataFrame(items, "item_id long, text string"),
        {"doc_id": F.col("doc_id")},
        short_items=True,
    )
    got = {(r["doc_id"], r["item_id"]): r["matched_words"] for r in found.collect()}
    assert got == brute(docs, items)
    assert {item for _, item in got} == {n for n, _ in items}
