from pyspark.sql import functions as F

from tests.llm.samples import awkward, documents, words
from tidedesk.llm import decontaminate
from tidedesk.llm.decontaminate import SPAN, SUBSTITUTIONS, WINDOW, overlaps


def found(docs, items):
    return overlaps(docs, items, {"doc_id": F.col("doc_id")})


def benchmark(spark, items):
    return spark.createDataFrame([(n, t, "x", "x") for n, t in items], "item_id long, text string, words string, at string")


def brute(docs, items):
    """Windows of aligned words with few substitutions that hold a span equal under one mask."""
    best = {}
    masks = [[k for k, bit in enumerate(m) if bit == "1"] for m in decontaminate.MASKS]
    for doc, text in docs:
        d = [w.strip(".,") for w in (text or "").lower().split()]
        for item, other in items:
            b = [w.strip(".,") for w in (other or "").lower().split()]
            window = min(WINDOW, len(b))
            for i in range(len(d) - SPAN + 1):
                for j in range(len(b) - SPAN + 1):
                    if any(all(d[i + k] == b[j + k] for k in m) for m in masks):
                        for s in range(max(0, j - window + SPAN), min(j, len(b) - window) + 1):
                            same = sum(0 <= i - j + s + k < len(d) and d[i - j + s + k] == b[s + k] for k in range(window))
                            if same >= window - SUBSTITUTIONS * window // WINDOW:
                                best[doc, item] = max(same, best.get((doc, item), 0))
    return best


def test_equals_brute_force(spark):
    items = [(1, words(1, 30)), (2, words(2, 12)), (3, words(1, 30)), (4, words(4, 5)), (5, None), (6, words(6, 9))]
    base, short = words(1, 30).split(), words(2, 12).split()
    near, far = list(base), list(base)
    near[4] = near[17] = "other"
    for k in range(0, 30, 4):
        far[k] = "other"
    docs = [
        (1, f"{words(11, 40)} {' '.join(base)} {words(12, 300)}"),
        (2, " ".join(near).upper() + "."),
        (3, " ".join(far)),
        (4, words(13, 100)),
        (5, " ".join(short[:-1] + ["x"])),
        (6, " ".join(base[8:21])),
        (7, words(4, 5)),
        (8, " ".join(base[:12])),
        (9, f"{words(14, 70)} {words(6, 9)}"),
    ]
    got = {(r["doc_id"], r["item_id"]): r["matched_words"] for r in found(documents(spark, docs), benchmark(spark, items)).collect()}
    assert got == brute(docs, items)
    assert {(1, 1), (1, 3), (2, 1), (5, 2), (6, 1), (9, 6)} <= set(got) and not {3, 4, 7} & {d for d, _ in got}


def test_benchmark_in_blocks(spark, monkeypatch):
    items = [(n, words(n, 20)) for n in range(12)]
    docs = documents(spark, [(n, words(n, 20)) for n in range(12)])
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 200_000)
    got = {(r["doc_id"], r["item_id"]) for r in found(docs, benchmark(spark, items)).collect()}
    assert got == {(n, n) for n in range(12)}


def test_awkward_rows_and_empty_tables(spark):
    docs, items = awkward(spark), benchmark(spark, [(1, words(1, 80)), (2, words(99, 20_000)), (None, "")])
    got = {(r["doc_id"], r["item_id"]) for r in found(docs, items).collect()}
    assert got == {(1, 1), (2, 1), (8, 2), (9, 2)}
    assert found(docs, benchmark(spark, [])).count() == 0
    assert found(documents(spark, []), items).count() == 0
