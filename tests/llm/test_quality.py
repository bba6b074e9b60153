import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tests.llm.samples import awkward, documents, words
from tidedesk.llm.quality import quality_rules, text_statistics


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = list(zip(w, w[1:], w[2:]))
    often = {g for g, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, g in enumerate(windows) if g in often for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_statistics_equal_brute_force(spark):
    draw = random.Random(5)
    texts = [None, "", " ", "a", "a b c", "a b c a b c", "x x x x x", "a\nb\na\n\n \n", "l 1\r\nl 1\r\n", "ñ é é\x0bf\x0cg\th #*$%&|<>"]
    texts += ["".join(draw.choice("ab é\n\t|#") for _ in range(draw.randrange(200))) for _ in range(150)]
    texts.append(words(7, 20_000, 300))
    docs = documents(spark, list(enumerate(texts)))
    got = docs.select("doc_id", text_statistics(F.col("text")).alias("s")).collect()
    for r in got:
        s = r["s"]
        assert (s["n_words"], s["word_chars"], s["n_symbols"], s["n_dup_lines"], s["n_repeat_words"]) == brute(texts[r["doc_id"]])


def test_outliers_go_and_others_stay(spark):
    rows = [(n, words(n, 60 + n % 50), "en", "hot" if n % 3 else "s2") for n in range(300)]
    junk = [(1000 + n, " ".join(f"{w}###$$$" for w in words(n, 80).split()), "en", "hot") for n in range(10)]
    short = [(2000, words(1, 49), "en", "hot"), (2001, "one two three " * 40, "en", "hot")]
    out = {r["doc_id"]: r for r in quality_rules(documents(spark, rows + junk + short), ["doc_id"]).collect()}
    assert all(out[n]["kept"] for n in range(300))
    assert not any(out[1000 + n]["kept"] or out[1000 + n]["base_failed"] for n in range(10))
    assert out[2000]["base_failed"] and out[2001]["base_failed"] and not out[2000]["kept"]


def test_awkward_rows(spark):
    docs = awkward(spark)
    out = quality_rules(docs, ["doc_id", "text", "row"]).collect()
    assert len(out) == docs.count()
    for r in out:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute(r["text"])
        assert r["kept"] == (not r["base_failed"])  # judged by the estimate of all rows, and near it


def test_empty_table(spark):
    assert quality_rules(documents(spark, []), ["doc_id"]).count() == 0
