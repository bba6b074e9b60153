"""Small inputs with the awkward cases: NULLs, empty and long texts, repeated rows, further columns with clashing names."""

import random

#: Columns that no operator asks for, named like ones that operators use inside.
CLASHES = "row string, grp string, fp string, tokens string, label string, block string, seed string, shard string, kept string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}"


def documents(spark, rows):
    """A table of (doc_id, text), or (doc_id, text, lang, source)."""
    full = []
    for row in rows:
        doc_id, text, lang, source = (*row, "en", "s1")[:4] if len(row) == 2 else row
        full.append((doc_id, text, lang, source, len(text or ""), *["x"] * 9))
    return spark.createDataFrame(full, SCHEMA)


def words(seed, n, vocabulary=5000):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(n))


def awkward(spark):
    """NULL ids, texts, languages and sources; empty and blank texts; repeated rows; one long text."""
    long_text = words(99, 20_000)
    return documents(
        spark,
        [
            (1, words(1, 80)),
            (1, words(1, 80)),
            (2, words(1, 80)),
            (3, None),
            (4, ""),
            (5, " \n\t "),
            (None, words(2, 60)),
            (None, None),
            (6, words(3, 60), None, None),
            (7, "Äö ñ é " * 30, "de", None),
            (8, long_text),
            (9, long_text),
        ],
    )
