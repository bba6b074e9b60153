import random

import corpus_pipeline
from tests.llm.samples import documents, words
from tidedesk.llm.minhash import SIMILARITY, shingles, similarity


def changed(text, seed, n):
    """The text with ``n`` words replaced, far from each other."""
    w, draw = text.split(), random.Random(seed)
    for k in range(n):
        w[draw.randrange(3) + k * (len(w) // n) + 5] = f"new{seed}x{k}"
    return " ".join(w)


def brute_similarity(a, b):
    s, t = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a.lower().split(), b.lower().split()))
    return len(s & t) / len(s | t)


def test_similarity_is_of_five_word_shingles():
    text = words(1, 200)
    for n in (0, 1, 2, 4, 9):
        other = changed(text, n, n) if n else text.upper()
        assert similarity(shingles(text.encode()), shingles(other.encode())) == brute_similarity(text, other)
    assert len(shingles(None)) == 0 and len(shingles(b"two words")) == 1


def test_near_copies_of_0_8_to_0_95_go(spark):
    rows, gone = [], set()
    for n in range(40):
        text = words(n, 300)
        rows.append((n, text))
        # One to six far words of 300 leave 0.81 to 0.97.
        rows.append((1000 + n, changed(text, n, 1 + n % 6)))
        rows.append((2000 + n, changed(text, 100 + n, 12)))
        if brute_similarity(text, rows[-2][1]) >= SIMILARITY:
            gone.add(1000 + n)
    assert len(gone) == 40 and all(brute_similarity(words(n, 300), rows[3 * n + 2][1]) < SIMILARITY for n in range(40))
    kept = [r["doc_id"] for r in corpus_pipeline.keep_one_of_each_group(spark, documents(spark, rows), "").collect()]
    assert sorted(kept) == sorted({n for n, _ in rows} - gone)


def test_chain_and_repeated_id(spark):
    # Each text is similar to the next one only; two clean texts share the id 7.
    chain = [words(5, 300)]
    for k in range(6):
        w = chain[-1].split()
        w[k * 40 : k * 40 + 25] = [f"c{k}w{i}" for i in range(25)]
        chain.append(" ".join(w))
    assert brute_similarity(chain[0], chain[1]) >= SIMILARITY > brute_similarity(chain[0], chain[3])
    rows = [(100 + k, t) for k, t in enumerate(chain)] + [(7, words(8, 100)), (7, words(9, 100))]
    kept = [r["doc_id"] for r in corpus_pipeline.keep_one_of_each_group(spark, documents(spark, rows), "").collect()]
    assert sorted(kept) == [7, 7, 100]
