"""Determinants and verdicts against a minimum covariance determinant found apart from the library, from many random starts."""

import math
import random

import numpy as np

from tests.llm.samples import documents
from tests.llm.test_quality import brute
from tidedesk.llm.quality import CUTOFF, FEATURES, LEAST_FALL, SUPPORT, quality_rules

LEAST = np.array(list(FEATURES.values()))


def text_of(seed, far):
    """Words whose length, symbols and repeats vary together; ``far`` texts break that pattern."""
    draw = random.Random(seed)
    level = draw.random()
    length = 4 + 3 * level + draw.random()
    if far:
        length, level = draw.choice([(2 + draw.random(), 6), (25 + draw.random(), 0), (7, 9)])
    lines = []
    for _ in range(draw.randrange(8, 14)):
        row = ["".join(draw.choices("abcdefghij", k=max(1, round(draw.gauss(length, 1))))) for _ in range(12)]
        lines.append(" ".join(w + "#" * (draw.random() < 0.05 * level) * (8 if far else 1) for w in row))
        if draw.random() < 0.06:
            lines.append(lines[0])
    return "\n".join(lines)


def features(text):
    n_words, chars, symbols, dup_lines, repeats = brute(text)
    lines = [x for x in text.split("\n") if x.strip()]
    return 3 * math.log(chars / n_words), math.log(1 + 100 * symbols / chars), dup_lines / len(lines), repeats / n_words


def estimate(x, inside):
    """Mean and covariance of some rows, scaled to be consistent for normal ones, with the least scales."""
    half = next(q / 1000 for q in range(10_000) if 1 - math.exp(-q / 2000) * (1 + q / 2000) >= SUPPORT) / 2
    below = 1 - math.exp(-half) * (1 + half + half * half / 2)  # six degrees of freedom
    return x[inside].mean(0), np.cov(x[inside].T, bias=True) * SUPPORT / below + np.diag(LEAST**2)


def distances(x, mean, cov):
    return np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)


def least_determinant(x, starts, seed):
    draw, n, best = np.random.default_rng(seed), math.ceil(SUPPORT * len(x)), None
    for _ in range(starts):
        mean, cov = estimate(x, draw.choice(len(x), 6, replace=False))
        last = math.inf
        while True:
            inside = np.argsort(distances(x, mean, cov))[:n]
            mean, cov = estimate(x, inside)
            now = np.linalg.slogdet(cov)[1]
            if now >= last - 1e-12:
                break
            last = now
        if best is None or now < best[0]:
            best = now, mean, cov
    return best[1:]


def covariance_behind(x, d2):
    """Mean and covariance whose squared distances are ``d2``: a quadratic form through all rows."""
    i, j = np.triu_indices(x.shape[1])
    terms = np.column_stack((x[:, i] * x[:, j], x, np.ones(len(x))))
    found, *_ = np.linalg.lstsq(terms, d2, rcond=None)
    assert np.allclose(terms @ found, d2, rtol=1e-6, atol=1e-6)
    inverse = np.zeros((x.shape[1],) * 2)
    inverse[i, j] += found[: len(i)] / 2
    inverse[j, i] += found[: len(i)] / 2
    cov = np.linalg.inv(inverse)
    return cov @ found[len(i) : -1] / -2, cov


def test_estimates_are_near_the_least_determinant(spark):
    """The steps from two starts end at a fixed point, whose determinant random starts hardly undercut; verdicts agree."""
    rows = []
    for group, (size, far) in enumerate([(160, 0), (200, 20), (240, 45)]):
        rows += [(1000 * group + n, text_of(1000 * group + n, n < far), "en", f"s{group}") for n in range(size)]
    out = {r["doc_id"]: r for r in quality_rules(documents(spark, rows), ["doc_id"]).collect()}
    assert not any(r["base_failed"] for r in out.values())
    for group in range(3):
        own = [(i, t) for i, t, _, source in rows if source == f"s{group}"]
        x = np.array([features(t) for _, t in own])
        d2 = np.array([out[i]["distance"] for i, _ in own])
        mean, cov = covariance_behind(x, d2)
        again = estimate(x, np.argsort(d2)[: math.ceil(SUPPORT * len(x))])
        best = least_determinant(x, 300, group)
        found, step, least = (np.linalg.slogdet(c)[1] for c in (cov, again[1], best[1]))
        assert found - step < LEAST_FALL
        assert found - least < 4 * LEAST_FALL
        kept = distances(x, *best) <= CUTOFF
        assert [out[i]["kept"] for i, _ in own] == kept.tolist()
        assert (~kept).sum() == (0, 20, 45)[group]
