"""Quality rules: fixed rules on text statistics, then robust multivariate outliers per language and source.

The minimum covariance determinant picks, in every (language, source) group, the ``SUPPORT`` share of rows
whose covariance is tightest: from two starts at the medians, with interquartile ranges alone and with the
correlations of bounded scores, concentration steps alternate between the Mahalanobis distances of all rows
and the mean and covariance of the nearest ones until the determinant no longer falls; the start with the
lesser determinant counts. Small groups are judged by the estimate of their language, or else of all rows.
Rows whose final distance exceeds a chi-square cutoff are rejected. Everything is DataFrame expressions;
every row of a group enters each step, as partial sums and quantile sketches made before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidedesk.llm.common import SPACES, stored

MIN_WORDS = 50
#: Share of a group that the estimate rests on.
SUPPORT = 0.75
#: A group's steps end when the logarithm of its determinant falls by less.
LEAST_FALL = 0.005
#: Groups with fewer rows that pass the fixed rules take the estimate of their language, or else of all rows.
MIN_GROUP_ROWS = 40
#: Relative error of the rank in the quantile sketches is 1 / QUANTILE_ACCURACY.
QUANTILE_ACCURACY = 10_000
# --- Fixed values: chi-square distribution with 4 degrees of freedom ----------------------------------
#: P(chi2_6 <= chi2_4(SUPPORT)) / SUPPORT makes the covariance of the nearest rows consistent.
CHI2_4_SUPPORT = 5.385
CHI2_6_BELOW = 0.5045
#: Quantile at 1 - 1e-6: texts have heavier tails than the normal law behind the quantile.
CUTOFF = 33.4
# --- End of fixed values ------------------------------------------------------------------------------
#: Transformed statistics and the least scale that counts as spread, in their own units.
FEATURES = {
    "word_length": 0.5,  # log of mean code points per word, times 3
    "symbols": 0.4,  # log(1 + symbols per 100 code points)
    "dup_lines": 0.1,  # share of lines equal to an earlier one
    "repeats": 0.1,  # share of words in repeated 3-word windows
}
NAMES = list(FEATURES)
#: Name of the group of all rows; those of languages start with "lang", of languages and sources with "=" or "null".
ALL = "all"
PAIRS = [(i, j) for i in range(len(NAMES)) for j in range(i + 1)]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a ``value`` that is computed once, however often lambdas inside refer to it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    spaced = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.array_remove(F.split(spaced, " "), "")


def _repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more. Windows are compared by 64-bit hash and length."""

    def windows(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")),
        )

    def starts(s: Column) -> Column:
        twice = F.filter(
            s, lambda e, k: F.get(s, k - 1)["h"].eqNullSafe(e["h"]) | F.get(s, k + 1)["h"].eqNullSafe(e["h"])
        )
        return F.sort_array(F.transform(twice, lambda e: e["i"]))

    def covered(positions: Column) -> Column:
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(
            positions,
            start,
            lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")),
            lambda acc: acc["n"],
        )

    some = let(F.sort_array(windows(words)), lambda s: covered(starts(s)))
    return F.when(F.size(words) >= 4, some).otherwise(F.lit(0).cast("long"))


def text_statistics(text: Column) -> Column:
    """A struct of counts over the whole text; NULL counts as empty.

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols`` (characters of ``#*$%&|<>``), ``n_lines``
    (lines with a word), ``n_dup_lines`` (those equal to an earlier line), ``n_repeat_words`` (words in 3-word
    windows found twice or more, first included).
    """
    full = F.coalesce(text, F.lit(""))

    def lines(all_lines: Column) -> Column:
        return F.filter(all_lines, lambda line: F.translate(line, SPACES, "") != "")

    return let(
        words_of(text),
        lambda w: let(
            lines(F.split(full, "\n")),
            lambda with_word: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.char_length(F.translate(full, SPACES, "")).cast("long").alias("word_chars"),
                (F.char_length(full) - F.char_length(F.translate(full, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
                F.size(with_word).cast("long").alias("n_lines"),
                (F.size(with_word) - F.size(F.array_distinct(with_word))).cast("long").alias("n_dup_lines"),
                _repeated_words(w).alias("n_repeat_words"),
            ),
        ),
    )


def _features(stats: DataFrame) -> dict[str, Column]:
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    raw = {
        "word_length": 3 * F.log(chars / words),
        "symbols": F.log(1 + 100 * F.col("n_symbols") / chars),
        "dup_lines": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeats": F.col("n_repeat_words") / words,
    }
    return {name: raw[name] for name in NAMES}


def _squared_distance(rows: DataFrame) -> DataFrame:
    """``d2`` from the columns of the group's estimate: forward substitution with its Cholesky factor."""
    for i, name in enumerate(NAMES):
        rest = F.col(name) - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"y{k}")
        rows = rows.withColumn(f"y{i}", rest / F.col(f"l{i}{i}"))
    return rows.withColumn("d2", sum(F.col(f"y{i}") * F.col(f"y{i}") for i in range(len(NAMES))))


def _factor(estimate: DataFrame) -> DataFrame:
    """Cholesky factor of the covariance ``c{i}{j}``; the least scales keep it positive definite."""
    for j in range(len(NAMES)):
        for i in range(j, len(NAMES)):
            rest = F.col(f"c{i}{j}") - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            estimate = estimate.withColumn(f"l{i}{j}", F.sqrt(rest) if i == j else rest / F.col(f"l{j}{j}"))
    return estimate


#: Groups whose estimates are broadcast at most, some 250 bytes each; those of more are joined by a salted group.
BROADCAST_GROUPS = 50_000
SALTS = 32


def _with_groups(rows: DataFrame, groups: DataFrame, key: str, few: bool, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of their group. A group with most rows is never gathered in one task."""
    if few:
        return rows.join(F.broadcast(groups), key, how)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salted = rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    return salted.join(groups.select("*", salts), [key, "salt"], how).drop("salt")


ESTIMATE = ["grp", "start", *[f"m{i}" for i in range(len(NAMES))], *[f"l{i}{j}" for i, j in PAIRS]]


def _log_determinant() -> Column:
    return sum(2 * F.log(f"l{i}{i}") for i in range(len(NAMES)))


def _starts(rows: DataFrame, few: bool) -> DataFrame:
    """Two estimates of each group at its medians: its interquartile ranges, and these with correlations of bounded scores."""
    quartiles = rows.groupBy("grp").agg(
        *[F.percentile_approx(name, [0.25, 0.5, 0.75], QUANTILE_ACCURACY).alias(f"q{i}") for i, name in enumerate(NAMES)],
    )
    columns = [F.col("grp"), F.lit(0).alias("start")]
    for i in range(len(NAMES)):
        columns.append(F.col(f"q{i}")[1].alias(f"m{i}"))
    for i, j in PAIRS:
        q = F.col(f"q{i}")
        spread = F.greatest((q[2] - q[0]) / 1.349, F.lit(FEATURES[NAMES[i]]))
        columns.append((spread if i == j else F.lit(0.0)).alias(f"l{i}{j}"))
    plain = stored(quartiles.select(columns), "mcd_start")
    score = [F.tanh((F.col(name) - F.col(f"m{i}")) / F.col(f"l{i}{i}")) for i, name in enumerate(NAMES)]
    scores = _with_groups(rows, plain, "grp", few).select("grp", *[z.alias(f"z{i}") for i, z in enumerate(score)])
    related = scores.groupBy("grp").agg(*[F.covar_pop(f"z{i}", f"z{j}").alias(f"v{i}{j}") for i, j in PAIRS])
    both = plain.join(related, "grp")
    # Below 1, so that the factor exists; undefined where a score is constant.
    covariance = []
    for i, j in PAIRS:
        spread = F.sqrt(F.greatest(F.col(f"v{i}{i}"), F.lit(0.0)) * F.greatest(F.col(f"v{j}{j}"), F.lit(0.0)))
        r = F.when(spread > 0, F.col(f"v{i}{j}") / F.nullif(spread, F.lit(0.0))).otherwise(0.0) * 0.95 if i != j else F.lit(1.0)
        covariance.append((F.col(f"l{i}{i}") * F.col(f"l{j}{j}") * r).alias(f"c{i}{j}"))
    related = _factor(both.select("grp", F.lit(1).alias("start"), *[f"m{i}" for i in range(len(NAMES))], *covariance))
    return plain.select(ESTIMATE).union(related.select(ESTIMATE))


def _concentrate(rows: DataFrame, estimate: DataFrame, few: bool) -> DataFrame:
    """Mean and covariance of the ``SUPPORT`` share of each group nearest to ``estimate``, for each start."""
    near = stored(
        _squared_distance(_with_groups(rows, estimate, "grp", few))
        .groupBy("grp", "start")
        .agg(F.percentile_approx("d2", SUPPORT, QUANTILE_ACCURACY).alias("reach")),
        "mcd_reach",
    )
    inside = _squared_distance(_with_groups(rows, estimate.join(near, ["grp", "start"]), "grp", few)).where("d2 <= reach")
    # Sums are of deviations from the present centre, so nothing cancels.
    delta = {i: F.col(name) - F.col(f"m{i}") for i, name in enumerate(NAMES)}
    sums = inside.groupBy("grp", "start").agg(
        *[F.avg(delta[i]).alias(f"d{i}") for i in delta],
        *[F.first(f"m{i}").alias(f"m{i}") for i in delta],
        *[F.avg(delta[i] * delta[j]).alias(f"s{i}{j}") for i, j in PAIRS],
    )
    scale = SUPPORT / CHI2_6_BELOW
    covariance = [
        (
            (F.col(f"s{i}{j}") - F.col(f"d{i}") * F.col(f"d{j}")) * scale
            + F.lit(FEATURES[NAMES[i]] ** 2 if i == j else 0.0)
        ).alias(f"c{i}{j}")
        for i, j in PAIRS
    ]
    moved = sums.select("grp", "start", *[(F.col(f"m{i}") + F.col(f"d{i}")).alias(f"m{i}") for i in delta], *covariance)
    return _factor(moved).select(ESTIMATE)


def _least_determinant(rows: DataFrame, few: bool) -> DataFrame:
    """The estimate of each group where concentration steps from every start have ended."""
    moving = stored(_concentrate(rows, stored(_starts(rows, few), "mcd"), few), "mcd")
    ended = []
    # The covariance has a least scale and each round but the last falls by a least amount, so the rounds end.
    while not moving.isEmpty():
        before = moving.select("grp", "start", _log_determinant().alias("before"))
        moved = _concentrate(rows, moving, few).withColumn("after", _log_determinant()).join(before, ["grp", "start"])
        moved = stored(moved.withColumn("falls", F.col("before") - F.col("after") >= LEAST_FALL), "mcd")
        last = moving.join(moved.where("not falls").select("grp", "start"), ["grp", "start"])
        ended.append(last.select(ESTIMATE))
        moving = moved.where("falls").select(ESTIMATE)
    if not ended:
        return moving.drop("start")
    found = reduce(DataFrame.unionByName, ended).withColumn("order", F.struct(_log_determinant().alias("d"), "start"))
    best = found.groupBy("grp").agg(F.min_by(F.struct(ESTIMATE[2:]), "order").alias("e"))
    return stored(best.select("grp", "e.*"), "mcd_best")


def _judges(fit: DataFrame) -> DataFrame:
    """For each ``grp`` the group whose estimate judges it (``judge``) and those whose estimates its rows enter (``fits``)."""
    sizes = stored(fit.groupBy("grp", "tongue").agg(F.count("*").alias("n")), "group_sizes")
    tongues = sizes.groupBy("tongue").agg(
        F.sum("n").alias("of_tongue"), F.bool_or(F.col("n") < MIN_GROUP_ROWS).alias("some_small")
    )
    tongues = stored(tongues, "language_sizes")
    use_all = bool(tongues.agg(F.bool_or(F.col("of_tongue") < MIN_GROUP_ROWS).alias("x")).first()["x"])
    large, known = F.col("n") >= MIN_GROUP_ROWS, F.col("of_tongue") >= MIN_GROUP_ROWS
    entered = [F.when(large, F.col("grp")), F.when(known & F.col("some_small"), F.col("tongue")), F.when(F.lit(use_all), F.lit(ALL))]
    judge = F.when(large, F.col("grp")).when(known, F.col("tongue")).otherwise(F.lit(ALL))
    judges = sizes.join(tongues, "tongue").select("grp", judge.alias("judge"), F.array_compact(F.array(*entered)).alias("fits"))
    return stored(judges, "judges")


def quality_rules(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The ``keep`` columns of every row of ``docs``, its statistics, ``base_failed``, ``distance`` and ``kept``.

    A row fails the fixed rules with fewer than 50 words or with more than half of its words in repeated
    3-word windows. Of the others, ``distance`` is the squared Mahalanobis distance from the estimate of
    its (``lang``, ``source``) group, of its language where that group is small, of all rows where the language
    is, and rows beyond ``CUTOFF`` are not kept; a row that fails has none. NULL text is empty text; NULL ``lang`` or ``source`` is a group like any
    other. Repeated rows count each time. Columns of ``docs`` outside ``keep`` are ignored, whatever
    their names; an empty table gives an empty result.
    """
    named = {c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("null")) for c in ("lang", "source")}
    stats = docs.select(
        F.struct(*[F.col(c) for c in keep]).alias("row"),
        F.concat_ws("|", *named.values()).alias("grp"),
        F.concat(F.lit("lang"), named["lang"]).alias("tongue"),
        text_statistics(F.col("text")).alias("s"),
    ).select("row", "grp", "tongue", "s.*")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = stored(stats.withColumns({**_features(stats), "base_failed": failed}), "statistics")
    fit = rows.where("not base_failed").select("grp", "tongue", *NAMES)
    judges = _judges(fit)
    few = judges.count() <= BROADCAST_GROUPS
    entered = _with_groups(fit, judges.select("grp", "fits"), "grp", few).select(F.explode("fits").alias("grp"), *NAMES)
    estimate = _least_determinant(stored(entered, "fit"), few).withColumnRenamed("grp", "judge")
    known = judges.select("grp", "judge").join(estimate, "judge", "left").drop("judge")
    judged = _squared_distance(_with_groups(rows, known, "grp", few, "left"))
    return judged.select(
        "row.*",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        F.when(~F.col("base_failed"), F.col("d2")).alias("distance"),
        (~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= CUTOFF)).alias("kept"),
    )
