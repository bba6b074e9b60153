"""Mixing sources to target weights: temperature, then budgeted block permutations.

Source ``i`` with token share ``s_i`` gets the weight ``s_i ** t / sum_j s_j ** t``. Bisection finds the exponent
``t`` in [0, 1]: the flattest mixture whose most repeated source stays within a repetition limit, or the one
whose entropy is the target. The token budget is dealt to the sources by these weights. Each source is cut
into blocks by a hash of its rows; in every pass over the source the blocks are permuted anew by a hash, and
whole blocks are taken in that order until the source's budget is spent. Everything is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidedesk.llm.common import stored
from tidedesk.llm.quality import let, words_of

BLOCK_TOKENS = 20_000
#: Blocks of a source at least, so that a budget is met within a small part of a small source.
LEAST_BLOCKS = 64
BISECTIONS = 50
#: Block totals are summed up inside hash ranges of a source and then over the ranges, so no task holds a source.
RANGES = 256


def _weights(shares: Column, exponent: Column) -> Column:
    powers = F.transform(shares, lambda s: F.pow(s, exponent))
    return let(powers, lambda p: let(_total(p), lambda z: F.transform(p, lambda x: x / z)))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def _entropy(weights: Column) -> Column:
    """In bits."""
    return -_total(F.transform(weights, lambda w: F.when(w > 0, w * F.log2(w)).otherwise(0.0)))


def _repetition(shares: Column, weights: Column, budget_ratio: float) -> Column:
    """Passes over the source that is repeated most."""
    return F.array_max(F.zip_with(shares, weights, lambda s, w: budget_ratio * w / s))


def _bisect(shares: Column, too_flat) -> Column:
    """The least exponent in [0, 1] that is not too flat; 1 where none is."""
    start = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"))

    def halve(acc, _):
        mid = (acc["lo"] + acc["hi"]) / 2
        flat = too_flat(_weights(shares, mid))
        return F.struct(F.when(flat, mid).otherwise(acc["lo"]).alias("lo"), F.when(flat, acc["hi"]).otherwise(mid).alias("hi"))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(BISECTIONS)), start, halve, lambda acc: acc["hi"])
    return F.when(~too_flat(_weights(shares, F.lit(0.0))), F.lit(0.0)).otherwise(found)


def source_weights(
    tokens: DataFrame, budget_ratio: float = 1.0, max_repetition: float | None = None, entropy: float | None = None
) -> DataFrame:
    """``src``, ``tokens``, ``share``, ``exponent``, ``weight`` and ``budget`` from ``src`` and ``tokens`` per source.

    Exactly one target is given: ``max_repetition`` passes over any source, or ``entropy`` of the weights in bits.
    The budget is ``budget_ratio`` times all tokens. Sources without tokens have no weight and no row. One row
    holds the shares of all sources; their number is that of the corpora that are mixed, not of documents.
    """
    if (max_repetition is None) == (entropy is None):
        raise ValueError("give max_repetition or entropy")

    def too_flat(shares: Column):
        if entropy is not None:
            return lambda w: _entropy(w) > entropy
        return lambda w: _repetition(shares, w, budget_ratio) > max_repetition

    listed = (
        tokens.where("tokens > 0")
        .groupBy()
        .agg(F.sort_array(F.collect_list(F.struct("src", "tokens"))).alias("all"), F.sum("tokens").alias("total"))
        .where("total > 0")
        .select("all", "total", F.transform("all", lambda s: s["tokens"] / F.col("total")).alias("shares"))
    )
    solved = listed.select("*", _bisect(F.col("shares"), too_flat(F.col("shares"))).alias("exponent")).select(
        "*", _weights(F.col("shares"), F.col("exponent")).alias("weights")
    )
    each = F.explode(F.arrays_zip(F.col("all"), F.col("shares"), F.col("weights"))).alias("s")
    return solved.select("total", "exponent", each).select(
        F.col("s.all.src").alias("src"),
        F.col("s.all.tokens").alias("tokens"),
        F.col("s.shares").alias("share"),
        "exponent",
        F.col("s.weights").alias("weight"),
        F.round(F.col("s.weights") * F.col("total") * F.lit(budget_ratio)).cast("long").alias("budget"),
    )


def _place(*key: str | Column) -> Column:
    return F.substring(F.md5(F.concat_ws(":", *key)), 1, 16)


def mix_sources(
    docs: DataFrame,
    keep: list[str],
    budget_ratio: float = 1.0,
    max_repetition: float | None = None,
    entropy: float | None = None,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """The mixture: the ``keep`` columns of every drawn row, once for each ``epoch`` (pass over its source) that draws it.

    ``tokens`` (words of the whole text), ``weight`` and ``exponent`` of its source and its ``block`` come
    with it. A source gets whole blocks until its budget is reached, so it exceeds the budget by less
    than its largest block. NULL sources are one source; NULL or empty texts have no tokens and come with
    their block; sources without any token are not drawn. Repeated rows are rows of their own. Other
    columns of ``docs`` are ignored; an empty table gives an empty result.
    """
    src = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))
    rows = stored(
        docs.select(
            F.struct(*[F.col(c) for c in keep]).alias("row"),
            F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("key"),
            src.alias("src"),
            F.size(words_of(F.col("text"))).cast("long").alias("tokens"),
        ),
        "tokens",
    )
    totals = rows.groupBy("src").agg(F.sum("tokens").alias("tokens"))
    weights = stored(source_weights(totals, budget_ratio, max_repetition, entropy), "weights")
    # Weights have one row per source; the join's small side is broadcast if its file is below the session's limit.
    cut = rows.join(weights.withColumnRenamed("tokens", "source_tokens"), "src").withColumn(
        "blocks", F.greatest(F.lit(LEAST_BLOCKS), F.ceil(F.col("source_tokens") / block_tokens))
    )
    block = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit("block"), "src", "key")), 1, 12), 16, 10).cast("long")
    cut = cut.withColumn("block", block % F.col("blocks"))
    sizes = stored(
        cut.groupBy("src", "block").agg(F.sum("tokens").alias("block_tokens"), F.first("budget").alias("budget"),
                                        F.first("source_tokens").alias("source_tokens")),
        "blocks",
    )
    # Full passes come first; the last pass takes a prefix of its permutation.
    full = F.floor(F.col("budget") / F.col("source_tokens"))
    place = _place(F.lit("epoch"), "src", F.col("full").cast("string"), F.col("block").cast("string"))
    last = (
        sizes.withColumn("full", full)
        .withColumn("rest", F.col("budget") - F.col("full") * F.col("source_tokens"))
        .withColumn("place", place)
        .withColumn("range", F.substring("place", 1, 2))
    )
    inner = Window.partitionBy("src", "range").orderBy("place", "block").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("src").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # At most RANGES rows for each source.
    ranges = last.groupBy("src", "range").agg(F.sum("block_tokens").alias("n")).select(
        "src", "range", F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("before_range")
    )
    drawn = (
        last.withColumn("before", F.coalesce(F.sum("block_tokens").over(inner), F.lit(0)))
        .join(ranges, ["src", "range"])
        .select(
            "src",
            "block",
            (F.col("full") + F.when(F.col("before") + F.col("before_range") < F.col("rest"), 1).otherwise(0)).alias("passes"),
        )
        .where("passes > 0")
    )
    drawn = stored(drawn, "draws")
    return (
        cut.join(drawn, ["src", "block"])
        .withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.col("passes"))))
        .select("row.*", "tokens", "block", "epoch", "weight", "exponent")
    )
