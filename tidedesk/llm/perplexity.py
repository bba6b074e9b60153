"""Quality by perplexity under an interpolated modified Kneser-Ney model of UTF-8 bytes.

Map tasks count the n-grams of trusted texts and note those of all texts; the counts are summed by n-gram. Lower orders
count how many distinct symbols stand before an n-gram. Discounts, context totals and interpolation are joins of count
tables, dealt out by n-gram or context, so nothing grows with the number of documents but the first sum. The
finished log-probabilities go to the scoring tasks in parts of bounded size. A text is kept if its perplexity is within a
quantile of that of trusted texts in its language.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidedesk.llm.common import stored

ORDER = 5
SYMBOLS = 256
#: Bytes of text that a map task gathers before it sends counts.
COUNT_BYTES = 8 * 1024 * 1024
#: Bytes of text that are scored together.
SCORE_BYTES = 1 << 20
#: N-grams of the model that are broadcast at a time, 16 bytes each; a larger model goes in several parts.
PART_GRAMS = 3_000_000
#: Trusted ids that are broadcast, 8 bytes each; more are joined by shuffling.
BROADCAST_IDS = 2_000_000
#: Quantile of the perplexity of trusted texts that are not in the counts, in each language, up to which texts are kept.
QUANTILE = 0.975
#: One of so many trusted texts, by a hash of its id, is left out of the counts and sets the limits.
HELD_OUT = 5
QUANTILE_ACCURACY = 10_000


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each byte of the texts, as a number, and where each text ends. Zeros precede a text."""
    pad = b"\0" * (ORDER - 1)
    data = np.frombuffer(b"".join(x for t in texts for x in (pad, t)), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    out = np.zeros(max(0, len(data) - ORDER + 1), np.int64)
    for k in range(ORDER):
        out |= data[k : k + len(out)].astype(np.int64) << (8 * (ORDER - 1 - k))
    # N-grams that end in the padding of a later text are left out.
    owner = np.zeros(len(data), bool)
    begins = np.cumsum(sizes + ORDER - 1) - sizes
    marks = np.zeros(len(data) + 1, np.int64)
    np.add.at(marks, begins, 1)
    np.add.at(marks, begins + sizes, -1)
    owner = np.cumsum(marks[:-1])[ORDER - 1 :] > 0
    return out[owner], np.cumsum(sizes)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct n-grams of some texts, with their counts in the trusted ones."""

    def counted(held: dict[bool, list[bytes]]) -> pa.RecordBatch:
        trusted, n = np.unique(grams(held[True])[0], return_counts=True)
        other = np.setdiff1d(np.unique(grams(held[False])[0]), trusted, assume_unique=True)
        counts = np.concatenate((n, np.zeros(len(other), np.int64)))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate((trusted, other))), pa.array(counts)], names=["gram", "n"])

    held: dict[bool, list[bytes]] = {True: [], False: []}
    size = 0
    for batch in batches:
        for text, trusted in zip(batch.column(0), batch.column(1)):
            text = text.as_py()
            held[trusted.as_py()].append(text)
            size += len(text)
            if size >= COUNT_BYTES:
                yield counted(held)
                held, size = {True: [], False: []}, 0
    if size:
        yield counted(held)


def _suffix(gram: str, order: int) -> Column:
    """The last ``order`` symbols of an n-gram."""
    return F.col(gram).bitwiseAND(F.lit((1 << (8 * order)) - 1))


def discounts(counts: DataFrame) -> DataFrame:
    """One row with the modified Kneser-Ney discounts ``d1``, ``d2``, ``d3`` of a table of ``n``; 0.5, 1 and 1.5 where counts
    of counts are too few to tell."""
    of = counts.agg(*[F.sum((F.col("n") == k).cast("long")).alias(f"n{k}") for k in (1, 2, 3, 4)])
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    solved = [k - (k + 1) * y * F.col(f"n{k + 1}") / F.nullif(F.col(f"n{k}"), F.lit(0)) for k in (1, 2, 3)]
    return of.select(
        *[
            F.when((d > 0) & (d <= k), d).otherwise(0.5 * k).alias(f"d{k}")
            for k, d in zip((1, 2, 3), [F.when((F.col("n1") > 0) & (F.col("n2") > 0), s) for s in solved])
        ]
    )


def log_probabilities(counts: DataFrame) -> DataFrame:
    """``gram`` and ``logp``, natural log, for every n-gram of ``counts`` (``gram``, ``n``; 0 for those of no trusted text)."""
    wanted = {ORDER: counts.select("gram")}
    count = {ORDER: counts.where("n > 0")}
    for order in range(ORDER - 1, 0, -1):
        wanted[order] = stored(wanted[order + 1].select(_suffix("gram", order).alias("gram")).distinct(), "wanted")
        count[order] = stored(
            count[order + 1].groupBy(_suffix("gram", order).alias("gram")).agg(F.count("*").alias("n")), "continuations"
        )
    lower = None
    for order in range(1, ORDER + 1):
        # One row; every use of it is a bounded broadcast.
        d1, d2, d3 = (F.lit(x) for x in discounts(count[order]).first())
        rows = count[order].withColumn("context", F.shiftright("gram", 8))
        context = rows.groupBy("context").agg(
            F.sum("n").alias("total"),
            *[F.sum((test).cast("long")).alias(c) for c, test in
              (("one", F.col("n") == 1), ("two", F.col("n") == 2), ("more", F.col("n") >= 3))],
        )
        rest = (d1 * F.col("one") + d2 * F.col("two") + d3 * F.col("more")) / F.col("total")
        context = stored(context.select("context", "total", rest.alias("rest")), "contexts")
        found = wanted[order].withColumn("context", F.shiftright("gram", 8))
        found = found.join(count[order].select("gram", "n"), "gram", "left").join(context, "context", "left")
        n = F.col("n")
        cut = F.when(n == 1, d1).when(n == 2, d2).otherwise(d3)
        own = F.coalesce(F.greatest(n - cut, F.lit(0.0)) / F.col("total"), F.lit(0.0))
        if lower is None:
            below = F.lit(1.0 / SYMBOLS)
        else:
            found = found.withColumn("tail", _suffix("gram", order - 1)).join(lower, "tail")
            below = F.col("below")
        p = own + F.coalesce("rest", F.lit(1.0)) * below
        done = stored(found.select("gram", p.alias("p")), "probabilities")
        lower = done.select(F.col("gram").alias("tail"), F.col("p").alias("below"))
    return done.select("gram", F.log("p").alias("logp"))


def _score(model):
    schema = pa.schema([("row", pa.int64()), ("logp", pa.float64()), ("n_bytes", pa.int64())])

    def scored(held: list[tuple[int, bytes]]) -> pa.RecordBatch:
        known, logp = model.value
        found, ends = grams([t for _, t in held])
        value = np.zeros(len(found))
        if len(known):
            at = np.minimum(np.searchsorted(known, found), len(known) - 1)
            value = np.where(known[at] == found, logp[at], 0.0)
        sums = np.concatenate(([0.0], np.cumsum(value)))
        begins = np.concatenate(([0], ends[:-1]))
        return pa.RecordBatch.from_arrays(
            [pa.array([r for r, _ in held], pa.int64()), pa.array(sums[ends] - sums[begins]), pa.array(ends - begins)], schema=schema
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                held.append((row.as_py(), text))
                size += len(text)
                if size >= SCORE_BYTES:
                    yield scored(held)
                    held, size = [], 0
        if held:
            yield scored(held)

    return run


def text_scores(texts: DataFrame, model: DataFrame) -> DataFrame:
    """``row``, summed ``logp`` and ``n_bytes`` for every distinct ``row`` of ``texts`` (``row``, ``text`` as binary)."""
    spark = texts.sparkSession
    parts = max(1, -(-model.count() // PART_GRAMS))
    scores = []
    for part in range(parts):
        # Dealt by hash, a part holds PART_GRAMS n-grams or a little more.
        own = model.where(F.pmod(F.xxhash64("gram"), F.lit(parts)) == part) if parts > 1 else model
        held = own.toArrow().sort_by("gram")
        arrays = held["gram"].to_numpy(), held["logp"].to_numpy()
        found = texts.mapInArrow(_score(spark.sparkContext.broadcast(arrays)), "row long, logp double, n_bytes long")
        # Equal rows have equal scores, but for the order in which a batch adds them up.
        scores.append(found.groupBy("row").agg(F.max("logp").alias("logp"), F.max("n_bytes").alias("n_bytes")))
    if parts == 1:
        return scores[0]
    return reduce(DataFrame.unionByName, scores).groupBy("row").agg(F.sum("logp").alias("logp"), F.max("n_bytes").alias("n_bytes"))


def perplexities(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``lang``, ``n_bytes``, ``perplexity`` per byte, its language's ``threshold`` and ``kept`` for every row of ``docs``.

    Texts are trusted if ``labels`` has their ``doc_id`` with ``quality`` 1. One in ``HELD_OUT`` of them is not counted, so
    that its perplexity is that of a text the model has not seen; the threshold is a quantile of these, or of the
    counted ones in a language that has no other. NULL and empty texts have no perplexity and are
    kept. A language without trusted text has no threshold, and its texts are kept; a NULL language is one like any
    other. Repeated rows count each time. Without any trusted text every byte has probability 1/256. Other columns
    are ignored; an empty table gives an empty result.
    """
    counted = F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) != 0
    trusted = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    trusted = stored(trusted.select("doc_id", F.lit(True).alias("trusted"), counted.alias("counted")), "trusted")
    if trusted.count() <= BROADCAST_IDS:
        trusted = F.broadcast(trusted)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    known = docs.select("doc_id", text.alias("text")).join(trusted, "doc_id", "left")
    known = known.select("text", F.coalesce("counted", F.lit(False)).alias("counted"))
    counts = stored(known.mapInArrow(_count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")), "counts")
    model = stored(log_probabilities(counts), "model")
    # Rows that agree in all columns used here are scored alike, so their order within a task does not matter.
    key = F.xxhash64("doc_id", "lang", "text")
    scores = stored(text_scores(docs.select(key.alias("row"), text.alias("text")), model), "scores")
    rows = docs.select("doc_id", "lang", key.alias("row")).join(trusted, "doc_id", "left").join(scores, "row")
    rows = stored(
        rows.select(
            "doc_id",
            "lang",
            "n_bytes",
            F.when(F.col("n_bytes") > 0, F.exp(-F.col("logp") / F.col("n_bytes"))).alias("perplexity"),
            F.coalesce("trusted", F.lit(False)).alias("trusted"),
            F.coalesce("counted", F.lit(False)).alias("counted"),
        ),
        "perplexities",
    )

    def limit(test: Column) -> Column:
        return F.percentile_approx(F.when(test, F.col("perplexity")), QUANTILE, QUANTILE_ACCURACY)

    limits = (
        rows.where("trusted and perplexity is not null")
        .groupBy(F.col("lang").alias("l"))
        .agg(F.coalesce(limit(~F.col("counted")), limit(F.col("counted"))).alias("threshold"))
    )
    judged = rows.join(stored(limits, "thresholds"), F.col("lang").eqNullSafe(F.col("l")), "left")
    kept = F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    return judged.select("doc_id", "lang", "n_bytes", "perplexity", "threshold", kept.alias("kept"))


# Workers get these functions by value, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
