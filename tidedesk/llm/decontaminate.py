"""Benchmark decontamination by spaced seeds.

A mask selects some positions of a span of ``SPAN`` words and ignores the others, so two spans that differ
only in ignored words have the same hash. Hashes of every span of every document are joined with those of
the benchmark items under each fixed mask; around each hit, windows of ``WINDOW`` aligned words that cover
the span are compared word by word, and a window with few enough substitutions is an overlap. Everything is
DataFrame expressions: the documents are read once and never shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidedesk.llm.quality import let, words_of

#: 1: the word counts, 0: it is ignored. All masks of items of a length have the same span. By enumeration, a mask fits
#: somewhere in every window of 13 words with at most two substitutions.
MASKS = ("11001111", "11101011")
SPAN = len(MASKS[0])
WINDOW = 13
#: Words of a window that may differ.
SUBSTITUTIONS = 2
#: Items with so many words, from and to, with the masks that fit into every allowed pattern of theirs: one substitution
#: from seven words on, none below.
LENGTHS = (
    *[(n, n, ("1" * n,)) for n in range(1, 7)],
    (7, 8, ("101111", "110111", "111101")),
    (9, 12, ("1011111", "1111011")),
    (WINDOW, None, MASKS),
)
#: Items with fewer words are short ones.
SHORT = 9
#: Seeds of so many bytes at most are broadcast at a time; a larger benchmark goes in several blocks of items.
BLOCK_BYTES = 32 * 1024 * 1024
#: Bytes of one benchmark word under a mask: a seed with its neighbourhood.
SEED_BYTES = 8 * 2 * WINDOW + 64
#: Spans in one piece of a text.
PIECE = 32
PUNCTUATION = ".,;:!?\"'()[]{}"


def _word_hashes(text: Column) -> Column:
    """Hashes of the words, without case and common punctuation."""
    plain = F.translate(F.lower(F.coalesce(text, F.lit(""))), PUNCTUATION, "")
    return F.transform(words_of(plain), lambda w: F.xxhash64(w))


def _spans(table: DataFrame, text: str, keys: dict[str, Column], masks: tuple[str, ...], width: int) -> DataFrame:
    """A row for each span and mask: ``keys``, its ``seed`` and where it stands, at ``at`` of ``words``.

    ``words`` are the hashes of the words around it, as far as windows of ``width`` words reach, and ``n`` counts
    those of the whole text. Texts are cut into short overlapping pieces first: a row with all words of its text for every word would be quadratic.
    """
    span = len(masks[0])
    margin = width - span

    def pieces(hashes: Column) -> Column:
        def piece(start: Column) -> Column:
            first = F.greatest(F.lit(0), start - margin)
            return F.struct(
                (start - first).alias("base"),
                F.least(F.lit(PIECE), F.size(hashes) - span + 1 - start).alias("spans"),
                F.slice(hashes, first + 1, start - first + PIECE + span - 1 + margin).alias("words"),
                F.size(hashes).alias("n"),
            )

        starts = F.when(F.size(hashes) >= span, F.sequence(F.lit(0), F.size(hashes) - span, F.lit(PIECE)))
        return F.transform(starts, piece)

    cut = table.select(
        *[c.alias(n) for n, c in keys.items()], F.explode(let(_word_hashes(F.col(text)), pieces)).alias("p")
    ).select(*keys, "p.*")
    each = cut.select("*", F.explode(F.sequence(F.lit(0), len(masks) * F.col("spans") - 1)).alias("k"))
    at = F.col("base") + F.expr(f"k div {len(masks)}").cast("int")
    placed = each.select(*keys, "words", "n", at.alias("at"), (F.col("k") % len(masks)).alias("mask"))
    seeds = [
        F.xxhash64(F.lit(m), *[F.get("words", F.col("at") + k) for k, bit in enumerate(mask) if bit == "1"])
        for m, mask in enumerate(masks)
    ]
    # Never NULL: the join then needs no filter that would hash every span a second time.
    seed = reduce(lambda rest, m: F.when(F.col("mask") == m, seeds[m]).otherwise(rest), range(1, len(masks)), seeds[0])
    return placed.select(*keys, "words", "n", "at", seed.alias("seed"))


def _best_window(hashes: Column, start: Column, piece: Column, window: Column) -> Column:
    """Most equal words in any ``window`` of the ``piece``, laid over ``hashes`` from ``start`` on."""
    equal = F.transform(piece, lambda h, k: F.coalesce((F.get(hashes, start + k) == h).cast("int"), F.lit(0)))
    return let(
        equal,
        lambda e: F.array_max(
            F.transform(
                F.sequence(F.lit(1), F.size(e) - window + 1),
                lambda s: F.aggregate(F.slice(e, s, window), F.lit(0), lambda acc, x: acc + x),
            )
        ),
    )


def benchmark_seeds(benchmark: DataFrame, masks: tuple[str, ...], least: int, most: int | None) -> DataFrame:
    """The seeds of the items of ``least`` to ``most`` words with the words around each span: ``seed``, ``item_id``,
    ``before``, ``piece``, ``window``."""
    spans = _spans(benchmark, "text", {"item_id": F.col("item_id")}, masks, most or WINDOW)
    spans = spans.where((F.col("n") >= least) & (F.lit(most is None) | (F.col("n") <= (most or 0))))
    window = F.least(F.lit(WINDOW), F.col("n"))
    first = F.greatest(F.lit(0), F.col("at") - (window - len(masks[0])))
    last = F.least(F.size("words"), F.col("at") + window)
    return spans.select(
        "seed",
        "item_id",
        (F.col("at") - first).alias("before"),
        F.slice("words", first + 1, last - first).alias("piece"),
        window.alias("window"),
    ).distinct()


def overlaps(docs: DataFrame, benchmark: DataFrame, keys: dict[str, Column], short_items: bool = False) -> DataFrame:
    """``keys`` of each row of ``docs`` with an ``item_id`` it overlaps, and the most ``matched_words`` of a window.

    A window has 13 words (the whole item if that is shorter) and at most 2 of them differ, fewer in
    proportion for short items: one of 7 to 12 words, none of fewer. Every such window is found; items with
    fewer than 9 words only with ``short_items``. NULL and empty texts overlap nothing. Rows of ``docs`` with
    equal keys count as one. Items of equal text are found under each ``item_id``. Columns other than
    ``text``, ``item_id`` and those of ``keys`` are ignored. An empty side gives an empty result.
    """
    lengths = [x for x in LENGTHS if short_items or x[0] >= SHORT]
    sized = benchmark.select(F.size(_word_hashes(F.col("text"))).alias("n"))
    is_of = [(F.col("n") >= least) & (F.lit(most is None) | (F.col("n") <= (most or 0))) for least, most, _ in lengths]
    words = sized.agg(*[F.sum(F.when(test, F.col("n"))).alias(f"w{k}") for k, test in enumerate(is_of)]).first()
    found = []
    for k, (least, most, masks) in enumerate(lengths):
        # Lengths that no item has need no pass over the documents, but for a result without rows.
        if not words[k] and (found or k + 1 < len(lengths)):
            continue
        width = most or WINDOW
        blocks = max(1, -(-int(words[k] or 0) * len(masks) * SEED_BYTES // BLOCK_BYTES))
        for block in range(blocks):
            items = benchmark.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block) if blocks > 1 else benchmark
            # At most BLOCK_BYTES, about.
            hits = _spans(docs, "text", keys, masks, width).join(F.broadcast(benchmark_seeds(items, masks, least, most)), "seed")
            matched = _best_window(F.col("words"), F.col("at") - F.col("before"), F.col("piece"), F.col("window"))
            allowed = F.floor(F.lit(SUBSTITUTIONS) * F.col("window") / WINDOW)
            found.append(
                hits.select(*keys, "item_id", "window", matched.alias("matched_words"), allowed.alias("allowed"))
                .where("matched_words >= window - allowed")
                .groupBy(*keys, "item_id")
                .agg(F.max("matched_words").cast("long").alias("matched_words"))
            )
    if len(found) == 1:
        return found[0]
    # An item_id may stand for texts of several lengths.
    every = reduce(DataFrame.unionByName, found)
    return every.groupBy(*keys, "item_id").agg(F.max("matched_words").alias("matched_words"))


def equals_short_item(docs: DataFrame, benchmark: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """``keys`` of each row of ``docs`` whose whole text has the words of a benchmark item of fewer than ``SHORT`` words.

    Common words make up such an item, so a longer text that holds it is no copy of it. NULL and empty texts equal none.
    """
    def worded(rows: DataFrame, *kept: Column) -> DataFrame:
        hashes = rows.select(*kept, _word_hashes(F.col("text")).alias("w"))
        return hashes.where((F.size("w") > 0) & (F.size("w") < SHORT)).withColumn("whole", F.xxhash64("w"))

    items = worded(benchmark).select("whole").distinct()
    return worded(docs, *[c.alias(n) for n, c in keys.items()]).join(items, "whole", "left_semi").select(*keys)
