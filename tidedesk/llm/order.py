"""Numbers rows in a given order without bringing a group, or the table, into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidedesk.llm.common import stored

#: Bits of ``monotonically_increasing_id`` below its partition number.
PLACE_BITS = 33


def in_order(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """``rows``, written, with ``rank``: their place from 0 in ascending order of the columns ``order``.

    NULLs come first and text is ordered by its UTF-8 bytes. Rows are dealt out by ranges, and rows that are equal
    in ``order`` by where they were read, so that no value has to fit one task. What is broadcast has one row per
    task of the sort.
    """
    keys = [*order, "_read"]
    read = rows.withColumn("_read", F.monotonically_increasing_id())
    ranged = read.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_read")
    placed = stored(ranged.withColumn("_seq", F.monotonically_increasing_id()), label)
    part = F.shiftright("_seq", PLACE_BITS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    joined = placed.join(F.broadcast(stored(offsets, f"{label}_offsets")), part == F.col("_part"))
    place = F.col("_seq").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return joined.withColumn("rank", F.col("_before") + place).drop("_seq", "_part", "_before")
