"""Which files of the contacts table may hold a value: minima, maxima and Bloom filters per file.

They are kept beside the table as rows that follow its loads, one per file, column and piece of a filter. A lookup
reads the rows of one column and opens the files that may hold the value; loads that are not indexed yet are opened.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidedesk.schema import CONTACT_SCHEMA
from tidedesk.sources.tables import CONTACTS, DAY, INDEX, LOAD, ContactStore, follow_loads, read_parts

INDEXED = ("agente_id", "orden_asociada")
#: Bits of one piece of a filter; Spark's bitmap aggregate has so many.
PIECE_BITS = 32768
#: Bits of a filter for every distinct value, and how many of them a value sets: about 3 of 100 other values pass.
VALUE_BITS = 10
PROBES = 2

_INDEX = "archivo string, columna string, menor string, mayor string, trozos long, trozo long, bits binary"


def _bit(value: Column, pieces: Column, probe: int) -> Column:
    """Where a value's bit of one probe lies in a filter of so many pieces."""
    return F.pmod(F.xxhash64(F.lit(probe), value), pieces * PIECE_BITS)


def index_rows(contacts: DataFrame) -> DataFrame:
    """The index of contacts that still know their files."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("columna"), F.col(c).alias("v")) for c in INDEXED]))
    rows = contacts.select(DAY, LOAD, F.col("_metadata.file_name").alias("archivo"), cells.alias("c"))
    values = rows.select(DAY, LOAD, "archivo", "c.*").where("v IS NOT NULL").distinct()
    file = [DAY, LOAD, "archivo", "columna"]
    sizes = values.groupBy(*file).agg(
        F.min("v").alias("menor"),
        F.max("v").alias("mayor"),
        F.ceil(F.count("*") * VALUE_BITS / PIECE_BITS).cast("long").alias("trozos"),
    )
    bits = F.explode(F.array(*[_bit(F.col("v"), F.col("trozos"), k) for k in range(PROBES)]))
    placed = values.join(sizes, file).select(*file, "menor", "mayor", "trozos", bits.alias("at"))
    piece = F.expr(f"at div {PIECE_BITS}").alias("trozo")
    return placed.groupBy(*file, "menor", "mayor", "trozos", piece).agg(
        F.bitmap_construct_agg(F.col("at") % PIECE_BITS).alias("bits")
    )


def index_loads(spark: SparkSession, store: ContactStore) -> int:
    """Brings the index up to date with the live loads; returns how many parts of loads were read."""
    return follow_loads(spark, store, INDEX, "filtros", index_rows)


def _set(bits: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.expr("at div 8 + 1"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(1) == 1


def files_with(
    spark: SparkSession, store: ContactStore, column: str, value: str, start: date | None = None, end: date | None = None
) -> list[str]:
    """Paths of the live files, and of whole loads that are not indexed, that may hold ``value``.

    The index is read by tasks; the driver gets the files that pass, and those alone.
    """
    if column not in INDEXED:
        raise ValueError(f"{column!r} is not indexed; choose one of {', '.join(INDEXED)}")
    state = store.log(spark).state()
    index = state.parts(INDEX, start, end)
    indexed = {(p.day, p.load.partition(":")[2]) for p in index}
    paths = [f"{store.contacts}/{p.day}/{p.name}" for p in state.parts(CONTACTS, start, end) if (p.day, p.name) not in indexed]
    if not index:
        return paths
    there = [f"{store.index}/{p.day}/{p.name}" for p in index]
    rows = spark.read.schema(f"{_INDEX}, {DAY} string, {LOAD} string").option("basePath", store.index).parquet(*there)
    wanted = F.lit(value)
    rows = rows.where((F.col("columna") == column) & (F.col("menor") <= wanted) & (F.col("mayor") >= wanted))
    probes = F.array(*[F.struct(F.lit(k).alias("probe"), _bit(wanted, F.col("trozos"), k).alias("at")) for k in range(PROBES)])
    asked = rows.select(DAY, LOAD, "archivo", "trozo", "bits", F.explode(probes).alias("p")).where(
        F.expr(f"p.at div {PIECE_BITS}") == F.col("trozo")
    )
    asked = asked.select(DAY, LOAD, "archivo", "bits", "p.probe", (F.col("p.at") % PIECE_BITS).alias("at"))
    passed = asked.where(_set(F.col("bits"), F.col("at"))).groupBy(DAY, LOAD, "archivo").agg(F.count("*").alias("k"))
    for row in passed.where(F.col("k") == PROBES).orderBy(DAY, LOAD, "archivo").toLocalIterator():
        paths.append(f"{store.contacts}/{DAY}={row[DAY]}/{LOAD}={row[LOAD].rpartition('+')[0]}/{row['archivo']}")
    return paths


def find_contacts(
    spark: SparkSession, store: ContactStore, column: str, value: str, start: date | None = None, end: date | None = None
) -> DataFrame:
    """The contacts with ``value``, and their ``fecha``, from the files that may hold it."""
    paths = files_with(spark, store, column, value, start, end)
    empty = read_parts(spark, store.contacts, CONTACT_SCHEMA, DAY, [])
    rows = spark.read.schema(empty.schema).option("basePath", store.contacts).parquet(*paths) if paths else empty
    return rows.where(F.col(column) == value).drop(LOAD)
