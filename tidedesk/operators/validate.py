"""Message validation: bytes in, typed contacts and dead letters out, no message lost."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidedesk.functions import strict_json
from tidedesk.schema import CONTACT_SCHEMA, REQUIRED_FIELDS

# --- Fixed values: reason texts ---------------------------------------------------------------------
EMPTY = "EMPTY"
INVALID_UTF8 = "INVALID_UTF8"
INVALID_JSON = "INVALID_JSON"
NOT_OBJECT = "NOT_OBJECT"
BAD_TYPE = "BAD_TYPE"
MISSING_PREFIX = "Faltan campos obligatorios: "
# --- End of fixed values ------------------------------------------------------------------------------
MISSING_FIELDS = "MISSING_FIELDS"

#: Read as variants, which keep what kind of JSON value it was; a text column takes JSON text only.
_AS_TEXT = [f.name for f in CONTACT_SCHEMA if isinstance(f.dataType, (T.StringType, T.TimestampType))]
_EVENT_DDL = (
    "struct<"
    + ", ".join(
        f"{f.name}: {'variant' if f.name in _AS_TEXT else f.dataType.simpleString()}" for f in CONTACT_SCHEMA
    )
    + ">"
)
#: Date, time to the second and offset; the fraction is optional.
_INSTANT = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"
_PROBE_DDL = f"struct<{CONTACT_SCHEMA[0].name}: string>"


def _text(event: Column, name: str) -> Column:
    return F.try_variant_get(event[name], "$", "string")


def _member(event: Column, field: T.StructField) -> Column:
    """One field of the parsed event in its declared type; NULL where it cannot be."""
    if field.name not in _AS_TEXT:
        return event[field.name]
    text = _text(event, field.name)
    return text.try_cast("timestamp") if isinstance(field.dataType, T.TimestampType) else text


def _texts_fit(event: Column) -> Column:
    """Whether all text columns hold JSON text or nothing, and instants are whole ones."""
    fits = F.lit(True)
    for field in CONTACT_SCHEMA:
        if field.name in _AS_TEXT:
            kind = F.schema_of_variant(event[field.name])
            fits = fits & F.coalesce(kind.isin("STRING", "VOID"), F.lit(True))
        if isinstance(field.dataType, T.TimestampType):
            text = _text(event, field.name)
            whole = text.rlike(_INSTANT) & text.try_cast("timestamp").isNotNull()
            fits = fits & F.coalesce(whole, text.isNull())
    return fits


def _complete(event: Column, required: Sequence[str]) -> Column:
    """Cheaper than the list, so valid messages never build it."""
    return reduce(Column.__and__, [event[name].isNotNull() for name in required], F.lit(True))


def _missing(event: Column, required: Sequence[str]) -> Column:
    return F.array_compact(F.array(*[F.when(event[name].isNull(), F.lit(name)) for name in required]))


def _missing_text(names: Column) -> Column:
    return F.concat(F.lit(MISSING_PREFIX + "['"), F.array_join(names, "', '"), F.lit("']"))


def validate(
    messages: DataFrame, value: str = "value", required: Sequence[str] = REQUIRED_FIELDS, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per message: ``keep`` columns, ``raw_payload``, ``evento``, ``faltantes``, ``error``.

    ``error`` is NULL for a valid message and ``EMPTY`` for one without a value, whose payload is NULL. Null and absent are the same for a required field, while
    empty text, 0 and false count as present. A message is checked for its encoding, then for being
    one JSON object, then for its required fields, then for the declared types.

    A valid flat message costs one parse, one with nested values two. Parses that tell rejects apart
    run for rejects only.
    """
    text, utf8 = F.col("_text"), F.col("_utf8")
    opens_object = strict_json.starts_object(text)
    strings_ddl = "struct<" + ", ".join(f"{name}: string" for name in required) + ">"

    def read(column: str) -> Column:
        return F.coalesce(F.col(f"{column}._bad").isNull() & F.col(f"{column}.p").isNotNull(), F.lit(False))

    parsed, strings = utf8 & read("_event"), read("_strings")
    typed = F.col("_fits")
    single = F.coalesce("_single", F.lit(False))
    other_kind = F.coalesce(F.col("_other") == 1, F.lit(False))
    fits, is_object = typed & single, (typed | strings) & single
    none = F.array().cast("array<string>")

    raw = F.col(value).cast("string")
    judged = (
        messages.select(*keep, raw.alias("_text"), F.coalesce(F.is_valid_utf8(raw), F.lit(False)).alias("_utf8"))
        .withColumn("_event", F.when(utf8, strict_json.parse_member(text, _EVENT_DDL)))
        .withColumn("_fits", F.when(parsed, _texts_fit(F.col("_event.p"))).otherwise(False))
        .withColumn(
            "_typed", F.when(typed, F.struct(*[_member(F.col("_event.p"), f).alias(f.name) for f in CONTACT_SCHEMA]))
        )
        .withColumns(
            {
                "_strings": F.when(utf8 & ~typed & opens_object, strict_json.parse_member(text, strings_ddl)),
                "_value": F.when(utf8 & ~typed & ~opens_object, strict_json.parse_member(text, "string")),
            }
        )
        .withColumns(
            {
                "_single": F.when(typed | strings, strict_json.is_single_object(text, _PROBE_DDL)),
                "_other": F.when(
                    F.col("_value").isNotNull() & F.col("_value._bad").isNull(),
                    strict_json.element_count(text, "string"),
                ),
            }
        )
        .withColumn(
            "_faltantes",
            F.when(fits & _complete(F.col("_typed"), required), none)
            .when(fits, _missing(F.col("_typed"), required))
            .when(is_object, _missing(F.col("_strings.p"), required))
            .otherwise(none),
        )
        .withColumn(
            "_error",
            F.when(text.isNull(), EMPTY)
            .when(~utf8, INVALID_UTF8)
            .when(F.size("_faltantes") > 0, _missing_text(F.col("_faltantes")))
            .when(is_object & ~fits, BAD_TYPE)
            .when(other_kind, NOT_OBJECT)
            .when(~is_object, INVALID_JSON),
        )
    )
    # A predicate on ``error`` or ``faltantes`` is not pushed through a generator, so splitting the result
    # never repeats the parse inside the filter. The costly columns lie beside it and are pruned where
    # nobody asks.
    return judged.select(
        *keep,
        F.when(utf8, text).otherwise(F.make_valid_utf8(text)).alias("raw_payload"),
        F.when(F.col("_error").isNull(), F.col("_typed")).alias("evento"),
        F.inline(F.array(F.struct(F.col("_faltantes").alias("faltantes"), F.col("_error").alias("error")))),
    )


def valid_rows(validated: DataFrame) -> DataFrame:
    """The 13 contact columns of the valid messages."""
    return validated.where(F.col("error").isNull()).select("evento.*")


def dlq_rows(validated: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Rejected messages as tolerant text, with the reason and the instant of capture."""
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    return validated.where(F.col("error").isNotNull()).select("raw_payload", "error", stamp.alias("ingested_at"))


def reason_code(error: Column) -> Column:
    """The reason without the list of fields, for grouping."""
    return F.when(error.startswith(MISSING_PREFIX), MISSING_FIELDS).otherwise(error)


def replay_dlq(
    dlq: DataFrame, required: Sequence[str] = REQUIRED_FIELDS, keep: Sequence[str] = ()
) -> DataFrame:
    """Validate stored payloads again, for instance after a change of rules.

    Rows rejected for their encoding hold replacement characters, not the bytes that arrived, so
    they keep their reason whatever the stored text looks like.
    """
    stored = F.col("stored_error")
    source = dlq.select(*keep, F.col("raw_payload").cast("binary").alias("value"), F.col("error").alias("stored_error"))
    again = validate(source, required=required, keep=[*keep, "stored_error"])
    lost = stored.isin(INVALID_UTF8, EMPTY)
    return again.select(
        *keep,
        "raw_payload",
        "faltantes",
        F.when(lost, stored).otherwise(F.col("error")).alias("error"),
        F.when(~lost, F.col("evento")).alias("evento"),
    )
