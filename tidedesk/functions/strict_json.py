"""Strict JSON checks from built-in expressions.

``from_json`` on its own takes trailing text after the first value and single-quoted keys. A text is
exactly one JSON value if it parses both as the only member of an object and as the only element of
an array: whatever closes one wrapper early, or adds members to it, breaks the other.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STRICT = {"allowSingleQuotes": "false", "timeZone": "UTC"}
_FLAGGED = {**_STRICT, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}


def _member(text: Column) -> Column:
    return F.concat(F.lit('{"p":'), text, F.lit("}"))


def _element(text: Column) -> Column:
    return F.concat(F.lit("["), text, F.lit("]"))


def parse_member(text: Column, ddl: str) -> Column:
    """``struct<p, _bad>``: the value read as ``ddl``; ``_bad`` is set when it does not fit."""
    return F.from_json(_member(text), f"p {ddl}, _bad string", _FLAGGED)


def element_count(text: Column, ddl: str) -> Column:
    """How many comma-separated values of type ``ddl`` the text holds; NULL when it cannot be read."""
    return F.size(F.from_json(_element(text), f"array<{ddl}>", _STRICT))


def is_single_object(text: Column, ddl: str) -> Column:
    """For a text that parses as an object's member: whether nothing follows the first object in it.

    An object ends with a brace. If the text's only closing brace is its last byte, the object ends
    there; that settles flat messages. Others are parsed once more, as an array's only element.
    """
    before_brace = F.octet_length(F.substring_index(text, "}", 1))
    return F.when(before_brace + 1 == F.octet_length(text), True).otherwise(element_count(text, ddl) == 1)


def starts_object(text: Column) -> Column:
    return text.rlike(r"^[ \t\r\n]*\{")
