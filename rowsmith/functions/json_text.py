"""JSON found inside free text answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STRICT = {"allowSingleQuotes": "false"}


def object_span(text: Column) -> Column:
    """From the first ``{`` to the last ``}``, null when there is none."""
    return F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))


def array_span(text: Column) -> Column:
    """From the first ``[`` to the last ``]``, null when there is none."""
    return F.nullif(F.regexp_extract(text, r"(?s)\[.*\]", 0), F.lit(""))


def valid_json(span: Column) -> Column:
    """The span when it is one complete JSON value, else null.

    A JSON reader stops after the first value; as the only element of an array the span can hold no other one.
    """
    values = F.from_json(F.concat(F.lit("["), span, F.lit("]")), "array<string>", STRICT)
    return F.when(F.size(values) == 1, F.get(values, F.lit(0)))


def parse_as(json: Column, schema: str) -> Column:
    """Typed value; a field of the wrong type becomes null, the others stay."""
    return F.from_json(json, schema, STRICT)


def answer_status(span: Column, json: Column) -> Column:
    """ok, no_json (nothing found) or bad_json (found, not parseable)."""
    return F.when(span.isNull(), "no_json").when(json.isNull(), "bad_json").otherwise("ok")
