"""Canonical texts, value hashes, boolean and time parsing."""

from __future__ import annotations

from collections.abc import Callable
from zoneinfo import available_timezones

from pyspark.sql import Column
from pyspark.sql import functions as F

# A JSON string literal, quotes included.
STRING_LITERAL = r'"(?:[^"\\]|\\.)*"'
# A member of a flat object whose name comes again.
EARLIER_MEMBER = rf"({STRING_LITERAL})\s*:\s*(?:{STRING_LITERAL}|[^,{{}}\[\]\"]*),(?=(?:[^\"]|{STRING_LITERAL})*?\1\s*:)"


def map_json_text(
    text: Column,
    inside: Callable[[Column], Column] | None = None,
    outside: Callable[[Column], Column] | None = None,
) -> Column:
    """Rewrites JSON text, its string literals and the rest separately."""
    rest = F.split(text, STRING_LITERAL, -1)
    literals = F.regexp_extract_all(text, F.lit(STRING_LITERAL), F.lit(0))
    if outside:
        rest = F.transform(rest, outside)
    if inside:
        literals = F.transform(literals, inside)
    pieces = F.zip_with(rest, literals, lambda r, s: F.concat(r, F.coalesce(s, F.lit(""))))
    return F.array_join(pieces, "")


def spaced_json(text: Column) -> Column:
    """JSON text with one blank after ``,`` and ``:`` and no other, member order kept."""

    def respace(rest: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(rest, r"\s+", ""), "([,:])", "$1 ")

    return map_json_text(text, outside=respace)


def canonical_text(value: Column, value_is_object: Column) -> Column:
    """The stored text of a value.

    Where the rule parses payloads: objects and lists as spaced JSON, booleans as
    ``true``/``false``, quoted strings without quotes, JSON null as null. Otherwise, and
    when the payload is not JSON, the text as it came.
    """
    parsed = F.when(value_is_object, F.try_parse_json(value))
    trimmed = F.trim(value)
    first = F.substring(trimmed, 1, 1)
    return (
        F.when(parsed.isNull(), value)
        .when(first.isin("{", "["), spaced_json(trimmed))
        .when(first == '"', F.try_variant_get(parsed, "$", "string"))
        .when(trimmed == "null", F.lit(None).cast("string"))
        .otherwise(trimmed)
    )


def hash_text(value: Column, value_is_object: Column | None = None) -> Column:
    """SHA-256 of a value for change detection. It never fails.

    An object or list is hashed as compact JSON with sorted members, numbers and texts told
    apart, and the last of several members of one name. What is no JSON, or is not parsed by
    its rule, is hashed as it came.
    """
    if value_is_object is None:
        value_is_object = F.lit(True)
    structured = value_is_object & F.ltrim(value).substr(1, 1).isin("{", "[")
    # the parser refuses a name that comes twice: then earlier members of a flat object give way
    last_wins = F.regexp_replace(value, EARLIER_MEMBER, "")
    parsed = F.coalesce(F.try_parse_json(value), F.try_parse_json(last_wins))
    return F.sha2(F.coalesce(F.when(structured, F.to_json(parsed)), value, F.lit("None")), 256)


def parse_bool(text: Column) -> Column:
    return F.lower(text).isin("true", "1", "yes", "on")


def coerce(value: Column, spark_type: str) -> Column:
    """A text or number as a column type; what does not fit becomes null.

    Whole numbers are cut toward zero, booleans follow ``parse_bool``.
    """
    if spark_type in ("bigint", "long"):
        return F.coalesce(value.try_cast("bigint"), value.try_cast("double").try_cast("bigint"))
    if spark_type == "boolean":
        return parse_bool(value.cast("string"))
    if spark_type == "double":
        return value.try_cast("double")
    return value.cast("string")


def parse_time(text: Column, default_zone: str = "America/Los_Angeles") -> Column:
    """Time text as an instant: ISO with offset or ``Z``, ISO with ``[Zone]``, or local.

    Texts without a zone, dates alone included, are read in ``default_zone``. A ``[Zone]``
    counts more than an offset; an unknown one gives null.
    """
    zone = F.nullif(F.regexp_extract(text, r"\[([^\]]+)\]$", 1), F.lit(""))
    body = F.regexp_replace(text, r"\[[^\]]*\]$", "")
    has_offset = body.rlike(r"(Z|[+-]\d{2}:?\d{2})$") & body.contains(":")
    clock = F.when(has_offset, F.regexp_replace(body, r"(Z|[+-]\d{2}:?\d{2})$", "")).otherwise(body)
    here = F.coalesce(zone, F.lit(default_zone))
    known = F.when(here.isin(*sorted(available_timezones())), here)
    local = F.to_utc_timestamp(clock.try_cast("timestamp_ntz").cast("timestamp"), known)
    return F.when(has_offset & zone.isNull(), body.try_cast("timestamp")).otherwise(local)


def show_time(ts: Column, zone: str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """A UTC instant as text in a display zone."""
    return F.date_format(F.from_utc_timestamp(ts, zone), pattern)
