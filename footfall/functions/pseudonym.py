"""Replacing ticket and device ids by tokens that are the same everywhere.

Tokens are keyed hashes, not random: every task computes the same token for an id, and a
retried task does not change the output. The salt is the secret that keeps tokens from
being recomputed; use a fresh one per released data set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.text import map_json_text

# The id shapes.
UUID_ID = "[a-f0-9]{8}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{12}"
AT_ID = "at[a-f0-9]{6}-[a-f0-9]{18}-[a-f0-9]{8}"
WATCH_ID = "E3[A-Z0-9]+"
EMBEDDED_WATCH_ID = "E3[A-Z0-9]{4,18}"
SCENT_ID = r"6\d{4}"
SHORT_ID_KEY = ":EmpaticaDeviceIDShort"

WORD_START = r"\b"
# Inside a JSON string an escape such as \n ends a word, though its letter looks like one.
JSON_WORD_START = r"(?:\b|(?<=\\[bfnrt])|(?<=\\u[0-9a-fA-F]{4}))"


def _digest(kind: str, real: Column, salt: str) -> Column:
    return F.sha2(F.concat(F.lit(f"{salt}|{kind}|"), real), 256)


def ticket_token(real: Column, salt: str) -> Column:
    """A token in the shape of a random (version 4) UUID."""
    # one replacement, so that the hash is computed once
    parts = "^(.{8})(.{4})(.{3})(.{3})(.{12}).*$"
    return F.regexp_replace(_digest("ticket", real, salt), parts, "$1-$2-4$3-a$4-$5")


def watch_token(real: Column, salt: str) -> Column:
    """``F`` and eleven letters or digits."""
    number = F.conv(F.substring(_digest("watch", real, salt), 1, 14), 16, 36)
    return F.concat(F.lit("F"), F.lpad(number, 11, "0"))


def scent_token(real: Column) -> Column:
    return F.concat(F.lit("7"), F.substring(real, F.lit(2), F.length(real)))


def fake_key(key: Column, salt: str) -> Column:
    """The key with its ticket, watch or scent id replaced; other keys stay."""

    def of(prefix: str, shape: str, token) -> tuple[Column, Column]:
        regex = f"^{prefix}:({shape})(:.*)?$"
        found = F.regexp_extract(key, regex, 1)
        hit = key.startswith(f"{prefix}:") & (found != "")
        return hit, F.concat(F.lit(f"{prefix}:"), token(found), F.regexp_extract(key, regex, 2))

    visitor = of("Visitors", f"{UUID_ID}|{AT_ID}", lambda c: ticket_token(c, salt))
    watch = of("Wearables:WatchDevices", WATCH_ID, lambda c: watch_token(c, salt))
    scent = of("Wearables:Scent", SCENT_ID, scent_token)
    return F.when(*visitor).when(*watch).when(*scent).otherwise(key)


def _embedded(start: str, with_scent: bool) -> str:
    shapes = [AT_ID, UUID_ID, EMBEDDED_WATCH_ID] + ([SCENT_ID] if with_scent else [])
    return "|".join(rf"{start}{shape}\b" for shape in shapes)


def fake_text(text: Column, salt: str, with_scent: bool, start: str = WORD_START) -> Column:
    """Text with every embedded id replaced in one pass, so no token is matched again."""
    regex = _embedded(start, with_scent)

    def token(real: Column) -> Column:
        return (
            F.when(real.contains("-"), ticket_token(real, salt))
            .when(real.startswith("E3"), watch_token(real, salt))
            .otherwise(scent_token(real))
        )

    found = F.transform(F.regexp_extract_all(text, F.lit(regex), F.lit(0)), token)
    pieces = F.zip_with(
        F.split(text, regex, -1), found, lambda rest, t: F.concat(rest, F.coalesce(t, F.lit("")))
    )
    # most texts hold no id: one search decides
    return F.when(text.rlike(regex), F.array_join(pieces, "")).otherwise(text)


def fake_value(key: Column, text: Column, value_type: Column, salt: str) -> Column:
    """A record's value with embedded ids replaced.

    Texts are rewritten whole. In JSON no ticket or watch id can stand outside a string, so
    its text is rewritten whole too; five-digit scent ids look like numbers, so where the
    key says ``Scent``, the only place they count, the strings are rewritten one by one.
    """

    def in_string(part: Column, with_scent: bool) -> Column:
        return fake_text(part, salt, with_scent, JSON_WORD_START)

    def rewrite(with_scent: bool, json: Column) -> Column:
        return (
            F.when(value_type == "string", fake_text(text, salt, with_scent))
            .when(value_type == "json", json)
            .otherwise(text)
        )

    strings = map_json_text(text, inside=lambda s: in_string(s, True))
    is_short = key.endswith(SHORT_ID_KEY) & (value_type == "string")
    return (
        F.when(is_short, F.concat(F.lit("F"), text))
        .when(key.contains("Scent"), rewrite(True, strings))
        .otherwise(rewrite(False, in_string(text, False)))
    )


def pseudonymise(records: DataFrame, salt: str) -> DataFrame:
    """Replay records (``key, text, value_type``) with ids replaced in keys and values."""
    key = F.col("key")
    changed = {
        "text": fake_value(key, F.col("text"), F.col("value_type"), salt),
        "key": fake_key(key, salt),
    }
    return records.select(*[changed[c].alias(c) if c in changed else c for c in records.columns])
