"""Glob patterns, allow-lists and key texts as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def glob_to_regex(pattern: str) -> str:
    """Shell glob as a JVM regex: ``*``, ``?``, ``[seq]``, ``[!seq]``; ``*`` crosses ``:``."""
    out, i = [], 0
    while i < len(pattern):
        c = pattern[i]
        i += 1
        if c == "*":
            out.append(".*")
        elif c == "?":
            out.append(".")
        elif c == "[":
            # a closing bracket directly after [ or [! belongs to the set
            end = pattern.find("]", i + (2 if pattern[i : i + 1] == "!" else 1))
            if end < 0:
                out.append(r"\[")
            else:
                out.append(_char_set(pattern[i:end]))
                i = end + 1
        else:
            out.append(re.escape(c))
    return r"(?s)\A" + "".join(out) + r"\z"


def _char_set(body: str) -> str:
    negate = body.startswith("!")
    chars = body[1:] if negate else body
    safe = re.sub(r"([\\\[\]&~^])", r"\\\1", chars)
    return f"[{'^' if negate else ''}{safe}]"


def glob_match(text: Column, pattern: str) -> Column:
    """Case-sensitive glob match; an exact pattern is a plain comparison."""
    if not any(c in pattern for c in "*?["):
        return text == F.lit(pattern)
    if pattern.count("*") == 1 and not any(c in pattern for c in "?["):
        head, tail = pattern.split("*")
        hit = text.startswith(head)
        return hit & text.endswith(tail) & (F.length(text) >= len(head + tail)) if tail else hit
    return text.rlike(glob_to_regex(pattern))


def allow_list_match(text: Column, patterns: list[str]) -> Column:
    """Member of an allow-list: exact entries, or ``*``/``?`` globs; brackets are literal."""
    exact = [p for p in patterns if "*" not in p and "?" not in p]
    globs = [p for p in patterns if "*" in p or "?" in p]
    hit = text.isin(exact) if exact else F.lit(False)
    for p in globs:
        hit = hit | text.rlike(allow_glob_to_regex(p))
    return hit


def allow_glob_to_regex(pattern: str) -> str:
    body = "".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in pattern)
    return rf"\A{body}$"


def specificity(pattern: str) -> tuple[bool, bool, bool, int]:
    """Sort key of a pattern, most specific first.

    Exact text (longest first), then text before the first ``*`` (longest first),
    then other wildcards (longest first), then the bare ``*``.
    """
    fixed, star, _ = pattern.partition("*")
    wild = bool(star) or "?" in pattern
    leads = bool(star and fixed)
    return wild, wild and not leads, pattern == "*", -len(fixed if leads else pattern)


def key_prefix(pattern: Column) -> Column:
    """Subscription prefix of a pattern: up to the last ``:`` before the first ``*``."""
    lead = F.substring_index(pattern, "*", 1)
    upto_colon = F.nullif(F.regexp_extract(lead, "^(.*:)", 1), F.lit(""))
    return F.when(pattern.contains("*"), F.coalesce(upto_colon, F.nullif(lead, F.lit("")))).otherwise(
        pattern
    )


def segment(key: Column, number: int) -> Column:
    """The ``:``-separated part at a zero-based position, null when there are fewer."""
    return F.get(F.split(key, ":", -1), F.lit(number))


def last_segment(key: Column) -> Column:
    return F.element_at(F.split(key, ":", -1), -1)


def preview(text: Column, n: int) -> Column:
    """The first ``n`` characters and ``...`` when there are more."""
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit("..."))).otherwise(text)


def any_prefix(text: Column, prefixes: list[str]) -> Column:
    hit = F.lit(False)
    for p in prefixes:
        hit = hit | text.startswith(p)
    return hit


def any_part(text: Column, parts: list[str]) -> Column:
    hit = F.lit(False)
    for p in parts:
        hit = hit | text.contains(p)
    return hit
