"""Routing events to target tables by glob rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.patterns import (
    glob_match,
    key_prefix,
    last_segment,
    specificity,
)
from footfall.rules import RULES, STATE, Rule, group_number, java_regex

# Tags looked for in a key, in this order.
DATA_TYPES = ("BioSensors", "BlueIoTSensors", "Status", "EmpaticaDeviceID")


def ranked(rules=RULES, source_type: str | None = None) -> list[Rule]:
    """Rules from most to least specific; equals keep their order."""
    chosen = [r for r in rules if source_type in (None, r.source_type)]
    return sorted(chosen, key=lambda r: specificity(r.pattern))


def _ordered(rules) -> list[tuple[int, Rule]]:
    """(rank within the source type, rule) for key rules, then channel rules."""
    return [
        (rank, rule) for kind in ("key", "channel") for rank, rule in enumerate(ranked(rules, kind))
    ]


def _hit(rule: Rule) -> Column:
    return (F.col("source_type") == rule.source_type) & glob_match(F.col("key"), rule.pattern)


def first_match(rules, value) -> Column:
    """``value(rule)`` of the most specific rule that matches, null when none does."""
    chain = F
    for _, rule in _ordered(rules):
        chain = chain.when(_hit(rule), value(rule))
    return chain.otherwise(F.lit(None)) if chain is not F else F.lit(None)


def route(raw: DataFrame, rules=RULES, keep_unmatched: bool = False) -> DataFrame:
    """Adds ``rule``, ``target_table``, ``value_is_object`` and the sensor's ``device_id``.

    Unmatched events drop out. The rules are configuration, so the match is one expression
    in the scan's stage: no join, and the same plan for batch and stream. It is generated,
    because a plain column would be copied into every later filter on the target table.
    """
    target = first_match(
        rules,
        lambda r: F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(r.target_table).alias("target_table"),
            F.lit(r.value_is_object).alias("value_is_object"),
            device_of(r).alias("device_id"),
        ),
    )
    generated = F.explode(F.array(target)).alias("_route")
    out = raw.select("*", generated).select(*raw.columns, "_route.*")
    return out if keep_unmatched else out.where(F.col("target_table").isNotNull())


def rule_matches(raw: DataFrame, rules=RULES) -> DataFrame:
    """Every rule that matches each event, with its rank (0 wins).

    Each row gets an array of its hits, so rows multiply only by true matches.
    """
    hits = F.array(
        *[
            F.when(
                _hit(rule),
                F.struct(
                    F.lit(rule.name).alias("rule"),
                    F.lit(rule.target_table).alias("target_table"),
                    F.lit(rank).cast("bigint").alias("rank"),
                ),
            )
            for rank, rule in _ordered(rules)
        ]
    )
    return raw.select("*", F.explode(F.array_compact(hits)).alias("_hit")).select(
        *raw.columns, "_hit.rule", "_hit.target_table", "_hit.rank"
    )


def rule_hits(raw: DataFrame, rules=RULES) -> DataFrame:
    """Per rule in the order of specificity: its rank and the events it takes."""
    rank = first_match(rules, lambda r: F.struct(
        F.lit(r.source_type).alias("source_type"),
        F.lit(next(i for i, x in _ordered(rules) if x == r)).cast("bigint").alias("rank"),
        F.lit(r.name).alias("rule"),
        F.lit(r.pattern).alias("pattern"),
    ))
    return (
        raw.select(rank.alias("hit"))
        .where(F.col("hit").isNotNull())
        .groupBy("hit.source_type", "hit.rank", "hit.rule", "hit.pattern")
        .agg(F.count("*").alias("events"))
        .orderBy("source_type", "rank")
    )


def prefixes(rules: DataFrame) -> DataFrame:
    """Distinct subscription prefixes of the key rules, sorted."""
    return (
        rules.where("source_type = 'key'")
        .select(key_prefix(F.col("pattern")).alias("prefix"))
        .where("prefix is not null")
        .distinct()
        .orderBy("prefix")
    )


def patterns_of(rules: DataFrame, source_type: str) -> DataFrame:
    return rules.where(F.col("source_type") == source_type).select("pattern")


def row_id(rules=RULES) -> Column:
    """Row id of a routed event.

    The whole key for the state table; else the rule's ``ticket_id`` group, or its
    ``device_id`` group; the key again when the regex does not match.
    """

    def of(rule: Rule) -> Column:
        if rule.target_table == STATE:
            return F.col("key")
        named = group_number(rule.id_regex, "ticket_id") or group_number(rule.id_regex, "device_id")
        if not named:
            return F.col("key")
        found = F.regexp_extract("key", "^" + java_regex(rule.id_regex), named)
        return F.coalesce(F.nullif(found, F.lit("")), F.col("key"))

    return by_rule(rules, of)


def device_of(rule: Rule) -> Column:
    """Device id that a sensor rule reads from the key; null on a miss or an empty id."""
    number = group_number(rule.id_regex, "device_id")
    if rule.target_table == STATE or not number:
        return F.lit(None).cast("string")
    return F.nullif(F.regexp_extract("key", "^" + java_regex(rule.id_regex), number), F.lit(""))


def by_rule(rules, value) -> Column:
    chain = F
    for rule in rules:
        chain = chain.when(F.col("rule") == rule.name, value(rule))
    return chain.otherwise(F.lit(None))


def data_type(key: Column) -> Column:
    """The first known tag the key contains, else its last segment."""
    chain = F
    for tag in DATA_TYPES:
        chain = chain.when(key.contains(tag), tag)
    return chain.otherwise(last_segment(key))
