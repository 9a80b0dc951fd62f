r"""Personal data: base spans by pattern, and terms that give protected entities away.

Mail and network addresses, card and phone numbers are found by pattern and checked; each
different value is a protected entity. The corpus tells how strongly a term (a run of letters)
reveals an entity: with m the words in all contexts of an entity (``REACH`` characters before and
after it), W all words, c how often the term occurs and k how often it does so in contexts of the entity,

    pointwise mutual information  log2((k / c) / (m / W)),  the entity's own information  log2(W / m)

and their ratio is the share of the entity that the term discloses; it is 1 for a term that occurs
nowhere else. A term whose disclosure reaches the threshold, in at least ``SUPPORT`` different contexts (copies
of a passage are one), is sanitised wherever it occurs: generalised to its first letters where all words
that begin so disclose less than the threshold together, and removed otherwise. Entities are replaced by
their kind. Only DataFrame functions are used, so everything stays in the JVM.

Positions come from the pieces between a pattern's matches: a match starts where the lengths of all pieces
and matches before it end. The patterns are written so that each character is looked at a bounded number
of times (possessive repeats; a match starts at the first character of its run or where the last match ended).

* Spans count code points, ends exclusive, leftmost and non-overlapping per kind; a match that fails its
  check is dropped and not tried again. Spans of different kinds may overlap; terms do not overlap mail addresses.
* Null texts are empty and have no spans; so are texts without letters or digits. Rows without an id, and rows
  that repeat an id, are looked at each on its own; equal texts have equal spans.
* Texts of any length are searched whole. An empty table gives an empty result. Extra columns stay behind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import written

#: What each kind looks like, in the order in which spans are listed.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold to be searched for a kind at all.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
TERM = "term"
REACH = 80
SUPPORT, DISCLOSURE = 3, 0.9
#: Letters of a term's general form.
GENERAL = 3
#: Running sums are made in blocks of this many, so that their cost stays in proportion.
BLOCK = 256
_SPAN = "array<struct<kind:string,start:bigint,end:bigint,value:string,before:string,after:string>>"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _checks(kind: str, value: str) -> str:
    digits = f"regexp_replace({value}, '[^0-9]', '')"
    if kind == "card":
        return f"length({digits}) between 16 and 19 and luhn_check({digits})"
    if kind == "phone":
        return f"length({digits}) between 8 and 15"
    if kind == "ip":
        part = "regexp_replace(p, '^0+', '')"
        return f"forall(split({value}, '[.]'), p -> length({part}) <= 3 and coalesce(try_cast({part} as int), 0) <= 255)"
    return "true"


def _running(values: str) -> str:
    """SQL of the sums of all values before each one, for an array of long values."""
    sums = "named_struct('t', 0L, 'a', cast(array() as array<bigint>))"
    within = f"aggregate(b, {sums}, (s, v) -> named_struct('t', s.t + v, 'a', array_append(s.a, s.t)))"
    blocks = f"transform(sequence(0, size(z) - 1, {BLOCK}), f -> slice(z, f + 1, {BLOCK}))"
    heads = f"aggregate(y, {sums}, (s, b) -> named_struct('t', s.t + b.t, 'a', array_append(s.a, s.t))).a"
    joined = f"flatten(zip_with(y, {heads}, (b, h) -> transform(b.a, v -> v + h)))"
    # a one-element array names what is used twice
    return f"transform(array({values}), z -> transform(array(transform({blocks}, b -> {within})), y -> {joined})[0])[0]"


def _spans(kind: str, pieces: str, found: str, check: str) -> str:
    """SQL of all matches that pass their check, from the matches and the pieces between them."""
    steps = f"transform({found}, (m, i) -> cast(length({pieces}[i]) + length(m) as bigint))"
    start = f"q[i] + length({pieces}[i])"
    struct = (
        f"named_struct('kind', '{kind}', 'start', {start}, 'end', {start} + length(m), 'value', m, "
        f"'before', if(length({pieces}[i]) > {REACH}, regexp_replace(right({pieces}[i], {REACH}), '^[^ \\\\s]+', ''), {pieces}[i]), "
        f"'after', if(length({pieces}[i + 1]) > {REACH}, regexp_replace(left({pieces}[i + 1], {REACH}), '[^ \\\\s]+$', ''), {pieces}[i + 1]))"
    )
    made = f"transform(array({_running(steps)}), q -> transform({found}, (m, i) -> {struct}))[0]"
    return f"if(size({found}) = 0, cast(array() as {_SPAN}), filter({made}, s -> {check}))"


def _matches(df: DataFrame, kind: str, pattern: Column, where: Column) -> DataFrame:
    """``df`` (text, ...) with the matches of a pattern and the pieces between them."""
    return df.withColumns({
        f"{kind}_found": F.when(where, F.regexp_extract_all("text", pattern, F.lit(0))).otherwise(F.expr("cast(array() as array<string>)")),
        f"{kind}_pieces": F.when(where, F.split("text", pattern, -1)).otherwise(F.expr("cast(array() as array<string>)")),
    })


def base_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, base) of every row: ``base`` has the checked spans of all kinds with the text around them."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    for kind, pattern in PATTERNS.items():
        rows = _matches(rows, kind, F.lit(pattern), F.contains("text", F.lit(NEEDS[kind])))
    all_kinds = ", ".join(_spans(k, f"{k}_pieces", f"{k}_found", _checks(k, "s.value")) for k in PATTERNS)
    return rows.select("doc_id", "text", F.expr(f"concat({all_kinds})").alias("base"))


def _terms(text: str | Column) -> Column:
    """The terms of a text in order, repeats included: runs of letters with A-Z in lower case, mail addresses left out."""
    column = F.col(text) if isinstance(text, str) else text
    bare = F.when(F.contains(column, F.lit("@")), F.regexp_replace(column, F.lit(PATTERNS["email"]), F.lit(" "))).otherwise(column)
    small = F.translate(bare, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(small, r"[^\p{L}\p{M}]+"), lambda w: F.length(w) >= GENERAL)


def contexts(found: DataFrame) -> DataFrame:
    """(entity, context, terms): a row for each entity in each text; the context is a hash of its terms."""
    spans = found.select(F.explode("base").alias("s"))
    entity = F.xxhash64("s.kind", F.lower("s.value"))
    terms = F.concat(_terms(F.col("s.before")), _terms(F.col("s.after")))
    return spans.select(entity.alias("entity"), terms.alias("terms")).withColumn("context", F.xxhash64("terms"))


def vocabulary(found: DataFrame) -> DataFrame:
    """(term, n) over all texts, summed in each task before the shuffle."""
    return found.select(F.explode(_terms("text")).alias("term")).groupBy("term").agg(F.count("*").alias("n"))


def disclosure(k: str, c: str, m: str, w: str) -> Column:
    """Share of an entity's information that a term gives away, from the counts named above."""
    col = lambda x: F.col(x).cast("double")
    inner = F.least(col(k) / col(c), F.lit(1.0))
    own = F.log2(col(w) / col(m))
    return F.when(own > 0, (F.log2(inner) + own) / own).otherwise(F.lit(0.0))


def disclosing_terms(found: DataFrame, threshold: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """(term, disclosure, replacement) of all terms to be sanitised, written; the replacement of one to be removed is empty.

    ``found`` is that of ``base_spans``. All joins are on terms or entities whose rows are sums already.
    """
    held = written(contexts(found), "pii-contexts")
    words = written(vocabulary(found), "pii-words")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("w"))
    around = held.groupBy("entity").agg(F.sum(F.size("terms")).alias("m"))
    near = held.select("entity", "context", F.explode("terms").alias("term"))
    pairs = near.groupBy("entity", "term", "context").agg(F.count("*").alias("k"))
    pairs = pairs.groupBy("entity", "term").agg(F.sum("k").alias("k"), F.count("*").alias("contexts"))
    pairs = written(pairs.withColumn("general", F.left("term", F.lit(GENERAL))), "pii-pairs")

    counted = pairs.filter(F.col("contexts") >= support).join(words.withColumnRenamed("n", "c"), "term").join(around, "entity")
    strong = counted.crossJoin(F.broadcast(total)).withColumn("disclosure", disclosure("k", "c", "m", "w")).filter(F.col("disclosure") >= threshold)
    strong = strong.select("entity", "term", "general", "m", "w", "disclosure")
    alike = words.groupBy(F.left("term", F.lit(GENERAL)).alias("general")).agg(F.sum("n").alias("gc"))
    alike_near = pairs.groupBy("entity", "general").agg(F.sum("k").alias("gk"))
    strong = strong.join(alike_near, ["entity", "general"]).join(alike, "general")
    general = disclosure("gk", "gc", "m", "w")
    by_term = strong.groupBy("term", "general").agg(F.max("disclosure").alias("disclosure"), F.max(general).alias("as_general"))
    replacement = F.when(F.col("as_general") < threshold, F.concat("general", F.lit("*"))).otherwise(F.lit(""))
    return written(by_term.select("term", "disclosure", replacement.alias("replacement")), "pii-terms")


def spans(docs: DataFrame, threshold: float = DISCLOSURE, support: int = SUPPORT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, base, added, replacements) of every row of ``docs``: base spans, spans of disclosing terms, and the terms' replacements."""
    found = base_spans(docs, id_col, text_col)
    terms = disclosing_terms(found, threshold, support).select("term", "replacement")
    key = F.md5(F.col("text").cast("binary"))
    told = found.select(key.alias("key"), F.explode(F.array_distinct(_terms("text"))).alias("term")).join(terms, "term")
    # the terms of one text, once for all its copies
    told = told.groupBy("key").agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct("term", "replacement")))).alias("replacements"))
    rows = found.withColumn("key", key).join(told, "key", "left").drop("key")
    some = F.col("replacements").isNotNull()
    either = F.concat(F.lit(PATTERNS["email"] + r"|(?<![\p{L}\p{M}])(?i:"), F.array_join(F.map_keys("replacements"), "|"), F.lit(r")(?![\p{L}\p{M}])"))
    rows = _matches(rows, TERM, F.coalesce(either, F.lit("a^")), some)
    added = _spans(TERM, f"{TERM}_pieces", f"{TERM}_found", "not contains(s.value, '@')")
    return rows.select("doc_id", "text", "base", F.expr(added).alias("added"), "replacements")


def listed(array: str) -> Column:
    """Spans as text: kind:start:end, joined by commas, in their order."""
    return F.array_join(F.transform(array, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def counted(array: str, kind: str) -> Column:
    return F.size(F.filter(array, lambda s: s["kind"] == kind)).cast("long")


def sanitised(rows: DataFrame) -> DataFrame:
    """``rows`` of ``spans`` with ``clean``, the text in which entities stand as their kind and terms as their replacement.

    Where spans overlap, the first (the longer of two that start together) names the whole stretch.
    """
    lower = "translate(s.value, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    label = f"if(s.kind = '{TERM}', replacements[{lower}], concat('[', upper(s.kind), ']'))"
    ordered = f"array_sort(transform(concat(base, added), s -> named_struct('start', s.start, 'back', -s.end, 'label', {label})))"
    put = (
        "if(s.start >= a.at, named_struct('at', -s.back, 'out', array_append(array_append(a.out, substring(text, int(a.at) + 1, int(s.start - a.at))), s.label)),"
        " named_struct('at', greatest(a.at, -s.back), 'out', a.out))"
    )
    parts = f"aggregate({ordered}, named_struct('at', 0L, 'out', cast(array() as array<string>)), (a, s) -> {put})"
    rest = f"transform(array({parts}), a -> array_join(array_append(a.out, substring(text, int(a.at) + 1)), ''))[0]"
    return rows.withColumn("clean", F.expr(f"if(size(base) + size(added) = 0, text, {rest})"))
