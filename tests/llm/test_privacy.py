"""Personal data: base spans and disclosing terms against plain loops, and odd inputs."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest

from footfall.llm import privacy, queries

SF = "/root/testdata/sf0.001"
# the plain patterns that define the base spans
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
MAIL = "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+"


def luhn(digits):
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def good(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    return kind == "email" or (kind == "card" and 16 <= len(digits) <= 19 and luhn(digits)) or (kind == "phone" and 8 <= len(digits) <= 15)


def plain_spans(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if good(k, m[0])]


def base_of(rows):
    return [[(s.kind, s.start, s.end) for s in r.base] for r in rows]


def random_text(rng):
    part = lambda: rng.choice([
        "a@b.c", "x.y@z", "@", ".", "+", "-", " ", "  ", "é", "日", "\n", "0", "255", "256", "007", "1.2.3.4", "4111 1111 1111 1111", "5500-0000-0000-0004",
        "+1 (415) 555-0000", "+49 30 12", "12345678901234567890", "%", "_", "mail@x-y.org", "q", "(", ")", "1234567890123452", "999.1.1.1",
    ])
    return "".join(part() for _ in range(rng.randrange(1, 40)))


def test_base_spans_of_random_texts(docs_of):
    rng = random.Random(3)
    texts = [random_text(rng) for _ in range(1500)]
    rows = privacy.base_spans(docs_of(texts)).collect()
    assert sum(len(r.base) for r in rows) > 1000
    for r in rows:
        assert [(s.kind, s.start, s.end) for s in r.base] == plain_spans(r.text)
        assert all(r.text[s.start : s.end] == s.value for s in r.base)


def test_base_spans_of_long_texts(docs_of):
    """Runs that a plain search would take quadratic time for, with the spans they must give."""
    many = [f"10.0.{i % 256}.{i % 300}" for i in range(3000)]
    at = [0]
    for m in many:
        at.append(at[-1] + len(m) + 1)
    ips = [("ip", a, a + len(m)) for m, a in zip(many, at) if int(m.rpartition(".")[2]) < 256]
    domain = "a@" + "b." * 100_000 + "c"
    cases = {
        "x" * 300_000: [], "1" * 300_000: [], "a." * 100_000: [], domain: [("email", 0, len(domain))], "+" + "1 " * 50_000: [],
        "1 " * 100_000: [], "+" * 50_000: [], "@" * 50_000: [], " ".join(many) + " u@v.w": [("email", at[-1], at[-1] + 5), *ips],
    }
    for r in privacy.base_spans(docs_of(list(cases), partitions=9)).collect():
        assert [(s.kind, s.start, s.end) for s in r.base] == cases[r.text]


def told(text):
    """Terms of a text with their places, mail addresses left out."""
    return [(m[0].translate(LOWER), m.start(), m.end()) for m in re.finditer(f"{MAIL}|[^\\W\\d_]+", text) if "@" not in m[0]]


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(texts):
    """Disclosure of every (entity, term) as the module's text defines it, and what the terms become."""
    word = lambda t: [w for w, _, _ in told(t) if len(w) >= 3]
    c, general_c = Counter(), Counter()
    for t in texts:
        c.update(word(t))
    for w, n in c.items():
        general_c[w[:3]] += n
    m, k, seen, general_k = Counter(), Counter(), defaultdict(set), Counter()
    for t in texts:
        for kind, p in PLAIN.items():
            found = list(re.finditer(p, t))
            edges = [0, *(x for f in found for x in (f.start(), f.end())), len(t)]
            for i, f in enumerate(found):
                if not good(kind, f[0]):
                    continue
                before, after = t[edges[2 * i] : f.start()], t[f.end() : edges[2 * i + 3]]
                if len(before) > 80:
                    before = re.sub(r"^[^ \s]+", "", before[-80:])
                if len(after) > 80:
                    after = re.sub(r"[^ \s]+$", "", after[:80])
                near, entity = word(before) + word(after), (kind, f[0].lower())
                m[entity] += len(near)
                for w in near:
                    k[entity, w] += 1
                    general_k[entity, w[:3]] += 1
                    seen[entity, w].add(tuple(near))
    total = sum(c.values())

    def disclosure(k, c, m):
        own = math.log2(total / m)
        return (math.log2(min(k / c, 1)) + own) / own if own > 0 else 0.0

    out = {}
    for (e, w), n in k.items():
        d = disclosure(n, c[w], m[e])
        if len(seen[e, w]) >= 3 and d >= 0.9:
            g = disclosure(general_k[e, w[:3]], general_c[w[:3]], m[e])
            best, general = out.get(w, (0, 0))
            out[w] = max(best, d), max(general, g)
    return {w: (d, f"{w[:3]}*" if g < 0.9 else "") for w, (d, g) in out.items()}


@pytest.fixture(scope="module")
def telling():
    """Texts in which a name stands beside one address in several contexts, and words that stand anywhere."""
    rng = random.Random(5)
    common = "the of and to in that with from this where about which people often marker market".split()
    say = lambda n: " ".join(rng.choice(common) for _ in range(n))
    texts = [say(60) for _ in range(150)]
    for i in range(6):
        texts.append(f"{say(30)} Write to Marwenna Quillfeather at mq.{7}@mail.example.com {say(20)}")
        texts.append(f"{say(12)} call Zorblatt, +1 (415) 555-0000 {say(i)}")
    texts += ["Here quillfeather is named alone, and nobody else.", "copies tell Onlyonce b@c.de alike"]
    return texts + ["copies tell Onlyonce b@c.de alike"] * 8


def test_terms_by_definition(docs_of, telling):
    found = privacy.base_spans(docs_of(telling))
    rows = {r.term: (r.disclosure, r.replacement) for r in privacy.disclosing_terms(found).collect()}
    want = plain_terms(telling)
    assert set(rows) == set(want) and {"marwenna", "quillfeather", "zorblatt"} <= set(rows)
    assert not {"the", "onlyonce", "copies"} & set(rows)  # common words, and a single context however often it is copied
    for w, (d, replacement) in want.items():
        assert rows[w][0] == pytest.approx(d) and rows[w][1] == replacement
    assert rows["marwenna"][1] == "mar*" and rows["zorblatt"][1] == ""


def test_spans_and_clean_texts(docs_of, telling):
    terms = plain_terms(telling)
    rows = privacy.sanitised(privacy.spans(docs_of(telling))).collect()
    assert len(rows) == len(telling)
    for r in rows:
        want = [("term", a, b) for w, a, b in told(r.text) if w in terms]
        assert [(s.kind, s.start, s.end) for s in r.added] == want
        clean, at = [], 0
        for kind, a, b in sorted(plain_spans(r.text) + want, key=lambda s: (s[1], -s[2])):
            if a >= at:
                clean += [r.text[at:a], terms[r.text[a:b].translate(LOWER)][1] if kind == "term" else f"[{kind.upper()}]"]
            at = max(at, b)
        assert r.clean == "".join(clean) + r.text[at:]
        assert not any(w in terms for w, _, _ in told(r.clean) if len(w) >= 3)


def test_query_columns_and_values(spark):
    rows = queries.RUNS["op11_pii"](spark, SF)
    assert rows.dtypes == [("doc_id", "bigint"), *((f"n_{k}", "bigint") for k in PLAIN), ("base_sha256", "string"), ("spans", "string")]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = rows.collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        base = plain_spans(texts[r.doc_id])
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in base) for kind in PLAIN]
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert r.spans.startswith(said) and all(s.startswith("term:") for s in r.spans[len(said) :].strip(",").split(",") if s)


def test_odd_and_empty_input(odd_docs, no_docs):
    rows = privacy.sanitised(privacy.spans(odd_docs)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.clean) for r in rows) == sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in odd_docs.collect())
    assert all(not r.base and not r.added for r in rows)
    assert privacy.spans(no_docs).count() == 0


def test_no_python_in_the_plan(docs_of, telling):
    plan = privacy.spans(docs_of(telling))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
