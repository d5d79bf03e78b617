"""Spans against Python's regular expressions, revealing terms against plain counting, masking, odd tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from obsframe.llm import pii
from tests.conftest import SMALL


def digits(s):
    return [int(c) for c in s if c in "0123456789"]


def luhn(s):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(digits(s)[::-1])) % 10 == 0


PLAIN = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(m)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
)


def brute(text):
    """[(kind, start, stop)] by the plain patterns."""
    return [(k, m.start(), m.end()) for k, p, ok in PLAIN for m in re.finditer(p, text or "") if ok(m[0])]


ODD = [
    None, "", "+1 (017) 555-7713 a@b.c_d@e.f x@y.z", "999.2.3.4.5.6.7 1.2.3.4.5.6.7.8 0001.002.3.255 256.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-11115 41111111111111111111", "1 " * 5000, "a" * 20_000 + "@", "1." * 6000,
    "\U0001f600\U0001f600 a@b.co é 10.0.0.1 4111111111111111", "+1+12345678901 +123 456 789)9 .+(", "a@b.c@d.e.f",
    "..@a..b@c.d", "12-34 5678--9012 3456 4111  1111", "٣٤@x.y 4111 1111 1111 1111-", "\n+12 345 678 901\n1.1.1.1",
    "4222222222222 x 6304000000000000 00 y 0000000000000",
]


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_base_spans(spark):
    df = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    base = pii._joined(F.concat(*pii.KINDS)).alias("base")
    got = {r.doc_id: r.base for r in pii.find_spans(df).select("doc_id", base).collect()}
    assert got == {i: joined(brute(t)) for i, t in enumerate(ODD)}


def test_query_is_native(spark):
    found = pii.op9_pii(spark, SMALL)
    assert not re.search("Python|Arrow|Pandas", found._jdf.queryExecution().executedPlan().toString())
    got = {r.doc_id: r for r in found.collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        spans, r = brute(d.text), got[d.doc_id]
        n = Counter(k for k, _, _ in spans)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(n[k] for k in pii.KINDS)
        assert r.base_sha256 == hashlib.sha256(joined(spans).encode()).hexdigest()
        assert r.spans.startswith(joined(spans))


def slow_terms(rows, reach=None, support=3, generalise_at=0.6, remove_at=0.9, near=48, chance=0.5):
    """{(doc_id, start, stop): kind} by counting pairs in plain loops."""
    n, df, holders = len(rows), Counter(), defaultdict(set)
    placed, spans = {}, {}
    for d, text in rows:
        df.update({w.lower() for w in re.findall(r"[^\W_]+", text)})
        spans[d] = [(k, a, b, (k, text[a:b].lower())) for k, a, b in brute(text)]
        for *_, entity in spans[d]:
            holders[entity].add(d)
        words = [(m[0].lower(), m.start(), m.end()) for m in re.finditer(r"[^\W_]+", text)]
        free = lambda s, e: not any(a < e and s < b for _, a, b, _ in spans[d])  # noqa: B023, E731
        placed[d] = [w for w in words if len(w[0]) >= 3 and free(*w[1:])]
    groups = defaultdict(set)
    for entity, held in holders.items():
        groups[frozenset(held) if reach is None else entity].add(entity)

    def beside(d, members, far):
        at = [(a - far, b + far) for _, a, b, e in spans[d] if e in members]
        return [w for w, s, e in placed[d] if any(s < b and e > a for a, b in at)]

    tells, close, terms = {}, {}, {}
    for g, members in groups.items():
        held = holders[next(iter(members))]
        content = math.log2(n / len(held))
        for d in held:
            terms[d] = [w for w, _, _ in placed[d]]
            tells[d, g] = {w for w in terms[d] if content > 0 and math.log2(n / df[w]) >= generalise_at * content - 1e-9}
            close[d, g] = beside(d, members, near)
    elsewhere = {dg: len(terms[dg[0]]) - len(close[dg]) for dg in tells}
    others = {(d, g): sum(w in tells[d, g] for w in terms[d]) - sum(w in tells[d, g] for w in close[d, g]) for d, g in tells}
    share = sum(others.values()) / max(sum(elsewhere.values()), 1)
    mixed = {dg: (others[dg] + pii.PRIOR_WORDS * share) / (elsewhere[dg] + pii.PRIOR_WORDS) for dg in tells}
    apart = {dg for dg in tells if len(close[dg]) * mixed[dg] <= chance}

    def ratio(k, a, b):
        cells = [(k, a, b), (a - k, a, n - b), (b - k, n - a, b), (n - a - b + k, n - a, n - b)]
        return 2 * sum(o * math.log(o * n / (x * y)) for o, x, y in cells if o > 0)

    out = {}
    for g, members in groups.items():
        held = holders[next(iter(members))]
        seen = {d: tells[d, g] & set(beside(d, members, reach) if reach is not None else terms[d]) for d in held}
        content = math.log2(n / len(held))
        for w in set().union(*seen.values()):
            k = sum(w in s for s in seen.values())
            if not (ratio(k, len(held), df[w]) >= pii.EVIDENCE if k >= support else any(w in seen[d] and w in close[d, g] and (d, g) in apart for d in held)):
                continue
            shared = math.log2(n * min(k / support, 1) * k / (len(held) * df[w]))
            kind = "remove" if shared >= remove_at * content else "generalise" if shared >= generalise_at * content else None
            for d in held if kind else ():
                for x, s, e in placed[d]:
                    if x == w and w in tells[d, g]:
                        out[d, s, e] = max(kind, out.get((d, s, e), ""))
    return out


def corpus():
    rows = [(i, f"agent falcon writes to f@x.org about plans {i} today") for i in range(5)]
    rows += [(10 + i, f"agent mills says call +1 555 123 4567{'.' * (i % 2)} about plans") for i in range(4)]
    rows += [(20 + i, f"nothing private here, only plans number {i} and an agent") for i in range(40)]
    return rows + [(70, "falcon seen once more"), (71, "mills 1.2.3.4 falcon f@x.org 5555555555554444")]


def test_revealing_terms(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string")
    got = {}
    for r in pii.find_spans(df, reach=24).collect():
        got |= {(r.doc_id, s.start, s.stop): s.kind for s in r.terms}
    want = slow_terms(corpus(), 24)
    assert got == want and {"remove", "generalise"} <= set(want.values())


def test_entities_of_one_document(spark):
    rows = [(1, "zorvath asks for plans by f@x.org"), (2, "mellin asks for plans by g@x.org"), (3, "mellin of plans by g@x.org")]
    rows += [(10 + i, "someone asks for plans by post") for i in range(97)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, s.start, s.stop) for r in pii.find_spans(df).collect() for s in r.terms}
    assert {(1, 0, 7), (2, 0, 6), (3, 0, 6)} <= got
    common = [(i, m.start(), m.end()) for i, t in rows for m in re.finditer("asks|for|plans", t)]
    assert not got & set(common)


def prose(rng, n, rare=0.0):
    """Words of which a few are common; ``rare`` of them occur once."""
    plain = [f"{a}{b}" for a in ("ral", "mon", "tis", "vel", "dor") for b in ("an", "eth", "ix", "umo", "ra", "sel")]
    return " ".join(f"odd{rng.randrange(10**9)}x" if rng.random() < rare else rng.choice(plain) for _ in range(n))


def found_by(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return {(r.doc_id, s.start, s.stop): s.kind for r in pii.find_spans(df, **options).collect() for s in r.terms}


def test_whole_documents_as_counted(spark):
    rng = random.Random(4)
    rows = [(i, f"{prose(rng, 30, 0.05)} {rng.choice(['a@b.co', 'c@d.ef', ''])} zor{i % 7} {prose(rng, 20)} {'10.0.0.%d' % (i % 9) if i % 3 else ''}") for i in range(60)]
    rows += [(100 + i, prose(rng, 25, 0.02)) for i in range(200)]
    for options in ({}, {"near": 10, "chance": 2.0}, {"reach": 30, "support": 2}):
        got, want = found_by(spark, rows, **options), slow_terms(rows, **options)
        assert got == want
    assert want


def test_planted_names(spark):
    """Names beside addresses are found, ordinary rare words are left: precision and recall."""
    rng = random.Random(9)
    rows, names = [], set()
    for i in range(300):
        if i % 5:
            rows.append((i, prose(rng, 80, 0.02)))
            continue
        head, name = prose(rng, 40, 0.02), f"Name{i}son"
        names.add((i, len(head) + 1, len(head) + 1 + len(name)))
        rows.append((i, f"{head} {name} writes from p{i}@mail.org {prose(rng, 40, 0.02)}"))
    got = set(found_by(spark, rows))
    assert len(got & names) / len(names) >= 0.95 and len(got & names) / len(got) >= 0.8
    # where rare words are as common elsewhere, standing near tells nothing
    dense = [(i, f"{prose(rng, 40, 0.3)} Name{i}son p{i}@mail.org {prose(rng, 40, 0.3)}") for i in range(60)]
    dense += [(100 + i, prose(rng, 80, 0.3)) for i in range(300)]
    assert found_by(spark, dense) == {}


def test_terms_far_from_the_entity(spark):
    far = "plain words that keep their distance from anything private, " * 3
    rows = [(i, f"f@x.org {far} falcon and {far} falcon {i}") for i in range(5)] + [(9, f"falcon f@x.org {far} falcon")]
    rows += [(10 + i, far) for i in range(60)] + [(90, "falcon seen once more")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {(i, m.start(), m.end()) for i, t in rows for m in re.finditer("falcon", t) if i < 10}
    got = {(r.doc_id, s.start, s.stop) for r in pii.find_spans(df).collect() for s in r.terms}
    assert want <= got and not {i for i, _, _ in got} - set(range(10))
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert not any("falcon" in clean[i] for i in (0, 1, 2, 3, 4, 9)) and "falcon" in clean[90]


def test_masks(spark):
    rows = [(1, "mail a@b.co, call +1 555 123 4567 or 10.0.0.1!", 1), (2, None, 5), (3, "plain", 9), (4, "+4111 1111 1111 1111 1", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars int")
    got = {r.doc_id: r for r in pii.sanitise(df).collect()}
    assert got[1].text == "mail [EMAIL], call [PHONE] or [IP]!" and got[1].n_chars == len(got[1].text)
    assert (got[2].text, got[2].n_chars, got[3].text) == ("", 0, "plain")
    again = {r.doc_id: r.text for r in pii.sanitise(spark.createDataFrame([(i, t) for i, t in corpus()], "doc_id long, text string"), reach=24).collect()}
    assert all("f@x.org" not in t and "555" not in t for t in again.values())
    assert "falcon" not in again[0] and again[70] == "falcon seen once more" and again[20] == corpus()[9][1]


def test_odd_tables(spark):
    rows = [(1, "a@b.co", "x"), (1, "a@b.co", "x"), (None, "a@b.co", "y"), (None, None, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string")
    got = pii.find_spans(df).collect()
    assert len(got) == 4 and sum(len(r.email) for r in got) == 3
    assert len(pii.sanitise(df).collect()) == 4 and pii.sanitise(df).columns == df.columns
    empty = df.limit(0)
    assert pii.find_spans(empty).collect() == [] and pii.sanitise(empty).collect() == []
