"""Personal data: base spans against plain regular expressions, checks, context, odd rows."""

import hashlib
import random
import re

import pytest

from kmstream.llm import personal
from kmstream.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def passes(kind, s):
    digits = [int(c) for c in s if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        odd = digits[-1::-2]
        even = [sum(divmod(2 * d, 10)) for d in digits[-2::-2]]
        return 13 <= len(digits) <= 19 and (sum(odd) + sum(even)) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS for m in re.finditer(p, text or "") if passes(k, m[0])]


def base(text):
    return [s[:3] for s in personal.SpanFinder().spans(text) if s[0] in personal.BASE_KINDS]


def test_base_spans_match_plain_patterns_on_random_texts():
    rng = random.Random(3)
    for size in (12, 40, 120):
        for _ in range(4000):
            text = "".join(rng.choice("19025.@+- ()ax_%é\n") for _ in range(size))
            assert base(text) == brute(text), text
    for text in ("a@b.c@d.e@f", "x@a.b@c.d@e.f", "1.2.3.4.5.6.7.8", "256.1.1.1.9", "0000255.1.1.1", "4111 1111-1111 1111", "+1 (743) 555-3824", "@a.b", ""):
        assert base(text) == brute(text), text


def test_long_runs_stay_linear():
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+1" + " " * 200_000, "9" * 5000 + ".1.1.1"):
        personal.SpanFinder().spans(text)


def test_validators():
    assert personal.luhn("4111111111111111") and not personal.luhn("4111111111111112")
    assert personal.mod97("GB82WEST12345698765432") and not personal.mod97("GB82WEST12345698765431")


@pytest.mark.parametrize("text,kind,found", [
    ("pay to DE89 3704 0044 0532 0130 00 TODAY", "iban", ["DE89 3704 0044 0532 0130 00"]),
    ("pay to DE89 3704 0044 0532 0130 01 today", "iban", []),
    ("social security 078-05-1120.", "ssn", ["078-05-1120"]),
    ("parts 078-05-1120.", "ssn", []),
    ("social security 000-05-1120.", "ssn", []),
    ("call me: (743) 555-3824", "national", ["(743) 555-3824"]),
    ("call me: +1 (743) 555-3824", "national", []),
    ("item (743) 555-3824", "national", []),
    ("née le 29.02.2000 à", "birth", ["29.02.2000"]),
    ("née le 29.02.2001 à", "birth", []),
    ("on 1999-12-31 it", "birth", []),
])
def test_context_and_checks_decide_on_other_kinds(text, kind, found):
    assert [text[a:b] for k, a, b, _ in personal.SpanFinder().spans(text) if k == kind] == found


def test_context_moves_scores_of_base_spans_but_never_drops_them():
    low, mid, high = (personal.SpanFinder().spans(f"{w} 10.0.0.1")[0][3] for w in ("version", "the", "server"))
    assert low < mid < high
    assert personal.PersonalRules(least=2.0) and len(personal.SpanFinder(personal.PersonalRules(least=2.0)).spans("version 10.0.0.1")) == 1


def test_odd_rows(spark):
    rows = [(1, None, "x"), (None, "", "x"), (2, "é mail a@b.cd", "x"), (2, "é mail a@b.cd", "x"), (3, "word " * 200_000 + "a@b.cd", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    out = personal.span_digest(personal.personal_data(df)).collect()
    assert sorted((r["doc_id"] or 0, r["spans"]) for r in out) == [
        (0, ""), (1, ""), (2, "email:7:13"), (2, "email:7:13"), (3, "email:1000000:1000006")]
    assert personal.span_digest(personal.personal_data(df.limit(0))).count() == 0
    clean = df.select(personal.redacted(df["text"], personal.personal_spans(df["text"])).alias("t")).collect()
    assert [r["t"] for r in clean][:3] == [None, "", "é mail <email>"]


def test_query_against_plain_patterns(spark):
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op13_personal_data"](spark, SF).collect()
    assert len(rows) == len(text)
    for r in rows:
        want = brute(text[r["doc_id"]])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k, _ in PATTERNS] == [sum(w[0] == k for w in want) for k, _ in PATTERNS]
        assert r["spans"].startswith(joined)
