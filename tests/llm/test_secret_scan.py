import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from creditspark.llm import secret_scan as S

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)


def base_spans(text):
    """Matches by the declared patterns in the whole text, without any index."""
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def every_span(text):
    out = base_spans(text)
    for k, rule in enumerate(S.FURTHER, 3):
        out += [(m.start(), k, rule.kind, m.end()) for m in re.finditer(rule.pattern, text)]
    return sorted(out)


def joined(found):
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in found)


def check(df):
    out = S.report(df)
    assert out.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    want = []
    for r in df.select("doc_id", "text").collect():
        base = base_spans(r.text or "")
        counts = [sum(k == n for _, k, *_ in base) for n in range(3)]
        want.append((r.doc_id, *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(every_span(r.text or ""))))
    got = [tuple(r) for r in out.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    return got


def test_whole_table_against_plain_matching(spark):
    got = check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))  # the smaller table has none
    assert sum(r[1] + r[2] + r[3] for r in got) > 0


KEY = "0123456789abcdef" * 2


def planted():
    return [
        "PassWord = 'hunter2.x'", "token=abc", "token=abcdef", "api_key: \"ABCDEF12\"", "apikey=ABCDEFG", "API_KEY=xyzxyz", "paſsword=abcdefgh", "toKen=abcdefgh",
        "AKIA" + "Z9" * 8, "AKIA" + "Z" * 15, "akia" + "Z" * 20, f"é{KEY}ü", "a" * 23, "a" * 24, KEY.upper(), "secret: \n abcdefgh", "secret==abcdef", "passwd'  :  'aaaaaa'",
        "-----BEGIN RSA PRIVATE KEY-----\nabc", "-----BEGIN PRIVATE KEY-----", "-----BEGIN CERTIFICATE-----", "ghp_" + "a1" * 18, "xoxb-" + "1a" * 12,
        "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSMeK", "AIza" + "b" * 35, "sk_live_" + "c" * 16, "postgres://user:passw0rd@host.example", "see https://example.com/a:b for the token of thanks",
        f"secret={KEY}", f"token = AKIA{'Q' * 16}", "to", "ken=abcdefg",
    ]


def test_planted_secrets(spark):
    rows = [(k, f"some words {x} and more") for k, x in enumerate(planted())]
    got = {r[0]: r for r in check(spark.createDataFrame(rows, "doc_id long, text string"))}
    kinds = "".join(r[-1] for r in got.values())
    assert all(r.kind + ":" in kinds for r in S.BASE + S.FURTHER)


def test_hard_rows(spark):
    rng = random.Random(1)
    long = " ".join(rng.choice(["word", "tok", "en", "password", "face", "=", ":"]) for _ in range(400_000)) + " token=abcdefgh " + KEY
    rows = [(1, None), (2, ""), (None, "token=abcdef"), (3, long), (3, "token=abcdef"), (3, "token=abcdef"), (4, "é" * 1000 + "secret:abcdefg" + "日" * 10)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("found", F.lit("x")).withColumn("spans", F.lit(1)).withColumn("kind", F.lit(0))
    check(df)
    assert S.report(df.limit(0)).count() == 0


def holds(query, text):
    if query is True:
        return True
    if isinstance(query, bytes):
        return query in text.encode().lower()
    return (any if query[0] == "or" else all)(holds(q, text) for q in query[1])


@pytest.mark.parametrize("rule", S.BASE + S.FURTHER, ids=lambda r: r.kind)
def test_queries_hold_for_every_match(rule):
    query = S.trigram_query(rule.pattern)
    assert (query is True) == (rule.kind == "hex")
    for text in planted():
        if re.search(rule.pattern, text):
            assert holds(query, text)
    assert query is True or not holds(query, "plain prose about nothing in particular")


@pytest.mark.parametrize("seed", range(200))
def test_queries_of_random_patterns_miss_no_match(seed):
    rng = random.Random(seed)

    def pattern(depth=0):
        kind = rng.randrange(8 if depth < 3 else 3)
        if kind < 3:
            return "".join(rng.choice("abAé") for _ in range(rng.randrange(1, 5)))
        if kind == 3:
            return "[ab]" if rng.random() < 0.5 else "[a-z]"
        if kind == 4:
            return f"(?:{pattern(depth + 1)}|{pattern(depth + 1)})"
        if kind == 5:
            return f"(?:{pattern(depth + 1)}){rng.choice(['?', '*', '+', '{2}', '{1,3}'])}"
        if kind == 6:
            return f"(?ai:{pattern(depth + 1)})"
        return pattern(depth + 1) + pattern(depth + 1)

    rule = pattern() + pattern()
    query = S.trigram_query(rule)
    texts = ["".join(rng.choice("abABé") for _ in range(rng.randrange(14))) for _ in range(300)]
    segment = S.Segment([t.encode() for t in texts], sorted(S._named(query)) or [b"zzz"])
    candidates = set(segment.holds(query).tolist())
    assert candidates == {k for k, t in enumerate(texts) if holds(query, t)}
    assert all(k in candidates for k, t in enumerate(texts) if re.search(rule, t))
