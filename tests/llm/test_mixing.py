import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from creditspark.llm import mixing as M


def n_words(text):
    return len((text or "").encode().split())


def totals_of(rows):
    out = defaultdict(lambda: [0, 0])
    for r in rows:
        out[r.source][0] += 1
        out[r.source][1] += n_words(r.text)
    return out


def check(df, whole=False, budget=None, **goal):
    """Every source gets its due, pass by pass, in gapless permutations, and stops within the budget."""
    rows = df.select("doc_id", "text", "source").collect()
    totals = totals_of(rows)
    filled = {s: t for s, (_, t) in totals.items() if t}
    alpha = M.exponent(M.source_totals(M.sized(df)), **(goal or {"repeat_limit": 2.0}), whole=whole)
    z = sum(t**alpha for t in filled.values())
    due = {s: (t**alpha * max(x ** (1 - alpha) for x in filled.values()) if whole else t**alpha / z * (budget or sum(filled.values()))) for s, t in filled.items()}
    got = M.mix(df, whole=whole, budget=budget, **goal).collect()
    by = defaultdict(list)
    for r in got:
        by[r.source, r["pass"]].append(r)
    of_source = defaultdict(Counter)
    for r in rows:
        of_source[r.source][r.doc_id, n_words(r.text)] += 1
    for s, (n, t) in totals.items():
        passes = int(round(due[s])) // t if t else 0
        rest = round(due[s]) - passes * t if t else 0
        for p in range(passes + 1):
            part = sorted(by.pop((s, p), []), key=lambda r: (r.offset, r.n_tokens))
            at = 0
            for r in part:
                assert r.offset == at
                at += r.n_tokens
            have = Counter((r.doc_id, r.n_tokens) for r in part)
            if p < passes:
                assert have == of_source[s]
            else:
                assert at <= rest and not have - of_source[s]
                left = of_source[s] - have
                assert not left or at + max(k[1] for k in left) > rest
    assert not by
    return alpha, due, filled, got


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    alpha, due, filled, _ = check(docs)
    assert 0 <= alpha <= 1 and max(due[s] / t for s, t in filled.items()) <= 2 + 1e-6
    alpha, due, filled, got = check(docs, whole=True, repeat_limit=1.5)
    assert {r.doc_id for r in got} == {r.doc_id for r in docs.collect()}
    assert abs(max(due[s] / t for s, t in filled.items()) - 1.5) < 1e-6 or alpha == 0


def test_entropy_and_order(spark):
    rows = [(i, "w " * (5 + i % 7), "big" if i % 10 else f"s{i % 3}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    alpha, due, filled, got = check(df, entropy=0.9)
    z = sum(due.values())
    h = -sum(d / z * math.log(d / z) for d in due.values())
    assert abs(h - 0.9 * math.log(len(due))) < 1e-5
    ordered = sorted(got, key=lambda r: r.at)
    half = Counter()
    for r in ordered:
        if r.at < 0.5:
            half[r.source] += r.n_tokens
    assert all(abs(half[s] - due[s] / 2) <= 24 for s in due)
    assert max(Counter((r.source, r["pass"], r.block) for r in got).values()) < 300  # no block near a source's size
    assert [r.doc_id for r in got if r["pass"] == 0 and r.source == "s0"] != [r.doc_id for r in got if r["pass"] == 1 and r.source == "s0"]


def test_hard_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "x y", None), (3, "x y", None), (None, "z", "a"), (4, "w " * 50_000, "a"), (5, "", "empty"), (6, None, "empty")]
    rows += [(10 + i, "a b c", "c") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("tokens", F.lit(1)).withColumn("g", F.lit("x")).withColumn("pass", F.lit(0))
    check(df)
    check(df, whole=True)
    check(df, budget=30)
    kept = M.mix(df, whole=True, repeat_limit=1.0, carry=True)
    assert kept.columns == df.columns
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, df.collect()))
    assert M.mix(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        M.exponent(M.source_totals(M.sized(df)))


def test_no_python_in_the_plan(spark, sf):
    plan = M.mix(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
