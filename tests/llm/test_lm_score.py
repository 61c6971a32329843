import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from creditspark.llm import lm_score as S


def test_scores_tell_good_from_bad(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    # learned from half of the good, tried on the rest
    rows = S.cross_entropy_difference(docs, labels.where("quality = 1 and doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id").where("score is not null").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    auc = sum((g < b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.85


def by_count(rows, wanted, least):
    """(doc_id, words, losses) where words and pairs of ``least`` occurrences in either corpus are kept."""
    uni = [Counter(), Counter()]
    split = [(i, (t or "").split()) for i, t in rows]
    for i, words in split:
        for m in (0, 1):
            if m or i in wanted:
                uni[m].update(words)
    vocab = {w for w in uni[1] if any(uni[m][w] >= least for m in (0, 1))}
    ids = [(i, [w if w in vocab else 0 for w in words]) for i, words in split]
    mapped, pair = [Counter(), Counter()], [Counter(), Counter()]
    for i, words in ids:
        for m in (0, 1):
            if m or i in wanted:
                mapped[m].update(words)
                pair[m].update(zip([1, *words], words))
    kept = {p for p in pair[1] if any(pair[m][p] >= least for m in (0, 1))}
    followed, taken = ([Counter(), Counter()] for _ in range(2))
    for p in kept:
        for m in (0, 1):
            followed[m][p[0]] += pair[m][p]
            taken[m][p[0]] += max(pair[m][p] - 0.75, 0)

    def loss(m, v, w):
        base = (mapped[m][w] + 1) / (sum(mapped[m].values()) + len(vocab) + 1)
        context = max(1, mapped[m][v], followed[m][v])
        own = max(pair[m][v, w] - 0.75, 0) / context if (v, w) in kept else 0
        return -math.log(own + (1 - taken[m][v] / context) * base)

    known = {p: (loss(0, *p), loss(1, *p)) for p in pair[1]}
    return [
        (i, len(words), *([sum(known[p][m] for p in zip([1, *words], words)) / len(words) for m in (0, 1)] if words else (None, None)))
        for i, words in ids
    ]


def check_by_count(spark, rows, wanted, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("k", F.lit("x"))
    out = S.cross_entropy_difference(df, spark.createDataFrame([(w,) for w in wanted], "doc_id long"), **options)
    got = sorted(map(tuple, out.collect()), key=repr)
    want = sorted(by_count(rows, set(wanted), options.get("min_count", S.MIN_COUNT)), key=repr)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:2] == w[:2]
        assert g[2:] == (pytest.approx((w[2], w[3], w[2] - w[3]), rel=1e-9, abs=1e-9) if w[1] else (None, None, None))


@pytest.mark.parametrize("common", [0, 500, S.COMMON])
def test_every_word_and_pair_with_the_count_is_kept(spark, sf, common):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    good = [r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").collect()]
    check_by_count(spark, rows, good, common=common)


@pytest.mark.parametrize("wanted", [[1, 2, 2, 77], []])
def test_hard_rows_by_count(spark, wanted):
    rows = [(1, "a b a b c"), (2, "a b"), (2, "a b"), (3, None), (4, ""), (5, " \n "), (None, "a x"), (6, "x y " * 30_000), (7, "é　日本\xa0a\x1cb"), (8, "only1 only2")]
    check_by_count(spark, rows, wanted)
    check_by_count(spark, rows, wanted, min_count=1, common=2)
    empty = spark.createDataFrame([], "doc_id long")
    assert S.cross_entropy_difference(spark.createDataFrame([], "doc_id long, text string"), empty).count() == 0
