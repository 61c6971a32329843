import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditspark.llm import queries
from creditspark.llm import top_k as T


def brute(rows, asked, k=10):
    def ready(rs):
        keep = {(i, tuple(math.floor(1024.0 * x) for x in v)) for i, v in rs if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
        return sorted(keep)

    out = []
    for q, v in ready(asked):
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ready(rows) if i != q and len(w) == len(v))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("blocks", [(1024, 8192), (2, 60)])
def test_whole_table(spark, sf, blocks):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert got(T.top_k(df, df.where("vec_id % 100 = 0"), query_block=blocks[0], block=blocks[1])) == brute(rows, [r for r in rows if r[0] % 100 == 0])


def test_query_has_the_contract_s_columns(spark, sf):
    df = queries.QUERIES["op3_exact_top_k"](spark, sf)
    assert df.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]


def test_hard_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(i, [0.5, -0.25, 0.125]) for i in range(300)] + [(300 + i, [math.sin(i), math.cos(i), i / 100.0]) for i in range(200)]
    rows += [(0, [0.5, -0.25, 0.125]), (600, None), (601, [None, 1.0, 1.0]), (602, [nan, 0.0, 0.0]), (603, [inf, 0.0, 0.0]), (None, [9.0, 9.0, 9.0])]
    rows += [(700, [1.0]), (701, [2.0]), (800, []), (801, []), (900, [3e12, -3e12, 1.0]), (901, [1e9, 1.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x")).withColumn("qb", F.lit(1))
    small = [r for r in rows if r[0] not in (900,)]
    for part, data in ((df.where("vec_id is null or vec_id <> 900"), small),):
        asked = [r for r in data if r[0] is not None and r[0] % 100 == 0]
        for block in (8192, 50):
            assert got(T.top_k(part, part.where("vec_id % 100 = 0"), block=block, query_block=3)) == brute(data, asked)
    assert T.top_k(df.limit(0), df).count() == 0 and T.top_k(df, df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_bounds_hold_and_pruning_keeps_the_best(seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(-500, 500, (400, 8)) * (rng.random((400, 1)) < 0.3 + seed / 5) + rng.integers(-3, 3, (400, 8))
    q = rng.integers(-500, 500, (7, 8)).astype(float)
    places = np.argsort(-x, axis=0, kind="stable")
    lists = np.take_along_axis(x, places, axis=0)
    ranks = np.argsort(places, axis=0)
    for depth in (1, 100, 200, 400):
        low, high = T._bounds(q, x, ranks, lists, depth)
        assert (low <= q @ x.T).all() and (q @ x.T <= high).all()
    ids = rng.permutation(400)
    want = brute([], [])
    for i in range(7):
        want += [(i - 10, int(c), int(-s)) for s, c in sorted((-float(q[i] @ x[j]), ids[j]) for j in range(400))[:10]]
    assert T.block_top(np.arange(7) - 10, q, ids, x, 10) == want
