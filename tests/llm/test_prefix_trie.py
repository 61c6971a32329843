import hashlib
import random
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditspark.llm import prefix_trie as T

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """Nodes by plain dictionaries: rows are (conv_id, turn, role, text)."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [(r, t) for *_, r, t in sorted(own)] for c, own in convs.items()}
    members = {}
    for c, own in convs.items():
        h = crc32(str(c).encode()) % 6
        turns = convs.get(c - c % 100, [])[:h] + own[h:]
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append((c, len(turns)))
    nodes = {}
    for prefix, own in members.items():
        ends = ",".join(map(str, sorted(c for c, n in own if n == len(prefix))))
        nodes[prefix] = [min(c for c, _ in own), len(prefix), min(c for c, _ in members[prefix[:-1]]) if prefix else None, len(own), 0, 0, 0, hashlib.sha256(ends.encode()).hexdigest()]
    for prefix in nodes:
        if prefix:
            nodes[prefix[:-1]][4] += 1
    for prefix in nodes:
        for d in range(len(prefix) + 1):
            top = nodes[prefix[:d]]
            top[5] += nodes[prefix][4] == 0
            top[6] += (nodes[prefix][3] - 1) * (len(prefix[-1][1]) if prefix else 0)
    return sorted(map(repr, map(tuple, nodes.values())))


def got(df, **kw):
    out = T.prefix_trie(T.rebuilt(df), **kw)
    assert out.columns == COLUMNS
    return sorted(repr(tuple(r)) for r in out.collect())


@pytest.mark.parametrize("block", [T.BLOCK_TURNS, 40, 1])
def test_whole_table_against_dictionaries(spark, sf, block):
    convs = spark.read.parquet(f"{sf}/conversations.parquet")
    assert got(convs, block_turns=block) == brute([tuple(r) for r in convs.select("conv_id", "turn", "role", "text").collect()])


@pytest.mark.parametrize("block", [T.BLOCK_TURNS, 30, 1])
@pytest.mark.parametrize("seed", range(3))
def test_deep_tries_copies_and_turnless_conversations(spark, seed, block):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(700), 150):
        n = rng.choice([1, 2, 3, 7, 7, 7, 30])
        word = rng.choice(["", "a", "long turn"]) if rng.random() < 0.7 else None
        rows += [(c, k, rng.choice(["user", "assistant"]) if rng.random() < 0.1 else "user", word if rng.random() < 0.95 else "other") for k in range(n)]
    rng.shuffle(rows)
    assert got(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), block_turns=block) == brute(rows)


def test_a_group_of_copies_over_many_tasks(spark):
    rows = [(100_000 + c, k, "user", f"turn {k}") for c in range(3000) for k in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8)
    assert got(df, block_turns=500) == brute(rows)


def test_hard_rows(spark):
    rows = [(None, 0, "user", "x"), (0, None, None, None), (0, 1, "user", "é" * 50_000), (0, 1, "user", "é" * 50_000), (7, None, "user", ""), (7, 0, "", None), (301, 5, "user", "a"), (301, -5, "user", "b")]
    rows += [(50, k, "user", "same") for k in range(300)] + [(51, k, "user", "same") for k in range(290)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    more = df.withColumn("part", F.lit(1)).withColumn("turns", F.lit("x")).withColumn("node", F.lit(0)).withColumn("key", F.lit(0))
    assert got(more) == brute(rows)
    assert T.prefix_trie(T.rebuilt(df.limit(0))).count() == 0
    only = spark.createDataFrame([(1, 0, "user", "a")], df.schema)
    assert got(only) == brute([(1, 0, "user", "a")])


def test_range_minimum():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 8, 31):
        values = rng.integers(0, 5, n)
        table = T.RangeMinimum(values)
        for a in range(n):
            for bound in range(6):
                stop = a
                while stop < n and values[stop] >= bound:
                    stop += 1
                start = a
                while start > 0 and values[start - 1] >= bound:
                    start -= 1
                assert table.right(np.array([a]), np.array([bound]))[0] == stop
                assert table.left(np.array([a]), np.array([bound]))[0] == start
            for b in range(a + 1, n + 1):
                assert table.least(np.array([a]), np.array([b]))[0] == values[a:b].min()
