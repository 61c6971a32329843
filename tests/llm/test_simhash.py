import math

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from creditspark.llm import simhash


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    counts = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(grams))


def brute_components(ids, fps):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    groups = {}
    for i, d in enumerate(ids):
        groups.setdefault(find(i), []).append(d)
    return [min((d for d in groups[find(i)] if d is not None), default=None) for i in range(len(ids))]


def check(df):
    rows = df.select("doc_id", "text").collect()
    got = sorted(map(tuple, simhash.near_duplicates(df).collect()), key=repr)
    fps = [brute_fingerprint(r.text) for r in rows]
    comps = brute_components([r.doc_id for r in rows], fps)
    assert got == sorted([(r.doc_id, f"{f:016x}", c) for r, f, c in zip(rows, fps, comps)], key=repr)


def test_whole_table_against_brute_force(spark, sf):
    check(spark.read.parquet(f"{sf}/documents.parquet"))


def test_hard_rows(spark):
    long = " ".join(f"w{i % 977}" for i in range(40_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, "one two"), (7, long), (8, long + " end")]
    rows += [(8, long + " end"), (None, "one"), (None, "lonely text of no id"), (9, " aÉ b\x0bc")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit(1)).withColumn("root", F.lit("x"))
    check(df)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("bucket_rows", [2, 50, 4096])
def test_large_buckets_lose_no_link(spark, bucket_rows):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 5, dtype=np.uint64)
    fps = {int(c) for c in rng.integers(0, 1 << 63, 200, dtype=np.uint64)}
    for c in centres:
        for _ in range(150):
            flips = rng.choice(64, rng.integers(0, 6), replace=False)
            fps.add(int(c) ^ sum(1 << int(b) for b in flips))
    fps = sorted(fps)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    df = spark.createDataFrame(signed, "fp long").repartition(3)
    edges = simhash.links(df, bucket_rows=bucket_rows).collect()
    assert len(edges) < 56 * 20 * len(fps)
    roots = {r.node: r.root for r in simhash.stars(spark.createDataFrame(edges, "a long, b long")).collect()}
    got = {}
    for (s,), f in zip(signed, fps):
        got.setdefault(roots.get(s, s), set()).add(f)
    want = {}
    for f, c in zip(fps, brute_components(fps, fps)):
        want.setdefault(c, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def similar_pairs(texts, width=5, similarity=0.8):
    """Pairs of texts by the exact Jaccard similarity of their shingle sets, by plain sets."""
    sets, holders = [], {}
    for t in texts:
        words = (t or "").encode().lower().split()
        sets.append({tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else {()})
    pairs = set()
    for i, s in enumerate(sets):
        for g in s:
            for j in holders.setdefault(g, []):
                pairs.add((j, i))
            holders[g].append(i)
    return [(j, i) for j, i in pairs if len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]) - 1e-9]


def check_similar(before, after, recall=0.9):
    """Rows of ``after`` against groups by all pairs: no group goes whole or loses its least id, few keep a second row."""
    ids, texts = zip(*before)
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for j, i in similar_pairs(texts):
        root[find(i)] = find(j)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(ids[i])
    kept = [d for d, _ in after]
    assert len(set(kept)) == len(kept) and {min(g) for g in groups.values()} <= set(kept)
    spare = len(ids) - len(groups)
    assert len(kept) - len(groups) <= (1 - recall) * spare, (len(kept), len(groups), len(ids))
    return spare, len(ids) - len(kept)


def test_similar_texts_by_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    before = [tuple(r) for r in docs.collect()]
    check_similar(before, [tuple(r) for r in simhash.keep_similar(docs).collect()])


@pytest.mark.parametrize("bucket_rows", [3, 4096])
def test_near_copies_of_all_sizes_of_group(spark, bucket_rows):
    rng = np.random.default_rng(9)
    rows = []
    for size in [2, 2, 3, 5, 9, 60]:
        base = [f"w{x}" for x in rng.integers(0, 5000, 300)]
        for _ in range(size):
            text = list(base)
            for at in rng.integers(0, 300, 3):
                text[at] = f"n{rng.integers(0, 10**9)}"
            rows.append((len(rows), " ".join(text)))
        rows.append((len(rows), " ".join(base[:150] + [f"z{x}" for x in rng.integers(0, 5000, 150)])))  # half alike: stays
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [tuple(r) for r in simhash.keep_similar(df, bucket_rows=bucket_rows).collect()]
    spare, gone = check_similar(rows, got)
    assert spare > 60 and gone >= 0.95 * spare


def test_similar_hard_rows(spark):
    long = " ".join(f"w{i % 977}" for i in range(40_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, "one two"), (7, long), (8, long + " end"), (None, "one"), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("s", F.lit(1)).withColumn("row", F.lit("x"))
    out = simhash.keep_similar(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id for r in out.collect()), key=repr) == [1, 4, 6, 7, None]
    assert simhash.keep_similar(df.limit(0)).count() == 0


def test_no_similar_pair_is_lost(spark):
    """Short texts whose shingles are as similar as they must be, though most of their words' fingerprints differ."""
    rng = np.random.default_rng(3)
    passage = [f"p{i}" for i in range(12)]  # a frequent one, in all sorts of texts
    rows = []
    for size in rng.integers(6, 90, 150).tolist():
        base = [f"w{x}" for x in rng.integers(0, 10**6, size)] + (passage if size % 3 == 0 else [])
        rows.append((len(rows), " ".join(base)))
        least = math.ceil(0.8 * (len(base) - 4))
        rows.append((len(rows), " ".join(base[: least + 4])))  # at the threshold, or the next step above it
        rows.append((len(rows), " ".join(base[: least + 3])))  # below it for the whole text, near the one before
        rows.append((len(rows), " ".join(base + [f"z{x}" for x in rng.integers(0, 10**6, (len(base) - 4) // 4)])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [tuple(r) for r in simhash.keep_similar(df).collect()]
    spare, gone = check_similar(rows, got, recall=1.0)
    assert spare == gone > 400


def test_similar_texts_with_every_pair(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    before = [tuple(r) for r in docs.collect()]
    for bits in (0, 4):  # whatever the fingerprints name
        check_similar(before, [tuple(r) for r in simhash.keep_similar(docs, max_bits=bits).collect()], recall=1.0)


def test_first_shingles_and_parities():
    """Similar sets share enough of their first shingles in any order, and differ in no more parities than shingles."""
    rng = np.random.default_rng(4)
    for _ in range(400):
        size, similarity = int(rng.integers(1, 300)), float(rng.choice([0.5, 0.8, 0.95]))
        pool = rng.integers(0, 1 << 63, 2 * size + 400).astype(np.uint64)
        one = np.unique(pool[:size])
        other = np.unique(np.r_[rng.permutation(one)[: max(1, math.ceil(similarity * len(one)) + int(rng.integers(0, 3)))], pool[size : size + int(rng.integers(0, 9))]])
        last = np.unique(rng.choice(pool, 40))
        rank = rng.permutation(len(last))
        both = len(np.intersect1d(one, other))
        apart = np.bitwise_count((simhash._parities(one) ^ simhash._parities(other)).view(np.uint64)).sum()
        assert apart <= len(one) + len(other) - 2 * both
        if both >= similarity * (len(one) + len(other) - both) - 1e-9:
            met = np.intersect1d(simhash._first(one, last, rank, similarity), simhash._first(other, last, rank, similarity))
            assert len(met) >= max(simhash._shared(len(x), similarity) for x in (one, other))
