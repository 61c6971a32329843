import random
from difflib import SequenceMatcher

import pytest
import xxhash
from pyspark.sql import functions as F

from creditspark.llm import line_dedup as D


def brute(rows, min_words):
    """Places removed of each document, all pairs compared by plain loops; rows are (doc_id, text).

    Of every run of lines that follow each other, blank ones aside, in a document and in an earlier one, with
    ``min_words`` words or more, all lines go from the first to the last.
    """

    def order(doc):
        return doc[0], xxhash.xxh64_intdigest(doc[1].encode(), 42) if doc[1] is not None else 42

    signed = lambda h: h - (1 << 64) if h >= 1 << 63 else h
    docs = sorted({((1 << 63) - 1 if i is None else i, t) for i, t in rows}, key=lambda d: (order(d)[0], signed(order(d)[1])))
    held = [[(p, x.strip(D._BLANK), len(x.encode().split())) for p, x in enumerate((t or "").split("\n")) if x.strip(D._BLANK)] for _, t in docs]
    places = []
    for lines in held:
        at = {}
        for j, (_, x, _) in enumerate(lines):
            at.setdefault(x, []).append(j)
        places.append(at)
    out = {}
    for k, doc in enumerate(docs):
        lines, gone = held[k], set()
        words = [0]
        for x in lines:
            words.append(words[-1] + x[2])
        for earlier in places[:k]:
            runs = {}
            for i in range(len(lines) - 1, -1, -1):  # runs[j]: lines from i on that stand from j on
                runs = {j: runs.get(j + 1, 0) + 1 for j in earlier.get(lines[i][1], ())}
                n = max(runs.values(), default=0)
                if n and words[i + n] - words[i] >= min_words:
                    gone |= set(range(lines[i][0], lines[i + n - 1][0] + 1))
        out[doc[0], doc[1] or ""] = gone
    return out


def check(df, min_words=D.MIN_WORDS):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want = brute(rows, min_words)
    expected = []
    for i, t in rows:
        gone = want[(1 << 63) - 1 if i is None else i, t or ""]
        left = None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone)
        expected.append((i, left, len(gone)))
    got = [(r.doc_id, r.text, r.n_removed) for r in D.remove_repeats(df, min_words=min_words, report=True).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))
    return got


@pytest.mark.parametrize("seed", range(30))
def test_patience_is_a_common_subsequence_as_long_as_blocks_need(seed):
    rng = random.Random(seed)
    a = [rng.randrange(12 if seed % 2 else 40) for _ in range(rng.randrange(40))]
    b = list(a)
    for _ in range(rng.randrange(8)):
        b.insert(rng.randrange(len(b) + 1), rng.randrange(60))
        del b[rng.randrange(len(b))]
    pairs = D.patience(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
    longest = max((m.size for m in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()), default=0)
    assert not longest or pairs


def test_whole_table_against_loops(spark, sf):
    got = check(spark.read.parquet(f"{sf}/documents.parquet"))
    assert sum(n for *_, n in got) > 0


def passage(tag, n=60):
    return " ".join(f"{tag}{k}" for k in range(n))


def test_passages_copies_and_clean_documents(spark):
    p = "\n".join(passage(f"p{k}", 20) for k in range(3))
    rows = [(1, f"start one\n{p}\nend one"), (5, f"All rights reserved.\nother text\n  \n{p}\nAll rights reserved."), (3, f"All rights reserved.\n{passage('x', 15)}")]
    rows += [(4, f"clean text\n{passage('x', 15)}\nAll rights reserved."), (100, "\n".join(passage(f"c{k}", 12) for k in range(5)))]
    rows += [(100 + k, rows[-1][1]) for k in range(1, 40)]
    rows += [(200 + k, "\n".join(passage(f"n{j}", 12) if j != k % 6 else f"edit {k} here" for j in range(6))) for k in range(30)]
    rows += [(300, passage("q1", 20)), (301, passage("q2", 20)), (302, passage("q1", 20) + "\n" + passage("q2", 20)), (303, passage("q1", 20) + "\n" + passage("q2", 20))]
    got = {r[0]: r for r in check(spark.createDataFrame(rows, "doc_id long, text string"))}
    assert got[5][1] == "All rights reserved.\nother text\n  \nAll rights reserved." and got[1][2] == 0
    assert got[3][2] == got[4][2] == 0
    assert got[100][2] == 0 and all(got[100 + k][1] == "" for k in range(1, 40))
    assert got[303][1] == ""  # the pair of lines is named by 302, though other documents held either first


def test_hard_rows(spark):
    long = "\n".join(passage(f"l{k}", 10) for k in range(3000))
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, long), (5, "x\n" + long + "\ny"), (5, "x\n" + long + "\ny"), (None, passage("s")), (6, passage("s")), (6, passage("s") + "\nmore")]
    rows += [(7, "\n".join([passage("r", 10)] * 500)), (8, "\n".join([passage("r", 10)] * 400)), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("d", F.lit("x")).withColumn("row", F.lit(1)).withColumn("ranges", F.lit(0))
    check(df)
    out = D.remove_repeats(df)
    assert out.columns == df.columns and out.count() == len(rows)
    assert D.remove_repeats(df.limit(0)).count() == 0


def all_runs(rows, min_words):
    """Lines left of each document when all its runs of lines that any earlier document holds are gone, by plain loops."""
    held = [[(k, x, len(x.split())) for k, x in enumerate(t.split("\n"))] for _, t in rows]
    out = []
    for at, doc in enumerate(held):
        gone = set()
        for other in held[:at]:
            for i in range(len(doc)):
                for j in range(len(other)):
                    n = 0
                    while i + n < len(doc) and j + n < len(other) and doc[i + n][1] == other[j + n][1]:
                        n += 1
                    if sum(x[2] for x in doc[i : i + n]) >= min_words:
                        gone |= set(range(i, i + n))
        out.append("\n".join(x for k, x, _ in doc if k not in gone))
    return out


def test_all_pairs_and_all_common_runs(spark):
    p, q = passage("p", 40), passage("q", 40)
    six = [passage(f"s{k}", 10) for k in range(6)]
    texts = [f"head a\nhead b\n{p}", f"{p}\nhead a\nhead b"]  # another order
    texts += [f"{q}\nx1 x2\n{passage('r', 40)}", f"{passage('r', 40)}\ny1 y2\n{q}", f"{q}\nz1\n{q}"]  # swapped, twice
    texts += [f"only {k}\n{six[k]}\n{six[k + 1]}\nend {k}" for k in range(5)] + ["\n".join(six), "\n".join(["new", *six, "other"])]
    rng = random.Random(5)
    pool = [passage(f"w{k}", rng.choice([2, 6, 11, 17, 31])) for k in range(9)]
    texts += ["\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 14))) for _ in range(60)]
    rows = list(enumerate(texts))
    got = D.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.text for r in sorted(got, key=lambda r: r.doc_id)] == all_runs(rows, D.MIN_WORDS)
    assert all_runs(rows, D.MIN_WORDS)[1] == "head a\nhead b" and all_runs(rows, D.MIN_WORDS)[11] == "new\nother"
