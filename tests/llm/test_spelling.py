import itertools
import random
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from creditspark.llm import spelling as S


def lower(word):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in word)


def distance_one(a, b):
    """By the table of edit distances."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (x != y)))
    return row[-1] == 1


def brute(rows, near=distance_one):
    every = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            every[run] += 1
    words = {w: n for w, n in every.items() if len(w) >= 6 and n >= 5}
    out, forms = [], {}
    found = {w: [v for v in words if abs(len(v) - len(w)) <= 1 and near(w, v)] for w in words}
    for w, n in words.items():
        best = min(found[w], key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best and words[best] >= 5 * n else None
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, len(found[w]), words[forms[w]] if forms[w] else None))
    return sorted(map(repr, out))


def got(df, **kw):
    out = S.variants(df, **kw)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(repr(tuple(r)) for r in out.collect())


@pytest.mark.parametrize("crowded", [S.CROWDED, 3, 0])
def test_whole_table_against_all_pairs(spark, sf, crowded):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]

    def near(a, b):  # quick, checked against the table of distances below
        return S.one_edit(a, b)

    assert got(docs, crowded=crowded) == brute(rows, near)


def test_one_edit_is_distance_one():
    rng = random.Random(3)
    for _ in range(4000):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(7)))
        b = "".join(rng.choice("ab") for _ in range(rng.randrange(7)))
        assert S.one_edit(a, b) == distance_one(a, b)


@pytest.mark.parametrize("crowded", [S.CROWDED, 10, 0])
def test_planted_variants_chains_and_ties(spark, crowded):
    rng = random.Random(8)
    text = []
    for k in range(25):
        word = "".join(rng.choice("abcdeÀé÷Z") for _ in range(rng.randrange(6, 10)))
        text += [word] * rng.choice([5, 25, 130, 700])
        for _ in range(12):
            at = rng.randrange(len(word))
            other = rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice("abcdeÀé") + word[at:], word[:at] + rng.choice("abcdeÀé") + word[at + 1 :]])
            text += [other] * rng.choice([4, 5, 6, 26])
    rng.shuffle(text)
    rows = [(k, " ".join(text[k::7])) for k in range(7)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string"), crowded=crowded) == brute(rows)


@pytest.mark.parametrize("crowded", [S.CROWDED, 50, 0])
def test_leaves_of_many_words_of_the_same_letters(spark, crowded):
    words = ["".join(p) for p in itertools.permutations("abcdef")]
    words += [w[:3] + "x" + w[4:] for w in words[::5]] + [w[:2] + "a" + w[2:] for w in words[::7]] + ["y" * 40, "y" * 41, "y" * 39 + "z"]
    df = spark.createDataFrame([(w, len(w)) for w in set(words)], "word string, n long")
    got = [tuple(r) for r in S.near_words(S.cut(df), crowded).collect()]
    want = [(a, b, len(b)) for a in set(words) for b in set(words) if S.one_edit(a, b)]
    assert sorted(got) == sorted(want)


def test_hard_rows(spark):
    long = " ".join(["variant"] * 40_000)
    rows = [(1, None), (2, ""), (3, "12 !"), (None, "flavour flavour flavour flavour flavour"), (4, long + " " + "x" * 30_000), (4, "variants " * 9), (4, "variants " * 9), (5, "VARIANTÉ variantÉ " * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("x")).withColumn("n", F.lit(1)).withColumn("key", F.lit(0))
    assert got(df) == brute(rows)
    assert S.variants(df.limit(0)).count() == 0
    assert "('variants', 'variant', 'variant'" in "".join(got(df))
