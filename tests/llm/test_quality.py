import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditspark.llm import quality as Q


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows, covered = {}, set()
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    for at in windows.values():
        if len(at) > 1:
            covered.update(p + k for p in at for k in range(3))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        len(lines),
    )


def vector(c):
    n_words, chars, symbols, dup, repeat, lines = c
    parts = [np.log2(1 + 64 * symbols / n_words), np.log2(chars / n_words), dup / lines, repeat / n_words]
    return [float(np.floor(abs(1024 * v) + 0.5) * np.sign(v)) for v in parts]


def brute(rows, min_group=Q.MIN_GROUP):
    """kept by plain numpy; rows are (doc_id, text, lang, source)."""
    counts = [brute_counts(r[1]) for r in rows]
    failed = [c[0] < 50 or 100 * c[4] > 50 * c[0] for c in counts]
    groups = {}
    for i, r in enumerate(rows):
        if not failed[i]:
            groups.setdefault((r[2], r[3]), []).append(i)
    pools = {}
    for g, members in groups.items():
        pools.setdefault(g if len(members) >= min_group else "", []).extend(members)
    floors = np.array([(1024 * f) ** 2 for *_, f in Q.STATISTICS])
    limit = Q.chi_square_point(Q.TAIL, 4)
    short = (1 - Q.chi_square_above(Q.chi_square_point(0.25, 4), 6)) / 0.75
    kept = [False] * len(rows)
    for members in pools.values():
        x = np.array([vector(counts[i]) for i in members])
        q = np.percentile(x, [25, 50, 75], axis=0)
        m, c = q[1], np.diag(((q[2] - q[0]) / 1.349) ** 2 + floors)
        mark = None
        for _ in range(Q.STEPS):
            d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
            step = np.floor(64 * np.log2(d + 1e-3))
            core = x[step <= np.sort(step)[int(np.ceil(0.75 * len(x))) - 1]]
            m, c = core.mean(0), np.cov(core.T, bias=True) / short + np.diag(floors)
            now = (len(core), *core.sum(0))
            if now == mark:
                break
            mark = now
        d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
        for i, v in zip(members, d):
            kept[i] = bool(v <= limit)
    return sorted(((r[0], *c[:5], f, k) for r, c, f, k in zip(rows, counts, failed, kept)), key=repr)


def got(df):
    out = Q.quality(df).select("doc_id", *Q.COUNTS, "base_failed", "kept").collect()
    return sorted(map(tuple, out), key=repr)


def test_whole_table_against_numpy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    assert got(docs) == brute(rows)


def test_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = Q.quality(docs).where("not base_failed").join(labels, "doc_id")
    assert found.where("quality = 1 and not kept").count() == 0
    assert found.where("quality = 0 and kept").count() == 0


def test_hard_rows(spark):
    ordinary = "The quick fox number {0} runs over hill {0} and sees river {1} flow to sea {2} "
    rows = [(i, ordinary.format(i, i * 7, i % 13) + " ".join(f"w{i}x{j}" for j in range(60)), None, "s") for i in range(150)]
    rows += [(900, " ".join(f"{w}$$$ ###" for w in range(80)), None, "s"), (901, None, None, None), (902, "", "en", "s")]
    rows += [(903, " \n\t\x0b", "en", None), (904, "a b c " * 20_000, "en", "s"), (905, " ".join(f"é{i}" for i in range(60_000)), "x", "y")]
    rows += [(906, "x y z", "en", "s"), (None, rows[0][1], None, "s"), (1, rows[1][1], None, "s"), (907, "a a a a\n\na a a a\n a\r", "en", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    df = df.withColumn("group", F.lit(1)).withColumn("n_words", F.lit("x"))
    assert got(df) == brute(rows)
    kept = {r[0] for r in got(df) if r[-1]}
    assert 900 not in kept and 904 not in kept and {0, 1, 149, 905} <= kept
    assert sorted(map(repr, Q.keep_good(df).select("doc_id").collect())) == sorted(f"Row(doc_id={r[0]})" for r in got(df) if r[-1])
    assert Q.keep_good(df).columns == df.columns
    assert Q.quality(df.limit(0)).count() == 0 and Q.keep_good(df.limit(0)).count() == 0


@pytest.mark.parametrize("above", [0.5, 0.25, 1e-9])
def test_chi_square(above):
    x = Q.chi_square_point(above, 4)
    assert abs(np.exp(-x / 2) * (1 + x / 2) - above) < 1e-6 * above


def test_no_python_in_the_plan(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for df in (Q.quality(docs), Q.keep_good(docs)):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_a_tight_group_rejects_duplicate_lines_and_repeats(spark):
    def words(tag, n):
        return " ".join(f"{tag}x{j}" for j in range(n))

    rows = [(i, "\n".join(words(f"l{i}n{k}", 10) for k in range(10)), "en", "s") for i in range(150)]
    # 40 per cent of the lines and 45 of the words are repeated
    rows.append((900, "\n".join([*[words("d100n0", 9)] * 5, *[words(f"u10{k}n0", 11) for k in range(5)]]), "en", "s"))
    got = {r.doc_id: r for r in Q.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert (got[900].n_dup_lines, got[900].n_repeat_words, got[900].base_failed, got[900].kept) == (4, 45, False, False)
    assert all(got[i].kept for i in range(150))
