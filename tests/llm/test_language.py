import zlib

import numpy as np
from pyspark.sql import functions as F

from creditspark.llm import language as L


def brute_grams(text):
    text = "".join(c if c.isalpha() else " " for c in text.lower())
    text = f" {' '.join(text.split())} "
    return {text[i : i + n] for n in (1, 2, 3) for i in range(len(text) - n + 1)}


def test_kernel_against_sets():
    texts = ["Der Hund läuft.", "the dog runs, 2 times", "El perro corre!", "Ünïcode ÀÉ 日本語", "aa aa aa", "x"]
    sets = [L.grams(t) for t in texts]
    plain = [brute_grams(t) for t in texts]
    want = [[len(a & b) / (len(a) * len(b)) ** 0.5 for b in plain] for a in plain]
    assert np.allclose(L.kernel(sets, sets), want)
    assert len(L.grams("12 !")) == len(L.grams(None)) == len(L.grams("")) == 0


def test_folded_weights_give_the_kernel_machine():
    rng = np.random.default_rng(0)
    words = {"a": ["the", "and", "of", "thing"], "b": ["der", "und", "das", "ding"], "c": ["el", "que", "los", "cosa"]}
    rows = [(k, " ".join(rng.choice(v, 12))) for k, v in words.items() for _ in range(20)]
    model = L.fit(rows, landmarks=12)
    sets = [L.grams(t) for _, t in rows]
    marks = [s for k in words for s in [s for (x, _), s in zip(rows, sets) if x == k][::5]]
    km, kn = L.kernel(marks, marks), L.kernel(sets, marks)
    values, vectors = np.linalg.eigh(km)
    kept = values > 1e-8 * values.max()
    phi = kn @ (vectors[:, kept] / np.sqrt(values[kept]))
    y = np.where(np.array([k for k, _ in rows])[:, None] == np.array(model.langs), 1.0, -1.0)
    beta = np.linalg.solve(phi.T @ phi / 20 + L.RIDGE * 3 * np.eye(phi.shape[1]), phi.T @ y / 20)
    assert np.allclose(model.margins(sets), phi @ beta)
    assert [k for k, _ in model.predict([t for _, t in rows])] == [k for k, _ in rows]


def test_held_out_accuracy_on_the_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r for r in docs.collect()}
    got = L.identify(docs).collect()
    assert len(got) == len(truth)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    right = [r.lang_pred == truth[r.doc_id].lang for r in got if r.held_out and len(truth[r.doc_id].text) > 40]
    assert np.mean(right) > 0.99


def test_learning_ignores_held_out_rows_and_labels_of_scored_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    spoiled = docs.withColumn("lang", F.when(L.held_out("doc_id"), F.lit("xx")).otherwise(F.col("lang")))
    assert sorted(map(tuple, L.identify(docs).collect())) == sorted(map(tuple, L.identify(spoiled).collect()))


def test_hard_rows(spark):
    rows = [(0, None, "en"), (2, "", "de"), (3, "12 !?", "en"), (3, "12 !?", "en"), (None, "the end", None), (5, "the " * 50_000, "en"), (6, "und der", "de"), (7, "the and of", "en"), (8, "日本", "ja")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit(1)).withColumn("place", F.lit("x"))
    got = [tuple(r) for r in L.identify(df).collect()]
    assert len(got) == len(rows) and [g[2] for g in got if g[0] in (0, 2, 3)] == ["und"] * 4
    assert all(g[3] == 0 for g in got if g[2] == "und") and {g[2] for g in got} <= {"und", "en", "de", "ja"}
    none = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in L.identify(none).collect()} == {"und"}
    assert L.identify(df.limit(0)).count() == 0
    assert len(L.sample(df, F.lit(True), "doc_id", "text", "lang", rows=3)) <= 3
