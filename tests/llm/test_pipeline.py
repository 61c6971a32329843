"""Each stage of the pipeline against its brute-force version, on the rows the one before kept."""

import corpus_pipeline as P
import test_line_dedup
import test_mixing
import test_packing
import test_quality
import test_simhash

import __spark_entry__ as entry

LAST = (1 << 63) - 1


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns

    def step(k, df):
        out = P.STAGES[k][1](spark, df, sf)
        out.write.parquet(str(tmp_path / str(k)))
        return spark.read.parquet(str(tmp_path / str(k)))

    good = step(0, docs)
    verdicts = test_quality.brute([tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()])
    assert good.columns == columns
    assert sorted(r[0] for r in rows(good)) == sorted(v[0] for v in verdicts if v[-1])

    unique = step(1, good)
    gone = test_line_dedup.brute([(r.doc_id, r.text) for r in good.collect()], 30)
    want = [(r.doc_id, "\n".join(x for p, x in enumerate(r.text.split("\n")) if p not in gone[r.doc_id, r.text]), r.lang, r.source) for r in good.collect()]
    assert unique.columns == columns
    assert sorted(rows(unique)) == sorted((*w, len(w[1])) for w in want)

    apart = step(2, unique)
    assert apart.columns == columns and set(rows(apart)) <= set(rows(unique))
    test_simhash.check_similar([(r.doc_id, r.text) for r in unique.collect()], [(r.doc_id, r.text) for r in apart.collect()])

    mixed = step(3, apart)
    test_mixing.check(apart, whole=True, repeat_limit=P.REPEAT_LIMIT)
    assert mixed.columns == columns and set(rows(mixed)) == set(rows(apart)) and mixed.count() >= apart.count()

    packed = step(4, mixed)
    used, least = test_packing.check([(r.doc_id, r.text) for r in mixed.collect()], packed.collect(), 2048)
    assert used <= 1.02 * least + 1
    assert [n for n, _ in P.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "source_mixing", "best_fit_packing"]


def test_run_gives_the_last_stage_s_rows(spark, sf):
    out = entry.queries()["pipeline"](spark, sf)
    assert out.columns[:5] == ["doc_id", "piece", "start", "length", "ids_crc32"] and out.count() > 0


def test_one_of_each_group_stays_whatever_the_ids(spark):
    data = [(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (None, "x y z w v"), (None, "x y z w v"), (3, None), (4, ""), (5, "p q"), (5, "r s t")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = sorted(map(repr, P.near_duplicates(spark, df, "").collect()))
    assert len(got) == 5 and sum("doc_id=5" in g for g in got) == 2 and sum("x y z" in g for g in got) == 1
