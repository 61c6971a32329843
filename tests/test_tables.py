"""Rules, splits, sources and sinks."""

import tempfile

import pytest
from pyspark.sql import functions as F

from creditspark import schema as S
from creditspark.errors import IngestionError, ValidationError
from creditspark.operators import quality as Q, split as SP
from creditspark.plans.fixtures import loans, prediction_log
from creditspark.sources import generate as G, reports as RP, tables as TB


@pytest.fixture(scope="module")
def good(spark):
    return G.generate_loans(spark.range(1, 501), "id").cache()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def test_valid_passes(good):
    assert Q.check(good).count() == 500
    assert Q.check(good.drop("loan_id", "loan_default"), S.INFERENCE_RULES).count() == 500


@pytest.mark.parametrize(
    "column,value",
    [("credit_score", "200L"), ("loan_default", "2L"), ("loan_purpose", "'crypto'"), ("home_ownership", "'CONDO'"),
     ("loan_id", "'X1'"), ("annual_income", "CAST(NULL AS DOUBLE)"), ("loan_amount", "double('NaN')"), ("credit_score", "'abc'")],
)
def test_each_fault_is_reported(good, column, value):
    bad = good.withColumn(column, F.expr(f"CASE WHEN loan_id = 'LOAN_0000007' THEN {value} ELSE {column} END") if value != "'abc'" else F.lit("abc"))
    with pytest.raises(ValidationError) as err:
        Q.check(bad)
    assert [e.split(":")[0] for e in err.value.errors] == [column]


def test_missing_column_is_a_violation(good):
    with pytest.raises(ValidationError, match="credit_score"):
        Q.check(good.drop("credit_score"))


def test_report_states(good):
    assert Q.validation_report(good).first().status == "PASSED"
    assert Q.validation_report(good.withColumn("credit_score", F.lit(900).cast("long"))).first().status == "PASSED_AFTER_FIX"
    failed = Q.validation_report(good.withColumn("loan_purpose", F.lit("crypto"))).first()
    assert failed.status == "FAILED" and failed.errors_after_fix == "loan_purpose"


def test_generated_moments(spark):
    df = G.generate_loans(spark.range(1, 20001), "id")
    m = df.agg(F.avg("loan_default"), F.avg("credit_score"), F.avg("debt_to_income_ratio"), F.avg("num_delinquencies"),
               F.expr("percentile(loan_amount, 0.5)"), F.avg((F.col("loan_term_months") == 36).cast("int"))).first()
    assert 0.03 < m[0] < 0.25 and abs(m[1] - 679) < 4 and abs(m[2] - 2 / 7) < 0.01 and abs(m[3] - 3 / 7) < 0.03
    assert abs(m[4] - 13360) < 400 and abs(m[5] - 0.6) < 0.02
    again = G.generate_loans(spark.range(1, 20001).repartition(5), "id")
    assert df.exceptAll(again).isEmpty()


def test_exact_split_sizes(spark, good):
    out = SP.exact_stratified_split(good).groupBy("split", "loan_default").count().collect()
    sizes = {}
    for r in out:
        sizes[r.split] = sizes.get(r.split, 0) + r["count"]
    assert sizes == {"test": 100, "val": 50, "train": 350}
    pos = good.filter("loan_default = 1").count()
    test_pos = next(r["count"] for r in out if r.split == "test" and r.loan_default == 1)
    assert abs(test_pos - pos * 0.2) <= 1


def test_split_is_reproducible_and_whole(good):
    for how in (SP.hash_split, SP.exact_stratified_split):
        first, again = how(good), how(good.repartition(3))
        assert first.select("loan_id", "split").exceptAll(again.select("loan_id", "split")).isEmpty()
        assert SP.split_overlap(first).isEmpty() and SP.split_cover(good, first).isEmpty()
    assert not SP.hash_split(good, seed=7).select("loan_id", "split").exceptAll(SP.hash_split(good).select("loan_id", "split")).isEmpty()


def test_exact_split_keeps_copies_together(spark):
    hot = spark.range(900).select(F.when(F.col("id") < 300, 0).otherwise(F.col("id")).cast("string").alias("loan_id"), F.lit(0).alias("loan_default"))
    out = SP.exact_stratified_split(hot)
    assert out.count() == 900 and SP.split_overlap(out).isEmpty()


def test_intersection_reads_its_rows_once(spark):
    """Missing and repeated ids, rows without a part and a third part, against two filtered reads."""
    rows = [("a", "train"), ("a", "train"), ("a", "test"), ("b", "train"), ("b", "val"), ("c", "test"), ("c", "test"), ("c", None)]
    rows += [(None, "test"), (None, "train"), (None, "train"), ("", "train"), ("", "val"), ("d", None), ("e", "val"), ("e", "test")]
    df = spark.createDataFrame(rows, "loan_id string, split string")
    for left, right, want in [("train", "test", [None, "a"]), ("test", "train", [None, "a"]), ("val", "val", ["", "b", "e"]), ("train", "none", [])]:
        out = SP.split_intersection(df, left, right)
        assert out.columns == ["loan_id"] and sorted((r.loan_id for r in out.collect()), key=lambda x: (x is not None, x)) == want
        parts = [df.filter(F.col("split") == s).select("loan_id") for s in (left, right)]
        assert out.exceptAll(parts[0].intersect(parts[1])).isEmpty()
        assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_exact_split_breaks_hash_ties_by_id(spark, monkeypatch):
    rows = spark.range(997).selectExpr("concat('L', id) AS loan_id", "CASE WHEN id % 50 = 0 THEN 1 WHEN id % 7 = 0 THEN NULL ELSE 0 END AS loan_default")
    same = lambda col, seed: F.length(col.cast("string")).cast("long") * (1 << 50)
    monkeypatch.setattr(SP, "hash_position", same)
    quotas = {r.loan_default: (r.n_test, r.n_val) for r in SP.split_quotas(rows).collect()}
    got = {}
    for r in SP.exact_stratified_split(rows).groupBy("loan_default", "split").count().collect():
        got[r.loan_default, r.split] = r["count"]
    assert set(quotas) == {0, 1, None}
    assert {k: (got[k, "test"], got[k, "val"]) for k in quotas} == quotas


def test_csv_columns_are_found_by_name(spark, folder):
    wide = spark.createDataFrame([("1.5", "L1", "x")], "loan_amount string, loan_id string, note string")
    TB.write_csv(wide, f"{folder}/w.csv")
    assert TB.scan_csv(spark, f"{folder}/w.csv", "loan_id string, loan_amount double").collect() == [("L1", 1.5)]
    with pytest.raises(IngestionError, match="no column credit_score"):
        TB.scan_csv(spark, f"{folder}/w.csv", "loan_id string, credit_score long")
    TB.write_csv(spark.createDataFrame([("L1", "many")], "loan_id string, loan_amount string"), f"{folder}/b.csv")
    with pytest.raises(Exception, match="many|MALFORMED"):
        TB.scan_csv(spark, f"{folder}/b.csv", "loan_id string, loan_amount double").collect()
    lenient = TB.scan_csv(spark, f"{folder}/b.csv", "loan_id string, loan_amount double", mode="PERMISSIVE")
    assert lenient.collect() == [("L1", None)]


def test_scan_errors(spark, folder):
    with pytest.raises(IngestionError, match="no such input"):
        TB.scan(spark, f"{folder}/none.parquet")
    with pytest.raises(IngestionError, match="unsupported"):
        TB.scan(spark, f"{folder}/data.xls")
    spark.range(0).write.parquet(f"{folder}/empty.parquet")
    with pytest.raises(IngestionError, match="no rows"):
        TB.scan(spark, f"{folder}/empty.parquet")
    with open(f"{folder}/broken.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(IngestionError, match="cannot read"):
        TB.scan(spark, f"{folder}/broken.parquet")


def test_csv_round_trip(spark, good, folder):
    TB.write_csv(good, f"{folder}/l.csv")
    assert TB.scan(spark, f"{folder}/l.csv", S.LOAN_SCHEMA).exceptAll(good).isEmpty()
    TB.write_sample_csv(good, f"{folder}/s.csv")
    assert TB.scan_csv(spark, f"{folder}/s.csv", S.LOAN_SCHEMA).count() == 200


def test_reading_one_split_prunes(spark, good, folder):
    TB.write_splits(SP.hash_split(good), f"{folder}/p")
    val = TB.read_split(spark, f"{folder}/p", "val")
    plan = val._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    assert val.count() == SP.hash_split(good).filter("split = 'val'").count()


def test_log_append_adds_only(spark, sf, folder):
    log = prediction_log(spark, sf)
    TB.append_predictions(log.limit(40), f"{folder}/log")
    before = {f for f in TB.read_predictions(spark, f"{folder}/log").inputFiles()}
    TB.append_predictions(log.limit(5).drop("actual_default"), f"{folder}/log")
    out = TB.read_predictions(spark, f"{folder}/log")
    assert out.count() == 45 and before < set(out.inputFiles())
    assert out.filter("dt <> to_date(ts)").isEmpty()


def test_report_files(spark, folder):
    df = spark.createDataFrame([("run_12345", "2024-05-06T00:00:00", {"auc": 0.8})], "run_id string, timestamp string, m map<string,double>")
    RP.save_reports(df, f"{folder}/r")
    back = RP.load_reports(spark, f"{folder}/r", df.schema).first()
    assert back.report == "report_run_1234_2024-05-06" and back.m == {"auc": 0.8}


def test_pushdown_reaches_the_scan(spark, sf):
    plan = loans(spark, sf).filter("as_of < timestamp_ntz'2000-01-01'").select("loan_amount")._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(o_orderdate" in plan and "l_extendedprice" not in plan and "c_name" not in plan
