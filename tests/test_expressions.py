import math

import pytest
from pyspark.sql import functions as F

from creditspark import schema as S
from creditspark.functions import loan as L, numeric as N
from creditspark.operators import columns as K


def column(spark, values, dtype="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")


def apply(spark, values, fn, dtype="double"):
    rows = column(spark, values, dtype).select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()
    return [r.y for r in rows]


def test_score_band_edges(spark):
    got = apply(spark, [299, 300, 579, 580, 669, 670, 740, 799, 800, 850, 851, None], L.score_band, "int")
    assert got == ["nan", "Poor", "Poor", "Fair", "Fair", "Good", "Very_Good", "Very_Good", "Exceptional", "Exceptional", "nan", "nan"]


def test_ratio(spark):
    df = spark.createDataFrame([(10000.0, 50000.0), (5000.0, 0.0), (5000.0, None), (9e9, 1.0), (-5.0, 1.0)], "a double, b double")
    got = [r[0] for r in df.select(L.loan_to_income(F.col("a"), F.col("b"))).collect()]
    assert got == [0.2, 0.0, 0.0, 10.0, 0.0]


def test_log_keeps_null(spark):
    assert apply(spark, [math.e - 1, -5.0, None], L.log_floor0) == [pytest.approx(1.0), 0.0, None]


def test_flag(spark):
    assert apply(spark, [0, 1, 2, 3, None], L.delinquency_flag, "int") == [0, 0, 1, 1, 0]


def test_decision_confidence_tier_edges(spark):
    p = [0.1999, 0.2, 0.35, 0.45, 0.5, 0.65, 0.6999, 0.7, 0.8]
    assert apply(spark, p, L.decision)[3:5] == ["APPROVE", "REJECT"]
    assert apply(spark, p, L.confidence) == ["HIGH", "HIGH", "MEDIUM", "LOW", "LOW", "MEDIUM", "MEDIUM", "MEDIUM", "HIGH"]
    assert apply(spark, p, L.risk_tier) == ["LOW_RISK"] + ["MEDIUM_RISK"] * 2 + ["HIGH_RISK"] * 4 + ["VERY_HIGH_RISK"] * 2


def test_direction_of_zero(spark):
    assert apply(spark, [0.1, 0.0, -0.1], L.factor_direction) == ["increases_risk", "decreases_risk", "decreases_risk"]


def test_clip_and_to_number(spark):
    assert apply(spark, [1.0, 5.0, 99.0, None], lambda c: N.clip(c, 2.0, 10.0)) == [2.0, 5.0, 10.0, None]
    assert apply(spark, ["1.5", "x", None, "NaN"], lambda c: N.to_number(c, 30), "string") == [1.5, 30.0, 30.0, 30.0]


def test_rounding(spark):
    assert apply(spark, [0.125, 0.375, 2.5], lambda c: N.round_half_even(c, 2)) == [0.12, 0.38, 2.5]
    values = [0.12345, 0.00005, 0.33335, 0.8537, 1.00005]
    assert apply(spark, values, lambda c: N.round_report(c, 4)) == [round(v, 4) for v in values]
    assert apply(spark, values, lambda c: N.fixed(c, 3)) == [f"{v:.3f}" for v in values]


def test_loan_ids(spark):
    assert apply(spark, [1, 1234567, 123456789], L.format_loan_id, "long") == ["LOAN_0000001", "LOAN_1234567", "LOAN_123456789"]


def test_request_ids(spark):
    ids = [r[0] for r in spark.range(50).select(L.request_id()).collect()]
    assert len(set(ids)) == 50 and all(len(i) == 20 and i.startswith("req_") for i in ids)


def test_count_reached_is_searchsorted(spark):
    import numpy as np

    edges = [0.1, 0.2, 0.2, 0.5, 0.9]
    values = [0.0, 0.1, 0.15, 0.2, 0.5, 0.6, 0.9, 2.0]
    arr = F.array(*[F.lit(e) for e in edges])
    got = apply(spark, values, lambda c: N.count_reached(arr, len(edges), c))
    assert got == list(np.searchsorted(edges, values, side="right"))


def test_bins_match_numpy_on_edges(spark):
    import numpy as np

    values = [i / 10 for i in range(11)] + [0.3, 0.6, 0.7, 0.05, 0.999999]
    edges = np.linspace(0.0, 1.0, 11)
    want = [min(int(np.searchsorted(edges, v, side="right")) - 1, 9) for v in values]
    got = apply(spark, values, lambda c: N.bin_index(c, F.lit(0.0), F.lit(0.1), 10))
    assert got == want


def test_lookup_defaults(spark):
    from pyspark.sql.types import DoubleType, StringType

    got = apply(spark, [1.0, 2.0, 7.0, 1.5, None], lambda c: K.lookup(c, DoubleType(), S.EDUCATION_TO_PURPOSE, "other"))
    assert got == ["home_improvement", "debt_consolidation", "other", "other", "other"]
    assert apply(spark, ["1", "x"], lambda c: K.lookup(c, StringType(), S.MARRIAGE_TO_OWNERSHIP, "RENT"), "string") == ["MORTGAGE", "RENT"]


def test_column_tools(spark):
    df = spark.createDataFrame([(1, 2)], ["Limit-Bal ", " Due.Date"])
    assert K.normalize_columns(df).columns == ["limit_bal", "due.date"]
    assert K.resolve_column(df, ["nope"], ("due",)) == " Due.Date"
    assert K.resolve_column(df, ["nope"]) is None
    assert K.resolve_column(df, ["nope"], position=-1) == " Due.Date"
    left = spark.createDataFrame([(1, "a")], "x int, y string")
    assert K.union_by_name(left, left.drop("y")).where("y is null").count() == 1


def test_canonicalize_without_optional_columns(spark):
    from creditspark.operators.canonical import canonicalize

    df = spark.createDataFrame([(7, "abc", 1)], "account int, credit_limit string, y int")
    row = canonicalize(df).first()
    assert row.loan_id == "LOAN_0000007" and row.loan_amount == 10000.0 and row.annual_income == 30000.0
    assert (row.employment_years, row.credit_score, row.debt_to_income_ratio) == (5, 650, 0.3)
    assert (row.num_open_accounts, row.num_delinquencies) == (1, 0)
    assert (row.loan_purpose, row.home_ownership, row.loan_term_months, row.loan_default) == ("debt_consolidation", "RENT", 36, 1)


def test_payment_score_values(spark):
    from creditspark.operators.canonical import payment_score

    names = [f"p{i}" for i in range(6)]
    rows = [tuple(1 if i < late else 0 for i in range(6)) for late in range(6, -1, -1)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} int" for n in names))
    assert [r[0] for r in df.select(payment_score(names)).collect()] == [300, 391, 483, 575, 666, 758, 850]
