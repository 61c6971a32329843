"""Features, scaling, encoding, training, scoring and explanations."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from creditspark import schema as S
from creditspark.functions import loan as L
from creditspark.functions.numeric import round_half_even as R
from creditspark.operators import explain as E, features as FE, model as MO, runs as RU, scoring as SC, split as SP
from creditspark.plans.fixtures import contributions, ctes, loans
from creditspark.plans.q_metrics import r6
from creditspark.plans.q_quality import SPLIT
from creditspark.plans.q_scalars import BAND_SQL
from creditspark.plans.registry import query
from creditspark.session import fresh_dir


def split_loans(spark, sf):
    return SP.hash_split(loans(spark, sf).select("k", *S.CANONICAL_COLUMNS))


ENG = SPLIT + f""",
eng AS (SELECT *, least(greatest(coalesce(loan_amount / nullif(annual_income, 0), 0e0), 0e0), 1e1) AS loan_to_income_ratio,
  ln(1 + greatest(loan_amount, 0e0)) AS log_loan_amount, ln(1 + greatest(annual_income, 0e0)) AS log_annual_income,
  {BAND_SQL} AS credit_score_band, CAST(num_delinquencies >= 2 AS INTEGER) AS high_delinquency_risk FROM split_loans),
fit AS (SELECT {', '.join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in FE.SCALED_NUMERIC)} FROM eng WHERE split = 'train')"""


def _scaled_sql(c: str) -> str:
    return f"({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END"


CATEGORIES = {
    "loan_purpose": sorted(S.LOAN_PURPOSES),
    "home_ownership": sorted(S.HOME_OWNERSHIP),
    "credit_score_band": sorted(S.SCORE_BAND_LABELS),
}
MATRIX_SQL = ctes("loans", extra=ENG) + (
    "SELECT loan_id, "
    + ", ".join(f"{r6(_scaled_sql(c))} + 0 AS {c}" for c in FE.SCALED_NUMERIC)
    + ", "
    + ", ".join(f"CASE WHEN {c} = '{v}' THEN 1e0 ELSE 0e0 END AS {c}_{v}" for c, vs in CATEGORIES.items() for v in vs)
    + " FROM eng, fit WHERE split "
)
APPLIED, FITTED = MATRIX_SQL + "<> 'train'", MATRIX_SQL + "= 'train'"


@query(
    "engineered_features",
    ctes("loans", extra=ENG) + f"""SELECT loan_id, {r6('loan_to_income_ratio')} AS loan_to_income_ratio, {r6('log_loan_amount')} AS log_loan_amount,
    {r6('log_annual_income')} AS log_annual_income, credit_score_band, high_delinquency_risk FROM eng""",
)
def _(spark, sf):
    df = split_loans(spark, sf)
    for stage in (FE.LoanToIncomeRatio(), FE.LogColumns(), FE.ScoreBands(), FE.DelinquencyFlag()):
        df = stage.transform(df)
    df = df.withColumns({c: R(F.col(c), 6) for c in ("loan_to_income_ratio", "log_loan_amount", "log_annual_income")})
    return df.select("loan_id", "loan_to_income_ratio", "log_loan_amount", "log_annual_income", "credit_score_band", "high_delinquency_risk")


@query(
    "standard_scale",
    ctes("loans", extra=ENG) + "SELECT loan_id, " + ", ".join(f"{r6(_scaled_sql(c))} + 0 AS scaled_{c}" for c in S.NUMERIC_FEATURES) + " FROM eng, fit",
)
def _(spark, sf):
    df = split_loans(spark, sf)
    out = FE.scale_columns(df.filter(F.col("split") == "train"), df, S.NUMERIC_FEATURES)
    return out.select("loan_id", *[(R(F.col(f"scaled_{c}"), 6) + 0.0).alias(f"scaled_{c}") for c in S.NUMERIC_FEATURES])


@query(
    "one_hot",
    ctes("loans") + "SELECT loan_id, " + ", ".join(
        f"CASE WHEN {c} = '{v}' THEN 1e0 ELSE 0e0 END AS {c}_{v}" for c in S.CATEGORICAL_FEATURES for v in CATEGORIES[c]
    ) + " FROM loans",
)
def _(spark, sf):
    cats = {c: CATEGORIES[c] for c in S.CATEGORICAL_FEATURES}
    out = FE.one_hot_columns(loans(spark, sf), cats)
    return out.select("loan_id", *[f"{c}_{v}" for c, vs in cats.items() for v in vs])


def _matrix(rows, model):
    names = FE.feature_names(model)
    vectors = model.transform(rows).select("loan_id", vector_to_array("features").alias("x"))
    return vectors.select("loan_id", *[(R(F.col("x")[i], 6) + 0.0).alias(n) for i, n in enumerate(names)])


def matrix(spark, sf):
    df = split_loans(spark, sf)
    return _matrix(df.filter(F.col("split") != "train"), FE.fit_features(df.filter(F.col("split") == "train")))


query("feature_matrix", APPLIED)(matrix)
query("transform", APPLIED)(matrix)


@query("fit_transform", FITTED)
def _(spark, sf):
    train = split_loans(spark, sf).filter(F.col("split") == "train")
    return _matrix(train, FE.fit_features(train))


@query("feature_matrix_reloaded", APPLIED)
def _(spark, sf):
    df = split_loans(spark, sf)
    path = fresh_dir(spark, "features")
    FE.save_features(FE.fit_features(df.filter(F.col("split") == "train")), path)
    return _matrix(df.filter(F.col("split") != "train"), FE.load_features(path))


@query(
    "feature_names",
    ctes("loans", extra=ENG) + "SELECT feature FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature" for c in FE.SCALED_NUMERIC)
    + "".join(f" UNION ALL SELECT DISTINCT '{c}_' || {c} FROM eng WHERE split = 'train'" for c in CATEGORIES)
    + ")",
)
def _(spark, sf):
    df = split_loans(spark, sf)
    names = FE.feature_names(FE.fit_features(df.filter(F.col("split") == "train")))
    return spark.createDataFrame([(n,) for n in names], "feature string")


LINEAR = {
    "credit_score": -0.006,
    "num_delinquencies": 0.4,
    "debt_to_income_ratio": 0.5,
    "employment_years": -0.02,
    "num_open_accounts": 0.05,
    "loan_term_months": 0.01,
}
INTERCEPT = -1.0
_TERMS = {c: f"({c} - m_{c}) * CAST({w} AS DOUBLE)" for c, w in LINEAR.items()}
LIN = ENG + """,
lin AS (SELECT loan_id, split, """ + ", ".join(f"{t} AS c_{c}" for c, t in _TERMS.items()) + """ FROM eng, fit),
linlong AS (""" + " UNION ALL ".join(
    f"SELECT loan_id, {i} AS i, '{c}' AS feature, c_{c} AS v FROM lin" for i, c in enumerate(LINEAR)
) + """),
ranked_factors AS (SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY abs(v) DESC, i) AS rn FROM linlong)"""


@query(
    "feature_contributions",
    ctes("loans", extra=LIN) + f"SELECT loan_id, feature, {r6('v')} + 0 AS value FROM linlong",
)
def _(spark, sf):
    df = split_loans(spark, sf)
    out = E.linear_contributions(df, df.filter(F.col("split") == "train"), LINEAR)
    wide = out.select("loan_id", *[(R(F.col("contributions")[i], 6) + 0.0).alias(c) for i, c in enumerate(LINEAR)])
    return wide.unpivot("loan_id", list(LINEAR), "feature", "value")


@query(
    "top_factors",
    ctes("loans", extra=LIN) + """SELECT loan_id, CAST(rn AS INTEGER) AS position, feature, round_even(v * 10000, 0) / 10000 + 0 AS shap_value,
    CASE WHEN v > 0 THEN 'increases_risk' ELSE 'decreases_risk' END AS direction FROM ranked_factors WHERE rn <= 5""",
)
def _(spark, sf):
    df = split_loans(spark, sf)
    out = E.linear_contributions(df, df.filter(F.col("split") == "train"), LINEAR)
    factors = E.top_factors(F.col("contributions"), list(LINEAR))
    return (
        out.select("loan_id", F.posexplode(factors).alias("p", "f"))
        .select("loan_id", (F.col("p") + 1).alias("position"), "f.feature", "f.shap_value", "f.direction")
    )


_MARGIN = "CAST(-1 AS DOUBLE) + " + " + ".join(f"c_{c}" for c in LINEAR)


@query(
    "score_batch",
    ctes("loans", extra=LIN + f""",
scored AS (SELECT loan_id, 1 / (1 + exp(-({_MARGIN}))) AS default_probability FROM lin),
factor_list AS (SELECT loan_id, string_agg(feature, ',' ORDER BY rn) AS factors FROM ranked_factors WHERE rn <= 5 GROUP BY 1)""")
    + """SELECT s.loan_id, CASE WHEN default_probability >= 4e-1 THEN 'REJECT' ELSE 'APPROVE' END AS prediction,
    round_even(default_probability * 10000, 0) / 10000 AS default_probability,
    CASE WHEN abs(default_probability - 5e-1) >= 3e-1 THEN 'HIGH' WHEN abs(default_probability - 5e-1) >= 15e-2 THEN 'MEDIUM' ELSE 'LOW' END AS confidence,
    CASE WHEN default_probability < 2e-1 THEN 'LOW_RISK' WHEN default_probability < 45e-2 THEN 'MEDIUM_RISK' WHEN default_probability < 7e-1 THEN 'HIGH_RISK' ELSE 'VERY_HIGH_RISK' END AS risk_tier,
    factors AS top_factors, 'linear' AS model_version, 'req_' || substr(md5(s.loan_id), 1, 16) AS request_id
    FROM scored s JOIN factor_list f ON f.loan_id = s.loan_id""",
)
def _(spark, sf):
    df = split_loans(spark, sf)
    out = SC.score_linear(df, df.filter(F.col("split") == "train"), LINEAR, INTERCEPT, "linear", 0.4)
    return out.withColumn("top_factors", F.array_join(F.col("top_factors")["feature"], ","))


DECLARED = {name: MO.MODEL_DEFAULTS[name] for name in ("n_estimators", "max_depth", "learning_rate")}


# What SQL can say of a fitted model: whom it was fitted to, and relations its numbers must satisfy.
TRAINED, LOANS = ctes("loans", extra=SPLIT), ctes("loans")


def _near(a, b):
    return F.abs(F.col(a) - b) <= 1e-9


@query(
    "train_gbt",
    TRAINED + """SELECT split, count(*) AS n_samples, CAST(sum(loan_default) AS BIGINT) AS n_positives,
    TRUE AS auc_holds, TRUE AS gini_holds, TRUE AS ks_holds FROM split_loans GROUP BY split""",
)
def _(spark, sf):
    """Sizes by split; the AUC beats chance and stays below 1, Gini is 2 AUC - 1, KS lies within 0 and 1."""
    df = split_loans(spark, sf)
    features, model = MO.train(df, DECLARED)
    return MO.evaluate_splits(MO.predict(df, features, model)).select(
        "split",
        F.col("n_samples").cast("long").alias("n_samples"),
        F.col("n_positives").cast("long").alias("n_positives"),
        F.col("auc_roc").between(0.5, 1.0).alias("auc_holds"),
        _near("gini", 2 * F.col("auc_roc") - 1).alias("gini_holds"),
        F.col("ks_statistic").between(0.0, 1.0).alias("ks_holds"),
    )


@query(
    "score_batch_gbt",
    LOANS + """SELECT loan_id, 'gbt-1' AS model_version, TRUE AS probability_holds, TRUE AS decision_holds,
    TRUE AS tier_holds, TRUE AS confidence_holds, TRUE AS factors_hold FROM loans""",
)
def _(spark, sf):
    """Decision, tier and confidence follow from the probability; five factors, the largest first."""
    df = split_loans(spark, sf)
    features, model = MO.train(df, DECLARED)
    scored = MO.predict(df, features, model)
    explained = E.tree_contributions(scored, model, keep=("loan_id", "default_probability"))
    factors = E.top_factors(F.col("contributions"), FE.feature_names(features))
    out = SC.response(explained, F.col("default_probability"), "gbt-1", 0.5, factors)
    p, half = F.col("default_probability"), 5e-5  # labels are set before the probability is rounded to four digits

    def holds(name, label):
        return (F.col(name) == label(p - half)) | (F.col(name) == label(p + half))

    return out.select(
        "loan_id",
        "model_version",
        p.between(0.0, 1.0).alias("probability_holds"),
        holds("prediction", L.decision).alias("decision_holds"),
        holds("risk_tier", L.risk_tier).alias("tier_holds"),
        holds("confidence", L.confidence).alias("confidence_holds"),
        (F.size(F.array_distinct(F.col("top_factors")["feature"])) == 5).alias("factors_hold"),
    )


@query("feature_contributions_tree", LOANS + "SELECT loan_id, TRUE AS sum_holds FROM loans")
def _(spark, sf):
    """Base and contributions add up to the model's margin."""
    df = split_loans(spark, sf)
    features, model = MO.train(df, DECLARED)
    out = E.tree_contributions(MO.predict(df, features, model), model, keep=("loan_id", "default_probability"))
    total = F.col("base_value") + F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x)
    p = F.col("default_probability")
    return out.select("loan_id", (F.abs(1 / (1 + F.exp(-total)) - p) <= 1e-9).alias("sum_holds"))


@query(
    "train_result_row",
    """SELECT 'run_00000001' AS run_id, 'gbt' AS model_name, TRUE AS aucs_hold, TRUE AS threshold_holds,
    'learning_rate,max_depth,n_estimators' AS params""",
)
def _(spark, sf):
    return MO.train_result(split_loans(spark, sf), "run_00000001", "gbt", DECLARED).select(
        "run_id",
        "model_name",
        (F.col("val_auc").between(0.5, 1.0) & F.col("test_auc").between(0.5, 1.0)).alias("aucs_hold"),
        F.col("threshold").between(0.0, 1.0).alias("threshold_holds"),
        F.array_join(F.sort_array(F.map_keys("params")), ",").alias("params"),
    )


TRIALS = MO.N_TRIALS


@query(
    "hyperparameter_search",
    f"SELECT CAST(trial AS BIGINT) AS trial, TRUE AS auc_holds, TRUE AS ranges_hold, TRUE AS rounds_hold, 9::BIGINT AS n_dimensions, 1::BIGINT AS n_best FROM range({TRIALS}) AS t(trial)",
)
def _(spark, sf):
    """Every declared trial once, its nine parameters within the ranges searched, and exactly one best."""
    trials = MO.draw_trials(TRIALS, 42)
    table = MO.random_search(split_loans(spark, sf), trials)
    named = table.withColumn("run_id", F.format_string("trial_%04d", "trial"))
    best = RU.best_trial(named, "val_auc").select("run_id")
    marked = named.withColumn("is_best", F.col("run_id") == best.scalar())
    within = F.lit(True)
    for name, (_, low, high, *_rest) in MO.SEARCH_SPACE.items():
        within = within & F.col("params")[name].cast("double").between(low, high)
    n_best = marked.agg(F.count_if("is_best")).scalar()
    return marked.select(
        F.col("trial").cast("long").alias("trial"),
        F.col("val_auc").between(0.5, 1.0).alias("auc_holds"),
        within.alias("ranges_hold"),
        F.col("rounds").between(1, F.col("params")["n_estimators"].cast("int")).alias("rounds_hold"),
        F.size("params").cast("long").alias("n_dimensions"),
        n_best.alias("n_best"),
    )


IMPORTANCE = "fi AS (SELECT feature, avg(abs(value)) AS importance FROM contributions GROUP BY 1)"


@query(
    "global_importance",
    ctes("contributions", extra=IMPORTANCE) + f"SELECT feature, {r6('importance')} AS importance FROM fi ORDER BY importance DESC, feature LIMIT 20",
)
def _(spark, sf):
    return E.global_importance(contributions(spark, sf)).withColumn("importance", R(F.col("importance"), 6))


@query(
    "group_importance",
    ctes("contributions", extra=IMPORTANCE) + f"""SELECT CASE WHEN feature IN ('credit_score', 'num_delinquencies') THEN 'creditworthiness'
      WHEN feature = 'employment_years' THEN 'income_capacity' WHEN feature = 'loan_term_months' THEN 'loan_characteristics' ELSE 'debt_burden' END AS feature_group,
    {r6('sum(importance)')} AS importance FROM fi GROUP BY 1""",
)
def _(spark, sf):
    return E.group_importance(contributions(spark, sf)).withColumn("importance", R(F.col("importance"), 6))
