"""Feature stages, boosted trees, contributions, scoring."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from creditspark import schema as S
from creditspark.operators import boosting as B, explain as E, features as FE, model as MO, scoring as SC, split as SP
from creditspark.session import fresh_dir
from creditspark.sources import generate as G

QUICK = {"n_estimators": 4, "max_depth": 3, "learning_rate": 0.3}


@pytest.fixture(scope="module")
def loans(spark):
    return SP.hash_split(G.generate_loans(spark.range(1, 3001), "id")).cache()


@pytest.fixture(scope="module")
def fitted(loans):
    return MO.train(loans, QUICK)


def test_scaling_is_population(spark):
    df = spark.createDataFrame([(1.0, 5), (2.0, 5), (6.0, 5)], "x double, c int")
    got = FE.PopulationScaler(inputCols=["x", "c"]).fit(df).transform(df).orderBy("x").collect()
    want = (np.array([1, 2, 6]) - 3) / np.std([1, 2, 6])
    assert [r.scaled_x for r in got] == pytest.approx(list(want)) and [r.scaled_c for r in got] == [0.0] * 3
    wide = FE.scale_columns(df, df, ["x", "c"]).orderBy("x").collect()
    assert [r.scaled_x for r in wide] == pytest.approx(list(want)) and [r.scaled_c for r in wide] == [0.0] * 3


def test_unseen_category_is_zeros(loans):
    train = loans.filter("loan_purpose <> 'medical'")
    model = FE.fit_features(train)
    names = FE.feature_names(model)
    assert "loan_purpose_medical" not in names and names[:8] == S.NUMERIC_FEATURES and len(names) == 11 + 5 + 3 + 5
    x = model.transform(loans.filter("loan_purpose = 'medical'")).select(vector_to_array("features").alias("x")).first().x
    assert len(x) == len(names) and sum(x[i] for i, n in enumerate(names) if n.startswith("loan_purpose_")) == 0.0


def test_features_survive_saving(spark, loans):
    model = FE.fit_features(loans, include_flag=True)
    path = fresh_dir(spark, "features")
    FE.save_features(model, path)
    again = FE.load_features(path)
    assert FE.feature_names(again) == FE.feature_names(model) and "high_delinquency_risk" in FE.feature_names(model)
    a, b = (m.transform(loans).select("loan_id", vector_to_array("features").alias("x")) for m in (model, again))
    assert a.exceptAll(b).isEmpty()


def test_model_ranks_better_than_chance(loans, fitted):
    scored = MO.predict(loans, *fitted)
    assert scored.filter("default_probability NOT BETWEEN 0 AND 1").isEmpty()
    auc = {r.split: r.auc_roc for r in MO.evaluate_splits(scored).collect()}
    assert set(auc) == {"train", "val", "test"} and auc["train"] > 0.65 and auc["test"] > 0.5


def log_loss(rows, model):
    val = rows.filter("is_val").select(vector_to_array("features").alias("x"), "label").collect()
    x, y = np.array([r.x for r in val]), np.array([r.label for r in val])
    return [float(np.mean(np.logaddexp(0, m) - y * m)) for m in (model.margins(x, k) for k in range(1, model.num_trees + 1))]


def test_early_stop_keeps_the_best_round(loans):
    assert B.stop_at([5, 4, 3, 3.5, 3.4, 2], 2) is None and B.stop_at([5, 4, 3, 3.5, 3.4], 2) == 3
    features = FE.fit_features(loans.filter("split = 'train'"))
    data = B.Binned(MO.training_rows(loans, features))
    params = MO.full_params({"learning_rate": 0.3, "n_estimators": 200})
    trees, losses = B.more_rounds(data, params, [], [], 200, 1, 10)
    best = int(np.argmin(losses)) + 1
    assert len(losses) == best + 10 < 200  # ended within the fit
    model = B.fit(data, params, 1, 10)
    assert model.num_trees == best and model.losses == losses[:best]
    assert log_loss(MO.training_rows(loans, features), model) == pytest.approx(model.losses)


def test_rounds_and_tasks_do_not_change_the_trees(loans):
    rows = MO.training_rows(loans, FE.fit_features(loans.filter("split = 'train'")))
    params = MO.full_params({"n_estimators": 6, "max_depth": 4})
    data = B.Binned(rows)
    many = data.spread(4)
    assert data.tasks == 1 and many.table.rdd.getNumPartitions() == 4
    one = B.fit(data, params)
    parts = B.fit(data, params, job_rounds=2)
    over = B.fit(many, params)
    for other in (parts, over):
        a, b = one.nodes(), other.nodes()
        assert a[["tree", "node", "feature", "bin", "left", "right", "cover"]].equals(b[["tree", "node", "feature", "bin", "left", "right", "cover"]])
        assert np.allclose(a["value"], b["value"])
        assert one.losses == pytest.approx(other.losses)


def plain_tree(bins, g, h, p, width, depth=0):
    """A tree by plain recursion over all splits: nested (feature, bin, left, right), or the value of a leaf."""
    shrink = lambda x: np.sign(x) * max(abs(x) - p["reg_alpha"], 0)
    score = lambda m: shrink(g[m].sum()) ** 2 / (h[m].sum() + p["reg_lambda"])
    every = np.ones(len(g), bool)
    best = None
    for f in range(bins.shape[1]):
        for b in range(width - 1):
            left = bins[:, f] <= b
            if min(left.sum(), (~left).sum()) < p["min_child_samples"] or min(h[left].sum(), h[~left].sum()) < p["min_child_weight"]:
                continue
            gain = 0.5 * (score(left) + score(~left) - score(every)) - p["gamma"]
            if gain > 1e-12 and (best is None or gain > best[0] + 1e-12):
                best = (gain, f, b, left)
    if best is None or depth == p["max_depth"]:
        return -shrink(g.sum()) / (h.sum() + p["reg_lambda"]) * p["learning_rate"]
    _, f, b, left = best
    return f, b, plain_tree(bins[left], g[left], h[left], p, width, depth + 1), plain_tree(bins[~left], g[~left], h[~left], p, width, depth + 1)


@pytest.mark.parametrize("seed", range(12))
def test_grown_trees_against_plain_recursion(seed):
    rng = np.random.default_rng(seed)
    bins = rng.integers(0, 6, (80, 4)).astype(np.uint8)
    g, h = rng.normal(size=80), rng.random(80) * 0.25
    p = {"reg_alpha": [0.0, 0.5][seed % 2], "reg_lambda": 1.0, "gamma": [0.0, 0.2][seed % 3 == 0], "min_child_samples": 3, "min_child_weight": 0.3, "max_depth": 3, "learning_rate": 0.1}
    tree = B.grow(bins, g, h, np.arange(80), np.arange(4), [6] * 4, p)

    def same(node, want):
        if isinstance(want, tuple):
            assert (tree.feature[node], tree.bin[node]) == want[:2]
            same(tree.left[node], want[2])
            same(tree.right[node], want[3])
        else:
            assert tree.left[node] == -1 and tree.value[node] == pytest.approx(want)

    same(0, plain_tree(bins, g, h, p, 6))
    # leaf by leaf with leaves to spare, the same tree; with few, the largest gains first
    whole = B.grow(bins, g, h, np.arange(80), np.arange(4), [6] * 4, {**p, "num_leaves": 100})
    assert sorted(whole.value[whole.left < 0]) == pytest.approx(sorted(tree.value[tree.left < 0]))
    few = B.grow(bins, g, h, np.arange(80), np.arange(4), [6] * 4, {**p, "num_leaves": 3})
    assert (few.left < 0).sum() == min(3, (tree.left < 0).sum())


def test_one_class_constant_features_and_no_validation(spark, loans):
    from pyspark.ml.linalg import Vectors

    rows = [(Vectors.dense([1.0, float(k % 3)]), float(k % 2), 1.0, False) for k in range(60)]
    df = spark.createDataFrame(rows, ["features", "label", "weight", "is_val"])
    model = B.fit(B.Binned(df), MO.full_params({"n_estimators": 3}))
    assert model.num_trees == 3 and all(t.feature[0] == 1 for t in model.trees if t.left[0] >= 0)
    only = B.fit(B.Binned(df.where("label = 1")), MO.full_params({"n_estimators": 3}))
    p = B.predict(df, only).agg(F.min("default_probability")).first()[0]
    assert p > 0.99
    with pytest.raises(ValueError):
        B.Binned(df.limit(0))


def test_model_survives_saving(spark, loans, fitted):
    path = fresh_dir(spark, "model")
    MO.save_model(*fitted, path)
    again = MO.load_model(spark, path)
    a, b = (MO.predict(loans, *m).select("loan_id", "default_probability") for m in (fitted, again))
    assert a.exceptAll(b).isEmpty() and again[1].losses == pytest.approx(fitted[1].losses)


def test_tree_contributions_add_up(loans, fitted):
    features, model = fitted
    scored = MO.predict(loans, features, model)
    out = E.tree_contributions(scored, model, keep=("loan_id", "default_probability"))
    gap = out.select(
        F.abs(1 / (1 + F.exp(-(F.col("base_value") + F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x)))) - F.col("default_probability")).alias("g")
    ).agg(F.max("g")).first()[0]
    assert gap < 1e-9 and out.count() == 3000


def test_tree_contributions_are_shapley_values(spark, loans):
    features, model = MO.train(loans, {"n_estimators": 3, "max_depth": 2, "learning_rate": 0.3})
    leaves = E.leaf_paths(model)
    rows = features.transform(loans.limit(3)).select("loan_id", "features")
    got = {r.loan_id: r.contributions for r in E.tree_contributions(rows, model).collect()}
    used = sorted({p[0] for _, path in leaves for p in path})
    assert 0 < len(used) <= 10

    def value(x, known):
        total = 0.0
        for v, path in leaves:
            w = 1.0
            for f, low, high, share in path:
                w *= float(low < x[f] <= high) if f in known else share
            total += v * w
        return total

    for r in rows.select("loan_id", vector_to_array("features").alias("x")).collect():
        for f in used:
            rest, phi = [u for u in used if u != f], 0.0
            for k in range(len(rest) + 1):
                for s in combinations(rest, k):
                    weight = factorial(k) * factorial(len(used) - k - 1) / factorial(len(used))
                    phi += weight * (value(r.x, {*s, f}) - value(r.x, set(s)))
            assert got[r.loan_id][f] == pytest.approx(phi, abs=1e-9)


def test_top_factor_order(spark):
    df = spark.createDataFrame([([0.1, -0.5, 0.5, 0.0, 0.00004, -0.2],)], "c array<double>")
    got = df.select(E.top_factors(F.col("c"), list("abcdef"))).first()[0]
    assert [(f.feature, f.shap_value, f.direction) for f in got] == [
        ("b", -0.5, "decreases_risk"), ("c", 0.5, "increases_risk"), ("f", -0.2, "decreases_risk"),
        ("a", 0.1, "increases_risk"), ("e", 0.0, "increases_risk")]


def test_score_records(loans):
    out = SC.score_linear(loans.drop("num_delinquencies"), loans, {"credit_score": -0.01, "num_delinquencies": 0.5}, -1.0)
    assert out.columns == ["loan_id", *SC.RESPONSE_COLUMNS] and out.count() == 3000


@pytest.mark.parametrize("space", [MO.SEARCH_SPACE, MO.LEAF_WISE_SPACE], ids=["by level", "leaf by leaf"])
def test_search(loans, space):
    small = {**space, "n_estimators": ("int", 2, 8, 1), "max_depth": ("int", 2, 4, 1)}
    trials = MO.draw_trials(5, 1, small)
    assert len(space) == 9 and trials == MO.draw_trials(5, 1, small) and set(trials[0]) == set(space)
    table = MO.random_search(loans, trials)
    rows = {r.trial: r for r in table.collect()}
    assert len(rows) == 5 and all(0 < r.val_auc < 1 and 1 <= r.rounds <= 8 and not r.pruned for r in rows.values())
    for i in (0, 3):  # the same as fitted alone
        scored = MO.predict(loans.filter("split = 'val'"), *MO.train(loans, trials[i]))
        assert MO.evaluate_splits(scored).first().auc_roc == pytest.approx(rows[i].val_auc)


def test_pruned_search_ends_the_worse_half(loans):
    trials = [{"n_estimators": 6, "learning_rate": rate, "max_depth": 3} for rate in (1e-3, 2e-3, 0.05, 0.1, 0.2)]
    rows = {r.trial: r for r in MO.random_search(loans, trials, prune=True, step=2).collect()}
    assert rows[0].pruned and rows[0].rounds == 2 and not rows[4].pruned and rows[4].rounds > 2


@pytest.mark.parametrize("d", [1, 2, 3, 6, 9])
def test_leaf_shapley_against_all_coalitions(d):
    rng = np.random.default_rng(d)
    met, shares = (rng.random((5, d)) < 0.5).astype(float), rng.random(d) * 0.9 + 0.05
    got = E.leaf_shapley(met, shares)
    for row, values in zip(met, got):
        for i in range(d):
            others, total = [j for j in range(d) if j != i], 0.0
            for k in range(d):
                for inside in combinations(others, k):
                    weight = factorial(k) * factorial(d - k - 1) / factorial(d)
                    total += weight * np.prod([row[j] if j in inside else shares[j] for j in others])
            assert values[i] == pytest.approx((row[i] - shares[i]) * total, abs=1e-12)


def test_leaf_shapley_of_a_deep_path_adds_up():
    rng = np.random.default_rng(0)
    met, shares = (rng.random((7, 40)) < 0.5).astype(float), rng.random(40) * 0.5 + 0.5
    assert E.leaf_shapley(met, shares).sum(axis=1) == pytest.approx(met.prod(axis=1) - shares.prod())


@pytest.mark.parametrize(
    "name",
    ["train_gbt", "score_batch_gbt", "feature_contributions_tree", "train_result_row", "hyperparameter_search", "training_pipeline"],
)
def test_queries_fit_with_the_declared_values(spark, sf, monkeypatch, name):
    from creditspark.plans import q_model, q_pipeline  # noqa: F401
    from creditspark.plans.registry import QUERIES

    class Fitted(Exception):
        pass

    def fit(rows, params=None, seed=42, patience=None):
        raise Fitted(params)

    def search(loans, trials, **kw):
        raise Fitted(trials[-1])

    monkeypatch.setattr(MO, "fit_boosted", fit)
    monkeypatch.setattr(MO, "random_search", search)
    with pytest.raises(Fitted) as seen:
        QUERIES[name](spark, sf)
    params = seen.value.args[0]
    if name == "hyperparameter_search":
        assert params in MO.draw_trials(q_model.TRIALS, 42)
    else:
        assert {**MO.MODEL_DEFAULTS, **params} == MO.MODEL_DEFAULTS


def test_a_fit_of_many_rows_exchanges_nothing(spark):
    """Spark's barrier takes a second for an exchange, and a round has several: rows that one task can hold stay in one."""
    from pyspark.ml.functions import array_to_vector

    k = F.col("id")
    rows = spark.range(120_000).select(
        array_to_vector(F.array((k % 97).cast("double"), (k % 2).cast("double"))).alias("features"),
        (k * 7919 % 97 < 40).cast("double").alias("label"),
        F.lit(1.0).alias("weight"),
        (k % 8 == 0).alias("is_val"),
    )
    data = B.Binned(rows)
    assert data.tasks == 1 and B.Binned(rows, rows_per_task=50_000).tasks == min(3, spark.sparkContext.defaultParallelism)
    model = B.fit(data, MO.full_params({"n_estimators": 3, "max_depth": 3, "subsample": 1.0}))
    assert [t.cover[0] for t in model.trees] == [105_000] * model.num_trees  # every row of train


@pytest.mark.parametrize("seed", range(6))
def test_grouped_columns_count_as_each_alone(seed):
    rng = np.random.default_rng(seed)
    kind, value = rng.integers(0, 4, 300), rng.integers(0, 6, 300)
    bins = np.column_stack([kind == 0, value, kind == 1, rng.integers(0, 6, 300), kind == 2, value, (value + (rng.random(300) < 0.2)).clip(0, 5)]).astype(np.uint8)
    widths = np.array([2, 6, 2, 6, 2, 6, 6])
    codes = B._Codes(bins, widths)
    assert len(codes.groups) < 7 and sorted(f for group in codes.groups for f in group.members) == list(range(7))
    for group in codes.groups:
        assert (group.bins[group.codes] == bins[:, group.members]).all()
    g, h = rng.normal(size=300), rng.random(300) + 0.1
    p = {"reg_alpha": 0.0, "reg_lambda": 1.0, "gamma": 0.0, "min_child_samples": [1, 3][seed % 2], "min_child_weight": 0.5, "max_depth": 3, "learning_rate": 0.1}
    columns = np.array([[0, 1, 2, 3, 4, 5, 6], [0, 2, 3, 4, 6]][seed % 2])
    grower = B._Grower(codes, g, h, np.arange(0, 300, 2), columns, p, lambda x: x)
    grower.rows |= {1: np.arange(0, 200), 2: np.arange(200, 203)}
    sums, sizes = grower._counted([1, 2])
    for at, rows in enumerate((np.arange(200), np.arange(200, 203))):
        for c, f in enumerate(columns):
            own = slice(grower.first[c], grower.first[c] + widths[f])
            for plane, v in enumerate((g, h, np.ones(300))[: grower.planes]):
                assert sums[plane, at, own] == pytest.approx([v[rows][bins[rows, f] == b].sum() for b in range(widths[f])])
    assert sizes.tolist() == [200, 3]
    tree = grower.grown()[0]
    assert tree.cover[0] == 150 and tree.cover[tree.left < 0].sum() == 150


@pytest.mark.parametrize("deep", [False, True])
def test_tables_of_ways_give_the_same_contributions(monkeypatch, deep):
    """Rows look their contributions up by the conditions they meet; row by row the same comes out."""
    rng = np.random.default_rng(3)
    bins = rng.integers(0, 8, (900, 6)).astype(np.uint8)
    g, h = rng.normal(size=900), rng.random(900) + 0.1
    params = MO.full_params({"max_depth": 9 if deep else 4, "min_child_weight": 0.2, "learning_rate": 0.3})
    trees = [B.grow(bins, g + k, h, np.arange(900), np.arange(6), [8] * 6, params) for k in range(2)]
    model = B.BoostedTrees(trees, [np.arange(7) + 0.5] * 6, 0.1, [0.0, 0.0])
    x = bins.astype(float)
    x[0, 0] = np.nan  # goes right, as in the model
    want = np.zeros_like(x)
    for value, path in E.leaf_paths(model):
        features, (low, high, shares) = [q[0] for q in path], np.array([q[1:] for q in path]).T
        # of a missing value x <= low never holds, so it lies above every cut
        own = np.where(np.isnan(x), 1e9, x)[:, features]
        want[:, features] += value * E.leaf_shapley(((own > low) & (own <= high)).astype(float), shares)
    counted = []
    monkeypatch.setattr(E, "leaf_shapley", lambda met, shares, f=E.leaf_shapley: counted.append(len(met)) or f(met, shares))
    for ways, rows in ((1 << 10, 900), (1 << 10, 40), (2, 900)):
        monkeypatch.setattr(E, "MOST_WAYS", ways)
        counted.clear()
        phi = np.zeros((6, rows))
        for group in E.leaf_groups(model):
            group.add(model.codes(x[:rows]), phi)
        assert phi.T == pytest.approx(want[:rows], abs=1e-12)
        assert max(counted) <= (64 if ways > 2 else rows)  # six features: 64 ways at most, however many rows
    base = model.base + sum(v * np.prod([q[3] for q in path]) for v, path in E.leaf_paths(model))
    assert base + want.sum(axis=1) == pytest.approx(model.margins(x))


def test_search_waits_for_no_other_trial_and_keeps_no_trees(loans, monkeypatch):
    """A trial goes on to its end by itself, and its trees go when it is scored."""
    held, seen = [], []

    def turn(data, params, trees, losses, upto, *rest, f=B.more_rounds):
        seen.append((params["learning_rate"], upto))
        return f(data, params, trees, losses, upto, *rest)

    def score(rows, models, first=0, f=B.predict_all):
        held.append(len(models))
        return f(rows, models, first)

    monkeypatch.setattr(B, "more_rounds", turn)
    monkeypatch.setattr(B, "predict_all", score)
    trials = [{"n_estimators": n, "learning_rate": rate, "max_depth": 2} for n, rate in ((2, 0.1), (6, 0.2), (4, 0.3))]
    rows = MO.random_search(loans, trials, parallelism=1, step=2).collect()
    assert [(r.trial, r.rounds <= t["n_estimators"], r.pruned) for r, t in zip(rows, trials)] == [(i, True, False) for i in range(3)]
    assert seen == [(0.2, 2), (0.2, 4), (0.2, 6), (0.3, 2), (0.3, 4), (0.1, 2)]  # the longest first, each to its end
    assert held == [1, 1, 1]


MANY_ROWS = ["score_batch_gbt", "stream_score_gbt", "train_result_row", "training_pipeline"]


@pytest.mark.parametrize("name", MANY_ROWS)
def test_queries_fit_many_rows_without_exchanges(spark, monkeypatch, name):
    """Over two tasks these fits took a second for each of some eight exchanges a round."""
    from creditspark.plans import q_model, q_pipeline, q_stream
    from creditspark.plans.registry import QUERIES

    class Fitted(Exception):
        pass

    def fit(data, params, *rest):
        raise Fitted(data.tasks, data.table.count(), {k: params[k] for k in q_model.DECLARED})

    def many(spark, sf=None):
        return G.generate_loans(spark.range(1, 150_001), "id")

    monkeypatch.setattr(B, "fit", fit)
    for module in (q_model, q_stream):
        monkeypatch.setattr(module, "split_loans", lambda spark, sf: SP.hash_split(many(spark)))
    monkeypatch.setattr(q_pipeline, "raw_card", many)
    monkeypatch.setattr(q_pipeline, "canonicalize", lambda rows: rows)
    with pytest.raises(Fitted) as seen:
        QUERIES[name](spark, "no tables")
    tasks, rows, params = seen.value.args
    assert tasks == 1 and rows > 100_000 and params == q_model.DECLARED
