"""TreeSHAP over Spark trees: base + contributions equals the model output."""

import itertools
import math

import numpy as np
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from barlab.operators import explain as K


def _data(spark):
    df = spark.range(400).select(
        (F.col("id") % 13).cast("double").alias("a"),
        (F.col("id") % 7).cast("double").alias("b"),
        ((F.col("id") * 17) % 11).cast("double").alias("c"),
    ).withColumn("label", ((F.col("a") + F.col("b") * 2 + (F.col("c") > 5).cast("int") * 3) % 4 < 2).cast("int"))
    d = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    return df, d.withColumn("weight", F.lit(1.0))


def test_forest_additivity(spark):
    df, d = _data(spark)
    m = RandomForestClassifier(numTrees=7, maxDepth=4, seed=1, weightCol="weight").fit(d)
    ens = K.ensemble_of(m, spark)
    rows = m.transform(d).select("a", "b", "c", vector_to_array("probability")[1].alias("p")).limit(40).collect()
    for r in rows:
        x = np.array([r.a, r.b, r.c])
        phi, base = K.shap_values(ens, x)
        assert math.isclose(base + phi.sum(), r.p, abs_tol=1e-9)
        assert math.isclose(K.model_output(ens, x), r.p, abs_tol=1e-9)


def test_boosted_additivity(spark):
    df, d = _data(spark)
    m = GBTClassifier(maxIter=6, maxDepth=3, seed=1, weightCol="weight").fit(d)
    ens = K.ensemble_of(m, spark)
    rows = m.transform(d).select("a", "b", "c", vector_to_array("probability")[1].alias("p")).limit(40).collect()
    for r in rows:
        x = np.array([r.a, r.b, r.c])
        phi, base = K.shap_values(ens, x)
        logodds = base + phi.sum()
        assert math.isclose(1 / (1 + math.exp(-logodds)), r.p, abs_tol=1e-9)


def test_single_feature_tree_gets_all_credit(spark):
    df, d = _data(spark)
    m = RandomForestClassifier(numTrees=1, maxDepth=2, seed=3, featureSubsetStrategy="all",
                               weightCol="weight").fit(d.withColumn("features", F.col("features")))
    ens = K.ensemble_of(m, spark)
    x = np.array([3.0, 2.0, 9.0])
    phi, base = K.shap_values(ens, x)
    used = {int(f) for t in ens.trees for f in t.feature if f >= 0}
    for j in range(3):
        if j not in used:
            assert phi[j] == 0.0


def test_text_columns(spark):
    df = spark.createDataFrame(
        [("RSI_14", 75.0), ("RSI_14_lag2", 25.0), ("market_cap", 2.5e12), ("MACD_hist", -0.5),
         ("candle_hammer", 1.0), ("Stoch_D", 12.345), ("candle_net_signal", 0.0), ("revenue", 123.0)],
        "feature string, value double")
    out = df.select("feature", K.display_name(F.col("feature")).alias("n"), K.hint(F.col("feature"), F.col("value")).alias("h"),
                    K.format_value(F.col("feature"), F.col("value")).alias("v")).collect()
    got = {r.feature: (r.n, r.h, r.v) for r in out}
    assert got["RSI_14"] == ("RSI (14-day)", "overbought — often precedes a pullback", "75.0")
    assert got["RSI_14_lag2"] == ("RSI (14-day) (2d ago)", "oversold — often precedes a rebound", "25.0")
    assert got["market_cap"][2] == "2.50T"
    assert got["MACD_hist"] == ("MACD histogram", "bearish momentum building", "-0.500")
    assert got["candle_hammer"][1] == "pattern present on this candle"
    assert got["Stoch_D"] == ("Stoch D", None, "12.3")
    assert got["candle_net_signal"][1] is None
    assert got["revenue"][2] == "123"


def test_explanations_in_units_before_scaling(spark):
    from barlab.operators import clean

    rows = spark.createDataFrame([("A", 1, 10.0, 2e12), ("B", 1, 30.0, 4e12)], "ticker string, bar_date int, pe_ratio double, market_cap double")
    cols = ["pe_ratio", "market_cap", "RSI_14"]
    params = clean.standard_fit(rows, cols)
    scaled = clean.standard_transform(rows, params, cols).withColumn("RSI_14", F.lit(71.0))
    each = scaled.select("ticker", "bar_date", F.array(*cols).alias("inputs"), F.array(F.lit(0.3), F.lit(-0.2), F.lit(0.1)).alias("contributions"))
    got = {(r.ticker, r.feature): r for r in K.explanation_table(each, cols, scaling=params).collect()}
    plain = {(r.ticker, r.feature): r for r in K.explanation_table(each, cols).collect()}
    assert got["A", "pe_ratio"].value_display == "10.00" and got["B", "market_cap"].value_display == "4.00T"
    assert plain["A", "pe_ratio"].value_display == "-1.000"
    for k, r in got.items():
        assert (r["rank"], r.pushes_toward, r.shap_value) == (plain[k]["rank"], plain[k].pushes_toward, plain[k].shap_value)
    assert got["A", "RSI_14"].value == 71.0


def _odd_tree(seed, n_features=5, splits=14):
    """A tree that splits again on features of its paths; one split leaves a side without cover."""
    rng = np.random.default_rng(seed)
    left, feature, threshold, cover = [-1], [-1], [0.0], [64.0]
    for i in range(splits):
        at = int(rng.choice([n for n, x in enumerate(left) if x < 0]))
        left[at], feature[at], threshold[at] = len(left), int(rng.integers(n_features - 1)), float(rng.integers(6))
        part = 0.0 if i == 9 else cover[at] * rng.choice([0.25, 0.5, 0.625])
        left, feature, threshold, cover = left + [-1, -1], feature + [-1, -1], threshold + [0.0, 0.0], cover + [part, cover[at] - part]
    left = np.array(left)
    return K.TreeArrays(left, np.where(left >= 0, left + 1, -1), np.array(feature), np.array(threshold), np.where(left < 0, rng.random(len(left)), 9.0), np.array(cover))


def _paid(t, x, coalition, node=0):
    """What a tree pays a coalition: other features go either way by cover."""
    if t.left[node] < 0:
        return t.value[node]
    f, kids = t.feature[node], (t.left[node], t.right[node])
    if f in coalition:
        return _paid(t, x, coalition, kids[int(x[f] > t.threshold[node])])
    return sum(_paid(t, x, coalition, k) * t.cover[k] / t.cover[node] for k in kids if t.cover[k])


def test_contributions_are_the_shapley_sums():
    n = 5
    for seed in range(6):
        trees = [_odd_tree(seed), _odd_tree(seed + 50, splits=seed)]
        ens = K.Ensemble("boosted", trees, np.array([0.5, 2.0]), n)
        xs = np.random.default_rng(seed).integers(-1, 7, (30, n)).astype(float)
        phi, base = K.shap_batch(ens, xs, max_cells=200)
        assert math.isclose(base, sum(w * _paid(t, xs[0], ()) for t, w in zip(trees, ens.weights)), abs_tol=1e-12)
        assert not phi[:, n - 1].any()
        for x, got in zip(xs, phi):
            for f in range(n):
                others = [g for g in range(n) if g != f]
                want = sum(math.factorial(k) * math.factorial(n - 1 - k) / math.factorial(n) * w * (_paid(t, x, {*c, f}) - _paid(t, x, c))
                           for k in range(n) for c in itertools.combinations(others, k) for t, w in zip(trees, ens.weights))
                assert math.isclose(got[f], want, abs_tol=1e-12)


def test_rows_are_explained_by_several_tasks(spark, monkeypatch):
    """A few hundred rows are small in bytes and arrive in one partition; each is a walk through all trees."""
    rows = spark.range(200).coalesce(1).select(F.concat(F.lit("T"), "id").alias("ticker"), F.col("id").cast("int").alias("bar_date"),
                                               *[(F.col("id") * k % 7).cast("double").alias(f"x{k}") for k in range(1, 6)])
    ens = K.Ensemble("boosted", [_odd_tree(3)], np.array([1.0]), 5)
    cols = [f"x{k}" for k in range(1, 6)]
    monkeypatch.setattr(K, "ensemble_of", lambda *a: ens)
    out = K.explain_rows(rows, None, cols).withColumn("task", F.spark_partition_id()).collect()
    assert sorted(r.ticker for r in out) == sorted(f"T{i}" for i in range(200))
    assert len({r.task for r in out}) > 1
    for r in out:
        assert math.isclose(r.base_value + sum(r.contributions), K.model_output(ens, np.array(r.inputs)), abs_tol=1e-12)
