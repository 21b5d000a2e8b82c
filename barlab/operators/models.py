"""Model jobs.

Forests and boosting are those of ``trees``; the linear model and the net are in
``gradients``. Scores differ from other libraries' by design. Data work stays in
Spark: assembly, class weights, time-ordered folds, metrics.
"""

from __future__ import annotations

import logging
import random
import uuid

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.operators import clean, gradients, trees
from barlab.operators.candles import CANDLE_COLS
from barlab.operators.labels import walk_forward_folds
from barlab.operators.metrics import binary_metrics, positive_weight
from barlab.operators.quarterly import QUARTERLY_FEATURE_COLS
from barlab.session import cut_lineage

log = logging.getLogger("barlab.models")

# Model inputs, in the fixed order of the reference's training script.
TECH_COLS = (
    "daily_return", "MA7", "MA21", "MA_crossover", "RSI_14",
    "MACD", "MACD_signal", "MACD_hist", "BB_width",
    "volume_change", "price_range",
    "Stoch_K", "Stoch_D", "ATR_14", "ADX_14", "OBV_roc_5",
    "daily_return_lag1", "daily_return_lag2", "daily_return_lag3",
    "RSI_14_lag1", "RSI_14_lag2",
)
FUND_COLS = ("pe_ratio", "eps", "market_cap", "debt_to_equity", "current_ratio")
CANDLE_FEATURES = (
    "candle_doji", "candle_hammer", "candle_inverted_hammer", "candle_shooting_star",
    "candle_bullish_marubozu", "candle_bearish_marubozu",
    "candle_bullish_engulfing", "candle_bearish_engulfing",
    "candle_morning_star", "candle_evening_star",
    "candle_bullish_signal_count", "candle_bearish_signal_count", "candle_net_signal",
)
FEATURE_COLS = TECH_COLS + FUND_COLS + CANDLE_FEATURES + QUARTERLY_FEATURE_COLS
assert set(CANDLE_FEATURES) == set(CANDLE_COLS)
EDA_IMPORTANCE_COLS = TECH_COLS[:11] + FUND_COLS

# Search spaces in the terms of trees.Spec: fixed values.
RF_GRID = {
    "trees": [100, 200, 300],
    "depth": [4, 6, 8, trees.NO_DEPTH],
    "min_rows": [1, 5, 10, 20],
    "node_features": ["sqrt", "log2", 0.5],
}
GBT_GRID = {
    "trees": [100, 200, 300],
    "depth": [3, 4, 5, 6],
    "rate": [0.01, 0.03, 0.05, 0.1],
    "rows": [0.7, 0.85, 1.0],
    "tree_features": [0.7, 0.85, 1.0],
}
SEED = 42


def present(df: DataFrame, cols=FEATURE_COLS) -> list[str]:
    return [c for c in cols if c in df.columns]


def assemble(df: DataFrame, cols=FEATURE_COLS, out: str = "features") -> DataFrame:
    """G1: missing inputs -> 0, then one vector column."""
    cols = present(df, cols)
    filled = clean.fill_zero(df.withColumns({c: F.col(c).cast("double") for c in cols}), cols)
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(filled)


def add_balanced_weight(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Weight n / (2 n_c) per class (two-row table, broadcast)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    total = counts.agg(F.sum("_nc").alias("_n"))
    w = counts.crossJoin(total).select(label, (F.col("_n") / (2 * F.col("_nc"))).alias(out))
    return df.join(F.broadcast(w), label, "left")


def add_positive_weight(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Class 1 weighs n0 / max(n1, 1), class 0 weighs 1."""
    pw = df.agg((F.count_if(F.col(label) == 0) / F.greatest(F.count_if(F.col(label) == 1), F.lit(1))).alias("_pw"))
    return df.crossJoin(F.broadcast(pw)).withColumn(
        out, F.when(F.col(label) == 1, F.col("_pw")).otherwise(F.lit(1.0))).drop("_pw")


def spec(family: str = "rf", **params) -> trees.Spec:
    """Balanced forest; G5: second-order boosting on log loss; G13: leaf-wise boosting."""
    return {"rf": trees.Spec, "gbt": trees.boosted, "leafwise": trees.leafwise}[family](**{"seed": SEED, **params})


def with_probability(pred: DataFrame) -> DataFrame:
    """H1 input: class-1 probability as a double column ``p``."""
    return pred.withColumn("p", vector_to_array("probability")[1])


def fit(df: DataFrame, family: str = "rf", cols=FEATURE_COLS, weighted: bool = True, **params) -> trees.TreeModel:
    """Fixed-parameter training of one family; missing inputs are 0. A forest's classes are
    balanced, a boosted run's positive class weighs n0 / n1, unless not ``weighted``."""
    cols = present(df, cols)
    return trees.fit(df, cols, spec(family, **params), "default" if weighted else None)


def predict(model, df: DataFrame, cols=FEATURE_COLS, keep=("ticker", "bar_date", "label")) -> DataFrame:
    """Scored rows: kept columns, prediction, class-1 probability ``p``."""
    pred = model.transform(assemble(df, cols))
    keep = [c for c in keep if c in df.columns]
    return with_probability(pred).select(*keep, F.col("prediction").cast("int").alias("prediction"), "p")


def evaluate(model, test: DataFrame, cols=FEATURE_COLS) -> DataFrame:
    """G8 on the test rows."""
    return binary_metrics(predict(model, test, cols))


def _draws(grid: dict, n_iter: int, seed: int) -> list[dict]:
    combos = [{}]
    for n in grid:
        combos = [dict(c, **{n: v}) for c in combos for v in grid[n]]
    rng = random.Random(seed)
    return combos if n_iter >= len(combos) else rng.sample(combos, n_iter)


def search_draws(family: str = "rf", grid: dict | None = None, n_iter: int = 15, seed: int = SEED) -> list[dict]:
    """The seeded draws of a search."""
    return _draws(grid or (RF_GRID if family == "rf" else GBT_GRID), n_iter, seed)


def random_search(train: DataFrame, family: str = "rf", grid: dict | None = None, n_iter: int = 15,
                  n_folds: int = 5, seed: int = SEED, cols=FEATURE_COLS, align: str = "date"):
    """Seeded random draws from the grid, each scored by mean F1 over
    walk-forward folds; the best draw is refit on all training rows.

    Folds come from the date-count table (no global row sort). The rows are binned
    once and all (draw, fold) fits run as one job (``trees.search``).
    Returns (best model, best params, table of per-draw scores).
    """
    draws, cols = search_draws(family, grid, n_iter, seed), present(train, cols)
    folded = walk_forward_folds(train, n_folds, align=align)
    folded = cut_lineage(folded.select("bar_date", "ticker", "label", "_pos", "fold", *[F.col(c).cast("double").alias(c) for c in cols]))
    starts = folded.filter(F.col("fold").isNotNull()).groupBy("fold").agg(F.min("_pos").alias("start"))
    bounds = {r["fold"]: r["start"] for r in starts.collect()}  # n_folds small numbers
    found = trees.search(folded, cols, [spec(family, **d) for d in draws], bounds)
    names = F.element_at(F.array(*[F.lit(str(d)) for d in draws]), F.col("draw") + 1)
    scores = found.withColumn("params", names).select("draw", "params", "fold", "test_rows", "tp", "fp", "fn", "tn", "f1")
    best = scores.groupBy("draw").agg(F.avg("f1").alias("f1")).orderBy(F.desc("f1"), "draw").first()
    best_params = draws[best["draw"]]
    log.info("draw %d wins with mean F1 %.4f: %s", best["draw"], best["f1"], best_params)
    return fit(train, family, cols, **best_params), best_params, scores


def _standardised(train: DataFrame, test: DataFrame, cols):
    """Standardise every input on training statistics (population std; NULL -> 0)."""
    params = clean.standard_fit(train, cols)
    return clean.standard_transform(train, params, cols), clean.standard_transform(test, params, cols)


def logistic_regression(train: DataFrame, test: DataFrame, cols=FEATURE_COLS):
    """Balanced logistic regression on inputs standardised with training
    statistics, with an L2 term of unit weight against the summed loss."""
    cols = present(train, cols)
    tr, te = _standardised(train, test, cols)
    return gradients.logistic(add_balanced_weight(assemble(tr, cols)), l2=1.0), te


def neural_net(train: DataFrame, test: DataFrame, cols=FEATURE_COLS, max_iter: int = 500):
    """Net with hidden layers 32 and 16; a held-out tenth of the rows stops the fit."""
    cols = present(train, cols)
    tr, te = _standardised(train, test, cols)
    return gradients.net(assemble(tr, cols), hidden=(32, 16), max_epochs=max_iter, seed=SEED), te


def compare_models(train: DataFrame, test: DataFrame, cols=FEATURE_COLS, include_second_boosting: bool = True,
                   rf_params=None, gbt_params=None, gbt2_params=None, mlp_iter: int = 500) -> DataFrame:
    """G14 (+ G13): several families on one split; one metrics row per family."""
    rows = []
    rf = fit(train, "rf", cols, **(rf_params or dict(trees=200, depth=6)))
    rows.append(evaluate(rf, test, cols).select(F.lit("RandomForest").alias("model"), "*"))
    # the boosted families are compared without a class weight
    gbt = fit(train, "gbt", cols, weighted=False, **(gbt_params or dict(trees=200, depth=5, rate=0.05)))
    rows.append(evaluate(gbt, test, cols).select(F.lit("BoostedTrees").alias("model"), "*"))
    if include_second_boosting:
        gbt2 = fit(train, "leafwise", cols, weighted=False, **(gbt2_params or dict(trees=200, depth=5, rate=0.05)))
        rows.append(evaluate(gbt2, test, cols).select(F.lit("LeafwiseTrees").alias("model"), "*"))
    lr, te = logistic_regression(train, test, cols)
    rows.append(evaluate(lr, te, cols).select(F.lit("LogisticRegression").alias("model"), "*"))
    mlp, te = neural_net(train, test, cols, mlp_iter)
    rows.append(evaluate(mlp, te, cols).select(F.lit("NeuralNet").alias("model"), "*"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def feature_importance(model, cols, top_n: int | None = 15) -> DataFrame:
    """Importances zipped to input names, largest first."""
    spark = SparkSession.getActiveSession()
    imp = model.featureImportances.toArray().tolist()
    rows = sorted(zip(cols, imp), key=lambda t: (-t[1], t[0]))
    if top_n:
        rows = rows[:top_n]
    return spark.createDataFrame([(c, float(v)) for c, v in rows], "feature string, importance double")


def standalone_importance(df: DataFrame, cols=EDA_IMPORTANCE_COLS, **params) -> DataFrame:
    """Balanced 100-tree forest on the EDA inputs, all importances sorted."""
    cols = present(df, cols)
    m = fit(df, "rf", cols, **{"trees": 100, **params})
    return feature_importance(m, cols, top_n=None)


def save_model(model: trees.TreeModel, path: str) -> None:
    """The node table as parquet, overwritten."""
    model.save(SparkSession.getActiveSession(), path)


def load_models(paths: dict[str, str]) -> dict[str, trees.TreeModel]:
    """Load the models that exist; missing or unreadable ones are skipped."""
    out = {}
    for name, path in paths.items():
        try:
            out[name] = trees.TreeModel.load(SparkSession.getActiveSession(), path)
        except Exception as e:
            log.info("no model at %s: %s", path, (str(e).splitlines() or [""])[0])
    return out


RUN_NAMES = {"rf": ("random_forest", "barlab_forest"), "gbt": ("boosted_trees", "barlab_boosting")}


def train_and_log(train: DataFrame, test: DataFrame, log_path: str | None = None, model_dir: str | None = None,
                  tune: bool = True, rf_params=None, gbt_params=None, **search) -> dict:
    """Train both families, tuned by ``random_search`` or with fixed parameters,
    save the models and append a run with parameters, metrics, times and status
    to the log; a failed fit is logged too, and raised. name -> (model, metrics)."""
    from barlab.operators.runlog import append_run, now

    spark, out = train.sparkSession, {}
    fixed = {"rf": rf_params or dict(trees=100), "gbt": gbt_params or dict(trees=200, depth=5, rate=0.05)}
    for family, (name, registered) in RUN_NAMES.items():
        run_id, start = uuid.uuid4().hex, now()
        try:
            if tune:
                model, params, _ = random_search(train, family, **search)
            else:
                model, params = fit(train, family, **fixed[family]), fixed[family]
            metrics = evaluate(model, test)
            values = metrics.first().asDict()
            if model_dir:
                save_model(model, f"{model_dir.rstrip('/')}/{name}")
        except Exception:
            if log_path:
                append_run(spark, log_path, run_id, name, {"tuned": tune}, {}, None, start_time=start, status="FAILED")
            raise
        if log_path:
            weight = {"class_weight": "balanced"} if family == "rf" else {
                "positive_weight": round(positive_weight(train).first()["pos_weight"], 3)}
            append_run(spark, log_path, run_id, name, {**params, **weight, "tuned": tune}, values, registered, start_time=start)
        out[name] = (model, metrics)
    return out


def retrain(featured: DataFrame, ratio: float = 0.70, rf_params=None, gbt_params=None, tune: bool = False, **kw):
    """Split the current table in time and refit both families, logged as in ``train_and_log``."""
    from barlab.operators.labels import time_ordered_split

    train, test = time_ordered_split(featured, ratio)
    return train_and_log(train, test, tune=tune, rf_params=rf_params, gbt_params=gbt_params, **kw)
