"""Registered queries for model jobs (G), scoring (J) and explanations (K).

Where the output is data work (assembly, latest rows, folds, gains, coefficients) an SQL twin is given;
what SQL can't fit is held by properties and by tests against plain learners.
Registered fits are the operators at their defaults, which follow the reference:
forest 100 x depth 30, boosting 200 x depth 5, a search of 15 draws x 5 folds on the
full grid, nets of up to 500 epochs.
Fitted models are kept per (session, sf_dir, family).
"""

from __future__ import annotations

import uuid

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from barlab import oracle as O
from barlab.functions.columns import round_compare
from barlab.operators import explain as K
from barlab.operators import models as G
from barlab.operators import score as J
from barlab.operators import trees as X
from barlab.operators.indicators import compute_features, run_feature_engineering
from barlab.operators.labels import time_ordered_split
from barlab.operators.quarterly import quarterly_history
from barlab.plans.pipeline import run_pipeline, run_preprocessing
from barlab.plans.registry import FIXTURE_LABELS, register
from barlab.plans.registry_stats import _FOLDS
from barlab.sources import bars as B
from barlab.params import SCORING_LOOKBACK_BARS, PipelineParams
from barlab.session import cut_lineage, ensure_checkpoint_dir
from barlab.sources import tables as T

W = O.with_
FEAT = (O.BARS, O.features_ctes())
_CACHE: dict = {}
_CUT_SQL = ("cut AS (SELECT bar_date AS cutoff FROM featured ORDER BY bar_date "
            "LIMIT 1 OFFSET (SELECT CAST(floor(count(*) * CAST(0.7 AS DOUBLE)) AS BIGINT) FROM featured))")


def _ingested(spark, sf):
    """Bars and quarterly history, made in one pass over the lines and stored."""
    key = (spark.sparkContext.applicationId, "ingested", sf)
    if key not in _CACHE:
        bars, quarters = T.bars_and_quarters(spark, sf)
        _CACHE[key] = cut_lineage(bars), cut_lineage(quarterly_history(quarters))
    return _CACHE[key]


def _pre(spark, sf):
    key = (spark.sparkContext.applicationId, "pre", sf)
    if key not in _CACHE:
        bars, history = _ingested(spark, sf)
        _CACHE[key] = run_preprocessing(B.join_index(bars, T.index_levels(spark, sf)), T.fundamentals(spark, sf), history)
    return _CACHE[key]


def _full(spark, sf):
    """Featured rows with every model input (processed -> features -> labels),
    materialised once: every fit and check reads the stored rows."""
    key = (spark.sparkContext.applicationId, "full", sf)
    if key not in _CACHE:
        _CACHE[key] = cut_lineage(run_feature_engineering(_pre(spark, sf).table, labels=FIXTURE_LABELS))
    return _CACHE[key]


def _split(spark, sf):
    return time_ordered_split(_full(spark, sf), 0.70)


def _model(spark, sf, family):
    key = (spark.sparkContext.applicationId, family, sf)
    if key not in _CACHE:
        train, _ = _split(spark, sf)
        _CACHE[key] = G.fit(train, family)
    return _CACHE[key]


# ---------------------------------------------------------------- G
@register("g01_feature_assembly", W(*FEAT) + "SELECT ticker, bar_date, CAST(44 AS INTEGER) AS n_inputs FROM featured")
def _g01(spark, sf):
    a = G.assemble(_full(spark, sf))
    return a.select("ticker", "bar_date", F.size(vector_to_array("features")).alias("n_inputs"))


@register("g04_random_forest", None)
def _g04(spark, sf):
    _, test = _split(spark, sf)
    return G.predict(_model(spark, sf, "rf"), test)


@register("g05_boosted_trees", None)
def _g05(spark, sf):
    _, test = _split(spark, sf)
    return G.predict(_model(spark, sf, "gbt"), test)


def _search_sql(family: str) -> str:
    """Draws by folds, with what a fold's test rows are; the share of right verdicts must follow from the counts."""
    draws = ", ".join(f"({i}, $${d}$$)" for i, d in enumerate(G.search_draws(family)))
    return W(*FEAT, _CUT_SQL, *_FOLDS, "pf AS (SELECT CAST(fd.fold AS INTEGER) AS fold, count(*) AS test_rows, CAST(sum(tr.label) AS BIGINT) AS positives "
             "FROM fd JOIN tr ON fd.ticker = tr.ticker AND fd.bar_date = tr.bar_date WHERE fd.fold IS NOT NULL GROUP BY fd.fold)") + (
        f"SELECT CAST(draw AS INTEGER) AS draw, params, fold, test_rows, positives, true AS f1_follows FROM (VALUES {draws}) d(draw, params), pf")


def _search_query(name: str, family: str):
    def fn(spark, sf):
        key = (spark.sparkContext.applicationId, "search", family, sf)
        if key not in _CACHE:
            _CACHE[key] = G.random_search(_split(spark, sf)[0], family)[2]
        hits, misses = F.col("tp"), F.col("fp") + F.col("fn")
        follows = F.abs(F.col("f1") * (2 * hits + misses) - 2 * hits) < 1e-6
        whole = hits + misses + F.col("tn") == F.col("test_rows")
        return _CACHE[key].select("draw", "params", "fold", "test_rows", (hits + F.col("fn")).alias("positives"), (follows & whole).alias("f1_follows"))
    register(name, _search_sql(family))(fn)


_search_query("g06_random_search", "rf")
_search_query("g06_random_search_boosted", "gbt")


@register("g07_fixed_training", None)
def _g07(spark, sf):
    _, test = _split(spark, sf)
    return G.evaluate(_model(spark, sf, "rf"), test).select(F.lit("random_forest").alias("model"), "*")


@register("g11_logistic_regression", None)
def _g11(spark, sf):
    train, test = _split(spark, sf)
    m, te = G.logistic_regression(train, test)
    return G.evaluate(m, te)


@register("g12_neural_net", None)
def _g12(spark, sf):
    train, test = _split(spark, sf)
    m, te = G.neural_net(train, test)
    return G.evaluate(m, te)


@register("g14_compare_models", None)
def _g14(spark, sf):
    train, test = _split(spark, sf)
    return G.compare_models(train, test)


@register("g15_feature_importance", None)
def _g15(spark, sf):
    return G.feature_importance(_model(spark, sf, "rf"), G.present(_full(spark, sf)))


@register("g16_standalone_importance", None)
def _g16(spark, sf):
    return G.standalone_importance(_full(spark, sf))


@register("g17_model_persist", None)
def _g17(spark, sf):
    from barlab.session import ensure_checkpoint_dir
    import uuid
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/models-{uuid.uuid4().hex}"
    paths = {"rf": f"{root}/rf", "gbt": f"{root}/gbt", "missing": f"{root}/none"}
    G.save_model(_model(spark, sf, "rf"), paths["rf"])
    G.save_model(_model(spark, sf, "gbt"), paths["gbt"])
    loaded = G.load_models(paths)
    rows = [(name, int(m.getNumTrees)) for name, m in sorted(loaded.items())]
    return spark.createDataFrame(rows, "model string, trees int")


@register("g18_retrain", None)
def _g18(spark, sf):
    res = G.retrain(_full(spark, sf))
    return res["random_forest"][1].select(F.lit("random_forest").alias("model"), "*").unionByName(
        res["boosted_trees"][1].select(F.lit("boosted_trees").alias("model"), "*"))


# ---------------------------------------------------------------- J
@register("j01_latest_rows", W(*FEAT) + "SELECT ticker, bar_date, " + O.r6("close", "RSI_14") +
          " FROM featured QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY bar_date DESC) = 1")
def _j01(spark, sf):
    f = run_feature_engineering(T.bars(spark, sf), labels=FIXTURE_LABELS)
    return J.latest_rows(f.select("ticker", "bar_date", "close", "RSI_14"))


def _latest_full(spark, sf):
    return J.latest_rows(_full(spark, sf))


@register("j02_batch_recommend", None)
def _j02(spark, sf):
    return J.recommend_all({"Random Forest": _model(spark, sf, "rf"), "Boosted Trees": _model(spark, sf, "gbt")},
                           _latest_full(spark, sf))


@register("j03_recommendations_wide", None)
def _j03(spark, sf):
    names = ["Random Forest", "Boosted Trees"]
    recs = J.recommend_all({"Random Forest": _model(spark, sf, "rf"), "Boosted Trees": _model(spark, sf, "gbt")},
                           _latest_full(spark, sf))
    return J.recommendations_wide(recs, names)


@register("j04_history_check", W(O.BARS) +
          "SELECT ticker, count(*) AS history_days, CASE WHEN count(*) < 60 THEN printf('history of %d bars is below the "
          "minimum of %d', count(*), 60) END AS reason FROM bars GROUP BY ticker")
def _j04(spark, sf):
    return J.history_check(T.bars(spark, sf))


@register("j05_warmup_check", W(*FEAT) + "SELECT ticker, bar_date, CASE WHEN MA21 IS NULL OR RSI_14 IS NULL OR MACD_signal IS NULL "
          "OR BB_width IS NULL THEN 'an indicator has no value yet on the latest bar' END AS reason "
          "FROM feat QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY bar_date DESC) = 1")
def _j05(spark, sf):
    f = compute_features(T.bars(spark, sf))
    return J.warmup_check(J.latest_rows(f)).select("ticker", "bar_date", "reason")


@register("j06_score_tickers", None)
def _j06(spark, sf):
    pre = _pre(spark, sf)
    models = {"Random Forest": _model(spark, sf, "rf"), "Boosted Trees": _model(spark, sf, "gbt")}
    bars, history = _ingested(spark, sf)
    return J.score_tickers(bars, T.fundamentals(spark, sf), history, pre.ratio_params, models)


class _BrokenModel:
    """A model whose transform fails (wrong input), to show per-model isolation."""

    def transform(self, df):
        return df.select(F.col("no_such_column"))


@register("j07_failure_isolation", None)
def _j07(spark, sf):
    return J.recommend_all({"Random Forest": _model(spark, sf, "rf"), "Broken": _BrokenModel()}, _latest_full(spark, sf))


# ---------------------------------------------------------------- K
def _explained(spark, sf, family="rf"):
    key = (spark.sparkContext.applicationId, "shap", family, sf)
    if key not in _CACHE:
        latest = _latest_full(spark, sf)
        cols = G.present(latest)
        _CACHE[key] = (K.explain_rows(latest, _model(spark, sf, family), cols), latest, cols)
    return _CACHE[key]


@register("k01_tree_shap", None)
def _k01(spark, sf):
    ex, latest, cols = _explained(spark, sf)
    return ex.select("ticker", "bar_date", "base_value", F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x).alias("contribution_sum"))


@register("k01_tree_shap_boosted", None)
def _k01b(spark, sf):
    ex, latest, cols = _explained(spark, sf, "gbt")
    return ex.select("ticker", "bar_date", "base_value", F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x).alias("contribution_sum"))


@register("k06_explanation_table", None)
def _k06(spark, sf):
    ex, latest, cols = _explained(spark, sf)
    return K.explanation_table(ex, cols, top_n=5)


@register("k07_narrative", None)
def _k07(spark, sf):
    ex, latest, cols = _explained(spark, sf)
    table = K.explanation_table(ex, cols, top_n=5)
    signals = J.recommend(_model(spark, sf, "rf"), latest, "rf").join(latest.select("ticker", "bar_date"), "ticker")
    return K.narrative(table, signals)


# ---------------------------------------------------------------- K2-K5 as their own rows
_TEXT_FEATURES = ("RSI_14", "RSI_14_lag1", "RSI_14_lag2", "MACD_hist", "MA_crossover", "Stoch_K", "Stoch_D",
                  "ADX_14", "daily_return_lag1", "candle_doji", "candle_hammer", "candle_net_signal",
                  "candle_bullish_signal_count")


def _text_sql() -> str:
    names = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in K.DISPLAY_NAMES.items())
    h = K.HINT_TEXT
    flags = ", ".join(f"'{c}'" for c in K.CANDLE_FLAG_NAMES)
    hint = (f"CASE WHEN b = 'RSI_14' THEN CASE WHEN value > 70 THEN '{h['rsi_high']}' WHEN value < 30 THEN '{h['rsi_low']}' END "
            f"WHEN b = 'Stoch_K' THEN CASE WHEN value > 80 THEN '{h['stoch_high']}' WHEN value < 20 THEN '{h['stoch_low']}' END "
            f"WHEN b = 'ADX_14' THEN CASE WHEN value > 25 THEN '{h['adx_strong']}' ELSE '{h['adx_weak']}' END "
            f"WHEN b = 'MACD_hist' THEN CASE WHEN value > 0 THEN '{h['macd_up']}' ELSE '{h['macd_down']}' END "
            f"WHEN b = 'MA_crossover' THEN CASE WHEN value >= 1 THEN '{h['ma_up']}' ELSE '{h['ma_down']}' END "
            f"WHEN b IN ({flags}) THEN CASE WHEN value >= 1 THEN '{h['flag']}' END "
            f"WHEN b = 'candle_net_signal' THEN CASE WHEN value > 0 THEN '{h['net_up']}' WHEN value < 0 THEN '{h['net_down']}' END END")
    cols = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _TEXT_FEATURES)
    return (W(*FEAT, f"lt AS (SELECT ticker, {cols} FROM featured QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY bar_date DESC) = 1)",
              f"lg AS (UNPIVOT lt ON {', '.join(_TEXT_FEATURES)} INTO NAME feature VALUE value)",
              "lb AS (SELECT *, regexp_replace(feature, '_lag[123]$', '') AS b, regexp_extract(feature, '_lag([123])$', 1) AS lag FROM lg)",
              f"ln AS (SELECT *, coalesce(CASE b {names} END, replace(feature, '_', ' ')) AS nm FROM lb)")
            + f"SELECT ticker, feature, {O.rnd('value')} AS value, CASE WHEN lag <> '' THEN nm || ' (' || lag || 'd ago)' ELSE nm END AS display_name, "
            f"{hint} AS hint FROM ln")


@register("k04_k05_display_and_hint", _text_sql())
def _k0405(spark, sf):
    f = run_feature_engineering(T.bars(spark, sf), labels=FIXTURE_LABELS)
    latest = J.latest_rows(f.select("ticker", "bar_date", *_TEXT_FEATURES))
    long = latest.select("ticker", *[F.col(c).cast("double").alias(c) for c in _TEXT_FEATURES]).unpivot(
        ["ticker"], list(_TEXT_FEATURES), "feature", "value")
    fcol, v = F.col("feature"), F.col("value")
    return long.select("ticker", "feature", "value", K.display_name(fcol).alias("display_name"), K.hint(fcol, v).alias("hint"))


@register("k02_top_factors", None)
def _k02(spark, sf):
    ex, latest, cols = _explained(spark, sf)
    return K.explanation_table(ex, cols, top_n=5).select("ticker", "bar_date", "rank", "feature", "shap_value")


@register("k03_direction", None)
def _k03(spark, sf):
    ex, latest, cols = _explained(spark, sf)
    return K.explanation_table(ex, cols, top_n=5).select("ticker", "bar_date", "feature", "pushes_toward")


@register("g13_second_boosted_family", None)
def _g13(spark, sf):
    _, test = _split(spark, sf)
    return G.predict(_model(spark, sf, "leafwise"), test)


# ---------------------------------------------------------------- the same operators on rules that SQL can follow
class _RuleModel:
    """P(BUY) from one column: ``high`` above the cut, ``low`` otherwise."""

    def __init__(self, col: str, cut: float, high: float, low: float):
        self.col, self.cut, self.high, self.low = col, cut, high, low

    def transform(self, df):
        p = F.when(F.col(self.col) > self.cut, F.lit(self.high)).otherwise(F.lit(self.low))
        return df.withColumn("probability", array_to_vector(F.array(1 - p, p))).withColumn("prediction", (p >= 0.5).cast("double"))

    def sql(self) -> str:
        return f"CASE WHEN {self.col} > {self.cut} THEN CAST({self.high} AS DOUBLE) ELSE CAST({self.low} AS DOUBLE) END"


_RULES = {"Momentum": _RuleModel("RSI_14", 50.0, 0.75, 0.375), "Trend": _RuleModel("MACD_hist", 0.0, 0.875, 0.25)}
_LATEST_SQL = "lt AS (SELECT * FROM {src} QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY bar_date DESC) = 1)"


def _signals_sql(cols: str = "ticker") -> str:
    return " UNION ALL ".join(
        f"SELECT {cols}, '{n}' AS model, CASE WHEN {m.sql()} >= 0.5 THEN 'BUY' ELSE 'SELL' END AS signal, "
        f"greatest({m.sql()}, 1 - {m.sql()}) AS confidence FROM lt" for n, m in _RULES.items())


def _latest_featured(spark, sf):
    return J.latest_rows(run_feature_engineering(T.bars(spark, sf), labels=FIXTURE_LABELS))


@register("j02_recommend_by_rules", W(*FEAT, _LATEST_SQL.format(src="featured")) + _signals_sql())
def _j02r(spark, sf):
    return J.recommend_all(_RULES, _latest_featured(spark, sf)).drop("error")


def _latest_query(name: str, src: str, parity: bool):
    def fn(spark, sf):
        return J.recommend_latest(_RULES, T.bars(spark, sf), FIXTURE_LABELS, parity).drop("error")
    register(name, W(*FEAT, _LATEST_SQL.format(src=src)) + _signals_sql("ticker, bar_date"))(fn)


_latest_query("j02_recommend_newest_by_rules", "feat", False)
_latest_query("j02_recommend_labelled_by_rules", "featured", True)


@register("j03_recommendations_wide_by_rules", W(*FEAT, _LATEST_SQL.format(src="featured")) + "SELECT ticker, " + ", ".join(
    f"CASE WHEN {m.sql()} >= 0.5 THEN 'BUY' ELSE 'SELL' END AS \"{n} Signal\", round(greatest({m.sql()}, 1 - {m.sql()}), 3) AS \"{n} Confidence\""
    for n, m in _RULES.items()) + " FROM lt")
def _j03r(spark, sf):
    return J.recommendations_wide(J.recommend_all(_RULES, _latest_featured(spark, sf)), list(_RULES))


@register("j06_score_tickers_by_rules", W(
    O.BARS, f"recent AS (SELECT * FROM bars QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY bar_date DESC) <= {SCORING_LOOKBACK_BARS})",
    O.features_ctes("recent"), "nb AS (SELECT ticker, count(*) AS history_days FROM recent GROUP BY ticker)", _LATEST_SQL.format(src="feat"),
    "bad AS (SELECT ticker, bar_date, history_days, CASE WHEN history_days < 60 THEN printf('history of %d bars is below the minimum of %d', history_days, 60) "
    "WHEN MA21 IS NULL OR RSI_14 IS NULL OR MACD_signal IS NULL OR BB_width IS NULL THEN 'an indicator has no value yet on the latest bar' END AS reason "
    "FROM lt JOIN nb USING (ticker))", f"sg AS ({_signals_sql()})")
    + "SELECT b.ticker, history_days, bar_date AS as_of_date, model, signal, confidence, reason, CAST(NULL AS VARCHAR) AS error, "
      "CAST(NULL AS VARCHAR) AS narrative FROM bad b LEFT JOIN sg ON b.ticker = sg.ticker AND reason IS NULL")
def _j06r(spark, sf):
    params = _pre(spark, sf).ratio_params
    bars, history = _ingested(spark, sf)
    return J.score_tickers(bars, T.fundamentals(spark, sf), history, params, _RULES)


@register("j07_failure_isolation_by_rules", W(*FEAT, _LATEST_SQL.format(src="featured"), f"sg AS ({_signals_sql()})")
          + "SELECT ticker, model, signal, confidence, false AS has_error FROM sg WHERE model = 'Momentum' "
            "UNION ALL SELECT ticker, 'Broken', 'ERROR', 0.0, true FROM lt")
def _j07r(spark, sf):
    r = J.recommend_all({"Momentum": _RULES["Momentum"], "Broken": _BrokenModel()}, _latest_featured(spark, sf))
    return r.select("ticker", "model", "signal", "confidence", F.col("error").isNotNull().alias("has_error"))


# contributions as a fixed multiple of each input, so that SQL can rank and word them
def _coefficient(i: int) -> float:
    return (-1.0) ** i / (8 * (i + 1))


def _explained_by_rule(spark, sf):
    lt = _latest_featured(spark, sf)
    x = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in _TEXT_FEATURES]
    return lt.select("ticker", "bar_date", F.array(*x).alias("inputs"),
                     F.array(*[v * F.lit(_coefficient(i)) for i, v in enumerate(x)]).alias("contributions")), lt


def _factors_ctes() -> tuple:
    """Ranked factors of the latest row of each ticker."""
    items = ", ".join(f"{{'pos': {i}, 'feature': '{c}', 'value': coalesce(CAST({c} AS DOUBLE), 0), 'shap': coalesce(CAST({c} AS DOUBLE), 0) * "
                      f"CAST({_coefficient(i)!r} AS DOUBLE)}}" for i, c in enumerate(_TEXT_FEATURES))
    names = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in K.DISPLAY_NAMES.items())
    text = _text_sql()
    hint = text[text.index("CASE WHEN b = 'RSI_14'"): text.index(" AS hint FROM ln")]
    osc = "(contains(feature, 'RSI') OR contains(feature, 'Stoch') OR contains(feature, 'ADX'))"
    return (*FEAT, _LATEST_SQL.format(src="featured"),
            f"lg AS (SELECT ticker, bar_date, unnest([{items}], recursive := true) FROM lt)",
            "rk AS (SELECT *, row_number() OVER (PARTITION BY ticker, bar_date ORDER BY abs(shap) DESC, pos) AS rank FROM lg QUALIFY rank <= 5)",
            "lb AS (SELECT *, regexp_replace(feature, '_lag[123]$', '') AS b, regexp_extract(feature, '_lag([123])$', 1) AS lag FROM rk)",
            f"ln AS (SELECT *, coalesce(CASE b {names} END, replace(feature, '_', ' ')) AS nm FROM lb)",
            "fx AS (SELECT ticker, bar_date, CAST(rank AS INTEGER) AS rank, feature, value, shap AS shap_value, "
            "CASE WHEN lag <> '' THEN nm || ' (' || lag || 'd ago)' ELSE nm END AS display_name, "
            f"CASE WHEN {osc} THEN printf('%.1f', value) WHEN abs(value) < 10 THEN printf('%.3f', value) ELSE printf('%.2f', value) END AS value_display, "
            f"CASE WHEN shap > 0 THEN 'BUY' ELSE 'SELL' END AS pushes_toward, {hint} AS hint FROM ln)")


def _factor_query(name: str, cols: list[str]):
    doubles = ("value", "shap_value")
    sel = ", ".join(f"{O.rnd(c)} AS {c}" if c in doubles else c for c in cols)

    def fn(spark, sf):
        return K.explanation_table(_explained_by_rule(spark, sf)[0], list(_TEXT_FEATURES), top_n=5).select(*cols)
    register(name, W(*_factors_ctes()) + f"SELECT {sel} FROM fx")(fn)


_factor_query("k02_top_factors_by_rule", ["ticker", "bar_date", "rank", "feature", "shap_value"])
_factor_query("k03_direction_by_rule", ["ticker", "bar_date", "feature", "pushes_toward"])
_factor_query("k06_explanation_table_by_rule", ["ticker", "bar_date", "rank", "feature", "display_name", "value", "value_display", "shap_value",
                                                "pushes_toward", "hint"])


def _narrative_sql() -> str:
    n = K.NARRATIVE_TEXT
    before, after = n["head"].split("{}")
    nl = "chr(10)"
    contrary = n["contrary"].strip(chr(10))
    return W(*_factors_ctes(), f"sg AS ({_signals_sql()})",
             "tx AS (SELECT f.ticker, f.bar_date, f.rank, s.signal, pushes_toward = s.signal AS sup, "
             f"'**' || display_name || '** = ' || value_display || coalesce(' (' || hint || ')', '') || '{n['push']}' AS line "
             "FROM fx f JOIN sg s ON f.ticker = s.ticker AND s.model = 'Momentum')",
             "nr AS (SELECT *, row_number() OVER (PARTITION BY ticker, bar_date, sup ORDER BY rank) AS k FROM tx)",
             "ag AS (SELECT ticker, bar_date, signal, "
             f"string_agg('{n['for']}' || line || signal, {nl} ORDER BY rank) FILTER (WHERE sup AND k <= 3) AS a, "
             f"string_agg('{n['against']}' || line || CASE WHEN signal = 'BUY' THEN 'SELL' ELSE 'BUY' END, {nl} ORDER BY rank) FILTER (WHERE NOT sup AND k <= 2) AS c "
             "FROM nr GROUP BY ALL)") + (
        f"SELECT ticker, bar_date, signal, '{before}' || signal || '{after}' || coalesce({nl} || a, '') || "
        f"coalesce({nl} || {nl} || '{contrary}' || {nl} || c, '') AS narrative FROM ag")


@register("k07_narrative_by_rule", _narrative_sql())
def _k07r(spark, sf):
    ex, lt = _explained_by_rule(spark, sf)
    signals = J.recommend(_RULES["Momentum"], lt, "Momentum").join(lt.select("ticker", "bar_date"), "ticker")
    return K.narrative(K.explanation_table(ex, list(_TEXT_FEATURES), top_n=5), signals)


# ---------------------------------------------------------------- what must hold of any fit
_TEST_SQL = W(*FEAT, _CUT_SQL) + "SELECT ticker, bar_date, label, true AS valid FROM featured, cut WHERE bar_date >= cutoff"


def _valid_query(name: str, family: str):
    def fn(spark, sf):
        _, test = _split(spark, sf)
        p = G.predict(_model(spark, sf, family), test)
        return p.select("ticker", "bar_date", "label", (F.col("p").between(0, 1) & ((F.col("p") == 0.5) | (
            (F.col("p") > 0.5) == (F.col("prediction") == 1)))).alias("valid"))
    register(name, _TEST_SQL)(fn)


_valid_query("g04_random_forest_properties", "rf")
_valid_query("g05_boosted_trees_properties", "gbt")
_valid_query("g13_leafwise_trees_properties", "leafwise")


_FLAGS = ("candle_doji", "candle_bullish_engulfing", "candle_bearish_engulfing", "candle_net_signal", "MA_crossover")


def _gain_sql() -> str:
    """Gains of all first splits on the flag columns: gradient and curvature of the log loss at even odds, one unit of l2."""
    long = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v, g, h FROM gh" for c in _FLAGS)
    rounded = "round(({}) * 1048576) / 1048576"
    sc = "({g}) * ({g}) / (({h}) + 1)".format
    return W(*FEAT, _CUT_SQL, "tr AS (SELECT * FROM featured, cut WHERE bar_date < cutoff)",
             "pw AS (SELECT count(*) FILTER (label = 0) / CAST(greatest(count(*) FILTER (label = 1), 1) AS DOUBLE) AS p FROM tr)",
             f"gh AS (SELECT tr.*, {rounded.format('CASE WHEN label = 1 THEN p * 0.5 ELSE -0.5 END')} AS g, "
             f"{rounded.format('CASE WHEN label = 1 THEN p * 0.25 ELSE 0.25 END')} AS h FROM tr, pw)",
             f"lg AS ({long})", "ct AS (SELECT feature, v, sum(g) AS g, sum(h) AS h FROM lg GROUP BY feature, v)",
             "rn AS (SELECT feature, v, sum(g) OVER (PARTITION BY feature ORDER BY v) AS gl, sum(h) OVER (PARTITION BY feature ORDER BY v) AS hl, "
             "sum(g) OVER (PARTITION BY feature) AS g, sum(h) OVER (PARTITION BY feature) AS h FROM ct)",
             f"gn AS (SELECT feature, v AS cut_value, {sc(g='gl', h='hl')} + {sc(g='g - gl', h='h - hl')} - {sc(g='g', h='h')} AS gain, hl, h - hl AS hr FROM rn)"
             ) + f"SELECT feature, cut_value, {O.rnd('gain')} AS gain FROM gn WHERE gain > 1e-7 AND hl >= 1 AND hr >= 1"


@register("g05_first_split_gains", _gain_sql())
def _g05gains(spark, sf):
    train, _ = time_ordered_split(run_feature_engineering(T.bars(spark, sf), labels=FIXTURE_LABELS), 0.70)
    train = cut_lineage(X.with_rows(train).select("row", "label", *[F.col(c).cast("double").alias(c) for c in _FLAGS]))
    values = train.select(*[F.array_sort(F.collect_set(c)).alias(c) for c in _FLAGS]).first()  # few values a flag
    table = X.binned(train, list(_FLAGS), [list(values[c]) for c in _FLAGS], ["label"])
    n = table.agg(F.count_if(F.col("label") == 0).alias("n0"), F.count_if(F.col("label") == 1).alias("n1")).first()
    w = F.when(F.col("label") == 1, n["n0"] / max(n["n1"], 1)).otherwise(1.0)
    rows = table.select(F.lit(0).alias("tree"), F.lit(1).cast("long").alias("path"), "bins", (F.rint(w * (F.col("label") - 0.5) * X.GRAIN) / X.GRAIN).alias("g"),
                        (F.rint(w * 0.25 * X.GRAIN) / X.GRAIN).alias("h"))
    total = rows.groupBy("tree", "path").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.count(F.lit(1)).alias("n"))
    gains = X.split_gains(rows, total, X.boosted(), len(_FLAGS))
    at = F.array(*[F.array(*[F.lit(float(v)) for v in values[c]]) for c in _FLAGS])
    return gains.select(F.element_at(F.array(*map(F.lit, _FLAGS)), F.col("feature") + 1).alias("feature"),
                        F.get(F.get(at, F.col("feature")), F.col("bin").cast("int")).alias("cut_value"), round_compare(F.col("gain")).alias("gain"))


def _newton_sql() -> str:
    """Newton steps for an intercept and one standardised input, both classes weighing alike, one unit of l2 on the slope."""
    det = "(haa * hbb - hab * hab)"
    return W(*FEAT, _CUT_SQL, "tr AS (SELECT RSI_14 AS v, CAST(label AS DOUBLE) AS y FROM featured, cut WHERE bar_date < cutoff)",
             "st AS (SELECT avg(v) AS m, stddev_pop(v) AS s, count(*) AS n, sum(y) AS n1 FROM tr)",
             "z AS (SELECT (v - m) / s AS x, y, CASE WHEN y = 1 THEN n / (2 * n1) ELSE n / (2 * (n - n1)) END AS w FROM tr, st)",
             "it AS (SELECT 0 AS i, CAST(0 AS DOUBLE) AS a, CAST(0 AS DOUBLE) AS b UNION ALL "
             f"SELECT i + 1, a + (hbb * ga - hab * gb) / {det}, b + (haa * gb - hab * ga) / {det} FROM (SELECT i, a, b, sum(w * (y - p)) AS ga, "
             "sum(w * (y - p) * x) - b AS gb, sum(w * p * (1 - p)) AS haa, sum(w * p * (1 - p) * x) AS hab, sum(w * p * (1 - p) * x * x) + 1 AS hbb "
             "FROM (SELECT i, a, b, x, y, w, 1 / (1 + exp(-(a + b * x))) AS p FROM it, z WHERE i < 12) GROUP BY i, a, b))").replace("WITH ", "WITH RECURSIVE ", 1) + (
        f"SELECT 'intercept' AS term, {O.rnd('a')} AS value FROM it WHERE i = 12 UNION ALL SELECT 'RSI_14', {O.rnd('b')} FROM it WHERE i = 12")


@register("g11_logistic_coefficients", _newton_sql())
def _g11c(spark, sf):
    train, test = time_ordered_split(cut_lineage(run_feature_engineering(T.bars(spark, sf), labels=FIXTURE_LABELS)), 0.70)
    m, _ = G.logistic_regression(train, test, ["RSI_14"])
    rows = spark.createDataFrame([("intercept", float(m.intercept)), ("RSI_14", float(m.coefficients[0]))], "term string, value double")
    return rows.select("term", round_compare(F.col("value")).alias("value"))


@register("g15_importance_properties", "SELECT true AS sums_to_one, true AS none_negative")
def _g15p(spark, sf):
    imp = G.feature_importance(_model(spark, sf, "rf"), G.present(_full(spark, sf)), top_n=None)
    return imp.agg((F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one"), (F.min("importance") >= 0).alias("none_negative"))


@register("g17_saved_model_predicts_the_same", W(*FEAT, _CUT_SQL) + "SELECT ticker, bar_date, true AS same FROM featured, cut WHERE bar_date >= cutoff")
def _g17p(spark, sf):
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    _, test = _split(spark, sf)
    G.save_model(_model(spark, sf, "rf"), path)
    was, now = G.predict(_model(spark, sf, "rf"), test), G.predict(G.load_models({"rf": path})["rf"], test)
    return was.join(now.select("ticker", "bar_date", F.col("p").alias("p2")), ["ticker", "bar_date"]).select(
        "ticker", "bar_date", (F.col("p") == F.col("p2")).alias("same"))


@register("k01_contributions_add_up", W(*FEAT, _LATEST_SQL.format(src="featured")) + "SELECT ticker, bar_date, true AS adds_up FROM lt")
def _k01p(spark, sf):
    ex, latest, cols = _explained(spark, sf)
    out = G.predict(_model(spark, sf, "rf"), latest).select("ticker", "bar_date", "p")
    total = F.col("base_value") + F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x)
    return ex.join(out, ["ticker", "bar_date"]).select("ticker", "bar_date", (F.abs(total - F.col("p")) < 1e-6).alias("adds_up"))


def _daily_run(spark, sf, tune: bool):
    """The log that a daily run wrote."""
    bars, history = _ingested(spark, sf)
    prices = B.join_index(bars, T.index_levels(spark, sf))
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/daily-{uuid.uuid4().hex}"
    paths = run_pipeline(prices, T.fundamentals(spark, sf), history, out,
                         PipelineParams(labels=FIXTURE_LABELS), tune=tune)
    runs = spark.read.parquet(paths["runs"])
    ended = F.when(F.col("end_time") >= F.col("start_time"), F.col("status"))
    return runs.select("run_name", ended.alias("status"), "model_name", F.col("params")["tuned"].alias("tuned"),
                       F.size("metrics").alias("metrics")).withColumn("tuned", F.lower("tuned"))


def _runs_sql(tuned: bool) -> str:
    """The two runs that a daily run logs, if there are rows to train on."""
    rows = ", ".join(f"('{name}', 'FINISHED', '{model}', '{str(tuned).lower()}', 4)" for name, model in sorted(G.RUN_NAMES.values()))
    return W(*FEAT, _CUT_SQL) + (f"SELECT v.* FROM (VALUES {rows}) v(run_name, status, model_name, tuned, metrics) "
                                 "WHERE EXISTS (SELECT 1 FROM featured, cut WHERE bar_date < cutoff)")


@register("e1_daily_run", _runs_sql(False))
def _e1(spark, sf):
    return _daily_run(spark, sf, tune=False)


@register("e1_daily_run_tuned", _runs_sql(True))
def _e1t(spark, sf):
    return _daily_run(spark, sf, tune=True)
