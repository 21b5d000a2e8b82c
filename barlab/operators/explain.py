"""Per-row explanations of tree-model predictions (K1-K7).

K1 is path-dependent TreeSHAP (Lundberg, Erion, Lee, "Consistent
individualized feature attribution for tree ensembles", 2018), computed for a
whole batch of rows from path tables of the nodes,
over the trees of a Spark model. The node tables are read from the model's
saved form (size bound: the model, not the data), broadcast, and each
partition of rows is explained in ``mapInPandas``. Forests are explained in
probability space (leaf value = class-1 share of the leaf's weighted
counts, trees averaged); boosted trees in log-odds space (2 x the weighted
sum of leaf values, Spark's logistic link). Base value + contributions =
model output.

K2-K7 (ranking, direction, names, hints, formatting, narrative) are column
expressions over the long (row, feature) table.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlab.session import ensure_checkpoint_dir


# ------------------------------------------------------------------ tree tables
@dataclass
class TreeArrays:
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    cover: np.ndarray


@dataclass
class Ensemble:
    kind: str               # "forest" or "boosted"
    trees: list
    weights: np.ndarray
    n_features: int


def _tree_from_nodes(nodes: pd.DataFrame, kind: str) -> TreeArrays:
    nodes = nodes.sort_values("id")
    n = int(nodes["id"].max()) + 1
    left = np.full(n, -1, dtype=np.int64)
    right = np.full(n, -1, dtype=np.int64)
    feature = np.full(n, -1, dtype=np.int64)
    threshold = np.zeros(n)
    value = np.zeros(n)
    cover = np.zeros(n)
    for r in nodes.itertuples(index=False):
        i = int(r.id)
        stats = np.asarray(r.impurityStats, dtype=float)
        left[i], right[i] = int(r.leftChild), int(r.rightChild)
        if left[i] >= 0:
            feature[i] = int(r.split["featureIndex"])
            threshold[i] = float(r.split["leftCategoriesOrThreshold"][0])
        if kind == "forest":
            cover[i] = stats.sum()
            value[i] = stats[1] / stats.sum() if stats.sum() > 0 and len(stats) > 1 else 0.0
        else:
            cover[i] = stats[0]
            value[i] = float(r.prediction)
    return TreeArrays(left, right, feature, threshold, value, cover)


def ensemble_of(model, spark: SparkSession | None = None) -> Ensemble:
    """Arrays of a ``trees.TreeModel``, or of a Spark RandomForestClassificationModel or GBTClassificationModel."""
    from pyspark.ml.classification import GBTClassificationModel

    from barlab.operators.trees import TreeModel

    if isinstance(model, TreeModel):
        found = []
        for _, t in model.nodes.groupby("tree"):
            left = t["left"].to_numpy()
            found.append(TreeArrays(left, np.where(left >= 0, left + 1, -1), *(t[c].to_numpy() for c in ("feature", "threshold", "value", "cover"))))
        forest = model.kind == "forest"
        return Ensemble("forest" if forest else "boosted", found, np.full(len(found), 1.0 / max(1, len(found)) if forest else 1.0), model.n_features)
    spark = spark or SparkSession.getActiveSession()
    root = ensure_checkpoint_dir(spark)
    path = f"{root.rstrip('/')}/explain-model-{uuid.uuid4().hex}"
    model.write().overwrite().save(path)
    data = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").toPandas()  # model-sized
    kind = "boosted" if isinstance(model, GBTClassificationModel) else "forest"
    trees = [_tree_from_nodes(g, kind) for _, g in sorted(data.groupby("treeID"), key=lambda t: t[0])]
    if kind == "boosted":
        weights = np.asarray(model.treeWeights, dtype=float) * 2.0
    else:
        weights = np.full(len(trees), 1.0 / len(trees))
    return Ensemble(kind, trees, weights, model.numFeatures)


# ------------------------------------------------------------------ TreeSHAP
@dataclass
class TreePaths:
    """Nodes of one tree, level by level, children side by side; for each what its path says of its parent's split feature.

    A row stays on the path if ``lo < x <= hi``; ``share`` is the product of the cover
    ratios of the path's splits on the feature, and ``above`` the last node before this
    one whose parent splits on it too (the root, if none). The root asks nothing.
    """

    feature: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    share: np.ndarray
    above: np.ndarray
    parent: np.ndarray
    value: np.ndarray       # of a leaf, else 0
    levels: list            # (start, end) of each level
    width: int              # most distinct features on a path


def tree_paths(t: TreeArrays) -> TreePaths:
    some = np.unique(t.feature[t.left >= 0])
    at = np.array([0])                                # node numbers of a level
    last = np.zeros((1, len(some)), np.int64)         # by feature, the last place on the path that was split on it
    count = np.zeros(1, np.int64)
    feature, lo, hi, share, above, parent = (np.array([x]) for x in (0, -np.inf, np.inf, 1.0, 0, 0))
    order, levels, width = [at], [(0, 1)], 1
    while True:
        split = np.flatnonzero(t.left[at] >= 0)
        if not len(split):
            break
        up, place = at[split], levels[-1][0] + split
        f, rows = t.feature[up], np.arange(len(split))
        was = last[split, np.searchsorted(some, f)]
        at = np.stack([t.left[up], t.right[up]], axis=1)
        cover = t.cover[up][:, None]
        ratio = np.divide(t.cover[at], cover, out=np.zeros(at.shape), where=cover > 0)
        cut = t.threshold[up]
        # the root's bounds and share are open, so they stand for "none above"
        lows = np.stack([lo[was], np.maximum(lo[was], cut)], axis=1)
        highs = np.stack([np.minimum(hi[was], cut), hi[was]], axis=1)
        count = np.repeat(count[split] + (was == 0), 2)
        width = max(width, int(count.max()))
        start, n = levels[-1][1], 2 * len(split)
        levels.append((start, start + n))
        last = np.repeat(last[split], 2, axis=0)
        last[np.arange(n), np.repeat(np.searchsorted(some, f), 2)] = start + np.arange(n)
        feature, lo, hi = (np.concatenate(x) for x in ((feature, np.repeat(f, 2)), (lo, lows.ravel()), (hi, highs.ravel())))
        share = np.concatenate([share, (share[was][:, None] * ratio).ravel()])
        above, parent = np.concatenate([above, np.repeat(was, 2)]), np.concatenate([parent, np.repeat(place, 2)])
        at = at.ravel()
        order.append(at)
    order = np.concatenate(order)
    return TreePaths(feature, lo, hi, share, above, parent, np.where(t.left[order] < 0, t.value[order], 0.0), levels, width)


def _expected(t: TreeArrays) -> float:
    leaves = t.left < 0
    return float((t.value[leaves] * t.cover[leaves]).sum() / t.cover[0]) if t.cover[0] > 0 else 0.0


def shap_batch(ens: Ensemble, xs: np.ndarray, max_cells: int = 200_000) -> tuple[np.ndarray, float]:
    """Contributions (rows x features) and the base value.

    A leaf pays its value if all its features hold; a feature outside the
    coalition holds with its share. The Shapley sum of such a product game is the
    integral over t in [0, 1] of the other features' ``share (1 - t) + holds t``,
    a polynomial of degree below the path length, so Gauss-Legendre nodes give it
    exactly. Leaves share what their paths share: the products go down a tree, the
    sums over the leaves below a node come up, and a node gives its feature the
    leaves below it, less those whose path splits on the feature again.
    """
    phi = np.zeros((len(xs), ens.n_features))
    base = sum(w * _expected(t) for t, w in zip(ens.trees, ens.weights))
    for t, w in zip(ens.trees, ens.weights):
        p = tree_paths(t)
        if len(p.levels) == 1:
            continue
        at, weight = np.polynomial.legendre.leggauss(p.width // 2 + 1)
        at, weight = (at + 1) / 2, weight / 2
        by_feature = np.argsort(p.feature[1:], kind="stable") + 1
        used, runs = np.unique(p.feature[by_feature], return_index=True)
        n, again = len(p.feature), np.flatnonzero(p.above)
        step = max(1, max_cells // (n * len(at)))
        for k in range(0, len(xs), step):
            x = xs[k:k + step].T[p.feature]
            holds = ((x > p.lo[:, None]) & (x <= p.hi[:, None])).astype(float)
            holds[0] = 1.0
            rest = holds - p.share[:, None]
            term = p.share[:, None, None] * (1 - at) + holds[:, :, None] * at
            term[term == 0] = 1
            product = np.ones_like(term)
            for start, end in p.levels[1:]:
                change = term[start:end] / term[p.above[start:end]]
                gone = (p.share[start:end, None] == 0) & (holds[start:end] == 0)
                change[gone] = 0
                product[start:end] = product[p.parent[start:end]] * change
            below = product * p.value[:, None, None]
            for start, end in p.levels[:0:-1]:
                below[p.parent[start:end:2]] = below[start:end:2] + below[start + 1:end:2]
            gain = rest * ((below / term) @ weight)
            gain[again] -= rest[p.above[again]] * ((below[again] / term[p.above[again]]) @ weight)
            phi[k:k + step, used] += w * np.add.reduceat(gain[by_feature], runs, axis=0).T
    return phi, float(base)


def shap_values(ens: Ensemble, x: np.ndarray) -> tuple[np.ndarray, float]:
    """Contributions for one input row and the base value."""
    phi, base = shap_batch(ens, np.asarray(x, dtype=float)[None, :])
    return phi[0], base


def model_output(ens: Ensemble, x: np.ndarray) -> float:
    """f(x) in the space of the contributions (probability or log-odds)."""
    out = 0.0
    for t, w in zip(ens.trees, ens.weights):
        node = 0
        while t.left[node] >= 0:
            node = t.left[node] if x[t.feature[node]] <= t.threshold[node] else t.right[node]
        out += w * t.value[node]
    return out


def explain_rows(df: DataFrame, model, cols: list[str], keep=("ticker", "bar_date")) -> DataFrame:
    """K1: one row per input row with ``base_value``, ``contributions`` and ``inputs``
    (arrays aligned with ``cols``); missing inputs are 0 as in scoring.

    A row costs a walk through every tree, far more than its bytes tell, so the
    rows are spread over all cores."""
    spark = df.sparkSession
    ens = ensemble_of(model, spark)
    bc = spark.sparkContext.broadcast(ens)
    keep = [c for c in keep if c in df.columns]
    inp = df.select(*keep, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_x{i}") for i, c in enumerate(cols)])
    xcols = [f"_x{i}" for i in range(len(cols))]
    out_schema = T.StructType([inp.schema[c] for c in keep] + [
        T.StructField("base_value", T.DoubleType()), T.StructField("contributions", T.ArrayType(T.DoubleType())),
        T.StructField("inputs", T.ArrayType(T.DoubleType()))])

    def explain(batches):
        e = bc.value
        for pdf in batches:
            xs = pdf[xcols].to_numpy(dtype=float)
            phi, base = shap_batch(e, xs)
            yield pdf[keep].assign(base_value=base, contributions=phi.tolist(), inputs=xs.tolist())

    return inp.repartition(spark.sparkContext.defaultParallelism).mapInPandas(explain, out_schema)


# ------------------------------------------------------------------ K2-K7
# Display names and hint rules of the explanation text (fixed values).
DISPLAY_NAMES = {
    "RSI_14": "RSI (14-day)",
    "MACD_hist": "MACD histogram",
    "MA_crossover": "MA7 vs MA21 crossover",
    "Stoch_K": "Stochastic %K",
    "ADX_14": "ADX (trend strength)",
    "candle_doji": "Doji pattern",
    "candle_hammer": "Hammer pattern",
    "candle_inverted_hammer": "Inverted Hammer pattern",
    "candle_shooting_star": "Shooting Star pattern",
    "candle_bullish_marubozu": "Bullish Marubozu",
    "candle_bearish_marubozu": "Bearish Marubozu",
    "candle_bullish_engulfing": "Bullish Engulfing pattern",
    "candle_bearish_engulfing": "Bearish Engulfing pattern",
    "candle_morning_star": "Morning Star pattern",
    "candle_evening_star": "Evening Star pattern",
    "candle_bullish_signal_count": "Bullish candlestick signal count",
    "candle_bearish_signal_count": "Bearish candlestick signal count",
    "candle_net_signal": "Net candlestick signal (bullish − bearish)",
}
HINT_TEXT = {
    "rsi_high": "overbought — often precedes a pullback",
    "rsi_low": "oversold — often precedes a rebound",
    "stoch_high": "overbought zone",
    "stoch_low": "oversold zone",
    "adx_strong": "strong trend in force",
    "adx_weak": "weak/no clear trend",
    "macd_up": "bullish momentum building",
    "macd_down": "bearish momentum building",
    "ma_up": "short-term trend above long-term trend (bullish)",
    "ma_down": "short-term trend below long-term trend (bearish)",
    "flag": "pattern present on this candle",
    "net_up": "more bullish than bearish patterns detected recently",
    "net_down": "more bearish than bullish patterns detected recently",
}
NARRATIVE_TEXT = {
    "head": "**Top factors behind this {} signal:**",
    "for": "- ✅ ",
    "against": "- ⚠️ ",
    "push": " → pushed toward ",
    "contrary": "\n\n**Working against this call:**\n",
    "none": "No explanation available.",
}
CANDLE_FLAG_NAMES = tuple(k for k in DISPLAY_NAMES if k.startswith("candle_") and not k.endswith(("count", "net_signal")))


def base_feature(feature: Column) -> Column:
    """Strip a ``_lag1``/``_lag2``/``_lag3`` suffix."""
    return F.regexp_replace(feature, "_lag[123]$", "")


def display_name(feature: Column) -> Column:
    """K4: name from the table (by base feature), else underscores as spaces;
    lagged inputs get "(kd ago)"."""
    names = F.create_map(*[x for k, v in DISPLAY_NAMES.items() for x in (F.lit(k), F.lit(v))])
    base = base_feature(feature)
    name = F.coalesce(F.element_at(names, base), F.regexp_replace(feature, "_", " "))
    lag = F.regexp_extract(feature, "_lag([123])$", 1)
    return F.when(lag != "", F.concat(name, F.lit(" ("), lag, F.lit("d ago)"))).otherwise(name)


def hint(feature: Column, value: Column) -> Column:
    """K5: rule of the base feature, strict comparisons; NULL when no clear signal."""
    b = base_feature(feature)
    h = HINT_TEXT
    return (F.when(b == "RSI_14", F.when(value > 70, h["rsi_high"]).when(value < 30, h["rsi_low"]))
            .when(b == "Stoch_K", F.when(value > 80, h["stoch_high"]).when(value < 20, h["stoch_low"]))
            .when(b == "ADX_14", F.when(value > 25, h["adx_strong"]).otherwise(h["adx_weak"]))
            .when(b == "MACD_hist", F.when(value > 0, h["macd_up"]).otherwise(h["macd_down"]))
            .when(b == "MA_crossover", F.when(value >= 1, h["ma_up"]).otherwise(h["ma_down"]))
            .when(b.isin(*CANDLE_FLAG_NAMES), F.when(value >= 1, h["flag"]))
            .when(b == "candle_net_signal", F.when(value > 0, h["net_up"]).when(value < 0, h["net_down"])))


def format_value(feature: Column, value: Column) -> Column:
    """K6: money-like inputs with T/B/Cr/L suffixes, oscillators with one
    decimal, everything else three decimals below 10 and two above."""
    money = feature.contains("market_cap") | feature.contains("revenue") | feature.contains("cash_flow")
    osc = feature.contains("RSI") | feature.contains("Stoch") | feature.contains("ADX")
    a = F.abs(value)
    money_txt = (F.when(a >= 1e12, F.concat(F.format_string("%.2f", value / 1e12), F.lit("T")))
                 .when(a >= 1e9, F.concat(F.format_string("%.2f", value / 1e9), F.lit("B")))
                 .when(a >= 1e7, F.concat(F.format_string("%.2f", value / 1e7), F.lit("Cr")))
                 .when(a >= 1e5, F.concat(F.format_string("%.2f", value / 1e5), F.lit("L")))
                 .otherwise(F.format_number(value, 0)))
    return (F.when(money, money_txt).when(osc, F.format_string("%.1f", value))
            .when(a < 10, F.format_string("%.3f", value)).otherwise(F.format_string("%.2f", value)))


def explanation_table(explained: DataFrame, cols: list[str], top_n: int = 5, keys=("ticker", "bar_date"),
                      scaling: DataFrame | None = None) -> DataFrame:
    """K2-K6: the top ``top_n`` inputs by |contribution| per row (input order
    breaks ties), with value, display name, formatted value, direction and hint.
    With the saved ``scaling`` (column, a, b) values are shown as they were before
    it; ranks and directions stay those of the model's inputs."""
    keys = list(keys)
    names = F.array(*[F.lit(c) for c in cols])
    each = F.transform("contributions", lambda c, i: F.struct(
        (-F.abs(c)).alias("order"), i.alias("pos"), c.alias("shap_value"), F.get("inputs", i).alias("value"),
        F.get(names, i).alias("feature")))
    # a row's own arrays are ranked in place: no shuffle
    best = explained.select(*keys, F.posexplode(F.slice(F.sort_array(each), 1, top_n)).alias("at", "e"))
    top = best.select(*keys, (F.col("at") + 1).alias("rank"), "e.shap_value", "e.value", "e.feature")
    if scaling is not None:  # one row per scaled column
        known = scaling.filter("kind = 'standard'").select(F.col("column").alias("feature"), "a", "b")
        shown = F.coalesce(F.col("value") * F.col("b") + F.col("a"), F.col("value"))
        top = top.join(F.broadcast(known), "feature", "left").withColumn("value", shown).drop("a", "b")
    f, v = F.col("feature"), F.col("value")
    return top.select(*keys, "rank", "feature", display_name(f).alias("display_name"), "value",
                      format_value(f, v).alias("value_display"), "shap_value",
                      F.when(F.col("shap_value") > 0, "BUY").otherwise("SELL").alias("pushes_toward"),
                      hint(f, v).alias("hint"))


def narrative(table: DataFrame, signals: DataFrame, keys=("ticker", "bar_date")) -> DataFrame:
    """K7: up to three supporting and two opposing factors, in rank order."""
    keys = list(keys)
    t = table.join(signals.select(*keys, "signal"), keys)
    hint_txt = F.when(F.col("hint").isNotNull(), F.concat(F.lit(" ("), F.col("hint"), F.lit(")"))).otherwise(F.lit(""))
    other = F.when(F.col("signal") == "BUY", "SELL").otherwise("BUY")
    line = F.concat(F.lit("**"), F.col("display_name"), F.lit("** = "), F.col("value_display"), hint_txt,
                    F.lit(NARRATIVE_TEXT["push"]))
    t = t.withColumn("_sup", F.col("pushes_toward") == F.col("signal")).withColumn(
        "_line", F.when(F.col("_sup"), F.concat(F.lit(NARRATIVE_TEXT["for"]), line, F.col("signal")))
        .otherwise(F.concat(F.lit(NARRATIVE_TEXT["against"]), line, other)))
    g = t.groupBy(*keys, "signal").agg(F.array_sort(F.collect_list(F.struct("rank", "_sup", "_line"))).alias("_l"))
    sup = F.slice(F.transform(F.filter("_l", lambda e: e["_sup"]), lambda e: e["_line"]), 1, 3)
    opp = F.slice(F.transform(F.filter("_l", lambda e: ~e["_sup"]), lambda e: e["_line"]), 1, 2)
    before, after = NARRATIVE_TEXT["head"].split("{}")
    head = F.concat(F.lit(before), F.col("signal"), F.lit(after))
    body = F.concat_ws("\n", F.concat(F.array(head), sup))
    against = F.when(F.size(opp) > 0, F.concat(F.lit(NARRATIVE_TEXT["contrary"]), F.concat_ws("\n", opp))) \
        .otherwise(F.lit(""))
    text = F.when(F.size("_l") == 0, F.lit(NARRATIVE_TEXT["none"])).otherwise(F.concat(body, against))
    return g.select(*keys, "signal", text.alias("narrative"))
