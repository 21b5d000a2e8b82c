"""Histogram trees against a plain learner, on arrays and on tables."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barlab.operators import explain as K
from barlab.operators import models as G
from barlab.operators import trees as T


def table(n=120, f=5, values=9, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, values, (n, f)).astype(np.int16)
    y = ((x[:, 0] + 2 * x[:, 1] + rng.integers(0, values, n)) > 2 * values - 3).astype(float)
    return x, y, np.arange(n) * 7 + 3


def plain_tree(x, g, h, spec, tree, open_features):
    """Nodes as {path: (g, h, feature, cut)}, one node and one split at a time."""
    out = {}

    def value(a, b):
        return a * a / (b + spec.l2) if b + spec.l2 > 0 else 0.0

    def visit(path, level, rows):
        sg, sh = math.fsum(g[r] for r in rows), math.fsum(h[r] for r in rows)
        best = None
        if level < spec.depth:
            for f in open_features(tree, path):
                for cut in sorted({int(x[r, f]) for r in rows})[:-1]:
                    left = [r for r in rows if x[r, f] <= cut]
                    right = [r for r in rows if x[r, f] > cut]
                    gl, hl = math.fsum(g[r] for r in left), math.fsum(h[r] for r in left)
                    gr, hr = math.fsum(g[r] for r in right), math.fsum(h[r] for r in right)
                    if min(len(left), len(right)) < max(1, spec.min_rows) or min(hl, hr) < spec.min_weight:
                        continue
                    gain = value(gl, hl) + value(gr, hr) - value(sg, sh)
                    if gain > T.MIN_GAIN and (best is None or gain > best[0]):
                        best = (gain, f, cut, left, right)
        out[path] = (sg, sh, best[1] if best else -1, best[2] if best else -1)
        if best:
            visit(2 * path, level + 1, best[3])
            visit(2 * path + 1, level + 1, best[4])

    visit(1, 0, list(range(len(g))))
    return out


def by_path(t: T.Grown):
    out, todo = {}, [(0, 1)]
    while todo:
        i, path = todo.pop()
        out[path] = (t.g[i], t.h[i], int(t.feature[i]), int(t.cut[i]))
        if t.feature[i] >= 0:
            todo += [(int(t.left[i]), 2 * path), (int(t.left[i]) + 1, 2 * path + 1)]
    return out


def draws(spec, n):
    def open_features(tree, path):
        mine = T.tree_draw(spec, tree, n)
        return [int(mine[j]) for j in T.node_draw(spec, tree, np.array([path]), mine)[0]]
    return open_features


SPECS = [T.Spec(trees=4), T.Spec(trees=4, depth=3, min_rows=5, node_features=0.5), T.Spec(trees=3, node_features="log2", tree_features=0.8),
         T.boosted(trees=4, depth=3), T.boosted(trees=3, depth=4, rows=0.7, tree_features=0.6, rate=0.3)]


@pytest.mark.parametrize("spec", SPECS)
def test_trees_equal_the_plain_learner(spec):
    x, y, row = table()
    w = T.class_weights(y, T.WEIGHTS[spec.kind])
    if spec.kind == "forest":
        grown = [T.forest_tree(x, y, w, row, spec, t) for t in range(spec.trees)]
    else:
        grown = list(T.boosting_rounds(x, y, w, row, spec))
    margin = np.zeros(len(y))
    for t, tree in enumerate(grown):
        bag = T.in_bag(spec, t, row)
        at = np.flatnonzero(bag) if spec.kind == "forest" or spec.rows < 1 else np.arange(len(y))
        if spec.kind == "forest":
            h = T.whole(w[at]) * bag[at]
            g = h * y[at]
        else:
            p = 1 / (1 + np.exp(-margin))
            g, h = T.whole(w[at] * (y[at] - p[at])), T.whole(w[at] * p[at] * (1 - p[at]))
            margin = margin + T.leaf_values(tree, spec)[tree.places(x)]
        assert by_path(tree) == plain_tree(x[at], g, h, spec, t, draws(spec, x.shape[1]))


def test_leafwise_takes_the_largest_gain_first():
    x, y, row = table(200, 4, 12, seed=3)
    spec = T.leafwise(trees=1, leaves=6, min_rows=4, depth=4)
    g, h = T.whole(y - 0.5), np.full(len(y), 0.25)
    tree = T.grow_leafwise(x, g, h, spec, 0)
    # plain: recount every leaf, split the best one, until there are six
    leaves, splits = [(np.arange(len(y)), 0)], []

    def gain_of(rows):
        best = (-1.0, 0, 0)
        for f in range(x.shape[1]):
            for cut in range(12):
                left = x[rows, f] <= cut
                a, b = rows[left], rows[~left]
                if min(len(a), len(b)) >= spec.min_rows:
                    gain = g[a].sum() ** 2 / h[a].sum() + g[b].sum() ** 2 / h[b].sum() - g[rows].sum() ** 2 / h[rows].sum()
                    if gain > best[0]:
                        best = (gain, f, cut)
        return best

    while len(leaves) < spec.leaves:
        found = [(gain_of(rows), i) for i, (rows, level) in enumerate(leaves) if level < spec.depth]
        (gain, f, cut), i = max(found, key=lambda v: v[0][0])
        if gain <= T.MIN_GAIN:
            break
        rows, level = leaves.pop(i)
        left = x[rows, f] <= cut
        leaves += [(rows[left], level + 1), (rows[~left], level + 1)]
        splits.append((f, cut, round(gain, 9)))
    inner = tree.feature >= 0
    assert sorted(zip(tree.feature[inner].tolist(), tree.cut[inner].tolist(), np.round(tree.gain[inner], 9).tolist())) == sorted(splits)
    assert sorted(np.unique(tree.places(x), return_counts=True)[1].tolist()) == sorted(len(r) for r, _ in leaves)


def frame(spark, n=90, seed=1):
    x, y, _ = table(n, 4, 7, seed)
    pdf = pd.DataFrame(x.astype(float), columns=list("abcd"))
    pdf["label"], pdf["ticker"] = y.astype(int), "T"
    pdf["bar_date"] = pd.date_range("2020-01-01", periods=n)
    df = spark.createDataFrame(pdf)
    return df.withColumn("d", F.when(F.col("d") == 3, None).otherwise(F.col("d")))


def same_nodes(a: pd.DataFrame, b: pd.DataFrame):
    key = ["tree", "id"]
    a, b = a.sort_values(key, ignore_index=True), b.sort_values(key, ignore_index=True)
    assert a[["tree", "id", "left", "feature", "threshold", "cover"]].to_numpy().tolist() == b[
        ["tree", "id", "left", "feature", "threshold", "cover"]].to_numpy().tolist()
    np.testing.assert_allclose(a[["value", "gain"]], b[["value", "gain"]], atol=1e-9)


@pytest.mark.parametrize("spec", [T.Spec(trees=3, depth=4), T.Spec(trees=2, depth=3, min_rows=3, node_features=0.5, tree_features=0.75),
                                  T.boosted(trees=2, depth=2, rows=0.8, tree_features=0.5)])
def test_growing_on_tables_gives_the_same_trees(spark, spec):
    df = frame(spark)
    same_nodes(T.fit(df, list("abcd"), spec).nodes, T.fit(df.repartition(5), list("abcd"), spec, wide=True).nodes)


def test_prefixes(spark):
    df = frame(spark)
    big, small = T.fit(df, list("abcd"), T.Spec(trees=30)), T.fit(df, list("abcd"), T.Spec(trees=10))
    same_nodes(big.nodes[big.nodes["tree"] < 10], small.nodes)


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_search_equals_fits_one_by_one(spark, kind):
    df = frame(spark, 150).withColumn("_pos", F.datediff("bar_date", F.lit("2020-01-01")).cast("long"))
    make = T.Spec if kind == "forest" else T.boosted
    specs = [make(trees=30, depth=3), make(trees=10, depth=3), make(trees=30, depth=2), make(trees=26, depth=3, min_rows=4)]
    bounds = {0: 60, 1: 100}
    folds = df.withColumn("fold", F.when(F.col("_pos") >= 100, 1).when(F.col("_pos") >= 60, 0))
    got = {(r.draw, r.fold): r for r in T.search(folds, list("abcd"), specs, bounds).collect()}
    assert len(got) == 8
    cuts = T.edges(df.fillna(0), list("abcd"))
    s = T.Sample.take(T.binned(T.with_rows(df.fillna(0)), list("abcd"), cuts, ["row", F.col("label"), F.col("_pos").alias("pos")]))
    for (i, fold), r in got.items():
        spec, start, end = specs[i], bounds[fold], 100 if fold == 0 else 150
        tr, te = s.pos < start, (s.pos >= start) & (s.pos < end)
        w = T.class_weights(s.y[tr], T.WEIGHTS[kind])
        grown = [T.forest_tree(s.bins[tr], s.y[tr], w, s.row[tr], spec, t) for t in range(spec.trees)] if kind == "forest" else list(
            T.boosting_rounds(s.bins[tr], s.y[tr], w, s.row[tr], spec))
        raw = sum(T.leaf_values(t, spec)[t.places(s.bins[te])] for t in grown)
        said = raw / spec.trees > 0.5 if kind == "forest" else raw > 0
        hit = s.y[te] == 1
        assert (r.test_rows, r.tp, r.fp, r.fn) == (len(raw), (said & hit).sum(), (said & ~hit).sum(), (~said & hit).sum())
        assert r.f1 == pytest.approx(2 * r.tp / max(1, 2 * r.tp + r.fp + r.fn))


@pytest.mark.parametrize("family", ["rf", "gbt", "leafwise"])
def test_models_score_explain_and_persist(spark, family, tmp_path):
    df = frame(spark, 200, seed=5)
    cols = list("abcd")
    m = G.fit(df, family, cols, trees=12)
    assert sum(m.featureImportances.toArray()) == pytest.approx(1)
    G.save_model(m, str(tmp_path / "m"))
    loaded = G.load_models({"m": str(tmp_path / "m"), "none": str(tmp_path / "none")})
    assert list(loaded) == ["m"]
    a, b = (x.toPandas().sort_values("bar_date")["p"].to_numpy() for x in (G.predict(m, df, cols), G.predict(loaded["m"], df, cols)))
    assert (a == b).all() and (a >= 0).all() and (a <= 1).all()
    rows = df.fillna(0).toPandas().sort_values("bar_date")
    ens = K.ensemble_of(m, spark)
    for p, (_, r) in list(zip(a, rows.iterrows()))[::40]:
        phi, base = K.shap_values(ens, r[cols].to_numpy(float))
        out = base + phi.sum()
        assert p == pytest.approx(out if family == "rf" else 1 / (1 + math.exp(-out)), abs=1e-9)


def test_bounded_rows_and_odd_tables(spark):
    df = frame(spark, 400)
    m = T.fit(df, list("abcd"), T.Spec(trees=2), weights=None, max_rows=100)
    root = m.nodes[m.nodes["id"] == 0]["cover"].to_numpy()
    assert (root > 50).all() and (root < 160).all()
    with pytest.raises(ValueError):
        T.fit(df.limit(0), list("abcd"), T.Spec(trees=1))
    one = T.fit(df.withColumn("label", F.lit(1)).withColumn("a", F.lit(None).cast("double")), list("abcd"), T.Spec(trees=1))
    assert len(one.nodes) == 1 and one.nodes["value"].iloc[0] == 1.0


def test_hash_is_the_same_on_columns(spark):
    rows = [(i, 5 * i + 1) for i in range(50)]
    df = T.scatter_column(spark.createDataFrame(rows, "a long, b long"), "h", 42, F.col("a"), F.col("b"))
    for r in df.collect():
        assert r.h == T.scatter(42, r.a, r.b) == T.scatter(np.array([42]), r.a, np.array([r.b]))[0]


def test_a_fit_takes_all_rows(spark):
    n = 230_000
    df = spark.range(n).selectExpr("concat('T', id % 7) AS ticker", "date_add(DATE'1970-01-01', CAST(id DIV 7 AS INT)) AS bar_date",
                                   "CAST(id * 7919 % 101 AS DOUBLE) AS a", "CAST(id * 104729 % 89 AS DOUBLE) AS b", "CAST(id * 31 % 5 < 2 AS INT) AS label")
    spec = T.Spec(trees=2, depth=2)
    row = T.with_rows(df).select("row").toArrow()["row"].to_numpy()
    m = T.fit(df, ["a", "b"], spec, weights=None)
    assert m.nodes.loc[m.nodes["id"] == 0, "cover"].tolist() == [T.in_bag(spec, t, row).sum() for t in range(2)]
    assert len(T.Sample.take(T.binned(T.with_rows(df), ["a", "b"], [[50.0], [40.0]], ["row", "label", F.lit(0).alias("pos")])).row) == n


@pytest.mark.parametrize("spec", [T.Spec(trees=2, depth=5), T.Spec(trees=2, depth=4, min_rows=3, node_features=0.5, tree_features=0.75),
                                  T.boosted(trees=2, depth=3, rows=0.8, tree_features=0.5)])
@pytest.mark.parametrize("most", [60, 15])
def test_tables_too_large_for_arrays_give_the_same_trees(spark, monkeypatch, spec, most):
    df = frame(spark, 130, seed=2)
    want = T.fit(df, list("abcd"), spec).nodes
    monkeypatch.setattr(T, "ARRAY_ROWS", most)
    grown = []
    monkeypatch.setattr(T, "fit_wide", lambda *a, f=T.fit_wide: grown.append(1) or f(*a))
    same_nodes(want, T.fit(df.repartition(5), list("abcd"), spec).nodes)
    assert grown


@pytest.mark.parametrize("make", [T.Spec, T.boosted])
def test_search_on_a_table_too_large_for_arrays(spark, monkeypatch, make):
    df = frame(spark, 150).withColumn("_pos", F.datediff("bar_date", F.lit("2020-01-01")).cast("long"))
    folds = df.withColumn("fold", F.when(F.col("_pos") >= 100, 1).when(F.col("_pos") >= 60, 0))
    args = folds, list("abcd"), [make(trees=3, depth=3), make(trees=2, depth=2)], {0: 60, 1: 100}
    want = sorted(T.search(*args).collect())
    monkeypatch.setattr(T, "ARRAY_ROWS", 40)
    assert sorted(T.search(*args).collect()) == want and len(want) == 4
