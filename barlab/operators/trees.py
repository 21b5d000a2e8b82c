"""Histogram trees: forests, second-order boosting and leaf-wise boosting over a table binned once.

All of them are one learner. A row has a gradient g and a weight h; a node's
score is G^2 / (H + l2), a split gains the children's scores less its own, and a
leaf is worth G / (H + l2). With g = weight * label and l2 = 0 that is the Gini
gain and the class-1 share of a forest; with the gradient and curvature of the log
loss it is regularised second-order boosting.

Two ways of growing give the same trees, on all labelled rows. ``grow`` works on
the arrays of a table of up to ``ARRAY_ROWS`` rows (about 70 bytes each, broadcast):
tasks then take whole trees or boosting runs. Larger tables stay tables: with
``grow_wide`` a level is one partial aggregate over (tree, node, feature, bin), all
open nodes of all trees at once, a window for the running sums, and a join that
moves rows to the children; the rows of a node that has become small enough meet in
one task, which grows the rest of its tree on arrays. g and h are multiples of
2^-20, so sums are exact and independent of partitioning.

Choices by chance (bootstrap, rows and columns of a tree) come from a hash of
(seed, tree, row or node, feature), so a smaller forest, fewer rounds and a
smaller depth are prefixes of a larger fit; ``search`` grows only the largest.
"""

from __future__ import annotations

import functools
import heapq
import math
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlab.operators import clean
from barlab.session import cut_lineage

#: Rows that a task may hold as arrays; no row is left out of a larger table, which is grown on as a table.
ARRAY_ROWS = 1 << 20
BINS = 64
GRAIN = float(1 << 20)
MIN_GAIN = 1e-7
PRIME = (1 << 31) - 1
NO_DEPTH = 30


@dataclass(frozen=True)
class Spec:
    """What a fit is; the defaults are a forest's."""

    kind: str = "forest"            # or "boosted", "leafwise"
    trees: int = 100
    depth: int = NO_DEPTH
    min_rows: int = 1               # rows of a leaf
    min_weight: float = 0.0         # h of a leaf
    node_features: float | str = "sqrt"   # drawn anew for every node
    tree_features: float = 1.0      # drawn once a tree
    rows: float = 1.0               # share of the rows of a round
    rate: float = 0.05
    l2: float = 0.0
    leaves: int = 31                # leaf-wise only
    seed: int = 42


def boosted(**kw) -> Spec:
    return Spec(**({"kind": "boosted", "trees": 200, "depth": 5, "min_weight": 1.0, "l2": 1.0, "node_features": 1.0} | kw))


def leafwise(**kw) -> Spec:
    return Spec(**({"kind": "leafwise", "trees": 200, "depth": 5, "min_rows": 20, "min_weight": 1e-3, "node_features": 1.0} | kw))


def n_drawn(how: float | str, n: int) -> int:
    k = {"sqrt": math.sqrt(n), "log2": math.log2(max(2, n)), "all": n}[how] if isinstance(how, str) else how * n
    return max(1, min(n, int(k)))


# ---------------------------------------------------------------- chance
def scatter(*parts):
    """Hash of whole numbers into [0, PRIME), on numbers or arrays; ``scatter_column`` is the same."""
    x = 1
    for p in (*parts, 7, 11):
        x = (x + p) % PRIME
        x = (x * x + 40503) % PRIME if isinstance(x, np.ndarray) else (int(x) * int(x) + 40503) % PRIME
    return x


def scatter_column(df: DataFrame, out: str, *parts) -> DataFrame:
    df = df.withColumn(out, F.lit(1).cast("long"))
    for p in (*parts, 7, 11):
        df = df.withColumn(out, (F.col(out) + (p if isinstance(p, Column) else F.lit(p))) % PRIME)
        df = df.withColumn(out, (F.col(out) * F.col(out) + 40503) % PRIME)
    return df


#: Chances of 0, 1, ... copies of a row in a bootstrap sample of as many rows, added up.
COPIES = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(8)])


def in_bag(spec: Spec, tree: int, row: np.ndarray) -> np.ndarray:
    """Copies of each row in a tree's sample."""
    u = scatter(np.full(len(row), spec.seed, np.int64), tree, row.astype(np.int64) % PRIME) / PRIME
    if spec.kind == "forest":
        return np.searchsorted(COPIES, u, side="right")
    return (u < spec.rows).astype(np.int64)


def tree_draw(spec: Spec, tree: int, n: int) -> np.ndarray:
    """Features open to a tree, in rising order."""
    f = np.arange(n, dtype=np.int64)
    return np.sort(np.argsort(scatter(np.full(n, spec.seed, np.int64), tree, 3, f), kind="stable")[:n_drawn(spec.tree_features, n)])


def node_draw(spec: Spec, tree: int, paths: np.ndarray, mine: np.ndarray) -> np.ndarray:
    """Of a tree's features those open to each node, as places in ``mine``, in rising order."""
    k = n_drawn(spec.node_features, len(mine))
    if k == len(mine):
        return np.repeat(np.arange(k)[None, :], len(paths), axis=0)
    rank = scatter(np.full((len(paths), len(mine)), spec.seed, np.int64), tree, paths[:, None] % PRIME, mine[None, :])
    return np.sort(np.argsort(rank, axis=1, kind="stable")[:, :k], axis=1)


# ---------------------------------------------------------------- growing on arrays
@dataclass
class Grown:
    """Nodes of a tree, parents first; the right child follows the left one. Leaves have feature -1."""

    feature: list = field(default_factory=list)
    cut: list = field(default_factory=list)       # last bin that goes left
    left: list = field(default_factory=list)
    g: list = field(default_factory=list)
    h: list = field(default_factory=list)
    gain: list = field(default_factory=list)
    level: list = field(default_factory=list)

    def add(self, g, h, level) -> int:
        n = len(self.g)
        self.g += list(map(float, g))
        self.h += list(map(float, h))
        for x, v in ((self.feature, -1), (self.cut, -1), (self.left, -1), (self.gain, 0.0), (self.level, level)):
            x += [v] * len(g)
        return n

    def split(self, i: int, feature, cut, left, gain) -> None:
        self.feature[i], self.cut[i], self.left[i], self.gain[i] = int(feature), int(cut), int(left), float(gain)

    def arrays(self) -> "Grown":
        return Grown(*(np.array(x, d) for x, d in zip((self.feature, self.cut, self.left, self.g, self.h, self.gain, self.level),
                                                      (np.int64, np.int64, np.int64, float, float, float, np.int64))))

    def places(self, bins: np.ndarray, depth: int | None = None) -> np.ndarray:
        """Node that each row ends in, going down ``depth`` levels at most."""
        at = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        for _ in range(NO_DEPTH if depth is None else depth):
            f = self.feature[at]
            if (f < 0).all():
                break
            step = self.left[at] + (bins[rows, np.maximum(f, 0)] > self.cut[at])
            at = np.where(f < 0, at, step)
        return at


def score(g, h, l2):
    d = h + l2
    return np.where(d > 0, g * g / np.where(d > 0, d, 1.0), 0.0)


def best_splits(node: np.ndarray, bins: np.ndarray, feats: np.ndarray, g, h, total_g, total_h, spec: Spec):
    """Best (gain, feature, cut) of each open node; gain is -inf where none is allowed.

    Cells of (node, feature, bin) are counted where they are fewer than the values, else they are the runs of the
    sorted keys. Equal gains go to the smaller feature, then bin.
    """
    n, k = feats.shape
    mine = bins if k == bins.shape[1] else np.take_along_axis(bins, feats[node], axis=1)
    size = np.bincount(node, minlength=n)
    if n * BINS <= len(node):
        each = np.empty((3, n, k, BINS))
        for j in range(k):
            key = node * BINS + mine[:, j]
            for out, x in zip(each, (g, h, None)):
                out[:, j] = np.bincount(key, x, n * BINS).reshape(n, BINS)
        gl, hl, nl = (np.cumsum(x, axis=2).ravel() for x in each)
        cell = np.arange(n * k * BINS)
    else:
        key, bits = ((node[:, None] * k + np.arange(k)) * BINS + mine).ravel(), len(node).bit_length()
        packed = np.sort((key << bits) | np.repeat(np.arange(len(node)), k))
        key, row = packed >> bits, packed & ((1 << bits) - 1)
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        cell = key[start]
        seg = cell // BINS
        seg_start = np.flatnonzero(np.append(True, seg[1:] != seg[:-1]))
        seg_of = np.repeat(np.arange(len(seg_start)), np.diff(np.append(seg_start, len(seg))))
        gl, hl, nl = (np.cumsum(x) for x in (np.add.reduceat(g[row], start), np.add.reduceat(h[row], start), np.diff(np.append(start, len(key)))))
        gl, hl, nl = (c - np.append(0, c[seg_start[1:] - 1])[seg_of] for c in (gl, hl, nl))
    at = cell // (BINS * k)
    gr, hr, nr = total_g[at] - gl, total_h[at] - hl, size[at] - nl
    gain = score(gl, hl, spec.l2) + score(gr, hr, spec.l2) - score(total_g, total_h, spec.l2)[at]
    least = max(1, spec.min_rows)
    ok = (nl >= least) & (nr >= least) & (hl >= spec.min_weight) & (hr >= spec.min_weight)
    gain = np.where(ok, gain, -np.inf)
    node_start = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    best = np.maximum.reduceat(gain, node_start)
    hit = np.flatnonzero(gain == np.repeat(best, np.diff(np.append(node_start, len(at)))))
    first = hit[np.unique(at[hit], return_index=True)[1]]
    return gain[first], feats[at[first], cell[first] // BINS % k], cell[first] % BINS


def grow(bins: np.ndarray, g: np.ndarray, h: np.ndarray, spec: Spec, tree: int, path: int = 1, top: int = 0) -> Grown:
    """A tree over the rows given, level by level, or what is below its node ``path`` of level ``top``."""
    out, mine = Grown(), tree_draw(spec, tree, bins.shape[1])
    bins = bins if len(mine) == bins.shape[1] else bins[:, mine]
    node, paths, ids = np.zeros(len(g), np.int64), np.array([path], np.int64), np.array([0])
    out.add([g.sum()], [h.sum()], top)
    for level in range(top, spec.depth):
        if not len(ids):
            break
        tg, th = (np.bincount(node, weights=x, minlength=len(ids)) for x in (g, h))
        gain, feature, cut = best_splits(node, bins, node_draw(spec, tree, paths, mine), g, h, tg, th, spec)
        go = gain > MIN_GAIN
        rank = np.cumsum(go) - 1
        side = (bins[np.arange(len(node)), feature[node]] > cut[node]).astype(np.int64)
        keep = go[node]
        node, side, bins, g, h = (x[keep] for x in (node, side, bins, g, h))
        node = 2 * rank[node] + side
        kids = 2 * int(go.sum())
        first = out.add(np.bincount(node, weights=g, minlength=kids), np.bincount(node, weights=h, minlength=kids), level + 1) if kids else 0
        for i, j in zip(np.flatnonzero(go).tolist(), rank[go].tolist()):
            out.split(ids[i], mine[feature[i]], cut[i], first + 2 * j, gain[i])
        paths = (2 * np.repeat(paths[go], 2) + np.tile([0, 1], kids // 2)).astype(np.int64)
        ids = first + np.arange(kids)
    return out.arrays()


def grow_leafwise(bins: np.ndarray, g: np.ndarray, h: np.ndarray, spec: Spec, tree: int) -> Grown:
    """A tree that splits the leaf of largest gain next, until it has ``spec.leaves``.

    A split counts the histogram of its smaller child; the larger one's is the parent's less that.
    """
    feats = tree_draw(spec, tree, bins.shape[1])
    cells = np.arange(len(feats)) * BINS + bins[:, feats]

    def histogram(rows):
        flat, k = cells[rows].ravel(), len(feats)
        return np.stack([np.bincount(flat, np.repeat(x, k), len(feats) * BINS) for x in (g[rows], h[rows], np.ones(len(rows)))])

    def candidate(i, rows, hist):
        run = np.cumsum(hist.reshape(3, len(feats), BINS), axis=2)
        total = run[:, :1, -1:]
        rest = total - run
        gain = score(run[0], run[1], spec.l2) + score(rest[0], rest[1], spec.l2) - score(total[0], total[1], spec.l2)
        ok = (run[2] >= max(1, spec.min_rows)) & (rest[2] >= max(1, spec.min_rows)) & (run[1] >= spec.min_weight) & (rest[1] >= spec.min_weight)
        gain = np.where(ok, gain, -np.inf)
        at = int(np.argmax(gain))
        if gain.flat[at] > MIN_GAIN and out.level[i] < spec.depth:
            heapq.heappush(queue, (-gain.flat[at], i, int(feats[at // BINS]), at % BINS, rows, hist))

    out, queue = Grown(), []
    every = np.arange(len(g))
    out.add([g.sum()], [h.sum()], 0)
    candidate(0, every, histogram(every))
    n_leaves = 1
    while queue and n_leaves < spec.leaves:
        gain, i, feature, cut, rows, hist = heapq.heappop(queue)
        side = bins[rows, feature] > cut
        kids = [rows[~side], rows[side]]
        small = int(len(kids[1]) < len(kids[0]))
        mine = histogram(kids[small])
        hists = [mine, hist - mine] if small == 0 else [hist - mine, mine]
        left = out.add([g[k].sum() for k in kids], [h[k].sum() for k in kids], out.level[i] + 1)
        out.split(i, feature, cut, left, -gain)
        for j in (0, 1):
            candidate(left + j, kids[j], hists[j])
        n_leaves += 1
    return out.arrays()


def whole(x: np.ndarray) -> np.ndarray:
    """Rounded so that sums are exact."""
    return np.round(x * GRAIN) / GRAIN


def forest_tree(bins, y, w, row, spec: Spec, tree: int) -> Grown:
    k = in_bag(spec, tree, row)
    at = np.flatnonzero(k)
    weight = whole(w[at]) * k[at]
    return grow(bins[at], weight * y[at], weight, spec, tree)


def boosting_rounds(bins, y, w, row, spec: Spec, margin: np.ndarray | None = None):
    """The trees of one run, one after the other; a leaf moves a row's log odds by rate * G / (H + l2)."""
    f = np.zeros(len(y)) if margin is None else margin
    build = grow_leafwise if spec.kind == "leafwise" else grow
    for tree in range(spec.trees):
        p = 1 / (1 + np.exp(-f))
        at = np.flatnonzero(in_bag(spec, tree, row)) if spec.rows < 1 else np.arange(len(y))
        t = build(bins[at], whole(w[at] * (y[at] - p[at])), whole(w[at] * p[at] * (1 - p[at])), spec, tree)
        f = f + leaf_values(t, spec)[t.places(bins)]
        yield t


def leaf_values(t: Grown, spec: Spec) -> np.ndarray:
    d = t.h + spec.l2
    v = np.where(d > 0, t.g / np.where(d > 0, d, 1.0), 0.0)
    return v if spec.kind == "forest" else spec.rate * v


# ---------------------------------------------------------------- the binned table
def edges(df: DataFrame, cols: list[str], bins: int = BINS) -> list[list[float]]:
    """Upper bounds of all bins but the last, per column: its quantiles, from one mergeable aggregate."""
    at = [i / bins for i in range(1, bins)]
    q = df.agg(*[F.percentile_approx(F.col(c), at, 10_000).alias(f"q{i}") for i, c in enumerate(cols)]).first()  # bins * columns numbers
    return [sorted({float(x) for x in v}) if v else [] for v in q]


def binned(df: DataFrame, cols: list[str], cuts: list[list[float]], keep: list[str]) -> DataFrame:
    """``keep`` and ``bins``, an array with the number of bounds below each value."""
    def place(c, cut):
        if not cut:
            return F.lit(0)
        return F.size(F.filter(F.array(*map(F.lit, cut)), lambda e: e < F.col(c)))
    return df.select(*keep, F.array(*[place(c, e) for c, e in zip(cols, cuts)]).cast("array<tinyint>").alias("bins"))


def with_rows(df: DataFrame, order=("bar_date", "ticker")) -> DataFrame:
    """``row``: a hash of the order columns, the same in any layout."""
    order = [c for c in order if c in df.columns]
    return df.withColumn("row", F.pmod(F.xxhash64(*order) if order else F.monotonically_increasing_id(), F.lit(PRIME)))


@dataclass
class Sample:
    """The binned rows of a fit as arrays, all of them, in the order of ``pos`` and ``row``."""

    bins: np.ndarray
    y: np.ndarray
    row: np.ndarray
    pos: np.ndarray

    @classmethod
    def take(cls, table: DataFrame) -> "Sample":
        """All rows of a binned table with label, row and pos."""
        got = table.select("bins", "label", "row", "pos").toArrow()
        if not got.num_rows:
            raise ValueError("no labelled rows")
        pos, row, y = (got[c].to_numpy().astype(kind) for c, kind in (("pos", np.int64), ("row", np.int64), ("label", float)))
        order = np.lexsort((row, pos))
        return cls(array_of(got["bins"])[order], y[order], row[order], pos[order])


def array_of(bins) -> np.ndarray:
    """Rows of an Arrow column of bins."""
    return bins.combine_chunks().flatten().to_numpy().reshape(len(bins), -1)


def class_weights(y: np.ndarray, how: str | None) -> np.ndarray:
    """balanced: n / (2 n_c); positive: n0 / max(n1, 1) for class 1; None: 1."""
    n1 = y.sum()
    if how == "balanced":
        return np.where(y == 1, len(y) / (2 * max(n1, 1)), len(y) / (2 * max(len(y) - n1, 1)))
    return np.where(y == 1, (len(y) - n1) / max(n1, 1), 1.0) if how == "positive" else np.ones(len(y))


WEIGHTS = {"forest": "balanced", "boosted": "positive", "leafwise": None}


# ---------------------------------------------------------------- models
NODES = "tree int, id int, left int, feature int, threshold double, value double, cover double, gain double"


def node_rows(t: Grown, tree: int, spec: Spec, cuts: list[list[float]]) -> pd.DataFrame:
    inner = t.feature >= 0
    cut = np.array([cuts[f][c] if f >= 0 else 0.0 for f, c in zip(t.feature.tolist(), t.cut.tolist())])
    return pd.DataFrame({"tree": tree, "id": np.arange(len(inner)), "left": t.left, "feature": t.feature, "threshold": cut,
                         "value": leaf_values(t, spec), "cover": t.h, "gain": t.gain})


class TreeModel:
    """A fitted ensemble; its node table is model-sized and kept as arrays.

    ``transform`` and ``featureImportances`` are as Spark ML models have them.
    """

    def __init__(self, nodes: pd.DataFrame, kind: str, n_features: int):
        self.nodes = nodes.sort_values(["tree", "id"], ignore_index=True)
        self.kind, self.n_features = kind, n_features
        sizes = self.nodes.groupby("tree").size().sort_index().to_numpy()
        self.roots = np.cumsum(sizes) - sizes

    @property
    def getNumTrees(self) -> int:
        return len(self.roots)

    @property
    def featureImportances(self):
        """Gain by feature; a forest's trees count alike."""
        n = self.nodes[self.nodes["feature"] >= 0]
        per = n["gain"] / n.groupby("tree")["gain"].transform("sum") if self.kind == "forest" else n["gain"]
        total = np.bincount(n["feature"], weights=per, minlength=self.n_features)
        return Vectors.dense(total / total.sum() if total.sum() else total)

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Class-1 probability of a forest, log odds of boosting."""
        return self.total(x) / max(1, len(self.roots)) if self.kind == "forest" else self.total(x)

    def total(self, x: np.ndarray) -> np.ndarray:
        """Sum of the leaves that each row ends in."""
        feature, threshold, value = (self.nodes[c].to_numpy() for c in ("feature", "threshold", "value"))
        left = self.nodes["left"].to_numpy() + np.repeat(self.roots, np.diff(np.append(self.roots, len(self.nodes))))
        out = np.zeros(len(x))
        rows = np.arange(len(x))
        for root in self.roots.tolist():
            at = np.full(len(x), root)
            while True:
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                at = np.where(inner, left[at] + (x[rows, np.maximum(f, 0)] > threshold[at]), at)
            out += value[at]
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def chance(x: pd.Series) -> pd.Series:
            m = shared.value
            raw = m.raw(np.stack(x.to_numpy())) if len(x) else np.zeros(0)
            return pd.Series(raw if m.kind == "forest" else 1 / (1 + np.exp(-raw)))

        scored = df.withColumn("_p", chance(vector_to_array("features")))
        return scored.withColumns({"probability": array_to_vector(F.array(1 - F.col("_p"), F.col("_p"))),
                                   "prediction": (F.col("_p") > 0.5).cast("double")}).drop("_p")

    def save(self, spark: SparkSession, path: str) -> None:
        table = spark.createDataFrame(self.nodes, NODES).withColumns({"kind": F.lit(self.kind), "n_features": F.lit(self.n_features)})
        table.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "TreeModel":
        pdf = spark.read.parquet(path).toPandas()  # model-sized
        return cls(pdf.drop(columns=["kind", "n_features"]), pdf["kind"].iloc[0], int(pdf["n_features"].iloc[0]))


#: Trees of a forest that one task grows in a row, or that grow together on a table.
BLOCK_TREES = 25


def is_wide(table: DataFrame, spec: Spec) -> bool:
    """Whether a table has too many rows for arrays."""
    return spec.kind != "leafwise" and table.count() > ARRAY_ROWS


def fit(df: DataFrame, cols: list[str], spec: Spec, weights: str | None = "default", max_rows: int | None = None,
        wide: bool | None = None) -> TreeModel:
    """A model of ``label`` on ``cols``, from all rows; ``max_rows``, if a caller gives it, thins them to about so many.

    ``wide`` grows on the table instead of on arrays: by default if it has over ``ARRAY_ROWS`` rows. Leaf-wise
    trees only grow on arrays, of as many rows as there are.
    """
    weights = WEIGHTS[spec.kind] if weights == "default" else weights
    df = cut_lineage(clean.fill_zero(with_rows(df).select("row", "label", *[F.col(c).cast("double").alias(c) for c in cols]), cols))
    cuts = edges(df, cols)
    table = binned(df, cols, cuts, ["row", F.col("label").cast("double").alias("label"), F.lit(0).alias("pos")])
    if max_rows is not None and (n := df.count()) > max_rows:
        table = table.filter(F.pmod(F.xxhash64(F.lit(17), "row"), F.lit(1 << 20)) < int(max_rows / n * (1 << 20)))
    if is_wide(table, spec) if wide is None else wide:
        return TreeModel(fit_wide(table, spec, weights, cuts), spec.kind, len(cols))
    sample = Sample.take(table)
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(sample)

    def trees(jobs):
        s = shared.value
        w = class_weights(s.y, weights)
        for pdf in jobs:
            for first, n in zip(pdf["first"], pdf["n"]):
                grown = ((t, forest_tree(s.bins, s.y, w, s.row, spec, t)) for t in range(first, first + n)) if spec.kind == "forest" else \
                    enumerate(boosting_rounds(s.bins, s.y, w, s.row, spec))
                for t, g in grown:
                    yield node_rows(g, t, spec, cuts)

    step = BLOCK_TREES if spec.kind == "forest" else spec.trees
    jobs = spark.createDataFrame([(i, min(step, spec.trees - i)) for i in range(0, spec.trees, step)], "first int, n int")
    nodes = jobs.repartition(-(-spec.trees // step)).mapInPandas(trees, NODES).toPandas()  # model-sized
    return TreeModel(nodes, spec.kind, len(cols))


# ---------------------------------------------------------------- search
def search(df: DataFrame, cols: list[str], specs: list[Spec], bounds: dict[int, int], weights: str | None = "default") -> DataFrame:
    """draw, fold, test_rows, tp, fp, fn, tn and f1 of every spec on every walk-forward fold, in one pass over all fits.

    ``df`` has label, ``_pos`` and ``fold``; a fold trains on all positions below its
    bound. Specs that differ in trees or depth alone are one fit, read at several sizes;
    a table of over ``ARRAY_ROWS`` rows is fitted spec by spec and fold by fold.
    """
    spark = df.sparkSession
    weights = WEIGHTS[specs[0].kind] if weights == "default" else weights
    df = cut_lineage(clean.fill_zero(with_rows(df).select("row", "label", "_pos", *[F.col(c).cast("double").alias(c) for c in cols]), cols))
    cuts = edges(df, cols)
    table = binned(df, cols, cuts, ["row", F.col("label").cast("double").alias("label"), F.col("_pos").alias("pos")])
    forest = specs[0].kind == "forest"
    if is_wide(table, specs[0]):
        return _search_scores(search_wide(table, specs, bounds, weights, cuts), specs)
    shared = spark.sparkContext.broadcast((Sample.take(table), bounds))
    alike: dict[Spec, list[int]] = {}
    for i, s in enumerate(specs):
        alike.setdefault(replace(s, trees=0, depth=s.depth if not forest else 0), []).append(i)
    fits = [(replace(specs[same[0]], trees=max(specs[i].trees for i in same), depth=max(specs[i].depth for i in same)),
             [(i, specs[i].trees, specs[i].depth) for i in same]) for same in alike.values()]

    def run(jobs):
        s, starts = shared.value
        ends = sorted(starts.values())[1:] + [np.iinfo(np.int64).max]
        end_of = dict(zip(sorted(starts, key=starts.get), ends))
        for pdf in jobs:
            for which, fold, first, n in zip(pdf["fit"], pdf["fold"], pdf["first"], pdf["n"]):
                spec, wanted = fits[which]
                tr, te = s.pos < starts[fold], (s.pos >= starts[fold]) & (s.pos < end_of[fold])
                x, y, row, test = s.bins[tr], s.y[tr], s.row[tr], s.bins[te]
                if not len(y) or not len(test):
                    continue
                w = class_weights(y, weights)
                depths = sorted({min(d, spec.depth) for _, _, d in wanted})
                total = {d: np.zeros(len(test)) for d in depths}
                grown = ((t, forest_tree(x, y, w, row, spec, t)) for t in range(first, first + n)) if forest else enumerate(
                    boosting_rounds(x, y, w, row, spec))
                for t, g in grown:
                    v = leaf_values(g, spec)
                    for d in depths:
                        total[d] += v[g.places(test, d)]
                    for i, trees, d in wanted:  # a draw's share of this job ends here
                        if t + 1 == min(trees, first + n) and trees > first:
                            yield pd.DataFrame({"draw": i, "fold": fold, "row": s.row[te], "pos": s.pos[te], "label": s.y[te],
                                                "raw": total[min(d, spec.depth)]})

    step = BLOCK_TREES if forest else 1 << 30
    jobs = [(k, fold, i, min(step, spec.trees - i)) for k, (spec, _) in enumerate(fits) for fold in bounds for i in range(0, spec.trees, step)]
    jobs = spark.createDataFrame(jobs, "fit int, fold int, first int, n int").repartition(min(len(jobs), 256))
    return _search_scores(jobs.mapInPandas(run, RAW), specs)


RAW = "draw int, fold int, row long, pos long, label double, raw double"


def _search_scores(raw: DataFrame, specs: list[Spec]) -> DataFrame:
    """The table of ``search`` from the leaf values of every test row, in one part or several."""
    forest = specs[0].kind == "forest"
    per_row = raw.groupBy("draw", "fold", "pos", "row").agg(F.sum("raw").alias("raw"), F.first("label").alias("label"))
    size = F.element_at(F.array(*[F.lit(float(s.trees)) for s in specs]), F.col("draw") + 1)
    said = F.col("raw") / size > 0.5 if forest else F.col("raw") > 0
    hit = F.col("label") == 1
    out = per_row.groupBy("draw", "fold").agg(
        F.count(F.lit(1)).alias("test_rows"), F.count_if(said & hit).alias("tp"), F.count_if(said & ~hit).alias("fp"),
        F.count_if(~said & hit).alias("fn"), F.count_if(~said & ~hit).alias("tn"))
    f1 = F.coalesce(F.try_divide(2.0 * F.col("tp"), 2.0 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0))
    return cut_lineage(out.withColumn("f1", f1))


# ---------------------------------------------------------------- growing on tables
def _score(g: str, h: str, l2: float) -> Column:
    d = F.col(h) + l2
    return F.when(d > 0, F.col(g) * F.col(g) / d).otherwise(0.0)


def split_gains(rows: DataFrame, total: DataFrame, spec: Spec, n_features: int) -> DataFrame:
    """tree, path, feature, bin and gain of every split that the open nodes in ``total`` may make."""
    at = ["tree", "path"]
    names = _open_features(total.select(*at), spec, n_features)
    if names is None:
        each = rows.select(*at, "g", "h", F.posexplode("bins").alias("feature", "bin"))
    else:
        each = rows.join(names.groupBy(*at).agg(F.collect_list("feature").alias("names")), at).select(
            *at, "g", "h", "bins", F.explode("names").alias("feature")).withColumn("bin", F.get("bins", F.col("feature")))
    cells = each.groupBy(*at, "feature", "bin").agg(F.sum("g").alias("cg"), F.sum("h").alias("ch"), F.count(F.lit(1)).alias("cn"))
    run = Window.partitionBy(*at, "feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = cells.withColumns({c: F.sum(x).over(run) for c, x in (("gl", "cg"), ("hl", "ch"), ("nl", "cn"))}).join(total, at)
    cells = cells.withColumns({"gr": F.col("g") - F.col("gl"), "hr": F.col("h") - F.col("hl"), "nr": F.col("n") - F.col("nl")})
    gain = _score("gl", "hl", spec.l2) + _score("gr", "hr", spec.l2) - _score("g", "h", spec.l2)
    least = max(1, spec.min_rows)
    ok = (F.col("nl") >= least) & (F.col("nr") >= least) & (F.col("hl") >= spec.min_weight) & (F.col("hr") >= spec.min_weight)
    return cells.withColumn("gain", gain).filter(ok & (F.col("gain") > MIN_GAIN)).select(*at, "feature", "bin", "gain")


def grow_wide(rows: DataFrame, spec: Spec, n_features: int) -> DataFrame:
    """Nodes (tree, path, level, g, h, feature, cut, gain) of the trees of ``rows`` (tree, bins, g, h), all at once.

    ``path`` is 1 at the root, twice the parent's to the left and one more to the right.
    What is below a node of at most ``ARRAY_ROWS`` rows is grown in one task.
    """
    at = ["tree", "path"]
    rows, done = rows.withColumn("path", F.lit(1).cast("long")), []
    for level in range(spec.depth + 1):
        rows = cut_lineage(rows) if level else rows  # bags are cheaper to draw again than to store
        total = rows.groupBy(*at).agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.count(F.lit(1)).alias("n"))
        total = cut_lineage(total.withColumn("level", F.lit(level)))
        small = F.col("n") <= ARRAY_ROWS
        done.append(rows.join(total.filter(small).select(*at), at).groupBy(*at).applyInArrow(_grow_below(spec, level), NODE_PATHS))
        # those left have over ARRAY_ROWS rows each, so they are few
        total = total.filter(~small)
        if total.isEmpty():
            break
        big = rows.join(F.broadcast(total.select(*at)), at)
        if level < spec.depth:
            cells = split_gains(big, total, spec, n_features)
            pick = F.max(F.struct("gain", (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"))).alias("s")
            best = cells.groupBy(*at).agg(pick).select(*at, (-F.col("s.f")).cast("int").alias("feature"), (-F.col("s.b")).cast("int").alias("cut"), "s.gain")
            nodes = cut_lineage(total.join(best, at, "left"))
        else:
            nodes = total.withColumns({"feature": F.lit(None).cast("int"), "cut": F.lit(None).cast("int"), "gain": F.lit(None).cast("double")})
        done.append(nodes.select(*at, "level", "g", "h", F.coalesce("feature", F.lit(-1)).alias("feature"), F.coalesce("cut", F.lit(-1)).alias("cut"),
                                 F.coalesce("gain", F.lit(0.0)).alias("gain")))
        best = nodes.filter("feature is not null").select(*at, "feature", "cut")
        step = F.col("path") * 2 + (F.element_at("bins", F.col("feature") + 1) > F.col("cut")).cast("int")
        rows = big.join(F.broadcast(best), at).withColumn("path", step).drop("feature", "cut")
    return functools.reduce(DataFrame.union, done)


NODE_PATHS = "tree int, path long, level int, g double, h double, feature int, cut int, gain double"


def _grow_below(spec: Spec, level: int):
    """Task: the nodes at and below one node, from its rows."""
    def run(rows):
        import pyarrow as pa

        tree, path = rows["tree"][0].as_py(), rows["path"][0].as_py()
        t = grow(array_of(rows["bins"]), rows["g"].to_numpy(), rows["h"].to_numpy(), spec, tree, path, level)
        paths = np.full(len(t.g), path, np.int64)
        for i in np.flatnonzero(t.feature >= 0):  # parents first
            paths[t.left[i]:t.left[i] + 2] = 2 * paths[i], 2 * paths[i] + 1
        cols = (np.full(len(t.g), tree, np.int32), paths, t.level.astype(np.int32), t.g, t.h, t.feature.astype(np.int32), t.cut.astype(np.int32), t.gain)
        return pa.table(dict(zip((c.split()[0] for c in NODE_PATHS.split(", ")), cols)))
    return run


def _open_features(nodes: DataFrame, spec: Spec, n: int) -> DataFrame | None:
    """tree, path and feature of the features that each node's tree, and of these the node, drew; None if all are open."""
    names, drawn, seed = None, n, spec.seed
    for share, key, parts in ((spec.tree_features, ["tree"], (seed, F.col("tree"), 3, F.col("feature"))),
                              (spec.node_features, ["tree", "path"], (seed, F.col("tree"), F.col("path") % PRIME, F.col("feature")))):
        k = n_drawn(share, drawn)
        if k < drawn:
            every = nodes.select(*key).distinct()
            every = every.join(names, "tree") if names is not None else every.withColumn("feature", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
            nth = F.row_number().over(Window.partitionBy(*key).orderBy("_r", "feature"))
            names, drawn = scatter_column(every, "_r", *parts).withColumn("_n", nth).filter(F.col("_n") <= k).select(*key, "feature"), k
    return names if names is None or "path" in names.columns else nodes.join(names, "tree")


def fit_wide(table: DataFrame, spec: Spec, weights: str | None, cuts: list[list[float]]) -> pd.DataFrame:
    """Node rows of a fit on every row of a binned table; ``BLOCK_TREES`` of a forest grow together, rounds follow one another."""
    if spec.kind == "leafwise":
        raise ValueError("leaf-wise trees grow one leaf at a time, on arrays")
    n = table.agg(F.sum("label").alias("p"), F.count(F.lit(1)).alias("n")).first()
    of = dict(zip((0.0, 1.0), class_weights(np.array([0.0, 1.0]), None)))
    n1, n0 = n["p"] or 0, n["n"] - (n["p"] or 0)
    if weights == "balanced":
        of = {0.0: n["n"] / (2 * max(n0, 1)), 1.0: n["n"] / (2 * max(n1, 1))}
    elif weights == "positive":
        of[1.0] = n0 / max(n1, 1)
    rounded = lambda c: F.rint(c * GRAIN) / GRAIN
    w = F.when(F.col("label") == 1, of[1.0]).otherwise(of[0.0])

    def bag(df, tree):
        return scatter_column(df, "_u", spec.seed, tree, F.col("row") % PRIME).withColumn("_u", F.col("_u") / PRIME)

    if spec.kind == "forest":
        copies = sum(((F.col("_u") >= float(c)).cast("int") for c in COPIES[1:]), (F.col("_u") >= float(COPIES[0])).cast("int"))
        table, found = cut_lineage(table), []
        for first in range(0, spec.trees, BLOCK_TREES):  # so that only these trees' bags are shuffled at a time
            some = F.sequence(F.lit(first), F.lit(min(first + BLOCK_TREES, spec.trees) - 1))
            each = bag(table.withColumn("tree", F.explode(some)), F.col("tree")).withColumn("h", rounded(w) * copies).filter("h > 0")
            each = each.select("tree", "bins", (F.col("h") * F.col("label")).alias("g"), "h")
            found.append(_wide_rows(grow_wide(each, spec, len(cuts)), spec, cuts))
        return pd.concat(found)
    f = table.withColumn("f", F.lit(0.0))
    found = []
    for tree in range(spec.trees):
        f = cut_lineage(f)
        p = 1 / (1 + F.exp(-F.col("f")))
        rows = f.withColumn("_p", p)
        rows = bag(rows, F.lit(tree)).filter(F.col("_u") < spec.rows) if spec.rows < 1 else rows
        rows = rows.select(F.lit(tree).alias("tree"), "bins", rounded(w * (F.col("label") - F.col("_p"))).alias("g"),
                           rounded(w * F.col("_p") * (1 - F.col("_p"))).alias("h"))
        nodes = _wide_rows(grow_wide(rows, spec, len(cuts)), spec, cuts)
        found.append(nodes)
        f = f.withColumn("f", F.col("f") + leaves_of(TreeModel(nodes.assign(tree=0), spec.kind, len(cuts)), cuts)("bins"))
    return pd.concat(found)


def leaves_of(model: TreeModel, cuts: list[list[float]]):
    """Sum of the leaves of a row of bins, as a function of columns."""
    bounds = [[*c, math.inf] for c in cuts]  # a bin's upper bound lies on the side of all its values

    @F.pandas_udf("double")
    def total(b: pd.Series) -> pd.Series:
        return pd.Series(model.total(np.array([[bounds[j][k] for j, k in enumerate(r)] for r in b]))) if len(b) else pd.Series([], dtype=float)

    return total


def search_wide(table: DataFrame, specs: list[Spec], bounds: dict[int, int], weights: str | None, cuts: list[list[float]]) -> DataFrame:
    """The leaf values of every draw's and fold's test rows, fitted on tables one by one."""
    starts, out = sorted(bounds.items(), key=lambda x: x[1]), []
    for (fold, start), end in zip(starts, [s for _, s in starts[1:]] + [np.iinfo(np.int64).max]):
        train, test = table.filter(F.col("pos") < start), table.filter((F.col("pos") >= start) & (F.col("pos") < int(end)))
        if train.isEmpty() or test.isEmpty():
            continue
        for i, spec in enumerate(specs):
            model = TreeModel(fit_wide(train, spec, weights, cuts), spec.kind, len(cuts))
            out.append(cut_lineage(test.select(F.lit(i).alias("draw"), F.lit(fold).alias("fold"), "row", "pos", "label",
                                               leaves_of(model, cuts)("bins").alias("raw"))))
    return functools.reduce(DataFrame.union, out, table.sparkSession.createDataFrame([], RAW))


def _wide_rows(nodes: DataFrame, spec: Spec, cuts: list[list[float]]) -> pd.DataFrame:
    """Node rows as ``node_rows`` makes them, from paths."""
    out = []
    for tree, pdf in nodes.toPandas().groupby("tree"):  # model-sized
        pdf = pdf.sort_values(["level", "path"], ignore_index=True)
        at = {p: i for i, p in enumerate(pdf["path"].tolist())}
        left = np.array([at[2 * p] if f >= 0 else -1 for p, f in zip(pdf["path"].tolist(), pdf["feature"].tolist())])
        grown = Grown(pdf["feature"].to_numpy(), pdf["cut"].to_numpy(), left, pdf["g"].to_numpy(), pdf["h"].to_numpy(), pdf["gain"].to_numpy(),
                      pdf["level"].to_numpy())
        out.append(node_rows(grown, int(tree), spec, cuts))
    return pd.concat(out)
