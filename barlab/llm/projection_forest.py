"""Approximate nearest neighbours: a forest of random-projection trees.

Every tree level has a random direction; a node splits its rows at the median of
their projections. Trees are fitted on a bounded sample (``FIT_ROWS``), every row
is indexed. A search keeps one priority queue over all trees: the branch nearest
to the query, by the largest margin crossed on the way, is opened next, until the
leaves seen hold a given share of the rows. That share is calibrated: the smallest
of ``SHARES`` at which sample queries find ``RECALL_GOAL`` of their true
neighbours in the sample. Candidates are reranked exactly, leaf by leaf, in matrix
products of double precision.

Equal vectors are indexed once, with their smallest ids (as many as a result can
show), so a vector that fills a third of the table is one row of its leaf. Leaves
and their queries are dealt in blocks of ``BLOCK`` rows each way, which bounds a
task. Driver and broadcasts hold the trees and the leaf sizes alone
(``TREES * 2 ** MAX_DEPTH`` entries at most).

Edge cases: vectors that are null, empty, zero, or hold null or non-finite
components take no part, nor do null ids or vectors of another length than most
of the sample; rows of one id are one, with the smallest of their vectors; ties go to the smaller id; with fewer candidates than
asked for, all are returned; an empty table gives no rows; only vec_id and
embedding are read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlab.llm import vectors as V
from barlab.llm.workspace import Workspace

TREES = 8
#: A leaf holds about n ** 0.6 / 2 rows of n: with a fixed size, the leaves that a share
#: of the rows fills, and the (query, leaf) probes with them, would grow like n squared.
LEAF_ROWS, LEAF_POWER, LEAF_FACTOR = 64, 0.6, 0.5
MAX_DEPTH = 12
FIT_ROWS = 32_768
#: Rows to see, over all trees, as shares of the rows indexed.
SHARES = (1 / 64, 1 / 32, 1 / 16, 1 / 8, 1 / 4, 3 / 8, 1 / 2, 5 / 8, 3 / 4, 1, 5 / 4, 3 / 2, 2, 3, 4)
RECALL_GOAL = 0.96
PROBE_QUERIES = 128
BLOCK = 4096
SEED = 11


def usable(vec: str = "embedding"):
    c = F.col(vec)
    real = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return c.isNotNull() & real & F.exists(c, lambda x: x != 0)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Forest:
    """Directions (a column per tree and level) and split values (a row per tree, heap order)."""

    def __init__(self, sample: np.ndarray, trees: int, depth: int, seed: int = SEED):
        self.trees, self.depth = trees, depth
        rng = np.random.default_rng(seed)
        self.dirs = rng.standard_normal((sample.shape[1], trees * max(depth, 1)))
        self.splits = np.zeros((trees, (1 << depth) - 1))
        p = self.project(sample)
        for t in range(trees):
            node = np.zeros(len(sample), np.int64)
            for level in range(depth):
                base = (1 << level) - 1
                here = p[:, t, level]
                order = np.lexsort((here, node))
                sizes = np.bincount(node - base, minlength=1 << level)
                mid = np.cumsum(sizes) - sizes + sizes // 2
                ok = sizes > 0
                self.splits[t, base: base + (1 << level)][ok] = here[order[np.minimum(mid, len(order) - 1)[ok]]]
                node = 2 * node + 1 + (here >= self.splits[t, node])

    def project(self, unit_vectors: np.ndarray) -> np.ndarray:
        return (unit_vectors @ self.dirs).reshape(len(unit_vectors), self.trees, -1)

    def leaves(self, p: np.ndarray) -> np.ndarray:
        """Leaf number of each row in each tree."""
        out = np.zeros((len(p), self.trees), np.int64)
        for t in range(self.trees):
            node = np.zeros(len(p), np.int64)
            for level in range(self.depth):
                node = 2 * node + 1 + (p[:, t, level] >= self.splits[t, node])
            out[:, t] = node - ((1 << self.depth) - 1)
        return out

    def search(self, p: np.ndarray, sizes: np.ndarray, rows: int) -> list[tuple[int, int]]:
        """(tree, leaf) in the order of one shared queue until they hold ``rows`` rows."""
        queue = [(0.0, t, 0, 0) for t in range(self.trees)]
        found, seen, inner = [], 0, (1 << self.depth) - 1
        while queue and seen < rows:
            margin, t, node, level = heapq.heappop(queue)
            while node < inner:
                gap = p[t, level] - self.splits[t, node]
                near, far = (2 * node + 2, 2 * node + 1) if gap >= 0 else (2 * node + 1, 2 * node + 2)
                level += 1
                heapq.heappush(queue, (max(margin, abs(gap)), t, far, level))
                node = near
            if sizes[t, node - inner]:
                found.append((t, node - inner))
                seen += int(sizes[t, node - inner])
        return found


def search_share(forest: Forest, sample: np.ndarray, k: int, goal: float = RECALL_GOAL) -> float:
    """Smallest share whose search of the sample, less the query, reaches the goal."""
    p = forest.project(sample)
    at = forest.leaves(p)
    sizes = np.stack([np.bincount(at[:, t], minlength=1 << forest.depth) for t in range(forest.trees)])
    asked = np.linspace(0, len(sample) - 1, min(PROBE_QUERIES, len(sample))).astype(np.int64)
    true = sample[asked] @ sample.T
    true[np.arange(len(asked)), asked] = -np.inf
    best = np.argsort(-true, axis=1)[:, : min(k, len(sample) - 1)]
    for share in SHARES:
        hit = 0
        for q, near in zip(asked, best):
            seen = set(forest.search(p[q], sizes, max(int(share * len(sample)), forest.trees * (k + 1))))
            hit += sum(any((t, leaf) in seen for t, leaf in enumerate(at[n].tolist())) for n in near.tolist())
        if hit >= goal * best.size:
            return share
    return float(forest.trees)


LEAVES = V.struct("tree int, leaf int, rep long")
CELLS = V.struct("tree int, leaf int, block int, qblock int, rep long, query boolean")
HITS = V.struct("query long, rep long, score double")


def _cells(pdf: pd.DataFrame) -> np.ndarray:
    return unit(np.array(pdf["embedding"].tolist(), np.float64))


def neighbours(ws: Workspace, vectors: DataFrame, every: int = 50, k: int = 5, trees: int = TREES,
               leaf_rows: int | None = None, goal: float = RECALL_GOAL) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found of each vec_id divisible by ``every``."""
    spark = vectors.sparkSession
    rows = vectors.filter(usable() & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    empty = spark.createDataFrame([], V.struct("query_id long, rank int, vec_id long, score double"))
    sizes = {r["n"]: r["c"] for r in rows.groupBy(F.size("embedding").alias("n")).agg(F.count(F.lit(1)).alias("c"))
             .orderBy(F.desc("c"), "n").limit(1).collect()}
    if not sizes:
        return empty
    (dim, total), = sizes.items()
    # one vector an id: the smallest of those that its rows give
    rows = rows.filter(F.size("embedding") == dim).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    first = Window.partitionBy("embedding").orderBy("vec_id")
    reps = (rows.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= k + 1)
            .groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    reps = ws.stage(reps.withColumn("rep", F.col("ids")[0]), "distinct")
    asked = rows.filter(F.col("vec_id") % every == 0)
    asked = ws.stage(asked.join(reps.select("embedding", "rep"), "embedding").select(F.col("vec_id").alias("query_id"), "rep"), "asked")

    n = reps.count()
    leaf_rows = leaf_rows or max(LEAF_ROWS, LEAF_FACTOR * n ** LEAF_POWER)
    depth = max(0, min(MAX_DEPTH, int(np.log2(max(1, n / leaf_rows)))))
    sample = reps.select("embedding").sample(min(1.0, FIT_ROWS / n), seed=SEED).limit(FIT_ROWS).collect()
    sample = sample or reps.select("embedding").limit(1).collect()
    sample = unit(np.array([r[0] for r in sample], np.float64))
    forest = Forest(sample, trees, depth)
    shared = spark.sparkContext.broadcast(forest)

    def index(pdfs):
        for pdf in pdfs:
            if len(pdf):
                at = shared.value.leaves(shared.value.project(_cells(pdf)))
                yield pd.DataFrame({"tree": np.tile(np.arange(trees), len(pdf)), "leaf": at.ravel(),
                                    "rep": np.repeat(pdf["rep"].to_numpy(), trees)})

    leaves = ws.stage(reps.select("embedding", "rep").mapInPandas(index, LEAVES), "leaves")
    counts = np.zeros((trees, 1 << depth), np.int64)
    for r in leaves.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n")).collect():  # at most trees * 2 ** depth
        counts[r["tree"], r["leaf"]] = r["n"]
    # a tree's leaves are disjoint, so this many rows hold k + 1 distinct ones whatever the data
    enough = max(int(search_share(forest, sample, k, goal) * n), trees * (k + 1))
    sized = spark.sparkContext.broadcast(counts)

    def probe(pdfs):
        for pdf in pdfs:
            if len(pdf):
                p = shared.value.project(_cells(pdf))
                out = [(t, leaf, rep) for rep, x in zip(pdf["rep"].tolist(), p)
                       for t, leaf in shared.value.search(x, sized.value, enough)]
                yield pd.DataFrame(out, columns=["tree", "leaf", "rep"])

    wanted = reps.join(asked.select("rep").distinct(), "rep").select("embedding", "rep")
    probes = ws.stage(wanted.mapInPandas(probe, LEAVES), "probes")
    # blocks: a leaf's rows and its queries are both dealt over as many as they fill
    load = (leaves.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("rows"))
            .join(probes.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("asks")), ["tree", "leaf"]))
    load = ws.stage(load.select("tree", "leaf", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"),
                                F.ceil(F.col("asks") / BLOCK).cast("int").alias("qblocks")), "load")
    own = lambda c: F.pmod(F.xxhash64("rep"), F.col(c)).cast("int")
    each = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    data = (leaves.join(load, ["tree", "leaf"]).withColumn("block", own("blocks")).withColumn("qblock", each("qblocks"))
            .join(reps.select("rep", "embedding"), "rep"))
    asks = (probes.join(load, ["tree", "leaf"]).withColumn("qblock", own("qblocks")).withColumn("block", each("blocks"))
            .join(wanted, "rep"))

    def rerank(a: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(q):
            return pd.DataFrame({"query": [], "rep": [], "score": []})
        va, vq = np.array(a["embedding"].tolist(), np.float64), np.array(q["embedding"].tolist(), np.float64)
        ra, rq = a["rep"].to_numpy(), q["rep"].to_numpy()
        ua, uq = unit(va), unit(vq)
        na, nq = np.sqrt((va * va).sum(axis=1)), np.sqrt((vq * vq).sum(axis=1))
        top = min(k + 1, len(a))
        qi, ai = [], []
        for s in range(0, len(vq), 256):
            score = uq[s:s + 256] @ ua.T
            # every row that reaches the top-th score but for rounding, so that ties are whole
            least = np.partition(score, len(a) - top, axis=1)[:, len(a) - top] - 1e-12
            i, j = np.nonzero(score >= least[:, None])
            qi.append(i + s)
            ai.append(j)
        qi, ai = np.concatenate(qi), np.concatenate(ai)
        exact = np.einsum("ij,ij->i", vq[qi], va[ai]) / (nq[qi] * na[ai])
        return pd.DataFrame({"query": rq[qi], "rep": ra[ai], "score": exact})

    cell = ["tree", "leaf", "block", "qblock"]
    hits = data.select(*cell, "rep", "embedding").groupBy(*cell).cogroup(
        asks.select(*[F.col(c).alias(c) for c in (*cell, "rep", "embedding")]).groupBy(*cell)).applyInPandas(rerank, HITS)
    best = hits.groupBy("query", "rep").agg(F.max("score").alias("score"))
    spread = best.join(reps.select("rep", F.explode("ids").alias("vec_id")), "rep")
    by = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    # k + 1 of all rows hold k others for every query of this vector
    listed = ws.stage(spread.withColumn("at", F.row_number().over(by)).filter(F.col("at") <= k + 1)
                      .select("query", "vec_id", "score"), "nearest")
    final = asked.join(listed, (F.col("rep") == F.col("query")) & (F.col("query_id") != F.col("vec_id")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return final.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
