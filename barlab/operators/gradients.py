"""Linear model and net fitted by sums over the table.

A step is one aggregate: tasks add up what their rows contribute to a vector of
fixed size (gradient, curvature, loss), the vectors are summed in Spark, and the
driver moves the parameters. It holds parameters and one such vector, never rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlab.session import cut_lineage


def summed(df: DataFrame, part, size: int) -> np.ndarray:
    """Sum over all rows of ``part(pandas frame) -> vector`` of ``size`` numbers."""
    def run(batches):
        total = np.zeros(size)
        for pdf in batches:
            if len(pdf):
                total += part(pdf)
        yield pd.DataFrame({"i": np.arange(size), "v": total})

    out = np.zeros(size)
    for r in df.mapInPandas(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():  # size numbers
        out[r["i"]] = r["v"]
    return out


def matrix(pdf: pd.DataFrame, col: str = "x") -> np.ndarray:
    return np.stack(pdf[col].to_numpy()).astype(float)


def with_chance(df: DataFrame, p: Column) -> DataFrame:
    """``probability`` and ``prediction`` as Spark ML models give them, from class 1's chance."""
    df = df.withColumn("_p", p)
    return df.withColumns({"probability": array_to_vector(F.array(1 - F.col("_p"), F.col("_p"))),
                           "prediction": (F.col("_p") > 0.5).cast("double")}).drop("_p")


# ---------------------------------------------------------------- logistic regression
@dataclass
class LinearModel:
    coefficients: np.ndarray
    intercept: float
    steps: int

    def transform(self, df: DataFrame) -> DataFrame:
        x = vector_to_array("features")
        dot = F.aggregate(F.zip_with(x, F.array(*[F.lit(float(c)) for c in self.coefficients]), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
        return with_chance(df, 1 / (1 + F.exp(-(dot + F.lit(float(self.intercept))))))


def logistic(df: DataFrame, l2: float = 1.0, tol: float = 1e-9, max_steps: int = 100) -> LinearModel:
    """Newton's method on ``features``, ``label`` and ``weight``; the intercept isn't penalised.

    A step sums the gradient and the weighted Gram matrix, (k + 1)(k + 4) / 2 + 1 numbers, and halves itself
    while the loss doesn't fall. It ends when no part of the penalised gradient exceeds ``tol`` times the weight.
    """
    rows = cut_lineage(df.select(vector_to_array("features").alias("x"), F.col("label").cast("double").alias("y"),
                                 F.col("weight").cast("double").alias("w")))
    first = rows.first()
    if first is None:
        raise ValueError("no labelled rows")
    k = len(first["x"]) + 1
    upper = np.triu_indices(k)
    penalty = np.append(np.full(k - 1, l2), 0.0)

    def at(beta: np.ndarray):
        def part(pdf):
            x = np.hstack([matrix(pdf), np.ones((len(pdf), 1))])
            y, w = pdf["y"].to_numpy(), pdf["w"].to_numpy()
            f = x @ beta
            p = 1 / (1 + np.exp(-f))
            gram = (x * (w * p * (1 - p))[:, None]).T @ x
            return np.concatenate([[w @ (np.logaddexp(0, f) - y * f), w.sum()], x.T @ (w * (y - p)), gram[upper]])

        s = summed(rows, part, 2 + k + len(upper[0]))
        hess = np.zeros((k, k))
        hess[upper] = s[2 + k:]
        hess = hess + np.triu(hess, 1).T + np.diag(penalty)
        return s[0] + (penalty * beta * beta).sum() / 2, s[1], s[2: 2 + k] - penalty * beta, hess

    beta = np.zeros(k)
    loss, total, grad, hess = at(beta)
    for step in range(max_steps):
        if np.abs(grad).max() <= tol * max(total, 1.0):
            break
        move = np.linalg.lstsq(hess, grad, rcond=None)[0]
        found = at(beta + move)
        while found[0] > loss + 1e-12 * abs(loss) and np.abs(move).max() > 1e-12:
            move = move / 2
            found = at(beta + move)
        beta = beta + move
        loss, total, grad, hess = found
    else:
        step = max_steps
    return LinearModel(beta[:-1], float(beta[-1]), step)


# ---------------------------------------------------------------- net
@dataclass
class NetModel:
    """ReLU layers and one logistic output; ``layers`` holds (weights, biases)."""

    layers: list[tuple[np.ndarray, np.ndarray]]
    epochs: int
    held_out: list[float]

    def chance(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-forward(self.layers, x)[-1][:, 0]))

    def transform(self, df: DataFrame) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def chance(x: pd.Series) -> pd.Series:
            return pd.Series(shared.value.chance(np.stack(x.to_numpy()))) if len(x) else pd.Series([], dtype=float)

        return with_chance(df, chance(vector_to_array("features")))


def forward(layers, x: np.ndarray) -> list[np.ndarray]:
    """What enters each layer, and the output's log odds."""
    out = [x]
    for i, (w, b) in enumerate(layers):
        x = x @ w + b
        x = np.maximum(x, 0) if i + 1 < len(layers) else x
        out.append(x)
    return out


def gradients(layers, x: np.ndarray, y: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of the summed log loss."""
    seen = forward(layers, x)
    back = 1 / (1 + np.exp(-seen[-1])) - y[:, None]
    out = []
    for i in range(len(layers) - 1, -1, -1):
        out.append((seen[i].T @ back, back.sum(axis=0)))
        if i:
            back = (back @ layers[i][0].T) * (seen[i] > 0)
    return out[::-1]


def start_layers(sizes: list[int], seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    rng = np.random.default_rng(seed)
    return [(rng.uniform(-(b := np.sqrt(6 / (m + n))), b, (m, n)), rng.uniform(-b, b, n)) for m, n in zip(sizes, sizes[1:])]


@dataclass
class Adam:
    rate: float = 1e-3
    b1: float = 0.9
    b2: float = 0.999
    t: int = 0
    m: np.ndarray | float = 0.0
    v: np.ndarray | float = 0.0

    def step(self, g: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = self.b1 * self.m + (1 - self.b1) * g
        self.v = self.b2 * self.v + (1 - self.b2) * g * g
        return -self.rate * (self.m / (1 - self.b1 ** self.t)) / (np.sqrt(self.v / (1 - self.b2 ** self.t)) + 1e-8)


def flat(layers) -> np.ndarray:
    return np.concatenate([np.append(w.ravel(), b) for w, b in layers])


def unflat(v: np.ndarray, sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    out, at = [], 0
    for m, n in zip(sizes, sizes[1:]):
        out.append((v[at: at + m * n].reshape(m, n), v[at + m * n: at + m * n + n]))
        at += m * n + n
    return out


HELD_OUT = 10
BATCH_ROWS = 2048


def batches_of(epoch: Column | int, n_batches: int) -> Column:
    """Batch of each row in an epoch, dealt anew every time by a hash."""
    return F.pmod(F.xxhash64(F.lit(epoch), "row"), F.lit(n_batches))


def net_rows(df: DataFrame, seed: int = 42) -> DataFrame:
    """x, y, row and held, true for one row in ``HELD_OUT``; ``row`` is a hash of the row's content."""
    row = F.xxhash64(F.lit(seed), vector_to_array("features"), F.col("label").cast("double"))
    return df.select(vector_to_array("features").alias("x"), F.col("label").cast("double").alias("y"), row.alias("row")).withColumn(
        "held", F.pmod(F.xxhash64(F.lit(1), "row"), F.lit(HELD_OUT)) == 0)


def net(df: DataFrame, hidden=(32, 16), max_epochs: int = 500, batch_rows: int = BATCH_ROWS, rate: float = 5e-3, l2: float = 1e-4,
        patience: int = 10, tol: float = 1e-4, seed: int = 42) -> NetModel:
    """Mini-batch steps (Adam) until the held-out accuracy hasn't risen by ``tol`` in ``patience`` epochs; the best parameters stay.

    A step is one aggregate: the gradient of its batch, and in an epoch's first step the held-out rows judged by
    the parameters that the last epoch left.
    """
    rows = cut_lineage(net_rows(df, seed))
    n = rows.agg(F.count_if("held").alias("held"), F.count_if(~F.col("held")).alias("fit"), F.first(F.size("x")).alias("k")).first()
    if not n["fit"]:
        raise ValueError("no labelled rows")
    sizes = [n["k"], *hidden, 1]
    value = flat(start_layers(sizes, seed))
    n_batches = max(1, -(-n["fit"] // batch_rows))
    adam, best, best_value, since, seen = Adam(rate), -1.0, value, 0, []
    for epoch in range(max_epochs + 1):
        for b in range(n_batches):
            layers = unflat(value, sizes)
            judge = b == 0

            def part(pdf):
                held = pdf["held"].to_numpy()
                x, y = matrix(pdf), pdf["y"].to_numpy()
                hits = ((forward(layers, x[held])[-1][:, 0] > 0) == (y[held] == 1)).sum() if held.any() else 0
                g = flat(gradients(layers, x[~held], y[~held])) if (~held).any() else np.zeros(len(value))
                return np.concatenate([g, [(~held).sum(), hits]])

            mine = (~F.col("held")) & (batches_of(epoch, n_batches) == b)
            s = summed(rows.filter(mine | F.col("held") if judge else mine), part, len(value) + 2)
            if judge and epoch:
                seen.append(s[-1] / n["held"] if n["held"] else 0.0)
                if seen[-1] > best + tol:
                    best, best_value, since = seen[-1], value, 0
                else:
                    since += 1
                if since >= patience or epoch == max_epochs:
                    return NetModel(unflat(best_value, sizes), epoch, seen)
            if s[-2]:
                value = value + adam.step(s[:-2] / s[-2] + l2 * value / s[-2])
    raise AssertionError("unreachable")
