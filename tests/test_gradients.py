"""Newton and mini-batch steps over Spark against numpy on the same rows."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from barlab.operators import gradients as R


def frame(spark, n=300, k=3, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, k))
    y = (x[:, 0] - 0.5 * x[:, 1] + rng.normal(0, 1, n) > 0).astype(int)
    cols = [f"c{i}" for i in range(k)]
    df = spark.createDataFrame([(*map(float, r), int(t), float(1 + t)) for r, t in zip(x, y)], [*cols, "label", "weight"])
    return VectorAssembler(inputCols=cols, outputCol="features").transform(df), x, y, 1.0 + y


def test_logistic_gradient_is_zero(spark):
    df, x, y, w = frame(spark)
    m = R.logistic(df.repartition(5), l2=1.0)
    p = 1 / (1 + np.exp(-(x @ m.coefficients + m.intercept)))
    assert np.abs(x.T @ (w * (y - p)) - m.coefficients).max() < 1e-5 and abs((w * (y - p)).sum()) < 1e-5
    assert m.steps < 12
    got = np.array([r.p for r in m.transform(df).select(F.col("c0"), R.vector_to_array("probability")[1].alias("p")).collect()])
    np.testing.assert_allclose(np.sort(got), np.sort(p), atol=1e-12)


def test_logistic_on_separable_and_equal_columns(spark):
    rows = [(float(i), float(i), int(i > 9), 1.0) for i in range(20)]
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(spark.createDataFrame(rows, ["a", "b", "label", "weight"]))
    m = R.logistic(df)
    assert m.coefficients[0] == pytest.approx(m.coefficients[1]) and np.isfinite(m.intercept)
    with pytest.raises(ValueError):
        R.logistic(df.limit(0))


def test_net_equals_numpy_on_the_same_batches(spark):
    df, *_ = frame(spark, 240, 4)
    m = R.net(df.repartition(3), hidden=(6, 3), max_epochs=3, batch_rows=100, patience=99)
    rows = R.net_rows(df)
    held = rows.filter("held").count()
    fit = rows.filter("not held").count()
    n_batches = -(-fit // 100)
    layers = R.start_layers([4, 6, 3, 1], 42)
    value, adam, seen, values = R.flat(layers), R.Adam(5e-3), [], []
    test = rows.filter("held").toPandas()
    for epoch in range(3):
        for b in range(n_batches):
            pdf = rows.filter(~F.col("held")).filter(R.batches_of(epoch, n_batches) == b).toPandas()
            g = R.flat(R.gradients(R.unflat(value, [4, 6, 3, 1]), np.stack(pdf["x"]), pdf["y"].to_numpy()))
            value = value + adam.step(g / len(pdf) + 1e-4 * value / len(pdf))
        out = R.forward(R.unflat(value, [4, 6, 3, 1]), np.stack(test["x"]))[-1][:, 0]
        seen.append(((out > 0) == (test["y"] == 1)).sum() / held)
        values.append(value)
    assert m.epochs == 3 and m.held_out == pytest.approx(seen)
    np.testing.assert_allclose(R.flat(m.layers), values[int(np.argmax(np.round(seen, 9)))], atol=1e-9)


def test_gradients_by_differences():
    rng = np.random.default_rng(0)
    sizes = [3, 4, 2, 1]
    x, y = rng.normal(0, 1, (9, 3)), rng.integers(0, 2, 9).astype(float)
    value = R.flat(R.start_layers(sizes, 1))

    def loss(v):
        f = R.forward(R.unflat(v, sizes), x)[-1][:, 0]
        return (np.logaddexp(0, f) - y * f).sum()

    g = R.flat(R.gradients(R.unflat(value, sizes), x, y))
    for i in range(len(value)):
        e = np.zeros(len(value))
        e[i] = 1e-6
        assert g[i] == pytest.approx((loss(value + e) - loss(value - e)) / 2e-6, abs=1e-5)


def test_net_stops_early(spark):
    df, x, y, _ = frame(spark, 400, 3)
    m = R.net(df, max_epochs=500)
    assert m.epochs < 500
    assert max(m.held_out) > 0.6
