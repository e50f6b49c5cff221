import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators import mlp as NN
from tidewater.operators import perceptron as PE


def _table(spark, X, y, parts=4):
    return spark.createDataFrame([(float(a), float(b), bool(k)) for (a, b), k in zip(X, y)], "a double, b double, y boolean").repartition(parts)


@pytest.mark.parametrize("parts", [1, 5])
def test_mistakes_stay_below_the_bound(spark, parts):
    """Separable rows: mistakes, averaged over the tasks and summed over the epochs, are at most (radius / margin)²."""
    rs = np.random.RandomState(1)
    X = rs.uniform(-1, 1, (800, 2))
    side = X @ [0.8, -0.6] + 0.1
    X, side = X[np.abs(side) > 0.08], side[np.abs(side) > 0.08]
    model = PE.fit_perceptron(_table(spark, X, side > 0, parts), ["a", "b"], F.col("y"), epochs=60)
    Z = np.concatenate([(X - X.mean(0)) / X.std(0), np.ones((len(X), 1))], 1)
    plane = np.append(np.array([0.8, -0.6]) * X.std(0), 0.1 + X.mean(0) @ [0.8, -0.6])
    margin = (Z @ plane * np.sign(side)).min() / np.linalg.norm(plane)
    assert margin > 0 and sum(model.mistakes) <= (np.linalg.norm(Z, axis=1).max() / margin) ** 2
    assert model.mistakes[-1] == 0
    assert model.transform(_table(spark, X, side > 0)).filter(F.col("y") != (F.col("prediction") == 1)).count() == 0


def test_epoch_equals_one_row_at_a_time():
    rs = np.random.RandomState(2)
    X, y, start = rs.normal(size=(9_000, 3)), rs.choice([-1.0, 1.0], 9_000), rs.normal(size=3)
    w, total, mistakes = start.copy(), np.zeros(3), 0
    for x, k in zip(X, y):
        if k * (x @ w) <= 0:
            w, mistakes = w + k * x, mistakes + 1
        total += w
    got = PE._epoch(X, y, start)
    assert np.allclose(got[0], w) and np.allclose(got[1], total) and got[2] == mistakes


def test_gradient_of_the_network_by_differences():
    rs = np.random.RandomState(3)
    X, y, w = rs.normal(size=(7, 2)), rs.randint(0, 2, 7).astype(float), rs.normal(size=NN.shapes(2, 3))
    _, g = NN.loss_and_gradient(w, X, y, 3)
    numeric = [(NN.loss_and_gradient(w + e, X, y, 3)[0] - NN.loss_and_gradient(w - e, X, y, 3)[0]) / 2e-6 for e in 1e-6 * np.eye(len(w))]
    assert np.allclose(g, numeric, atol=1e-5)


def test_network_in_single_precision():
    """rows in floats are computed in floats, near the sums in doubles, and large logits stay finite."""
    rs = np.random.RandomState(5)
    X, y, w = rs.normal(size=(5_000, 4)), rs.randint(0, 2, 5_000).astype(float), rs.normal(size=NN.shapes(4, 7))
    loss, g = NN.loss_and_gradient(w, X, y, 7)
    loss32, g32 = NN.loss_and_gradient(w, X.astype(np.float32), y.astype(np.float32), 7)
    assert g32.dtype == np.float32 and abs(loss32 / loss - 1) < 1e-5 and np.allclose(g32, g, atol=1e-2 * np.abs(g).max())
    far, _ = NN.loss_and_gradient(1e4 * w, X.astype(np.float32), y.astype(np.float32), 7)
    assert np.isfinite(far)


def test_passes_read_blocks_of_rows(spark):
    """a pass hands blocks to Python, not rows; no row is lost, whatever the splits."""
    df = spark.range(0, 20_011, 1, 3).select(F.col("id").cast("double").alias("x0"), (F.col("id") % 2 == 0).alias("y"))
    got = NN.blocks(df, ["x0"], np.array([10.0]), np.array([2.0])).collect()
    X, y = (np.concatenate([np.frombuffer(r[c], np.float32) for r in got]) for c in "xy")
    assert len(got) < 20 and all(len(r["y"]) <= 4 * NN._BLOCK for r in got)
    assert sorted(zip(X, y)) == [((i - 10) / 2, float(i % 2 == 0)) for i in range(20_011)]


def test_loss_falls_and_a_curved_class_is_learned(spark):
    rs = np.random.RandomState(4)
    X = rs.uniform(-1, 1, (1_500, 2))
    y = (X**2).sum(1) < 0.5  # no plane separates it
    df = _table(spark, X, y)
    model = NN.fit_tanh_network(df, ["a", "b"], F.col("y"), steps=120)
    assert all(b < a for a, b in zip(model.losses, model.losses[1:])) and model.losses[-1] < 0.5 * model.losses[0]
    right = model.transform(df).filter(F.col("y") == (F.col("prediction") == 1)).count() / len(X)
    assert right > 0.9 > max(y.mean(), 1 - y.mean()) + 0.1
    # the column expression is the same network
    loss, _ = NN.loss_and_gradient(model.weights, (X - X.mean(0)) / X.std(0), y.astype(float), 7)
    p = model.transform(df).select(F.avg(-F.log(F.when(F.col("y"), F.col("probability")).otherwise(1 - F.col("probability"))))).first()[0]
    assert abs(p - loss / len(X)) < 1e-6 and abs(model.losses[-1] - loss / len(X)) < 1e-6


def test_empty_null_and_constant_rows(spark):
    none = spark.createDataFrame([], "a double, b double, y boolean")
    odd = spark.createDataFrame([(1.0, 2.0, True), (1.0, 2.0, True), (None, 1.0, False), (1.0, 2.0, None)], "a double, b double, y boolean")
    for df in (none, odd):
        for fit in (PE.fit_perceptron, NN.fit_tanh_network):
            model = fit(df, ["a", "b"], F.col("y"))
            got = model.transform(odd).collect()
            assert np.isfinite(model.weights).all() and [r["prediction"] is None for r in got] == [False, False, True, False]
