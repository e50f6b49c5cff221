import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators import folds as FD
from tidewater.operators import forest as FO


@pytest.fixture(scope="module")
def table(spark):
    rs = np.random.RandomState(2)
    a, b = rs.randint(0, 20, 900).astype(float), rs.randint(0, 9, 900).astype(float)
    y = 3 + 0.5 * a - b + rs.normal(size=900)
    label = np.where(a + 2 * b + rs.normal(size=900) > 16, "up", np.where(a > 8, "side", "down"))
    rows = [(float(p), float(q), float(r), str(k), int(f)) for p, q, r, k, f in zip(a, b, y, label, rs.randint(0, 4, 900))]
    return rows, spark.createDataFrame(rows, "a double, b double, y double, label string, fold int").repartition(3)


def test_ridge_equals_fits_without_the_fold(table):
    rows, df = table
    found = {(r["penalty"], r["fold"]): (r["n"], r["mse"]) for r in FD.cross_validate_ridge(df, ["a", "b"], "y", [0.0, 25.0]).collect()}
    X, y, fold = np.array([[1, r[0], r[1]] for r in rows]), np.array([r[2] for r in rows]), np.array([r[4] for r in rows])
    for penalty in (0.0, 25.0):
        for f in range(4):
            train, test = fold != f, fold == f
            w = np.linalg.solve(X[train].T @ X[train] + penalty * np.diag([0, 1, 1]), X[train].T @ y[train])
            n, mse = found.pop((penalty, f))
            assert n == test.sum() and np.isclose(mse, ((y[test] - X[test] @ w) ** 2).mean())
    assert not found


def test_trees_equal_fits_without_the_fold(table):
    rows, df = table
    found = {(r["max_depth"], r["fold"]): (r["correct"], r["n"]) for r in FD.cross_validate_trees(df, ["a", "b"], "label", [1, 2, 5]).collect()}
    edges = FO.bin_edges(df, ["a", "b"])
    classes = ["down", "side", "up"]
    for f in range(4):
        nodes = {r["node"]: r for r in FO.grow(FO.cells(df.filter(F.col("fold") != f), ["a", "b"], "label", classes, edges), 1, 5).collect()}
        for depth in (1, 2, 5):
            right = 0
            for r in rows:
                if r[4] == f:
                    n = 1
                    while nodes[n]["feature"] is not None and n.bit_length() <= depth:
                        k = nodes[n]["feature"]
                        n = 2 * n + (sum(e < r[k] for e in edges[k]) > nodes[n]["bin"])
                    right += classes[int(np.argmax(nodes[n]["shares"]))] == r[3]
            assert found.pop((depth, f)) == (right, sum(r[4] == f for r in rows))
    assert not found


def test_few_values_are_their_own_bins(table):
    assert FO.bin_edges(table[1], ["a", "b"], 20) == [[float(i) for i in range(19)], [float(i) for i in range(8)]]
    assert len(FO.bin_edges(table[1], ["y"], 16)[0]) == 15


def test_edges(spark, table):
    df = table[1]
    none, one = df.limit(0), df.filter("fold = 0")
    for rows in (none, one):  # nothing to fit on
        assert FD.cross_validate_ridge(rows, ["a"], "y", [1.0]).count() == 0
        assert FD.cross_validate_trees(rows, ["a"], "label", [1]).count() == 0
    nulls = spark.createDataFrame([(None, 1.0, "x", 0), (2.0, None, "x", 0), (2.0, 1.0, None, 1), (2.0, 1.0, "x", None), (1.0, 5.0, "x", 0), (1.0, 5.0, "x", 1)],
                                  "a double, y double, label string, fold int")
    got = [tuple(r) for r in FD.cross_validate_ridge(nulls, ["a"], "y", [1.0]).collect()]
    assert [(p, f, n) for p, f, n, _ in got] == [(1.0, 0, 1), (1.0, 1, 2)]
    assert sorted(tuple(r) for r in FD.cross_validate_trees(nulls, ["a"], "label", [1]).collect()) == [(1, 0, 2, 2), (1, 1, 1, 1)]
