import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators import forest as FO


@pytest.fixture(scope="module")
def table(spark):
    rs = np.random.RandomState(5)
    x, y, z = rs.uniform(0, 10, 3000), rs.randint(0, 6, 3000), rs.normal(size=3000)
    label = np.where(x + y > 9, "high", np.where(x * y < 8, "low", "mid"))
    noisy = np.where(rs.uniform(size=3000) < 0.1, "mid", label)
    df = spark.createDataFrame([(float(a), int(b), float(c), str(k)) for a, b, c, k in zip(x, y, z, noisy)], "x double, y int, z double, label string").repartition(4)
    return df.filter("z < 0.8"), df.filter("z >= 0.8")


FEATURES = ["x", "y", "z"]


def _cells(df, edges):
    return FO.cells(df, FEATURES, "label", ["high", "low", "mid"], edges)


def _rows(nodes):
    return sorted((r["tree"], r["node"], r["feature"], r["bin"], tuple(r["shares"])) for r in nodes.collect())


def test_a_tree_cut_at_a_depth_is_the_tree_of_that_depth(table):
    cells = _cells(table[0], FO.bin_edges(table[0], FEATURES, 16))
    deep = _rows(FO.grow(cells, 6, 9))
    for depth, trees in ((0, 6), (1, 6), (4, 6), (9, 3)):
        alone = _rows(FO.grow(cells, trees, depth))
        cut = [(t, n, f if n.bit_length() <= depth else None, b if n.bit_length() <= depth else None, s) for t, n, f, b, s in deep if n.bit_length() <= depth + 1 and t < trees]
        assert alone == cut


def test_sweep_equals_single_fits(table):
    train, test = table
    found = {(r["max_depth"], r["num_trees"]): (r["train_accuracy"], r["test_accuracy"]) for r in FO.sweep(train, test, FEATURES, "label", (1, 3, 6), (1, 4, 9), 16).collect()}
    assert len(found) == 9
    edges = FO.bin_edges(train, FEATURES, 16)
    for (depth, trees), rates in found.items():
        # row by row, in plain Python
        nodes = {(t, n): (f, b, s) for t, n, f, b, s in _rows(FO.grow(_cells(train, edges), 9, depth))}
        for df, rate in zip((train, test), rates):
            right = total = 0
            for r in df.collect():
                bins = [sum(e < float(r[f]) for e in edges[i]) for i, f in enumerate(FEATURES)]
                votes = np.zeros(3)
                for t in range(trees):
                    n = 1
                    while nodes[t, n][0] is not None:
                        n = 2 * n + (bins[nodes[t, n][0]] > nodes[t, n][1])
                    votes += nodes[t, n][2]
                right += ["high", "low", "mid"][int(votes.argmax())] == r["label"]
                total += 1
            assert abs(right / total - rate) < 1e-6
    assert found[6, 9][1] > found[1, 1][1] and found[6, 9][0] > 0.85


def test_single_tree_equals_brute_force_split(table):
    """The root of a tree over all rows has the least Gini impurity of all cuts."""
    train = table[0]
    edges = FO.bin_edges(train, FEATURES, 16)
    root = [r for r in FO.grow(_cells(train, edges), 1, 1).collect() if r["node"] == 1][0]
    rows = [([sum(e < float(r[f]) for e in edges[i]) for i, f in enumerate(FEATURES)], r["label"]) for r in train.collect()]

    def impurity(labels):
        n = len(labels)
        return n - sum(labels.count(c) ** 2 for c in set(labels)) / n if n else 0.0

    best = min((impurity([k for b, k in rows if b[f] <= c]) + impurity([k for b, k in rows if b[f] > c]), f, c) for f in range(3) for c in range(len(edges[f])))
    assert (root["feature"], root["bin"]) == best[1:]


def test_same_however_the_rows_are_split(table):
    edges = FO.bin_edges(table[0], FEATURES, 8)
    one, many = (_rows(FO.grow(_cells(df, edges), 3, 5)) for df in (table[0].coalesce(1), table[0].repartition(13)))
    assert one == many


def test_edges_and_bounds(spark, table):
    assert FO.bin_edges(spark.createDataFrame([(1.0,), (1.0,), (None,)], "x double"), ["x"]) == [[]]
    few = spark.createDataFrame([(1.0, 2, 0.0, "a"), (1.0, 2, 0.0, "b"), (None, 1, 1.0, "a"), (5.0, 2, 0.0, None)], "x double, y int, z double, label string")
    got = FO.sweep(few, few, FEATURES, "label", (1, 2), (1, 2)).collect()
    assert len(got) == 4 and all(r["train_accuracy"] == 0.5 for r in got)
    with pytest.raises(ValueError, match="cells"):
        FO.cells(few, FEATURES * 4, "label", ["a"], [list(range(31))] * 12)
    assert FO.sweep(few.limit(0), few, FEATURES, "label", (1,), (1,)).count() == 0
    assert FO.cells(table[0], FEATURES, "label", ["high"], [[5.0], [], []]).agg(F.sum("c0")).first()[0] == table[0].filter("label = 'high'").count()
