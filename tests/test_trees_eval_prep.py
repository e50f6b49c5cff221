import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewater.operators import evaluate as EV
from tidewater.operators import prep as PR
from tidewater.operators import trees as TR


def _py_best(xs, ys, score):
    """Straight transcription of the split-search contract for checking."""
    order = sorted(range(len(xs)), key=lambda i: xs[i])
    X = [xs[i] for i in order]
    Y = [ys[i] for i in order]
    best, thr = -math.inf, None
    for i in range(len(X) - 1):
        if X[i] == X[i + 1]:
            continue
        lo, hi = Counter(Y[:i + 1]), Counter(Y[i + 1:])
        nl, nh = i + 1, len(X) - i - 1
        if score == "gini":
            g = lambda c, n: 1 - sum((v / n) ** 2 for v in c.values())
            s = -(nl * g(lo, nl) + nh * g(hi, nh)) / (nl + nh)
        else:
            s = max(lo.values()) + max(hi.values())
        s = round(s, 9)
        if s > best:
            best, thr = s, (X[i] + X[i + 1]) / 2
    return thr, best


def test_best_split_matches_python(spark):
    rs = np.random.RandomState(0)
    xs = rs.randint(0, 20, size=300).astype(float).tolist()
    ys = [("a" if x < 7 else "b") if rs.rand() < 0.8 else "c" for x in xs]
    df = spark.createDataFrame(list(zip(xs, ys)), "f double, label string")
    for score in ("gini", "maj_sum"):
        got = TR.best_split(df, ["f"], "label", score, ["a", "b", "c"]).first()
        thr, best = _py_best(xs, ys, score)
        assert got.threshold == thr and abs(got.score - best) < 1e-9


def test_regression_step_function(spark):
    # the reference's own check: a step at x = 1 is found by a depth-1 split
    xs = np.linspace(0, 2, 101)
    df = spark.createDataFrame([(float(x), float(x > 1.0)) for x in xs], "x double, y double")
    got = TR.best_split(df, ["x"], "y", "variance").first()
    assert abs(got.threshold - 1.0) < 0.03


def test_grow_and_apply_tree(spark):
    data = [(float(i), float(i % 3), "lo" if i < 50 else "hi") for i in range(100)]
    df = spark.createDataFrame(data, "a double, b double, label string")
    nodes = TR.grow_tree(df, ["a", "b"], "label", ["hi", "lo"], max_depth=2)
    root = [r for r in nodes.collect() if r.node == 1][0]
    assert root.feature == "a" and root.threshold == 49.5
    pred = TR.apply_tree(df, nodes)
    assert EV.accuracy(pred.withColumnRenamed("label", "label")).first().accuracy == 1.0
    assert nodes.filter("node = 1").count() == 1


def test_report_consistent_with_confusion(spark):
    pred = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("b", "b"), ("c", "a")],
                                 "label string, prediction string")
    cm = {(r.label, r.prediction): r.n for r in EV.confusion_matrix(pred).collect()}
    rep = {r.cls: r for r in EV.classification_report(pred).collect()}
    for c in "abc":
        tp = cm.get((c, c), 0)
        npred = sum(v for (l, p), v in cm.items() if p == c)
        sup = sum(v for (l, p), v in cm.items() if l == c)
        assert rep[c].support == sup
        assert abs(rep[c].precision - round(tp / npred if npred else 0.0, 4)) < 1e-12
    assert abs(rep["accuracy"].f1 - 0.6) < 1e-12
    assert EV.accuracy(pred).first().accuracy == 0.6


def test_impurity_loss_baselines(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "label string")
    imp = EV.class_impurity(df).first()
    assert abs(imp.entropy - 1.5) < 1e-9 and abs(imp.gini - 0.625) < 1e-9 and imp.majority == 2
    loss = EV.mean_loss(spark.createDataFrame([(1.0, 0.0)], "y double, logit double")).first().mean_loss
    assert abs(loss - round(math.log(2), 6)) < 1e-12
    pred = EV.baseline_majority(df, df)
    assert {r.prediction for r in pred.collect()} == {"a"}


def test_splits_samples_maps(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "k")
    s = PR.split_by_hash(df, "k", [0.8, 0.2], 1, ["train", "test"])
    c = dict(rows(s.groupBy("split").count()))
    assert 0.75 < c["train"] / 5000 < 0.85
    assert rows(PR.split_by_hash(df, "k", [0.8, 0.2], 1, ["train", "test"])) == rows(s)  # repeatable
    n = PR.sample_subset(df, "k", 0.2, 2).count()
    assert 800 < n < 1200
    codes = spark.createDataFrame([(1,), (3,), (4,)], "c int")
    got = [r.m for r in codes.select(PR.map_codes(F.col("c"), ["normal", "suspect", "pathologic"]).alias("m"))
           .collect()]
    assert got == ["normal", "pathologic", None]
    z = PR.standardize(spark.createDataFrame([(1.0,), (3.0,)], "x double"), ["x"])
    assert sorted(r.x for r in z.collect()) == [-1.0, 1.0]
    assert PR.drop_incomplete(spark.createDataFrame([(1, None), (2, "x")], "a int, b string")).count() == 1


def test_block_prefix_sums_equal_single_window(spark):
    rs = np.random.RandomState(4)
    data = [(float(rs.normal()), float(rs.normal()), "a" if rs.rand() < 0.5 else "b") for _ in range(2000)]
    df = spark.createDataFrame(data, "u double, v double, label string")
    for score in ("gini", "info_gain"):
        one = rows(TR.split_candidates(df, ["u", "v"], "label", score, ["a", "b"], blocks=1))
        many = rows(TR.split_candidates(df, ["u", "v"], "label", score, ["a", "b"], blocks=7))
        assert one == many
    reg = spark.createDataFrame([(x, x * 2 + y) for x, y, _ in data], "u double, y double")
    assert rows(TR.split_candidates(reg, ["u"], "y", "variance", blocks=1)) == \
        rows(TR.split_candidates(reg, ["u"], "y", "variance", blocks=5))


def test_sample_exact_matches_sort_limit(spark):
    df = spark.range(0, 3001).withColumnRenamed("id", "k")
    got = sorted(r.k for r in PR.sample_exact(df, "k", 0.2, 5).collect())
    keyed = sorted((r.h, r.k) for r in df.select("k", PR.hash_key(F.col("k"), 5).alias("h")).collect())
    assert got == sorted(k for _, k in keyed[:600])


def test_regression_tree_growth(spark):
    xs = np.linspace(0, 2, 101)
    df = spark.createDataFrame([(float(x), float(x > 1.0)) for x in xs], "x double, y double")
    nodes = {r.node: r for r in TR.grow_tree(df, ["x"], "y", None, 2, "variance", var_threshold=1e-9).collect()}
    assert abs(nodes[1].threshold - 1.0) < 0.03
    assert nodes[2].feature is None and nodes[3].feature is None  # pure children stop (variance 0)
    assert nodes[2].prediction == 0.0 and nodes[3].prediction == 1.0


def test_equal_leaves_merge_up_the_tree(spark):
    # the label depends on a alone: whatever is split below a's threshold merges again
    df = spark.createDataFrame([(float(a), float(b), "hi" if a >= 4 else "lo") for a in range(8) for b in range(8)] + [(0.0, 0.0, "hi")], "a double, b double, label string")
    nodes = {r.node: r for r in TR.grow_tree(df, ["a", "b"], "label", ["hi", "lo"], max_depth=3).collect()}
    assert all(r.feature or n == 1 or nodes[n // 2].feature for n, r in nodes.items())  # no node below a leaf
    for n, r in nodes.items():
        if r.feature:
            low, high = nodes[2 * n], nodes[2 * n + 1]
            assert low.feature or high.feature or low.prediction != high.prediction
    t = TR.grow_tree(df, ["a", "b"], "label", ["hi", "lo"], max_depth=3)
    one = rows(TR.apply_tree(df, t), "a", "b", "prediction")
    assert one == rows(TR.apply_tree_by_levels(df, t, ["a", "b"], 3), "a", "b", "prediction")


def _plain_tree(data, features, classes, max_depth):
    """T5 by recursion over rows in plain Python: node -> (feature, threshold, prediction, n)."""
    out = {}

    def score(lo, hi):
        def term(side):
            n = len(side)
            return n * (1 - sum((side.count(c) / n) ** 2 for c in classes))
        return round(-(term(lo) + term(hi)) / (len(lo) + len(hi)), 9)

    def grow(node, items, depth):
        labels = [r[-1] for r in items]
        counts = {c: labels.count(c) for c in classes}
        prediction = min(classes, key=lambda c: (-counts[c], c))
        best = None
        if depth < max_depth and sum(v > 0 for v in counts.values()) > 1:
            for k, f in enumerate(features):
                xs = sorted({r[k] for r in items if r[k] is not None})
                for a, b in zip(xs, xs[1:]):
                    lo = [r[-1] for r in items if r[k] is not None and r[k] <= a]
                    hi = [r[-1] for r in items if r[k] is not None and r[k] > a]
                    found = (-score(lo, hi), k, (a + b) / 2)
                    best = min(best, found) if best else found
        out[node] = [None, None, prediction, len(items)]
        if best:
            _, k, t = best
            out[node][:2] = features[k], t
            kids = [r for r in items if r[k] is not None and r[k] <= t], [r for r in items if r[k] is None or r[k] > t]
            for child, part in zip((2 * node, 2 * node + 1), kids):
                grow(child, part, depth + 1)
            low, high = out[2 * node], out[2 * node + 1]
            if low[0] is None and high[0] is None and low[2] == high[2]:
                out[node] = [None, None, low[2], len(items)]
                del out[2 * node], out[2 * node + 1]

    grow(1, data, 0)
    return {n: tuple(v) for n, v in out.items()}


def test_deep_tree_by_subtraction(spark):
    """Histograms of larger siblings by subtraction, down to depth 20, with nulls, ties and repeated rows."""
    data = [(float(i), float(i % 3), "ab"[(i * i // 7) % 2]) for i in range(46)] + [(None, 1.0, "a"), (None, 2.0, "b"), (3.0, None, "b"), (3.0, None, "b"), (5.0, 2.0, "a")]
    df = spark.createDataFrame(data + [(1.0, 1.0, None)], "x double, y double, label string")
    want = _plain_tree(data, ["x", "y"], ["a", "b"], 20)
    assert max(n.bit_length() for n in want) > 9
    nodes = TR.grow_tree(df, ["x", "y"], "label", ["a", "b"], max_depth=20)
    assert {r.node: (r.feature, r.threshold, r.prediction, r.n) for r in nodes.collect()} == want

    def leaf(r):
        n = 1
        while want[n][0] is not None:
            v = r[["x", "y"].index(want[n][0])]
            n = 2 * n if v is not None and v <= want[n][1] else 2 * n + 1
        return want[n][2]

    got = sorted(TR.apply_tree_by_levels(df.filter("label IS NOT NULL"), nodes, ["x", "y"], 20).collect(), key=str)
    assert sorted((tuple(r)[:3] + (r.prediction,) for r in got), key=str) == sorted(((*r, leaf(r)) for r in data), key=str)


def test_a_level_counts_each_row_once(spark):
    """Only the smaller child's rows are aggregated; the sibling comes from the parent's histogram."""
    df = spark.createDataFrame([(i, float(i), "a" if i < 30 else "b") for i in range(40)], "id long, x double, label string")
    data = df.withColumn("node", F.lit(1).cast("bigint"))
    hist = TR._histogram(data, ["x"], "label", "gini", ["a", "b"], ["node"], whole=True)
    inner = spark.createDataFrame([(1, 3)], "node long, _small long")
    routed = data.withColumn("node", F.when(F.col("x") <= 29.5, 2).otherwise(3).cast("long")).withColumn("_small", F.lit(3).cast("long"))
    below = TR._children(hist, routed, inner, ["x"], "label", "gini", ["a", "b"])
    whole = {r.node: (r.c0, r.c1) for r in below.filter("fidx = -1").collect()}
    assert whole == {2: (30, 0), 3: (0, 10)} and below.filter("fidx = 0").count() == 40
    assert rows(below, "node", "fidx", "x", "c0", "c1") == rows(TR._histogram(routed, ["x"], "label", "gini", ["a", "b"], ["node"], whole=True), "node", "fidx", "x", "c0", "c1")
