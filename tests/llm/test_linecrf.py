import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import linecrf
from tidewater.llm.queries import QUERIES
from tests.conftest import SF001

SF = SF001.replace("0.001", "0.01")


def by_all_labellings(emissions, pairs):
    """Marginals and expected neighbours by listing all labellings."""
    n, total = len(emissions), 0.0
    sums, counts = np.zeros(n), np.zeros((2, 2))
    for y in itertools.product((0, 1), repeat=n):
        w = math.exp(sum(e for e, k in zip(emissions, y) if k) + sum(pairs[i][j] for i, j in zip(y, y[1:])))
        total += w
        sums += w * np.array(y)
        for i, j in zip(y, y[1:]):
            counts[i, j] += w
    return sums / total, counts / total


@pytest.mark.parametrize("n", [1, 2, 7])
def test_forward_backward_equals_all_labellings(n):
    rng = np.random.default_rng(n)
    e, pairs = rng.normal(0, 3, n), rng.normal(0, 2, (2, 2))
    want, counts = by_all_labellings(e, pairs)
    assert np.allclose(linecrf.marginals(e.tolist(), pairs), want)
    others = rng.normal(0, 1, 3)  # a second chain beside it
    chains = linecrf._Chains(np.zeros((n + 3, 1)), np.repeat([0, 1], [n, 3]))
    p, both = chains.expect(np.concatenate([e, others]), pairs)
    more, more_counts = by_all_labellings(others, pairs)
    assert np.allclose(p, np.concatenate([want, more])) and np.allclose(both, counts + more_counts)


def test_marginals_of_extreme_weights_are_finite():
    p = linecrf.marginals([900.0, -900.0, 0.0] * 400, np.array([[5.0, -50.0], [-50.0, 5.0]]))
    assert all(0 <= x <= 1 for x in p)


def test_gradient_is_that_of_the_log_likelihood():
    rng = np.random.default_rng(1)
    x, owner, labels = rng.normal(0, 1, (9, 2)), np.repeat([0, 1], [5, 4]), rng.integers(0, 2, 9)
    chains = linecrf._Chains(x, owner)

    def likelihood(w):
        e, pairs = chains.x @ w[:-4], w[-4:].reshape(2, 2)
        total = 0.0
        for d in (0, 1):
            mine, y = e[owner == d], labels[owner == d]
            score = lambda z: sum(a * k for a, k in zip(mine, z)) + sum(pairs[i][j] for i, j in zip(z, z[1:]))
            total += score(y) - math.log(sum(math.exp(score(z)) for z in itertools.product((0, 1), repeat=len(y))))
        return total

    w = rng.normal(0, 0.5, chains.x.shape[1] + 4)
    p, counts = chains.expect(chains.x @ w[:-4], w[-4:].reshape(2, 2))
    seen = np.zeros((2, 2))
    for i in range(8):
        if owner[i] == owner[i + 1]:
            seen[labels[i], labels[i + 1]] += 1
    gradient = np.concatenate([chains.x.T @ (labels - p), (seen - counts).ravel()])
    numeric = [(likelihood(w + step) - likelihood(w - step)) / 2e-5 for step in 1e-5 * np.eye(len(w))]
    assert np.allclose(gradient, numeric, atol=1e-4)


def test_features_by_hand():
    x, points, owner = linecrf.line_features(["".encode(), "\n \t\n".encode(), "The É| dog dog!\nThe É| dog dog!\n\nabc".encode(), b"x"])
    assert owner.tolist() == [2, 2, 2, 3] and points.tolist() == [15, 15, 3, 1]
    first = x[0]
    assert first[4] == 0 and x[1][4] == 1  # the second line repeats the first
    assert first[5] == 1 and x[2][5] == 0  # ends with a stop
    assert np.isclose(first[7], 2 / 11) and np.isclose(first[9], 1 / 4) and np.isclose(first[10], 1 / 4) and np.isclose(first[13], 2 / 4)
    assert x.shape[1] == linecrf.N_FEATURES and linecrf.line_features([])[0].shape == (0, linecrf.N_FEATURES)


def test_held_out_quality(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    rows = QUERIES["op13_line_crf_quality"](spark, SF).join(labels, "doc_id").filter("held_out").collect()
    right = sum((r["score"] >= 0.7) == bool(r["quality"]) for r in rows) / len(rows)
    base = max(np.mean([r["quality"] for r in rows]), 1 - np.mean([r["quality"] for r in rows]))
    good, bad = ([r["score"] for r in rows if r["quality"] == k] for k in (1, 0))
    above = np.mean([(np.array(good) > b).mean() + 0.5 * (np.array(good) == b).mean() for b in bad])
    assert right >= 0.97 > base and above >= 0.99
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in rows)


def test_edges(spark, edge, none):
    labels = spark.createDataFrame([(903, 1), (904, 0), (904, 1), (905, 0), (906, 1), (None, 1), (907, None), (912, 0), (7_777, 1)], "doc_id long, label int")
    model = linecrf.train(edge, labels)
    found = linecrf.score(edge, model)
    assert found.count() == edge.count() and found.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    empty = {r["score"] for r in found.filter("doc_id IN (900, 901, 902)").collect()}
    assert empty == {model.empty} and model.empty == 3 / 5  # of 903, 904 (a tie: good), 905, 906 (too many lines or not), 912
    assert linecrf.lines(edge, model).filter("good < 0 OR good > 1").count() == 0
    nothing = linecrf.train(none, labels)
    assert {r["score"] for r in linecrf.score(edge, nothing).collect()} <= {nothing.empty, nothing.document(0.5)} and nothing.empty == 0.5
    assert linecrf.score(none, model).count() == 0 and linecrf.train(edge, labels.filter("label = 1")).empty == 1.0


def test_score_is_the_weighted_mean_of_lines(spark, docs):
    labels = spark.read.parquet(f"{SF001}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    model = linecrf.train(docs, labels)
    means = linecrf.lines(docs, model).groupBy("doc_id").agg((F.sum(F.col("good") * F.col("n_points")) / F.sum("n_points")).alias("mean"))
    for r in linecrf.score(docs, model).join(means, "doc_id").collect():
        assert math.isclose(r["score"], model.document(r["mean"]), abs_tol=1e-9)


def test_long_chain_document_counts_whole(spark):
    """Lines behind the first ones count."""
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    model = linecrf.train(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    good, bad = "The rain had stopped and they went home.\n" * 20, "".join(f"BUY{i}$$$ NOW{i}### FREE{i}&&& WIN{i}***\n" for i in range(400))
    scores = {r["doc_id"]: r["score"] for r in linecrf.score(spark.createDataFrame([(1, bad), (2, good + bad)], "doc_id long, text string"), model).collect()}
    assert scores[1] < 0.3 and scores[2] < 0.5
