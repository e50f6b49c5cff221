import numpy as np
import pytest
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from tidewater.operators import ml as ML
from tidewater.operators import textgrid as TG


@pytest.fixture(scope="module")
def texts(spark):
    """Two classes that share words and have some of their own; one text in eight has the other label."""
    rs = np.random.RandomState(4)
    rows = []
    for i in range(240):
        kind = int(rs.randint(2))
        words = [f"shared{rs.randint(30)}" if rs.uniform() < 0.8 else f"{'ab'[kind]}word{rs.randint(12)}" for _ in range(25)]
        rows.append((i, " ".join(words), "xy"[kind if rs.uniform() > 0.12 else 1 - kind], int(rs.randint(3))))
    return rows, spark.createDataFrame(rows, "doc_id long, text string, label string, fold int").repartition(4)


def _grid(texts, vocab=(20, 60), ngrams=(1, 2)):
    rows = TG.documents(texts, "label", "text", "fold")
    sizes = {r["fold"]: r["count"] for r in rows.groupBy("fold").count().collect()}
    points = [TG.Point(f, g, v, c, one) for g in ngrams for f in sorted(sizes) for v in vocab for c in (0.1, 10.0) for one in (True, False)]
    vocabulary = TG.vocabularies(rows, sorted(sizes), max(vocab), list(ngrams))
    return TG.Grid(TG.counts_by_place(rows, vocabulary), vocabulary, points, ["x", "y"], sizes), vocabulary


def test_vocabularies_leave_the_fold_out(texts):
    rows, df = texts
    _, vocabulary = _grid(df)
    from collections import Counter
    for fold in range(3):
        for ngram in (1, 2):
            times, docs = Counter(), Counter()
            for _, text, _, f in rows:
                if f != fold:
                    w = text.split()
                    grams = w + [f"{a} {b}" for a, b in zip(w, w[1:])] * (ngram > 1)
                    times.update(grams)
                    docs.update(set(grams))
            want = [(t, docs[t]) for t, _ in sorted(times.items(), key=lambda x: (-x[1], x[0]))[:60]]
            found = [(r["term"], r["df"]) for r in vocabulary.filter((F.col("fold") == fold) & (F.col("ngram") == ngram)).orderBy("rank").collect()]
            assert found == want


def test_gradient_by_differences_and_falling_loss(texts):
    """The gradient of one point against differences of its loss, computed from the plain definition."""
    rows, df = texts
    grid, _ = _grid(df, vocab=(20,), ngrams=(1,))
    at = next(i for i, p in enumerate(grid.points) if p.fold == 1 and not p.l1 and p.c == 10.0)
    table = [(dict(zip(r["places"], r["counts"])), "xy".index(r["label"]), r["fold"]) for r in grid.table.collect()]
    X = np.array([[c.get(k, 0.0) for k in range(grid.size)] for c, _, f in table if f != 1]) * grid.factor[:, at]
    y = np.array([k for _, k, f in table if f != 1])
    assert np.allclose(X.std(0, ddof=1)[grid.factor[:, at] > 0], 1, atol=1e-6)  # scaled columns

    def loss(w, b):
        s = X @ w + b
        return np.mean(np.log(np.exp(s).sum(1)) - s[np.arange(len(y)), y])

    rs = np.random.RandomState(0)
    w, b = rs.normal(size=(grid.size, len(grid.points), 2)) * 0.1, rs.normal(size=(len(grid.points), 2)) * 0.1
    g, gb = grid.gradient(w, b)
    for k in [int(i) for i in np.flatnonzero(grid.factor[:, at])[:4]]:
        step = np.zeros((grid.size, 2))
        step[k, 0] = 1e-4
        numeric = (loss(w[:, at] + step, b[at]) - loss(w[:, at] - step, b[at])) / 2e-4
        assert abs(numeric - g[k, at, 0]) < 1e-4
    assert abs((loss(w[:, at], b[at] + [1e-4, 0]) - loss(w[:, at], b[at] - [1e-4, 0])) / 2e-4 - gb[at, 0]) < 1e-4
    values = [loss(np.zeros((grid.size, 2)), np.zeros(2))] + [loss(w[:, at], b[at]) for w, b in (grid.fit(4), grid.fit(16))]
    assert values[0] > values[1] > values[2]


def test_accuracies_near_those_of_single_fits(texts):
    """Within 4 points of pyspark.ml's fit of each point over the same folds; the
    vocabulary holds all words, as ties at its end fall differently there."""
    _, df = texts
    found = TG.cross_validate_grid(df, vocabularies_of=(60,), ngrams=(1,), cs=(0.1, 10.0), l1=(1.0, 0.0), steps=60)
    mean = {(r["ngram"], r["c"], r["l1"]): r["a"] for r in found.groupBy("ngram", "c", "l1").agg(F.avg(F.col("correct") / F.col("n")).alias("a")).collect()}
    assert len(mean) == 4 and found.agg(F.sum("n")).first()[0] == 4 * 240
    n = df.count()
    pipe = ML.text_classifier("label", "text", 60, 1)
    lr = pipe.getStages()[-1]
    points = ParamGridBuilder().addGrid(lr.regParam, [1 / (0.1 * n), 1 / (10.0 * n)]).addGrid(lr.elasticNetParam, [1.0, 0.0]).build()
    for point, accuracy in zip(points, ML.cross_validate(df, pipe, points, folds=3, fold_col="fold")):
        assert abs(mean[1, round(1 / (point[lr.regParam] * n), 6), point[lr.elasticNetParam]] - accuracy) < 0.04


def test_edges(spark, texts):
    schema = "doc_id long, text string, label string, fold int"
    small = dict(vocabularies_of=(5,), ngrams=(1,), cs=(1.0,), l1=(0.0,), steps=3)
    for rows in ([], [(1, "ab cd", "x", 0), (2, "ab", "y", 0)], [(1, "ab cd", "x", 0), (2, "ab", "x", 1)], [(1, "", "x", 0), (2, None, "y", 1)]):
        assert TG.cross_validate_grid(spark.createDataFrame(rows, schema), **small).count() == 0
    rows = [(1, "ab cd", "x", 0), (1, "ab cd", "x", 0), (2, "ef gh", "y", 1), (3, None, "y", 0), (4, "ab cd", "x", 1), (5, "ef", None, 0), (6, "ef", "y", None), (7, "ab " * 9000, "x", 1)]
    got = TG.cross_validate_grid(spark.createDataFrame(rows, schema), **small).collect()
    assert sorted((r["fold"], r["n"]) for r in got) == [(0, 3), (1, 3)]


def test_blocks_hold_their_own_terms_of_one_fold(spark):
    """A block is as wide as the terms that its documents have, however many the
    vocabularies have, and of one fold; frequent terms have the first places."""
    rows = [(i, f"all {'ab'[i % 2]}{i % 2}w{i % 7} all", "xy"[i % 2], i % 3) for i in range(120)]
    docs = TG.documents(spark.createDataFrame(rows, "doc_id long, text string, label string, fold int"), "label", "text", "fold")
    terms = TG.ranked_terms(docs, [0, 1, 2], 50, [2])
    assert terms.filter("place = 0").select("term").distinct().collect() == [("all",)]
    size = terms.agg(F.max("place")).first()[0] + 1
    table = TG.counts_by_place(docs.filter("fold = 1 OR label = 'x'").repartition(1), terms)
    seen = 0
    for X, at, y, fold in TG._blocks(table.toArrow().to_batches(), size, ["x", "y"]):
        assert X.shape == (len(y), len(at)) and (X.sum(0) > 0).all() and (fold == 1 or (y == 0).all() and len(at) < size)
        seen += len(y)
    assert seen == 80


def test_pairs_of_rare_words_are_not_exchanged(spark):
    """Only pairs of words as frequent as the last kept word are counted, ties included."""
    rows = [(i, f"aa bb cc rare{i} aa bb", "xy"[i % 2], i % 2) for i in range(40)]
    docs = TG.documents(spark.createDataFrame(rows, "doc_id long, text string, label string, fold int"), "label", "text", "fold")
    found = [(r["term"], r["rank"]) for r in TG.ranked_terms(docs, [0, 1], 4, [2]).filter("fold = 0").orderBy("rank").collect()]
    assert found == [("aa", 0), ("aa bb", 1), ("bb", 2), ("bb cc", 3)]
