import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators import evaluate as EV
from tidewater.operators import ml as ML
from tidewater.sources import sinks as S


def test_normal_equations_match_numpy(spark):
    rs = np.random.RandomState(2)
    a, b = rs.uniform(0, 10, 500), rs.uniform(0, 1, 500)
    y = 1.5 + 0.3 * a - 2.0 * b + rs.normal(0, 0.01, 500)
    df = spark.createDataFrame([(float(x), float(z), float(t)) for x, z, t in zip(a, b, y)], "a double, b double, y double")
    got = ML.normal_equations_2(df, "a", "b", "y").first()
    X = np.column_stack([np.ones(500), a, b])
    want = np.linalg.lstsq(X, y, rcond=None)[0]
    assert np.allclose([got.b0, got.b1, got.b2], np.round(want, 6), atol=2e-6)


def test_one_hot_and_unseen_categories(spark):
    train = spark.createDataFrame([("x", 1.0), ("y", 2.0), ("x", 3.0)], "c string, v double")
    test = spark.createDataFrame([("z", 4.0), ("x", 5.0)], "c string, v double")
    model = ML.encode_features(train, ["c"], ["v"], handle_invalid="keep")
    vecs = [r.features.toArray().tolist() for r in model.transform(test).orderBy("v").collect()]
    assert vecs[0][:3] == [0.0, 0.0, 1.0]  # unseen "z" goes to the extra bucket
    assert vecs[1][:3] == [1.0, 0.0, 0.0]
    oh = ML.one_hot(train, "c", ["x", "y"], "c").orderBy("v").collect()
    assert [(r.c_x, r.c_y) for r in oh] == [(1, 0), (0, 1), (1, 0)]


def test_text_classifier_and_persistence(spark, tmp_path):
    rows = [(i, ("good great fine" if i % 2 else "bad awful poor") + f" w{i}", str(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, label string")
    model = ML.text_classifier("label", "text", vocab=50).fit(df)
    S.save_model(model, str(tmp_path / "m"))
    again = S.load_model(str(tmp_path / "m"))
    p1 = [r.prediction for r in model.transform(df).orderBy("doc_id").collect()]
    p2 = [r.prediction for r in again.transform(df).orderBy("doc_id").collect()]
    assert p1 == p2
    acc = EV.accuracy(model.transform(df).select(F.col("label_idx").alias("label"), "prediction")).first().accuracy
    assert acc == 1.0


def test_activations(spark):
    df = spark.createDataFrame([(0.0,), (1.0,)], "z double")
    got = [(r.t, r.s) for r in df.select(EV.activation(F.col("z"), "tanh").alias("t"),
                                         EV.activation(F.col("z")).alias("s")).orderBy("z").collect()]
    assert got[0] == (0.0, 0.5) and abs(got[1][0] - math.tanh(1)) < 1e-12


def _points(spark, n=400):
    rs = np.random.RandomState(6)
    a, b = rs.uniform(0, 1, n), rs.uniform(0, 1, n)
    return spark.createDataFrame([(float(x), float(z), "u" if x > 0.6 else "v" if z > 0.5 else "w", 2 * float(x) + float(z)) for x, z in zip(a, b)],
                                 "a double, b double, label string, y double")


@pytest.mark.parametrize("kind", ["tree", "forest", "gbt", "svc", "logistic"])
def test_models_are_no_worse_than_the_majority(spark, kind):
    df = _points(spark)
    model = ML.fit_classifier(df, ["a", "b"], "label", kind, num_trees=5, iters=10)
    r = ML.against_majority(model, df, df, "label").first()
    assert r.n == 400 and 0.2 < r.baseline < 0.6 and r.reaches
    assert ML.evaluate_classifier(model, df).first().accuracy > 0.75


def test_mlp_and_regressors_against_baselines(spark):
    df = _points(spark)
    two = df.withColumn("label", F.when(F.col("label") == "u", "u").otherwise("o"))
    assert ML.against_majority(ML.fit_classifier(two, ["a", "b"], "label", "mlp"), two, two, "label").first().reaches
    for model in (ML.fit_forest_regressor(df, ["a", "b"], "y", num_trees=5, max_depth=4), ML.fit_lasso(df, ["a", "b"], "y")):
        r = ML.against_mean(model, df, df, "y").first()
        assert r.n == 400 and r.reaches
    curve = ML.regression_curve(df, df, ["a", "b"], "y", depths=(1, 4)).collect()
    assert curve[1].train_mse < curve[0].train_mse


def test_regression_curve_by_one_fit(spark, monkeypatch):
    """Each depth's errors are those of a tree fitted to that depth, also where
    branches end early and rows lack a feature or are new; one tree is fitted."""
    import math
    data = [(i, float(i % 23), float(i % 7), (i % 23) ** 1.5 + (9.0 if i % 7 > 3 and i % 23 > 11 else 0.0) + math.sin(i)) for i in range(600)]
    df = spark.createDataFrame([*data, (600, None, 1.0, 5.0)], "id int, a double, b double, y double").repartition(3)
    train, test, depths, fits, make = df.filter("id % 5 > 0"), df.filter("id % 5 = 0"), (1, 2, 4, 7), [], ML.DecisionTreeRegressor
    monkeypatch.setattr(ML, "DecisionTreeRegressor", lambda **kw: fits.append(kw["maxDepth"]) or make(**kw))
    found = {r.max_depth: (r.train_mse, r.test_mse) for r in ML.regression_curve(train, test, ["a", "b"], "y", depths).collect()}
    assert fits == [7] and sorted(found) == [*depths]
    for d in depths:
        m = ML.Pipeline(stages=[*ML._assembler(["a", "b"]), make(featuresCol="features", labelCol="y", maxDepth=d, seed=7)]).fit(train)
        assert found[d] == pytest.approx([ML.regression_mse(m, x, "y").first()["mse"] for x in (train, test)], abs=2e-6)


def test_cross_validation_of_any_estimator_and_sweeps(spark):
    df = _points(spark, 150)
    pipe = ML.Pipeline(stages=[*ML._assembler(["a", "b"]), ML.LinearRegression(featuresCol="features", labelCol="y")])
    assert ML.cross_validate(df, pipe, [{}], metric="mse:y", folds=3)[0] < 1e-6
    depths = ML.cross_validate_depths(df, ["a", "b"], "label", folds=2, depths=(1, 3)).collect()
    assert [r.max_depth for r in depths] == [1, 3] and depths[1].avg_accuracy > depths[0].avg_accuracy
    sweep = ML.depth_sweep(df, df, ["a", "b"], "label", depths=(1, 3), trees=(1, 3)).collect()
    assert [(r.max_depth, r.num_trees) for r in sweep] == [(1, 1), (3, 1), (1, 3), (3, 3)]
    texts = spark.createDataFrame([(i, ("good fine" if i % 2 else "bad poor") + f" w{i % 5}", str(i % 2)) for i in range(40)], "doc_id int, text string, label string")
    grid = ML.text_grid(texts, vocabularies=(20,), ngrams=(1,), cs=(1.0,), folds=2).collect()
    assert [(r.vocab, r.ngram, r.c, r.l1) for r in grid] == [(20, 1, 1.0, 1.0), (20, 1, 1.0, 0.0)] and grid[1].avg_accuracy > 0.9


def test_forests_and_boosting_fit_weighted_cells(spark, monkeypatch):
    """However often rows come, a fit sees each cell of the bins once, with its rows as weight."""
    df = spark.range(3000).select((F.col("id") % 5).cast("double").alias("a"), (F.col("id") % 3).cast("double").alias("b"),
                                  F.when(F.col("id") % 5 > 2, "x").otherwise("y").alias("label"), (F.col("id") % 5).cast("double").alias("y"))
    df = df.unionByName(df.limit(1).withColumn("a", F.lit(None).cast("double")))  # left out
    seen = []

    def watch(cls):
        fit = cls._fit

        def spy(self, data):
            seen.append(data.agg(F.count(F.lit(1)), F.sum("weight")).first())
            return fit(self, data)
        monkeypatch.setattr(cls, "_fit", spy)

    watch(ML.RandomForestClassifier), watch(ML.OneVsRest), watch(ML.RandomForestRegressor)
    models = [ML.fit_classifier(df, ["a", "b"], "label", "forest", num_trees=3), ML.fit_classifier(df, ["a", "b"], "label", "gbt", iters=3)]
    curve = ML.fit_forest_regressor(df, ["a", "b"], "y", num_trees=5, max_depth=4)
    assert [tuple(r) for r in seen] == [(15, 3000.0)] * 3
    for m in models:
        assert tuple(ML.evaluate_classifier(m, df).first()) == (1.0, 3000)
    assert ML.regression_mse(curve, df, "y").first().n == 3000
    monkeypatch.undo()  # ML's own fit on the rows boosts the same stumps
    rows = ML.Pipeline(stages=[ML._label_indexer("label"), *ML._assembler(["a", "b"]), ML.classifier("gbt", iters=3)]).fit(df)
    plain = {(r.a, r.b): r.prediction for r in rows.transform(df).select("a", "b", "prediction").distinct().collect()}
    assert plain == {(r.a, r.b): r.prediction for r in models[1].transform(df).select("a", "b", "prediction").distinct().collect()}
