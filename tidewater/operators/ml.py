"""Model pipelines with ``pyspark.ml``.

Everything is an Estimator/Transformer pipeline so fitting is distributed
(tree learners aggregate histograms per partition; linear models use
treeAggregate). The regression fit by normal equations (M10) is one
aggregate of sums of products and a closed-form 3×3 solve written as column
expressions — no driver round trip.

Forests and boosted stumps see a feature by its bins only (``maxBins``, 32), so
they are fitted on the distinct rows of bins, each with its number of rows as
weight: the passes of a fit follow the cells of the bins and not the rows.
"""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, OneVsRest, RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import (IDF, Bucketizer, CountVectorizer, NGram, OneHotEncoder, RegexTokenizer, SQLTransformer,
                                StandardScaler, StringIndexer, VectorAssembler)
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.text import TOKEN_RX
from tidewater.operators import evaluate as EV
from tidewater.operators.common import attach_scalars
from tidewater.operators.forest import bin_edges
from tidewater.session import cut_lineage, spread


def _label_indexer(label: str) -> StringIndexer:
    return StringIndexer(inputCol=label, outputCol="label_idx", handleInvalid="keep",
                         stringOrderType="alphabetAsc")


def _assembler(features: list[str], scaled: bool = False):
    stages = [VectorAssembler(inputCols=features, outputCol="raw" if scaled else "features",
                              handleInvalid="skip")]
    if scaled:
        stages.append(StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True))
    return stages


def classifier(kind: str, seed: int = 7, **kw):
    """M3–M6, M13 estimators on (features, label_idx)."""
    common = dict(featuresCol="features", labelCol="label_idx")
    if kind == "tree":
        return DecisionTreeClassifier(seed=seed, maxDepth=kw.get("max_depth", 5), **common)
    if kind == "forest":
        return RandomForestClassifier(seed=seed, numTrees=kw.get("num_trees", 20),
                                      maxDepth=kw.get("max_depth", 5), **common)
    if kind == "gbt":  # binary learner → one-vs-rest for several classes (M5)
        return OneVsRest(classifier=GBTClassifier(maxIter=kw.get("iters", 100), stepSize=1.0, maxDepth=1,
                                                  seed=seed), parallelism=4, **common)
    if kind == "svc":  # perceptron / linear SVC re-aimed as a linear SVC, scaled inputs
        return OneVsRest(classifier=LinearSVC(maxIter=kw.get("iters", 50)), **common)
    if kind == "logistic":
        return LogisticRegression(maxIter=kw.get("iters", 100), **common)
    if kind == "mlp":
        return MultilayerPerceptronClassifier(layers=[kw["n_features"], 7, 2], seed=seed,
                                              maxIter=kw.get("iters", 100), **common)
    raise ValueError(kind)


MAX_BINS = 32  # of a feature, as the tree learners' own default


def _binner(train: DataFrame, features: list[str]) -> Bucketizer:
    """Bins of the features' values (all of few ones, else quantiles), up to the
    edge as in ``bin_edges``; rows with a null or NaN feature are skipped."""
    edges = bin_edges(train.dropna(subset=features), features, MAX_BINS)
    splits = [[-math.inf, *[math.nextafter(e, math.inf) for e in found or [0.0]], math.inf] for found in edges]
    return Bucketizer(splitsArray=splits, inputCols=features, outputCols=_bins(features), handleInvalid="skip")


def _bins(features: list[str]) -> list[str]:
    return [f"_bin{i}" for i in range(len(features))]


def _fit_cells(train: DataFrame, features: list[str], stages: list, learner, others: list[str], aggs: list) -> PipelineModel:
    """The fitted ``stages`` (of the rows), the bins and ``learner``, fitted on
    the cells: distinct bins and ``others`` with their rows as ``weight``. A
    forest draws its bootstrap weights by cells."""
    first = [stage.fit(train) for stage in stages]
    binner = _binner(train, features)
    rows = PipelineModel(stages=[*first, binner]).transform(train)
    cells = rows.groupBy(*_bins(features), *others).agg(F.count(F.lit(1)).cast("double").alias("weight"), *aggs)
    rest = Pipeline(stages=[*_assembler(_bins(features)), learner]).fit(spread(cut_lineage(cells)))
    return PipelineModel(stages=[*first, binner, *rest.stages])


def fit_classifier(train: DataFrame, features: list[str], label: str, kind: str, **kw):
    if kind in ("forest", "gbt"):
        return _fit_cells(train, features, [_label_indexer(label)], classifier(kind, **kw).setWeightCol("weight"), ["label_idx"], [])
    scaled = kind in ("svc", "mlp", "logistic")
    if kind == "mlp":
        kw.setdefault("n_features", len(features))
    stages = [_label_indexer(label), *_assembler(features, scaled), classifier(kind, **kw)]
    return Pipeline(stages=stages).fit(train)


def evaluate_classifier(model, test: DataFrame) -> DataFrame:
    """E1 on a fitted pipeline: (accuracy, n)."""
    p = model.transform(test)
    return p.agg(F.round(F.avg((F.col("label_idx") == F.col("prediction")).cast("double")), 6).alias("accuracy"),
                 F.count(F.lit(1)).cast("bigint").alias("n"))


def fit_forest_regressor(train: DataFrame, features: list[str], label: str, num_trees: int = 20,
                         max_depth: int = 10, seed: int = 7):
    """M9. A cell's label is the mean of its rows', which leaves the gain of
    every split as it is."""
    rf = RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=num_trees,
                               maxDepth=max_depth, seed=seed, weightCol="weight")
    # a null label stays one, which the learner refuses
    mean = F.when(F.count(label) == F.count(F.lit(1)), F.avg(F.col(label).cast("double"))).alias(label)
    return _fit_cells(train, features, [], rf, [], [mean])


def fit_lasso(train: DataFrame, features: list[str], label: str, reg: float = 0.01):
    """M10 (Lasso variant)."""
    lr = LinearRegression(featuresCol="features", labelCol=label, elasticNetParam=1.0, regParam=reg)
    return Pipeline(stages=[*_assembler(features), lr]).fit(train)


def regression_mse(model, test: DataFrame, label: str) -> DataFrame:
    """E2 on a fitted regression pipeline."""
    p = model.transform(test)
    return p.agg(F.round(F.avg(F.pow(F.col(label) - F.col("prediction"), 2)), 6).alias("mse"),
                 F.count(F.lit(1)).cast("bigint").alias("n"))


def against_majority(model, train: DataFrame, test: DataFrame, label: str, margin: float = 0.0) -> DataFrame:
    """(n, baseline, reaches): the test rows, the accuracy of the training
    majority class on them, and whether the model's is above it by ``margin``
    at least (M1)."""
    base = EV.accuracy(EV.baseline_majority(train.select(F.col(label).alias("label")), test.select(F.col(label).alias("label"))))
    both = attach_scalars(evaluate_classifier(model, test), base.select(F.col("accuracy").alias("baseline")))
    return both.select("n", F.round("baseline", 6).alias("baseline"), (F.col("accuracy") >= F.col("baseline") + margin).alias("reaches"))


def against_mean(model, train: DataFrame, test: DataFrame, label: str, share: float = 1.0) -> DataFrame:
    """(n, baseline, reaches): the test rows, the mean squared error of the
    training mean on them, and whether the model's is at most ``share`` of it
    (M2)."""
    base = EV.baseline_mean(train, test, label).agg(F.avg(F.pow(F.col(label) - F.col("prediction"), 2)).alias("baseline"))
    both = attach_scalars(regression_mse(model, test, label), base)
    return both.select("n", F.round("baseline", 6).alias("baseline"), (F.col("mse") <= F.col("baseline") * share).alias("reaches"))


def normal_equations_2(df: DataFrame, x1: str, x2: str, y: str) -> DataFrame:
    """M10 closed form: y ≈ b0 + b1·x1 + b2·x2 by ordinary least squares.

    One aggregate of the sums of products, then Cramer's rule on the 3×3
    normal equations — all column expressions."""
    a, b, yy = F.col(x1).cast("double"), F.col(x2).cast("double"), F.col(y).cast("double")
    s = df.agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum(a).alias("sa"), F.sum(b).alias("sb"),
               F.sum(a * a).alias("saa"), F.sum(a * b).alias("sab"), F.sum(b * b).alias("sbb"),
               F.sum(yy).alias("sy"), F.sum(a * yy).alias("say"), F.sum(b * yy).alias("sby"))
    c = F.col

    def det3(m):
        return (m[0][0] * (m[1][1] * m[2][2] - m[1][2] * m[2][1])
                - m[0][1] * (m[1][0] * m[2][2] - m[1][2] * m[2][0])
                + m[0][2] * (m[1][0] * m[2][1] - m[1][1] * m[2][0]))

    A = [[c("n"), c("sa"), c("sb")], [c("sa"), c("saa"), c("sab")], [c("sb"), c("sab"), c("sbb")]]
    rhs = [c("sy"), c("say"), c("sby")]
    d = det3(A)
    coefs = []
    for j in range(3):
        m = [[rhs[i] if k == j else A[i][k] for k in range(3)] for i in range(3)]
        coefs.append(det3(m) / d)
    return s.select(*[F.round(coefs[j], 6).alias(f"b{j}") for j in range(3)])


def one_hot(df: DataFrame, col: str, categories: list[str], prefix: str | None = None) -> DataFrame:
    """M7 (oracle form): one indicator column per known category."""
    p = prefix or col
    return df.select("*", *[(F.col(col) == F.lit(v)).cast("int").alias(f"{p}_{v.lower()}") for v in categories])


def encode_features(train: DataFrame, cat_cols: list[str], num_cols: list[str], handle_invalid: str = "keep"):
    """M7/M8: StringIndexer + OneHotEncoder(dropLast=False) + VectorAssembler;
    categories unseen in training go to an extra bucket (``keep``)."""
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid=handle_invalid) for c in cat_cols]
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in cat_cols], outputCols=[f"{c}_oh" for c in cat_cols],
                        dropLast=False, handleInvalid=handle_invalid)
    va = VectorAssembler(inputCols=[f"{c}_oh" for c in cat_cols] + num_cols, outputCol="features")
    return Pipeline(stages=[*idx, ohe, va]).fit(train)


def text_classifier(label: str = "label", text: str = "text", vocab: int = 1000, ngram: int = 2,
                    reg: float = 0.01, l1: float = 0.0) -> Pipeline:
    """Tokens (same rule as the TF-IDF tables) → n-grams → counts
    (capped vocabulary) → IDF → logistic regression (L1/L2 via elastic net)."""
    tok = RegexTokenizer(inputCol=text, outputCol="tok", pattern=TOKEN_RX, gaps=False, toLowercase=True)
    stages = [tok]
    if ngram >= 2:
        stages += [NGram(n=2, inputCol="tok", outputCol="bi"),
                   SQLTransformer(statement="SELECT *, concat(tok, bi) AS grams FROM __THIS__")]
        src = "grams"
    else:
        src = "tok"
    stages += [CountVectorizer(inputCol=src, outputCol="tf", vocabSize=vocab),
               IDF(inputCol="tf", outputCol="features"),
               StringIndexer(inputCol=label, outputCol="label_idx", handleInvalid="keep"),
               LogisticRegression(featuresCol="features", labelCol="label_idx", regParam=reg,
                                  elasticNetParam=l1, maxIter=50)]
    return Pipeline(stages=stages)


def cross_validate(train: DataFrame, pipeline: Pipeline, grid: list[dict], metric: str = "accuracy", folds: int = 5,
                   parallelism: int = 4, seed: int = 7, fold_col: str = "") -> list[float]:
    """K-fold cross validation of any pipeline; the mean metric of
    each point of ``grid`` (parameters to values, as ``ParamGridBuilder``
    makes them; ``[{}]`` for the pipeline as it is). ``metric``: of
    classification (on ``label_idx``), or ``mse:<label>``. ``fold_col`` names a
    column with each row's fold."""
    if metric.startswith("mse:"):
        ev = RegressionEvaluator(labelCol=metric[4:], predictionCol="prediction", metricName="mse")
    else:
        ev = MulticlassClassificationEvaluator(labelCol="label_idx", predictionCol="prediction", metricName=metric)
    cv = CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=ev, numFolds=folds, parallelism=parallelism, seed=seed, foldCol=fold_col)
    return cv.fit(train).avgMetrics


def cross_validate_depths(train: DataFrame, features: list[str], label: str, kind: str = "tree", folds: int = 5,
                          depths=tuple(range(1, 11)), seed: int = 7) -> DataFrame:
    """(max_depth, avg_accuracy) of a tree learner."""
    est = classifier(kind, seed=seed)
    pipe = Pipeline(stages=[_label_indexer(label), *_assembler(features), est])
    found = cross_validate(train, pipe, ParamGridBuilder().addGrid(est.maxDepth, list(depths)).build(), folds=folds, seed=seed)
    return train.sparkSession.createDataFrame([(int(d), float(round(m, 6))) for d, m in zip(depths, found)], "max_depth int, avg_accuracy double")


def text_grid(train: DataFrame, label: str = "label", text: str = "text", vocabularies=(1000, 2000, 3000), ngrams=(1, 2),
              cs=(0.1, 1.0, 10.0), l1=(1.0, 0.0), folds: int = 5) -> DataFrame:
    """(vocab, ngram, c, l1, avg_accuracy) of the text classifier over
    vocabulary × n-gram × regularisation (1 / c, over the rows) × penalty.
    Each vocabulary and n-gram is a pipeline; c and the penalty are its grid."""
    n, rows = train.count(), []
    for vocab in vocabularies:
        for ngram in ngrams:
            pipe = text_classifier(label, text, vocab, ngram)
            lr = pipe.getStages()[-1]
            grid = ParamGridBuilder().addGrid(lr.regParam, [1.0 / (c * n) for c in cs]).addGrid(lr.elasticNetParam, list(l1)).build()
            for point, m in zip(grid, cross_validate(train, pipe, grid, folds=folds)):
                rows.append((vocab, ngram, round(1.0 / (point[lr.regParam] * n), 6), point[lr.elasticNetParam], float(round(m, 6))))
    return train.sparkSession.createDataFrame(rows, "vocab int, ngram int, c double, l1 double, avg_accuracy double")


def depth_sweep(train: DataFrame, test: DataFrame, features: list[str], label: str,
                depths=tuple(range(1, 21)), trees=(1, 5, 10, 25, 50, 100, 200), seed: int = 7) -> DataFrame:
    """Forest grid over depth × ensemble size → (max_depth,
    num_trees, train_accuracy, test_accuracy), a learning-curve table. A single
    tree (``trees=(1,)``) gives the curve of one tree."""
    rows = []
    ev = MulticlassClassificationEvaluator(labelCol="label_idx", predictionCol="prediction", metricName="accuracy")
    for t in trees:
        for d in depths:
            m = fit_classifier(train, features, label, "forest" if t > 1 else "tree", num_trees=t, max_depth=d, seed=seed)
            rows.append((d, t, round(ev.evaluate(m.transform(train)), 6), round(ev.evaluate(m.transform(test)), 6)))
    return train.sparkSession.createDataFrame(
        rows, "max_depth int, num_trees int, train_accuracy double, test_accuracy double")


def _paths(model, deepest: int) -> list[tuple]:
    """(leaf, p0, p1, …) of a fitted regression tree: the number that ``leafCol``
    gives a leaf, and what the tree cut at each depth predicts there (a tree of
    ``deepest`` levels has 2 ** deepest leaves at most)."""
    out = []

    def walk(node, above: list[float]) -> None:
        here = [*above, float(node.prediction())]
        if node.subtreeDepth() == 0:
            out.append((float(len(out)), *here, *[here[-1]] * (deepest + 1 - len(here))))
        else:
            walk(node.leftChild(), here)
            walk(node.rightChild(), here)

    walk(model._call_java("rootNode"), [])
    return out


def regression_curve(train: DataFrame, test: DataFrame, features: list[str], label: str, depths=tuple(range(1, 11)), seed: int = 7) -> DataFrame:
    """E5: (max_depth, train_mse, test_mse) of a regression tree, all depths by
    one fit: a node's split doesn't depend on how deep the tree will grow, so the
    deepest tree cut at a depth is the tree of that depth."""
    spark, deepest = train.sparkSession, max(depths)
    tree = DecisionTreeRegressor(featuresCol="features", labelCol=label, maxDepth=deepest, seed=seed, leafCol="leaf")
    m = Pipeline(stages=[*_assembler(features), tree]).fit(train)
    leaves = F.broadcast(spark.createDataFrame(_paths(m.stages[-1], deepest), ", ".join(["leaf double", *[f"p{d} double" for d in range(deepest + 1)]])))
    found = [m.transform(x).select("leaf", label).join(leaves, "leaf").agg(*[F.round(F.avg(F.pow(F.col(label) - F.col(f"p{d}"), 2)), 6).alias(f"d{d}") for d in depths]).first()
             for x in (train, test)]
    rows = [(d, *(float(r[f"d{d}"]) for r in found)) for d in depths]
    return spark.createDataFrame(rows, "max_depth int, train_mse double, test_mse double")


def top_importances(spark, model, features: list[str], n: int = 10) -> DataFrame:
    """The n largest feature importances with their names (the
    importance vector has one entry per feature: a bound set by the model)."""
    imp = model.stages[-1].featureImportances.toArray()
    rows = sorted(((features[i], float(round(v, 6))) for i, v in enumerate(imp)), key=lambda r: (-r[1], r[0]))[:n]
    return spark.createDataFrame(rows, "feature string, importance double")
