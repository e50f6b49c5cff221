"""Evaluation tables.

All of them are grouped aggregates over a predictions DataFrame
``(label, prediction[, probability])``; the classification report is
derived from the confusion counts, so one shuffle of ``(label, prediction)``
pairs (at most classes² rows after partial aggregation) feeds everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.common import attach_scalars


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """E1."""
    return pred.agg(F.round(F.avg((F.col(label) == F.col(prediction)).cast("double")), 6).alias("accuracy"),
                    F.count(F.lit(1)).cast("bigint").alias("n"))


def mse(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """E2."""
    return pred.agg(F.round(F.avg(F.pow(F.col(label) - F.col(prediction), 2)), 6).alias("mse"))


def confusion_matrix(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """E3 (long form: one row per non-empty cell)."""
    return pred.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


def classification_report(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                          digits: int = 4) -> DataFrame:
    """Precision, recall, F1 and support per class, plus accuracy, macro
    and weighted averages (zero division → 0)."""
    cm = confusion_matrix(pred, label, prediction)
    # each confusion cell counts once as its label's support and once as its
    # prediction's predicted count (tp when they agree): one inline + groupBy
    z = F.lit(0).cast("bigint")
    roles = F.array(
        F.struct(F.col("label").cast("string").alias("cls"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(z).alias("tp"),
                 F.col("n").alias("support"), z.alias("npred")),
        F.struct(F.col("prediction").cast("string").alias("cls"), z.alias("tp"), z.alias("support"),
                 F.col("n").alias("npred")))
    per = (cm.select(F.inline(roles)).groupBy("cls")
           .agg(F.sum("tp").alias("tp"), F.sum("support").alias("support"), F.sum("npred").alias("npred")))
    p = F.when(F.col("npred") > 0, F.col("tp") / F.col("npred")).otherwise(0.0)
    r = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    per = per.withColumn("precision", p).withColumn("recall", r).withColumn(
        "f1", F.when(F.col("precision") + F.col("recall") > 0,
                     2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0))
    tot = per.agg(F.sum("support").alias("_n"), F.sum("tp").alias("_tp"), F.count(F.lit(1)).alias("_k"),
                  F.sum("precision").alias("_sp"), F.sum("recall").alias("_sr"), F.sum("f1").alias("_sf"),
                  F.sum(F.col("precision") * F.col("support")).alias("_wp"),
                  F.sum(F.col("recall") * F.col("support")).alias("_wr"),
                  F.sum(F.col("f1") * F.col("support")).alias("_wf"))
    rd = lambda c: F.round(c, digits)
    classes = per.select("cls", rd(F.col("precision")).alias("precision"), rd(F.col("recall")).alias("recall"),
                         rd(F.col("f1")).alias("f1"), F.col("support").cast("bigint").alias("support"))
    summary = tot.select(F.inline(F.array(
        F.struct(F.lit("accuracy").alias("cls"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), rd(F.col("_tp") / F.col("_n")).alias("f1"),
                 F.col("_n").cast("bigint").alias("support")),
        F.struct(F.lit("macro avg").alias("cls"), rd(F.col("_sp") / F.col("_k")).alias("precision"),
                 rd(F.col("_sr") / F.col("_k")).alias("recall"), rd(F.col("_sf") / F.col("_k")).alias("f1"),
                 F.col("_n").cast("bigint").alias("support")),
        F.struct(F.lit("weighted avg").alias("cls"), rd(F.col("_wp") / F.col("_n")).alias("precision"),
                 rd(F.col("_wr") / F.col("_n")).alias("recall"), rd(F.col("_wf") / F.col("_n")).alias("f1"),
                 F.col("_n").cast("bigint").alias("support")))))
    return classes.unionByName(summary)


def sigmoid(z: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-z))


def bce(y: Column, p: Column) -> Column:
    """binary cross-entropy of a probability."""
    return -(y * F.log(p)) - (1 - y) * F.log(1 - p)


def mean_loss(pred: DataFrame, y: str = "y", logit: str = "logit") -> DataFrame:
    """Mean binary cross-entropy with the sigmoid applied to logits."""
    return pred.agg(F.round(F.avg(bce(F.col(y), sigmoid(F.col(logit)))), 6).alias("mean_loss"))


def misclassified(pred: DataFrame, order: list[str], n: int = 10, label: str = "label",
                  prediction: str = "prediction") -> DataFrame:
    """The first n rows (by ``order``) where label ≠ prediction —
    a bounded top-n, not a full sort."""
    return pred.filter(F.col(label) != F.col(prediction)).orderBy(*order).limit(n)


def class_impurity(df: DataFrame, label: str = "label") -> DataFrame:
    """F16: entropy (bits), Gini impurity and majority count of the class
    distribution."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    tot = counts.agg(F.sum("n").alias("_t"))
    p = F.col("n") / F.col("_t")
    return attach_scalars(counts, tot).agg(
        F.round(-F.sum(p * F.log2(p)), 6).alias("entropy"),
        F.round(1 - F.sum(p * p), 6).alias("gini"),
        F.max("n").cast("bigint").alias("majority"))


def baseline_majority(train: DataFrame, test: DataFrame, label: str = "label") -> DataFrame:
    """M1: predict the most frequent training class (ties → smallest)."""
    top = train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).agg(
        F.min(F.struct((-F.col("n")).alias("o"), F.col(label).alias("c"))).getField("c").alias("_maj"))
    return attach_scalars(test, top).withColumnRenamed("_maj", "prediction")


def baseline_mean(train: DataFrame, test: DataFrame, label: str = "y") -> DataFrame:
    """M2: predict the training mean."""
    return attach_scalars(test, train.agg(F.avg(label).alias("prediction")))


def activation(z: Column, kind: str = "sigmoid") -> Column:
    """the hidden/output activations of the small networks."""
    if kind == "tanh":
        return F.tanh(z)
    if kind == "sigmoid":
        return sigmoid(z)
    raise ValueError(kind)
