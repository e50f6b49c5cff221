"""Cross validation from sufficient statistics.

One aggregate gives each fold's statistics; what a model is fitted on without a
fold is the total less the fold, so the rows are read once for all folds, all
penalties and all depths. Ridge regression needs a fold's sums of products, a
tree its counts of classes in the cells of the binned features. A row belongs to
fold ``fold`` (0 to folds - 1); rows with a null among the used columns are left
out, as is a fold without rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.forest import bin_edges, cells_by, grow_tree, read_integers
from tidewater.operators.knn import write_queries
from tidewater.session import ship_package


def product_sums(df: DataFrame, features: list[str], y: str, fold: str = "fold") -> dict[int, np.ndarray]:
    """Of each fold the matrix of sums of products of (1, features, y): folds ×
    (features + 2)² numbers in all."""
    cols = [F.lit(1.0), *[F.col(c).cast("double") for c in [*features, y]]]
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    sums = df.dropna(subset=[*features, y, fold]).groupBy(F.col(fold).cast("int").alias("fold")).agg(*[F.sum(cols[i] * cols[j]).alias(f"s{i}_{j}") for i, j in pairs])
    out = {}
    for r in sums.collect():
        m = np.zeros((len(cols), len(cols)))
        for i, j in pairs:
            m[i, j] = m[j, i] = r[f"s{i}_{j}"]
        out[r["fold"]] = m
    return out


def ridge(sums: np.ndarray, penalty: float) -> np.ndarray:
    """Intercept and weights that minimise squared error + penalty · Σ weights²
    (the intercept is free), from sums of products."""
    p = len(sums) - 1
    free = np.diag([0.0] + [penalty] * (p - 1))
    return np.linalg.lstsq(sums[:p, :p] + free, sums[:p, p], rcond=None)[0]


def squared_error(sums: np.ndarray, weights: np.ndarray) -> float:
    """Sum of squared errors, from sums of products."""
    p = len(sums) - 1
    return max(0.0, float(sums[p, p] - 2 * weights @ sums[:p, p] + weights @ sums[:p, :p] @ weights))


def cross_validate_ridge(df: DataFrame, features: list[str], y: str, penalties: list[float], fold: str = "fold") -> DataFrame:
    """(penalty, fold, n, mse): of each fold the mean squared error of the
    ridge regression fitted on the other folds."""
    each = product_sums(df, features, y, fold)
    total = sum(each.values()) if each else None
    rows = [(float(p), f, int(m[0, 0]), float(squared_error(m, ridge(total - m, p)) / m[0, 0])) for p in penalties for f, m in sorted(each.items()) if len(each) > 1]
    return df.sparkSession.createDataFrame(rows, "penalty double, fold int, n bigint, mse double")


def cross_validate_trees(df: DataFrame, features: list[str], label: str, depths: list[int], fold: str = "fold", n_bins: int = 32) -> DataFrame:
    """(max_depth, fold, correct, n): of each fold the rows whose class the
    Gini tree of each depth predicts, grown on the other folds' counts. A task
    grows the tree of one fold to the largest depth; a tree cut at a depth is
    the tree of that depth."""
    spark = df.sparkSession
    ship_package(spark)
    used = df.dropna(subset=[*features, label, fold]).withColumn("_fold", F.col(fold).cast("int"))
    folds, classes = (sorted(r[0] for r in used.select(c).distinct().collect()) for c in ("_fold", label))
    schema = "max_depth int, fold int, correct bigint, n bigint"
    if len(folds) < 2:
        return spark.createDataFrame([], schema)
    edges = bin_edges(used, features, n_bins)
    sums = [F.count_if((F.col("_label") == c) & (F.col("_fold") == f)).alias(f"c{i}_{k}") for i, f in enumerate(folds) for k, c in enumerate(classes)]
    files = write_queries(cells_by(used, features, edges, [F.col(label).alias("_label"), "_fold"], sums))
    n_features, n_classes = len(features), len(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                rows = read_integers(files)
                bins, counts = rows[:, :n_features], rows[:, n_features:].reshape(len(rows), len(folds), n_classes)
                own = counts[:, i]
                correct, at, kept = {}, np.ones(len(rows), np.int64), np.zeros(len(rows), np.int64)
                for level in grow_tree(bins, (counts.sum(1) - own).astype(np.float64), max(depths), 0, 0, n_features):
                    place = np.minimum(np.searchsorted(level["node"], at), len(level["node"]) - 1)
                    here = level["node"][place] == at
                    kept[here] = level["shares"].argmax(1)[place[here]]  # where no training row comes, what stood above stays
                    correct[level["depth"]] = int(own[np.arange(len(rows)), kept].sum())
                    inner = here & (level["feature"][place] >= 0)
                    f = level["feature"][place[inner]]
                    at[inner] = 2 * at[inner] + (bins[inner, f] > level["bin"][place[inner]])
                    at[~inner] = 0  # a leaf was reached
                last = max(correct)
                yield pa.RecordBatch.from_pylist([{"max_depth": d, "fold": folds[i], "correct": correct[min(d, last)], "n": int(own.sum())} for d in depths],
                                                 pa.schema([("max_depth", pa.int32()), ("fold", pa.int32()), ("correct", pa.int64()), ("n", pa.int64())]))

    return spark.range(len(folds), numPartitions=len(folds)).mapInArrow(run, schema)
