"""Averaged perceptron by iterative parameter mixing (M6).

Features are scaled by their mean and deviation (one aggregate). In an epoch
every task runs the perceptron over its rows, in their order, from the mixed
weights; the tasks' weights are averaged to the next epoch's. The model is the
average of all weights that the epochs passed through, which is steadier than
the last ones. On rows that a margin separates, the mistakes of an epoch,
averaged over the tasks and summed over all epochs, stay below (radius /
margin)², however the rows are split. A task holds one block of rows; the
driver holds the weights and one row a task of each epoch.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.session import cut_lineage, ship_package, spread


@dataclass
class Perceptron:
    """Scaled features times weights plus intercept; ``mistakes`` of each epoch, averaged over the tasks."""
    features: list[str]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last one is the intercept
    mistakes: list[float] = field(default_factory=list)

    def margin(self) -> Column:
        out = F.lit(float(self.weights[-1]))
        for f, m, s, w in zip(self.features, self.mean, self.scale, self.weights):
            out = out + (F.col(f).cast("double") - float(m)) / float(s) * float(w)
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction``: 1 on or above the plane, else 0; null for a null feature."""
        return df.withColumn("prediction", (self.margin() >= 0).cast("int"))


def _epoch(X: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Weights after the rows, the sum of the weights after each row, mistakes."""
    w, total, at, mistakes = w.copy(), np.zeros_like(w), 0, 0
    while at < len(X):
        # the next mistake of the present weights; until there they stay
        ahead = X[at:at + 4_096] @ w * y[at:at + 4_096] <= 0
        first = int(ahead.argmax()) if ahead.any() else len(ahead)
        total += first * w
        at += first
        if first < len(ahead):
            w = w + y[at] * X[at]
            total += w
            at += 1
            mistakes += 1
    return w, total, mistakes


def scaling(df: DataFrame, features: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation (1 where there is none) of each feature, by one aggregate."""
    r = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(features) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    mean = np.array([r[f"m{i}"] or 0.0 for i in range(len(features))])
    scale = np.array([r[f"s{i}"] or 1.0 for i in range(len(features))])
    return mean, scale


def fit_perceptron(train: DataFrame, features: list[str], positive: Column, epochs: int = 10) -> Perceptron:
    """The model of ``positive`` (a boolean column); rows with a null feature
    or class are left out. Training ends early after an epoch without mistakes."""
    ship_package(train.sparkSession)
    rows = train.select(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)], positive.alias("y")).dropna()
    rows = cut_lineage(spread(rows))
    names = [f"x{i}" for i in range(len(features))]
    mean, scale = scaling(rows, names)
    w, passed, seen, mistakes = np.zeros(len(features) + 1), np.zeros(len(features) + 1), 0, []
    for _ in range(epochs):
        def run(batches, w=w):
            held, total, wrong, n = w, np.zeros_like(w), 0, 0
            for batch in batches:
                if batch.num_rows:
                    X = (np.stack([batch.column(c).to_numpy() for c in names], 1) - mean) / scale
                    y = np.where(batch.column("y").to_numpy(zero_copy_only=False), 1.0, -1.0)
                    held, sums, k = _epoch(np.concatenate([X, np.ones((len(X), 1))], 1), y, held)
                    total, wrong, n = total + sums, wrong + k, n + len(X)
            if n:
                yield pa.RecordBatch.from_pylist([{"w": held.tolist(), "total": total.tolist(), "mistakes": wrong, "n": n}])

        tasks = rows.mapInArrow(run, "w array<double>, total array<double>, mistakes bigint, n bigint").collect()
        if not tasks:
            break
        w = np.mean([r["w"] for r in tasks], axis=0)
        passed += np.sum([r["total"] for r in tasks], axis=0)
        seen += sum(r["n"] for r in tasks)
        mistakes.append(float(np.mean([r["mistakes"] for r in tasks])))
        if not mistakes[-1]:
            break
    return Perceptron(features, mean, scale, passed / max(seen, 1) if mistakes and mistakes[-1] else w, mistakes)
