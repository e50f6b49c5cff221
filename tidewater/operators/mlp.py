"""A network of one hidden layer of tanh units for a binary class.

Each step is one pass over the rows: every task gives the cross entropy and the
full-batch gradient of its rows at a few step sizes along the last gradient, as
columns that one aggregate sums with partial sums; the best step is taken and
its gradient is there already. A step that doesn't lower the loss is made
smaller and tried again, so the loss never rises. The weights (a few dozen
numbers) are all that the driver holds.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.perceptron import scaling
from tidewater.session import cut_lineage, ship_package, spread

_TRIES = (0.3, 1.0, 2.5)  # step sizes of a pass, times the last good one


def shapes(n_features: int, hidden: int) -> int:
    return hidden * (n_features + 1) + hidden + 1


def loss_and_gradient(w: np.ndarray, X: np.ndarray, y: np.ndarray, hidden: int) -> tuple[float, np.ndarray]:
    """Sum over rows of the cross entropy on the logits, and its gradient; a
    row's terms in the precision of ``X``, the loss summed in doubles."""
    d, w = X.shape[1], w.astype(X.dtype)
    a, out = w[:hidden * (d + 1)].reshape(hidden, d + 1), w[hidden * (d + 1):]
    z = np.tanh(X @ a[:, :d].T + a[:, d])
    logit = z @ out[:hidden] + out[hidden]
    small = np.exp(-np.abs(logit))  # one exponential for the loss and the probability
    loss = np.maximum(logit, 0) + np.log(1 + small) - y * logit
    error = np.where(logit >= 0, 1, small) / (1 + small) - y
    back = (error[:, None] * out[:hidden]) * (1 - z * z)
    return float(loss.sum(dtype=np.float64)), np.concatenate([np.concatenate([back.T @ X, back.sum(0)[:, None]], 1).ravel(), z.T @ error, [error.sum()]])


@dataclass
class TanhNetwork:
    features: list[str]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    hidden: int
    losses: list[float] = field(default_factory=list)  # mean cross entropy before each step, and of the end

    def logit(self) -> Column:
        d = len(self.features)
        a, out = self.weights[:self.hidden * (d + 1)].reshape(self.hidden, d + 1), self.weights[self.hidden * (d + 1):]
        total = F.lit(float(out[self.hidden]))
        for h in range(self.hidden):
            z = F.lit(float(a[h, d]))
            for f, m, s, w in zip(self.features, self.mean, self.scale, a[h, :d]):
                z = z + (F.col(f).cast("double") - float(m)) / float(s) * float(w)
            total = total + F.tanh(z) * float(out[h])
        return total

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``probability`` of the class and ``prediction`` (1 from one half on); null for a null feature."""
        p = 1 / (1 + F.exp(-self.logit()))
        return df.withColumn("probability", p).withColumn("prediction", (F.col("probability") >= 0.5).cast("int"))


_BLOCK = 8_192  # rows of a block


def blocks(rows: DataFrame, names: list[str], mean: np.ndarray, scale: np.ndarray) -> DataFrame:
    """(x, y): scaled features and classes of up to ``_BLOCK`` rows as bytes of
    floats. A pass then hands bytes to Python, not rows; a task reads one split
    of the written blocks."""
    def pack(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, _BLOCK):
                part = batch.slice(at, _BLOCK)
                X = (np.stack([part.column(c).to_numpy() for c in names], 1) - mean) / scale
                y = part.column("y").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_pydict({"x": [X.astype(np.float32).tobytes()], "y": [y.astype(np.float32).tobytes()]})

    return rows.mapInArrow(pack, "x binary, y binary")


def fit_tanh_network(train: DataFrame, features: list[str], positive: Column, hidden: int = 7, steps: int = 40, rate: float = 1.0, seed: int = 7) -> TanhNetwork:
    """The network of ``positive`` (a boolean column); rows with a null feature
    or class are left out."""
    ship_package(train.sparkSession)
    rows = train.select(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)], positive.alias("y")).dropna()
    rows = cut_lineage(spread(rows))
    names = [f"x{i}" for i in range(len(features))]
    mean, scale = scaling(rows, names)
    packed = cut_lineage(blocks(rows, names, mean, scale))
    size = shapes(len(features), hidden)
    w = np.random.default_rng(seed).normal(size=size) / np.sqrt(len(features) + 1)
    model = TanhNetwork(features, mean, scale, w, hidden)

    def sums(points: list[np.ndarray]) -> list[tuple[float, np.ndarray]]:
        """Mean loss and gradient at each point, by one aggregate."""
        def run(batches):
            total = np.zeros(len(points) * (size + 1) + 1)
            for batch in batches:
                for x, y in zip(batch.column("x"), batch.column("y")):
                    y = np.frombuffer(y.as_buffer(), np.float32)
                    X = np.frombuffer(x.as_buffer(), np.float32).reshape(len(y), -1)
                    for k, point in enumerate(points):
                        loss, g = loss_and_gradient(point, X, y, hidden)
                        total[k * (size + 1)] += loss
                        total[k * (size + 1) + 1:(k + 1) * (size + 1)] += g
                    total[-1] += len(X)
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in total], [f"s{i}" for i in range(len(total))])

        n = len(points) * (size + 1) + 1
        r = packed.mapInArrow(run, ", ".join(f"s{i} double" for i in range(n))).agg(*[F.sum(f"s{i}") for i in range(n)]).first()
        values = np.array([v or 0.0 for v in r])
        return [(values[k * (size + 1)] / max(values[-1], 1), values[k * (size + 1) + 1:(k + 1) * (size + 1)] / max(values[-1], 1)) for k in range(len(points))]

    (loss, g), = sums([w])
    model.losses.append(loss)
    for _ in range(steps):
        if not np.linalg.norm(g) > 1e-9:
            break
        sizes = [rate * t for t in _TRIES]
        tried = sums([w - s * g for s in sizes])
        best = int(np.argmin([x[0] for x in tried]))
        if tried[best][0] < loss:
            w, rate, (loss, g) = w - sizes[best] * g, sizes[best], tried[best]
            model.losses.append(loss)
        else:
            rate = sizes[0] * _TRIES[0]
    model.weights = w
    return model
