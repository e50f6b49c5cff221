"""Exact nearest neighbours without every distance.

A segment of rows gets pivots (rows far from each other); every row belongs to
its nearest pivot and lies there by its distance to it. For a query the distance
to a pivot bounds that to the pivot's rows by the triangle inequality: rows
whose own distance differs from the query's by more than the k-th distance known
so far can't be nearer, so only a range of each pivot's rows is compared, and
pivots whose every row is too far are passed over. The first bound is certified
before any row is compared: a pivot at distance d with k rows within r has k rows
within d + r. Ties are kept (bounds are widened by a rounding allowance), so the
result is that of the full scan. On data without clusters all pairs are compared,
besides those with the pivots.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators.knn import _NOTHING, matrix, query_blocks, segments, write_queries
from tidewater.session import ship_package, spread

_SLACK = 1e-9  # relative allowance for rounding


class PivotIndex:
    """Rows of a segment by their nearest pivot and the distance to it."""

    def __init__(self, X: np.ndarray, ids: np.ndarray, n_pivots: int | None = None):
        n = len(X)
        k = max(1, min(n, n_pivots or int(np.sqrt(n))))
        # farthest first: each pivot is the row farthest from the ones before
        nearest = np.linalg.norm(X - X[0], axis=1)
        owner = np.zeros(n, np.int64)
        pivots = [0]
        for p in range(1, k):
            far = int(nearest.argmax())
            if nearest[far] == 0:
                break
            pivots.append(far)
            d = np.linalg.norm(X - X[far], axis=1)
            closer = d < nearest
            owner[closer], nearest[closer] = p, d[closer]
        order = np.lexsort((nearest, owner))
        self.pivots = X[pivots]
        self.X, self.ids, self.away = X[order], ids[order], nearest[order]
        self.begin = np.searchsorted(owner[order], np.arange(len(pivots) + 1))
        self.compared = 0  # distances to rows and pivots

    def search(self, q: np.ndarray, k: int, exclude: int = _NOTHING) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the k nearest rows but ``exclude``, by distance and id."""
        to = np.linalg.norm(self.pivots - q, axis=1)
        self.compared += len(to)
        sizes = np.diff(self.begin)
        # one row more than k may be the excluded one
        enough = np.flatnonzero(sizes > k)
        bound = (to[enough] + self.away[self.begin[enough] + k]).min() if len(enough) else np.inf
        least = np.maximum(to - self.away[self.begin[1:] - 1], 0)
        found_d, found_i = np.empty(0), np.empty(0, np.int64)
        for p in np.argsort(least, kind="stable"):
            limit = bound * (1 + _SLACK) + _SLACK
            if least[p] > limit:
                break
            a, b = self.begin[p], self.begin[p + 1]
            i = a + np.searchsorted(self.away[a:b], to[p] - limit, "left")
            j = a + np.searchsorted(self.away[a:b], to[p] + limit, "right")
            if i >= j:
                continue
            d, ids = np.sqrt(((self.X[i:j] - q) ** 2).sum(axis=1)), self.ids[i:j]
            self.compared += j - i
            other = ids != exclude
            found_d, found_i = np.concatenate([found_d, d[other]]), np.concatenate([found_i, ids[other]])
            if len(found_d) > k:
                best = np.lexsort((found_i, found_d))[:k]
                found_d, found_i = found_d[best], found_i[best]
            if len(found_d) == k:
                bound = min(bound, found_d.max())
        best = np.lexsort((found_i, found_d))[:k]
        return found_i[best], found_d[best]


def knn_by_pivots(data: DataFrame, queries: DataFrame, k: int, id_col: str = "id", vec_col: str = "vec",
                  q_id: str = "q_id", q_vec: str = "vec", exclude_col: str | None = None) -> DataFrame:
    """(q_id, id, d, rank): as ``knn`` with the Euclidean metric. For cosine
    give unit vectors on both sides; the similarity is 1 - d² / 2."""
    ship_package(data.sparkSession)
    excl = F.coalesce(F.col(exclude_col).cast("bigint"), F.lit(_NOTHING)) if exclude_col else F.lit(_NOTHING)
    files = write_queries(queries.filter(F.col(q_vec).isNotNull())
                          .select(F.col(q_id).cast("bigint").alias("q_id"), F.col(q_vec).cast("array<double>").alias("qv"), excl.alias("excl")))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment in segments(batches):
            index = PivotIndex(matrix(segment.column("v").combine_chunks()), segment.column("id").to_numpy())
            for block in query_blocks(files, 256):
                out = ([], [], [])
                for q, vec, own in zip(block.column("q_id").to_pylist(), matrix(block.column("qv")), block.column("excl").to_pylist()):
                    ids, d = index.search(vec, k, own)
                    for column, values in zip(out, (np.full(len(ids), q), ids, d)):
                        column.append(values)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["q_id", "id", "d"])

    rows = spread(data.filter(F.col(vec_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("v")))
    w = Window.partitionBy("q_id").orderBy("d", "id")
    cand = rows.mapInArrow(scan, "q_id bigint, id bigint, d double")
    return cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
