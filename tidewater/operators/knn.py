"""Exact k-nearest-neighbour scan (J7–J10 and the geo J8).

Plan: the query set, of any size, is written once to the shared folder. The
data side is scanned once with ``mapInArrow``: a task holds a segment of its
partition (bounded in bytes), reads the query table block by block, computes
each block of distances with NumPy and emits only the segment's top-k per
query, so no pair table is built, no cross join appears in the plan, and
neither the driver nor a broadcast holds the queries. A final ``row_number() ≤
k`` per query merges the partial lists (Spark plans this with a partial
window-group limit before the shuffle). Ties are broken by the smaller data id.
"""

from __future__ import annotations

from collections.abc import Iterator

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import shared_file, shared_path, ship_package, spread

METRICS = ("euclidean", "euclidean_expanded", "cosine", "haversine")
_QUERY_BLOCK = 256  # queries per distance block inside a task (bounds task memory)
_DATA_BLOCK = 8_192  # data rows per distance block
_SEGMENT_BYTES = 64 << 20  # vectors that a task holds at a time
_NOTHING = -2**63  # excludes no id


def _distances(metric: str, X: np.ndarray, Q: np.ndarray, xsq: np.ndarray | None) -> np.ndarray:
    """(n × q) matrix where smaller is better."""
    if metric == "euclidean":  # direct differences, one query at a time (n × d memory)
        return np.stack([np.sqrt(((X - q) ** 2).sum(axis=1)) for q in Q], axis=1)
    if metric == "euclidean_expanded":
        qsq = (Q * Q).sum(axis=1)
        d2 = xsq[:, None] + qsq[None, :] - 2.0 * (X @ Q.T)
        return np.sqrt(np.maximum(d2, 0.0))
    if metric == "cosine":  # rows are unit vectors: distance = −similarity
        return -(X @ Q.T)
    if metric == "haversine":  # columns (lat, lon) in radians, unit sphere
        dlat = X[:, None, 0] - Q[None, :, 0]
        dlon = X[:, None, 1] - Q[None, :, 1]
        a = np.sin(dlat / 2) ** 2 + np.cos(X[:, None, 0]) * np.cos(Q[None, :, 0]) * np.sin(dlon / 2) ** 2
        return 2.0 * np.arcsin(np.sqrt(np.clip(a, 0.0, 1.0)))
    raise ValueError(metric)


def _local_topk(ids: np.ndarray, D: np.ndarray, k: int, qids: np.ndarray,
                excl: np.ndarray | None) -> pd.DataFrame:
    """Top-k (smallest D, then smallest id) of each column of D."""
    out_q, out_i, out_d = [], [], []
    n = len(ids)
    for j in range(D.shape[1]):
        d = D[:, j]
        if excl is not None:
            d = np.where(ids == excl[j], np.inf, d)
        if n > k:
            kth = np.partition(d, k - 1)[k - 1]
            cand = np.nonzero(d <= kth)[0]  # keeps every tie at the boundary
        else:
            cand = np.arange(n)
        cand = cand[np.isfinite(d[cand])]
        order = np.lexsort((ids[cand], d[cand]))[:k]
        sel = cand[order]
        out_q.append(np.full(len(sel), qids[j]))
        out_i.append(ids[sel])
        out_d.append(d[sel])
    if not out_q:
        return pd.DataFrame({"q_id": [], "id": [], "d": []})
    return pd.DataFrame({"q_id": np.concatenate(out_q), "id": np.concatenate(out_i),
                         "d": np.concatenate(out_d)})


def matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls as rows of doubles, from its flat values."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def write_queries(queries: DataFrame) -> list[str]:
    """Write a query table once; returns its files, which all tasks read."""
    spark = queries.sparkSession
    path = shared_path(spark, f"queries/{uuid.uuid4().hex}")
    queries.write.parquet(path)
    return sorted(spark.read.schema(queries.schema).parquet(path).inputFiles())


def query_blocks(files: list[str], size: int) -> Iterator[pa.RecordBatch]:
    """The written queries, ``size`` at a time."""
    for uri in files:
        with shared_file(uri) as file:
            yield from pq.ParquetFile(file).iter_batches(batch_size=size)


def segments(batches: Iterator[pa.RecordBatch], vec: str = "v", most: int = _SEGMENT_BYTES) -> Iterator[pa.Table]:
    """A partition in runs of about ``most`` bytes of vectors."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.column(vec).nbytes
        if size > most:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def knn(data: DataFrame, queries: DataFrame, k: int, metric: str,
        id_col: str = "id", vec_col: str = "vec", q_id: str = "q_id", q_vec: str = "vec",
        exclude_col: str | None = None) -> DataFrame:
    """(q_id, id, d, rank) for the k nearest data rows of every query.

    ``data``: (id bigint, vec array<double|float>) — for ``haversine`` the
    vector is [lat, lon] in radians; for ``cosine`` both sides must already be
    unit vectors and ``d`` is the negated similarity. ``exclude_col`` names a
    query column holding a data id that must not be returned (the query's
    own row). Rows and queries without a vector match nothing."""
    if metric not in METRICS:
        raise ValueError(metric)
    ship_package(data.sparkSession)
    excl = F.coalesce(F.col(exclude_col).cast("bigint"), F.lit(_NOTHING)) if exclude_col else F.lit(_NOTHING)
    files = write_queries(queries.filter(F.col(q_vec).isNotNull())
                          .select(F.col(q_id).cast("bigint").alias("q_id"), F.col(q_vec).cast("array<double>").alias("qv"), excl.alias("excl")))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment in segments(batches):
            X = matrix(segment.column("v").combine_chunks())
            ids = segment.column("id").to_numpy()
            xsq = (X * X).sum(axis=1) if metric == "euclidean_expanded" else None
            for block in query_blocks(files, _QUERY_BLOCK):
                Q = matrix(block.column("qv"))
                qids, excl = block.column("q_id").to_numpy(), block.column("excl").to_numpy()
                best = pd.concat([_local_topk(ids[s:s + _DATA_BLOCK], _distances(metric, X[s:s + _DATA_BLOCK], Q, None if xsq is None else xsq[s:s + _DATA_BLOCK]),
                                              k, qids, excl) for s in range(0, len(X), _DATA_BLOCK)], ignore_index=True)
                if len(X) > _DATA_BLOCK:
                    best = best.sort_values(["q_id", "d", "id"], kind="mergesort").groupby("q_id", sort=False).head(k)
                if len(best):
                    yield pa.RecordBatch.from_pandas(best.astype({"q_id": "int64", "id": "int64", "d": "float64"}), preserve_index=False)

    d = spread(data.filter(F.col(vec_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("v")))
    cand = d.mapInArrow(scan, "q_id bigint, id bigint, d double")
    w = Window.partitionBy("q_id").orderBy("d", "id")
    return cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def lookup_queries(rows: DataFrame, words: DataFrame, key: str = "word", check: bool = True) -> DataFrame:
    """Word → row lookup for a query word list of any size. An unknown
    word is an error, as in the reference."""
    w = words.select(key).distinct()
    if check:
        missing = w.join(rows.select(key), key, "left_anti").limit(1).collect()
        if missing:
            raise KeyError(f"unknown query word {missing[0][key]!r}")
    return rows.join(w, key)


def check_labels(result: DataFrame, expected: DataFrame, q_id: str = "q_id", found: str = "found") -> DataFrame:
    """Number of queries and of those whose result (q_id, found) is not
    the expected one (q_id, expected); a missing result is an error."""
    j = expected.join(result.select(F.col(q_id).alias("q_id"), F.col(found).alias("_found")), "q_id", "left")
    return j.agg(F.count(F.lit(1)).cast("bigint").alias("n_queries"),
                 F.count_if(~F.col("_found").eqNullSafe(F.col("expected"))).cast("bigint").alias("n_errors"))


# --- vector helpers (F11, A27, centroids) -----------------------------------

def dot(a, b):
    """dot product of two array columns (JVM higher-order functions)."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(v):
    return F.sqrt(F.aggregate(F.transform(v, lambda x: x.cast("double") * x.cast("double")),
                              F.lit(0.0), lambda acc, x: acc + x))


def l2_normalize(df: DataFrame, vec: str = "vec", out: str = "unit") -> DataFrame:
    """Unit vectors; a zero vector gets a null (D8) instead of NaNs."""
    n = l2_norm(F.col(vec))
    return df.withColumn("norm", n).withColumn(
        out, F.when(F.col("norm") > 0, F.transform(F.col(vec), lambda x: x.cast("double") / F.col("norm"))))


def centroids(df: DataFrame, key: str, vec: str) -> DataFrame:
    """Mean vector per key. Element-wise means by a grouped aggregate over
    (key, position) with partial aggregation; re-assembled per key (the
    array has ``dim`` entries, a bound set by the data's dimension)."""
    e = df.select(key, F.posexplode(vec).alias("pos", "x"))
    m = e.groupBy(key, "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return m.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias(vec))
