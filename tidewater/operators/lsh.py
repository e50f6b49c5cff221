"""Random-hyperplane LSH top-k.

``topk_probed`` probes by Hamming balls. Signatures of ``superbit_planes`` (512
bits, 64 bytes a row whatever the dimension) order all rows by the number of
planes between them and the query; a query's ball grows until it holds
``probe_rows`` rows, about the square root of the data, and only those are
compared exactly. Radii come from counts of distances, so they are the same
however the rows are split: one scan counts, a second one scores. ``topk_lsh``
is the plain scheme of equal buckets in one of several tables.

Both write the query set, of any size, once to the shared folder and read it
block by block beside bounded segments of the data. Neither side is shuffled by
bucket, so a bucket with a third of the data costs no skew, and no candidate
pair leaves a task; a ``row_number() ≤ k`` merges the segments' top k. The column
functions ``signature`` and ``bucket_keys`` give signatures and buckets as
expressions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators.knn import dot, matrix, query_blocks, segments, write_queries
from tidewater.session import ship_package, spread

_NOTHING = -2**63  # excludes no id
_ROW_BLOCK = 16_384  # rows per block of distances


def lsh_params(dim: int, n_planes: int = 32, n_tables: int = 8, seed: int = 42):
    """(planes D×dim, positions L×D, 0-based). Gaussian planes normalised to
    unit length (the sign test is unaffected); positions are an order of all
    planes for each table, so no bit repeats in a bucket."""
    rs = np.random.RandomState(seed)
    planes = rs.normal(size=(n_planes, dim))
    planes /= np.linalg.norm(planes, axis=1, keepdims=True)
    positions = np.stack([rs.permutation(n_planes) for _ in range(n_tables)])
    return planes, positions


def lsh_bits(n_rows: int, least: int = 8, most: int = 32) -> int:
    """Bits of a bucket: log2 of the data, rounded up, within bounds."""
    return max(least, min(most, max(0, n_rows - 1).bit_length()))


def superbit_planes(dim: int, n_planes: int = 512, seed: int = 42) -> np.ndarray:
    """Gaussian planes, orthogonal within each run of ``dim`` (which makes the
    share of planes between two vectors a better estimate of their angle)."""
    rs, out = np.random.RandomState(seed), []
    for begin in range(0, n_planes, dim):
        out.append(np.linalg.qr(rs.normal(size=(dim, dim)))[0].T[:n_planes - begin])
    return np.round(np.concatenate(out), 9)


def probe_rows(n_rows: int, k: int = 3) -> int:
    """Rows that a query's ball holds at least: the square root of the data,
    four times the result or 16."""
    return max(16, 4 * k, math.ceil(math.sqrt(n_rows)))


def signature(vec: Column, planes: np.ndarray) -> Column:
    """one bit per hyperplane, 1 when the dot product is ≥ 0."""
    lit_planes = F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in planes])
    return F.transform(lit_planes, lambda p: F.when(dot(vec, p) >= 0, 1).otherwise(0))


def bucket_keys(sig: Column, positions: np.ndarray) -> Column:
    """per table, the bits at its chosen positions joined as a string."""
    keys = []
    for t, pos in enumerate(positions):
        b = F.concat(*[F.element_at(sig, int(i) + 1).cast("string") for i in pos])
        keys.append(F.struct(F.lit(t).alias("t"), b.alias("b")))
    return F.array(*keys)


def _buckets(X: np.ndarray, planes: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """(tables × rows) bucket numbers."""
    bits = (X @ planes.T >= 0).astype(np.int64)
    weights = 1 << np.arange(positions.shape[1], dtype=np.int64)
    return np.stack([bits[:, p] @ weights for p in positions])


def topk_lsh(data: DataFrame, queries: DataFrame, k: int, planes: np.ndarray, positions: np.ndarray,
             id_col: str = "id", vec_col: str = "vec", unit_col: str = "unit",
             q_id: str = "q_id", exclude_col: str | None = None, query_block: int = 1_024) -> DataFrame:
    """(q_id, id, sim, rank): the k most similar candidates sharing a bucket
    with the query in at least one table; ``exclude_col`` holds each query's
    own data id. Rows and queries without a unit vector match nothing."""
    ship_package(data.sparkSession)
    excl = F.coalesce(F.col(exclude_col).cast("bigint"), F.lit(_NOTHING)) if exclude_col else F.lit(_NOTHING)
    files = write_queries(queries.filter(F.col(unit_col).isNotNull())
                          .select(F.col(q_id).cast("bigint").alias("q_id"), F.col(vec_col).cast("array<double>").alias("qv"),
                                  F.col(unit_col).cast("array<double>").alias("qu"), excl.alias("excl")))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment in segments(batches):
            U, ids = matrix(segment.column("u").combine_chunks()), segment.column("id").to_numpy()
            codes = _buckets(matrix(segment.column("v").combine_chunks()), planes, positions)
            order = np.argsort(codes, axis=1, kind="stable")
            codes = np.take_along_axis(codes, order, 1)
            for block in query_blocks(files, query_block):
                Q, wanted = matrix(block.column("qu")), _buckets(matrix(block.column("qv")), planes, positions)
                begin = np.stack([np.searchsorted(c, w, "left") for c, w in zip(codes, wanted)])
                end = np.stack([np.searchsorted(c, w, "right") for c, w in zip(codes, wanted)])
                out = ([], [], [])
                for j, (q, excl) in enumerate(zip(block.column("q_id").to_pylist(), block.column("excl").to_pylist())):
                    near = np.unique(np.concatenate([o[a:b] for o, a, b in zip(order, begin[:, j], end[:, j])]))
                    near = near[ids[near] != excl]
                    sims = U[near] @ Q[j]
                    top = np.lexsort((ids[near], -sims))[:k]
                    out[0].append(np.full(len(top), q))
                    out[1].append(ids[near][top])
                    out[2].append(sims[top])
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["q_id", "id", "sim"])

    rows = data.filter(F.col(unit_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("v"), F.col(unit_col).alias("u"))
    cand = spread(rows).mapInArrow(scan, "q_id bigint, id bigint, sim double")
    w = Window.partitionBy("q_id").orderBy(F.desc("sim"), F.asc("id"))
    return cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _codes(X: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Signatures as rows of 64-bit words."""
    packed = np.packbits(X @ planes.T >= 0, axis=1)
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)


def _hamming(codes: np.ndarray, wanted: np.ndarray, ids: np.ndarray, excl: np.ndarray, far: int) -> np.ndarray:
    """(queries × rows) planes between them; ``far`` for a query's own row."""
    out = np.zeros((len(wanted), len(codes)), np.uint16)
    for w in range(codes.shape[1]):
        out += np.bitwise_count(wanted[:, w, None] ^ codes[None, :, w])
    out[excl[:, None] == ids[None, :]] = far
    return out


def topk_probed(data: DataFrame, queries: DataFrame, k: int, planes: np.ndarray, n_probe: int,
                id_col: str = "id", vec_col: str = "vec", unit_col: str = "unit",
                q_id: str = "q_id", exclude_col: str | None = None, query_block: int = 256) -> DataFrame:
    """(q_id, id, sim, rank): the k most similar rows of each query's ball, the
    smallest Hamming ball of signatures with at least ``n_probe`` rows (all
    rows if there are fewer). ``exclude_col`` holds each query's own data id,
    which its ball doesn't count. Rows and queries without a unit vector match
    nothing. A query is one row of ``queries``; ``q_id`` must be unique."""
    ship_package(data.sparkSession)
    bits = len(planes)
    excl = F.coalesce(F.col(exclude_col).cast("bigint"), F.lit(_NOTHING)) if exclude_col else F.lit(_NOTHING)
    wanted = queries.filter(F.col(unit_col).isNotNull()).select(F.col(q_id).cast("bigint").alias("q_id"), F.col(unit_col).cast("array<double>").alias("qu"), excl.alias("excl"))
    files = write_queries(wanted)

    def blocks(batches, files):
        """Each block of queries beside each bounded part of the rows."""
        for segment in segments(batches, "u"):
            U, ids = matrix(segment.column("u").combine_chunks()), segment.column("id").to_numpy()
            codes = _codes(U, planes)
            for block in query_blocks(files, query_block):
                Q = matrix(block.column("qu"))
                yield block, Q, _codes(Q, planes), block.column("excl").to_numpy(), U, ids, codes

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, Q, sig, excl, _, ids, codes in blocks(batches, files):
            seen = np.zeros((len(Q), bits + 2), np.int64)
            for s in range(0, len(ids), _ROW_BLOCK):
                near = _hamming(codes[s:s + _ROW_BLOCK], sig, ids[s:s + _ROW_BLOCK], excl, bits + 1).astype(np.int64)
                seen += np.bincount((near + np.arange(len(Q))[:, None] * (bits + 2)).ravel(), minlength=seen.size).reshape(seen.shape)
            seen[:, bits + 1] = 0
            before = np.cumsum(seen, axis=1) - seen
            q, d = np.nonzero((before < n_probe) & (seen > 0))
            if len(q):
                yield pa.RecordBatch.from_arrays([block.column("q_id").take(pa.array(q)), pa.array(d.astype(np.int32)), pa.array(seen[q, d])], ["q_id", "d", "n"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, Q, sig, excl, U, ids, codes in blocks(batches, balls):
            radius, out = block.column("radius").to_numpy(), ([], [], [])
            hit = [[] for _ in range(len(Q))]
            for s in range(0, len(ids), _ROW_BLOCK):
                q, row = np.nonzero(_hamming(codes[s:s + _ROW_BLOCK], sig, ids[s:s + _ROW_BLOCK], excl, bits + 1) <= radius[:, None])
                for j, rows in zip(*_runs(q, row + s)):
                    hit[j].append(rows)
            for j, qid in enumerate(block.column("q_id").to_pylist()):
                near = np.concatenate(hit[j]) if hit[j] else np.empty(0, np.int64)
                sims = U[near] @ Q[j]
                top = np.lexsort((ids[near], -sims))[:k]
                for column, values in zip(out, (np.full(len(top), qid), ids[near][top], sims[top])):
                    column.append(values)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["q_id", "id", "sim"])

    rows = spread(data.filter(F.col(unit_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(unit_col).alias("u")))
    seen = rows.mapInArrow(count, "q_id bigint, d int, n bigint").groupBy("q_id", "d").agg(F.sum("n").alias("n"))
    so_far = Window.partitionBy("q_id").orderBy("d").rowsBetween(Window.unboundedPreceding, -1)
    # the first distance that completes the ball is the last one that it begins with too few rows
    radius = seen.withColumn("before", F.coalesce(F.sum("n").over(so_far), F.lit(0))).filter(F.col("before") < n_probe).groupBy("q_id").agg(F.max("d").alias("radius"))
    balls = write_queries(wanted.join(radius, "q_id"))
    cand = rows.mapInArrow(score, "q_id bigint, id bigint, sim double")
    w = Window.partitionBy("q_id").orderBy(F.desc("sim"), F.asc("id"))
    return cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _runs(groups: np.ndarray, values: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Each group (ascending) and its values."""
    begin = np.flatnonzero(np.diff(groups, prepend=-1))
    return groups[begin].tolist(), np.split(values, begin[1:]) if len(begin) else []


def superbits_sql(planes: np.ndarray) -> str:
    """The signatures of ``e`` (vec_id, v) as bit strings, for an independent oracle."""
    rows = ", ".join(f"({i}, [{', '.join(repr(float(x)) for x in row)}]::DOUBLE[])" for i, row in enumerate(planes))
    return f"""superbits(pid, p) AS (VALUES {rows}),
codes AS (SELECT e.vec_id, string_agg(CASE WHEN list_inner_product(e.v, p) >= 0 THEN '1' ELSE '0' END, '' ORDER BY pid)::BIT AS code FROM e, superbits GROUP BY e.vec_id)"""


def params_sql(planes: np.ndarray, positions: np.ndarray) -> str:
    """The same parameters as SQL VALUES lists (for an independent oracle)."""
    pl = ", ".join(f"({i}, [{', '.join(repr(float(x)) for x in row)}]::DOUBLE[])" for i, row in enumerate(planes))
    ps = ", ".join(f"({t}, [{', '.join(str(int(i) + 1) for i in row)}])" for t, row in enumerate(positions))
    return f"planes(pid, p) AS (VALUES {pl}),\ntables(t, idx) AS (VALUES {ps})"
