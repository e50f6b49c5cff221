"""Exact geographic k-nearest neighbours for large query sets (J8 at scale).

The scan in ``knn`` computes all |Q|·|X| distances. This operator compares
only neighbours: points and queries are bucketed into
lat/lon cells and meet in an equi-grouped co-group, cell by cell.

* Each query is replicated to the cells of a square ring of half-width r
  around its own cell; both sides are co-grouped by (cell, point-salt,
  query-salt) and a NumPy kernel emits only each query's local top-k, so no
  pair table is built.
* Hot cells are salted on both sides — a cell with ``n`` points gets
  ``ceil(n / max_points)`` point salts, and queries are split the same way —
  so no group holds more than ``max_points`` points or ``max_queries``
  queries, however skewed the data.
* A result is certified exact when its k-th distance is below a lower bound
  on the distance to anything outside the searched block (latitude-band and
  meridian distances on the unit sphere). Uncertified queries go to the next,
  wider ring; no ring runs when none is left, and after the last ring the few
  left are finished by the exact scan.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators import knn as K
from tidewater.session import cut_lineage, ship_package

_OUT = T.StructType([T.StructField("q_id", T.LongType()), T.StructField("id", T.LongType()),
                     T.StructField("d", T.DoubleType())])


def _cells(df: DataFrame, s: float, ncx: int) -> DataFrame:
    return (df.withColumn("cy", F.floor((F.col("lat") + 90.0) / s).cast("int"))
              .withColumn("cx", F.pmod(F.floor((F.col("lon") + 180.0) / s), F.lit(ncx)).cast("int")))


def _kernel(k: int):
    def run(qs: pd.DataFrame, ps: pd.DataFrame) -> Iterator[pd.DataFrame]:
        if len(qs) == 0 or len(ps) == 0:
            return pd.DataFrame({"q_id": [], "id": [], "d": []})
        X = np.radians(ps[["lat", "lon"]].to_numpy(dtype=np.float64))
        Q = np.radians(qs[["qlat", "qlon"]].to_numpy(dtype=np.float64))
        ids = ps["id"].to_numpy(dtype=np.int64)
        qids = qs["q_id"].to_numpy(dtype=np.int64)
        out = []
        for s in range(0, len(Q), 256):
            D = K._distances("haversine", X, Q[s:s + 256], None)
            out.append(K._local_topk(ids, D, k, qids[s:s + 256], None))
        return pd.concat(out, ignore_index=True)
    return run


def _bound(r: int, s: float) -> F.Column:
    """Lower bound (radians) on the distance from the query to any point
    outside its (2r+1)² block of cells."""
    lat, lon = F.col("qlat"), F.col("qlon")
    cy = F.floor((lat + 90.0) / s)
    cx = F.floor((lon + 180.0) / s)
    lat_lo, lat_hi = (cy - r) * s - 90.0, (cy + r + 1) * s - 90.0
    inf = F.lit(float("inf"))
    b_lat = F.least(F.when(lat_lo <= -90.0, inf).otherwise(F.radians(lat - lat_lo)),
                    F.when(lat_hi >= 90.0, inf).otherwise(F.radians(lat_hi - lat)))
    if (2 * r + 1) * s >= 360.0:
        b_lon = inf
    else:
        dmin = F.least(lon - ((cx - r) * s - 180.0), ((cx + r + 1) * s - 180.0) - lon)
        b_lon = F.asin(F.cos(F.radians(lat)) * F.sin(F.radians(F.least(dmin, F.lit(90.0)))))
    return F.least(b_lat, b_lon)


def nn_grid(points: DataFrame, queries: DataFrame, k: int = 1, cell_deg: float | None = None,
            target_per_cell: int = 32, max_points: int = 20_000, max_queries: int = 20_000,
            rings: tuple[int, ...] = (1, 3, 9)) -> DataFrame:
    """(q_id, id, d, rank): exact k nearest ``points (id, lat, lon)`` in
    degrees for every ``queries (q_id, lat, lon)``; d in radians of arc."""
    spark = points.sparkSession
    ship_package(spark)
    if cell_deg is None:  # cells sized so an average cell holds ~target_per_cell points
        n = points.count()
        cell_deg = min(30.0, max(0.01, math.sqrt(41253.0 * target_per_cell / max(n, 1))))
    # whole number of cells around the globe, so the longitude wrap is exact
    ncx = int(math.ceil(360.0 / float(cell_deg)))
    s = 360.0 / ncx
    P = _cells(points.select(F.col("id").cast("bigint"), F.col("lat").cast("double"),
                             F.col("lon").cast("double")), s, ncx)
    pcount = P.groupBy("cy", "cx").agg(F.count(F.lit(1)).alias("np"))
    P = (P.join(pcount, ["cy", "cx"])
         .withColumn("psalt", F.pmod(F.xxhash64("id"), F.ceil(F.col("np") / max_points)).cast("int")))
    pending = queries.select(F.col("q_id").cast("bigint"), F.col("lat").cast("double").alias("qlat"),
                             F.col("lon").cast("double").alias("qlon"))
    done = []
    w = Window.partitionBy("q_id").orderBy("d", "id")
    for r in rings:
        off = F.array(*[F.lit(i) for i in range(-r, r + 1)])
        Q = (pending.withColumn("qcy", F.floor((F.col("qlat") + 90.0) / s).cast("int"))
             .withColumn("qcx", F.floor((F.col("qlon") + 180.0) / s).cast("int"))
             .withColumn("cy", F.explode(F.transform(off, lambda d: F.col("qcy") + d)))
             .filter((F.col("cy") >= 0) & (F.col("cy") * s < 180.0))
             .withColumn("cx", F.explode(F.array_distinct(F.transform(off, lambda d: F.pmod(F.col("qcx") + d,
                                                                                             F.lit(ncx)))))))
        # only cells that hold points matter; their salts come with them
        Q = Q.join(pcount, ["cy", "cx"])
        qcount = Q.groupBy("cy", "cx").agg(F.count(F.lit(1)).alias("nq"))
        Q = (Q.join(qcount, ["cy", "cx"])
             .withColumn("qsalt", F.pmod(F.xxhash64("q_id"), F.ceil(F.col("nq") / max_queries)).cast("int"))
             .withColumn("psalt", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("np") / max_points) - 1).cast("int")))))
        Pr = (P.join(qcount, ["cy", "cx"])
              .withColumn("qsalt", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("nq") / max_queries) - 1)
                                                        .cast("int")))))
        keys = ["cy", "cx", "psalt", "qsalt"]
        part = (Q.select(*keys, "q_id", "qlat", "qlon").groupBy(*keys)
                .cogroup(Pr.select(*keys, "id", "lat", "lon").groupBy(*keys))
                .applyInPandas(_kernel(k), _OUT))
        # per-ring results are |Q|·k rows: cut lineage (reliable checkpoint in
        # the shared folder) so later rings never recompute earlier ones
        top = cut_lineage(part.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k))
        kth = top.groupBy("q_id").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("dk"))
        judged = cut_lineage(pending.join(kth, "q_id", "left")
                             .withColumn("ok", (F.col("n") == k) & (F.col("dk") < _bound(r, s) - F.lit(1e-12))))
        ok_ids = judged.filter("ok").select("q_id")
        done.append(top.join(ok_ids, "q_id", "left_semi"))
        pending = judged.filter(~F.coalesce(F.col("ok"), F.lit(False))).select("q_id", "qlat", "qlon")
        if pending.isEmpty():
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    if pending.isEmpty():
        return out
    # whatever is left (queries far from every point) is finished by the scan
    data = points.select(F.col("id").cast("bigint"),
                         F.array(F.radians("lat"), F.radians("lon")).alias("vec"))
    rest_q = pending.select("q_id", F.array(F.radians("qlat"), F.radians("qlon")).alias("vec"))
    rest = K.knn(data, rest_q, k, "haversine")
    return out.unionByName(rest.select("q_id", "id", "d", "rank"))
