"""Follow-graph statistics (K1: A1–A6, P2, P3, S18).

The graph is held as two DataFrames: ``users (user_id)`` — one row per
listed user (the lines of the adjacency file) — and ``edges (user_id,
followed)``. Adjacency arrays are never rebuilt: a user that follows a third
of the graph would otherwise become one giant row. All counts are
``groupBy`` with map-side partial aggregation, so a hot user/followed id only
ships one partial row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def follow_counts(users: DataFrame, edges: DataFrame) -> DataFrame:
    """Follows per listed user (0 for users with an empty list).

    Duplicate user lines merge (MapReduce semantics): counts are summed."""
    per_user = edges.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    listed = users.select("user_id").distinct()
    return (listed.join(per_user, "user_id", "left")
            .select("user_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def follower_counts(users: DataFrame, edges: DataFrame, include_zero: bool = False) -> DataFrame:
    """A2/A3: followers per id. With ``include_zero`` every listed user is
    seeded with 0 so users nobody follows appear (MapReduce semantics)."""
    hits = edges.select(F.col("followed").alias("user_id"), F.lit(1).alias("w"))
    if include_zero:
        seeds = users.select("user_id", F.lit(0).alias("w"))
        hits = hits.unionByName(seeds)
    return hits.groupBy("user_id").agg(F.sum("w").cast("bigint").alias("n"))


def degree_summary(counts: DataFrame, key: str = "user_id", value: str = "n") -> DataFrame:
    """A4: one row (max_id, max_n, avg_n, n_zero, min_id, min_n).

    Ties on the maximum/minimum go to the smallest key (D3). One global
    aggregate: partial per task, one final row."""
    k, v = F.col(key), F.col(value)
    best = F.min(F.struct((-v).alias("o"), k.alias("k")))
    worst = F.min(F.struct(v.alias("o"), k.alias("k")))
    return counts.agg(
        best.getField("k").cast("bigint").alias("max_id"),
        F.max(v).cast("bigint").alias("max_n"),
        F.round(F.avg(v.cast("double")), 6).alias("avg_n"),
        F.count_if(v == 0).cast("bigint").alias("n_zero"),
        worst.getField("k").cast("bigint").alias("min_id"),
        F.min(v).cast("bigint").alias("min_n"),
    )


def follows_report(users: DataFrame, edges: DataFrame) -> DataFrame:
    """The follows summary plus user count as (metric, value) rows."""
    counts = follow_counts(users, edges)
    one = counts.agg(
        F.count(F.lit(1)).cast("double").alias("n_users"),
        F.max("n").cast("double").alias("max_n"),
        F.round(F.avg(F.col("n").cast("double")), 6).alias("avg_n"),
        F.count_if(F.col("n") == 0).cast("double").alias("n_zero"),
    )
    return one.unpivot([], ["n_users", "max_n", "avg_n", "n_zero"], "metric", "value")


def mean_followers(users: DataFrame, edges: DataFrame, denominator: str = "ids") -> DataFrame:
    """Mean followers per id. ``ids`` divides by every distinct id
    (listed users and followed-only ids, the MapReduce meaning); ``lines``
    divides by the number of listed users (input lines, the RDD meaning)."""
    total = edges.agg(F.count(F.lit(1)).cast("double").alias("total"))
    if denominator == "ids":
        den = follower_counts(users, edges, include_zero=True).agg(F.count(F.lit(1)).alias("den"))
    elif denominator == "lines":
        den = users.agg(F.count(F.lit(1)).alias("den"))
    else:
        raise ValueError(denominator)
    from tidewater.operators.common import attach_scalars
    return attach_scalars(total, den).select(F.round(F.col("total") / F.col("den"), 6).alias("mean_followers"))
