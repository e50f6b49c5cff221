"""SSH auth-log analytics (K2: P1, P4, A7–A13, J1, O1, O2).

One scan of the log produces a projected ``auth`` frame — one row per line
that mentions ``password`` with (month, day, user, ip, accepted, failed,
invalid, weight). Repeated-message lines carry their repeat count as a
weight instead of being exploded, so a line repeated a million times costs
one row. Every statistic is a ``groupBy`` over that frame with partial
aggregation; top-k results use ``orderBy().limit()`` which plans as
``TakeOrderedAndProject`` (no full sort).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import logparse as L


def auth_events(log: DataFrame, line: str = "line") -> DataFrame:
    """P1 + F2/F4/F5/F6: project the password lines into typed columns."""
    c = F.col(line)
    month, day = L.month_day(c)
    return log.filter(c.contains(L.PASSWORD)).select(
        month.alias("month"), day.alias("day"),
        L.username(c).alias("user"), L.ipv4(c).alias("ip"),
        c.contains(L.ACCEPTED).alias("accepted"),
        c.contains(L.FAILED).alias("failed"),
        (c.contains(L.FAILED) & c.contains(L.INVALID)).alias("invalid"),
        L.repeat_count(c).cast("bigint").alias("weight"),
    )


def expand_repeats(auth: DataFrame) -> DataFrame:
    """A7 as rows: one row per logical attempt (only for consumers that need
    it; every aggregate here uses the weight)."""
    return auth.withColumn("_r", F.explode(F.array_repeat(F.lit(1), F.col("weight").cast("int")))) \
               .drop("_r").withColumn("weight", F.lit(1).cast("bigint"))


def _wsum(cond=None):
    w = F.col("weight")
    return F.sum(w if cond is None else F.when(cond, w).otherwise(0)).cast("bigint")


def attempts_by_user(auth: DataFrame) -> DataFrame:
    """Attempts per user for the four populations, one pass."""
    return auth.groupBy("user").agg(
        _wsum().alias("n_all"),
        _wsum(F.col("accepted")).alias("n_accepted"),
        _wsum(F.col("failed")).alias("n_failed"),
        _wsum(F.col("invalid")).alias("n_invalid"),
    )


POPULATIONS = ("all", "accepted", "failed", "invalid")


def top_users(auth: DataFrame) -> DataFrame:
    """Top user per population (ties → smallest name), one row each.
    One aggregate over the per-user counts yields all four winners."""
    per_user = attempts_by_user(auth)
    winners = []
    for p in POPULATIONS:
        n = F.col(f"n_{p}")
        best = F.min(F.when(n > 0, F.struct((-n).alias("o"), F.col("user").alias("u"))))
        winners.append(F.struct(F.lit(p).alias("population"), best.getField("u").alias("user"),
                                (-best.getField("o")).cast("bigint").alias("n")))
    return (per_user.agg(F.array(*winners).alias("w"))
            .select(F.inline("w")).filter(F.col("n").isNotNull()))


def success_rates(auth: DataFrame) -> DataFrame:
    """Accepted / all per user, users with no success drop out (the
    reference's inner join, done as one grouped pass plus a filter)."""
    return (attempts_by_user(auth).filter(F.col("n_accepted") > 0)
            .select("user", "n_all", "n_accepted",
                    F.round(F.col("n_accepted") / F.col("n_all"), 6).alias("rate")))


def argmax_all(df: DataFrame, value: str) -> DataFrame:
    """Every row whose ``value`` equals the maximum (ties kept). The
    maximum is one global aggregate broadcast back as a scalar."""
    mx = df.agg(F.max(value).alias("_mx"))
    return df.join(F.broadcast(mx), F.col(value) == F.col("_mx")).drop("_mx")


def best_success_users(auth: DataFrame) -> DataFrame:
    """A10: users at the maximum success rate."""
    return argmax_all(success_rates(auth).select("user", "rate"), "rate")


def failed_by_ip(auth: DataFrame) -> DataFrame:
    """Failed attempts per source IP (null when the line has none)."""
    return auth.filter("failed").groupBy("ip").agg(_wsum().alias("n"))


def top_ips(auth: DataFrame, k: int = 3) -> DataFrame:
    """O1."""
    return failed_by_ip(auth).orderBy(F.desc("n"), F.asc_nulls_first("ip")).limit(k)


def top_invalid_users(auth: DataFrame, k: int = 10) -> DataFrame:
    """O2."""
    return (auth.filter("invalid").groupBy("user").agg(_wsum().alias("n"))
            .orderBy(F.desc("n"), F.asc_nulls_first("user")).limit(k))


def attempts_by_day(auth: DataFrame) -> DataFrame:
    """A12."""
    return auth.groupBy("month", "day").agg(_wsum().alias("n"))


def busiest_quietest_day(auth: DataFrame) -> DataFrame:
    """Busiest and quietest (month, day); ties → smallest (month, day)."""
    days = attempts_by_day(auth)
    agg = days.agg(
        F.min(F.struct((-F.col("n")).alias("o"), "month", "day")).alias("hi"),
        F.min(F.struct(F.col("n").alias("o"), "month", "day")).alias("lo"),
    )
    rows = F.array(
        F.struct(F.lit("busiest").alias("which"), F.col("hi.month").alias("month"), F.col("hi.day").alias("day"),
                 (-F.col("hi.o")).cast("bigint").alias("n")),
        F.struct(F.lit("quietest").alias("which"), F.col("lo.month").alias("month"), F.col("lo.day").alias("day"),
                 F.col("lo.o").cast("bigint").alias("n")))
    return agg.select(F.inline(rows))  # both rows from the one aggregate


def line_counts(auth: DataFrame) -> DataFrame:
    """A5 for the log: attempts in each population, one row."""
    return auth.agg(
        _wsum().alias("n_password"),
        _wsum(F.col("accepted")).alias("n_accepted"),
        _wsum(F.col("failed")).alias("n_failed"),
        _wsum(F.col("invalid")).alias("n_invalid"),
        F.count(F.lit(1)).cast("bigint").alias("n_lines"),
    )


def partial_counts_first_version(log: DataFrame, line: str = "line") -> DataFrame:
    """A13 (first-version log job, folded per D5): per-user partial counts
    from accepted, failed and repeat lines unioned, then re-summed."""
    c = F.col(line)
    parts = log.filter(c.contains(L.PASSWORD)).select(
        L.username_single_regex(c).alias("user"),
        F.when(c.contains(L.ACCEPTED), 1).otherwise(0).alias("acc"),
        F.when(c.contains(L.FAILED), L.repeat_count(c)).otherwise(0).alias("fail"))
    return parts.groupBy("user").agg(F.sum("acc").cast("bigint").alias("n_accepted"),
                                     F.sum("fail").cast("bigint").alias("n_failed"))
