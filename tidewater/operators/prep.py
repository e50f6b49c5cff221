"""Row preparation, splitting and sampling (P5–P10, A26, O8, SA1, SA2).

Splits, shuffles and samples are keyed on an md5 hash of (id, seed), so they
are repeatable, need no coordination between tasks, and can be checked by
any SQL engine. Nothing here shuffles except the optional ordering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.text import portable_hash32


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """P6."""
    return df.dropna(how="any", subset=subset)


def map_codes(col: Column, names: list[str], base: int = 1) -> Column:
    """Integer code → label (``names[code - base]``); out of range → null."""
    arr = F.array(*[F.lit(n) for n in names])
    idx = (col.cast("int") - base + 1)
    return F.when((idx >= 1) & (idx <= len(names)), F.element_at(arr, idx))


def binarize(col: Column, positive) -> Column:
    """P9."""
    return (col == F.lit(positive)).cast("double")


def log_target(col: Column) -> Column:
    """P10."""
    return F.log(col)


def standardize_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, mean, std_pop) — one aggregate pass over all columns."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}__mean").alias("mean"),
                              F.col(f"{c}__std").alias("std")) for c in cols])
    return one.select(F.inline(rows))


def standardize(df: DataFrame, cols: list[str]) -> DataFrame:
    """Scaled columns (x − mean) / std_pop, stats attached as scalars."""
    from tidewater.operators.common import attach_scalars
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"_{c}_m"), F.stddev_pop(c).alias(f"_{c}_s")]
    out = attach_scalars(df, df.agg(*aggs))
    for c in cols:
        out = out.withColumn(c, (F.col(c) - F.col(f"_{c}_m")) / F.col(f"_{c}_s"))
    return out.drop(*[f"_{c}_{s}" for c in cols for s in "ms"])


def hash_key(id_col: Column, seed: int) -> Column:
    return portable_hash32(F.concat(id_col.cast("string"), F.lit(f":{seed}")))


def split_by_hash(df: DataFrame, id_col: str, weights: list[float], seed: int = 0,
                  names: list[str] | None = None) -> DataFrame:
    """SA1: assign each row to a split by its hash bucket in [0, 100)."""
    names = names or [f"s{i}" for i in range(len(weights))]
    total = float(sum(weights))
    bucket = hash_key(F.col(id_col), seed) % 100
    expr, acc = None, 0.0
    for w, n in zip(weights, names):
        acc += 100.0 * w / total
        cond = bucket < F.lit(int(round(acc)))
        expr = F.when(cond, F.lit(n)) if expr is None else expr.when(cond, F.lit(n))
    return df.withColumn("split", expr.otherwise(F.lit(names[-1])))


def sample_subset(df: DataFrame, id_col: str, frac: float, seed: int = 0) -> DataFrame:
    """SA2: repeatable Bernoulli sample without replacement (hash below a
    threshold); its size is ``frac · n`` in expectation."""
    return df.filter(hash_key(F.col(id_col), seed) < F.lit(int(frac * 2**32)))


def shuffle_rows(df: DataFrame, id_col: str, seed: int = 0) -> DataFrame:
    """A seeded, repeatable row order (range-partitioned sort)."""
    return df.withColumn("shuffle_key", hash_key(F.col(id_col), seed)).orderBy("shuffle_key", id_col)


def year_from_string(ts: Column) -> Column:
    """year as the first four characters of a timestamp string."""
    return F.substring(ts, 1, 4).cast("int")


def sample_exact(df: DataFrame, id_col: str, frac: float, seed: int = 0) -> DataFrame:
    """SA2, exact size: the ``floor(frac · n)`` rows with the smallest
    (hash(id, seed), id) — the same rows as a full sort plus limit, without
    a global sort or a big limit through one task.

    The cut is found by two bounded histograms of the 32-bit hash: the high
    16 bits locate the bucket holding the cut (≤ 65,536 counts), then the low
    16 bits inside that bucket locate the exact hash value; rows sharing that
    value (hash collisions, a handful) are ordered by id."""
    keyed = df.withColumn("_h", hash_key(F.col(id_col), seed))
    n = keyed.count()
    target = int(frac * n)
    if target <= 0:
        return keyed.limit(0).drop("_h")
    if target >= n:
        return keyed.drop("_h")
    # bounded summaries (≤ 65,536 rows each) brought to the driver
    hist = keyed.groupBy(F.shiftright("_h", 16).alias("b")).agg(F.count(F.lit(1)).alias("c")).orderBy("b").collect()
    cum = 0
    for row in hist:
        if cum + row["c"] >= target:
            b = row["b"]
            break
        cum += row["c"]
    need = target - cum
    lo_hist = (keyed.filter(F.shiftright("_h", 16) == b)
               .groupBy(F.col("_h").bitwiseAND(0xFFFF).alias("lo")).agg(F.count(F.lit(1)).alias("c"))
               .orderBy("lo").collect())
    cum2 = 0
    for row in lo_hist:
        if cum2 + row["c"] >= need:
            lo = row["lo"]
            break
        cum2 += row["c"]
    hstar, take = (b << 16) | lo, need - cum2
    below = keyed.filter(F.col("_h") < hstar)
    at = keyed.filter(F.col("_h") == hstar).orderBy(id_col).limit(take)  # only the colliding rows
    return below.unionByName(at).drop("_h")
