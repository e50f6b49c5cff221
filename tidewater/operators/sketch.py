"""HyperLogLog cardinality sketch as table operators (K3: A14–A16, A29).

Registers are a sparse table ``(register, rho)``: build = ``groupBy(register)
.agg(max(rho))`` (partial aggregation: at most m rows leave each map task, so
one key holding a third of the rows costs nothing extra); merge = union +
max; estimate = one global aggregate. For production-grade sketches the
built-in DataSketches functions (``hll_sketch_agg`` / ``hll_union_agg``) are
wrapped too.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import hashing as H
from tidewater.session import spread


def hashed(df: DataFrame, col: str, log2m: int = 10, hash: str = "portable", seed: int = 69) -> DataFrame:  # fixed value: the seed
    """(register, rho) per input row: bucket by multiply-shift of the key, ρ
    from an independent 32-bit hash of the key. A null key is no element."""
    x = F.col(col)
    h = H.portable_hash32(x) if hash == "portable" else H.tabulation_hash(x, seed)
    keys = spread(df.select(col).filter(x.isNotNull()))
    return keys.select(H.multiply_shift(x, log2m).alias("register"), H.rho32(h).alias("rho"))


def _sized(registers: DataFrame, log2m: int) -> DataFrame:
    """The register column carries the sketch's size."""
    return registers.select(F.col("register").alias("register", metadata={"log2m": log2m}), "rho")


def sketch_size(registers: DataFrame) -> int | None:
    return registers.schema["register"].metadata.get("log2m")


def hll_registers(df: DataFrame, col: str, log2m: int = 10, **kw) -> DataFrame:
    """A14."""
    return _sized(hashed(df, col, log2m, **kw).groupBy("register").agg(F.max("rho").cast("int").alias("rho")), log2m)


def hll_merge(a: DataFrame, b: DataFrame) -> DataFrame:
    """Element-wise max of two register tables of the same size; tables
    of different or unknown size are refused."""
    size = sketch_size(a)
    if size is None or size != sketch_size(b):
        raise ValueError(f"sketches of different size: {size} and {sketch_size(b)} (log2 of the registers)")
    return _sized(a.unionByName(b).groupBy("register").agg(F.max("rho").cast("int").alias("rho")), size)


def hll_estimate(registers: DataFrame, log2m: int = 10) -> DataFrame:
    """α·m²/Σ2^−M with the small-range (linear counting) and
    large-range corrections; registers absent from the sparse table are 0."""
    m = 1 << log2m
    alpha = 0.7213 / (1 + 1.079 / m)
    two32 = float(2 ** 32)
    agg = registers.agg(F.sum(F.pow(F.lit(2.0), -F.col("rho"))).alias("s"),
                        F.count(F.lit(1)).alias("hit"))
    zeros = (F.lit(m) - F.col("hit")).cast("double")
    raw = F.lit(alpha * m * m) / (F.coalesce(F.col("s"), F.lit(0.0)) + zeros)
    est = (F.when((raw <= 2.5 * m) & (zeros > 0), F.lit(float(m)) * F.log(F.lit(float(m)) / zeros))
           .when(raw > two32 / 30, F.lit(-two32) * F.log(1 - raw / two32))
           .otherwise(raw))
    return agg.select(F.round(est, 4).alias("estimate"), zeros.cast("bigint").alias("zero_registers"))


def hash_histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between min and max of the 32-bit hash (last bin
    closed), by integer arithmetic so bin edges are exact."""
    h = df.select(H.portable_hash32(F.col(col)).alias("h"))
    mm = h.agg(F.min("h").alias("lo"), F.max("h").alias("hi"))
    from tidewater.operators.common import attach_scalars
    width = F.col("hi") - F.col("lo")
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.lit(bins - 1), F.expr(f"((h - lo) * {bins}) div (hi - lo)")))
    return (attach_scalars(h, mm).groupBy((b + 1).cast("int").alias("bin"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n")))


def builtin_distinct(df: DataFrame, col: str, lg_config_k: int = 12) -> DataFrame:
    """Production path: DataSketches HLL built in Spark."""
    return df.agg(F.hll_sketch_estimate(F.hll_sketch_agg(F.col(col), lg_config_k)).alias("estimate"))


def relative_error_bound(log2m: int) -> float:
    return 1.04 / math.sqrt(1 << log2m)
