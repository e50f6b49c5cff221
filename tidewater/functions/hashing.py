"""Hash functions for the cardinality sketch.

* ``multiply_shift`` — top bits of ``a·x mod 2^64`` computed with 16-bit
  limbs in plain ``bigint`` expressions (Spark has no unsigned 64-bit type
  and ANSI mode raises on overflow; every partial product here stays below
  2^35). Runs inside whole-stage codegen.
* ``rho32`` — 1-based position of the leading one of a 32-bit value; 33 for 0.
* ``tabulation_hash`` — XOR of four 65,536-entry tables indexed by the 16-bit
  chunks of the key. The tables come from NumPy's seeded legacy generator,
  which no SQL engine reproduces, so this is an Arrow-batched pandas UDF;
  each Python worker builds the 1 MiB tables once from the seed.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions.text import portable_hash32  # noqa: F401  (re-export)

# fixed value: the multiplier of the multiply-shift bucket hash
MULTIPLIER = 0xC863B1E7D63F37A3
_MASK16 = 0xFFFF


def _limbs(v: Column) -> list[Column]:
    return [F.shiftrightunsigned(v, 16 * i).bitwiseAND(_MASK16) for i in range(4)]


def multiply_shift(x: Column, log2m: int, a: int = MULTIPLIER) -> Column:
    """Bucket in ``[0, 2^log2m)``: bits 63..(64−log2m) of ``a·x mod 2^64``.

    ``x`` is read as an unsigned 64-bit integer (two's complement limbs).
    Supports ``1 <= log2m <= 16``."""
    if not 1 <= log2m <= 16:
        raise ValueError("log2m must be in 1..16")
    al = [(a >> (16 * i)) & _MASK16 for i in range(4)]
    xl = _limbs(x.cast("bigint"))
    carry = F.lit(0).cast("bigint")
    limb3 = None
    for k in range(4):
        s = carry
        for i in range(k + 1):
            s = s + F.lit(al[i]) * xl[k - i]
        if k < 3:
            carry = F.shiftright(s, 16)
        else:
            limb3 = s.bitwiseAND(_MASK16)
    return F.shiftright(limb3, 16 - log2m).cast("int")


def rho32(h: Column) -> Column:
    """33 − bit length of a 32-bit value (33 for 0)."""
    return F.when(h == 0, F.lit(33)).otherwise(F.lit(33) - F.length(F.bin(h))).cast("int")


@functools.lru_cache(maxsize=4)
# fixed value: the seed 69 of the tables
def tabulation_tables(seed: int = 69) -> np.ndarray:
    """Four tables of 65,536 uint32 values from the seeded legacy generator."""
    rs = np.random.RandomState(seed)
    return np.stack([rs.randint(0, 2**32, size=65536, dtype=np.uint32) for _ in range(4)])


def tabulation_hash_np(keys: np.ndarray, seed: int = 69) -> np.ndarray:
    t = tabulation_tables(seed)
    x = keys.astype(np.uint64)
    out = np.zeros(len(x), dtype=np.uint32)
    for i in range(4):
        out ^= t[i][((x >> np.uint64(16 * i)) & np.uint64(_MASK16)).astype(np.int64)]
    return out


def tabulation_hash(x: Column, seed: int = 69) -> Column:
    """F7 as an Arrow-batched pandas UDF → bigint in [0, 2^32)."""
    from tidewater.session import ship_package
    ship_package()

    @F.pandas_udf("bigint")
    def _tab(s: pd.Series) -> pd.Series:
        return pd.Series(tabulation_hash_np(s.to_numpy(dtype=np.int64).view(np.uint64), seed).astype(np.int64))

    return _tab(x.cast("bigint"))
