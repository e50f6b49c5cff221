"""Small plan helpers shared by operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row of ``df``.

    Planned as a scalar subquery: the aggregate runs once and its struct is
    injected as a constant — no join of any kind appears in the plan."""
    cols = one_row.columns
    s = one_row.select(F.struct(*cols).alias("_s")).scalar()
    out = df.withColumn("_scalars", s)
    return out.select(*[F.col(c) for c in df.columns], *[F.col("_scalars").getField(c).alias(c) for c in cols])
