"""Sinks (S15–S18): CSV / text files, model persistence, key/value reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_text(df: DataFrame, path: str, col: str | None = None, mode: str = "overwrite") -> None:
    """One line per row; multi-column rows are tab-joined."""
    if col is None:
        cols = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
        df = df.select(F.concat_ws("\t", *cols).alias("value"))
    else:
        df = df.select(F.col(col).cast("string").alias("value"))
    df.write.mode(mode).text(path)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def as_report(one_row: DataFrame) -> DataFrame:
    """One-row statistics → (metric string, value string) rows."""
    cols = one_row.columns
    return one_row.select(
        *[F.col(c).cast("string").alias(c) for c in cols]
    ).unpivot([], cols, "metric", "value")
