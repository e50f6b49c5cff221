"""File-corpus statistics (K7: A23–A25, A30, J15, O4, P17, U5, F17–F19).

Input is a ``files`` DataFrame ``(path, ext, content)`` — from
``sources.readers.read_tree`` on a real tree, or derived from tables.
Everything is per-file expressions plus ``groupBy``; line-level operators
explode whole texts into lines (never a prefix of a text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import text as TX


def count_by_extension(files: DataFrame, case_insensitive: bool = True) -> DataFrame:
    """A23."""
    ext = F.lower("ext") if case_insensitive else F.col("ext")
    return files.groupBy(ext.alias("ext")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def line_counts(files: DataFrame) -> DataFrame:
    """``wc -l`` per file."""
    return files.select("path", TX.newline_count(F.col("content")).alias("n_lines"))


def longest_files(files: DataFrame, n: int = 10) -> DataFrame:
    """Top-n by line count (ties → path), a bounded top-k."""
    return line_counts(files).orderBy(F.desc("n_lines"), F.asc("path")).limit(n)


def total_bytes(files: DataFrame) -> DataFrame:
    """A30."""
    return files.agg(F.count(F.lit(1)).cast("bigint").alias("n_files"),
                     F.sum(F.octet_length("content")).cast("bigint").alias("total_bytes"))


def digests(files: DataFrame) -> DataFrame:
    """SHA-1 of each file's content."""
    return files.select("path", TX.sha1_hex(F.col("content")).alias("sha1"))


def verify_digests(files: DataFrame, stored: DataFrame) -> DataFrame:
    """Join recomputed digests with a stored manifest ``(path, sha1)``
    on path; count missing and mismatching entries."""
    d = digests(files).withColumnRenamed("sha1", "actual")
    j = stored.withColumnRenamed("sha1", "expected").join(d, "path", "left")
    return j.agg(F.count(F.lit(1)).cast("bigint").alias("n_checked"),
                 F.count_if(F.col("actual").isNull()).cast("bigint").alias("n_missing"),
                 F.count_if(F.col("actual") != F.col("expected")).cast("bigint").alias("n_mismatch"))


def file_lines(files: DataFrame) -> DataFrame:
    """Every line of every file (whole texts)."""
    return files.select("path", F.posexplode(TX.lines(F.col("content"))).alias("line_no", "line"))


def files_and_lines_containing(files: DataFrame, needle: str) -> DataFrame:
    """Files whose content contains ``needle`` vs lines matching it as
    a whole word, in one pass; only matching files are split into lines."""
    word = rf"\b\Q{needle}\E\b"
    hit = F.col("content").contains(needle)
    lines = F.when(hit, F.size(F.filter(TX.lines(F.col("content")), lambda x: x.rlike(word)))).otherwise(0)
    return files.agg(F.count_if(hit).cast("bigint").alias("n_files"), F.coalesce(F.sum(lines), F.lit(0)).cast("bigint").alias("n_lines"))


def license_ids(files: DataFrame, pattern: str, exts: list[str] | None = None) -> DataFrame:
    """first licence identifier per file (pattern group 1)."""
    f = files if not exts else files.filter(F.lower("ext").isin(exts))
    lid = F.nullif(F.regexp_extract("content", pattern, 1), F.lit(""))
    return f.select("path", lid.alias("license")).filter(F.col("license").isNotNull())


def license_counts(files: DataFrame, pattern: str, exts: list[str] | None = None) -> DataFrame:
    """Tally of licence identifiers."""
    return license_ids(files, pattern, exts).groupBy("license").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


def top_license(files: DataFrame, pattern: str, exts: list[str] | None = None) -> DataFrame:
    return license_counts(files, pattern, exts).orderBy(F.desc("n"), F.asc("license")).limit(1)


def distinct_lines_containing(files: DataFrame, needle: str) -> DataFrame:
    """U5 (``grep | sort --unique``)."""
    return (file_lines(files).filter(F.col("line").contains(needle))
            .select("line").distinct().orderBy("line"))


def last_word_tally(files: DataFrame, needle: str) -> DataFrame:
    """F19 applied as the reference does: tally of the last word of each
    matching line."""
    lw = TX.last_token(F.col("line"))
    return (file_lines(files).filter(F.col("line").contains(needle))
            .groupBy(lw.alias("last_word")).agg(F.count(F.lit(1)).cast("bigint").alias("n")))
