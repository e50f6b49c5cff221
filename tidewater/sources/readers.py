"""Text/CSV/file readers.

Each reader is ``spark.read.text``/``csv``/``binaryFile`` plus a column-level
parse. The parse steps are exposed separately (``parse_*``) so they can run on
any DataFrame of lines, e.g. lines derived from the driver tables. Every
schema is explicit; nothing is inferred. A number that does not parse is null.

Where the position of a line in its file is an id, ``number_lines`` gives dense
zero-based numbers however the files are split.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Blocks of files whose first line numbers are broadcast at most; more are joined.
BROADCAST_BLOCKS = 200_000


def number_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with ``line_no`` (dense over all files, in order of
    their names) and ``file_line`` (dense in each file), both from zero.

    Lines of one block of a file (a split) are consecutive in a task; a first
    pass counts the lines of each block, and prefix sums over the blocks (few
    rows) give each block's first numbers."""
    text = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_at"),
                                        F.monotonically_increasing_id().alias("_row"))
    counts = text.groupBy("_file", "_at").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.withColumns({"_all": F.coalesce(F.sum("_n").over(before.orderBy("_file", "_at")), F.lit(0)),
                                 "_own": F.coalesce(F.sum("_n").over(before.partitionBy("_file").orderBy("_at")), F.lit(0))}).drop("_n")
    if spark.read.text(path).select("_metadata.file_path", "_metadata.file_block_start").distinct().limit(BROADCAST_BLOCKS + 1).count() <= BROADCAST_BLOCKS:
        blocks = F.broadcast(blocks)
    inside = F.col("_row") - F.col("_first")
    return text.join(blocks, ["_file", "_at"]).select("value", (F.col("_all") + inside).alias("line_no"), (F.col("_own") + inside).alias("file_line"))


def _numbered(lines: DataFrame, name: str) -> list[Column]:
    """The line number as an id, of lines that have one."""
    return [F.col("line_no").alias(name)] if "line_no" in lines.columns else []


def _tokens(col: Column) -> Column:
    """Whitespace split with empty tokens removed (Python ``str.split()``)."""
    return F.filter(F.split(F.trim(col), r"\s+"), lambda t: t != F.lit(""))


# S1 ----------------------------------------------------------------------
def parse_adjacency(lines: DataFrame, col: str = "value") -> DataFrame:
    """``id: a b c`` → (user_id bigint, follows array<bigint>). A line without
    ``:`` is a user with an empty list; a blank line is none."""
    parts = F.split(F.col(col), ":", 2)
    rest = F.when(F.size(parts) > 1, F.get(parts, 1)).otherwise(F.lit(""))
    return lines.filter(F.trim(F.col(col)) != "").select(
        F.trim(parts.getItem(0)).try_cast("bigint").alias("user_id"),
        F.transform(_tokens(rest), lambda t: t.try_cast("bigint")).alias("follows"),
    )


def read_adjacency(spark: SparkSession, path: str) -> DataFrame:
    return parse_adjacency(spark.read.text(path))


def adjacency_edges(adj: DataFrame) -> DataFrame:
    """Adjacency rows → (user_id, followed) edge rows; the scalable form
    every graph statistic runs on."""
    return adj.select("user_id", F.explode("follows").alias("followed"))


# S2 ----------------------------------------------------------------------
def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "line")


# S3 ----------------------------------------------------------------------
def parse_edge_ids(lines: DataFrame, col: str = "value") -> DataFrame:
    """Whitespace-separated ids, flattened to one id per row."""
    return lines.select(F.explode(F.transform(_tokens(F.col(col)), lambda t: t.try_cast("bigint"))).alias("id"))


def read_edge_ids(spark: SparkSession, path: str) -> DataFrame:
    return parse_edge_ids(spark.read.text(path))


# S4 / S9 -------------------------------------------------------------------
def parse_embeddings(lines: DataFrame, dim: int | None = None, col: str = "value") -> DataFrame:
    """``word v1 … vd`` (single spaces, no quoting) → (id, word, vec).

    Words are kept literally (``null``/``NaN`` stay strings). ``id`` is the line
    number of lines that have one (``number_lines``). With ``dim``, a line of
    another width is an error."""
    toks = F.split(F.col(col), " ")
    vec = F.transform(F.slice(toks, 2, F.size(toks) - 1), lambda t: t.try_cast("float"))
    if dim is not None:
        bad = F.raise_error(F.concat(F.lit(f"not {dim} numbers: "), F.substring(F.col(col), 1, 80))).cast("array<float>")
        vec = F.when(F.size(toks) == dim + 1, vec).otherwise(bad)
    return lines.select(*_numbered(lines, "id"), toks.getItem(0).alias("word"), vec.alias("vec"))


def read_embeddings(spark: SparkSession, path: str, dim: int | None = None) -> DataFrame:
    return parse_embeddings(number_lines(spark, path), dim)


def parse_query_vectors(lines: DataFrame, col: str = "value") -> DataFrame:
    return lines.select(*_numbered(lines, "q_id"), F.transform(_tokens(F.col(col)), lambda t: t.try_cast("float")).alias("vec"))


def read_query_vectors(spark: SparkSession, path: str) -> DataFrame:
    return parse_query_vectors(number_lines(spark, path))


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    return number_lines(spark, path).select(F.col("line_no").alias("q_id"), F.trim("value").alias("expected"))


# S5 / S6 / S7 ---------------------------------------------------------------
def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Headered CSV with a declared schema."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def read_csv_skip(spark: SparkSession, path: str, schema: T.StructType, skip: int = 1) -> DataFrame:
    """CSV whose first ``skip`` lines are junk, followed by a header line: the
    first ``skip + 1`` lines of each file are left out by position, whatever
    they hold, and all others are parsed with quotes (a record is one line).
    Missing or unreadable fields are null; blank lines are none."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    body = number_lines(spark, path).filter((F.col("file_line") > skip) & (F.trim("value") != ""))
    return body.select(F.from_csv("value", ddl, {"quote": '"', "escape": '"'}).alias("r")).select("r.*")


def read_tsv(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    return spark.read.schema(schema).option("sep", "\t").option("header", False).csv(path)


# S10 / S11 -----------------------------------------------------------------
def parse_query_points(lines: DataFrame, col: str = "value") -> DataFrame:
    toks = _tokens(F.col(col))
    return lines.select(*_numbered(lines, "q_id"), F.get(toks, 0).try_cast("double").alias("lat"), F.get(toks, 1).try_cast("double").alias("lon"))


def read_query_points(spark: SparkSession, path: str) -> DataFrame:
    return parse_query_points(number_lines(spark, path))


def read_words(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("word")).filter(F.col("word") != "")


# S13 / S14 -----------------------------------------------------------------
def either_case(glob: str) -> str:
    """A glob that matches letters in either case, so that the file listing
    itself leaves other files out."""
    return re.sub(r"\[[^\]]*\]|[A-Za-z]", lambda m: m[0] if m[0][0] == "[" else f"[{m[0].lower()}{m[0].upper()}]", glob)


def read_tree(spark: SparkSession, root: str, glob: str | None = None,
              case_insensitive: bool = False) -> DataFrame:
    """Recursive file scan → (path, ext as it is written, bytes, content
    string). The name filter goes to the file listing."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", either_case(glob) if case_insensitive else glob)
    return reader.load(root).select(
        "path",
        F.regexp_extract("path", r"\.([^./]+)$", 1).alias("ext"),
        F.col("length").alias("bytes"),
        F.col("content").cast("string").alias("content"),
    )


def read_labelled_dir(spark: SparkSession, root: str) -> DataFrame:
    """Folder-per-class layout → (path, label, bytes)."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return df.select("path", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("label"),
                     F.col("length").alias("bytes"))


def class_counts(files: DataFrame) -> DataFrame:
    return files.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
