"""Reader queries (S1, S2, S5–S7, S9–S11, S13): table rows are printed in the
text formats into the shared folder and read back from there."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators import knn as K
from tidewater.plans.fixtures import FOLLOW_GRAPH_SQL, auth_log, follow_graph
from tidewater.plans.registry import query
from tidewater.session import shared_path
from tidewater.sources import readers as R
from tidewater.sources.tables import Tables


def _folder(spark, name: str) -> str:
    return shared_path(spark, f"text/{name}-{uuid.uuid4().hex[:12]}")


def _text(spark, name: str, lines) -> str:
    path = _folder(spark, name)
    lines.write.text(path)
    return path


@query("src_adjacency", "WITH " + FOLLOW_GRAPH_SQL + """
SELECT u.user_id, CAST(count(e.followed) AS BIGINT) AS n, CAST(coalesce(sum(e.followed), 0) AS BIGINT) AS total
FROM users u LEFT JOIN edges e USING (user_id) GROUP BY u.user_id
""")
def src_adjacency(spark, d):
    """A line ``id: a b c`` for each user, read back."""
    users, edges = follow_graph(Tables(spark, d))
    lists = users.join(edges, "user_id", "left").groupBy("user_id").agg(F.collect_list("followed").alias("f"))
    lines = lists.select(F.concat(F.col("user_id").cast("string"), F.lit(": "), F.array_join(F.col("f").cast("array<string>"), " ")))
    adj = R.read_adjacency(spark, _text(spark, "adjacency", lines))
    return adj.select("user_id", F.size("follows").cast("bigint").alias("n"), F.aggregate("follows", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"))


@query("src_log", """
SELECT CAST(count(*) AS BIGINT) AS n_lines,
       CAST(count(*) FILTER (WHERE event_type IN ('error', 'signup', 'click', 'view') OR event_id % 2 = 1) AS BIGINT) AS n_password FROM events
""")
def src_log(spark, d):
    """The log as a text file, read back line by line."""
    lines = auth_log(Tables(spark, d)).select("line")
    log = R.read_log(spark, _text(spark, "log", lines))
    return log.agg(F.count(F.lit(1)).cast("bigint").alias("n_lines"), F.count_if(F.col("line").contains("password")).cast("bigint").alias("n_password"))


_SUPPLIER = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()), T.StructField("s_acctbal", T.DoubleType())])
_SUPPLIER_SQL = "SELECT s_suppkey, s_name || ', \"' || s_nationkey || '\"' AS s_name, s_acctbal FROM supplier"


def _suppliers(t):
    """Names with commas and quotes, so that fields have to be quoted."""
    return t.supplier.select("s_suppkey", F.concat("s_name", F.lit(', "'), F.col("s_nationkey").cast("string"), F.lit('"')).alias("s_name"), "s_acctbal")


@query("src_table_csv", _SUPPLIER_SQL)
def src_table_csv(spark, d):
    """A table with a header and quoted fields."""
    path = _folder(spark, "csv")
    _suppliers(Tables(spark, d)).write.option("header", True).option("escape", '"').csv(path)
    return R.read_table(spark, path, _SUPPLIER)


@query("src_csv_skip", _SUPPLIER_SQL)
def src_csv_skip(spark, d):
    """The same behind a junk line that has as many commas as a row."""
    t = _suppliers(Tables(spark, d))
    row = F.to_csv(F.struct(*t.columns), {"escape": '"'})
    lines = t.select(F.lit(1).alias("o"), "s_suppkey", row.alias("value"))
    head = spark.createDataFrame([(0, 0, "junk,of,three"), (0, 1, ",".join(t.columns))], "o int, s_suppkey bigint, value string")
    one = head.unionByName(lines).coalesce(1).sortWithinPartitions("o", "s_suppkey").select("value")  # the format is one file
    return R.read_csv_skip(spark, _text(spark, "skip", one), _SUPPLIER, skip=1)


@query("src_tsv", "SELECT CAST(n_nationkey AS VARCHAR) AS label, n_name AS text FROM nation")
def src_tsv(spark, d):
    """Label and text, tab-separated, without a header."""
    path = _folder(spark, "tsv")
    Tables(spark, d).nation.select(F.col("n_nationkey").cast("string"), "n_name").write.option("sep", "\t").csv(path)
    return R.read_tsv(spark, path, ["label", "text"])


@query("src_vectors_labels", """
SELECT CAST(count(*) AS BIGINT) AS n_queries, CAST(0 AS BIGINT) AS n_errors, CAST(max(id) AS BIGINT) AS last_id FROM (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS id FROM embeddings)
""")
def src_vectors_labels(spark, d):
    """Vectors and labels in two files, split differently; the
    line number of one names the line of the other."""
    e = Tables(spark, d).embeddings
    line = F.concat_ws(" ", F.concat(F.lit("w"), F.col("vec_id").cast("string")), F.array_join(F.transform("embedding", lambda x: x.cast("string")), " "))
    vectors = _text(spark, "vectors", e.repartitionByRange(5, "vec_id").sortWithinPartitions("vec_id").select(line))
    labels = _text(spark, "labels", e.coalesce(1).sortWithinPartitions("vec_id").select(F.concat(F.lit("w"), F.col("vec_id").cast("string"))))
    found = R.read_embeddings(spark, vectors, 64)
    checked = K.check_labels(found.select(F.col("id").alias("q_id"), F.col("word").alias("found")), R.read_labels(spark, labels))
    last = found.agg(F.max("id").alias("last_id"))
    return checked.select("*", last.scalar().alias("last_id"))


@query("src_query_vectors", "SELECT CAST(count(*) AS BIGINT) AS n, CAST(max(len(embedding)) AS INTEGER) AS dim FROM embeddings")
def src_query_vectors(spark, d):
    """Vectors without words."""
    lines = Tables(spark, d).embeddings.select(F.array_join(F.transform("embedding", lambda x: x.cast("string")), " "))
    q = R.read_query_vectors(spark, _text(spark, "query-vectors", lines))
    return q.agg(F.countDistinct("q_id").cast("bigint").alias("n"), F.max(F.size("vec")).alias("dim"))


@query("src_query_points", "SELECT s_suppkey, CAST(row_number() OVER (ORDER BY s_suppkey) - 1 AS BIGINT) AS q_id, s_acctbal AS lat FROM supplier")
def src_query_points(spark, d):
    """Points by line number."""
    s = Tables(spark, d).supplier.coalesce(1).sortWithinPartitions("s_suppkey")
    lines = s.select(F.concat_ws("  ", F.col("s_acctbal").cast("string"), F.col("s_suppkey").cast("string")))
    pts = R.read_query_points(spark, _text(spark, "points", lines))
    return pts.select(F.col("lon").cast("bigint").alias("s_suppkey"), "q_id", "lat")


@query("src_words", "SELECT n_name AS word FROM nation")
def src_words(spark, d):
    """One word a line, with blank lines and spaces between."""
    lines = Tables(spark, d).nation.select(F.explode(F.array(F.lit(""), F.concat(F.lit("  "), F.col("n_name")), F.lit("  "))))
    return R.read_words(spark, _text(spark, "words", lines))


@query("src_tree", """
SELECT 'csv' AS ext, CAST(count(*) AS BIGINT) AS n_lines FROM supplier UNION ALL
SELECT 'json', count(*) FROM nation UNION ALL SELECT 'txt', count(*) FROM customer
""")
def src_tree(spark, d):
    """A tree of files of three kinds, by a name filter in either case."""
    t, root = Tables(spark, d), _folder(spark, "tree")
    t.customer.select("c_name").write.text(f"{root}/a/b")
    t.supplier.write.csv(f"{root}/c")
    t.nation.write.json(f"{root}/d")
    files = R.read_tree(spark, root, "PART-*", case_insensitive=True)
    n = F.length("content") - F.length(F.replace("content", F.lit("\n"), F.lit("")))
    return files.groupBy("ext").agg(F.sum(n).cast("bigint").alias("n_lines"))
