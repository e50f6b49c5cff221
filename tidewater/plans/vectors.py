"""K4 vector-search queries. The query set is derived from the whole table:
per-label centroids (J7/J9/J12), and the data rows nearest to them — the
label medoids — as query words for the cosine and LSH searches (J5, J10, J11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import knn as K
from tidewater.operators import lsh as LSH
from tidewater.operators.pivots import knn_by_pivots
from tidewater.plans.fixtures import EMB_SQL, embedding_rows
from tidewater.plans.registry import query
from tidewater.session import cut_lineage, spread
from tidewater.sources.tables import Tables

_W = "WITH " + EMB_SQL
DIM = 64
# fixed values: LSH shape (32 hyperplanes, 8 tables; 12 bits for the candidates of the medoids) and its seed
BITS = 12
PLANES, ORDERS = LSH.lsh_params(DIM, n_planes=32, n_tables=8, seed=42)
POSITIONS = ORDERS[:, :BITS]
SUPERBITS = LSH.superbit_planes(DIM)
_LSH_SQL = LSH.params_sql(PLANES, POSITIONS) + """,
sig AS (SELECT e.vec_id, list(CASE WHEN list_inner_product(e.v, p) >= 0 THEN 1 ELSE 0 END ORDER BY pid) AS s
        FROM e, planes GROUP BY e.vec_id),
bk AS (SELECT vec_id, t, array_to_string(list_transform(idx, lambda i: s[i]::VARCHAR), '') AS b FROM sig, tables)
"""
# bits of a bucket: ceil(log2(rows)) between 8 and 32, as lsh_bits()
_BUCKETS_SQL = LSH.params_sql(PLANES, ORDERS) + """,
nb AS (SELECT greatest(8, least(32, CASE WHEN count(*) < 2 THEN 0 ELSE length(bin(count(*) - 1)) END)) AS nb FROM e),
sig AS (SELECT e.vec_id, list(CASE WHEN list_inner_product(e.v, p) >= 0 THEN 1 ELSE 0 END ORDER BY pid) AS s
        FROM e, planes GROUP BY e.vec_id),
bk AS (SELECT vec_id, t, array_to_string(list_transform(idx[1:nb], lambda i: s[i]::VARCHAR), '') AS b FROM sig, tables, nb)
"""
# the smallest Hamming ball of each query (q_id, qu) with as many rows as probe_rows() says, and its three most similar rows
_PROBE_SQL = LSH.superbits_sql(SUPERBITS) + """,
far AS (SELECT q.q_id, c.vec_id AS id, bit_count(xor(qc.code, c.code)) AS d
        FROM queries q JOIN codes qc ON qc.vec_id = q.q_id JOIN codes c ON c.vec_id <> q.q_id JOIN u ON u.vec_id = c.vec_id),
ball AS (SELECT q_id, max(d) AS radius FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY d) AS n FROM far)
         WHERE n <= (SELECT greatest(16, CAST(ceil(sqrt(count(*))) AS BIGINT)) FROM e) GROUP BY q_id),
cand AS (SELECT far.q_id, far.id FROM far JOIN ball ON far.q_id = ball.q_id AND d <= radius)
SELECT q_id, id, sim, CAST(rank AS INTEGER) AS rank FROM (
  SELECT c.q_id, c.id, round(list_inner_product(u.u, q.qu), 6) AS sim,
         row_number() OVER (PARTITION BY c.q_id ORDER BY list_inner_product(u.u, q.qu) DESC, c.id) AS rank
  FROM cand c JOIN u ON u.vec_id = c.id JOIN queries q ON q.q_id = c.q_id) WHERE rank <= 3
"""


def _emb(spark, d):
    return embedding_rows(Tables(spark, d))


def _centroid_nn(spark, d, metric):
    emb = _emb(spark, d)
    cents = K.centroids(emb, "label", "vec").withColumnRenamed("label", "q_id")
    return emb, K.knn(emb, cents, 1, metric)


def _medoid_queries(spark, d):
    emb, nn = _centroid_nn(spark, d, "euclidean")
    nn = cut_lineage(nn)  # one row a label: later lookups don't scan again
    words = nn.join(emb.select("id", "word"), "id").select("word")   # J6: ids carried, names attached
    unit = K.l2_normalize(emb, "vec", "unit")
    q = K.lookup_queries(unit, words).select(F.col("id").alias("q_id"), "vec", "unit", F.col("id").alias("self_id"))
    return unit, q


_NN_OUT = "SELECT CAST(q_id AS BIGINT) AS q_id, id, round(d, 6) AS d, CAST(rank AS INTEGER) AS rank FROM nn"


@query("vec_norms", """
SELECT vec_id AS id, round(sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))), 6) AS norm
FROM embeddings
""")
def vec_norms(spark, d):
    return K.l2_normalize(_emb(spark, d), "vec", "unit").select("id", F.round("norm", 6).alias("norm"))


@query("vec_centroid_nn", _W + _NN_OUT)
def vec_centroid_nn(spark, d):
    _, nn = _centroid_nn(spark, d, "euclidean")
    return nn.select("q_id", "id", F.round("d", 6).alias("d"), F.col("rank").cast("int"))


@query("vec_centroid_nn_expanded", _W + _NN_OUT)
def vec_centroid_nn_expanded(spark, d):
    _, nn = _centroid_nn(spark, d, "euclidean_expanded")
    return nn.select("q_id", "id", F.round("d", 6).alias("d"), F.col("rank").cast("int"))


@query("vec_centroid_nn_pivots", _W + _NN_OUT)
def vec_centroid_nn_pivots(spark, d):
    """J7 by pivots: only rows that the triangle inequality leaves are compared."""
    emb = _emb(spark, d)
    cents = K.centroids(emb, "label", "vec").withColumnRenamed("label", "q_id")
    return knn_by_pivots(emb, cents, 1).select("q_id", "id", F.round("d", 6).alias("d"), F.col("rank").cast("int"))


@query("vec_twentieth_cosine_pivots", _W + """
SELECT q_id, id, sim, CAST(rank AS INTEGER) AS rank FROM (
  SELECT q.vec_id AS q_id, u.vec_id AS id, round(list_inner_product(u.u, q.u), 6) AS sim,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(u.u, q.u) DESC, u.vec_id) AS rank
  FROM u q JOIN u ON u.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0) WHERE rank <= 3
""")
def vec_twentieth_cosine_pivots(spark, d):
    """J10 by pivots for every row whose id is divisible by 20, against all rows."""
    unit = K.l2_normalize(_emb(spark, d), "vec", "unit").filter(F.col("unit").isNotNull())
    q = unit.filter(F.col("id") % 20 == 0).select(F.col("id").alias("q_id"), "unit", F.col("id").alias("own"))
    r = knn_by_pivots(unit, q, 3, vec_col="unit", q_vec="unit", exclude_col="own")
    return r.select("q_id", "id", F.round(1 - F.col("d") * F.col("d") / 2, 6).alias("sim"), F.col("rank").cast("int"))


@query("vec_centroid_label_check", _W + """
SELECT CAST(count(*) AS BIGINT) AS n_queries,
       CAST(count(*) FILTER (WHERE e.label <> nn.q_id) AS BIGINT) AS n_errors
FROM nn JOIN e ON e.vec_id = nn.id
""")
def vec_centroid_label_check(spark, d):
    emb, nn = _centroid_nn(spark, d, "euclidean")
    j = nn.join(emb.select("id", F.col("label").alias("found")), "id")   # J12
    return j.agg(F.count(F.lit(1)).cast("bigint").alias("n_queries"),
                 F.count_if(F.col("found") != F.col("q_id")).cast("bigint").alias("n_errors"))


@query("vec_medoid_cosine_top3", _W + """
SELECT q_id, id, sim, CAST(rank AS INTEGER) AS rank FROM (
  SELECT m.q_id, u.vec_id AS id, round(list_inner_product(u.u, m.qu), 6) AS sim,
         row_number() OVER (PARTITION BY m.q_id ORDER BY list_inner_product(u.u, m.qu) DESC, u.vec_id) AS rank
  FROM medoids m, u WHERE u.vec_id <> m.q_id) WHERE rank <= 3
""")
def vec_medoid_cosine_top3(spark, d):
    unit, q = _medoid_queries(spark, d)
    r = K.knn(unit.filter(F.col("unit").isNotNull()), q, 3, "cosine", vec_col="unit", q_vec="unit",
              exclude_col="self_id")
    return r.select("q_id", "id", F.round(-F.col("d"), 6).alias("sim"), F.col("rank").cast("int"))


def _probed(unit, q, n_rows):
    r = LSH.topk_probed(unit, q, 3, SUPERBITS, LSH.probe_rows(n_rows), exclude_col="self_id")
    return r.select("q_id", "id", F.round("sim", 6).alias("sim"), F.col("rank").cast("int"))


@query("vec_medoid_lsh_top3", _W + ", queries AS (SELECT q_id, qu FROM medoids)," + _PROBE_SQL)
def vec_medoid_lsh_top3(spark, d):
    unit, q = _medoid_queries(spark, d)
    return _probed(unit, q, Tables(spark, d).embeddings.count())


@query("vec_lsh_twentieth_top3", _W + ", queries AS (SELECT vec_id AS q_id, u AS qu FROM u WHERE vec_id % 20 = 0)," + _PROBE_SQL)
def vec_lsh_twentieth_top3(spark, d):
    """J11 for every row whose id is divisible by 20, against all rows."""
    unit = K.l2_normalize(_emb(spark, d), "vec", "unit")
    q = unit.filter(F.col("id") % 20 == 0).select(F.col("id").alias("q_id"), "unit", F.col("id").alias("self_id"))
    return _probed(unit, q, Tables(spark, d).embeddings.count())


@query("vec_medoid_bucket_top3", _W + "," + _LSH_SQL + """,
qb AS (SELECT m.q_id, bk.t, bk.b FROM medoids m JOIN bk ON bk.vec_id = m.q_id),
cand AS (SELECT DISTINCT qb.q_id, bk.vec_id AS id FROM qb JOIN bk ON qb.t = bk.t AND qb.b = bk.b
         WHERE bk.vec_id <> qb.q_id)
SELECT q_id, id, sim, CAST(rank AS INTEGER) AS rank FROM (
  SELECT c.q_id, c.id, round(list_inner_product(u.u, m.qu), 6) AS sim,
         row_number() OVER (PARTITION BY c.q_id ORDER BY list_inner_product(u.u, m.qu) DESC, c.id) AS rank
  FROM cand c JOIN u ON u.vec_id = c.id JOIN medoids m ON m.q_id = c.q_id) WHERE rank <= 3
""")
def vec_medoid_bucket_top3(spark, d):
    """Rows that share a bucket with the query in one of the tables."""
    unit, q = _medoid_queries(spark, d)
    r = LSH.topk_lsh(unit, q, 3, PLANES, POSITIONS, exclude_col="self_id")
    return r.select("q_id", "id", F.round("sim", 6).alias("sim"), F.col("rank").cast("int"))


@query("vec_lsh_buckets", _W + "," + _BUCKETS_SQL + """
SELECT vec_id AS id, array_to_string(list(DISTINCT s)[1], '') AS signature, string_agg(b, ',' ORDER BY t) AS buckets
FROM bk JOIN sig USING (vec_id) GROUP BY vec_id
""")
def vec_lsh_buckets(spark, d):
    """signatures and buckets of all vectors, as column functions; a
    bucket has as many bits as the table asks for."""
    bits = LSH.lsh_bits(Tables(spark, d).embeddings.count())
    sig = spread(_emb(spark, d)).select("id", LSH.signature(F.col("vec"), PLANES).alias("s"))
    keys = LSH.bucket_keys(F.col("s"), ORDERS[:, :bits])
    return sig.select("id", F.array_join(F.col("s").cast("array<string>"), "").alias("signature"),
                      F.array_join(F.transform(keys, lambda x: x["b"]), ",").alias("buckets"))


@query("vec_text_roundtrip_norms", """
SELECT 'w' || vec_id AS word, round(sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))), 6) AS norm
FROM embeddings
""")
def vec_text_roundtrip_norms(spark, d):
    """Embeddings printed as ``word v1 … vd`` lines and parsed back by the
    text reader; norms of the parsed vectors (float text round-trips exactly)."""
    from tidewater.sources.readers import parse_embeddings
    e = Tables(spark, d).embeddings
    lines = e.select(F.concat_ws(" ", F.concat(F.lit("w"), F.col("vec_id").cast("string")),
                                 F.array_join(F.transform("embedding", lambda x: x.cast("string")), " "))
                     .alias("value"))
    parsed = parse_embeddings(lines, dim=DIM)
    return K.l2_normalize(parsed, "vec", "unit").select("word", F.round("norm", 6).alias("norm"))
