"""Preparation, splitting and evaluation-table queries (P6–P10, P16, A26,
O8, SA1, SA2, E1–E4, E6, F16, M1, M2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import evaluate as EV
from tidewater.operators import prep as PR
from tidewater.plans.fixtures import PRED_SQL, hash_sql, rule_predictions
from tidewater.plans.registry import query
from tidewater.sources.tables import Tables

# fixed values: priority names for the code map, seeds and split weights
PRIORITY_NAMES = ["urgent", "high", "medium", "not specified", "low"]
SPLIT_SEED, SAMPLE_SEED, SHUFFLE_SEED = 1, 2, 3
FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_WP = "WITH " + PRED_SQL


@query("prep_drop_incomplete", """
SELECT o_orderkey FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS s, nullif(o_orderpriority, '5-LOW') AS p
                        FROM orders) WHERE s IS NOT NULL AND p IS NOT NULL
""")
def prep_drop_incomplete(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("s"),
                                       F.nullif("o_orderpriority", F.lit("5-LOW")).alias("p"))
    return PR.drop_incomplete(o, ["s", "p"]).select("o_orderkey")


_NAMES = "[" + ", ".join(f"'{n}'" for n in PRIORITY_NAMES) + "]"


@query("prep_map_codes", f"""
SELECT o_orderkey, {_NAMES}[CAST(substr(o_orderpriority, 1, 1) AS INTEGER)] AS priority_name FROM orders
""")
def prep_map_codes(spark, d):
    o = Tables(spark, d).orders
    code = F.substring("o_orderpriority", 1, 1).cast("int")
    return o.select("o_orderkey", PR.map_codes(code, PRIORITY_NAMES).alias("priority_name"))


@query("prep_binarize_log", """
SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS is_finished,
       round(ln(o_totalprice), 6) AS log_price FROM orders
""")
def prep_binarize_log(spark, d):
    o = Tables(spark, d).orders
    return o.select("o_orderkey", PR.binarize(F.col("o_orderstatus"), "F").alias("is_finished"),
                    F.round(PR.log_target(F.col("o_totalprice")), 6).alias("log_price"))


@query("prep_standardize_stats", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std FROM lineitem"
    for c in FEATURES))
def prep_standardize_stats(spark, d):
    s = PR.standardize_stats(Tables(spark, d).lineitem, FEATURES)
    return s.select("feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query("prep_standardized_sum", """
SELECT round(min((l_quantity - m) / s), 6) AS min_z, round(max((l_quantity - m) / s), 6) AS max_z,
       round(sum(((l_quantity - m) / s) * ((l_quantity - m) / s)), 3) AS sum_z2
FROM lineitem, (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS s FROM lineitem)
""")
def prep_standardized_sum(spark, d):
    z = PR.standardize(Tables(spark, d).lineitem.select("l_quantity"), ["l_quantity"])
    return z.agg(F.round(F.min("l_quantity"), 6).alias("min_z"), F.round(F.max("l_quantity"), 6).alias("max_z"),
                 F.round(F.sum(F.col("l_quantity") * F.col("l_quantity")), 3).alias("sum_z2"))


@query("prep_split_80_20", f"""
SELECT o_orderkey, CASE WHEN {hash_sql('o_orderkey', SPLIT_SEED)} % 100 < 80 THEN 'train' ELSE 'test' END AS split
FROM orders
""")
def prep_split_80_20(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey")
    return PR.split_by_hash(o, "o_orderkey", [0.8, 0.2], SPLIT_SEED, ["train", "test"])


@query("prep_split_60_20_20", f"""
SELECT o_orderkey, CASE WHEN b < 60 THEN 'train' WHEN b < 80 THEN 'valid' ELSE 'test' END AS split
FROM (SELECT o_orderkey, {hash_sql('o_orderkey', SPLIT_SEED)} % 100 AS b FROM orders)
""")
def prep_split_60_20_20(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey")
    return PR.split_by_hash(o, "o_orderkey", [0.6, 0.2, 0.2], SPLIT_SEED, ["train", "valid", "test"])


@query("prep_sample_20", f"""
SELECT o_orderkey FROM orders WHERE {hash_sql('o_orderkey', SAMPLE_SEED)} < {int(0.2 * 2**32)}
""")
def prep_sample_20(spark, d):
    return PR.sample_subset(Tables(spark, d).orders.select("o_orderkey"), "o_orderkey", 0.2, SAMPLE_SEED)


@query("prep_shuffle", f"SELECT o_orderkey, {hash_sql('o_orderkey', SHUFFLE_SEED)} AS shuffle_key FROM orders")
def prep_shuffle(spark, d):
    return PR.shuffle_rows(Tables(spark, d).orders.select("o_orderkey"), "o_orderkey", SHUFFLE_SEED)


def _pred(spark, d):
    return rule_predictions(Tables(spark, d))


@query("eval_accuracy", _WP + """
SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy, CAST(count(*) AS BIGINT) AS n FROM pred
""")
def eval_accuracy(spark, d):
    return EV.accuracy(_pred(spark, d))


@query("eval_confusion", _WP + "SELECT label, prediction, CAST(count(*) AS BIGINT) AS n FROM pred GROUP BY 1, 2")
def eval_confusion(spark, d):
    return EV.confusion_matrix(_pred(spark, d))


@query("eval_report", _WP + """,
cls AS (SELECT label AS cls FROM pred UNION SELECT prediction FROM pred),
per AS (SELECT cls,
          (SELECT count(*) FROM pred WHERE label = cls AND prediction = cls) AS tp,
          (SELECT count(*) FROM pred WHERE label = cls) AS support,
          (SELECT count(*) FROM pred WHERE prediction = cls) AS npred FROM cls),
m AS (SELECT cls, tp, support,
        CASE WHEN npred > 0 THEN tp / npred ELSE 0.0 END AS precision,
        CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM per),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM m)
SELECT cls, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1, CAST(support AS BIGINT) AS support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 4), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', round(avg(precision), 4), round(avg(recall), 4), round(avg(f1), 4), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 4), round(sum(recall * support) / sum(support), 4),
                 round(sum(f1 * support) / sum(support), 4), CAST(sum(support) AS BIGINT) FROM f
""")
def eval_report(spark, d):
    return EV.classification_report(_pred(spark, d))


@query("eval_misclassified", _WP + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, label, prediction FROM pred WHERE label <> prediction
ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 10
""")
def eval_misclassified(spark, d):
    p = _pred(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "label", "prediction")
    return EV.misclassified(p, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], 10)


# fixed rule: the probability of quality 1 grows with the length of the text
_TEXT_P = "1.0 / (1.0 + exp(-((length(text) - 1000) / 500.0)))"


@query("eval_misclassified_texts", f"""
SELECT doc_id, text, quality AS label, CAST(p >= 0.5 AS INTEGER) AS prediction, round(p, 6) AS probability
FROM (SELECT doc_id, text, quality, {_TEXT_P} AS p FROM labels JOIN documents USING (doc_id))
WHERE quality <> CAST(p >= 0.5 AS INTEGER) ORDER BY doc_id LIMIT 10
""")
def eval_misclassified_texts(spark, d):
    """P16 with the texts and the probabilities."""
    t = Tables(spark, d)
    p = EV.sigmoid((F.length("text") - 1000) / 500.0)
    pred = (t.labels.join(t.documents.select("doc_id", "text"), "doc_id").withColumn("p", p)
            .select("doc_id", "text", F.col("quality").alias("label"), (F.col("p") >= 0.5).cast("int").alias("prediction"), F.round("p", 6).alias("probability")))
    return EV.misclassified(pred, ["doc_id"], 10)


@query("eval_activations", """
SELECT round(avg(tanh(10 * (l_discount - 0.05))), 6) AS mean_tanh, round(avg(1.0 / (1.0 + exp(-(10 * (l_discount - 0.05))))), 6) AS mean_sigmoid FROM lineitem
""")
def eval_activations(spark, d):
    """both activations."""
    z = 10 * (F.col("l_discount") - 0.05)
    return Tables(spark, d).lineitem.agg(F.round(F.avg(EV.activation(z, "tanh")), 6).alias("mean_tanh"), F.round(F.avg(EV.activation(z, "sigmoid")), 6).alias("mean_sigmoid"))


@query("eval_class_impurity", """
WITH c AS (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1), t AS (SELECT sum(n) AS t FROM c)
SELECT round(-sum((n / t) * log2(n / t)), 6) AS entropy, round(1 - sum((n / t) * (n / t)), 6) AS gini,
       CAST(max(n) AS BIGINT) AS majority FROM c, t
""")
def eval_class_impurity(spark, d):
    return EV.class_impurity(Tables(spark, d).lineitem, "l_returnflag")


@query("eval_mean_loss", """
SELECT round(avg(-(y * ln(p)) - (1 - y) * ln(1 - p)), 6) AS mean_loss FROM (
  SELECT CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS y,
         1.0 / (1.0 + exp(-(10 * (l_discount - 0.05)))) AS p FROM lineitem)
""")
def eval_mean_loss(spark, d):
    li = Tables(spark, d).lineitem
    p = li.select(PR.binarize(F.col("l_returnflag"), "R").alias("y"),
                  (10 * (F.col("l_discount") - 0.05)).alias("logit"))
    return EV.mean_loss(p)


@query("eval_baseline_majority", f"""
WITH s AS (SELECT l_returnflag AS label,
                  CASE WHEN {hash_sql('l_orderkey', SPLIT_SEED)} % 100 < 80 THEN 'train' ELSE 'test' END AS split FROM lineitem),
maj AS (SELECT label FROM s WHERE split = 'train' GROUP BY label ORDER BY count(*) DESC, label LIMIT 1)
SELECT round(avg(CASE WHEN s.label = maj.label THEN 1.0 ELSE 0.0 END), 6) AS accuracy, CAST(count(*) AS BIGINT) AS n
FROM s, maj WHERE s.split = 'test'
""")
def eval_baseline_majority(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", F.col("l_returnflag").alias("label"))
    s = PR.split_by_hash(li, "l_orderkey", [0.8, 0.2], SPLIT_SEED, ["train", "test"])
    pred = EV.baseline_majority(s.filter("split = 'train'"), s.filter("split = 'test'"))
    return EV.accuracy(pred)


@query("eval_baseline_mean_mse", f"""
WITH s AS (SELECT ln(o_totalprice) AS y,
                  CASE WHEN {hash_sql('o_orderkey', SPLIT_SEED)} % 100 < 80 THEN 'train' ELSE 'test' END AS split FROM orders)
SELECT round(avg(pow(y - (SELECT avg(y) FROM s WHERE split = 'train'), 2)), 6) AS mse FROM s WHERE split = 'test'
""")
def eval_baseline_mean_mse(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", F.log("o_totalprice").alias("y"))
    s = PR.split_by_hash(o, "o_orderkey", [0.8, 0.2], SPLIT_SEED, ["train", "test"])
    pred = EV.baseline_mean(s.filter("split = 'train'"), s.filter("split = 'test'"), "y")
    return EV.mse(pred, "y", "prediction")


@query("prep_year_counts", """
SELECT CAST(substr(CAST(o_orderdate AS VARCHAR), 1, 4) AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS n
FROM orders GROUP BY 1
""")
def prep_year_counts(spark, d):
    """the year is the first four characters of the timestamp string."""
    o = Tables(spark, d).orders
    return o.groupBy(PR.year_from_string(F.col("o_orderdate").cast("string")).alias("year")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


@query("prep_sample_exact_20", f"""
SELECT o_orderkey FROM (
  SELECT o_orderkey, row_number() OVER (ORDER BY {hash_sql('o_orderkey', SAMPLE_SEED)}, o_orderkey) AS rn FROM orders)
WHERE rn <= (SELECT CAST(floor(0.2 * count(*)) AS BIGINT) FROM orders)
""")
def prep_sample_exact_20(spark, d):
    return PR.sample_exact(Tables(spark, d).orders.select("o_orderkey"), "o_orderkey", 0.2, SAMPLE_SEED)
