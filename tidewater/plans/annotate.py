"""K8 annotation-cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import annotate as AN
from tidewater.plans.fixtures import ANNOT_SQL, annotated
from tidewater.plans.registry import query
from tidewater.sources.tables import Tables

_W = "WITH " + ANNOT_SQL
PICK_SEED = 7


def _votes(spark, d):
    return annotated(Tables(spark, d))


@query("annot_merge_votes", _W + "SELECT doc_id, label FROM merged")
def annot_merge_votes(spark, d):
    return AN.merge_votes(_votes(spark, d)).select("doc_id", "label")


@query("annot_merge_votes_pick", _W + f"""
SELECT doc_id, CAST(CASE WHEN n0 + n1 = 0 THEN -1 WHEN n1 > n0 THEN 1 WHEN n0 > n1 THEN 0
  ELSE ('0x' || substr(md5(doc_id || ':{PICK_SEED}'), 1, 8))::BIGINT % 2 END AS INTEGER) AS label
FROM merged
""")
def annot_merge_votes_pick(spark, d):
    return AN.merge_votes(_votes(spark, d), tie="pick", seed=PICK_SEED).select("doc_id", "label")


@query("annot_label_distribution", _W + """
SELECT label, CAST(count(*) AS BIGINT) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM merged), 2) AS pct
FROM merged GROUP BY label
""")
def annot_label_distribution(spark, d):
    return AN.distribution(AN.merge_votes(_votes(spark, d)), "label")


@query("annot_disagreements", _W + """
SELECT CAST(count(*) FILTER (WHERE n0 > 0 AND n1 > 0) AS BIGINT) AS n_disagree FROM merged
""")
def annot_disagreements(spark, d):
    return AN.count_disagreements(_votes(spark, d))


@query("annot_agreement", _W + """
SELECT CAST(count(*) FILTER (WHERE (n0 > 0) <> (n1 > 0)) AS BIGINT) AS n_agree,
       round(avg(CASE WHEN (n0 > 0) <> (n1 > 0) THEN 1.0 ELSE 0.0 END), 4) AS agreement_rate
FROM merged
""")
def annot_agreement(spark, d):
    return AN.agreement(_votes(spark, d))


@query("annot_vote_patterns", _W + """
SELECT CAST(count(*) FILTER (WHERE votes = '-1') AS BIGINT) AS n_only_undecided,
       CAST(count(*) FILTER (WHERE regexp_matches(votes, '-1/[0-9]')) AS BIGINT) AS n_undecided_then_vote
FROM votes
""")
def annot_vote_patterns(spark, d):
    return AN.vote_pattern_counts(_votes(spark, d))


@query("annot_dedup_first", "SELECT min(doc_id) AS doc_id FROM documents GROUP BY text")
def annot_dedup_first(spark, d):
    return AN.dedup_first(Tables(spark, d).documents).select("doc_id")


@query("annot_dropped_duplicates", """
WITH f AS (SELECT text, min(doc_id) AS kept FROM documents GROUP BY text)
SELECT d.doc_id, f.kept AS kept_doc_id FROM documents d JOIN f ON d.text = f.text WHERE d.doc_id <> f.kept
""")
def annot_dropped_duplicates(spark, d):
    return AN.dropped_duplicates(Tables(spark, d).documents)


@query("annot_clean_labels", _W + """
, decided AS (SELECT doc_id, text, label FROM merged WHERE label <> -1)
SELECT doc_id, label FROM decided WHERE doc_id IN (SELECT min(doc_id) FROM decided GROUP BY text)
""")
def annot_clean_labels(spark, d):
    merged = AN.drop_undecided(AN.merge_votes(_votes(spark, d)))
    return AN.dedup_first(merged).select("doc_id", "label")
