"""Text-feature queries: term counts, TF-IDF, top terms, transform."""

from __future__ import annotations

from tidewater.operators import textfeat as TF
from tidewater.plans.registry import query
from tidewater.sources.tables import Tables

# fixed values: vocabulary size and n-gram range of the reference's grid point
MAX_FEATURES, NGRAM = 1000, 2

_TOK = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
_GRAMS = f"""
toks AS (SELECT doc_id, {_TOK} AS t FROM documents),
grams AS (
  SELECT doc_id, unnest(t) AS term FROM toks
  UNION ALL
  SELECT doc_id, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) FROM toks),
tf AS (SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY doc_id, term),
vocab AS (
  SELECT term, ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1 AS idf FROM (
    SELECT term, sum(tf) AS cf, count(*) AS df FROM tf GROUP BY term
    ORDER BY cf DESC, term LIMIT {MAX_FEATURES}))
"""


def _tfidf_sql(tf_cte: str) -> str:
    return f"""
w AS (SELECT doc_id, term, tf * idf AS w FROM {tf_cte} JOIN vocab USING (term)),
n AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY doc_id),
tfidf AS (SELECT doc_id, term, round(w / norm, 6) AS tfidf FROM w JOIN n USING (doc_id))
"""


@query("text_term_counts", f"""
SELECT term, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest({_TOK}) AS term FROM documents) GROUP BY term
""")
def text_term_counts(spark, d):
    return TF.term_counts(Tables(spark, d).documents)


@query("text_tfidf", "WITH " + _GRAMS + "," + _tfidf_sql("tf") + "SELECT * FROM tfidf")
def text_tfidf(spark, d):
    return TF.tfidf(Tables(spark, d).documents, MAX_FEATURES, ngram_max=NGRAM)


@query("text_top_terms", "WITH " + _GRAMS + "," + _tfidf_sql("tf") + """
SELECT doc_id, term, tfidf, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY tfidf DESC, term) AS rank FROM tfidf)
WHERE rank <= 10
""")
def text_top_terms(spark, d):
    return TF.top_terms(TF.tfidf(Tables(spark, d).documents, MAX_FEATURES, ngram_max=NGRAM), 10)


@query("text_tfidf_transform", "WITH " + _GRAMS + f""",
btoks AS (SELECT item_id AS doc_id, {_TOK} AS t FROM benchmark),
bgrams AS (
  SELECT doc_id, unnest(t) AS term FROM btoks
  UNION ALL
  SELECT doc_id, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) FROM btoks),
btf AS (SELECT doc_id, term, count(*) AS tf FROM bgrams GROUP BY doc_id, term),
""" + _tfidf_sql("btf") + "SELECT * FROM tfidf")
def text_tfidf_transform(spark, d):
    t = Tables(spark, d)
    vocab = TF.fit_vocabulary(t.documents, MAX_FEATURES, ngram_max=NGRAM)
    bench = t.benchmark.withColumnRenamed("item_id", "doc_id")
    return TF.tfidf_transform(vocab, bench, MAX_FEATURES, ngram_max=NGRAM)
