"""Term counts and TF-IDF as long tables.

Contract (the reference's library defaults): lower-case; tokens are runs of
≥2 letters/digits/underscores; optional 1–2-grams; vocabulary = the
``max_features`` most frequent terms over the corpus (ties by term);
tf = raw count; idf = ln((1+n)/(1+df)) + 1; each document's vector is
L2-normalised over its vocabulary terms.

Tokenising whole texts is the expensive step, so a fit does it once: each
document's tokens are written under the shared checkpoint folder, and every
later pass takes words and pairs of neighbours from them. The vocabulary comes
first: corpus frequency per word is a partial ``groupBy(term)``. A pair is no
more frequent than either of its words, so the ``max_features`` most frequent
terms hold no pair with a word rarer than the last of as many words: pairs of
the other words alone are counted, which bounds their exchange by the square of
those words and not by the texts. The occurrences in a document are joined to
the vocabulary *before* the per-document aggregation, so only vocabulary terms
are shuffled, and the counts are written, too. Document frequencies, idf, norms
and weights all derive from that table. A vocabulary of up to
``BROADCAST_TERMS`` terms by its parameter is broadcast; larger or unbounded
ones are joined by an exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions import text as TX
from tidewater.operators.common import attach_scalars
from tidewater.session import cut_lineage, spread


def token_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, toks): whole texts tokenised once, tokens space-joined — the
    one regex-heavy step, and a compact string to write."""
    return spread(docs).select(F.col(id_col).alias("doc_id"), TX.token_string(F.col(text_col)).alias("toks"))


def _grams(ts: DataFrame, ngram_max: int) -> DataFrame:
    return ts.select("doc_id", TX.grams_of_token_string(F.col("toks"), ngram_max).alias("grams"))


def gram_arrays(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                ngram_max: int = 1) -> DataFrame:
    """(doc_id, grams array) over whole texts."""
    return _grams(token_strings(docs, id_col, text_col), ngram_max)


def _explode(garr: DataFrame) -> DataFrame:
    return garr.select("doc_id", F.explode("grams").alias("term"))


def doc_terms(docs: DataFrame, **kw) -> DataFrame:
    """(doc_id, term) per occurrence, over whole texts."""
    return _explode(gram_arrays(docs, **kw))


def term_counts(docs: DataFrame, **kw) -> DataFrame:
    """Corpus frequency of each term."""
    return doc_terms(docs, **kw).groupBy("term").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


#: Terms that a broadcast vocabulary has at most.
BROADCAST_TERMS = 200_000


def _bounded(terms: DataFrame, max_features: int | None) -> DataFrame:
    return F.broadcast(terms) if max_features and max_features <= BROADCAST_TERMS else terms


def token_arrays(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, toks): the tokens of whole texts."""
    return spread(docs).select(F.col(id_col).alias("doc_id"), TX.tokens(F.col(text_col)).alias("toks"))


def _pairs(toks: DataFrame) -> DataFrame:
    """(doc_id, a, b) of each two neighbouring tokens; ``b`` of a last token is null."""
    return toks.select("doc_id", F.inline(F.arrays_zip("toks", F.slice("toks", 2, F.size("toks")))).alias("a", "b"))


def _most_frequent(counted: DataFrame, max_features: int) -> DataFrame:
    return counted.orderBy(F.desc("n"), F.asc("term")).limit(max_features)


def _top_terms_of(toks: DataFrame, max_features: int | None, ngram_max: int) -> DataFrame:
    words = toks.select(F.explode("toks").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    pairs = _pairs(toks).filter(F.col("b").isNotNull())
    pair = F.concat_ws(" ", "a", "b").alias("term")
    if not max_features:
        return (words.select("term").unionByName(pairs.select(pair).distinct()) if ngram_max > 1 else words.select("term"))
    if ngram_max < 2:
        return _most_frequent(words, max_features).select("term")
    words = cut_lineage(words)
    last = _most_frequent(words, max_features).agg(F.when(F.count(F.lit(1)) >= max_features, F.min("n")).otherwise(1).alias("last"))
    frequent = cut_lineage(attach_scalars(words, last).filter("n >= last").select("term"))
    for word in "ab":
        pairs = pairs.join(frequent.withColumnRenamed("term", word), word, "left_semi")
    counted = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).select(pair, "n")
    return _most_frequent(words.unionByName(counted), max_features).select("term")


def _vocab_tf(toks: DataFrame, terms: DataFrame, max_features: int | None, ngram_max: int) -> DataFrame:
    """(doc_id, term, tf) restricted to the vocabulary (joined before the
    per-document aggregation)."""
    found = toks.select("doc_id", F.explode("toks").alias("term")).join(_bounded(terms, max_features), "term", "left_semi")
    if ngram_max > 1:
        two = F.split("term", " ")
        known = terms.filter(F.col("term").contains(" ")).select("term", two[0].alias("a"), two[1].alias("b"))
        found = found.unionByName(_pairs(toks).join(_bounded(known, max_features), ["a", "b"]).select("doc_id", "term"))
    return found.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"))


def _idf(tf: DataFrame, n_docs: DataFrame) -> DataFrame:
    # every vocabulary term occurs in at least one document, so df ≥ 1
    dfreq = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return (attach_scalars(dfreq, n_docs)
            .select("term", (F.log((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1).alias("idf")))


def _fit(docs: DataFrame, max_features: int | None, ngram_max: int = 1, **kw) -> tuple[DataFrame, DataFrame]:
    """Written (doc_id, term, tf) over the vocabulary, and written (term, idf)."""
    toks = cut_lineage(token_arrays(docs, **kw))
    terms = cut_lineage(_top_terms_of(toks, max_features, ngram_max))
    tf = cut_lineage(_vocab_tf(toks, terms, max_features, ngram_max))
    return tf, cut_lineage(_idf(tf, toks.agg(F.count(F.lit(1)).alias("n_docs"))))


def fit_vocabulary(docs: DataFrame, max_features: int | None = 1000, **kw) -> DataFrame:
    """(term, idf) for the vocabulary fitted on ``docs``;
    idf = ln((1 + n_docs) / (1 + df)) + 1."""
    return _fit(docs, max_features, **kw)[1]


def _weights(tf: DataFrame, vocab: DataFrame, max_features: int | None) -> DataFrame:
    w = tf.filter(F.col("doc_id").isNotNull()).join(_bounded(vocab, max_features), "term").withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc_id")))
    return w.select("doc_id", "term", F.round(F.col("w") / norm, 6).alias("tfidf"))


def tfidf_transform(vocab: DataFrame, docs: DataFrame, max_features: int | None = 1000, ngram_max: int = 1, **kw) -> DataFrame:
    """Apply a fitted vocabulary/idf (of at most ``max_features`` terms, if
    given) to documents → (doc_id, term, tfidf)."""
    tf = cut_lineage(_vocab_tf(cut_lineage(token_arrays(docs, **kw)), vocab.select("term"), max_features, ngram_max))
    return _weights(tf, vocab, max_features)


def tfidf(docs: DataFrame, max_features: int | None = 1000, **kw) -> DataFrame:
    """Fit on ``docs`` and transform the same documents."""
    return _weights(*_fit(docs, max_features, **kw), max_features)


def top_terms(weights: DataFrame, n: int = 10) -> DataFrame:
    """The n highest-weighted terms per document (ties → term)."""
    w = Window.partitionBy("doc_id").orderBy(F.desc("tfidf"), F.asc("term"))
    return weights.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
