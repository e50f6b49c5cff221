"""One query for each operator: production parameters, whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import convtrie, decon, grulm, jaccard, langid, linecrf, pairmaps, planes, quality, secrets, spfst, subdup, warc
from tidewater.llm.shared import new_folder
from tidewater.sources.tables import table

QUERIES = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_bit_plane_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written as bit planes and read back."""
    return planes.write_and_digest(table(spark, sf_dir, "documents"))


@query
def op5_blob_ledger_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents through a new ledger: every blob and rule version is unseen."""
    versions = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = secrets.scan(versions, new_folder(spark, "secret-ledger"))
    return secrets.digest(secrets.findings(versions, ledger))


@query
def op9_gzip_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records, normalised from whole-file gzip and read back by index."""
    return warc.archive(table(spark, sf_dir, "pages"))


@query
def op10_line_first_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-first cleaning of all documents: counts and verdicts."""
    found = quality.clean(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.drop("text", "cleaned_text")


SQL["op10_line_first_quality"] = quality.SQL


@query
def op2_count_min_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words of 50-word windows that an earlier one holds."""
    found = subdup.dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@query
def op4_word_first_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents; four fifths of them teach."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    model = langid.train(docs.filter(~held_out))
    found = langid.predict(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op8_seed_align_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item, exact or edited."""
    return decon.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op7_shortest_path_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents by shortest paths, decoded again."""
    return spfst.encode(table(spark, sf_dir, "documents"))


@query
def op3_gru_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and recurrent log probabilities of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    return grulm.train_and_score(docs, held_out)


@query
def op6_divide_skip_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents that share three quarters of their shingles."""
    return jaccard.join(table(spark, sf_dir, "documents"))


@query
def op11_truncation_peeling_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    seqs = convtrie.with_family_openings(convtrie.sequences(table(spark, sf_dir, "conversations")))
    return convtrie.trie(convtrie.paths(seqs))


SQL["op11_truncation_peeling_trie"] = convtrie.SQL


@query
def op12_inverted_pair_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the tokens of two tokenizers in all documents, by their pairs' documents."""
    aligned = pairmaps.align(table(spark, sf_dir, "documents"))
    return pairmaps.scores(aligned, pairmaps.pairs(aligned))


@query
def op13_line_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents by their lines' marginals; three quarters of the labels teach."""
    def held_out():
        return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    found = linecrf.score(docs, linecrf.train(docs, labels.filter(~held_out())))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
