"""Annotation cleaning (K8: V1–V3, W5, J4, A17–A19, P15, P18).

Votes are slash-joined strings (``"1/0/-1"``). All vote logic is array
expressions on the row (``split``/``filter``/``aggregate``); no explode, no
per-row Python. Duplicate texts are found by a SHA-256 key with a grouped
``min`` (partial aggregation: a text repeated a million times still ships
one row per map task), never by a window over the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.common import attach_scalars

UNDECIDED = -1


def _valid_votes(votes: Column) -> Column:
    return F.filter(F.split(votes, "/"), lambda v: (v != F.lit("-1")) & (v != F.lit("")))


def _tally(valid: Column) -> Column:
    """array<struct<n, v>> sorted by count desc then value asc."""
    counted = F.transform(F.array_distinct(valid), lambda v: F.struct(
        F.size(F.filter(valid, lambda x: x == v)).alias("n"), v.alias("v")))
    return F.array_sort(counted, lambda a, b: F.when(a["n"] > b["n"], -1).when(a["n"] < b["n"], 1)
                        .when(a["v"] < b["v"], -1).when(a["v"] > b["v"], 1).otherwise(0))


def merge_votes(df: DataFrame, col: str = "votes", tie: str = "undecided",
                seed: int = 0, out: str = "label", key: str = "doc_id") -> DataFrame:
    """V1/V2: drop ``-1`` votes; a unique most-frequent vote wins. Ties give
    ``-1`` (``tie='undecided'``) or a repeatable pseudo-random pick among the
    tied values (``tie='pick'``, md5 of the column ``key`` and the seed). No
    votes → ``-1``."""
    valid = _valid_votes(F.col(col))
    tally = _tally(valid)
    top = F.element_at(tally, 1)
    n_top = F.size(F.filter(tally, lambda t: t["n"] == top["n"]))
    if tie == "undecided":
        chosen = F.when(n_top == 1, top["v"])
    elif tie == "pick":
        keyed = F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))
        h = F.conv(F.substring(F.md5(keyed), 1, 8), 16, 10).cast("bigint")
        idx = (h % n_top + 1).cast("int")
        chosen = F.element_at(tally, idx)["v"]
    else:
        raise ValueError(tie)
    label = F.when(F.size(valid) == 0, F.lit(UNDECIDED)).otherwise(
        F.coalesce(chosen.try_cast("int"), F.lit(UNDECIDED)))
    return df.withColumn(out, label.cast("int"))


def drop_undecided(df: DataFrame, col: str = "label") -> DataFrame:
    """P15."""
    return df.filter(F.col(col) != UNDECIDED)


def text_key(text: Column) -> Column:
    return F.sha2(text, 256)


def first_of_duplicates(df: DataFrame, text: str = "text", order: str = "doc_id") -> DataFrame:
    """(text key, first id, number of rows) for every distinct text."""
    return (df.select(text_key(F.col(text)).alias("_k"), order).groupBy("_k")
            .agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_n")))


def dedup_first(df: DataFrame, text: str = "text", order: str = "doc_id") -> DataFrame:
    """Keep the first row (smallest ``order``, which names a row) of each
    distinct text."""
    firsts = first_of_duplicates(df, text, order).select(F.col("_first").alias(order))
    return df.join(firsts, order, "left_semi")


def dropped_duplicates(df: DataFrame, text: str = "text", order: str = "doc_id", salts: int = 32) -> DataFrame:
    """Rows removed by ``dedup_first`` with the id that was kept. Only
    groups of several rows are joined; they are replicated to ``salts`` salts,
    and a text's rows spread over these."""
    salted = df.select(text_key(F.col(text)).alias("_k"), order, F.pmod(F.xxhash64(order), F.lit(salts)).alias("_salt"))
    groups = (first_of_duplicates(df, text, order).filter("_n > 1")
              .select("_k", "_first", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))).alias("_salt")))
    return (salted.join(groups, ["_k", "_salt"]).filter(F.col(order) != F.col("_first"))
            .select(order, F.col("_first").alias("kept_" + order)))


def distribution(df: DataFrame, col: str) -> DataFrame:
    """Value counts and percentage (2 decimals)."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("_t"))
    return (attach_scalars(counts, total)
            .select(col, F.col("n").cast("bigint").alias("n"),
                    F.round(F.col("n") * 100.0 / F.col("_t"), 2).alias("pct")))


def count_disagreements(df: DataFrame, col: str = "votes") -> DataFrame:
    """Rows whose valid votes include both 0 and 1."""
    valid = _valid_votes(F.col(col))
    return df.agg(F.count_if(F.array_contains(valid, "0") & F.array_contains(valid, "1"))
                  .cast("bigint").alias("n_disagree"))


def agreement(df: DataFrame, col: str = "votes") -> DataFrame:
    """Agreement flag (exactly one distinct valid vote) and the rate."""
    valid = _valid_votes(F.col(col))
    flag = F.size(F.array_distinct(valid)) == 1
    return df.agg(F.count_if(flag).cast("bigint").alias("n_agree"),
                  F.round(F.avg(flag.cast("double")), 4).alias("agreement_rate"))


def vote_pattern_counts(df: DataFrame, col: str = "votes") -> DataFrame:
    """Rows that are exactly ``-1``; rows with ``-1/`` followed by a digit."""
    c = F.col(col)
    return df.agg(F.count_if(c.rlike(r"^-1$")).cast("bigint").alias("n_only_undecided"),
                  F.count_if(c.rlike(r"-1/[0-9]")).cast("bigint").alias("n_undecided_then_vote"))
