"""Text column functions (F1, F17–F19, F21 and tokenisation)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: tokens are runs of at least two letters, digits or
# underscores, after lower-casing (the "\b\w\w+\b" rule, Unicode-aware)
TOKEN_RX = r"[\p{L}\p{N}_]{2,}"


def tokens(text: Column) -> Column:
    """Ordered token array of a whole text."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_RX), 0)


# a zero-width match at each token start that captures "token next-token"
# (tokens contain no spaces, so the space-joined string is unambiguous)
_BIGRAM_RX = r"(?<![^ ])(?=([^ ]+ [^ ]+))"


def token_string(text: Column) -> Column:
    """The tokens of a whole text joined by single spaces."""
    return F.array_join(tokens(text), " ")


def grams_of_token_string(ts: Column, ngram_max: int = 2) -> Column:
    """Unigrams (and adjacent bigrams) of a space-joined token string, all
    JVM regex/split work (no interpreted lambdas)."""
    uni = F.when(ts == F.lit(""), F.array().cast("array<string>")).otherwise(F.split(ts, " "))
    if ngram_max < 2:
        return uni
    return F.concat(uni, F.regexp_extract_all(ts, F.lit(_BIGRAM_RX), 1))


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def newline_count(text: Column) -> Column:
    """``wc -l``: number of newline characters."""
    return (F.length(text) - F.length(F.regexp_replace(text, "\n", ""))).cast("bigint")


def last_token(s: Column) -> Column:
    """F19 (``awk '{print $NF}'``): last whitespace-separated token."""
    toks = F.filter(F.split(F.trim(s), r"\s+"), lambda t: t != F.lit(""))
    return F.when(F.size(toks) > 0, F.element_at(toks, -1))


def sha1_hex(content: Column) -> Column:
    """F17."""
    return F.sha1(content.cast("binary"))


def portable_hash32(x: Column) -> Column:
    """32-bit hash reproducible in any SQL engine with md5: the first 8 hex
    digits of md5 of the decimal string, as a bigint in [0, 2^32)."""
    return F.conv(F.substring(F.md5(x.cast("string")), 1, 8), 16, 10).cast("bigint")
