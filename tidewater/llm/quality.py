"""Line-first cleaning of documents with column expressions only.

Every line is judged alone: by its punctuation, as navigation and as
boilerplate. Lines that fail are removed, and a document that loses more than
``max_lost`` of its words with them is rejected; so is one that fails the base
rules (too few words, or too many words in repeated five-word windows of the
whole text). A null text has no lines and no words. Rows are judged one by one
without any exchange, so repeated rows get equal verdicts; columns of the input
other than those computed here are kept. A very long text costs memory in
proportion to its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
#: Characters that stand between the entries of a menu.
SEPARATORS = "|»›•·"
#: Symbols that prose has few of.
SYMBOLS = "#*$%&|<>"
#: Lines that are all menu entry, lower case.
MENU = ("home", "menu", "login", "log in", "sign in", "sign up", "search", "next", "previous", "back", "contact", "contact us", "about",
        "about us", "sitemap", "read more", "share", "skip to content", "top", "print")
#: Parts of lines that a site or a licence puts into every page, lower case.
BOILERPLATE = ("all rights reserved", "cookie policy", "use cookies", "uses cookies", "accept cookies", "privacy policy", "terms of use",
               "terms of service", "enable javascript", "javascript is disabled", "javascript is required", "lorem ipsum", "click here",
               "subscribe to our", "is licensed under", "copyright (c)", "copyright ©", "©")
#: End of a sentence, a closing quote or bracket may follow.
ENDS = r"[.!?…:;。！？][\x22\x27”’»)\x5D]*$"
#: A line without such an end passes with this many words.
PROSE_WORDS = 10


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def count_of(text: Column, chars: str) -> Column:
    """Number of characters of ``text`` that are in ``chars``."""
    return F.length(F.regexp_replace(text, f"[^{chars}]+", ""))


def line_fails(line: Column, n_words: Column) -> Column:
    """The rules of one line (without white space around it): a struct of
    punctuation, navigation and boilerplate."""
    short = line.rlike(ENDS) | (n_words >= PROSE_WORDS)
    symbols, shouts = count_of(line, r"#*$%&<>"), F.regexp_count(line, F.lit("!!+"))
    bars = count_of(line, SEPARATORS)
    lower = F.lower(line)
    boilerplate = F.lit(False)
    for phrase in BOILERPLATE:
        boilerplate = boilerplate | F.contains(lower, F.lit(phrase))
    return F.struct((~short | (symbols * 4 > n_words) | (shouts * 3 >= n_words)).alias("punctuation"),
                    (((bars >= 2) & (bars * 4 >= n_words)) | lower.isin(*MENU)).alias("navigation"),
                    boilerplate.alias("boilerplate"))


def judged_lines(text: Column) -> Column:
    """Array of (line, n_words, rules, fails) for all lines with a word."""
    lines = F.transform(F.split(text, "\n", -1), lambda x: F.struct(x.alias("line"), F.regexp_count(x, F.lit(WORD)).alias("n_words")))
    lines = F.filter(lines, lambda x: x["n_words"] > 0)
    stripped = lambda x: F.regexp_replace(x, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    lines = F.transform(lines, lambda x: F.struct(x["line"].alias("line"), x["n_words"].alias("n_words"),
                                                  let(stripped(x["line"]), lambda s: line_fails(s, x["n_words"])).alias("rules")))
    return F.transform(lines, lambda x: F.struct(x["line"].alias("line"), x["n_words"].alias("n_words"), x["rules"].alias("rules"),
                                                 (x["rules"]["punctuation"] | x["rules"]["navigation"] | x["rules"]["boilerplate"]).alias("fails")))


def repeated_words(words: Column, width: int = 5) -> Column:
    """Words covered by a window of ``width`` words that occurs at least twice.

    Only texts in which some window repeats sort their windows: equal ones
    become neighbours, and each place counts the words up to the next place."""
    n = F.size(words)
    windows = F.transform(F.sequence(F.lit(0), n - width), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(ordered, lambda s: let(
            F.sort_array(F.transform(F.filter(s, lambda e, k: (F.get(s, k - 1)["h"] == e["h"]) | (F.get(s, k + 1)["h"] == e["h"])), lambda e: e["i"])),
            lambda p: F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(width), F.coalesce(F.get(p, k + 1) - x, F.lit(width)))),
                                  F.lit(0), lambda a, x: a + x)))

    return F.when(n <= width, F.lit(0)).otherwise(
        let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))))


def clean(docs: DataFrame, max_lost: float = 0.5) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, n_lines, n_lines_removed, n_words_removed,
    kept and cleaned_text. Input columns with these names are replaced, and
    ones named _w or _l are left out."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    of_words = let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).cast("long").alias("n_repeat_words")))
    of_lines = let(judged_lines(text), lambda lines: F.struct(
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(F.transform(lines, lambda x: x["line"])))).cast("long").alias("n_dup_lines"),
        F.aggregate(lines, F.lit(0).cast("long"), lambda a, x: a + F.when(x["fails"], F.lit(1)).otherwise(F.lit(0))).alias("n_lines_removed"),
        F.aggregate(lines, F.lit(0).cast("long"), lambda a, x: a + F.when(x["fails"], x["n_words"]).otherwise(F.lit(0))).alias("n_words_removed"),
        F.array_join(F.transform(F.filter(lines, lambda x: ~x["fails"]), lambda x: x["line"]), "\n").alias("cleaned_text")))
    found = docs.withColumns({"_w": of_words, "_l": of_lines, "n_symbols": count_of(text, SYMBOLS).cast("long")})
    found = found.withColumns({"n_words": F.col("_w.n_words"), "word_chars": F.col("_w.word_chars"), "n_repeat_words": F.col("_w.n_repeat_words")}
                              | {c: F.col(f"_l.{c}") for c in ("n_lines", "n_dup_lines", "n_lines_removed", "n_words_removed", "cleaned_text")})
    found = found.drop("_w", "_l").withColumn("base_failed", (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20))
    return found.withColumn("kept", ~F.col("base_failed") & (F.col("n_words_removed") <= F.col("n_words") * F.lit(max_lost)))


#: The same rules for DuckDB, over a view ``documents``.
SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '{WORD}') AS w FROM d),
win AS (SELECT doc_id, i, w[i:i + 4] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT doc_id, sum(least(5, coalesce(nxt - i, 5)))::BIGINT AS n FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM rep) GROUP BY doc_id),
l AS (SELECT doc_id, line, len(regexp_extract_all(line, '{WORD}')) AS n, regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') AS s
      FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)),
j AS (SELECT doc_id, line, n,
      NOT (regexp_matches(s, '{ENDS}') OR n >= {PROSE_WORDS}) OR 4 * length(regexp_replace(s, '[^#*$%&<>]+', '', 'g')) > n OR 3 * len(regexp_extract_all(s, '!!+')) >= n
      OR (length(regexp_replace(s, '[^{SEPARATORS}]+', '', 'g')) >= 2 AND 4 * length(regexp_replace(s, '[^{SEPARATORS}]+', '', 'g')) >= n)
      OR lower(s) IN ({", ".join(f"'{m}'" for m in MENU)}) OR {" OR ".join(f"contains(lower(s), '{b}')" for b in BOILERPLATE)} AS fails
      FROM l WHERE n > 0),
s AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines, coalesce(sum(n) FILTER (fails), 0)::BIGINT AS lost, count(*) AS n_lines,
      count(*) FILTER (fails) AS n_lines_removed FROM j GROUP BY doc_id),
a AS (SELECT w.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
      length(regexp_replace(t, '[^{SYMBOLS}]+', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
      coalesce(cov.n, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_lines_removed, 0)::BIGINT AS n_lines_removed,
      coalesce(lost, 0)::BIGINT AS n_words_removed FROM w LEFT JOIN cov USING (doc_id) LEFT JOIN s USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_words_removed <= 0.5 * n_words AS kept
FROM a
"""
