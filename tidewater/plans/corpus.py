"""K7 file-corpus queries."""

from __future__ import annotations

from tidewater.operators import corpus as C
from tidewater.plans.fixtures import CORPUS_SQL, corpus_files, digest_manifest
from tidewater.plans.registry import query
from tidewater.sources.tables import Tables

_W = "WITH " + CORPUS_SQL

# fixed values: the search string and licence pattern of the corpus questions
NEEDLE = "License"
LICENSE_RX = r"under the (.+?) License"


def _files(spark, d):
    return corpus_files(Tables(spark, d))


@query("corpus_count_by_ext", _W + "SELECT lower(ext) AS ext, CAST(count(*) AS BIGINT) AS n FROM files GROUP BY 1")
def corpus_count_by_ext(spark, d):
    return C.count_by_extension(_files(spark, d))


@query("corpus_count_by_ext_exact", _W + "SELECT ext, CAST(count(*) AS BIGINT) AS n FROM files GROUP BY 1")
def corpus_count_by_ext_exact(spark, d):
    return C.count_by_extension(_files(spark, d), case_insensitive=False)


_NL = "CAST(length(content) - length(replace(content, chr(10), '')) AS BIGINT)"


@query("corpus_line_counts", _W + f"SELECT path, {_NL} AS n_lines FROM files")
def corpus_line_counts(spark, d):
    return C.line_counts(_files(spark, d))


@query("corpus_longest_files", _W + f"SELECT path, {_NL} AS n_lines FROM files ORDER BY n_lines DESC, path LIMIT 10")
def corpus_longest_files(spark, d):
    return C.longest_files(_files(spark, d), 10)


@query("corpus_total_bytes", _W + """
SELECT CAST(count(*) AS BIGINT) AS n_files, CAST(sum(strlen(content)) AS BIGINT) AS total_bytes FROM files
""")
def corpus_total_bytes(spark, d):
    return C.total_bytes(_files(spark, d))


@query("corpus_digests", _W + "SELECT path, sha1(content) AS sha1 FROM files")
def corpus_digests(spark, d):
    return C.digests(_files(spark, d))


@query("corpus_verify_digests", _W + """
, manifest AS (SELECT path, sha1(CASE WHEN ext = 'html' THEN rtrim(content) ELSE content END) AS expected FROM files)
SELECT CAST(count(*) AS BIGINT) AS n_checked,
       CAST(count(*) FILTER (WHERE f.path IS NULL) AS BIGINT) AS n_missing,
       CAST(count(*) FILTER (WHERE sha1(f.content) <> m.expected) AS BIGINT) AS n_mismatch
FROM manifest m LEFT JOIN files f ON f.path = m.path
""")
def corpus_verify_digests(spark, d):
    t = Tables(spark, d)
    return C.verify_digests(corpus_files(t), digest_manifest(t))


@query("corpus_files_and_lines_containing", _W + f"""
SELECT (SELECT CAST(count(*) AS BIGINT) FROM files WHERE contains(content, '{NEEDLE}')) AS n_files,
       (SELECT CAST(count(*) AS BIGINT) FROM file_lines WHERE regexp_matches(line, '\\b{NEEDLE}\\b')) AS n_lines
""")
def corpus_files_and_lines_containing(spark, d):
    return C.files_and_lines_containing(_files(spark, d), NEEDLE)


_LIC = f"""
, lic AS (SELECT path, nullif(regexp_extract(content, '{LICENSE_RX}', 1), '') AS license FROM files)
"""


@query("corpus_license_counts", _W + _LIC + """
SELECT license, CAST(count(*) AS BIGINT) AS n FROM lic WHERE license IS NOT NULL GROUP BY license
""")
def corpus_license_counts(spark, d):
    return C.license_counts(_files(spark, d), LICENSE_RX)


@query("corpus_license_counts_sources", _W + _LIC + """
SELECT license, CAST(count(*) AS BIGINT) AS n FROM lic JOIN files USING (path)
WHERE license IS NOT NULL AND lower(ext) IN ('c', 'h') GROUP BY license
""")
def corpus_license_counts_sources(spark, d):
    """A25 over source files alone, either case."""
    return C.license_counts(_files(spark, d), LICENSE_RX, ["c", "h"])


@query("corpus_top_license", _W + _LIC + """
SELECT license, CAST(count(*) AS BIGINT) AS n FROM lic WHERE license IS NOT NULL GROUP BY license
ORDER BY n DESC, license LIMIT 1
""")
def corpus_top_license(spark, d):
    return C.top_license(_files(spark, d), LICENSE_RX)


@query("corpus_distinct_license_lines", _W + f"""
SELECT DISTINCT line FROM file_lines WHERE contains(line, '{NEEDLE}') ORDER BY line
""")
def corpus_distinct_license_lines(spark, d):
    return C.distinct_lines_containing(_files(spark, d), NEEDLE)


@query("corpus_license_last_word", _W + f"""
SELECT CASE WHEN trim(line) = '' THEN NULL ELSE regexp_extract(trim(line), '(\\S+)$', 1) END AS last_word,
       CAST(count(*) AS BIGINT) AS n
FROM file_lines WHERE contains(line, '{NEEDLE}') GROUP BY 1
""")
def corpus_license_last_word(spark, d):
    return C.last_word_tally(_files(spark, d), NEEDLE)
