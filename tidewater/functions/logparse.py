"""SSH auth-log column functions (F2–F6). All are JVM-side regex
expressions; no Python runs per line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the message markers the log analytics keys on
PASSWORD = "password"
ACCEPTED = "Accepted password"
FAILED = "Failed password"
INVALID = "invalid user"
REPEAT_RX = r"message repeated (\d+) times:"
SINGLE_RX = r"for\s(?:invalid user\s)?(\w+)\sfrom"
IPV4_RX = r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}"


def _word_after(line: Column, word: str) -> Column:
    # first whitespace-delimited token exactly equal to `word`, then the next token
    return F.nullif(F.regexp_extract(line, rf"(?:^|\s){word}\s+(\S+)", 1), F.lit(""))


def username(line: Column) -> Column:
    """the token after ``user`` when the line has ``invalid user``, else
    the token after ``for``; null when neither is present (D4)."""
    return F.when(line.contains(INVALID), _word_after(line, "user")).otherwise(_word_after(line, "for"))


def username_single_regex(line: Column) -> Column:
    """the one-regex variant ``for\\s(?:invalid user\\s)?(\\w+)\\sfrom``
    (drops names containing ``-`` or ``.``)."""
    return F.nullif(F.regexp_extract(line, SINGLE_RX, 1), F.lit(""))


def ipv4(line: Column) -> Column:
    """first dotted-quad in the line, null if none."""
    return F.nullif(F.regexp_extract(line, IPV4_RX, 0), F.lit(""))


def repeat_count(line: Column) -> Column:
    """N of ``message repeated N times:``, else 1."""
    n = F.nullif(F.regexp_extract(line, REPEAT_RX, 1), F.lit(""))
    return F.coalesce(n.try_cast("int"), F.lit(1))


def month_day(line: Column) -> tuple[Column, Column]:
    """the first two whitespace-separated words."""
    toks = F.split(F.trim(line), r"\s+")
    return toks.getItem(0), toks.getItem(1)
