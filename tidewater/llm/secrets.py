"""Incremental scan of every version of every path for secrets.

A blob is the text of one version of one path, named by its SHA-256. The
ledger is a table in a folder: one row for each blob and rule version scanned
so far, with the spans found (none, too). ``scan`` reads the ledger, keeps one
copy of each blob for which some rule version is missing, scans only the
missing pairs, appends them, and joins the findings of the ledger back to all
paths and versions. A new version of a rule is a new pair for all blobs; a
path that goes back to an old text costs nothing.

Spans are in code points, with an exclusive end. A null text is scanned as the
empty one. Repeated rows of one path and version give repeated results. Many
copies of a blob meet in one row before any shuffle (``any_value`` by blob),
and findings go back by a join that Spark splits where a blob is frequent.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A pattern with a version; ``accepts`` drops matches that fail (the
    search goes on behind them); ``needs``: lower-case ASCII words of which a
    text holds one, in either case, if it has a match."""
    name: str
    version: int
    pattern: str
    flags: int = 0
    accepts: Callable[[re.Match], bool] | None = None
    needs: tuple[str, ...] = ()

    def spans(self, text: str, lower: bytes) -> list[tuple[int, int]]:
        if self.needs and not any(x.encode() in lower for x in self.needs):
            return []
        found = re.finditer(self.pattern, text, self.flags)
        return [m.span() for m in found if self.accepts is None or self.accepts(m)]


def _long_value(m: re.Match) -> bool:
    return len(m[2]) >= 8


#: The base kinds, in the order in which spans that begin together are listed.
BASE = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         re.IGNORECASE | re.ASCII, _long_value, ("password", "passwd", "secret", "token", "apikey", "api_key")),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}", needs=("akia",)),
    Rule("hex", 1, r"[0-9a-f]{32,}"),
)
#: A key from its BEGIN to its END line whatever stands between; without an END
#: line of the same label, BEGIN and the lines of base64 that follow, if any.
#: Line ends may be written as \n, as in JSON.
PRIVATE_KEY = r"""-----BEGIN\x20((?:[A-Z]+\x20){0,3})PRIVATE\x20KEY-----
(?: (?:(?!-----BEGIN\x20)[\s\S])*?-----END\x20\1PRIVATE\x20KEY-----
  | (?:(?:\s|\\[nr])+(?:Proc-Type|DEK-Info):[^\n\\]*)*
    (?:(?:\s|\\[nr])+[A-Za-z0-9+/]{16,}={0,2})+
    (?:(?:[\x20\t\r]*\n[\x20\t]*|(?:\\r)?\\n)[A-Za-z0-9+/]{1,15}={0,2}(?=\s*(?:\n|\Z)))? )?"""
#: Formats with a mark of their own.
MORE = (
    Rule("private_key", 2, PRIVATE_KEY, re.VERBOSE, needs=("private key-----",)),
    Rule("code_host", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", needs=("gh",)),
    Rule("chat", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}", needs=("xox",)),
    Rule("web_token", 1, r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", needs=("eyj",)),
)
RULES = BASE + MORE
LEDGER = "blob string, rule string, rule_version long, spans array<struct<start:long,end:long>>"
_LEDGER = pa.schema([("blob", pa.string()), ("rule", pa.string()), ("rule_version", pa.int64()),
                     ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def blob_id(text):
    """Content address of a text column."""
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256)


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """All pairs scanned so far; empty when the folder is new."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], LEDGER)
    # a pair twice (two runs at one time) holds the same spans
    return spark.read.schema(LEDGER).parquet(f"{folder}/*").dropDuplicates(["blob", "rule", "rule_version"])


def unseen(versions: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...]) -> DataFrame:
    """One row for each blob with a pair not in the ledger: blob, text, rules
    (the missing ones, as ``name@version``)."""
    wanted = F.array(*[F.lit(f"{r.name}@{r.version}") for r in rules])
    blobs = versions.select(blob_id(F.col("text")).alias("blob"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if ledger is None:
        return blobs.groupBy("blob").agg(F.any_value("text").alias("text")).withColumn("rules", wanted)
    done = ledger.groupBy("blob").agg(F.collect_set(F.concat_ws("@", "rule", "rule_version")).alias("done"))
    left = blobs.join(done, "blob", "left").withColumn("rules", F.when(F.col("done").isNull(), wanted).otherwise(F.array_except(wanted, "done")))
    return left.filter(F.size("rules") > 0).groupBy("blob").agg(F.any_value("text").alias("text"), F.any_value("rules").alias("rules"))


def scan(versions: DataFrame, ledger_folder: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Bring the ledger up to date with ``versions`` (a column ``text`` beside
    any others) and return it."""
    spark = versions.sparkSession
    known = {f"{r.name}@{r.version}": r for r in rules}
    ledger = read_ledger(spark, ledger_folder)

    def search(batches):
        for batch in batches:
            rows = []
            for blob, text, missing in zip(*(batch.column(c).to_pylist() for c in ("blob", "text", "rules")), strict=True):
                lower = text.encode().lower()
                for key in missing:
                    spans = known[key].spans(text, lower)
                    rows.append({"blob": blob, "rule": known[key].name, "rule_version": known[key].version,
                                 "spans": [{"start": a, "end": b} for a, b in spans]})
            yield pa.RecordBatch.from_pylist(rows, _LEDGER)

    todo = unseen(versions, None if ledger.isEmpty() else ledger, rules)
    todo.mapInArrow(search, LEDGER).write.parquet(f"{ledger_folder}/run-{uuid.uuid4().hex[:12]}")
    return read_ledger(spark, ledger_folder)


#: Blobs with findings that are sent to all tasks at most; more are joined by an exchange.
SENT = 100_000


def findings(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES, text: bool = False) -> DataFrame:
    """``versions`` with ``blob`` and ``spans``: an array of (start, rank of
    the rule, end, kind) in this order, of the given rule versions. ``text``
    keeps the text column; as few blobs have findings, these are then counted
    and, if at most ``SENT``, broadcast, so that the texts stay in place. Input
    columns named blob or spans are replaced, and one named _spans is left out."""
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(f"{r.name}@{r.version}"), F.lit(i))])
    hits = ledger.withColumn("rank", F.try_element_at(rank, F.concat_ws("@", "rule", "rule_version"))).filter("rank IS NOT NULL AND size(spans) > 0")
    hits = hits.select("blob", F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.col("rank").alias("rank"),
                                                                      s["end"].alias("end"), F.col("rule").alias("kind"))).alias("spans"))
    hits = hits.groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("_spans"))
    if text and hits.limit(SENT + 1).count() <= SENT:
        hits = F.broadcast(hits)
    keep = [c for c in versions.columns if c not in ("blob", "spans", "_spans") and (text or c != "text")]
    named = versions.select(*keep, blob_id(F.col("text")).alias("blob"))
    return named.join(hits, "blob", "left").withColumn("spans", F.coalesce("_spans", F.array().cast(hits.schema["_spans"].dataType))).drop("_spans")


def listed(spans):
    """kind:start:end of a spans column, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests of the base kinds, and all spans."""
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    return found.select("doc_id", *[of(r.name).alias(f"n_{r.name}") for r in BASE],
                        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), "blob")


def redact(found: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``text`` with every span replaced by ``mark``; spans that overlap are
    one. The parts between the spans are cut out and joined. An input column
    named _cut is left out."""
    last = F.aggregate("spans", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts")),
                       lambda acc, s: F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                                               F.when(s["start"] < acc["at"], acc["parts"]).otherwise(
                                                   F.concat(acc["parts"], F.array(F.substring(F.col("text"), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mark)))).alias("parts")))
    cut = found.withColumn("_cut", last)
    rest = F.expr("substring(text, cast(_cut.at + 1 AS int))")
    return cut.withColumn("text", F.when(F.size("spans") == 0, F.col("text")).otherwise(F.concat(F.array_join("_cut.parts", ""), rest))).drop("_cut")
