"""Language identification by words first, character n-grams second.

``train`` counts words by language over all labelled rows, and character
n-grams (of orders 1 to ``max_order``, over words with their ends marked) from
those counts. What a model sends to all tasks, its head, holds the words that
occur most often: of each language as many as have a count at or over the
smallest threshold that leaves at most ``max_words`` of them, and no more than
``cells`` numbers in all, however many languages there are. All other words and
all n-grams lie in written tables with their counts in every language, and
meet the texts by joins: the head spares work and changes no result.

``predict`` adds, for each word of a text, its log frequency in each language
(count + 0.5, over the language's words and half of one for each different word
of all languages and for an unknown one). A word that was never counted is
scored by the longest counted n-gram that begins at each character of the
marked word, averaged over its characters; a character that was never counted
adds nothing. That n-gram depends only on the ``max_order`` characters that
begin there, so each different run of them is looked up once.

A word is a run of letters, in lower case. The prediction of a text that is
null or has no letter is ``und`` with score 0; so is any without a learned
language. Sums that are equal to six places go to the first language in order.
Rows without letters or language teach nothing; repeated rows count each. The
score is the share of the predicted language in the sum of all languages'
likelihoods.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.shared import drop, saved
from tidewater.session import spread

LETTERS = re.compile(r"[^\W\d_]+")
FLUSH = 300_000  # distinct words that a counting task holds
SALTS = 16  # tasks that share a frequent run of characters
NEVER = math.log(0.5)  # of a count of 0
_COUNTS = pa.schema([("lang", pa.string()), ("n", pa.int64()), ("gram", pa.string()), ("times", pa.int64())])
COUNTS = "lang string, n long, gram string, times long"
PARTS = "gram string, key long, doc_id long, n long, gains array<struct<k:int,v:double>>"


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def _table(counts: dict[tuple[str, int], Counter]) -> pa.RecordBatch:
    langs, orders, grams, times = [], [], [], []
    for (lang, n), found in counts.items():
        langs += [lang] * len(found)
        orders += [n] * len(found)
        grams += found.keys()
        times += found.values()
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((langs, orders, grams, times), _COUNTS.types, strict=True)], schema=_COUNTS)


def count_words(labelled: DataFrame) -> DataFrame:
    """lang, n = 0, gram (a word) and times."""
    def count(batches):
        held, size = {}, 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = held.setdefault((lang, 0), Counter())
                before = len(found)
                found.update(words_of(text))
                size += len(found) - before
                if size > FLUSH:
                    yield _table(held)
                    held, size = {}, 0
        yield _table(held)

    rows = labelled.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).filter("lang IS NOT NULL AND text IS NOT NULL")
    return rows.mapInArrow(count, COUNTS).groupBy("lang", "n", "gram").agg(F.sum("times").alias("times"))


def count_grams(words: DataFrame, max_order: int) -> DataFrame:
    """lang, n, gram and times of the character n-grams of counted words."""
    def count(batches):
        held, size = {}, 0
        for batch in batches:
            for lang, word, times in zip(*(batch.column(c).to_pylist() for c in ("lang", "gram", "times")), strict=True):
                marked = f"^{word}$"
                for n in range(1, max_order + 1):
                    found = held.setdefault((lang, n), Counter())
                    for i in range(len(marked) - n + 1):
                        found[marked[i:i + n]] += times
            size = sum(map(len, held.values()))
            if size > FLUSH:
                yield _table(held)
                held = {}
        yield _table(held)

    return spread(words).mapInArrow(count, COUNTS).groupBy("lang", "n", "gram").agg(F.sum("times").alias("times"))


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The grams (n, gram) of some language and order with a count at or over
    the smallest one that leaves at most ``most`` of them."""
    # a row for each different count: few, and no task sorts the grams
    by = Window.partitionBy("lang", "n").orderBy(F.desc("times"))
    steps = counts.groupBy("lang", "n", "times").agg(F.count("*").alias("grams")).withColumn("kept", F.sum("grams").over(by))
    least = steps.filter(F.col("kept") <= most).groupBy("lang", "n").agg(F.min("times").alias("least"))
    return counts.join(least, ["lang", "n"]).filter("times >= least").select("n", "gram").distinct()


def by_gram(counts: DataFrame, langs: DataFrame) -> DataFrame:
    """gram and, of each language that has it, its number and what the count
    gains over none: an array as long as the languages at most."""
    gain = F.struct("k", (F.log(F.col("times") + 0.5) - NEVER).cast("float").alias("v"))
    return counts.join(langs, "lang").groupBy("gram").agg(F.collect_list(gain).alias("gains"))


@dataclass
class Model:
    """What is sent: the head's words by their row in a table of gains with a
    column for each language."""
    langs: list[str]
    words: dict[str, int]
    gains: np.ndarray


@dataclass
class Trained(Model):
    """A model, the written gains of all words outside its head and of all
    n-grams, and by language and order (0: words) the log of what divides a count."""
    max_order: int
    log_totals: np.ndarray
    tail: DataFrame | None = None
    grams: DataFrame | None = None

    def sent(self) -> Model:
        return Model(self.langs, self.words, self.gains)


def train(labelled: DataFrame, max_words: int = 50_000, max_order: int = 4, cells: int = 1 << 22) -> Trained:
    """Fit on all rows of ``labelled`` (text, lang), all languages. A head of
    any size gives equal predictions."""
    words = saved(count_words(labelled), "lang-words")
    grams = saved(count_grams(words, max_order), "lang-grams")
    totals = {(r["lang"], r["n"]): r["t"] for t in (words, grams) for r in t.groupBy("lang", "n").agg(F.sum("times").alias("t")).collect()}
    langs = sorted({lang for lang, _ in totals})
    if not langs:
        drop(words, grams)
        return Trained(langs, {}, np.zeros((0, 0)), max_order, np.zeros((0, max_order + 1)))
    numbers = labelled.sparkSession.createDataFrame([(lang, k) for k, lang in enumerate(langs)], "lang string, k int")
    head = saved(most_frequent(words, min(max_words, cells // len(langs) ** 2)), "lang-head")
    # at most ``cells`` rows
    listed = by_gram(words.join(head, ["n", "gram"], "left_semi"), numbers).toArrow()
    index = {gram: i for i, gram in enumerate(listed.column("gram").to_pylist())}
    gains = np.zeros((len(index), len(langs)))
    for i, found in enumerate(listed.column("gains").to_pylist()):
        for gain in found:
            gains[i, gain["k"]] = gain["v"]
    tail = saved(by_gram(words.join(head, ["n", "gram"], "left_anti"), numbers), "lang-tail")
    wide = saved(by_gram(grams, numbers), "lang-pieces")
    drop(words, grams, head)
    different = {r["n"]: r["count"] for r in wide.groupBy(F.length("gram").alias("n")).count().collect()} | {0: len(index) + tail.count()}
    log_totals = np.log([[totals.get((lang, n), 0) + 0.5 * different.get(n, 0) + 0.5 for n in range(max_order + 1)] for lang in langs])
    return Trained(langs, index, gains, max_order, log_totals, tail, wide)


def stems_of(words: DataFrame, order: int) -> DataFrame:
    """word, size, stem and times: the runs of ``order`` characters (fewer at
    the end) that begin at the characters of each marked word."""
    def cut(batches):
        for batch in batches:
            names, grams = batch.column("word").to_pylist(), batch.column("gram").to_pylist()
            for at in range(0, len(grams), 1_000):
                ids, sizes, stems, times = [], [], [], []
                for name, gram in zip(names[at:at + 1_000], grams[at:at + 1_000], strict=True):
                    marked = f"^{gram}$"
                    found = Counter(marked[i:i + order] for i in range(len(marked)))
                    ids += [name] * len(found)
                    sizes += [len(marked)] * len(found)
                    stems += found.keys()
                    times += found.values()
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(sizes, pa.int64()), pa.array(stems, pa.string()), pa.array(times, pa.int64())],
                                                 ["word", "size", "stem", "times"])

    return words.select("word", "gram").mapInArrow(cut, "word string, size long, stem string, times long")


def back_off(words: DataFrame, model: Trained) -> DataFrame:
    """word, k and v of never-counted words: the mean over its characters of
    the longest counted n-grams' logs, less what a word has whose count is 0."""
    # a run that many words share is dealt out, as are the short beginnings that many runs share
    places = saved(stems_of(words, model.max_order), "lang-stems")
    cut = places.select("stem").distinct().select("stem", F.explode(F.sequence(F.lit(1), F.length("stem"))).alias("n"))
    part = F.when(F.col("n") <= 2, F.pmod(F.xxhash64("stem"), F.lit(SALTS))).otherwise(F.lit(0).cast("long"))
    cut = cut.select("stem", "n", F.substr("stem", F.lit(1), F.col("n")).alias("piece"), part.alias("part"))
    every = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    parts = F.when(F.length("gram") <= 2, every).otherwise(F.array(F.lit(0).cast("long")))
    known = model.grams.select(F.col("gram").alias("piece"), "gains", F.explode(parts).alias("part"))
    longest = cut.join(known, ["piece", "part"]).groupBy("stem").agg(F.max_by(F.struct("n", "gains"), "n").alias("at"))
    none = [F.array(*map(F.lit, logs)) for logs in (NEVER - model.log_totals).T.tolist()]  # of a count of 0, by order
    gain = F.map_from_entries("at.gains")
    logs = F.transform(F.get(F.array(*none), F.col("at.n")), lambda log, k: log + F.coalesce(F.try_element_at(gain, k), F.lit(0.0)))
    longest = longest.select("stem", logs.alias("logs"), F.explode(every).alias("salt"))
    met = places.withColumn("salt", F.pmod(F.xxhash64("word"), F.lit(SALTS))).join(longest, ["stem", "salt"])
    met = met.select("word", F.posexplode("logs").alias("k", "v"), (F.col("times") / F.col("size")).alias("share"))
    own = words.select("word", F.posexplode(none[0]).alias("k", "v"), F.lit(-1.0).alias("share"))
    return met.unionByName(own).groupBy("word", "k").agg(F.sum(F.col("v") * F.col("share")).cast("float").alias("v"))


def outside_scores(words: DataFrame, model: Trained) -> DataFrame:
    """word, k and v of words outside the head, each once."""
    met = saved(words.join(model.tail, "gram", "left").withColumn("word", _short("gram")), "lang-met")
    counted = met.filter("gains IS NOT NULL").select("word", F.inline("gains"))
    scores = saved(counted.unionByName(back_off(met.filter("gains IS NULL"), model)), "lang-outside")
    drop(met)
    return scores


def _short(column: str) -> Column:
    """A word, or a mark and the MD5 of one that is long."""
    return F.when(F.length(column) <= 32, F.col(column)).otherwise(F.concat(F.lit("#"), F.md5(F.col(column).cast("binary"))))


def predict(docs: DataFrame, model: Trained) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every row, from the text alone."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    langs, log_totals = model.langs, model.log_totals
    if not langs:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model.sent())  # bounded by the limits of train()
    gain_type = pa.struct([("k", pa.int32()), ("v", pa.float64())])

    def begin(batches):
        """Of each text a row without a gram, with its number of words and the
        gains of those in the head, and a row for each other word."""
        model = shared.value
        row_of, gains = model.words.get, model.gains
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                keys = part.column("key").to_pylist()
                counts, grams, owners, times, offsets, ks, vs = [], [], [], [], [0], [], []
                for key, text in zip(keys, part.column("text").to_pylist(), strict=True):
                    words = words_of(text)
                    known = np.array([row_of(w, -1) for w in words], np.int64)
                    inside = known >= 0
                    total = gains[known[inside]].sum(0)
                    held = np.flatnonzero(total)
                    ks += held.tolist()
                    vs += total[held].tolist()
                    offsets.append(len(ks))
                    counts.append(len(words))
                    outside = Counter(words[i] for i in np.flatnonzero(~inside).tolist())
                    grams += outside.keys()
                    times += outside.values()
                    owners += [key] * len(outside)
                more = len(grams)
                offsets = pa.array(offsets + [offsets[-1]] * more, pa.int32())
                pairs = pa.StructArray.from_arrays([pa.array(ks, pa.int32()), pa.array(vs, pa.float64())], fields=list(gain_type))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([None] * len(keys) + grams, pa.string()), pa.array(keys + owners, pa.int64()),
                     pa.array(part.column("doc_id").to_pylist() + [None] * more, pa.int64()), pa.array(counts + times, pa.int64()),
                     pa.ListArray.from_arrays(offsets, pairs)], ["gram", "key", "doc_id", "n", "gains"])

    def label(batches):
        most = max(1, (1 << 20) // len(langs))
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                part = batch.slice(at, most)
                found, sizes = part.column("gains").flatten(), part.column("gains").value_lengths().to_numpy()
                n = part.column("n").to_numpy()
                total = n[:, None] * (NEVER - log_totals[:, 0])
                total[np.repeat(np.arange(len(sizes)), sizes), found.field(0).to_numpy()] += found.field(1).to_numpy()
                total = np.round(total, 6)
                best, some = total.argmax(1), n > 0
                shares = np.where(some, 1.0 / np.exp(total - total[np.arange(len(best)), best][:, None]).sum(1), 0.0)
                preds = [langs[k] if has else "und" for k, has in zip(best.tolist(), some.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(preds, pa.string()), pa.array(shares)], ["doc_id", "lang_pred", "score"])

    parts = saved(rows.withColumn("key", F.monotonically_increasing_id()).mapInArrow(begin, PARTS), "lang-parts")
    nothing = F.array(F.struct(F.lit(0).alias("k"), F.lit(0.0).alias("v")))
    own = parts.filter("gram IS NULL").select("key", "doc_id", "n", F.inline(F.when(F.size("gains") > 0, F.col("gains")).otherwise(nothing)))
    outside = parts.filter("gram IS NOT NULL").select("gram", "key", "n")
    scores = outside_scores(outside.select("gram").distinct(), model)
    met = outside.join(scores, _short("gram") == scores["word"]).select("key", F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("n"), "k", (F.col("v").cast("double") * F.col("n")).alias("v"))
    sums = own.unionByName(met).groupBy("key", "k").agg(F.sum("v").alias("v"), F.max("doc_id").alias("doc_id"), F.max("n").alias("n"))
    whole = sums.groupBy("key").agg(F.max("doc_id").alias("doc_id"), F.max("n").alias("n"), F.collect_list(F.struct("k", "v")).alias("gains"))
    return whole.select("doc_id", "n", "gains").mapInArrow(label, "doc_id long, lang_pred string, score double")
