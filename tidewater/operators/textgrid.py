"""The TF-IDF and logistic-regression grid by one fit.

Every point of the grid (vocabulary size × penalty strength × penalty kind) and
every fold is one group of columns of a weight matrix, so one pass over the
documents gives the gradients of all of them; each n-gram setting has a matrix. Terms are counted once:
a fold's training counts are the total less the fold's own, which gives each
fold its vocabulary (the most frequent terms; smaller ones are the first ranks
of larger ones) and its idf. Documents keep plain term counts over the union of
the vocabularies; idf, the scale of a column and the vocabulary's cut are
factors of the weights. Counts and gradients are made where a document lies; only
sums by term are exchanged.

A block of documents is of one fold and multiplies what can differ from zero
only: the terms that it has, the columns of the other folds, for a term those
whose vocabulary is large enough, and all classes but the last (scores count by
their differences, and a document's errors add up to zero).

The loss is that of ``pyspark.ml``'s logistic regression: mean cross entropy plus
``1 / (c · n)`` times the penalty (L1 or half the squares) of the weights of
columns scaled to unit deviation; the intercept is free. Weights come by
accelerated proximal gradients with restarts, of a step from the largest
eigenvalue of each fold's columns (power iteration).

The driver holds the weights only, whose size the grid bounds: union of the
vocabularies × points × folds × classes. Gradients are summed in Spark, a part of
the terms in each row. A document with no term of a vocabulary has the
intercepts alone; rows with a null label, fold or id are left out, a null text
has no terms; repeated ids are documents of their own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions import text as TX
from tidewater.session import cut_lineage, ship_package, spread

_BLOCK = 1_024  # documents multiplied at a time
_PART = 512  # terms of a row of summed gradients


@dataclass(frozen=True)
class Point:
    """A column group: fold, n-grams, vocabulary size, c and whether the penalty is L1."""

    fold: int
    ngram: int
    vocab: int
    c: float
    l1: bool


def documents(docs: DataFrame, label: str, text: str, fold: str) -> DataFrame:
    """(label, fold, toks): the words of each text, written once."""
    used = docs.filter(F.col(label).isNotNull() & F.col(fold).isNotNull())
    return cut_lineage(spread(used).select(F.col(label).cast("string").alias("label"), F.col(fold).cast("int").alias("fold"),
                                           TX.tokens(F.coalesce(F.col(text), F.lit(""))).alias("toks")))


def _of_other_folds(terms: DataFrame, key: list[str], folds: list[int], name: str) -> DataFrame:
    """(key, fold, name): how many rows of ``terms`` the other folds have, if any."""
    own = terms.groupBy(*key).agg(F.count(F.lit(1)).alias("every"), *[F.count_if(F.col("fold") == f).alias(f"own{i}") for i, f in enumerate(folds)])
    others = F.array(*[F.struct(F.lit(f).alias("fold"), (F.col("every") - F.col(f"own{i}")).alias(name)) for i, f in enumerate(folds)])
    return own.select(*key, F.inline(others)).filter(F.col(name) > 0)


def _first(terms: DataFrame, most: int) -> DataFrame:
    """The ``most`` most frequent terms (ties by term) of each fold, with their rank from 0 on."""
    w = Window.partitionBy("fold").orderBy(F.desc("tf"), "term")
    return terms.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most).withColumn("rank", F.col("rank") - 1)


def ranked_terms(rows: DataFrame, folds: list[int], most: int, ngrams: list[int]) -> DataFrame:
    """(term, place, fold, ngram, rank): of each fold and n-gram setting the
    ``most`` most frequent terms of the other folds (ties by term), ranked from
    0 on; ``place`` numbers the terms of the union by their best rank.

    A pair is no more frequent than either of its words, so only pairs of words
    as frequent as a fold's last kept word can be among its terms; others
    aren't counted."""
    words = cut_lineage(_of_other_folds(rows.select("fold", F.explode("toks").alias("term")), ["term"], folds, "tf"))
    alone = cut_lineage(_first(words, most))
    found = [alone.withColumn("ngram", F.lit(n)) for n in ngrams if n < 2]
    if any(n > 1 for n in ngrams):
        bounds = F.broadcast(alone.groupBy("fold").agg(F.when(F.count(F.lit(1)) >= most, F.min("tf")).otherwise(1).alias("bound")))
        frequent = cut_lineage(words.join(bounds, "fold").filter("tf >= bound").select("term").distinct())
        pairs = rows.select("fold", F.inline(F.arrays_zip("toks", F.slice("toks", 2, F.size("toks")))).alias("a", "b"))
        for word in "ab":  # the last word has no next one: null, in no join
            pairs = pairs.join(frequent.withColumnRenamed("term", word), word, "left_semi")
        counted = _of_other_folds(pairs, ["a", "b"], folds, "tf").join(bounds, "fold").filter("tf >= bound")
        both = _first(words.unionByName(counted.select(F.concat_ws(" ", "a", "b").alias("term"), "fold", "tf")), most)
        found += [both.withColumn("ngram", F.lit(n)) for n in ngrams if n > 1]
    kept = found[0]
    for other in found[1:]:
        kept = kept.unionByName(other)
    kept = cut_lineage(kept.select("term", "fold", "ngram", "rank"))
    # the union has most × folds × settings terms at the most
    union = kept.groupBy("term").agg(F.min("rank").alias("best")).select("term", (F.row_number().over(Window.orderBy("best", "term")) - 1).alias("place"))
    return cut_lineage(kept.join(F.broadcast(union), "term"))


def document_frequencies(terms: DataFrame, table: DataFrame, folds: list[int]) -> DataFrame:
    """``terms`` with ``df``: documents of the other folds that have the term, by the table of ``counts_by_place``."""
    found = _of_other_folds(table.select("fold", F.explode("places").alias("place")), ["place"], folds, "df")
    return cut_lineage(terms.join(found, ["place", "fold"]).select("term", "place", "fold", "ngram", "rank", "df"))


def vocabularies(rows: DataFrame, folds: list[int], most: int, ngrams: list[int]) -> DataFrame:
    """(term, place, fold, ngram, rank, df): ``ranked_terms`` with their document frequencies."""
    terms = ranked_terms(rows, folds, most, ngrams)
    return document_frequencies(terms, counts_by_place(rows, terms), folds)


def counts_by_place(rows: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(label, fold, places, counts) of every document, over the union of the
    vocabularies; the documents of a file ordered by fold and label."""
    terms = vocabulary.select("term", "place").distinct().collect()  # bounded by the grid
    words = sorted({w for r in terms for w in r["term"].split(" ")})
    number, size = {w: i for i, w in enumerate(words)}, max((r["place"] for r in terms), default=-1) + 1
    alone = np.full(len(words) + 1, -1)  # the last one stands for all other words
    pairs = []
    for r in terms:
        ids = [number[w] for w in r["term"].split(" ")]
        if len(ids) == 1:
            alone[ids[0]] = r["place"]
        else:
            pairs.append((ids[0] * len(words) + ids[1], r["place"]))
    codes, places = np.array(sorted(pairs), np.int64).reshape(-1, 2).T

    def count(batches):
        known = pa.array(words, pa.string())
        for batch in batches:
            for at in range(0, batch.num_rows, _BLOCK):
                part = batch.slice(at, _BLOCK)
                lists = part.column("toks")
                owner = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
                word = pc.fill_null(pc.index_in(lists.flatten().cast(pa.string()), value_set=known), -1).to_numpy(zero_copy_only=False)
                keys = [(owner * size + alone[word])[alone[word] >= 0]]
                if len(codes):
                    follows = np.flatnonzero((owner[1:] == owner[:-1]) & (word[1:] >= 0) & (word[:-1] >= 0))
                    code = word[follows].astype(np.int64) * len(words) + word[follows + 1]
                    found = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
                    hit = codes[found] == code
                    keys.append(owner[follows[hit]] * size + places[found[hit]])
                key, n = np.unique(np.concatenate(keys), return_counts=True)
                ends = np.searchsorted(key, np.arange(part.num_rows + 1) * size)
                yield pa.RecordBatch.from_arrays([part.column("label"), part.column("fold"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(key % max(size, 1), pa.int32())),
                                                  pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(n, pa.float32()))], ["label", "fold", "places", "counts"])

    found = spread(rows.select("label", "fold", "toks")).mapInArrow(count, "label string, fold int, places array<int>, counts array<float>")
    return cut_lineage(found.sortWithinPartitions("fold", "label"))


def _blocks(batches, size: int, classes: list[str]):
    """Dense blocks of term counts of one fold: the counts of the terms that the
    block has, their places, the documents' classes, the fold."""
    known = pa.array(classes, pa.string())
    for batch in batches:
        fold = batch.column("fold").to_numpy()
        ends = [0, *(np.flatnonzero(np.diff(fold)) + 1), len(fold)]
        for at, end in ((k, min(k + _BLOCK, hi)) for lo, hi in zip(ends, ends[1:]) for k in range(lo, hi, _BLOCK)):
            part = batch.slice(at, end - at)
            lists = part.column("places")
            owner = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            place = lists.flatten().to_numpy()
            there = np.zeros(size, bool)
            there[place] = True
            X = np.zeros((part.num_rows, int(there.sum())), np.float32)
            X[owner, (np.cumsum(there) - 1)[place]] = part.column("counts").flatten().to_numpy()
            yield X, np.flatnonzero(there), pc.index_in(part.column("label"), value_set=known).to_numpy(zero_copy_only=False), int(fold[at])


@dataclass(frozen=True)
class Columns:
    """Columns by blocks' fold, those of large vocabularies first, and how many of
    them (``wide``) the places from ``lo`` to ``hi`` can have: ``cuts`` by fold."""

    of: dict[int, np.ndarray]
    cuts: dict[int, list[tuple[int, int, int]]]

    def scores(self, X: np.ndarray, at: np.ndarray, fold: int, weights: np.ndarray) -> np.ndarray:
        """Counts times weights of (places × columns of the fold × classes)."""
        s = np.zeros((len(X), *weights.shape[1:]), np.float32)
        for lo, hi, wide in self.cuts[fold]:
            a, b = np.searchsorted(at, [lo, hi])
            if a < b:  # the block has such terms
                s[:, :wide] += (X[:, a:b] @ weights[at[a:b], :wide].reshape(b - a, -1)).reshape(len(X), wide, -1)
        return s

    def add_products(self, X: np.ndarray, at: np.ndarray, fold: int, p: np.ndarray, total: np.ndarray) -> None:
        """Adds counts, transposed, times ``p`` (documents × columns × classes)."""
        for lo, hi, wide in self.cuts[fold]:
            a, b = np.searchsorted(at, [lo, hi])
            if a < b:
                total[at[a:b], :wide] += (X[:, a:b].T @ p[:, :wide].reshape(len(X), -1)).reshape(b - a, wide, -1)

    def summed(self, blocks, plain: np.ndarray, change) -> np.ndarray | None:
        """Over all blocks the products of ``change``'d scores, and in a last row their sums."""
        weights, total = {}, {}
        for X, at, y, fold in blocks:
            if fold not in weights:
                weights[fold] = np.ascontiguousarray(plain[:, self.of[fold]])
                total[fold] = np.zeros((len(plain) + 1, *weights[fold].shape[1:]))
            p = change(self.scores(X, at, fold, weights[fold]), y, self.of[fold])
            self.add_products(X, at, fold, p, total[fold])
            total[fold][-1] += p.sum(0, dtype=np.float64)
        if not total:
            return None
        out = np.zeros((len(plain) + 1, *plain.shape[1:]))
        for fold, found in total.items():
            out[:, self.of[fold]] += found
        return out.reshape(len(out), -1)


def _summed(table: DataFrame, size: int, partial) -> np.ndarray:
    """Sum over all tasks of a matrix with ``size`` rows that ``partial`` makes
    of a task's batches; summed in Spark, some rows of it at a time."""
    parts = -(-size // _PART)

    def send(batches):
        total = partial(batches)
        if total is not None:
            yield pa.RecordBatch.from_pydict({"part": list(range(parts)), "data": [total[k * _PART:(k + 1) * _PART].astype(np.float32).tobytes() for k in range(parts)]})

    def add(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, data in zip(batch.column("part").to_pylist(), batch.column("data").to_pylist()):
                values = np.frombuffer(data, np.float32).astype(np.float64)
                held[k] = held[k] + values if k in held else values
        if held:
            yield pa.RecordBatch.from_pydict({"part": list(held), "data": [v.tobytes() for v in held.values()]})

    found = table.mapInArrow(send, "part bigint, data binary").repartition("part").mapInArrow(add, "part bigint, data binary").collect()
    return np.concatenate([np.frombuffer(r["data"]) for r in sorted(found, key=lambda r: r["part"])]).reshape(size, -1) if found else np.zeros((size, 0))


class Grid:
    """Weights of all points, and the passes over the documents."""

    def __init__(self, table: DataFrame, vocabulary: DataFrame, points: list[Point], classes: list[str], sizes: dict[int, int]):
        self.table, self.points, self.classes = table, points, classes
        terms = vocabulary.select("place", "fold", "ngram", "rank", "df").collect()  # bounded by the grid
        self.size = max((r["place"] for r in terms), default=-1) + 1
        if not self.size:
            return
        n = sum(sizes.values())
        groups = sorted({(p.fold, p.ngram) for p in points})
        column = {g: i for i, g in enumerate(groups)}
        self.rank, idf = np.full((self.size, len(groups)), 1 << 30), np.zeros((self.size, len(groups)))
        for r in terms:
            if (g := column.get((r["fold"], r["ngram"]))) is not None:
                self.rank[r["place"], g] = r["rank"]
                idf[r["place"], g] = np.log((n - sizes[r["fold"]] + 1) / (r["df"] + 1))
        self.group = np.array([column[p.fold, p.ngram] for p in points])
        # deviations of the counts without each fold, from sums by fold
        folds = self.folds = sorted(sizes)
        sums = self._moments(folds)
        total, squares = sums[:, :len(folds)], sums[:, len(folds):]
        at = np.array([folds.index(f) for f, _ in groups])
        rows = np.array([n - sizes[f] for f, _ in groups], np.float64)
        mean = (total.sum(1)[:, None] - total[:, at]) / rows
        variance = ((squares.sum(1)[:, None] - squares[:, at]) - rows * mean**2) / np.maximum(rows - 1, 1)
        deviation = np.sqrt(np.maximum(variance, 0)) * idf
        # a weight of a scaled column stands for this many of the plain count; none beyond the vocabulary
        unit = np.where(deviation > 0, idf / np.where(deviation > 0, deviation, 1), 0)
        self.factor = unit[:, self.group] * (self.rank[:, self.group] < np.array([p.vocab for p in points]))
        self.rows, self.training = rows[self.group], self._columns(points)
        self.strength = np.array([1.0 / (p.c * n) for p in points])

    def _columns(self, points: list[Point], own: bool = False) -> Columns:
        """Columns of the points for the blocks of each fold: the points that it
        trains, or (``own``) those that it tests."""
        levels = sorted({p.vocab for p in points})
        best = np.minimum.accumulate(self.rank.min(1)[::-1])[::-1]  # places go by their best rank
        ends = [0, *np.searchsorted(best, levels)]
        of, cuts = {}, {}
        for f in self.folds:
            of[f] = np.array(sorted((i for i, p in enumerate(points) if (p.fold == f) == own), key=lambda i: -points[i].vocab), np.int64)
            wide = [sum(points[i].vocab >= v for i in of[f]) for v in levels]
            cuts[f] = [(lo, hi, w) for lo, hi, w in zip(ends, ends[1:], wide) if w and lo < hi]
        return Columns(of, cuts)

    def _moments(self, folds: list[int]) -> np.ndarray:
        size, classes = self.size, self.classes

        def partial(batches):
            total = np.zeros((size, 2 * len(folds)))
            for X, at, _, fold in _blocks(batches, size, classes):
                total[at, folds.index(fold)] += X.sum(0, dtype=np.float64)
                total[at, len(folds) + folds.index(fold)] += (X.astype(np.float64)**2).sum(0)
            return total

        return _summed(self.table, size, partial)

    def _broadcast(self, weights: np.ndarray, intercepts: np.ndarray):
        """Weights of plain counts, (terms × points × classes), and intercepts;
        both less those of the last class, whose scores are then 0."""
        plain = ((weights[:, :, :-1] - weights[:, :, -1:]) * self.factor[:, :, None]).astype(np.float32)
        return self.table.sparkSession.sparkContext.broadcast((plain, (intercepts[:, :-1] - intercepts[:, -1:]).astype(np.float32)))

    def largest_eigenvalues(self, steps: int = 6) -> np.ndarray:
        """Of each point's scaled columns, second moments over its training rows.
        Points that differ by their penalties alone share them."""
        kinds = {(p.fold, p.ngram, p.vocab): i for i, p in enumerate(self.points)}
        use = list(kinds.values())
        factor, columns = self.factor[:, use], self._columns([self.points[i] for i in use])
        v = np.random.default_rng(1).normal(size=(self.size, len(use)))
        size, classes = self.size, self.classes
        value = np.ones(len(use))
        for _ in range(steps):
            v /= np.maximum(np.linalg.norm(v, axis=0), 1e-30)
            sent = self.table.sparkSession.sparkContext.broadcast((v * factor).astype(np.float32)[:, :, None])

            def partial(batches, sent=sent):
                return columns.summed(_blocks(batches, size, classes), sent.value, lambda s, y, of: s)

            v = _summed(self.table, size + 1, partial)[:-1] * factor / self.rows[use]
            sent.destroy()
            value = np.linalg.norm(v, axis=0)
        at = {k: i for i, k in enumerate(kinds)}
        return value[[at[p.fold, p.ngram, p.vocab] for p in self.points]]

    def gradient(self, weights: np.ndarray, intercepts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sent = self._broadcast(weights, intercepts)
        size, classes, columns = self.size, self.classes, self.training

        def partial(batches):
            plain, free = sent.value
            return columns.summed(_blocks(batches, size, classes), plain, lambda s, y, of: _errors(s + free[of], y))

        found = _summed(self.table, size + 1, partial)
        sent.destroy()
        found = found.reshape(size + 1, len(self.points), -1) / self.rows[None, :, None]
        found = np.concatenate([found, -found.sum(2, keepdims=True)], 2)  # a document's errors add up to 0
        return found[:-1] * self.factor[:, :, None], found[-1]

    def fit(self, steps: int = 30) -> tuple[np.ndarray, np.ndarray]:
        k, n = len(self.classes), len(self.points)
        step = (1.0 / (0.5 * (1.1 * self.largest_eigenvalues() + 1.0) + self.strength))
        lasso = np.array([p.l1 for p in self.points])[None, :, None]
        strength, rate = self.strength[None, :, None], step[None, :, None]
        w, b = np.zeros((self.size, n, k)), np.zeros((n, k))
        ahead, ahead_b, t = w, b, np.ones(n)
        for _ in range(steps):
            g, gb = self.gradient(ahead, ahead_b)
            moved = ahead - rate * (g + np.where(lasso, 0, strength * ahead))
            new = np.where(lasso, np.sign(moved) * np.maximum(np.abs(moved) - rate * strength, 0), moved)
            new_b = ahead_b - step[:, None] * gb
            # momentum, begun anew where it points uphill
            uphill = ((ahead - new) * (new - w)).sum((0, 2)) + ((ahead_b - new_b) * (new_b - b)).sum(1) > 0
            t_new = np.where(uphill, 1.0, (1 + np.sqrt(1 + 4 * t * t)) / 2)
            pull = np.where(uphill, 0.0, (t - 1) / t_new)
            ahead, ahead_b = new + pull[None, :, None] * (new - w), new_b + pull[:, None] * (new_b - b)
            w, b, t = new, new_b, t_new
        return w, b

    def correct(self, weights: np.ndarray, intercepts: np.ndarray) -> np.ndarray:
        """Of each point the documents of its fold whose class it predicts (of equal scores the first)."""
        sent = self._broadcast(weights, intercepts)
        size, classes, columns, points = self.size, self.classes, self._columns(self.points, own=True), len(self.points)

        def partial(batches):
            total = np.zeros((1, points))
            plain, free = sent.value
            for X, at, y, fold in _blocks(batches, size, classes):
                of = columns.of[fold]
                s = columns.scores(X, at, fold, plain[:, of]) + free[of]
                best = np.concatenate([s, np.zeros((*s.shape[:2], 1), np.float32)], 2).argmax(2)
                total[0, of] += (best == y[:, None]).sum(0)
            return total

        found = _summed(self.table, 1, partial)[0]
        sent.destroy()
        return found


def _errors(scores: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Probabilities less 1 for a document's own class, of all classes but the last, whose scores are 0."""
    top = np.maximum(scores.max(2), 0)
    p = np.exp(scores - top[:, :, None])
    p /= (p.sum(2) + np.exp(-top))[:, :, None]
    rows = np.flatnonzero(y < scores.shape[2])
    p[rows, :, y[rows]] -= 1
    return p


RESULT = "vocab int, ngram int, c double, l1 double, fold int, correct bigint, n bigint"


def cross_validate_grid(docs: DataFrame, label: str = "label", text: str = "text", fold: str = "fold", vocabularies_of=(1000, 2000, 3000), ngrams=(1, 2),
                        cs=(0.1, 1.0, 10.0), l1=(1.0, 0.0), steps: int = 30) -> DataFrame:
    """(vocab, ngram, c, l1, fold, correct, n): of every point of the grid and
    every fold the fold's documents that the classifier of the other folds gets
    right. One fold alone, or one class, gives no rows."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = documents(docs, label, text, fold)
    sizes = {r["fold"]: r["count"] for r in rows.groupBy("fold").count().collect()}
    classes = sorted(r["label"] for r in rows.select("label").distinct().collect())
    if len(sizes) < 2 or len(classes) < 2:
        return spark.createDataFrame([], RESULT)
    found = []
    for n in ngrams:  # settings share few columns, so each has a matrix of its own
        points = [Point(f, n, v, c, bool(one)) for f in sorted(sizes) for v in vocabularies_of for c in cs for one in l1]
        terms = ranked_terms(rows, sorted(sizes), max(vocabularies_of), [n])
        table = counts_by_place(rows, terms)
        grid = Grid(table, document_frequencies(terms, table, sorted(sizes)), points, classes, sizes)
        if grid.size:
            found += [(p.vocab, p.ngram, p.c, float(p.l1), p.fold, int(r), sizes[p.fold]) for p, r in zip(points, grid.correct(*grid.fit(steps)))]
    return spark.createDataFrame(found, RESULT)
