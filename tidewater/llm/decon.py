"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman.

Words are the texts' words in lower case without punctuation at their ends.
All n-grams of a benchmark item are seeds, however many documents hold them, so
every stretch of an item keeps its own. Where those of an item lie on near
diagonals of a document, the item is aligned to the document's words by local
alignment (a match 2, a mismatch or a gap -1). The score is the alignment's
share of a whole copy's. A passage of a long item counts by its own length, too:
an alignment whose score equals that of ``passage`` matched words is a hit
whatever its share. A copy with so many words replaced that no n-gram is
left whole is found by its pairs of words, of which it must hold as many as any
copy with words replaced and a score of ``threshold`` holds. Items go through in
blocks of at most ``block_words`` words, one scan of the documents each, so what
a task holds of the benchmark is bounded whatever its size.

Items with equal words are one, under the smallest item_id. Items with fewer
words than a seed, null or empty ones and a null item_id match nothing; a null
text holds nothing. Rows of documents are scanned one by one, so repeated rows
give repeated hits.
"""

from __future__ import annotations

import re
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.shared import trim
from tidewater.llm.words import CACHE_WORDS, in_parts, split

ENDS = re.compile(r"^[\W_]+|[\W_]+$")
HITS = "doc_id long, item_id long, score double, doc_start long, doc_end long, n_seeds long"
_HITS = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("doc_start", pa.int64()), ("doc_end", pa.int64()), ("n_seeds", pa.int64())])
PAIRS = 1 << 20  # pairs of a place in a text and one in an item looked at together, besides a text's own
OTHER, NONE = 0, -1  # a word that no item holds; no word at all


def plain(word: str) -> str:
    """``word`` in lower case without punctuation at its ends."""
    word = word.lower()
    if word.isalnum():
        return word
    word = word.strip(punctuation)
    return word if word and word[0].isalnum() and word[-1].isalnum() else ENDS.sub("", word)


class Numbers(dict):
    """Word as it stands in a text to its number in the items' vocabulary."""

    def __init__(self, vocabulary: dict[str, int]):
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        form = plain(word)
        value = self[word] = self.vocabulary.get(form, OTHER) if form else NONE
        return value

    def of(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The numbered words of all texts of a column, and of each the number
        of its text. Only the different words of the column are looked up."""
        words, sizes = split(column)
        coded = words.dictionary_encode()
        different = coded.dictionary.to_numpy(zero_copy_only=False)
        found = np.fromiter(map(self.__getitem__, different), np.int64, len(different))[coded.indices.to_numpy()]
        owner = np.repeat(np.arange(len(sizes)), sizes)
        return found[found != NONE], owner[found != NONE]


class Seeds:
    """The ``n``-grams of a block of items, and the places of each."""

    def __init__(self, words: list[np.ndarray], n: int, vocabulary: int):
        self.n, self.base = n, np.int64(vocabulary + 1)
        codes = [self.codes(w, np.zeros(len(w))) for w in words]
        item = np.repeat(np.arange(len(codes)), [len(c) for c in codes]).astype(np.int64)
        place = np.concatenate([np.arange(len(c)) for c in codes]) if codes else np.empty(0, np.int64)
        every = np.concatenate(codes) if codes else np.empty(0, np.int64)
        self.grams, gram = np.unique(every, return_inverse=True)
        order = np.argsort(gram, kind="stable")
        self.item, self.place = item[order], place[order]
        self.begin = np.searchsorted(gram[order], np.arange(len(self.grams) + 1))

    def codes(self, words: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """A code for each n-gram; one with a word that no item holds, or over
        the end of a text, gets 0."""
        if len(words) < self.n:
            return np.empty(0, np.int64)
        out = np.zeros(len(words) - self.n + 1, np.int64)
        good = owner[:len(out)] == owner[self.n - 1:]
        for k in range(self.n):
            part = words[k:len(words) - self.n + 1 + k]
            out = out * self.base + part
            good &= part > 0
        return np.where(good, out, 0)

    def found(self, words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places, and numbers, of the items' n-grams in numbered words."""
        codes = self.codes(words, owner)
        places = np.flatnonzero(codes)
        if not len(places) or not len(self.grams):
            return places[:0], places[:0]
        at = np.minimum(np.searchsorted(self.grams, codes[places]), len(self.grams) - 1)
        hit = self.grams[at] == codes[places]
        return places[hit], at[hit]


class Items:
    """A block of benchmark items as numbered words, and their seeds."""

    def __init__(self, rows: list[tuple[int, str]], n: int):
        self.vocabulary, self.ids, self.words = {}, [], []
        seen: set[tuple[int, ...]] = set()
        for item, text in rows:  # ascending item_id
            forms = [f for f in (plain(w.decode()) for w in text.encode().split()) if f]
            words = tuple(self.vocabulary.setdefault(f, len(self.vocabulary) + 1) for f in forms)
            if len(words) >= n and words not in seen:
                seen.add(words)
                self.ids.append(item)
                self.words.append(np.array(words, np.int64))
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.seeds = Seeds(self.words, n, len(self.vocabulary))
        self.pairs = Seeds(self.words, 2, len(self.vocabulary)) if n > 2 else None

    def needed(self, threshold: float, passage: int) -> np.ndarray:
        """Of each item the matched words that an alignment's score must equal."""
        return np.minimum(threshold * self.sizes, passage)

    def pairs_needed(self, threshold: float, passage: int) -> np.ndarray:
        """Of each item the pairs that are left in a copy with words replaced
        that scores ``threshold``: m words of the item's s that match and e
        replaced have 2m - e >= 2s * threshold and m + e <= s, and at least
        m - e - 1 pairs are whole. Of a long item s is the size of a part
        whose share ``threshold`` is ``passage`` words."""
        size = np.minimum(self.sizes, passage / threshold) if threshold > 0 else self.sizes
        return np.maximum(2, np.ceil(size * (4 * threshold - 1) / 3 - 1e-9).astype(np.int64) - 1)


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> list[tuple[int, int, int]]:
    """Best local alignment of each item with its passage: score, begin and end
    in the passage. All pairs go through one table row at a time."""
    if not items:
        return []
    m, w = max(map(len, items)), max(map(len, passages))
    a = np.full((len(items), m), -2, np.int64)
    b = np.full((len(items), w), -3, np.int64)
    for k, (x, y) in enumerate(zip(items, passages, strict=True)):
        a[k, :len(x)], b[k, :len(y)] = x, y
    column = np.arange(w + 1, dtype=np.int32)
    score = np.zeros((len(items), w + 1), np.int32)
    # where in the passage the alignment that ends in a cell began
    begun = np.broadcast_to(column, score.shape).copy()
    best = np.zeros(len(items), np.int32)
    best_begin, best_end = np.zeros(len(items), np.int64), np.zeros(len(items), np.int64)
    rows = np.arange(len(items))
    for i in range(m):
        diagonal = np.zeros_like(score)
        diagonal[:, 1:] = score[:, :-1] + np.where(a[:, i:i + 1] == b, 2, -1)
        up = score - 1
        take = diagonal >= up
        reach = np.where(take, diagonal, up)
        begin = np.where(take, np.concatenate([begun[:, :1], begun[:, :-1]], 1), begun)
        begin = np.where(reach <= 0, column, begin)
        reach = np.maximum(reach, 0)
        # gaps along the row: the best of what lies to the left, one less for each step
        lifted = np.maximum.accumulate(reach + column, 1)
        source = np.maximum.accumulate(np.where(reach + column == lifted, column, 0), 1)
        score, begun = lifted - column, np.take_along_axis(begin, source, 1)
        end = np.argmax(score, 1)
        top = score[rows, end]
        better = (top > best) & (i < np.array([len(x) for x in items]))
        best = np.where(better, top, best)
        best_begin = np.where(better, begun[rows, end], best_begin)
        best_end = np.where(better, end, best_end)
    return list(zip(best.tolist(), best_begin.tolist(), best_end.tolist(), strict=True))


def passages_of(items: Items, seeds: Seeds, words: np.ndarray, owner: np.ndarray, need: np.ndarray):
    """(text, item, begin, end, seeds) of the stretches of texts, as numbered
    words, at which at least ``need`` (of the item) seeds on near diagonals point."""
    places, grams = seeds.found(words, owner)
    texts = owner[places]
    counts = seeds.begin[grams + 1] - seeds.begin[grams]
    start = np.cumsum(counts) - counts
    # whole texts, of about PAIRS pairs of a place and an item's place at a time
    edges = np.flatnonzero(np.diff(texts, prepend=-1))
    edges = np.append(edges[np.flatnonzero(np.diff(start[edges] // PAIRS, prepend=-1))], len(places))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        n = counts[a:b]
        entry = np.repeat(seeds.begin[grams[a:b]] - start[a:b] + start[a], n) + np.arange(n.sum())
        begun, ended = np.searchsorted(owner, texts[a:b]), np.searchsorted(owner, texts[a:b], "right")
        item, row, size = seeds.item[entry], np.repeat(texts[a:b], n), np.repeat(ended - begun, n)
        diagonal = np.repeat(places[a:b] - begun, n) - seeds.place[entry]
        order = np.lexsort((diagonal, item, row))
        item, row, size, diagonal = item[order], row[order], size[order], diagonal[order]
        new = np.ones(len(item), bool)
        new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (np.diff(diagonal) > items.sizes[item[1:]] // 2)
        first = np.flatnonzero(new)
        held = np.diff(first, append=len(item))
        enough = held >= need[item[first]]
        first, held = first[enough], held[enough]
        whole = items.sizes[item[first]]
        slack = whole // 4 + 4
        begin = np.maximum(0, diagonal[first] - slack)
        end = np.minimum(size[first], diagonal[first + held - 1] + whole + slack)
        yield from zip(*(c.tolist() for c in (row[first], item[first], begin, end, held)), strict=True)


def _blocks(benchmark: DataFrame, n: int, block_words: int):
    """Blocks of items in ascending item_id, read one partition at a time."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("item_id IS NOT NULL AND text IS NOT NULL")
    held, size = [], 0
    for r in rows.orderBy("item_id").toLocalIterator():
        held.append((r["item_id"], r["text"]))
        size += r["text"].count(" ") + 1
        if size >= block_words:
            yield Items(held, n)
            held, size = [], 0
    if held:
        yield Items(held, n)


def seeded(docs: DataFrame, benchmark: DataFrame, n: int, block_words: int):
    """Blocks of items with their seeds, as broadcast variables: at most
    ``block_words`` words and their n-grams each."""
    for items in _blocks(benchmark, n, block_words):
        if items.ids:
            yield docs.sparkSession.sparkContext.broadcast(items)


def found_in(items: Items, numbers: Numbers, column: pa.Array, threshold: float, passage: int) -> list[tuple[int, int, float, int, int, int]]:
    """Of each text of a column (by its number) and item the best alignment
    with at least ``threshold``, or a score of ``passage`` matched words:
    number, item, score, begin, end, seeds."""
    words, owner = numbers.of(column)
    found = list(passages_of(items, items.seeds, words, owner, np.ones_like(items.sizes)))
    if items.pairs:
        covered: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for row, item, begin, end, _ in found:
            covered.setdefault((row, item), []).append((begin, end))
        found += [x for x in passages_of(items, items.pairs, words, owner, items.pairs_needed(threshold, passage))
                  if not any(a <= x[2] and x[3] <= b for a, b in covered.get(x[:2], ()))]
    needed = items.needed(threshold, passage).tolist()
    begins = np.searchsorted(owner, [row for row, *_ in found]).tolist()
    places, pairs = [], []
    for at, (row, item, begin, end, n) in zip(begins, found, strict=True):
        stretch = words[at + begin:at + end]
        # no alignment matches more of the item's words than stand in the stretch
        if np.isin(items.words[item], stretch).sum() >= needed[item]:
            places.append((row, item, begin, n))
            pairs.append((items.words[item], stretch))
    order = sorted(range(len(pairs)), key=lambda k: len(pairs[k][1]))  # near lengths go together
    aligned: list = [None] * len(pairs)
    for at in range(0, len(order), 256):
        some = order[at:at + 256]
        for k, result in zip(some, align([pairs[k][0] for k in some], [pairs[k][1] for k in some]), strict=True):
            aligned[k] = result
    best: dict[tuple[int, int], tuple] = {}
    for (row, item, begin, seeds), (score, a, b) in zip(places, aligned, strict=True):
        share = score / (2.0 * len(items.words[item]))
        if (share >= threshold or score >= 2 * passage) and ((row, item) not in best or share > best[row, item][2]):
            best[row, item] = (row, item, share, begin + a, begin + b, seeds)
    return list(best.values())


def hits(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.4, n: int = 3, block_words: int = 200_000, passage: int = 40) -> DataFrame:
    """One row for each document row and item aligned with at least
    ``threshold``, or a score equal to ``passage`` matched words: score, the passage (numbers of words, end exclusive; words
    without a letter or digit don't count) and the seeds on its diagonals."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = docs.sparkSession.createDataFrame([], HITS)
    for block in seeded(docs, benchmark, n, block_words):
        def search(batches, block=block):
            items = block.value
            numbers = Numbers(items.vocabulary)
            for part in in_parts(batches):
                ids = part.column("doc_id").to_pylist()
                rows = [{"doc_id": ids[row], "item_id": items.ids[item], "score": score, "doc_start": begin, "doc_end": end, "n_seeds": seeds}
                        for row, item, score, begin, end, seeds in found_in(items, numbers, part.column("text"), threshold, passage)]
                yield pa.RecordBatch.from_pylist(rows, _HITS)

        out = out.unionByName(docs.mapInArrow(search, HITS))
    return out


def without(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.4, n: int = 3, block_words: int = 200_000, passage: int = 40) -> DataFrame:
    """The rows of ``docs``, all columns, that ``hits`` has nothing on. The
    scan that aligns drops the rows, so texts go through no exchange."""
    out = docs
    for block in seeded(docs, benchmark, n, block_words):
        def keep(batches, block=block):
            items = block.value
            numbers = Numbers(items.vocabulary)
            for part in in_parts(batches):
                hit = {row for row, *_ in found_in(items, numbers, part.column("text"), threshold, passage)}
                yield part.filter(pa.array([row not in hit for row in range(part.num_rows)]))
            trim()

        out = out.mapInArrow(keep, docs.schema)
    return out
