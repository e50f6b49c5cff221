"""Alignment of two tokenizers by inverted pair bitmaps.

The tokens of a text by tokenizer A (byte-level BPE, of space + text) and B
(pieces, of text) are cut into groups at the byte places where both end a
token; every A token and every B token of a group are linked. For each pair of
ids a chunk of documents has one posting: a compressed bitmap of the documents
that hold the pair (two bytes a document, or a bit for each document of the
chunk, whichever is shorter), and bit planes of the links in each of them
(less one, by the document's rank in the bitmap). Bitmaps of the runs of a
chunk are OR-merged, their planes added, so a document that goes through in
parts counts once. Population counts of all chunks give a pair's documents,
those of the planes its links; counts return to the chunks that hold the pair,
whose postings return them to the documents.

A chunk holds at most 65,536 documents and, but for its last run, 2^22
documents of pairs. Rows with a null or empty text, or one whose tokens don't
spell space + text, have no tokens. Rows that share a doc_id, or have none, are
documents of their own. The ids of no text depend on another one.
"""

from __future__ import annotations

import hashlib
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.segments import Aligner, binary, content
from tidewater.llm.shared import saved
from tidewater.llm.words import in_parts, texts
from tidewater.session import spread

CHUNK_DOCS, CHUNK_POSTINGS = 1 << 16, 1 << 22
RUN_LINKS = 1 << 21

ROWS = pa.schema([("chunk", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int32()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                  ("groups_sha256", pa.string()), ("pair", pa.int64()), ("n_docs", pa.int64()), ("pair_links", pa.int64()), ("docs", pa.binary()), ("planes", pa.binary())])
ROWS_DDL = ("chunk long, doc_id long, place int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pair long, n_docs long, pair_links long, "
            "docs binary, planes binary")


def merge(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """OR of the runs' (pair << 16 | document) keys, each sorted, and the sums of their links."""
    keys, links = np.concatenate([k for k, _ in runs]), np.concatenate([n for _, n in runs])
    if len(runs) == 1 or not len(keys):
        return keys, links
    order = np.argsort(keys, kind="stable")
    keys, links = keys[order], links[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(links, first)


def postings(keys: np.ndarray, links: np.ndarray, n_docs: int):
    """Bitmaps and planes of sorted keys, by pair: pairs, their documents,
    their links, the bitmaps, the planes."""
    pair, doc = keys >> 16, (keys & 0xFFFF).astype(np.uint16)
    first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(keys) else np.empty(0, np.int64)
    size = np.diff(np.append(first, len(keys)))
    width = -(-n_docs // 8)
    bitmap = 2 * size > width
    # bytes of each pair's bitmap: numbers of documents, or a bit for each document
    length = np.where(bitmap, width, 2 * size)
    at = np.concatenate([[0], np.cumsum(length)])
    data = np.zeros(at[-1], np.uint8)
    owner = np.repeat(np.arange(len(first)), size)
    rank = np.arange(len(keys)) - first[owner] if len(keys) else np.empty(0, np.int64)
    listed = ~bitmap[owner]
    place = at[owner[listed]] + 2 * rank[listed]
    data[place], data[place + 1] = doc[listed] & 0xFF, doc[listed] >> 8
    for k in np.flatnonzero(bitmap):
        bits = np.zeros(8 * width, np.uint8)
        bits[doc[first[k]:first[k] + size[k]]] = 1
        data[at[k]:at[k] + width] = np.packbits(bits, bitorder="little")
    # planes of the links less one, each of a bit for each document that holds the pair
    more = links - 1
    most = np.maximum.reduceat(more, first) if len(first) else more
    n_planes = np.where(most > 0, np.floor(np.log2(np.maximum(most, 1))).astype(np.int64) + 1, 0)
    bytes_of_plane = -(-size // 8)
    plane_at = np.concatenate([[0], np.cumsum(n_planes * bytes_of_plane)])
    bits = np.zeros(8 * int(plane_at[-1]), np.uint8)
    for p in range(int(n_planes.max(initial=0))):
        has = np.flatnonzero((more >> p) & 1)
        bits[8 * (plane_at[owner[has]] + p * bytes_of_plane[owner[has]]) + rank[has]] = 1
    total = np.add.reduceat(links, first) if len(first) else links
    return pair[first], size, total, binary(data, at), binary(np.packbits(bits, bitorder="little"), plane_at)


def expand(size: np.ndarray, docs: pa.Array, planes: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The inverse of ``postings`` for some rows: each entry's row, document and links."""
    doc_at, plane_at = (np.concatenate([[0], np.cumsum(_lengths(x))]) for x in (docs, planes))
    data, plane_data = content(docs.cast(pa.large_binary())), content(planes.cast(pa.large_binary()))
    length = np.diff(doc_at)
    owner = np.repeat(np.arange(len(size)), size)
    start = np.cumsum(size) - size
    rank = np.arange(len(owner)) - start[owner]
    listed = length == 2 * size
    place = doc_at[owner] + 2 * rank
    doc = np.zeros(len(owner), np.int64)
    mine = listed[owner]
    doc[mine] = data[place[mine]].astype(np.int64) | data[place[mine] + 1].astype(np.int64) << 8
    for k in np.flatnonzero(~listed):
        doc[start[k]:start[k] + size[k]] = np.flatnonzero(np.unpackbits(data[doc_at[k]:doc_at[k + 1]], bitorder="little"))
    bytes_of_plane = -(-size // 8)
    n_planes = np.diff(plane_at) // np.maximum(bytes_of_plane, 1)
    bits, links = np.unpackbits(plane_data, bitorder="little"), np.ones(len(owner), np.int64)
    for p in range(int(n_planes.max(initial=0))):
        mine = np.flatnonzero(n_planes[owner] > p)
        links[mine] += bits[8 * (plane_at[owner[mine]] + p * bytes_of_plane[owner[mine]]) + rank[mine]].astype(np.int64) << p
    return owner, doc, links


def _lengths(array: pa.Array) -> np.ndarray:
    return pc.binary_length(array).to_numpy(zero_copy_only=False)


class Chunk:
    """Documents of a task, until their postings are written."""

    def __init__(self, number: int):
        self.number, self.n_docs, self.runs, self.held = number, 0, [], 0

    def add(self, keys: np.ndarray) -> None:
        """A run's keys, one for each link."""
        keys.sort()
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
        self.runs.append((keys[first], np.diff(np.append(first, len(keys)))))
        self.held += len(first)

    def rows(self):
        if not self.held:
            return
        pair, size, total, docs, planes = postings(*merge(self.runs), self.n_docs)
        for i in range(0, len(pair), 10_000):
            part = slice(i, i + 10_000)
            n = len(pair[part])
            columns = {"chunk": pa.array(np.full(n, self.number)), "pair": pa.array(pair[part]), "n_docs": pa.array(size[part]), "pair_links": pa.array(total[part]),
                       "docs": docs[part].cast(pa.binary()), "planes": planes[part].cast(pa.binary())}
            yield pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in ROWS], schema=ROWS)


def _link_keys(table, segments: np.ndarray, place: np.ndarray):
    """(pair << 16 | place) of all links of some segments, a bounded number at a time."""
    n = np.diff(table.pair_at)[segments]
    ends = np.cumsum(n)
    begin = 0
    while begin < len(segments):
        stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + RUN_LINKS)))
        times = n[begin:stop]
        at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times - table.pair_at[segments[begin:stop]], times)
        yield table.pairs[at] << 16 | np.repeat(place[begin:stop], times)
        begin = stop


def align(docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model") -> DataFrame:
    """Rows of documents (``place`` in their ``chunk``, counts, the digest of
    their groups) and rows of postings (``pair`` = A's id shifted left by the
    bits of B's ids, or B's id; documents, links, bitmap, planes), written as
    one table so that both are of the same attempt."""
    def rows(batches):
        aligner = Aligner.of(a, b)
        numbers = count(TaskContext.get().partitionId() << 32)
        chunk = Chunk(next(numbers))
        for part in in_parts(batches):
            begin = 0
            while begin < part.num_rows:
                if chunk.n_docs == CHUNK_DOCS or chunk.held >= CHUNK_POSTINGS:
                    yield from chunk.rows()
                    chunk = Chunk(next(numbers))
                some = part.slice(begin, CHUNK_DOCS - chunk.n_docs)
                begin += some.num_rows
                yield _documents(aligner, chunk, some)
        yield from chunk.rows()

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return saved(spread(wanted).mapInArrow(rows, ROWS_DDL), "token-pairs")


def _documents(aligner: Aligner, chunk: Chunk, part: pa.RecordBatch) -> pa.RecordBatch:
    """Documents' rows; their links go to the chunk."""
    data = texts(part.column("text"))
    segments, counts = aligner.segments(data)
    table, n = aligner.table, len(data)
    owner = np.repeat(np.arange(n), counts)
    good = np.array([len(t) > 0 for t in data])
    whole = {}
    if not table.good[segments].all():  # as one segment: only so it is sure
        for i in np.unique(owner[~table.good[segments]]).tolist():
            good[i] = False
            found = aligner.group([b" " + data[i]])
            if found.good[0]:
                whole[i] = found
    kept = good[owner]
    sums = {name: np.bincount(owner[kept], getattr(table, name)[segments[kept]], n).astype(np.int64) for name in ("n_a", "n_b", "n_groups")}
    sums["n_links"] = np.bincount(owner[kept], np.diff(table.pair_at)[segments[kept]], n).astype(np.int64)
    strings = table.strings.take(pa.array(segments))
    text = memoryview(content(strings))
    ends = np.concatenate([[0], np.cumsum(_lengths(strings))])[np.concatenate([[0], np.cumsum(counts)])].tolist()
    digests = [hashlib.sha256(text[i:j - 1]).hexdigest() if ok else "" for i, j, ok in zip(ends, ends[1:], good.tolist(), strict=False)]
    for keys in _link_keys(table, segments[kept], owner[kept] + chunk.n_docs):
        chunk.add(keys)
    for i, found in whole.items():
        for name in ("n_a", "n_b", "n_groups"):
            sums[name][i] = getattr(found, name)[0]
        sums["n_links"][i], digests[i] = len(found.pairs), hashlib.sha256(found.strings[0].as_py()[:-1]).hexdigest()
        for keys in _link_keys(found, np.zeros(1, np.int64), np.array([i + chunk.n_docs])):
            chunk.add(keys)
    columns = {"chunk": pa.array(np.full(n, chunk.number)), "doc_id": part.column("doc_id"), "place": pa.array(np.arange(chunk.n_docs, chunk.n_docs + n), pa.int32()),
               "groups_sha256": pa.array(digests, pa.string())} | {name: pa.array(x) for name, x in sums.items()}
    chunk.n_docs += n
    return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in ROWS], schema=ROWS)


def pairs(aligned: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model") -> DataFrame:
    """Pairs of ids: ``pair``, ``a``, ``b``, documents, links, and ``best``,
    whether no pair of its A id has more documents. A's ids bound the rows of
    the side that is broadcast."""
    bits = Aligner.of(a, b).bits
    found = aligned.filter("pair IS NOT NULL").groupBy("pair").agg(F.sum("n_docs").alias("n_docs"), F.sum("pair_links").alias("n_links"))
    found = saved(found.withColumn("a", F.shiftright("pair", bits)).withColumn("b", F.col("pair").bitwiseAND((1 << bits) - 1)), "pair-counts")
    most = found.groupBy("a").agg(F.max("n_docs").alias("_most"))
    return found.join(F.broadcast(most), "a").withColumn("best", F.col("n_docs") == F.col("_most")).drop("_most")


RETURNED = pa.schema([("chunk", pa.int64()), ("place", pa.int32()), ("n_best", pa.int64()), ("count_sum", pa.int64())])


def _return_scores(held: pa.Table, counts: pa.Table) -> pa.Table:
    """A chunk's postings and the counts of its pairs: sums for its documents."""
    held, counts = held.combine_chunks().sort_by("pair"), counts.combine_chunks().sort_by("of_pair")
    size = held.column("n_docs").to_numpy()
    owner, doc, links = expand(size, *(held.column(c).combine_chunks() for c in ("docs", "planes")))
    n_docs, best = counts.column("count").to_numpy(), counts.column("best").to_numpy().astype(np.int64)
    width = int(doc.max(initial=-1)) + 1
    sums, bests = np.zeros(width, np.int64), np.zeros(width, np.int64)
    np.add.at(sums, doc, links * n_docs[owner])
    np.add.at(bests, doc, links * best[owner])
    chunk = held.column("chunk")[0].as_py() if len(held) else 0
    return pa.table([pa.array(np.full(width, chunk)), pa.array(np.arange(width), pa.int32()), pa.array(bests), pa.array(sums)], schema=RETURNED)


def scores(aligned: DataFrame, found: DataFrame) -> DataFrame:
    """Documents with the scores of their links: ``n_best`` (links of a best
    pair) and ``count_sum`` (documents of the pairs, over links)."""
    held = aligned.filter("pair IS NOT NULL").select("chunk", "pair", "n_docs", "docs", "planes")
    wanted = aligned.filter("pair IS NOT NULL").select(F.col("chunk").alias("in_chunk"), "pair").join(found.select("pair", F.col("n_docs").alias("count"), "best"), "pair")
    wanted = wanted.select("in_chunk", F.col("pair").alias("of_pair"), "count", "best")
    back = held.groupBy("chunk").cogroup(wanted.groupBy("in_chunk")).applyInArrow(_return_scores, "chunk long, place int, n_best long, count_sum long")
    documents = aligned.filter("place IS NOT NULL").select("chunk", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    zero = F.lit(0).cast("long")
    return documents.join(back, ["chunk", "place"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
