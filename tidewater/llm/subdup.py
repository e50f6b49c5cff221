"""Removal of word sequences that an earlier document holds, too.

A window is ``width`` consecutive words of one document. Every word covered by
a window that also starts in a document with a smaller doc_id is removed.

Count-min prefilter. Documents are read in blocks of up to ``block_windows``
windows, and the blocks' sketches of window hashes are merged (``countmin``).
An estimate is never under the true count: a second pass over the blocks keeps
the windows estimated at two or more, and no other window can occur twice. The
width of the sketch follows the number of windows, and no task holds all of it.

Exact pass. Kept windows are grouped by 128-bit hashes of their words, first in
their block, where all but the smallest document of a window are known to lose
it; only that smallest one goes on to the group of the window among all blocks.
A window in a third of all documents sends one entry for each block.

A null text has no words. Rows with a null doc_id are neither removed from nor
held against others; rows that share a doc_id are not held against each other.
A block that finds no answer (its documents were dealt out differently in the
second pass) keeps all of its windows, which changes no result.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.countmin import SKETCH, estimates, merge, pack, pack_sorted, sketch, unpack, unpack_sorted
from tidewater.llm.shared import saved
from tidewater.llm.words import digests, in_parts, texts, window_hashes

ROWS = 2  # of the sketch
NO_DOC = np.iinfo(np.int64).min  # a null doc_id in arrays


class Block:
    """Windows of consecutive documents: hashes, and for each window the
    number of its document in the block and its place there."""

    def __init__(self, width: int, exact: bool):
        self.width, self.exact, self.n = width, exact, 0
        self.name = blake2b(digest_size=16)
        self.docs, self.keys, self.h1, self.h2, self.doc, self.pos = [], [], [], [], [], []

    def add(self, part: pa.RecordBatch) -> None:
        docs, keys = part.column("doc_id").to_pylist(), part.column("key").to_pylist()
        split = [x.split() for x in texts(part.column("text"))]
        lengths = np.array([len(w) for w in split], np.int64)
        values = digests([w for words in split for w in words])
        number = np.repeat(np.arange(len(split)), lengths)
        ends = np.cumsum(lengths)
        pos = np.arange(len(values)) - np.repeat(ends - lengths, lengths)
        starts = np.flatnonzero(pos + self.width <= np.repeat(lengths, lengths))
        self.h1.append(window_hashes(values[:, 0], self.width, 0)[starts])
        if self.exact:
            self.h2.append(window_hashes(values[:, 1], self.width, 1)[starts])
            self.doc.append(number[starts] + len(self.docs))
            self.pos.append(pos[starts])
        self.docs += [NO_DOC if d is None else d for d in docs]
        self.keys += keys
        self.name.update(np.array(keys, np.int64).tobytes() + lengths.tobytes())
        self.n += len(starts)

    def array(self, name: str, kind=np.int64) -> np.ndarray:
        parts = getattr(self, name)
        return np.concatenate(parts) if parts else np.empty(0, kind)


def blocks(batches, width: int, block_windows: int, exact: bool):
    block = Block(width, exact)
    for part in in_parts(batches):
        block.add(part)
        if block.n >= block_windows:
            yield block
            block = Block(width, exact)
    if block.docs:
        yield block


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a key of both that tells rows with one doc_id apart."""
    doc, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    return docs.select(doc.alias("doc_id"), F.xxhash64(doc, text).alias("key"), text.alias("text"))


def sketched(docs: DataFrame, width: int, bits: int, shard_bits: int, block_windows: int) -> str:
    """The merged sketch of all windows: the folder of its answers to the blocks."""
    def send(batches):
        for block in blocks(batches, width, block_windows, exact=False):
            yield sketch(block.name.hexdigest(), block.array("h1", np.uint64), ROWS, bits, shard_bits)

    return merge(docs.mapInArrow(send, SKETCH))


def estimated_repeated(block: Block, folder: str, bits: int) -> np.ndarray:
    """The numbers of a block's windows whose estimated count is over one."""
    h1 = block.array("h1", np.uint64)
    found = estimates(folder, block.name.hexdigest(), h1, ROWS, bits)
    return np.arange(len(h1)) if found is None else np.flatnonzero(found > 1)


COVER = "bucket long, data binary"
_COVER = pa.schema([("bucket", pa.int64()), ("data", pa.binary())])


def first_of_runs(*sorted_columns: np.ndarray) -> np.ndarray:
    """Of rows in order, the number of the run of equal rows that each belongs to."""
    if not len(sorted_columns[0]):
        return np.empty(0, np.int64)
    new = np.zeros(len(sorted_columns[0]), bool)
    for c in sorted_columns:
        new[1:] |= c[1:] != c[:-1]
    return np.cumsum(new)


def losers(h1: np.ndarray, h2: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the entries by window and document, and in that order
    whether the window also starts in a smaller document."""
    order = np.lexsort((doc, h2, h1))
    run = first_of_runs(h1[order], h2[order])
    if not len(run):
        return order, np.empty(0, bool)
    begins = np.flatnonzero(np.diff(run, prepend=-1))
    return order, doc[order] > doc[order][begins][run]


def cover_rows(key: np.ndarray, pos: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Window starts by document row, a row for each bucket of document rows."""
    bucket = np.mod(key, buckets)
    order = np.lexsort((pos, key, bucket))
    key, pos, bucket = key[order], pos[order].astype(np.int32), bucket[order]
    begins = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = np.append(begins, len(key))[1:]
    data = [pack(key[a:b], pos[a:b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(bucket[begins]), pa.array(data, pa.binary())], schema=_COVER)


class Covers:
    """Window starts of the document rows of a bucket."""

    def __init__(self, rows: list[bytes]):
        keys, pos = [], []
        for data in map(unpack, rows):
            n = len(data) // 12
            keys.append(np.frombuffer(data, np.int64, n))
            pos.append(np.frombuffer(data, np.int32, n, 8 * n))
        keys, pos = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (keys, pos))
        order = np.argsort(keys, kind="stable")
        self.pos = pos[order]
        self.keys, self.begin = np.unique(keys[order], return_index=True)
        self.end = np.append(self.begin[1:], len(keys))

    def of(self, key: int) -> np.ndarray | None:
        k = int(np.searchsorted(self.keys, key))
        if k == len(self.keys) or self.keys[k] != key:
            return None
        return np.unique(self.pos[self.begin[k]:self.end[k]])


def covers(docs: DataFrame, folder: str, width: int, bits: int, exact_bits: int, block_windows: int, buckets: int) -> DataFrame:
    """The starts of windows that lose their words, by bucket (several rows each)."""
    def second(batches):
        schema = pa.schema([("shard", pa.int64()), ("bucket", pa.int64()), ("n", pa.int64()), ("data", pa.binary())])
        for block in blocks(batches, width, block_windows, exact=True):
            kept = estimated_repeated(block, folder, bits)
            h1, h2 = (block.array(x, np.uint64)[kept] for x in ("h1", "h2"))
            number, pos = (block.array(x)[kept] for x in ("doc", "pos"))
            docs_, keys = np.array(block.docs, np.int64), np.array(block.keys, np.int64)
            named = docs_[number] != NO_DOC
            h1, h2, number, pos = h1[named], h2[named], number[named], pos[named]
            order, lost = losers(h1, h2, docs_[number])
            gone = order[lost]
            local = cover_rows(keys[number[gone]], pos[gone], buckets)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(local), pa.int64()), local.column(0), pa.nulls(len(local), pa.int64()), local.column(1)], schema=schema)
            stay = order[~lost]  # in order of h1
            shard = (h1[stay] >> np.uint64(64 - exact_bits)).astype(np.int64) if exact_bits else np.zeros(len(stay), np.int64)
            edges = np.searchsorted(shard, np.arange((1 << exact_bits) + 1))
            rows = []
            for s in np.flatnonzero(np.diff(edges)).tolist():
                part = stay[edges[s]:edges[s + 1]]
                data = pack_sorted(h1[part])
                rest = pack(h2[part], docs_[number[part]], keys[number[part]], pos[part].astype(np.int32))
                rows.append({"shard": s, "bucket": len(data), "n": len(part), "data": data + rest})
            yield pa.RecordBatch.from_pylist(rows, schema)

    def exact(batches):
        def settle(group):
            h1, h2, doc, key, pos = [], [], [], [], []
            for g in group:
                n = g["n"]
                h1.append(unpack_sorted(g["data"][:g["bucket"]]))  # its length stands in for the bucket
                rest = unpack(g["data"][g["bucket"]:])
                h2.append(np.frombuffer(rest, np.uint64, n))
                doc.append(np.frombuffer(rest, np.int64, n, 8 * n))
                key.append(np.frombuffer(rest, np.int64, n, 16 * n))
                pos.append(np.frombuffer(rest, np.int32, n, 24 * n))
            doc, key, pos = map(np.concatenate, (doc, key, pos))
            order, lost = losers(np.concatenate(h1), np.concatenate(h2), doc)
            gone = order[lost]
            return cover_rows(key[gone], pos[gone], buckets)

        group = []
        for batch in batches:
            for g in batch.to_pylist():
                if group and g["shard"] != group[0]["shard"]:
                    yield settle(group)
                    group = []
                group.append(g)
        if group:
            yield settle(group)

    found = saved(docs.mapInArrow(second, "shard long, bucket long, n long, data binary"), "windows")
    among = found.filter("shard IS NOT NULL").repartition("shard").sortWithinPartitions("shard").mapInArrow(exact, COVER)
    return found.filter("shard IS NULL").select("bucket", "data").unionByName(among)


def dedup(docs: DataFrame, width: int = 50, block_windows: int = 1 << 20, shard_windows: int = 1 << 21) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text of every row of ``docs``."""
    docs = keyed(docs)
    # the width of the sketch follows the text: about eight cells a window
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    windows = max(1 << 10, size // 6)
    bits = (8 * windows - 1).bit_length()
    shard_bits = max(4, (windows // shard_windows).bit_length())
    folder = sketched(docs, width, bits, shard_bits, block_windows)
    buckets = max(8, windows // shard_windows)
    lost = covers(docs, folder, width, bits, shard_bits, block_windows, buckets)

    def cut(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.binary())])
        current, held, found = None, [], None
        for part in in_parts(batches):
            rows = []
            columns = (part.column(c).to_pylist() for c in ("bucket", "data", "doc_id", "key"))
            for bucket, data, doc, key, text in zip(*columns, texts(part.column("text")), strict=True):
                if bucket != current:
                    current, held, found = bucket, [], None
                if data is not None:  # these rows of a bucket come first
                    held.append(data)
                    continue
                if found is None:
                    found, held = Covers(held), []
                words, begin = text.split(), found.of(key)
                kept = words
                if begin is not None:
                    edge = np.zeros(len(words) + 1, np.int64)
                    edge[begin] += 1
                    np.subtract.at(edge, begin + width, 1)
                    kept = [w for w, s in zip(words, (np.cumsum(edge[:-1]) == 0).tolist(), strict=True) if s]
                rows.append({"doc_id": doc, "n_words": len(words), "n_removed": len(words) - len(kept), "kept_text": b" ".join(kept)})
            yield pa.RecordBatch.from_pylist(rows, schema)

    # the starts and the documents of a bucket meet in one task, the starts first
    named = docs.select(F.pmod("key", F.lit(buckets)).alias("bucket"), F.lit(1).alias("kind"), "doc_id", "key", "text", F.lit(None).cast("binary").alias("data"))
    lost = lost.select("bucket", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("key"),
                       F.lit(None).cast("string").alias("text"), "data")
    joined = lost.unionByName(named).repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind")
    out = joined.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_text binary")
    return out.withColumn("kept_text", F.col("kept_text").cast("string"))
