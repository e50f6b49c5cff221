"""Count-min sketch of hashes spread over blocks of rows, without a broadcast.

A block sends, for each row of the sketch, its cells (sorted, gaps compressed)
with their counts, cut into shards. The shards of all blocks meet and are
added up, and every block is answered with the total of each cell that it
sent, cut off at 255, in a file of its own; blocks of one name are equal and
share it. Totals are never under the true
count of a hash. The width of the sketch can follow the data: no task holds
more than its block, or one shard."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tidewater.llm.shared import NewFile, filesystem, new_folder
from tidewater.llm.words import mix

MOST = 255
SKETCH = "row long, shard long, block string, cells binary, times binary"
_SKETCH = pa.schema([("row", pa.int64()), ("shard", pa.int64()), ("block", pa.string()), ("cells", pa.binary()), ("times", pa.binary())])
_ANSWER = pa.schema([("block", pa.string()), ("row", pa.int64()), ("shard", pa.int64()), ("n", pa.int64()), ("totals", pa.binary())])


def pack(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(a.tobytes() for a in arrays))


def unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompressobj().decompress(data)


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending 64-bit values by their gaps, in the narrowest type that holds them."""
    gaps = np.diff(values, prepend=np.uint64(0))
    size = next(s for s in (1, 2, 4, 8) if s == 8 or int(gaps.max(initial=0)) < 1 << 8 * s)
    return bytes([size]) + pack(gaps.astype(f"<u{size}"))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(unpack(data[1:]), f"<u{data[0]}"), dtype=np.uint64)


def cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    """Cell of each hash in a row of the sketch."""
    h = hashes if row == 0 else mix(hashes ^ np.uint64(0x5851F42D4C957F2D * row % (1 << 64)))
    return h >> np.uint64(64 - bits)


def sketch(block: str, hashes: np.ndarray, rows: int, bits: int, shard_bits: int) -> pa.RecordBatch:
    """What a block sends."""
    out = []
    for row in range(rows):
        hit, times = np.unique(cells(hashes, row, bits), return_counts=True)
        times = np.minimum(times, MOST).astype(np.uint8)
        edges = np.searchsorted(hit >> np.uint64(bits - shard_bits), np.arange((1 << shard_bits) + 1, dtype=np.uint64))
        for s in np.flatnonzero(np.diff(edges)).tolist():
            a, b = edges[s], edges[s + 1]
            out.append({"row": row, "shard": s, "block": block, "cells": pack_sorted(hit[a:b]), "times": pack(times[a:b])})
    return pa.RecordBatch.from_pylist(out, _SKETCH)


def _groups(batches, *by: str):
    """Runs of rows with equal values of ``by``, of rows in that order."""
    group: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if group and any(row[c] != group[0][c] for c in by):
                yield group
                group = []
            group.append(row)
    if group:
        yield group


def _add_up(batches):
    for group in _groups(batches, "row", "shard"):
        hit = [unpack_sorted(g["cells"]) for g in group]
        sizes = [len(h) for h in hit]
        every = np.concatenate(hit)
        times = np.frombuffer(b"".join(unpack(g["times"]) for g in group), np.uint8)
        order = np.argsort(every, kind="stable")
        begins = np.flatnonzero(np.diff(every[order], prepend=every[order[:1]] + np.uint64(1)))
        sums = np.minimum(np.add.reduceat(times[order].astype(np.int64), begins), MOST).astype(np.uint8)
        totals = np.empty(len(every), np.uint8)
        totals[order] = np.repeat(sums, np.diff(np.append(begins, len(every))))
        edges = np.cumsum([0, *sizes]).tolist()
        yield pa.RecordBatch.from_pylist([{"block": g["block"], "row": g["row"], "shard": g["shard"], "n": n, "totals": pack(totals[a:a + n])}
                                          for g, n, a in zip(group, sizes, edges, strict=False)], _ANSWER)


def merge(sketches: DataFrame) -> str:
    """Add up all blocks' sketches; returns the folder of the answers."""
    folder = new_folder(sketches.sparkSession, "sketch-answers")

    def store(batches):
        for group in _groups(batches, "block"):
            with NewFile(f"{folder}/{group[0]['block']}") as out:
                for before, g in zip([{}, *group], group, strict=False):
                    if (before.get("row"), before.get("shard")) == (g["row"], g["shard"]):
                        continue  # another block of the same rows, with the same totals
                    out.write(np.array([g["row"], g["n"], len(g["totals"])], "<u4").tobytes() + g["totals"])
            yield pa.RecordBatch.from_pydict({"stored": pa.array([group[0]["block"]])})

    answers = sketches.repartition("row", "shard").sortWithinPartitions("row", "shard", "block").mapInArrow(_add_up, "block string, row long, shard long, n long, totals binary")
    answers.repartition("block").sortWithinPartitions("block", "row", "shard").mapInArrow(store, "stored string").write.format("noop").mode("overwrite").save()
    return folder


def estimates(folder: str, block: str, hashes: np.ndarray, rows: int, bits: int) -> np.ndarray | None:
    """Counts of a block's hashes over all blocks, never too small; None if
    the folder has no answer to such a block."""
    if not len(hashes):
        return np.empty(0, np.uint8)
    fs, path = filesystem(f"{folder}/{block}")
    try:
        with fs.open_input_file(path) as file:
            data = file.read()
    except FileNotFoundError:
        return None
    totals, at = [[] for _ in range(rows)], 0
    while at < len(data):
        row, n, size = np.frombuffer(data, "<u4", 3, at).tolist()
        totals[row].append(np.frombuffer(unpack(data[at + 12:at + 12 + size]), np.uint8, n))
        at += 12 + size
    least = np.full(len(hashes), MOST, np.uint8)
    for row in range(rows):
        which = np.unique(cells(hashes, row, bits), return_inverse=True)[1]
        least = np.minimum(least, np.concatenate(totals[row])[which])
    return least
