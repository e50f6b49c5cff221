"""Token ids in shuffled planes.

``write_ids`` tokenises documents and writes their ids, in ascending order of
``doc_id``, as shard files; ``read_ids`` reads the files back. A shard file is

    magic | block 0 | block 1 | ... | documents | index | tail

A block holds up to ``block_ids`` ids (only the last one of a shard holds
fewer), transposed into planes: 32 bit planes or 4 byte planes of the
little-endian unsigned 32-bit ids, each compressed with zstandard alone. A
plane without a set bit is stored as nothing. ``documents`` is the compressed
table of doc_id and number of ids. The index gives, for each block, its offset,
its ids and the length of each plane, so any block can be read alone. The tail
gives the place of the documents and of the index.

Rows with a null text have no ids but the end id. Rows that share a doc_id are
documents of their own, in the order of their texts; a null doc_id comes first.
Documents go to shards by ranges of doc_id; a task holds one block of ids and
12 bytes for each document of its shard.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.shared import NewFile, new_folder, open_file, saved
from tidewater.llm.words import in_parts, texts

MAGIC = b"IDPLANE1"
TAIL = struct.Struct("<QQQB3xI8s")  # documents at, index at, number of ids, planes, blocks, magic
NULL_ID = -(1 << 63)  # a null doc_id in the documents table
CACHE_PIECES = 1_000_000


def split_planes(ids: np.ndarray, planes: int) -> list[bytes]:
    """The planes of a block, lowest first; an empty one has no set bit."""
    out = []
    seen = int(np.bitwise_or.reduce(ids)) if len(ids) else 0
    width = 32 // planes
    for p in range(planes):
        if not (seen >> (p * width)) & ((1 << width) - 1):
            out.append(b"")
        elif planes == 32:
            out.append(np.packbits((ids >> np.uint32(p)).astype(np.uint8) & 1, bitorder="little").tobytes())
        else:
            out.append((ids >> np.uint32(8 * p)).astype(np.uint8).tobytes())
    return out


def join_planes(parts: list[bytes], n: int) -> np.ndarray:
    """The ids of a block from its planes."""
    ids = np.zeros(n, np.uint32)
    for p, part in enumerate(parts):
        if part and len(parts) == 32:
            ids |= np.unpackbits(np.frombuffer(part, np.uint8), count=n, bitorder="little").astype(np.uint32) << np.uint32(p)
        elif part:
            ids |= np.frombuffer(part, np.uint8).astype(np.uint32) << np.uint32(8 * p)
    return ids


class ShardWriter:
    """Streams documents into one shard file."""

    def __init__(self, uri: str, planes: int, block_ids: int, level: int):
        self.file, self.planes, self.block_ids = NewFile(uri), planes, block_ids
        self.pack = zstandard.ZstdCompressor(level=level).compress
        self.held: list[bytes] = []
        self.held_ids = self.n_ids = 0
        self.index: list[bytes] = []
        self.docs, self.counts = [], []
        self.file.write(MAGIC)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append(NULL_ID if doc_id is None else doc_id)
        self.counts.append(len(ids) // 4)
        self.held.append(ids)
        self.held_ids += len(ids) // 4
        self.n_ids += len(ids) // 4
        if self.held_ids >= self.block_ids:
            self._flush(all_of_it=False)

    def _flush(self, all_of_it: bool) -> None:
        data = b"".join(self.held)
        at, step = 0, 4 * self.block_ids
        while len(data) - at >= step or (all_of_it and at < len(data)):
            block = np.frombuffer(data[at:at + step], "<u4")
            parts = [self.pack(p) if p else b"" for p in split_planes(block, self.planes)]
            self.index.append(struct.pack(f"<QI{self.planes}I", self.file.size, len(block), *map(len, parts)))
            self.file.write(b"".join(parts))
            at += step
        self.held, self.held_ids = [data[at:]], (len(data) - min(at, len(data))) // 4

    def close(self) -> None:
        self._flush(all_of_it=True)
        docs_at = self.file.size
        self.file.write(self.pack(np.array(self.docs, "<i8").tobytes() + np.array(self.counts, "<u4").tobytes()))
        index_at = self.file.size
        self.file.write(self.pack(b"".join(self.index)))
        self.file.write(TAIL.pack(docs_at, index_at, self.n_ids, self.planes, len(self.index), MAGIC))
        self.file.__exit__(None, None, None)


class ShardReader:
    """Reads a shard file: ``documents``, single blocks, or all documents in order."""

    def __init__(self, uri: str):
        self.file = open_file(uri)
        size = self.file.size()
        self.docs_at, self.index_at, self.n_ids, self.planes, blocks, magic = TAIL.unpack(self._read(size - TAIL.size, TAIL.size))
        if magic != MAGIC or self._read(0, len(MAGIC)) != MAGIC:
            raise ValueError(f"{uri} is not a shard of ids")
        row = struct.Struct(f"<QI{self.planes}I")
        index = zstandard.ZstdDecompressor().decompress(self._read(self.index_at, size - TAIL.size - self.index_at), max_output_size=max(1, blocks * row.size))
        self.index = [row.unpack_from(index, k * row.size) for k in range(blocks)]

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def documents(self) -> tuple[np.ndarray, np.ndarray]:
        raw = zstandard.ZstdDecompressor().decompressobj().decompress(self._read(self.docs_at, self.index_at - self.docs_at))
        n = len(raw) // 12
        return np.frombuffer(raw, "<i8", n), np.frombuffer(raw, "<u4", n, 8 * n)

    def block(self, k: int) -> np.ndarray:
        at, n, *lengths = self.index[k]
        data, parts, unpack = self._read(at, sum(lengths)), [], zstandard.ZstdDecompressor()
        begin = 0
        for length in lengths:
            part = data[begin:begin + length]
            parts.append(unpack.decompress(part, max_output_size=n) if length else b"")
            begin += length
        return join_planes(parts, n)

    def __iter__(self):
        """(doc_id, ids) of every document, one block in memory at a time."""
        held, k = np.empty(0, "<u4"), 0
        for doc, n in zip(*map(np.ndarray.tolist, self.documents()), strict=True):
            parts, have = [held], len(held)
            while have < n:
                parts.append(self.block(k))
                have += len(parts[-1])
                k += 1
            ids = np.concatenate(parts) if len(parts) > 1 else held
            held = ids[n:]
            yield (None if doc == NULL_ID else doc), ids[:n]


def tokenizer_path(name: str) -> str:
    """A tokenizer file by path, or by name among the installed public ones."""
    if os.path.exists(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


#: A letter of ASCII or Latin-1 (in UTF-8) before ASCII punctuation. The
#: tokenizer's pattern always ends a token there.
_LETTER = rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])"
_BEFORE_MARK = re.compile(rb"(" + _LETTER + rb")(?=[!-/:-@\[-`{-~])")
_LETTERS = re.compile(rb"[a-z\xc3\x80-\xbf]+")
_SIGNS = re.compile(rb"\xc3[\x97\xb7]")


#: Fixed value: the split pattern of tokenizers that the cuts below are right for.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def cuts_hold(spec: dict) -> bool:
    """Whether a tokenizer's file says that it lowers the case, drops white
    space, splits by ``_SPLIT`` and marks the ends of words, so that pieces can
    be encoded alone."""
    normaliser, before, model = (spec.get(k) or {} for k in ("normalizer", "pre_tokenizer", "model"))
    kinds = [n.get("type") for n in normaliser.get("normalizers", [])]
    spaces = [n.get("content") for n in normaliser.get("normalizers", []) if n.get("type") == "Replace" and n.get("pattern") == {"Regex": r"\s+"}]
    splits = before.get("pretokenizers", [])
    return (kinds == ["NFC", "Replace", "Lowercase"] and spaces == [" "] and [x.get("type") for x in splits] == ["Split", "ByteLevel"]
            and splits[0].get("pattern") == {"Regex": _SPLIT} and splits[0].get("invert") is True and splits[0].get("behavior") == "Removed"
            and splits[1].get("add_prefix_space") is False and splits[1].get("use_regex") is False and model.get("type") == "BPE"
            and model.get("end_of_word_suffix") == "</w>" and not spec.get("post_processor") and not spec.get("truncation")
            and all(t["content"].startswith("<|") for t in spec.get("added_tokens", [])))


class PieceIds:
    """Encodes with the tokenizers library, once for each distinct piece where
    the tokenizer allows it (``cuts_hold``), whole texts else.

    A text is cut where the tokenizer always ends a token: at ASCII white
    space, which it drops, and between a letter and ASCII punctuation. It
    lowers the case itself, so pieces are kept in lower case (ASCII). Texts
    with ``<|``, the begin of special tokens, are cut at white space only."""

    _made: dict[str, PieceIds] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encoder, self.known = Tokenizer.from_file(path), {}
        with open(path, encoding="utf-8") as file:
            self.by_piece = cuts_hold(json.load(file))
        vocabulary = self.encoder.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    @classmethod
    def of(cls, path: str) -> PieceIds:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    @staticmethod
    def cut(text: bytes) -> list[bytes]:
        return text.split() if b"<|" in text else _BEFORE_MARK.sub(rb"\1 ", text.lower()).split()

    def learn(self, new: list[bytes]) -> None:
        known = self.known
        plain = [w for w in new if _LETTERS.fullmatch(w) and not _SIGNS.search(w)]
        # words of letters only are one token run each, so many go in one call and are told apart by the end marks
        for i in range(0, len(plain), 2_000):
            part = plain[i:i + 2_000]
            ids = np.array(self.encoder.encode(b" ".join(part).decode(), add_special_tokens=False).ids, "<u4")
            stops = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            if len(stops) == len(part):
                data, begin = ids.tobytes(), 0
                for word, stop in zip(part, stops, strict=True):
                    known[word] = data[begin:stop]
                    begin = stop
        rest = [w for w in new if w not in known]
        for i in range(0, len(rest), 20_000):
            part = rest[i:i + 20_000]
            found = self.encoder.encode_batch_fast([x.decode("utf-8", "replace") for x in part], add_special_tokens=False)
            for word, e in zip(part, found, strict=True):
                known[word] = struct.pack(f"<{len(e.ids)}I", *e.ids)

    def encode(self, docs: list[bytes], end: bytes) -> list[bytes]:
        if not self.by_piece:
            found = self.encoder.encode_batch_fast([d.decode("utf-8", "replace") for d in docs], add_special_tokens=False)
            return [np.array(e.ids, "<u4").tobytes() + end for e in found]
        split = [self.cut(d) for d in docs]
        if len(self.known) > CACHE_PIECES:
            self.known.clear()
        self.learn(list(set().union(*split).difference(self.known)))
        return [b"".join(map(self.known.__getitem__, words)) + end for words in split]


MANIFEST = "file string, shard long, n_docs long, n_ids long, n_bytes long, first_doc long"


def write_ids(docs: DataFrame, folder: str, tokenizer: str = "word_bpe_49k.json", end_id: int = 2,
              planes: int = 32, block_ids: int = 1 << 16, level: int = 3, name: str = "ids") -> DataFrame:
    """Tokenise ``text`` and write the shards to ``folder``. Returns the
    manifest: one row for each file, with ``start``, the number of ids in all
    shards before it. No documents give no file."""
    end = struct.pack("<I", end_id)

    def write(batches):
        path, writer, first = None, None, None
        for part in in_parts(batches):
            pieces = PieceIds.of(tokenizer_path(tokenizer))
            ids = part.column("doc_id").to_pylist()
            if writer is None:
                shard = TaskContext.get().partitionId()
                path, first = f"{folder}/{name}-{shard:06d}.planes", ids[0]
                writer = ShardWriter(path, planes, block_ids, level)
            for doc, data in zip(ids, pieces.encode(texts(part.column("text")), end), strict=True):
                writer.add(doc, data)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pylist([{"file": path, "shard": shard, "n_docs": len(writer.docs), "n_ids": writer.n_ids,
                                               "n_bytes": writer.file.size, "first_doc": first}])

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    manifest = saved(ordered.mapInArrow(write, MANIFEST), "ids-manifest")
    # one row a shard: few enough for one task, unlike the documents
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_ids(manifest: DataFrame) -> DataFrame:
    """Documents of the shards: doc_id, start, n_tokens and ids (binary,
    little-endian unsigned 32-bit), a task for each few shards."""
    def read(batches):
        for batch in batches:
            for shard in batch.to_pylist():
                start, rows, held = shard["start"], [], 0
                for doc, ids in ShardReader(shard["file"]):
                    rows.append({"doc_id": doc, "start": start, "n_tokens": len(ids), "ids": ids.astype("<u4").tobytes()})
                    start += len(ids)
                    held += len(ids)
                    if held > 1 << 21 or len(rows) >= 10_000:
                        yield pa.RecordBatch.from_pylist(rows, READ_SCHEMA)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, READ_SCHEMA)

    return _by_shard(manifest).mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


READ_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def _by_shard(manifest: DataFrame) -> DataFrame:
    spark = manifest.sparkSession
    return manifest.select("file", "start").repartition(max(2, spark.sparkContext.defaultParallelism * 4))


def id_digests(manifest: DataFrame) -> DataFrame:
    """Documents of the shards by digest: doc_id, start, n_tokens, ids_crc32
    (of the ids as little-endian unsigned 32-bit integers)."""
    def read(batches):
        for batch in batches:
            for shard in batch.to_pylist():
                start, rows = shard["start"], []
                for doc, ids in ShardReader(shard["file"]):
                    rows.append((doc, start, len(ids), zlib.crc32(np.ascontiguousarray(ids, "<u4"))))
                    start += len(ids)
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _by_shard(manifest).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_digest(docs: DataFrame, **parameters) -> DataFrame:
    """Write the ids of ``docs`` to a new shared folder and digest what the files hold."""
    folder = new_folder(docs.sparkSession, "ids")
    return id_digests(write_ids(docs, folder, **parameters))
