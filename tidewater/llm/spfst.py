"""SentencePiece pieces as a weighted finite-state transducer.

``compile_model`` builds, from a model file, the normaliser (white space to
the mark U+2581, a mark in front), the pieces as a trie whose paths carry the
piece's number and the weight -score, and byte fallback: a character that is no
piece of its own has an arc that writes its UTF-8 bytes' pieces, at a weight
above every piece's. ``encode`` composes a text with these and takes the
shortest path in the tropical semiring (weights add along a path, the least sum
wins; of equal sums the path with the longer last piece, and so on backwards).

Where no piece holds two neighbouring characters, every path goes through the
state between them, so the composition is cut there: before a mark that follows
another character, between a letter and a sign that no piece joins, and around
line ends and tabs that no piece holds. Equal parts have equal
paths, so a worker solves each part once while it stays in its cache.
``decode`` is the inverse transducer.

A null or empty text has no pieces. Models whose normaliser maps characters
(a precompiled map) are refused: their map isn't compiled here.
"""

from __future__ import annotations

import os
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.shared import trim

MARK = "▁"
CACHE = 550_000
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6  # fixed values: the kinds of pieces in a model file


def model_path(name: str) -> str:
    """A model file by path, or by name among the installed public ones."""
    if os.path.exists(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Transducer(dict):
    """The compiled model; as a dict, the ids (packed) of parts solved so far."""

    def __init__(self, pieces: list[tuple[str, float, int]], dummy_prefix: bool = True, squeeze: bool = False):
        self.dummy_prefix, self.squeeze = dummy_prefix, squeeze
        self.ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, USER)}
        self.unknown = next((i for i, p in enumerate(pieces) if p[2] == UNKNOWN), None)
        self.bytes = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        self.weights = np.array([-score if kind in (NORMAL, USER) else 0.0 for _, score, kind in pieces])
        self.fallback = float(self.weights.max(initial=0.0)) + 10.0
        for b, i in self.bytes.items():  # the weight lies on the first byte of a character
            self.weights[i] = 0.0 if 0x80 <= b < 0xC0 else self.fallback
        if self.unknown is not None:
            self.weights[self.unknown] = self.fallback
        self.plain = [b"" if kind in (CONTROL, UNKNOWN) else bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(MARK, " ").encode()
                      for p, _, kind in pieces]
        # the trie: of each state the weight of the piece that ends there, or None
        self.arcs: dict[str, float | None] = {p[:n]: None for p in self.ids for n in range(1, len(p) + 1)}
        self.arcs |= {p: float(self.weights[i]) for p, i in self.ids.items()}
        self.parts = re.compile(self._cuts())

    def _cuts(self) -> str:
        """A pattern of the parts of a text between states that every path goes through."""
        before: dict[str, set[str]] = {}  # what stands before a character inside pieces
        for p in self.ids:
            before.setdefault(p[0], set())
            for a, b in zip(p, p[1:], strict=False):
                before.setdefault(b, set()).add(a)
        lone = "".join(c for c in "\n\t\r" if c not in before)
        if before.get(MARK, set()) - {MARK}:  # a piece goes on over a mark
            return (f"[{lone}]|[^{lone}]+") if lone else "(?s:.)+"
        # ASCII signs that follow a Latin letter in no piece: between the two there is such a state
        latin = {chr(c) for c in range(0x41, 0x100) if chr(c).isalpha() and chr(c) not in "ªº"}
        signs = "".join(re.escape(c) for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" if not before.get(c, set()) & latin)
        letter, other, glue = "A-Za-zÀ-ÖØ-öø-ÿµ", f"[^A-Za-zÀ-ÖØ-öø-ÿµ{MARK}{lone}]", f"[^A-Za-zÀ-ÖØ-öø-ÿµ{MARK}{lone}{signs}]"
        run = f"[{letter}]+(?:{glue}{other}*)?"  # letters, and what no sign parts from them
        return f"[{lone}]|" * bool(lone) + f"{MARK}*(?:{other}+(?:{run})*|(?:{run})+)|{MARK}+"

    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        return MARK * (self.dummy_prefix and text != "") + text.replace(" ", MARK)

    def shortest(self, part: str) -> tuple[float, list[int]]:
        """Weight and ids of the shortest path of a normalised text."""
        n, arcs, fallback = len(part), self.arcs, self.fallback
        best = [0.0] + [float("inf")] * n
        back = [0] * (n + 1)
        for i in range(n):
            here = best[i]
            for j in range(i + 1, n + 1):
                arc = part[i:j]
                if arc not in arcs:
                    break
                weight = arcs[arc]
                if weight is not None and here + weight < best[j]:
                    best[j], back[j] = here + weight, i
            if here + fallback < best[i + 1] and part[i] not in self.ids:
                best[i + 1], back[i + 1] = here + fallback, i
        out: list[int] = []
        at = n
        while at:
            arc = part[back[at]:at]
            piece = self.ids.get(arc)
            if piece is not None:
                out.append(piece)
            elif self.bytes:
                out += [self.bytes[b] for b in reversed(arc.encode("utf-8", "replace"))]
            else:
                out.append(self.unknown)
            at = back[at]
        return best[n], out[::-1]

    def __missing__(self, part: str) -> bytes:
        ids = self.shortest(part)[1]
        value = self[part] = struct.pack(f"<{len(ids)}I", *ids)
        return value

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text."""
        if len(self) > CACHE:
            self.clear()
        return np.frombuffer(b"".join(map(self.__getitem__, self.parts.findall(self.normalise(text)))), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.plain.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text

    def weight(self, ids: np.ndarray) -> float:
        return float(self.weights[ids].sum())


def compile_model(path: str) -> Transducer:
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    spec = model.normalizer_spec
    if spec.precompiled_charsmap:
        raise ValueError(f"{path}: a normaliser with a map of characters is not supported")
    return Transducer([(p.piece, p.score, p.type) for p in model.pieces], spec.add_dummy_prefix, spec.remove_extra_whitespaces)


_compiled: dict[str, Transducer] = {}


def transducer(name: str) -> Transducer:
    """The compiled model of this worker."""
    path = model_path(name)
    if path not in _compiled:
        _compiled[path] = compile_model(path)
    return _compiled[path]


ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("n_pieces", pa.int64()), ("n_byte_pieces", pa.int64()),
                     ("weight", pa.float64()), ("round_trip", pa.bool_())])


def encode(docs: DataFrame, model: str = "piece_bpe_32k.model") -> DataFrame:
    """doc_id, ids, n_pieces, n_byte_pieces, weight of the path, and whether
    the decoded ids are the text again (marks in it read as spaces)."""
    def run(batches):
        fst = transducer(model)
        is_byte = np.zeros(len(fst.weights), bool)
        is_byte[list(fst.bytes.values())] = True
        for batch in batches:
            for at in range(0, batch.num_rows, 300):
                part = batch.slice(at, 300)
                found, bytes_, weight, same = [], [], [], []
                for text in part.column("text").to_pylist():
                    text = text or ""
                    ids = fst.encode(text)
                    found.append(ids)
                    bytes_.append(int(is_byte[ids].sum()))
                    weight.append(fst.weight(ids))
                    same.append(fst.decode(ids) == text.replace(MARK, " "))
                sizes = np.array([len(x) for x in found], np.int64)
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(np.concatenate(found).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids, pa.array(sizes), pa.array(bytes_, pa.int64()), pa.array(weight, pa.float64()),
                                                  pa.array(same, pa.bool_())], schema=ENCODED)
        trim()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, n_pieces long, n_byte_pieces long, weight double, round_trip boolean")


def decode(encoded: DataFrame, model: str = "piece_bpe_32k.model") -> DataFrame:
    """``encoded`` (with ``ids``) with the text that the ids stand for; null ids give null."""
    def run(batches):
        fst = transducer(model)
        for batch in batches:
            texts = [None if ids is None else fst.decode(np.array(ids, np.int64)) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
