"""Texts cut where two tokenizers both end a token.

A byte-level BPE tokenizer (A, of space + text) and a piece model (B, of text,
with its space in front) both end a token before a space or line end between
two other characters, and between a Latin letter and a sign that no piece of B
joins to a letter. Between such places the tokens of a segment depend on the
segment alone, so each distinct segment is encoded once while it stays in the
worker's cache; ``Aligner`` keeps its tokens' groups. What isn't sure by this
(a segment whose tokens don't spell it) is encoded as a whole text.
"""

from __future__ import annotations

import os
import re
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa

MARK = "▁"
#: Segments kept in a worker, and their bytes.
CACHE, CACHE_BYTES = 500_000, 16 << 20
_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_WORD = re.compile(rb" (?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")  # a space and Latin letters


def public_path(name: str) -> str:
    """A file by path, or by name among the installed public ones."""
    if os.path.exists(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable ones for themselves, the others from U+0100 on in their order."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Groups(NamedTuple):
    """Token groups of some texts: of each its tokens, groups, linked pairs
    (``pairs[pair_at[i]:pair_at[i + 1]]``), its groups as a string with ; after
    each, and whether its tokens spell it."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    pairs: np.ndarray
    pair_at: np.ndarray
    strings: pa.Array
    good: np.ndarray


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids, and how many of each list."""
    n = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(n.sum())), n


def binary(data: np.ndarray | bytes, offsets: np.ndarray) -> pa.Array:
    """Parts of some bytes as an array."""
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data)])


def content(array: pa.Array) -> np.ndarray:
    """All bytes of a binary array, one after another."""
    _, offsets, data = array.buffers()
    if data is None:
        return np.empty(0, np.uint8)
    at = np.frombuffer(offsets, np.int64)[array.offset:array.offset + len(array) + 1]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]]


class Aligner:
    """Both tokenizers, and what is known of segments."""

    _made: dict[tuple[str, str], Aligner] = {}

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        chars = byte_of_char()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            a_bytes[i] = bytes(map(chars.__getitem__, token)) if all(c in chars for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.spelled = {"a": pa.array(a_bytes, pa.large_binary()), "b": pa.array(b_bytes, pa.large_binary())}
        self.a_size, self.b_size = (np.array([len(x) for x in xs]) for xs in (a_bytes, b_bytes))
        # each id's text before a comma, a bar (A's last of a group) and a semicolon (B's last)
        self.n_ids = max(len(a_bytes), len(b_bytes))
        self.id_texts = pa.array([f"{i}{mark}".encode() for mark in ",|;" for i in range(self.n_ids)], pa.large_binary())
        self.bits = (len(pieces) - 1).bit_length()
        self._set_cuts(pieces)
        self.clear()

    def _set_cuts(self, pieces: list[str]) -> None:
        """Where both end a token, by the classes of bytes beside a place."""
        self.front = self.b.encode("\n")  # the space that B adds, and a line end
        joined = {p[i:i + 2] for p in pieces for i in range(len(p) - 1)}
        letter = re.compile(f"[{_LATIN}]")
        self.at_spaces = not any(MARK in p.lstrip(MARK) for p in pieces) and self.b.encode("a b") != [] and len(self.front) == 2
        lone = self.at_spaces and not any("\n" in p for p in pieces)
        signs = [c for c in _SIGNS if not any(x[1] == c and letter.match(x[0]) for x in joined)] if lone else []
        self.kind = np.zeros(256, np.uint8)
        self.kind[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = 1  # white space, by any table
        self.kind[[c for c in range(128) if chr(c).isalpha()]] = 2
        self.kind[[ord(c) for c in signs]] = 4
        self.lead = np.zeros(256, bool)
        self.lead[[32, 10] if lone else [32]] = True

    @classmethod
    def of(cls, a: str, b: str) -> Aligner:
        key = (public_path(a), public_path(b))
        if key not in cls._made:
            cls._made[key] = cls(*key)
        return cls._made[key]

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.known_bytes = 0
        none = np.empty(0, np.int64)
        self.table = Groups(none, none, none, none, np.zeros(1, np.int64), pa.array([], pa.large_binary()), np.empty(0, bool))

    def cut(self, texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The texts with a space before each, one after another; where
        segments begin; and how many each text has."""
        data = b"".join(x for text in texts for x in (b" ", text))
        begin = _offsets(np.array([len(t) + 1 for t in texts], np.int64))
        if not self.at_spaces:
            return data, begin, np.ones(len(texts), np.int64)
        u = np.frombuffer(b"\0\0\0" + data + b"\0", np.uint8)  # place i of data is i + 3 here
        kind = self.kind[u]
        inner = np.ones(len(data) + 1, bool)
        inner[begin] = False
        places = np.flatnonzero(self.lead[u[3:-1]] & inner[:-1] & inner[1:]) + 3  # neither at a text's begin nor at its end
        before, after = u[places - 1], u[places + 1]
        wide = before >= 0x80  # the character before it may be white space beyond ASCII
        two = wide & (u[places - 2] == 0xC2) & ((before == 0x85) | (before == 0xA0))
        three = wide & np.isin(u[places - 3].astype(np.int64) << 8 | u[places - 2], [0xE19A, 0xE280, 0xE281, 0xE380])
        fine = (kind[places - 1] != 1) & ~two & ~three & (kind[places + 1] != 1) & ~np.isin(after, [0xC2, 0xE1, 0xE2, 0xE3])
        signs = np.flatnonzero((kind[3:-1] == 4) & inner[:-1]) + 3
        before = u[signs - 1]
        latin = (kind[signs - 1] == 2) | ((u[signs - 2] == 0xC3) & (before >= 0x80) & (before != 0x97) & (before != 0xB7))
        inner[places[fine] - 3] = inner[signs[latin] - 3] = False
        at = np.flatnonzero(~inner)
        return data, at, np.diff(np.searchsorted(at, begin))

    def _encode(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids by A and by B, all segments' one after another, and how many each has; without the space that B adds where a segment has none in front."""
        texts = [s.decode("utf-8", "replace") for s in segments]
        a, n_a = _flat([e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)])
        b = self.b.encode([t[1:] if t[0] == " " else "\n" + t for t in texts], num_threads=1)
        return a, n_a, *_flat([ids if t[0] == " " else ids[2:] if ids[:2] == self.front else [0] for t, ids in zip(texts, b, strict=True)])

    def _encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same for words with a space in front, many at once: each one's tokens end where its bytes do."""
        found: list[list[np.ndarray]] = [[], [], [], []]
        for k in range(0, len(words), 500):
            part = words[k:k + 500]
            text, stops = b"".join(part).decode(), np.cumsum(list(map(len, part)))
            for at, size, ids in ((0, self.a_size, self.a.encode(text, add_special_tokens=False).ids), (2, self.b_size, self.b.encode(text[1:]))):
                ids = np.array(ids, np.int64)
                found[at].append(ids)
                found[at + 1].append(np.diff(np.searchsorted(np.cumsum(size[ids]), stops) + 1, prepend=0))
        return tuple(map(np.concatenate, found))

    def group(self, segments: list[bytes], words: bool = False) -> Groups:
        """Tokens and groups of segments, each cut where tokens of both end."""
        a_ids, n_a, b_ids, n_b = self._encode_words(segments) if words else self._encode(segments)
        all_bytes = np.frombuffer(b"".join(segments), np.uint8)
        good = np.ones(len(segments), bool)
        spelled = {k: self.spelled[k].take(pa.array(ids)) for k, ids in (("a", a_ids), ("b", b_ids))}
        if any(len(x := content(s)) != len(all_bytes) or (x != all_bytes).any() for s in spelled.values()):
            for k, (size, n) in {"a": (self.a_size[a_ids], n_a), "b": (self.b_size[b_ids], n_b)}.items():
                at, text = _offsets(size)[_offsets(n)], content(spelled[k]).tobytes()
                good &= [text[i:j] == s for i, j, s in zip(at, at[1:], segments, strict=False)]
            a_ids, b_ids = a_ids[np.repeat(good, n_a)], b_ids[np.repeat(good, n_b)]  # so that the others' bytes stay in step
            n_a, n_b = n_a * good, n_b * good
        a_end, b_end = np.cumsum(self.a_size[a_ids]), np.cumsum(self.b_size[b_ids])
        both = np.zeros(int(a_end[-1]) + 1 if len(a_end) else 1, np.int8)
        both[a_end] += 1
        both[b_end] += 1
        common = np.flatnonzero(both == 2)
        a_group, b_group = np.searchsorted(common, a_end), np.searchsorted(common, b_end)
        g_a, g_b = np.bincount(a_group, minlength=len(common)), np.bincount(b_group, minlength=len(common))
        owner = np.repeat(np.arange(len(segments)), n_a)
        n_groups = np.bincount(owner[np.cumsum(g_a) - g_a], minlength=len(segments)) if len(common) else np.zeros(len(segments), np.int64)
        # all pairs of a group: each A token beside the run of its group's B tokens
        times = g_b[a_group]
        right = b_ids[np.arange(times.sum()) - np.repeat(np.cumsum(times) - times - (np.cumsum(g_b) - g_b)[a_group], times)]
        n_links = np.bincount(np.repeat(owner, times), minlength=len(segments))
        # the groups' text: A's tokens, then B's, of one group after another
        a_mark, b_mark = np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
        a_mark[np.cumsum(g_a) - 1], b_mark[np.cumsum(g_b) - 1] = 1, 2
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        texts = self.id_texts.take(pa.array(np.concatenate([a_ids + self.n_ids * a_mark, b_ids + self.n_ids * b_mark])[order]))
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        strings = binary(content(texts), ends[_offsets(n_a + n_b)] - ends[0])
        return Groups(n_a, n_b, n_groups, np.repeat(a_ids, times) << self.bits | right, _offsets(n_links), strings, good)

    def learn(self, segments: list[bytes]) -> None:
        """Add segments to the table."""
        words = [s for s in segments if _WORD.fullmatch(s)] if self.at_spaces else []
        other = set(segments).difference(words) if len(words) < len(segments) else ()
        for kind in (words, list(other)):
            for i in range(0, len(kind), 50_000):
                part = kind[i:i + 50_000]
                old, new = self.table, self.group(part, kind is words)
                self.known.update(zip(part, range(len(old.good), len(old.good) + len(part)), strict=True))
                self.known_bytes += sum(map(len, part))
                self.table = Groups(*(np.concatenate(x) for x in zip(old[:4], new[:4], strict=True)), np.concatenate([old.pair_at, old.pair_at[-1] + new.pair_at[1:]]),
                                    pa.concat_arrays([old.strings, new.strings]), np.concatenate([old.good, new.good]))

    def segments(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers in the table of all texts' segments, and how many each text has."""
        if len(self.known) > CACHE or self.known_bytes > CACHE_BYTES:
            self.clear()
        data, at, counts = self.cut(texts)
        coded = binary(data, np.append(at, len(data)) if not len(at) or at[-1] != len(data) else at).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        self.learn([s for s in distinct if s not in self.known])
        number = np.array([self.known[s] for s in distinct], np.int64)
        return number[coded.indices.to_numpy(zero_copy_only=False)], counts
