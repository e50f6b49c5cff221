"""Words as the operators of this package count them: maximal runs of bytes
other than space, tab, line feed, vertical tab, form feed and carriage return.
``bytes.split()`` separates at exactly these, so UTF-8 text needs no regex."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words kept in a worker's cache before it starts anew (bounds its memory).
CACHE_WORDS = 150_000


def texts(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8 bytes; null gives the empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def in_parts(batches, max_bytes: int = 4 << 20, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into runs of at most ``max_bytes`` of text (one row
    at least), so the words of a run always fit in memory."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        begin, total = 0, 0
        for i, n in enumerate(sizes):
            if i > begin and total + n > max_bytes:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += n
        yield batch.slice(begin)


def split_lower(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``split`` with ASCII letters in lower case."""
    return split(pc.ascii_lower(column))


def split(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts of a string column as one array, and the number
    of words of each text; null has none."""
    lists = pc.ascii_split_whitespace(pc.fill_null(column, ""))
    words, sizes = lists.flatten(), pc.list_value_length(lists).to_numpy()
    full = pc.greater(pc.binary_length(words), 0)
    if pc.all(full).as_py() is False:  # white space at an end leaves an empty word
        owner = np.repeat(np.arange(len(sizes)), sizes)[full.to_numpy(zero_copy_only=False)]
        words, sizes = words.filter(full), np.bincount(owner, minlength=len(sizes))
    return words, sizes.astype(np.int64)


class WordDigests(dict):
    """Word to its 16-byte BLAKE2b digest, computed once for each word."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = blake2b(word, digest_size=16).digest()
        return value


_digests = WordDigests()


def digests(words: list[bytes]) -> np.ndarray:
    """(n, 2) unsigned 64-bit values of the words' digests."""
    return np.frombuffer(b"".join(map(_digests.__getitem__, words)), np.uint64).reshape(-1, 2)


#: Odd multipliers of the polynomial window hashes, one for each half, and their inverses.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
INVERSES = tuple(pow(b, -1, 1 << 64) for b in BASES)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.empty(size, np.uint64)
        have[0] = 1
        done = 1
        while done < size:
            step = min(done, size - done)
            have[done:done + step] = have[:step] * np.uint64(pow(base, done, 1 << 64))
            done += step
        _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that any bits of a hash can be used."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(values: np.ndarray, width: int, half: int) -> np.ndarray:
    """Hashes of all windows of ``width`` consecutive values (one half of the
    digests): prefix sums of value * base**i, so the cost does not depend on
    the width."""
    n = len(values)
    if n < width:
        return np.empty(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(BASES[half], n), out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * powers(INVERSES[half], n - width + 1))
