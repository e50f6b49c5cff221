"""Document quality from lines labelled by a linear-chain conditional random
field.

Every line with a word is good (1) or bad (0). A line's features are its own,
those of the line before and those of the line after (shapes of characters and
words, no vocabulary); the chain has a weight for each pair of neighbouring
labels. ``train`` knows labels of documents only: at first every line has its
document's label and is judged alone; then, three times, the lines of a bad
document that look good become good (its worst one stays bad) and the chain is
fitted to the lines, by full gradients of the log likelihood (forward-backward)
and Adam. ``score`` gives each line its marginal by forward-backward, averages
these over a document by the lines' code points, and maps the mean to a
probability by the logistic curve that was fitted on the training documents.

A model is fitted on at most ``max_docs`` labelled documents, those whose ids
have the smallest hashes, of at most ``max_lines`` lines each. All documents are
scored, by all their lines. A document without a word (null, empty) has the
share of good training documents as its score, 0.5 if there are none. A document
labelled more than once is good if the mean of its labels is at least 0.5; rows
without label or doc_id teach nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.segments import binary
from tidewater.llm.words import in_parts, texts
from tidewater.session import spread

MAX_DOCS, MAX_LINES = 4_000, 120
SPACE, LETTER, UPPER, DIGIT, SYMBOL, BAR, SHOUT, STOP = (1 << k for k in range(8))


def _kinds() -> np.ndarray:
    """Classes of bytes; a byte of a wider character counts as a letter."""
    kind = np.zeros(256, np.uint8)
    for chars, bit in ((b" \t\n\x0b\x0c\r", SPACE), (b"0123456789", DIGIT), (b"#*$%&<>~^_=+{}[]\\/@", SYMBOL), (b"|", BAR), (b"!", SHOUT), (b".,;:?", STOP)):
        kind[list(chars)] |= bit
    letters = [c for c in range(128) if chr(c).isalpha()] + list(range(128, 256))
    kind[letters] |= LETTER
    kind[[c for c in range(128) if chr(c).isupper()]] |= UPPER
    return kind


_KIND = _kinds()
_END = np.zeros(256, bool)
_END[list(b".!?:;\"')]")] = True
N_FEATURES = 24


def line_features(data: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines with a word, their code points, and the text that each is of."""
    none = np.empty(0, np.int64)
    if not data:
        return np.empty((0, N_FEATURES), np.float32), none, none
    u = np.frombuffer(b"".join(x for t in data for x in (t, b"\n")), np.uint8)
    ends = np.flatnonzero(u == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    owner = np.searchsorted(np.cumsum([len(t) + 1 for t in data]), starts, side="right")
    kind = _KIND[u]
    space = (kind & SPACE) > 0

    def count(flags: np.ndarray) -> np.ndarray:
        return np.add.reduceat(flags, starts, dtype=np.int64).astype(np.float64)

    first = ~space
    first[1:] &= space[:-1]
    n_words = count(first)
    keep = n_words > 0
    in_words = count(~space)
    points = count((u & 0xC0) != 0x80) - 1
    wide_upper = np.zeros(len(u), bool)  # capitals of Latin-1: 0xC3 and a byte up to 0x9E
    wide_upper[1:] = (u[:-1] == 0xC3) & (u[1:] >= 0x80) & (u[1:] <= 0x9E)
    letters = np.maximum(count((kind & LETTER) > 0), 1)
    upper, digits, symbols, bars, shouts, stops = (count((kind & bit) > 0) for bit in (UPPER, DIGIT, SYMBOL, BAR, SHOUT, STOP))
    upper += count(wide_upper)
    odd_word = np.zeros(len(u), bool)  # words that end with a sign other than a stop
    odd_word[:-1] = ~space[:-1] & space[1:] & ((kind[:-1] & (SYMBOL | BAR | SHOUT)) > 0)
    # words equal to the one before in their line
    begin = np.flatnonzero(first)
    code = binary(u, np.append(begin, len(u))).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    line = np.searchsorted(starts, begin, side="right") - 1
    stutter = np.bincount(line[1:], (code[1:] == code[:-1]) & (line[1:] == line[:-1]), len(starts))
    # lines equal to an earlier one of their text
    code = binary(u, np.append(starts, len(u))).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    _, where = np.unique(owner.astype(np.int64) * len(starts) + code, return_index=True)
    again = np.ones(len(starts), bool)
    again[where] = False
    words, chars = np.maximum(n_words, 1), np.maximum(in_words, 1)
    last = _END[u[np.maximum(ends - 1, 0)]] & (ends > starts)
    shares = [upper / letters, symbols / chars, bars / words, shouts / words, digits / chars, stops / words, count(odd_word) / words, stutter / words]
    columns = [np.ones(len(starts)), np.log1p(words), chars / words / 10, np.minimum(chars / words / 10, 0.4), again, last, (kind[starts] & UPPER) > 0,
               *(np.minimum(s, 1) for s in shares), *(np.sqrt(np.minimum(s, 1)) for s in shares), np.log1p(points) / 5]
    return np.stack(columns, 1)[keep].astype(np.float32), points[keep].astype(np.int64), owner[keep]


@dataclass
class Model:
    """Weights of a line's own, the previous and the next line's features
    (after ``mean`` and ``scale``), of neighbouring labels, and the curve from
    mean marginals to probabilities."""

    mean: np.ndarray
    scale: np.ndarray
    own: np.ndarray
    previous: np.ndarray
    following: np.ndarray
    pairs: np.ndarray  # 2 x 2: weight of label i before label j
    slope: float
    shift: float
    empty: float

    def emissions(self, features: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Log odds of the lines by their features."""
        x = (features - self.mean) / self.scale
        same = owner[1:] == owner[:-1]
        found = x @ self.own
        found[1:] += (x[:-1] @ self.previous) * same
        found[:-1] += (x[1:] @ self.following) * same
        return found.astype(np.float64)

    def document(self, mean: float) -> float:
        mean = min(max(mean, 1e-4), 1 - 1e-4)
        return 1 / (1 + math.exp(-(self.slope * math.log(mean / (1 - mean)) + self.shift)))


def _log_ratio(x: float, one: tuple[float, float], zero: tuple[float, float]) -> float:
    """log((e^(x + one[1]) + e^one[0]) / (e^(x + zero[1]) + e^zero[0]))."""
    a, b, c, d = one[0], x + one[1], zero[0], x + zero[1]
    up, down = max(a, b), max(c, d)
    return up - down + math.log1p(math.exp(-abs(a - b))) - math.log1p(math.exp(-abs(c - d)))


def marginals(emissions: list[float], pairs: np.ndarray) -> list[float]:
    """Probability of label 1 for each line of a chain."""
    (t00, t01), (t10, t11) = pairs.tolist()
    n = len(emissions)
    ahead, at = [0.0] * n, 0.0
    for i in range(n):
        at = emissions[i] + (_log_ratio(at, (t01, t11), (t00, t10)) if i else 0.0)
        ahead[i] = at
    back = 0.0
    out = [0.0] * n
    for i in range(n - 1, -1, -1):
        x = ahead[i] + back
        out[i] = 1 / (1 + math.exp(-x)) if x > -700 else 0.0
        back = _log_ratio(emissions[i] + back, (t10, t11), (t00, t01))
    return out


class _Chains:
    """Training lines, laid out by document and place for passes over all at once."""

    def __init__(self, x: np.ndarray, owner: np.ndarray):
        n = int(owner[-1]) + 1 if len(owner) else 0
        zero = np.zeros_like(x)
        same = (owner[1:] == owner[:-1])[:, None]
        before, after = zero.copy(), zero
        before[1:], after[:-1] = x[:-1] * same, x[1:] * same
        self.x, self.owner = np.concatenate([x, before, after], 1), owner
        size = np.bincount(owner, minlength=n)
        order = np.argsort(-size, kind="stable")  # long ones first, so that a place's documents are the first few
        row = np.empty(n, np.int64)
        row[order] = np.arange(n)
        place = np.arange(len(owner)) - (np.cumsum(size) - size)[owner]
        self.cell = place * n + row[owner]
        self.width, self.length = n, int(size.max(initial=0))
        self.active = [int((size > t).sum()) for t in range(self.length)]
        self.last = size[order] - 1

    def expect(self, emissions: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of all lines and expected numbers of neighbouring labels."""
        def ratio(x, one, zero):
            return np.logaddexp(one[0], x + one[1]) - np.logaddexp(zero[0], x + zero[1])

        (t00, t01), (t10, t11) = pairs
        e = np.zeros((self.length, self.width))
        e.flat[self.cell] = emissions
        ahead, back, odds, counts = e.copy(), np.zeros_like(e), np.zeros_like(e), np.zeros((2, 2))
        for t in range(1, self.length):
            k = self.active[t]
            ahead[t, :k] += ratio(ahead[t - 1, :k], (t01, t11), (t00, t10))
        for t in range(self.length - 2, -1, -1):
            k = self.active[t + 1]
            on = e[t + 1, :k] + back[t + 1, :k]
            back[t, :k] = ratio(on, (t10, t11), (t00, t01))
            joint = np.stack([t00 + 0 * on, t01 + on, t10 + ahead[t, :k], t11 + ahead[t, :k] + on])
            joint = np.exp(joint - joint.max(0))
            counts += (joint / joint.sum(0)).sum(1).reshape(2, 2)
        odds = ahead + back
        return 1 / (1 + np.exp(-np.clip(odds.flat[self.cell], -500, 500))), counts

    def fit(self, labels: np.ndarray, chain: bool, start: np.ndarray | None = None, steps: int = 60, rate: float = 0.15, decay: float = 1e-4):
        """Weights of features and neighbours that fit the lines' labels."""
        d, n = self.x.shape[1], max(len(labels), 1)
        w = np.zeros(d + 4) if start is None else start.copy()
        same = self.owner[1:] == self.owner[:-1]
        seen = np.zeros((2, 2))
        np.add.at(seen, (labels[:-1][same], labels[1:][same]), 1)
        observed = np.concatenate([self.x.T @ labels, seen.ravel() + 0.5 * chain])
        m, v = np.zeros_like(w), np.zeros_like(w)
        for step in range(1, steps + 1):
            p, counts = self.expect(self.x @ w[:d], w[d:].reshape(2, 2) if chain else np.zeros((2, 2)))
            g = (np.concatenate([self.x.T @ p, counts.ravel()]) - observed) / n + decay * w
            if not chain:
                g[d:] = 0
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        return w


def fit_model(features: np.ndarray, points: np.ndarray, owner: np.ndarray, labels: np.ndarray) -> Model:
    """The model of some documents' lines (``owner`` ascending, from 0 on) and the documents' labels."""
    d = N_FEATURES
    share = float(labels.mean()) if len(labels) else 0.5
    if not len(owner) or share in (0.0, 1.0):
        none = np.zeros(d)
        return Model(none, np.ones(d), none, none, none, np.zeros((2, 2)), 0.0, math.log((share + 1e-4) / (1 - share + 1e-4)), share)
    has = np.unique(owner)
    mean, scale = features.mean(0), features.std(0) + 1e-3
    mean[0], scale[0] = 0, 1
    chains = _Chains(((features - mean) / scale).astype(np.float64), np.searchsorted(has, owner))
    document, labels = chains.owner, labels[has].astype(np.int64)
    line = labels[document].copy()
    w = chains.fit(line, chain=False)
    for _ in range(3):
        p, _ = chains.expect(chains.x @ w[:3 * d], w[3 * d:].reshape(2, 2))
        worst = np.full(len(has), np.inf)
        np.minimum.at(worst, document, p)
        line = np.where(labels[document] == 1, 1, ((p > 0.5) & (p > worst[document])).astype(np.int64))
        w = chains.fit(line, chain=True, start=w, steps=40)
    p, _ = chains.expect(chains.x @ w[:3 * d], w[3 * d:].reshape(2, 2))
    means = np.clip(np.bincount(document, p * points) / np.maximum(np.bincount(document, points), 1), 1e-4, 1 - 1e-4)
    slope, shift = _logistic(np.log(means / (1 - means)), labels)
    return Model(mean, scale, w[:d], w[d:2 * d], w[2 * d:3 * d], w[3 * d:].reshape(2, 2), slope, shift, share)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (at least 0) and shift of a logistic curve, by Newton's steps on targets a little inside 0 and 1."""
    n1, n0 = y.sum(), (1 - y).sum()
    goal = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    w, rows = np.zeros(2), np.stack([x, np.ones_like(x)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -50, 50)))
        hessian = (rows * (p * (1 - p))[:, None]).T @ rows + 1e-3 * np.eye(2)
        w -= np.clip(np.linalg.solve(hessian, rows.T @ (p - goal) + 1e-3 * w), -2, 2)
    return max(float(w[0]), 0.0), float(w[1])


SAMPLE = "label int, order long, n int, features binary, points binary"


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, max_lines: int = MAX_LINES) -> Model:
    """Model of ``docs`` (doc_id, text) by ``labels`` (doc_id, label 0 or 1)."""
    chosen = labels.filter("doc_id IS NOT NULL AND label IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("of_doc")).agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    chosen = chosen.withColumn("order", F.xxhash64("of_doc")).orderBy("order", "of_doc").limit(max_docs)

    def features(batches):
        for part in in_parts(batches):
            x, points, owner = line_features(texts(part.column("text")))
            sizes = np.bincount(owner, minlength=part.num_rows)
            at = np.concatenate([[0], np.cumsum(sizes)])
            rows = [{"label": y, "order": o, "n": int(sizes[i]), "features": x[at[i]:at[i + 1]].tobytes(), "points": points[at[i]:at[i + 1]].tobytes()}
                    for i, (y, o) in enumerate(zip(part.column("label").to_pylist(), part.column("order").to_pylist(), strict=True)) if sizes[i] <= max_lines]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("label", pa.int32()), ("order", pa.int64()), ("n", pa.int32()), ("features", pa.binary()), ("points", pa.binary())]))

    wanted = docs.select(F.col("doc_id").cast("long").alias("of_doc"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "of_doc")
    found = wanted.select("label", "order", "text").mapInArrow(features, SAMPLE).orderBy("order", F.sha2("features", 256)).limit(max_docs).collect()
    x = np.frombuffer(b"".join(r["features"] for r in found), np.float32).reshape(-1, N_FEATURES)
    points = np.frombuffer(b"".join(r["points"] for r in found), np.int64)
    return fit_model(x, points, np.repeat(np.arange(len(found)), [r["n"] for r in found]), np.array([r["label"] for r in found], np.int64))


LINES = "doc_id long, line int, n_points long, good double"


def _scored(batches, model: Model):
    """Of some documents: ids, scores, and the lines' owners, code points and marginals."""
    for part in in_parts(batches):
        x, points, owner = line_features(texts(part.column("text")))
        odds, at = model.emissions(x, owner).tolist(), np.searchsorted(owner, np.arange(part.num_rows + 1)).tolist()
        good = np.array([p for i, j in zip(at, at[1:], strict=False) for p in marginals(odds[i:j], model.pairs)])
        sums, sizes = (np.bincount(owner, w, part.num_rows) for w in (points * good, points))
        scores = [model.document(s / n) if n else model.empty for s, n in zip(sums.tolist(), sizes.tolist(), strict=True)]
        yield part.column("doc_id"), scores, owner, points, good


def lines(docs: DataFrame, model: Model) -> DataFrame:
    """Lines with a word: doc_id, line (its number among those, from 0 on), code points, probability of being good."""
    def rows(batches):
        for ids, _, owner, points, good in _scored(batches, model):
            place = np.arange(len(owner)) - np.searchsorted(owner, owner)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(owner)), pa.array(place, pa.int32()), pa.array(points), pa.array(good, pa.float64())], ["doc_id", "line", "n_points", "good"])

    return spread(_inputs(docs)).mapInArrow(rows, LINES)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (probability of label 1) of all documents."""
    def rows(batches):
        for ids, scores, *_ in _scored(batches, model):
            yield pa.RecordBatch.from_arrays([ids, pa.array(scores, pa.float64())], ["doc_id", "score"])

    return spread(_inputs(docs)).mapInArrow(rows, "doc_id long, score double")


def _inputs(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
