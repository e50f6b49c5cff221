import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm.conftest import pairs, words
from tidewater.llm import grulm
from tidewater.llm.words import split_lower

def HELD():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2


def held(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 7 == 2


def expected(rows):
    lower = [(doc, [w.lower() for w in words(text)]) for doc, text in rows]
    counts, ends = Counter(), 0
    for doc, w in lower:
        if not held(doc):
            counts.update(w)
            ends += 1
    total, types = sum(counts.values()) + ends, len(counts) + (ends > 0)
    out = []
    for doc, w in lower:
        base = sum(math.log10((counts[x] + 1) / (total + types + 1)) for x in w) + math.log10((ends + 1) / (total + types + 1))
        out.append((str(doc), held(doc), len(w) + 1, sum(counts[x] > 0 for x in w) + (ends > 0), total, round(base, 4)))
    return sorted(out)


def counted(found):
    return sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in found)


def test_counts(edge, docs):
    both = docs.unionByName(edge.select(*docs.columns))
    # a small head, so that most words go by the join
    found = grulm.train_and_score(both, HELD(), n_head=300, n_words=100, n_classes=8).collect()
    assert counted(found) == expected(pairs(both))
    assert all(math.isfinite(r["score"]) for r in found)


def test_learns_more_than_counts(docs):
    found = grulm.train_and_score(docs, HELD()).collect()
    assert counted(found) == expected(pairs(docs))
    own = [r for r in found if r["held_out"]]
    gain = sum(r["score"] - r["base_score"] for r in own) * math.log2(10) / sum(r["n_tokens"] for r in own)
    assert len(own) > 20 and gain > 0.3  # bits a token


def plain_score(text, params, hidden, counts, n_words, class_from):
    """log10 probability of a text, word after word in plain steps."""
    common = sorted(counts, key=lambda w: (-counts[w], w))[:n_words - 1]
    place, n_own = {w: k + 1 for k, w in enumerate(common)}, len(common) + 1  # 0: the end
    other = sum(c + 1 for w, c in counts.items() if w not in place) + 1
    state, before, total = np.zeros(hidden), 0, 0.0

    def log_softmax(logits, k):
        return logits[k] - logits.max() - math.log(np.exp(logits - logits.max()).sum())

    for word in [*(w.lower() for w in words(text)), None]:
        x = (params["x"][before] + params["b"]).astype(float)
        keep, see = np.split(1 / (1 + np.exp(-(x[:2 * hidden] + state @ params["u"]))), 2)
        state = keep * state + (1 - keep) * np.tanh(x[2 * hidden:] + (see * state) @ params["v"])
        before = 0 if word is None else place.get(word, n_own)
        logits = params["c"] @ state + params["cb"]
        if before == n_own:
            total += log_softmax(logits, len(class_from) - 1) / math.log(10) + math.log10((counts[word] + 1) / other)
            continue
        k = int(np.searchsorted(class_from, before, "right")) - 1
        a, b = class_from[k], class_from[k + 1]
        total += (log_softmax(logits, k) + log_softmax(params["w"][a:b] @ state + params["wb"][a:b], before - a)) / math.log(10)
    return total


def test_score_by_plain_steps(edge, docs):
    """Scores of whole texts, over many windows, unseen and rare words, from the same parameters."""
    both = docs.unionByName(edge.select(*docs.columns)).filter("doc_id IS NOT NULL AND doc_id NOT IN (907, 910)").withColumn("held_out", HELD())
    learned = both.filter("NOT held_out")
    rows = pairs(both)
    counts = Counter(w.lower() for doc, text in rows if not held(doc) for w in words(text))
    counted_words = grulm.saved(grulm.count_words(learned), "lm-test-counts")
    vocab = grulm.vocabulary(counted_words, learned.count(), 300, 100, 8)
    vector = grulm.train(learned, vocab, 8)
    found = {r["doc_id"]: r["score"] for r in grulm.score(both, counted_words, vocab, vector, 8).collect()}
    params = grulm.Network(vocab, 8, vector).p
    assert len(found) == len(rows)
    some = [(doc, text) for doc, text in rows if doc >= 900 and doc != 906 or doc % 40 == 0 or held(doc) and doc % 3 == 0]
    assert any(held(doc) for doc, _ in some) and max(len(words(text)) for _, text in some) > 100
    for doc, text in some:
        want = plain_score(text, params, 8, counts, 100, vocab.class_from)
        assert math.isclose(found[doc], want, rel_tol=1e-4, abs_tol=1e-3), doc


def test_no_documents_and_nothing_to_learn(none, edge):
    assert grulm.train_and_score(none, HELD()).count() == 0
    found = grulm.train_and_score(edge, F.lit(True)).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and math.isfinite(r["score"]) for r in found)


def vocabulary(n):
    counts = np.arange(n - 1, 0, -1, dtype=np.int64) * 5
    return grulm.Vocabulary(pa.array([f"w{i}" for i in range(n - 1)]), counts, 1, int(counts.sum()) + 40, n + 3, 20, n,
                            np.repeat(np.arange(3), [2, n // 2 - 2, n - n // 2]), np.array([0, 2, n // 2, n]))


def test_distribution_sums_to_one():
    net = grulm.Network(vocabulary(12), 5)
    states = np.random.default_rng(2).normal(size=(4, 5)).astype(np.float32)
    total = sum(np.exp(net.outputs(states, np.full(4, t), False)) for t in range(13))
    assert np.allclose(total, 1.0, atol=1e-5)


def test_gradient():
    rng = np.random.default_rng(3)
    net = grulm.Network(vocabulary(12), 4)
    net = grulm.Network(net.vocab, 4, net.vector.astype(np.float64))
    tokens, targets = rng.integers(0, 13, (6, 3)), rng.integers(0, 13, (6, 3))
    fresh, state = (rng.random((6, 3)) < 0.2).astype(np.float64), rng.normal(size=(3, 4))
    _, _, grad = net.window(state, tokens, fresh, targets, True)
    for k in rng.choice(len(net.vector), 60, replace=False):
        keep, near = net.vector[k], []
        for step in (1e-5, -1e-5):
            net.vector[k] = keep + step
            near.append(net.window(state, tokens, fresh, targets, False)[0].sum())
        net.vector[k] = keep
        assert math.isclose((near[0] - near[1]) / 2e-5, grad[k], rel_tol=2e-3, abs_tol=2e-3), k


def test_lanes_do_not_change_a_score():
    vocab, rng = vocabulary(12), np.random.default_rng(4)
    net = grulm.Network(vocab, 4)
    docs = [np.append(rng.integers(1, 13, n), 0) for n in (1, 40, 3, 17, 90, 2)]
    results = []
    for n, size in ((1, 7), (3, 16), (6, 200)):
        total, packed = np.zeros(len(docs)), grulm.Lanes(docs, n)
        state = np.zeros((n, 4), np.float32)
        for live, inputs, targets, fresh, number in packed.windows(size):
            out, state, _ = net.window(state[:live], inputs, fresh, targets, False)
            inside = number.ravel() >= 0
            total += np.bincount(number.ravel()[inside], out[inside], minlength=len(docs))
        results.append(total)
    assert np.allclose(results[0], results[1], atol=1e-4) and np.allclose(results[0], results[2], atol=1e-4)


def test_words_are_split_alike():
    texts = ["", None, " a  B\tc\n", "\x0b\x0cx\ry\x1cz\x85 É é", "\n", "one", "tail "]
    found, sizes = split_lower(pa.array(texts))
    want = [(t or "").encode().lower().split() for t in texts]
    assert [w.encode() for w in found.to_pylist()] == [w for x in want for w in x] and sizes.tolist() == [len(x) for x in want]
