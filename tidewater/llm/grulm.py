"""Gated recurrent language model in numpy, trained and applied by Spark tasks.

Tokens are a text's words (ASCII letters in lower case) and one end. Word
counts come from all training documents. The ``n_words`` most frequent tokens
have inputs and outputs of their own, all others share an input. The output is
factored: a softmax over classes, and one over the tokens of the class, both
from the recurrent state. Classes are runs of the frequency order with about
equal counts; one more class holds all other words, with the fixed distribution
(c + 1) / (sum over the class of (c + 1) + 1), so a word never seen has the
share that the counts give to one.

``train`` goes through all training documents once, in ``rounds`` parts by a
hash of the document: in each, every task runs truncated backpropagation (Adam)
over its documents from the common parameters, and these become the mean of the
tasks' parameters, weighted by tokens. Documents lie end to end in lanes; the
state goes on from window to window and is zero where a document begins.
``score`` runs whole documents the same way and adds up log10 probabilities.

Counts of words that are not among the ``n_head`` most frequent are not sent to
all tasks: a task writes such words by document, and they join the counts.
A null text is the end alone. Repeated rows are scored, and learned, each.
Without training documents all words are unknown and the model knows the end
only.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.shared import saved
from tidewater.llm.words import in_parts, split_lower

FLUSH = 500_000
SLOT = 2_048  # parameters in a row of the averaging


def count_words(docs: DataFrame) -> DataFrame:
    """word and n over all texts."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def summed(held):
        table = pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])
        return table.select(["word", "n"]).cast(schema)

    def count(batches):
        held, size = [], 0
        for part in in_parts(batches):
            found = pc.value_counts(split_lower(part.column("text"))[0])
            held.append(pa.Table.from_arrays([found.field("values"), found.field("counts")], schema=schema))
            size += len(found)
            if size > FLUSH:  # what this task has so far, in one row a word
                held = [summed(held)]
                size = held[0].num_rows
                if size > FLUSH // 2:
                    yield from held[0].to_batches(max_chunksize=100_000)
                    held, size = [], 0
        if held:
            yield from summed(held).to_batches(max_chunksize=100_000)

    return docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Head words by falling count; the model's own tokens are the end and the first of them."""
    words: pa.Array
    counts: np.ndarray
    least: int  # every word counted at least so often is among them
    tokens: int
    types: int
    documents: int
    n_own: int
    class_of: np.ndarray
    class_from: np.ndarray

    @property
    def n_classes(self) -> int:
        return len(self.class_from)  # the last one holds all other words

    @property
    def other(self) -> float:
        """Sum of (c + 1) over the words of the last class, with one unseen."""
        own = int(self.counts[:self.n_own - 1].sum())
        return float(self.tokens - self.documents - own + max(0, self.types - self.n_own) + 1)


def vocabulary(counts: DataFrame, documents: int, n_head: int, n_words: int, n_classes: int) -> Vocabulary:
    total = counts.agg(F.sum("n"), F.count("*")).first()
    tokens, types = (total[0] or 0), total[1]
    # a row for each different count: the least count that leaves at most n_head words
    steps = counts.groupBy("n").agg(F.count("*").alias("words")).withColumn("kept", F.sum("words").over(Window.orderBy(F.desc("n"))))
    least = steps.filter(F.col("kept") <= n_head).agg(F.min("n")).first()[0] or 1 << 62
    head = counts.filter(F.col("n") >= least).toArrow()  # at most n_head words
    found = sorted(zip(head.column("n").to_pylist(), head.column("word").to_pylist(), strict=True), key=lambda x: (-x[0], x[1]))
    own = [documents] + [n for n, _ in found[:n_words - 1]]  # the end first
    order = np.array(own, np.float64)
    share = np.cumsum(order) / max(order.sum(), 1.0)
    bounds = [0]
    for k in range(1, len(own)):
        if share[k - 1] >= len(bounds) / n_classes:
            bounds.append(k)
    class_from = np.array([*bounds, len(own)], np.int64)
    return Vocabulary(pa.array([w for _, w in found], pa.string()), np.array([n for n, _ in found], np.int64), least, tokens + documents, types + (documents > 0),
                      documents, len(own), np.repeat(np.arange(len(bounds)), np.diff(class_from)), class_from)


def places_of(words: pa.Array, sizes: np.ndarray, head: pa.Array) -> list[np.ndarray]:
    """For each text the places of its words in the head, -1 of any other."""
    found = pc.fill_null(pc.index_in(words, value_set=head), -1).to_numpy()
    return np.split(found, np.cumsum(sizes)[:-1]) if len(sizes) else []


def own_tokens(places: np.ndarray, n_own: int) -> np.ndarray:
    """Tokens of the model: its own words, then all others, and at last the end (0)."""
    return np.append(np.where((places >= 0) & (places < n_own - 1), places + 1, n_own), 0)


def log_softmax_of(logits: np.ndarray, targets: np.ndarray, grad: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Of logits with a column for each row of a batch (sums over the outputs
    then go along whole rows): log softmax at the targets and its gradient."""
    columns = np.arange(len(targets))
    logits -= logits.max(0)
    at = logits[targets, columns]
    np.exp(logits, out=logits)
    total = logits.sum(0)
    if not grad:
        return at - np.log(total), None
    logits /= -total
    logits[targets, columns] += 1.0
    return at - np.log(total), logits


class Network:
    """Parameters in one vector, and the two directions."""

    def __init__(self, vocab: Vocabulary, hidden: int, vector: np.ndarray | None = None):
        self.h, self.n_own, self.vocab = hidden, vocab.n_own, vocab
        shapes = {"x": (self.n_own + 1, 3 * hidden), "u": (hidden, 2 * hidden), "v": (hidden, hidden), "b": (3 * hidden,),
                  "c": (vocab.n_classes, hidden), "cb": (vocab.n_classes,), "w": (self.n_own, hidden), "wb": (self.n_own,)}
        sizes = {k: math.prod(s) for k, s in shapes.items()}
        if vector is None:
            vector = np.zeros(sum(sizes.values()), np.float32)
            fresh = True
        else:
            fresh = False
        self.vector, self.p, at = vector, {}, 0
        for k, shape in shapes.items():
            self.p[k] = vector[at:at + sizes[k]].reshape(shape)
            at += sizes[k]
        if fresh:
            rng = np.random.default_rng(7)
            for k in ("x", "u", "v"):
                self.p[k][:] = rng.normal(0, 0.3 if k == "x" else 0.5 / math.sqrt(hidden), shapes[k])
            self.p["b"][:hidden] = 1.0  # at first the state lasts
            own = np.concatenate([[vocab.documents], vocab.counts[:self.n_own - 1]]).astype(np.float64)
            self.p["wb"][:] = np.log(own + 1.0)
            mass = np.array([own[a:b].sum() for a, b in zip(vocab.class_from[:-1], vocab.class_from[1:], strict=True)] + [vocab.tokens - own.sum()])
            self.p["cb"][:] = np.log(mass + 1.0)

    def outputs(self, states: np.ndarray, targets: np.ndarray, grad: bool):
        """Natural log probability of each target (of the last class: of the
        class alone), and with ``grad`` the gradients of their sum."""
        p, vocab = self.p, self.vocab
        own = targets < self.n_own
        which = np.full(len(targets), vocab.n_classes - 1)
        which[own] = vocab.class_of[targets[own]]
        found, d = log_softmax_of(p["c"] @ states.T + p["cb"][:, None], which, grad)
        out = found.astype(np.float64)
        if grad:
            g = {"c": d @ states, "cb": d.sum(1), "w": np.zeros_like(p["w"]), "wb": np.zeros_like(p["wb"])}
            back = d.T @ p["c"]
        order = np.argsort(which.astype(np.uint16), kind="stable")
        edges = np.searchsorted(which[order], np.arange(vocab.n_classes))
        for k in range(vocab.n_classes - 1):
            a, b = vocab.class_from[k], vocab.class_from[k + 1]
            at = order[edges[k]:edges[k + 1]]
            if b - a < 2 or not len(at):
                continue
            s = states[at]
            found, d = log_softmax_of(p["w"][a:b] @ s.T + p["wb"][a:b, None], targets[at] - a, grad)
            out[at] += found
            if grad:
                g["w"][a:b], g["wb"][a:b] = d @ s, d.sum(1)
                back[at] += d.T @ p["w"][a:b]
        return (out, back, g) if grad else out

    def window(self, state, tokens, fresh, targets, grad: bool):
        """A window of (time, lane) input tokens; ``fresh`` marks lanes where a
        document begins. Returns log probabilities, the last state and, with
        ``grad``, the gradient of their sum as one vector."""
        h, p = self.h, self.p
        time, n = tokens.shape
        inputs = (p["x"] + p["b"])[tokens]
        stays = (1.0 - fresh)[:, :, None]
        old, states, new = (np.empty((time, n, h), inputs.dtype) for _ in range(3))
        gates = inputs[:, :, :2 * h]  # becomes the gates: how much of the state lasts, and how much the new one sees
        held = np.empty((time, n, h), inputs.dtype)
        for t in range(time):
            np.multiply(state, stays[t], out=old[t])
            g = gates[t]
            g += old[t] @ p["u"]
            np.negative(g, out=g)
            np.exp(g, out=g)
            g += 1.0
            np.reciprocal(g, out=g)
            np.multiply(g[:, h:], old[t], out=held[t])
            np.tanh(inputs[t, :, 2 * h:] + held[t] @ p["v"], out=new[t])
            state = np.subtract(old[t], new[t], out=states[t])
            state *= g[:, :h]
            state += new[t]
        every = states.reshape(-1, h)
        if not grad:
            return self.outputs(every, targets.ravel(), False), state, None
        out, back, g = self.outputs(every, targets.ravel(), True)
        back = back.reshape(time, n, h)
        keep, reset = gates[:, :, :h], gates[:, :, h:]
        # what a gradient of the state is multiplied with on its way to the inputs of each gate
        to_new = (1.0 - keep) * (1.0 - new * new)
        to_keep = (old - new) * keep * (1.0 - keep)
        to_reset = old * reset * (1.0 - reset)
        gx = np.empty((time, n, 3 * h), inputs.dtype)
        d = np.zeros_like(state)
        ut, vt = p["u"].T.copy(), p["v"].T.copy()
        for t in range(time - 1, -1, -1):
            d = d + back[t]
            d_new = np.multiply(d, to_new[t], out=gx[t, :, 2 * h:])
            d_held = d_new @ vt
            np.multiply(d, to_keep[t], out=gx[t, :, :h])
            np.multiply(d_held, to_reset[t], out=gx[t, :, h:2 * h])
            d *= keep[t]
            d_held *= reset[t]
            d += d_held
            d += gx[t, :, :2 * h] @ ut
            d *= stays[t]
        flat, places = gx.reshape(-1, 3 * h), tokens.ravel()
        order = np.argsort(places.astype(np.uint16) if self.n_own < 1 << 16 else places, kind="stable")
        seen, begin = np.unique(places[order], return_index=True)
        table_grad = np.zeros_like(p["x"])
        table_grad[seen] = np.add.reduceat(flat[order], begin, 0)
        g |= {"x": table_grad, "u": old.reshape(-1, h).T @ flat[:, :2 * h], "v": held.reshape(-1, h).T @ flat[:, 2 * h:], "b": table_grad.sum(0)}
        return out, state, np.concatenate([g[k].ravel() for k in p])


class Adam:
    def __init__(self, n: int, rate: float):
        self.rate, self.m, self.v, self.t = rate, np.zeros(n, np.float32), np.zeros(n, np.float32), 0

    def climb(self, vector: np.ndarray, grad: np.ndarray) -> None:
        self.t += 1
        self.m += 0.1 * (grad - self.m)
        self.v += 0.01 * (grad * grad - self.v)
        rate = self.rate * math.sqrt(1.0 - 0.99 ** self.t) / (1.0 - 0.9 ** self.t)
        vector += rate * self.m / (np.sqrt(self.v) + 1e-6)


class Lanes:
    """Documents end to end in ``n`` lanes of about equal length, longest
    first. Of each place: the input token (the one before it), the target,
    whether a document begins there, and the document's number. Only as much
    is held as there are tokens, however long a document is."""

    def __init__(self, docs: list[np.ndarray], n: int):
        heap = [(0, k) for k in range(n)]
        held: list[list[int]] = [[] for _ in range(n)]
        for i in sorted(range(len(docs)), key=lambda i: (-len(docs[i]), i)):
            size, k = heapq.heappop(heap)
            held[k].append(i)
            heapq.heappush(heap, (size + len(docs[i]), k))
        sizes = {k: size for size, k in heap}
        order = [i for k in sorted(sizes, key=lambda k: -sizes[k]) for i in held[k]]
        self.sizes = np.array(sorted(sizes.values(), reverse=True), np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        lengths = np.array([len(docs[i]) for i in order], np.int64)
        self.target = np.concatenate([docs[i] for i in order]) if order else np.empty(0, np.int64)
        self.number = np.repeat(np.array(order, np.int64), lengths)
        first = np.cumsum(lengths) - lengths
        self.input = np.empty_like(self.target)
        self.input[1:] = self.target[:-1]
        self.input[first] = 0  # the first input is the end of what came before
        self.fresh = np.zeros(len(self.target), np.float32)
        self.fresh[first] = 1.0

    def windows(self, size: int):
        """(lanes that go on, inputs, targets, beginnings, numbers) of each
        window of ``size`` places; behind a lane's last place the number is -1,
        the state begins anew and the end follows the end."""
        for at in range(0, int(self.sizes.max(initial=0)), size):
            live = int((self.sizes > at).sum())
            place = np.arange(at, at + size)[:, None]
            inside = place < self.sizes[:live]
            inside = inside[inside.any(1)]
            place = np.where(inside, place[:len(inside)] + self.begins[:live], 0)
            yield (live, np.where(inside, self.input[place], 0), np.where(inside, self.target[place], 0),
                   np.where(inside, self.fresh[place], np.float32(1)), np.where(inside, self.number[place], -1))


def averaged(parts: DataFrame, size: int) -> np.ndarray | None:
    """Mean of the tasks' parameters, weighted by their tokens."""
    def mean(batches):
        current, total, weight = None, None, 0.0
        schema = pa.schema([("slot", pa.int64()), ("mean", pa.binary())])
        for batch in batches:
            for slot, tokens, data in zip(*(batch.column(c).to_pylist() for c in ("slot", "tokens", "data")), strict=True):
                if slot != current:
                    if current is not None:
                        yield pa.RecordBatch.from_pylist([{"slot": current, "mean": (total / weight).astype(np.float32).tobytes()}], schema)
                    current, total, weight = slot, 0.0, 0.0
                total = total + tokens * np.frombuffer(data, np.float32).astype(np.float64)
                weight += tokens
        if current is not None:
            yield pa.RecordBatch.from_pylist([{"slot": current, "mean": (total / weight).astype(np.float32).tobytes()}], schema)

    found = parts.repartition("slot").sortWithinPartitions("slot").mapInArrow(mean, "slot long, mean binary").collect()  # one vector of parameters
    if not found:
        return None
    return np.concatenate([np.frombuffer(r["mean"], np.float32) for r in sorted(found, key=lambda r: r["slot"])])[:size].copy()


def train(docs: DataFrame, vocab: Vocabulary, hidden: int = 16, rounds: int = 2, window: int = 16, most_lanes: int = 512,
          updates: int = 400, piece: int = 1_024, rate: float = 0.01) -> np.ndarray:
    """Parameters after one pass over ``docs`` (doc_id, text). A task begins
    with few lanes and takes more, up to ``most_lanes``, as it goes on: as many
    as would make ``updates`` windows of the tokens that it has had. In training
    alone, a document of over ``piece`` tokens goes on in another lane, from the
    zero state, so that no lane is much longer than the others."""
    vector = Network(vocab, hidden).vector
    if not vocab.documents:
        return vector
    sc = docs.sparkSession.sparkContext
    of_round = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("round")), F.lit(rounds))
    for r in range(rounds):
        shared = sc.broadcast((vocab, vector))  # n_head words and one vector: both bounded by parameters

        def learn(batches, shared=shared, r=r):
            vocab, start = shared.value
            net, own = Network(vocab, hidden, start.copy()), vocab.words.slice(0, vocab.n_own - 1)
            adam, tokens = Adam(len(start), rate / (1 + r)), 0
            for part in in_parts(batches):
                found = [own_tokens(x, vocab.n_own) for x in places_of(*split_lower(part.column("text")), own)]
                found = [x[k:k + piece] for x in found for k in range(0, len(x), piece)]
                tokens += sum(map(len, found))
                packed = Lanes(found, max(8, min(most_lanes, tokens // (window * updates))))
                state = np.zeros((len(packed.sizes), hidden), np.float32)
                for live, inputs, targets, fresh, _ in packed.windows(window):
                    out, state, grad = net.window(state[:live], inputs, fresh, targets, True)
                    adam.climb(net.vector, grad / out.size)
            if tokens:
                data = np.pad(net.vector, (0, -len(net.vector) % SLOT)).reshape(-1, SLOT)
                yield pa.RecordBatch.from_pylist([{"slot": k, "tokens": tokens, "data": row.tobytes()} for k, row in enumerate(data)],
                                                 pa.schema([("slot", pa.int64()), ("tokens", pa.int64()), ("data", pa.binary())]))

        mean = averaged(docs.filter(of_round == r).select("text").mapInArrow(learn, "slot long, tokens long, data binary"), len(vector))
        vector = vector if mean is None else mean
    return vector


SCORED = "kind int, row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, word string, times long"
_SCORED = pa.schema([("kind", pa.int32()), ("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                     ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()), ("word", pa.string()), ("times", pa.int64())])


def log_likelihoods(net: Network, docs: list[np.ndarray], window: int, most_lanes: int) -> np.ndarray:
    """log10 probability of each document's tokens, the last class as one."""
    if not docs:
        return np.empty(0)
    total = np.zeros(len(docs))
    # no more lanes than the longest document leaves to be filled
    packed = Lanes(docs, max(1, min(most_lanes, len(docs), max(64, sum(map(len, docs)) // max(map(len, docs))))))
    state = np.zeros((len(packed.sizes), net.h), np.float32)
    for live, inputs, targets, fresh, number in packed.windows(window):
        out, state, _ = net.window(state[:live], inputs, fresh, targets, False)
        inside = number.ravel() >= 0
        total += np.bincount(number.ravel()[inside], out[inside], minlength=len(docs))
    return total / math.log(10.0)


def score(docs: DataFrame, counts: DataFrame, vocab: Vocabulary, vector: np.ndarray, hidden: int = 16, window: int = 32, most_lanes: int = 1024,
          long_tokens: int = 1_500, held_tokens: int = 1 << 21) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score
    of every row of ``docs`` (doc_id, text, held_out). A task puts documents of
    over ``long_tokens`` tokens aside, up to ``held_tokens`` of them, and runs
    them side by side."""
    shared = docs.sparkSession.sparkContext.broadcast((vocab, vector))

    def run(batches):
        vocab, params = shared.value
        net = Network(vocab, hidden, params)
        known = np.log10(np.append(vocab.counts, 0) + 1.0)  # the last: of a word outside the head, by the join
        end, other = math.log10(vocab.documents + 1.0), math.log10(vocab.other)
        n_own, row = vocab.n_own, TaskContext.get().partitionId() << 40

        def rows(items):
            logs = log_likelihoods(net, [tokens for *_, tokens, _ in items], window, most_lanes)
            n_known, base = [], []
            for i, (_, _, _, tokens, places) in enumerate(items):
                base.append(float(known[places].sum()) + end)
                n_known.append(int((places >= 0).sum()) + (vocab.documents > 0))
                # words of the last class have their share in it, too
                logs[i] += float(known[places[places >= n_own - 1]].sum()) - other * int((tokens == n_own).sum())
            n = len(items)
            numbers, docs_, held = ([x[k] for x in items] for k in range(3))
            return pa.RecordBatch.from_arrays([
                pa.array([0] * n, pa.int32()), pa.array(numbers, pa.int64()), pa.array(docs_, pa.int64()), pa.array(held, pa.bool_()),
                pa.array([len(x[3]) for x in items], pa.int64()), pa.array(n_known, pa.int64()), pa.array(base, pa.float64()),
                pa.array(logs, pa.float64()), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64())], schema=_SCORED)

        def outside(words, sizes, places, first):
            missing = pa.array(np.concatenate(places) < 0)
            owner = pa.array(np.repeat(np.arange(first, first + len(sizes)), sizes)).filter(missing)
            found = pa.table({"row": owner, "word": words.filter(missing)}).group_by(["row", "word"]).aggregate([([], "count_all")])
            for batch in found.to_batches(max_chunksize=100_000):
                k = batch.num_rows
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.ones(k, np.int32)), batch.column("row"), *(pa.nulls(k, t) for t in _SCORED.types[2:8]),
                    batch.column("word"), batch.column("count_all")], schema=_SCORED)

        aside, aside_tokens = [], 0
        for part in in_parts(batches):
            words, sizes = split_lower(part.column("text"))
            places, items = places_of(words, sizes, vocab.words), []
            yield from outside(words, sizes, places, row)
            for doc, held_out, x in zip(part.column("doc_id").to_pylist(), part.column("held_out").to_pylist(), places, strict=True):
                item = (row, doc, held_out, own_tokens(x, n_own), x)
                row += 1
                if len(x) >= long_tokens:
                    aside.append(item)
                    aside_tokens += len(x)
                else:
                    items.append(item)
            yield rows(items)
            if aside_tokens > held_tokens:
                yield rows(aside)
                aside, aside_tokens = [], 0
        yield rows(aside)

    found = saved(docs.mapInArrow(run, SCORED), "lm-scored")
    # words outside the head: their counts come by a join, and sums go back to the documents
    rare = counts.filter(F.col("n") < vocab.least).withColumnRenamed("n", "seen")
    tail = found.filter("kind = 1").select("row", "word", "times").join(rare, "word", "left")
    tail = tail.groupBy("row").agg(F.sum(F.when(F.col("seen") > 0, F.col("times")).otherwise(0)).alias("tail_known"),
                                   F.sum(F.col("times") * F.log10(F.coalesce("seen", F.lit(0)) + 1.0)).alias("tail_log"))
    whole = found.filter("kind = 0").join(tail, "row", "left")
    tail_log = F.coalesce("tail_log", F.lit(0.0))
    return whole.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
                        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
                        (F.col("base") + tail_log - F.col("n_tokens") * math.log10(vocab.tokens + vocab.types + 1)).alias("base_score"),
                        (F.col("score") + tail_log).alias("score"))


def train_and_score(docs: DataFrame, held_out: Column, n_head: int = 200_000, n_words: int = 1_024, n_classes: int = 32, hidden: int = 16, **training) -> DataFrame:
    """Learn from the rows of ``docs`` that are not ``held_out`` and score all."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out.alias("held_out"))
    learned = rows.filter(~F.col("held_out"))
    counts = saved(count_words(learned), "lm-counts")
    vocab = vocabulary(counts, learned.count(), n_head, n_words, n_classes)
    vector = train(learned, vocab, hidden, **training)
    return score(rows, counts, vocab, vector, hidden)
