import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidewater.llm import pairmaps
from tidewater.llm.queries import QUERIES
from tidewater.llm.segments import Aligner, byte_of_char, public_path
from tests.conftest import SF001
from tests.llm.conftest import pairs as rows_of


class Plain:
    """Whole texts by the libraries, groups by sets of byte places."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(public_path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_path("piece_bpe_32k.model"))
        chars = byte_of_char()
        self.a_bytes = {i: bytes(chars[c] for c in t) if all(c in chars for c in t) else t.encode() for t, i in self.a.get_vocab().items()}
        self.b_bytes = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(len(self.b))]

    def groups(self, text):
        if not text:
            return []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        goal = (" " + text).encode()
        if b"".join(self.a_bytes[i] for i in a) != goal or b"".join(self.b_bytes[i] for i in b) != goal:
            return []
        ends = [set(np.cumsum([len(x[i]) for i in ids]).tolist()) for x, ids in ((self.a_bytes, a), (self.b_bytes, b))]
        out, begin = [], 0
        starts = [np.cumsum([0] + [len(x[i]) for i in ids]).tolist() for x, ids in ((self.a_bytes, a), (self.b_bytes, b))]
        where = [dict(zip(s, range(len(s)))) for s in starts]
        for end in sorted(ends[0] & ends[1]):
            out.append((a[where[0][begin]:where[0][end]], b[where[1][begin]:where[1][end]]))
            begin = end
        return out


def expected(rows):
    plain = Plain()
    all_groups = [plain.groups(t) for _, t in rows]
    links = [Counter((x, y) for a, b in groups for x in a for y in b) for groups in all_groups]
    docs = Counter(p for c in links for p in c)
    most = defaultdict(int)
    for (x, _), n in docs.items():
        most[x] = max(most[x], n)
    out = []
    for (doc, _), groups, c in zip(rows, all_groups, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((doc, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(c.values()), sum(n for p, n in c.items() if docs[p] == most[p[0]]),
                    sum(n * docs[p] for p, n in c.items()), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr)


def found(df):
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert df.columns == columns
    return sorted((tuple(r) for r in df.collect()), key=repr)


def run(df):
    aligned = pairmaps.align(df)
    return pairmaps.scores(aligned, pairmaps.pairs(aligned))


def test_query_equals_whole_texts(spark, docs):
    assert found(QUERIES["op12_inverted_pair_bitmaps"](spark, SF001)) == expected(rows_of(docs))


def test_edges(spark, edge, none):
    more = spark.createDataFrame([(i, t) for i, t in enumerate([" x  y", "a　 b", "a 　b", "x\n\ny\n z", " lead", "trail ", "don't it's 'tis", "mark ▁ here", "<s> <0x41> </s><unk>", "é.É,×.÷!",
                                  "a\x00b \x00", "\n", " ", "\x85 \x1c.", "abc\tdef\t ghi", "日本 語.\n한국", "x" * 300 + " " + "y" * 300, "**bold** (paren) [x] a.b.c", "“quote” … — dash"])], "doc_id long, text string")
    for df in (edge, more, edge.limit(0), none):
        assert found(run(df)) == expected(rows_of(df))


def test_cleared_cache():
    """What is learned anew is the same."""
    aligner = Aligner.of("byte_bpe_50k.json", "piece_bpe_32k.model")
    texts = [f"word{i} the, and.\nThat's {i}".encode() for i in range(50)]
    first, counts = aligner.segments(texts)
    strings = [s.as_py() for s in aligner.table.strings.take(first.tolist())]
    aligner.clear()
    again, _ = aligner.segments(texts)
    assert strings == [s.as_py() for s in aligner.table.strings.take(again.tolist())] and counts.sum() == len(first)


@pytest.mark.parametrize("n_docs", [1, 9, 70, 65_536])
def test_postings_round_trip(n_docs):
    rng = np.random.default_rng(n_docs)
    keys = np.unique(np.concatenate([np.full(n_docs, 5) << 16 | np.arange(n_docs), rng.integers(0, 40, 500) << 16 | rng.integers(0, n_docs, 500)]))
    links = rng.integers(1, 70, len(keys))
    half = rng.random(len(keys)) < 0.5
    merged = pairmaps.merge([(keys[half], links[half]), (keys, links), (keys[:0], links[:0])])
    assert (merged[0] == keys).all() and (merged[1] == links * (1 + half)).all()
    pair, size, total, docs, planes = pairmaps.postings(*merged, n_docs)
    owner, doc, again = pairmaps.expand(size, docs, planes)
    assert (pair[owner] << 16 | doc == keys).all() and (again == merged[1]).all() and total.sum() == merged[1].sum()
    assert max(len(x.as_py()) for x in docs) <= -(-n_docs // 8) + 1


def test_small_runs(docs, monkeypatch):
    """A document that goes through in parts counts once."""
    some = rows_of(docs)[:60]
    for name, value in (("CHUNK_POSTINGS", 50), ("RUN_LINKS", 7)):
        monkeypatch.setattr(pairmaps, name, value)
    aligner = Aligner.of("byte_bpe_50k.json", "piece_bpe_32k.model")
    import pyarrow as pa
    chunk = pairmaps.Chunk(0)
    pairmaps._documents(aligner, chunk, pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in some], "text": [t for _, t in some]}))
    assert len(chunk.runs) > len(some)
    keys, links = pairmaps.merge(chunk.runs)
    assert sum(links.tolist()) == sum(r[4] for r in expected(some)) and len(np.unique(keys)) == len(keys)
