import hashlib

from tests.llm.conftest import pairs, words
from tidewater.llm import subdup


def expected(rows, width=50):
    """By brute force: the smallest document in which each window starts."""
    first = {}
    for doc, text in rows:
        w = words(text)
        for k in range(len(w) - width + 1):
            if doc is not None:
                g = tuple(w[k:k + width])
                first[g] = min(first.get(g, doc), doc)
    out = []
    for doc, text in rows:
        w = words(text)
        gone = bytearray(len(w))
        for k in range(len(w) - width + 1):
            if doc is not None and first[tuple(w[k:k + width])] < doc:
                gone[k:k + width] = b"\1" * width
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((str(doc), len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], hashlib.sha256(r["kept_text"].encode()).hexdigest()) for r in df.collect())


def test_against_brute_force(edge, docs):
    both = docs.unionByName(edge.select(*docs.columns)).repartition(5)
    rows = pairs(both)
    assert any(x[2] for x in expected(rows))
    assert got(subdup.dedup(both)) == expected(rows)


def test_small_blocks_and_shards(edge):
    rows = pairs(edge)
    assert got(subdup.dedup(edge.repartition(4), width=7, block_windows=300, shard_windows=1 << 10)) == expected(rows, 7)


def test_no_documents(none):
    assert subdup.dedup(none).count() == 0


def test_a_block_without_an_answer_keeps_all(spark, edge):
    block = subdup.Block(5, exact=True)
    block.h1 = [__import__("numpy").arange(9, dtype="uint64")]
    assert len(subdup.estimated_repeated(block, "/nowhere", 20)) == 9
