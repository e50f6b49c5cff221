import random

import numpy as np
import pytest

from tests.conftest import SF001
from tests.llm.conftest import PASSAGE, pairs
from tidewater.llm import decon


def score(item, passage):
    """Smith-Waterman by the book."""
    h = np.zeros((len(item) + 1, len(passage) + 1), int)
    for i in range(1, len(item) + 1):
        for j in range(1, len(passage) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if item[i - 1] == passage[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return h.max()


def test_alignment_by_the_book():
    rng = np.random.default_rng(1)
    items = [rng.integers(1, 5, n) for n in rng.integers(1, 14, 60)]
    passages = [rng.integers(0, 5, n) for n in rng.integers(1, 30, 60)]
    for (best, a, b), x, y in zip(decon.align(items, passages), items, passages, strict=True):
        assert best == score(x, y)
        assert score(x, y[a:b]) == best  # the passage alone has the alignment


def plain(text):
    return [f for f in (decon.plain(w.decode()) for w in (text or "").encode().split()) if f]


def test_whole_copies_of_the_benchmark(spark, docs):
    bench = spark.read.parquet(f"{SF001}/benchmark.parquet")
    found = {(r["doc_id"], r["item_id"]): r["score"] for r in decon.hits(docs, bench).collect()}
    seen, want = {}, set()
    for item, text in sorted((r["item_id"], r["text"]) for r in bench.collect()):
        seen.setdefault(tuple(plain(text)), item)
    for doc, text in pairs(docs):
        line = f" {' '.join(plain(text))} "
        want |= {(doc, item) for w, item in seen.items() if f" {' '.join(w)} " in line}
    assert want and want <= set(found) and all(found[k] == 1.0 for k in want)
    kept = {r["doc_id"] for r in decon.without(docs, bench).collect()}
    assert kept == {d for d, _ in pairs(docs)} - {d for d, _ in found}


def test_edited_copies_and_blocks(spark):
    rng = random.Random(4)
    items = [" ".join(f"v{rng.randrange(400)}" for _ in range(rng.randint(20, 60))) for _ in range(30)]
    rows, planted = [], set()
    for doc in range(200):
        filler = [f"v{rng.randrange(4000)}" for _ in range(120)]
        if doc % 4 == 0:
            item = rng.randrange(30)
            text = items[item].split()
            for _ in range(len(text) // 6):  # replaced, left out, put in
                k = rng.randrange(len(text))
                text[k:k + 1] = rng.choice([["edit"], [], [text[k], "more"]])
            filler[50:50] = [w.upper() + rng.choice(["", ",", "."]) for w in text]
            planted.add((doc, item))
        rows.append((doc, " ".join(filler)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    for words in (200_000, 150):
        assert {(r["doc_id"], r["item_id"]) for r in decon.hits(docs, bench, block_words=words).collect()} == planted


@pytest.mark.parametrize("block_words", [10, 200_000])
def test_edges(spark, edge, none, block_words):
    bench = spark.createDataFrame([(1, PASSAGE), (0, PASSAGE.upper()), (2, None), (3, ""), (4, "two words"), (None, PASSAGE)], "item_id long, text string")
    if block_words > 10:  # in one block, equal items are one
        found = decon.hits(edge, bench, block_words=block_words).collect()
        assert sorted((str(r["doc_id"]), r["item_id"]) for r in found) == [("908", 0), ("909", 0), ("910", 0), ("910", 0), ("None", 0)]
    kept = decon.without(edge, bench, block_words=block_words)
    assert kept.columns == edge.columns
    assert sorted(str(d) for d, _ in pairs(kept)) == sorted(str(d) for d, t in pairs(edge) if PASSAGE not in (t or ""))
    assert decon.hits(none, bench).count() == 0
    assert decon.hits(edge, bench.limit(0)).count() == 0 and decon.without(edge, bench.limit(0)).count() == edge.count()


def test_every_third_to_fifth_word_edited_and_parts(spark):
    rng = random.Random(6)
    items = [" ".join(f"v{rng.randrange(3000)}" for _ in range(40)) for _ in range(24)]
    rows, planted = [], {}
    for item, text in enumerate(items):
        words, way = text.split(), item % 6
        if way < 3:  # one word in 3, 4 or 5
            words = [f"edit{k}" if k % (way + 3) == way + 2 else w for k, w in enumerate(words)]
        elif way < 5:  # the first or the second half
            words = words[:20] if way == 3 else words[20:]
        else:
            words = [w if rng.random() > 0.25 else "edit" for w in words]
        filler = [f"u{rng.randrange(4000)}" for _ in range(80)]
        rows.append((item, " ".join([*filler[:30], *words, *filler[30:]])))
        planted[item, item] = score(text.split(), words) / 80
    # whole copies elsewhere of half of the items
    rows += [(100 + item, f"before {items[item]} behind") for item in range(0, 24, 2)]
    planted |= {(100 + item, item): 1.0 for item in range(0, 24, 2)}
    assert all(x >= 0.4 for x in planted.values())
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["score"] for r in decon.hits(docs, bench).collect()}
    assert found == pytest.approx(planted)
    assert decon.without(docs, bench).count() == 0


def test_passages_of_long_items(spark):
    rng = random.Random(9)
    items = [" ".join(f"v{rng.randrange(9000)}" for _ in range(n)) for n in (400, 2000, 400, 300)]
    parts = [items[0].split()[200:320], items[1].split()[900:1050], items[2].split()[10:130], items[3].split()[250:280]]
    parts[2] = ["edit" if k % 3 == 2 else w for k, w in enumerate(parts[2])]  # 80 of 120 words
    rows = [(k, " ".join([f"u{rng.randrange(900)}" for _ in range(60)] + part + ["behind"] * 9)) for k, part in enumerate(parts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): (r["score"], r["doc_start"], r["doc_end"]) for r in decon.hits(docs, bench).collect()}
    # 30 words are under the length of a passage and the share of the item
    assert found == {(0, 0): (0.3, 60, 180), (1, 1): (0.075, 60, 210), (2, 2): (pytest.approx(121 / 800), 60, 179)}
    assert [r["doc_id"] for r in decon.without(docs, bench).collect()] == [3]
