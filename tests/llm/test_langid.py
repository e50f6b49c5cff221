import math
import re
import zlib
from collections import Counter

from tests.conftest import SF001
from tidewater.llm import langid
from tidewater.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    found = {r["doc_id"]: r for r in QUERIES["op4_word_first_language_id"](spark, SF001).collect()}
    rows = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    assert len(found) == len(rows)
    for r in rows:
        assert found[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= found[r["doc_id"]]["score"] <= 1
    out = [r for r in rows if found[r["doc_id"]]["held_out"]]
    assert sum(found[r["doc_id"]]["lang_pred"] == r["lang"] for r in out) >= 0.97 * len(out)


def test_edges(edge, docs, none):
    model = langid.train(docs.unionByName(edge.select(*docs.columns)))
    found = langid.predict(edge, model).collect()
    assert len(found) == edge.count()
    by_id = {r["doc_id"]: r for r in found}
    for doc in (900, 901, 902):
        assert (by_id[doc]["lang_pred"], by_id[doc]["score"]) == ("und", 0.0)
    assert by_id[907]["lang_pred"] in model.langs
    empty = langid.train(none)
    assert empty.langs == [] and {r["lang_pred"] for r in langid.predict(edge, empty).collect()} == {"und"}
    assert langid.predict(none, model).count() == 0


def plain_scores(rows, texts, max_order=4):
    """(lang, score) of each text in plain Python: words first, then the
    longest counted n-gram at each character."""
    langs = sorted({lang for text, lang in rows if lang is not None and words_in(text)})
    counts = {lang: [Counter() for _ in range(max_order + 1)] for lang in langs}
    for text, lang in rows:
        for word in words_in(text) if lang in counts else []:
            counts[lang][0][word] += 1
            marked = f"^{word}$"
            for n in range(1, max_order + 1):
                counts[lang][n].update(marked[i:i + n] for i in range(len(marked) - n + 1))
    known = [set().union(*(counts[lang][n] for lang in langs)) for n in range(max_order + 1)]
    totals = {lang: [sum(c.values()) + 0.5 * len(k) + 0.5 for c, k in zip(counts[lang], known, strict=True)] for lang in langs}

    def log(lang, n, gram):
        return math.log((counts[lang][n][gram] + 0.5) / totals[lang][n])

    def of_word(lang, word):
        if word in known[0]:
            return log(lang, 0, word)
        marked = f"^{word}$"
        longest = (next((n for n in range(max_order, 0, -1) if i + n <= len(marked) and marked[i:i + n] in known[n]), 0) for i in range(len(marked)))
        return sum(log(lang, n, marked[i:i + n]) for i, n in enumerate(longest) if n) / len(marked)

    found = []
    for text in texts:
        words = words_in(text)
        sums = [round(sum(of_word(lang, w) for w in words), 6) for lang in langs]
        best = max(range(len(langs)), key=sums.__getitem__, default=None)  # the first of equal ones
        found.append((langs[best], 1 / sum(math.exp(min(s - sums[best], 0)) for s in sums)) if words and langs else ("und", 0.0))
    return found


def words_in(text):
    return re.findall(r"[^\W\d_]+", (text or "").lower())


def same(found, wanted):
    assert len(found) == len(wanted)
    for (lang, score), (lang2, score2) in zip(found, wanted, strict=True):
        assert lang == lang2 and abs(score - score2) < 1e-4


def predicted(df, model):
    return [(r["lang_pred"], r["score"]) for r in langid.predict(df, model).orderBy("doc_id").collect()]


def test_words_first_then_shorter_grams(spark):
    rows = [("the cat the cat the", "en"), ("le chat le chat le", "fr"), (None, "fr"), ("x", None), ("", "de")]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"), max_words=2)
    assert set(model.words) == {"the", "cat", "le", "chat"} and model.langs == ["en", "fr"]
    texts = ["cats", "chats", "123 !", "the", "Le", "qqq", "thé the catch", "x" * 5_000]
    found = predicted(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model)
    assert [lang for lang, _ in found[:3]] == ["en", "fr", "und"]
    same(found, plain_scores(rows, texts))


def test_scores_by_brute_force(docs, edge, spark):
    """All documents, trained on half of them: each other's words are never counted."""
    rows = docs.select("doc_id", "text", "lang").unionByName(edge.select("doc_id", "text", "lang").filter("doc_id IS NOT NULL AND doc_id NOT IN (907, 910)")).orderBy("doc_id").collect()
    taught = [(r["text"], r["lang"]) for r in rows if r["doc_id"] % 2]
    wanted = plain_scores(taught, [r["text"] for r in rows])
    labelled = spark.createDataFrame(taught, "text string, lang string")
    df = spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows], "doc_id long, text string")
    for limits in ({}, {"max_words": 30}, {"cells": 0}):
        model = langid.train(labelled, **limits)
        assert limits.get("cells") != 0 or not model.words
        same(predicted(df, model), wanted)


def test_head_is_bounded(docs):
    model = langid.train(docs, max_words=50)
    assert len(model.words) <= 50 * len(model.langs)
    model = langid.train(docs, cells=1_000)
    assert 0 < model.gains.size <= 1_000


def test_ties_and_many_languages(spark):
    """300 languages, each with a word of its own; a word that all share and
    one that none has go to the first."""
    name = "".join
    rows = [(f"same {name(chr(97 + int(d)) for d in str(1000 + k))}", f"l{k:03}") for k in range(300)]
    texts = [rows[k][0] for k in (0, 7, 255, 256, 299)] + ["same", "same same", "日本"]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"))
    assert len(model.langs) == 300
    found = predicted(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model)
    assert [lang for lang, _ in found] == ["l000", "l007", "l255", "l256", "l299", "l000", "l000", "l000"]
    same(found, plain_scores(rows, texts))
