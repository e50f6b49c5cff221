import duckdb

from tests.conftest import SF001
from tests.llm.conftest import pairs, words
from tidewater.llm import quality
from tidewater.llm.queries import QUERIES, SQL


def base(text):
    w, t = words(text), text or ""
    repeats = {}
    for k in range(len(w) - 4):
        repeats.setdefault(tuple(w[k:k + 5]), []).append(k)
    covered = {k + i for places in repeats.values() if len(places) > 1 for k in places for i in range(5)}
    lines = [x for x in t.split("\n") if words(x)]
    n = len(w)
    return (n, sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


def test_base_by_brute_force(edge, docs):
    both = docs.select("doc_id", "text").unionByName(edge.select("doc_id", "text"))
    found = quality.clean(both).collect()
    got = sorted((str(r["doc_id"]), r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in found)
    assert got == sorted((str(d), *base(t)) for d, t in pairs(both))
    assert not any(r["kept"] and r["base_failed"] for r in found)


def test_sql_agrees(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF001}/documents.parquet')")
    found = QUERIES["op10_line_first_quality"](spark, SF001)
    res = con.execute(SQL["op10_line_first_quality"])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(found.columns)
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(res.fetchall())


LINES = {"A whole sentence stands here.": "", "Is it a question?": "", "\"Quoted speech,\" they said.\"": "", "no end at all": "punctuation",
         "a long line without any end but with more than ten words in it": "", "Home": "punctuation navigation", "Home | About | Contact": "punctuation navigation",
         "Buy### now*** the$$$ thing.": "punctuation", "GO!! NOW!! BUY!!": "punctuation", "We use cookies on this site.": "boilerplate", "© 2020 Someone.": "boilerplate"}


def test_rules_of_lines(spark):
    df = spark.createDataFrame([(k, line) for k, line in enumerate(LINES)], "doc_id long, text string")
    rows = df.select("text", quality.judged_lines(df["text"])[0].alias("x")).collect()
    for r in rows:
        assert " ".join(k for k in ("punctuation", "navigation", "boilerplate") if r["x"]["rules"][k]) == LINES[r["text"]], r["text"]


def test_cleaning_and_clean_documents(spark, edge, none):
    good = "The first line is a sentence.\n  Home | About | Contact\n\nThe last line is a sentence, too."
    bad = "Home | About | Contact\nNews | Sport | More | Less | Other | Things\nOne line is fine."
    rows = {r["doc_id"]: r for r in quality.clean(spark.createDataFrame([(1, good), (2, bad)], "doc_id long, text string")).collect()}
    assert rows[1]["kept"] and rows[1]["cleaned_text"] == "The first line is a sentence.\nThe last line is a sentence, too."
    assert not rows[2]["kept"] and not rows[2]["base_failed"] and rows[2]["n_lines_removed"] == 2
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    found = QUERIES["op10_line_first_quality"](spark, SF001).join(labels, "doc_id").filter("NOT base_failed")
    assert found.filter("quality = 1 AND NOT kept").count() == 0
    assert found.filter("quality = 0 AND kept").count() <= 0.1 * found.filter("quality = 0").count()
    assert quality.clean(none).count() == 0
    wide = quality.clean(edge)
    assert wide.filter("text IS NULL AND (kept OR n_words > 0)").count() == 0 and wide.count() == edge.count()


def test_clashing_names(spark):
    text = "This line has some more than ten words and a full stop at its end."
    rows = spark.createDataFrame([(1, text, "a", 5, "x", "mine"), (2, None, None, None, None, "too")],
                                 "doc_id long, text string, _w string, n_words int, cleaned_text string, source string")
    plain = quality.clean(rows.select("doc_id", "text", "source")).collect()
    found = quality.clean(rows)
    assert "_w" not in found.columns and found.columns.count("n_words") == 1
    assert sorted(sorted(r.asDict().items(), key=lambda x: x[0]) for r in found.collect()) == sorted(sorted(r.asDict().items(), key=lambda x: x[0]) for r in plain)
