import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewater.operators import annotate as AN
from tidewater.operators import textfeat as TF
from tidewater.operators import triples as TR


def _triples(spark):
    people = spark.createDataFrame([("t1", "TA Ann", "1"), ("t2", "Teacher Bo", "2"), ("t3", "TA Cy", "3")],
                                   "ind string, name string, tid string")
    hours = spark.createDataFrame([("h1", "1", "c1", 130.0), ("h2", "2", "c1", 100.0), ("h3", "3", "c2", 150.0)],
                                  "ind string, teacher string, inst string, hrs double")
    return TR.union_triples([
        TR.to_triples(people, TR.SheetRule("ind", "Teacher", {"teacherName": ("name", "string"),
                                                              "teacherID": ("tid", "string")})),
        TR.to_triples(hours, TR.SheetRule("ind", "TeachingAssignment", {
            "hoursTeacher": ("teacher", "string"), "hoursCourseInstance": ("inst", "string"),
            "aHours": ("hrs", "float")})),
    ])


def test_bgp_filters_and_distinct(spark):
    tr = _triples(spark)
    b = TR.match_bgp(tr, [("?t", "teacherID", "?id"), ("?t", "teacherName", "?n"),
                          ("?h", "hoursTeacher", "?id"), ("?h", "hoursCourseInstance", "c1"),
                          ("?h", "aHours", "?hrs")],
                     filters=[F.col("hrs").cast("double") > 120, TR.regex_filter("n", "ta.*", "i")],
                     select=["t", "n"], distinct=True)
    assert rows(b) == [("t1", "TA Ann")]


def test_disconnected_pattern_refused(spark):
    with pytest.raises(ValueError):
        TR.match_bgp(_triples(spark), [("?a", "teacherName", "?x"), ("?b", "aHours", "?y")])


def test_not_exists_and_counts(spark):
    tr = _triples(spark)
    c1 = TR.match_bgp(tr, [("?h", "hoursTeacher", "?id"), ("?h", "hoursCourseInstance", "c1")], select=["id"])
    c2 = TR.match_bgp(tr, [("?h", "hoursTeacher", "?id"), ("?h", "hoursCourseInstance", "c2")], select=["id"])
    assert rows(TR.not_exists(c1, c2, ["id"])) == [("1",), ("2",)]
    assert TR.count_bindings(c1, "n").first().n == 2


VOTES = [(1, "1/1/0"), (2, "1/0/-1"), (3, "-1"), (4, "0/-1/-1"), (5, "0/1/1"), (6, "")]


def test_merge_votes_rules(spark):
    df = spark.createDataFrame(VOTES, "doc_id bigint, votes string")
    got = dict(rows(AN.merge_votes(df), "doc_id", "label"))
    assert got == {1: 1, 2: -1, 3: -1, 4: 0, 5: 1, 6: -1}
    pick1 = dict(rows(AN.merge_votes(df, tie="pick", seed=3), "doc_id", "label"))
    pick2 = dict(rows(AN.merge_votes(df, tie="pick", seed=3), "doc_id", "label"))
    assert pick1 == pick2 and pick1[2] in (0, 1) and pick1[1] == 1 and pick1[3] == -1


def test_vote_statistics(spark):
    df = spark.createDataFrame(VOTES, "doc_id bigint, votes string")
    assert AN.count_disagreements(df).first().n_disagree == 3
    a = AN.agreement(df).first()
    assert a.n_agree == 1 and abs(a.agreement_rate - round(1 / 6, 4)) < 1e-12
    p = AN.vote_pattern_counts(spark.createDataFrame([("-1",), ("-1/1",), ("1/-1",)], "votes string")).first()
    assert (p.n_only_undecided, p.n_undecided_then_vote) == (1, 1)


def test_dedup_first_and_dropped(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b"), (5, "a")], "doc_id bigint, text string")
    assert rows(AN.dedup_first(df), "doc_id") == [(1,), (2,)]
    assert rows(AN.dropped_duplicates(df)) == [(3, 1), (5, 1)]
    dist = rows(AN.distribution(df, "text"))
    assert dist == [("a", 3, 75.0), ("b", 1, 25.0)]


def test_tfidf_matches_formula(spark):
    docs = spark.createDataFrame([(1, "Apple banana apple"), (2, "banana cherry"), (3, "x")],
                                 "doc_id bigint, text string")
    w = {(r.doc_id, r.term): r.tfidf for r in TF.tfidf(docs, None).collect()}
    n = 3
    idf = {t: math.log((1 + n) / (1 + df)) + 1 for t, df in {"apple": 1, "banana": 2, "cherry": 1}.items()}
    v1 = {"apple": 2 * idf["apple"], "banana": idf["banana"]}
    norm = math.sqrt(sum(x * x for x in v1.values()))
    assert abs(w[(1, "apple")] - round(v1["apple"] / norm, 6)) < 1e-9
    assert (3, "x") not in w  # single characters are not tokens
    bi = {r.term for r in TF.term_counts(docs, ngram_max=2).collect()}
    assert "apple banana" in bi and "banana apple" in bi
    top = TF.top_terms(TF.tfidf(docs, 2), 1).collect()
    assert all(r["rank"] == 1 for r in top)


def test_stars_equal_pattern_joins(spark, monkeypatch):
    """Random patterns over random triples, with values of several, repeated
    triples, and a predicate of too many values for the property table."""
    import random
    monkeypatch.setattr(TR, "MAX_VALUES", 4)
    rng = random.Random(6)
    data = [(f"s{rng.randrange(12)}", f"p{rng.randrange(4)}", rng.choice([f"s{rng.randrange(12)}", f"o{rng.randrange(5)}"]), "iri") for _ in range(120)]
    data += [("s1", "hub", f"s{i}", "iri") for i in range(12)] + data[:5]
    triples = spark.createDataFrame(data, "s string, p string, o string, dtype string")
    store = TR.build_store(triples, lambda df, name: df)
    assert "hub" not in store.columns and store.counts["hub"] == 12
    cases = [[("?x", "p0", "?a"), ("?x", "p1", "?b")], [("?x", "p0", "?y"), ("?y", "p1", "?z"), ("?x", "p2", "o1")], [("?x", "p0", "?a"), ("?x", "p1", "?a")],
             [("?x", "p0", "?x")], [("?h", "hub", "?x"), ("?x", "p3", "?a"), ("?x", "p3", "?b")], [("s1", "p0", "?x"), ("?x", "?p", "?a")], [("?x", "p0", "o1"), ("?x", "p0", "?a")],
             [("?x", "absent", "?a"), ("?x", "p0", "?b")]]
    for patterns in cases:
        want = TR.match_bgp(triples.distinct(), patterns)
        got = TR.match_stars(store, patterns).select(*want.columns)
        assert rows(got) == rows(want), patterns
    with pytest.raises(ValueError, match="cross product"):
        TR.match_stars(store, [("?x", "p0", "?a"), ("?y", "p1", "?b")])
    empty = TR.build_store(triples.limit(0), lambda df, name: df)
    assert empty.columns == {} and TR.match_stars(empty, [("?x", "p0", "?a"), ("?x", "p1", "?b")]).count() == 0


def test_store_follows_its_patterns(spark, tmp_path):
    """Only the patterns' predicates are counted and get a column, the triples
    are written without an exchange, and constants are asked for before it."""
    data = [("a", "x", "1", "iri"), ("a", "x", "1", "iri"), ("a", "x", "2", "iri"), ("b", "x", "1", "iri"), ("a", "y", "5", "iri"), ("b", "y", "6", "iri"), (None, "x", "1", "iri"), ("c", "z", "9", "iri")]
    triples = spark.createDataFrame(data, "s string, p string, o string, dtype string")
    written = {}
    store = TR.build_store(triples, lambda df, name: written.setdefault(name, df), ["x", "y", "none"])
    assert [*written] == ["counts"] and rows(written["counts"], "p", "n", "most") == [("x", 5, 3), ("y", 2, 1)]
    assert sorted(store.columns) == ["x", "y"] and store.counts == {"x": 5, "y": 2}
    assert rows(TR.match_stars(store, [("?s", "x", "1"), ("?s", "y", "?v")]).select("s", "v")) == [("a", "5"), ("b", "6")]
    assert rows(TR.match_stars(store, [("?s", "x", "1"), ("?s", "x", "?v"), ("?s", "y", "5")]).select("s", "v")) == [("a", "1"), ("a", "2")]
    assert TR.match_stars(store, [("?s", "x", "1"), ("?s", "y", "5"), ("?s", "y", "6")]).count() == 0
    assert sorted((r["s"] or "", sorted(r["v"])) for r in TR.property_table(triples, {"x": "v"}).collect()) == [("", ["1"]), ("a", ["1", "2"]), ("b", ["1"])]


def test_stars_are_reduced_before_their_exchange(spark):
    """subjects without the constants, or that few bindings can't join, are
    left out before the arrays are made; the bindings stay, null subjects too."""
    data = [(f"h{i}", "inst", f"I{i % 50}", "iri") for i in range(400)] + [(f"h{i}", "hrs", str(i), "float") for i in range(400)]
    data += [(f"c{i}", "id", f"I{i}", "iri") for i in range(50)] + [(f"c{i}", "code", str(i % 25), "iri") for i in range(50)]
    data += [(None, "id", "I9", "iri"), (None, "code", "7", "iri")]
    triples = spark.createDataFrame(data, "s string, p string, o string, dtype string")
    store = TR.build_store(triples, lambda df, name: df, ["inst", "hrs", "id", "code"])
    patterns = [("?h", "inst", "?ci"), ("?h", "hrs", "?n"), ("?c", "id", "?ci"), ("?c", "code", "7")]
    found = TR.match_stars(store, patterns, select=["h", "n", "ci"])
    assert rows(found) == sorted((f"h{i}", str(i), f"I{i % 50}") for i in range(400) if i % 50 in (7, 9, 32))
    assert "Join LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()
    assert rows(TR.match_stars(store, patterns[2:], select=["c"])) == [("c32",), ("c7",), (None,)]
    assert rows(TR.predicate_counts(triples, ["code", "hrs"]), "p", "n", "most") == [("code", 51, 1), ("hrs", 400, 1)]
    # a subject has one row in the exchange, whatever its predicates
    plan = TR.predicate_counts(triples, ["code", "hrs"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(p#" not in plan


def test_instance_sheets_share_the_offer_as_key(spark, tmp_path):
    """The course sheets are aggregated and attached by part and quarter,
    nulls as well, with no exchange by the instance's name."""
    import datetime
    from tidewater.plans.fixtures import university_triples
    from tidewater.sources.tables import SCHEMAS, Tables
    for name, schema in SCHEMAS.items():
        lines = []
        if name == "lineitem":
            lines = [(1, part, supp, 1, 2.0, 1.0, 0.0, 0.0, "N", "O", day) for part, day in ((5, datetime.datetime(1996, 2, 1)), (None, datetime.datetime(1996, 2, 1)), (5, None)) for supp in (3, 4, 4)]
        spark.createDataFrame(lines, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    triples = university_triples(Tables(spark, str(tmp_path)))
    plan = triples._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter, (offer#" in plan
    found = rows(triples.filter("p IN ('planNumStudents', 'seniorHours', 'assistHours')"), "s", "p", "o")
    assert found == sorted((f"I-{x}", p, o) for x in ("5-1996-1", "1996-1", "5") for p, o in (("assistHours", "12.0"), ("planNumStudents", "3"), ("seniorHours", "6.0")))
    assert rows(triples.filter("p = 'rHours'"), "s", "o") == sorted((f"H-{x}", o) for x, o in (("5-1996-1-3", "6.0"), ("5-1996-1-4", "12.0"), ("1996-1-3", "6.0"), ("1996-1-4", "12.0"), ("5-3", "6.0"), ("5-4", "12.0")))


def test_stars_need_few_joins(spark):
    """Four subjects, three joins, instead of one for each further pattern."""
    from tests.conftest import SF001
    from tidewater.plans.triples import sparql_ta_in_division
    plan = sparql_ta_in_division(spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") <= 4


def test_attach_by_position_with_unequal_splits(spark, tmp_path):
    """Rows of two sheets meet by their place, whatever the files and their splits."""
    from tidewater.sources.readers import number_lines
    n = 1_000
    for name, cuts in (("a", (0, 1, 700, n)), ("b", (0, 333, 333, 900, n - 7))):
        for k, (i, j) in enumerate(zip(cuts, cuts[1:])):
            (tmp_path / name).mkdir(exist_ok=True)
            (tmp_path / name / f"part-{k}.txt").write_text("".join(f"{name}{r}\n" for r in range(i, j)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        a, b = (number_lines(spark, str(tmp_path / name)).select("line_no", F.col("value").alias(name)) for name in "ab")
        found = sorted(tuple(r) for r in TR.attach_by_position(a, b).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == [(i, f"a{i}", f"b{i}" if i < n - 7 else None) for i in range(n)]


def test_sheets_are_cut_by_the_partitions(spark, tmp_path, monkeypatch):
    """No fixed number of files: what a task sorts doesn't grow with the data alone."""
    from tests.conftest import SF001
    from tidewater.plans import triples as plans
    monkeypatch.setattr(plans, "shared_path", lambda spark, name: str(tmp_path / "sheets"))
    assert plans.sheet_attach_by_position(spark, SF001).count() > 100
    files = [len([*(tmp_path / "sheets" / name).glob("part-*")]) for name in ("instances", "plannings")]
    assert files[0] > files[1] > int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_top_terms_of_words_and_pairs_against_plain_counts(spark):
    """The most frequent words and pairs, ties by term, though pairs of rarer words aren't counted."""
    from collections import Counter
    texts = ["aa bb aa bb cc", "bb aa dd, ee ff", "", None, "aa", "ee ff ee ff ee ff gg", "hh aa bb"]
    toks = TF.token_arrays(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    times = Counter()
    for t in texts:
        w = (t or "").replace(",", "").split()
        times.update(w + [f"{a} {b}" for a, b in zip(w, w[1:])])
    order = [t for t, _ in sorted(times.items(), key=lambda x: (-x[1], x[0]))]
    for k in (1, 3, 4, 6, len(order), 100):
        assert sorted(r[0] for r in TF._top_terms_of(toks, k, 2).collect()) == sorted(order[:k])
    tf = {(r["doc_id"], r["term"]): r["tf"] for r in TF._vocab_tf(toks, TF._top_terms_of(toks, None, 2), None, 2).collect()}
    assert sum(tf.values()) == sum(times.values()) and tf[5, "ee ff"] == 3
