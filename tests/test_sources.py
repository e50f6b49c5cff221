import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tidewater.operators import knn as K
from tidewater.sources import readers as R
from tidewater.sources import sinks as S


def _write(path, text):
    path.write_text(text)
    return str(path)


def test_adjacency_and_edges(spark, tmp_path):
    p = _write(tmp_path / "adj.txt", "1: 2 3 4\n2:\n3\n4:   1\n")
    adj = R.read_adjacency(spark, p)
    got = {r.user_id: list(r.follows) for r in adj.collect()}
    assert got == {1: [2, 3, 4], 2: [], 3: [], 4: [1]}
    assert rows(R.adjacency_edges(adj)) == [(1, 2), (1, 3), (1, 4), (4, 1)]


def test_edge_ids(spark, tmp_path):
    p = _write(tmp_path / "e.txt", "1 2\n3   4\n 5 6 \n")
    assert rows(R.read_edge_ids(spark, p)) == [(i,) for i in range(1, 7)]


def test_embeddings_keep_words_literally(spark, tmp_path):
    p = _write(tmp_path / "g.txt", "null 0.5 1.0\nNaN -1 2\nthe 0 0\n")
    got = {r.word: list(r.vec) for r in R.read_embeddings(spark, p, dim=2).collect()}
    assert got == {"null": [0.5, 1.0], "NaN": [-1.0, 2.0], "the": [0.0, 0.0]}


def test_query_points_words_labels(spark, tmp_path):
    pts = R.read_query_points(spark, _write(tmp_path / "q.txt", "51.5 -0.1\n40.7 -74.0\n"))
    assert sorted((r.lat, r.lon) for r in pts.collect()) == [(40.7, -74.0), (51.5, -0.1)]
    assert rows(R.read_words(spark, _write(tmp_path / "w.txt", "king\n\nqueen\n"))) == [("king",), ("queen",)]
    assert len(R.read_labels(spark, _write(tmp_path / "l.txt", "a\nb\n")).collect()) == 2


def test_csv_readers(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType())])
    p = _write(tmp_path / "t.csv", "a,b\n1,2.5\n3,4.0\n")
    assert rows(R.read_table(spark, p, schema)) == [(1, 2.5), (3, 4.0)]
    p2 = _write(tmp_path / "skip.csv", "junk line;with;semicolons\na,b\n1,2.5\n3,4.0\n")
    assert rows(R.read_csv_skip(spark, p2, schema)) == [(1, 2.5), (3, 4.0)]
    p3 = _write(tmp_path / "t.tsv", "1/0/-1\thello\n-1\tworld\n")
    assert rows(R.read_tsv(spark, p3, ["label", "text"])) == [("-1", "world"), ("1/0/-1", "hello")]


def test_tree_and_labelled_dir(spark, tmp_path):
    for cls, n in (("cats", 2), ("dogs", 1)):
        (tmp_path / "img" / cls).mkdir(parents=True)
        for i in range(n):
            (tmp_path / "img" / cls / f"{i}.bin").write_bytes(b"x" * (i + 1))
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "a.c").write_text("int x;\n")
    (tmp_path / "src" / "b.H").write_text("#define Y\n")
    files = R.read_tree(spark, str(tmp_path / "src"), "*.h", case_insensitive=True)
    assert [r.ext for r in files.collect()] == ["H"]  # as it is written
    assert R.read_tree(spark, str(tmp_path / "src"), "*.h").count() == 0
    lab = R.read_labelled_dir(spark, str(tmp_path / "img"))
    assert rows(R.class_counts(lab)) == [("cats", 2), ("dogs", 1)]


def test_sinks_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    S.write_csv(df, str(tmp_path / "out_csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out_csv"))
    assert sorted(r.k for r in back.collect()) == ["1", "2"]
    S.write_text(df, str(tmp_path / "out_txt"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out_txt")).collect()) == ["1\ta", "2\t"]
    rep = S.as_report(spark.createDataFrame([(3, 1.5)], "n int, avg double"))
    assert rows(rep) == [("avg", "1.5"), ("n", "3")]


def test_numbers_do_not_depend_on_splits(spark, tmp_path):
    n, before = 4_000, spark.conf.get("spark.sql.files.maxPartitionBytes")
    vectors = _write(tmp_path / "v.txt", "".join(f"w{i} {i} {-i}\n" for i in range(n)))
    labels = _write(tmp_path / "l.txt", "".join(f"w{i}\n" for i in range(n)))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
        many = R.read_embeddings(spark, vectors, 2)
        assert many.rdd.getNumPartitions() > 4
        assert K.check_labels(many.select(F.col("id").alias("q_id"), F.col("word").alias("found")), R.read_labels(spark, labels)).first() == (n, 0)
        assert sorted(r.id for r in many.collect()) == list(range(n))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    folder = tmp_path / "many"
    folder.mkdir()
    for k in range(3):
        _write(folder / f"{k}.txt", "".join(f"{k}.5 {i}\n" for i in range(5)))
    pts = sorted((r.q_id, r.lat, r.lon) for r in R.read_query_points(spark, str(folder)).collect())
    assert pts == [(5 * k + i, k + 0.5, float(i)) for k in range(3) for i in range(5)]


def test_lines_that_do_not_parse(spark, tmp_path):
    p = _write(tmp_path / "adj.txt", "1: 2 x\n\n   \nno: 5\n")
    assert [(r.user_id, list(r.follows)) for r in R.read_adjacency(spark, p).collect()] == [(1, [2, None]), (None, [5])]
    bad = _write(tmp_path / "e.txt", "w 1 2\nv 1\n")
    with pytest.raises(Exception, match="not 2 numbers"):
        R.read_embeddings(spark, bad, 2).collect()


def test_csv_with_quotes_and_junk_of_the_same_width(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    p = _write(tmp_path / "skip.csv", 'junk,with a comma\na,b\n1,x\n2,"y,z"\n3,"say ""hi"""\n\n4\n')
    assert rows(R.read_csv_skip(spark, p, schema)) == [(1, "x"), (2, "y,z"), (3, 'say "hi"'), (4, None)]
    assert rows(R.read_csv_skip(spark, _write(tmp_path / "two.csv", "j,k\n1,k\na,b\n5,e\n"), schema, skip=2)) == [(5, "e")]


def test_either_case_globs():
    assert R.either_case("*.h") == "*.[hH]" and R.either_case("a?[bC].*") == "[aA]?[bC].*"
