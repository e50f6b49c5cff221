import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators import knn as K
from tidewater.operators import pivots as PV


def _clustered(n=3_000, d=16, seed=1):
    rs = np.random.RandomState(seed)
    centres = rs.normal(size=(30, d)) * 6
    return centres[rs.randint(30, size=n)] + rs.normal(size=(n, d)) * 0.4


@pytest.mark.parametrize("clustered", [True, False])
def test_pivots_find_what_the_scan_finds(clustered):
    rs = np.random.RandomState(3)
    X = _clustered() if clustered else rs.normal(size=(800, 16))
    ids = rs.permutation(len(X))
    queries = np.concatenate([X[:40], rs.normal(size=(20, 16)) * 4])
    index, pairs = PV.PivotIndex(X, ids), 0
    for j, q in enumerate(queries):
        for k in (1, 5):
            own = int(ids[j]) if j < 40 and k == 5 else -(2**63)
            d = np.sqrt(((X - q) ** 2).sum(1))
            order = [i for i in np.lexsort((ids, d)) if ids[i] != own][:k]
            got_ids, got_d = index.search(q, k, own)
            assert got_ids.tolist() == ids[order].tolist() and np.allclose(got_d, d[order])
            pairs += len(X)
    if clustered:
        assert index.compared / pairs < 0.3


def test_ties_repeats_and_few_rows(spark):
    """Equal distances go to the smaller id; null vectors match nothing; fewer rows than k; no rows."""
    rows = [(5, [0.0, 0.0]), (3, [0.0, 2.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (9, None)]
    df = spark.createDataFrame(rows, "id bigint, vec array<double>")
    q = spark.createDataFrame([(1, [1.0, 1.0], 5), (2, [0.0, 0.0], 9), (3, None, 0)], "q_id bigint, vec array<double>, own bigint")
    want = [(r.q_id, r.rank, r.id) for r in K.knn(df, q, 3, "euclidean", exclude_col="own").collect()]
    assert sorted((r.q_id, r.rank, r.id) for r in PV.knn_by_pivots(df, q, 3, exclude_col="own").collect()) == sorted(want)
    assert PV.knn_by_pivots(df, q, 9).filter("q_id = 1").count() == 5
    assert PV.knn_by_pivots(df.limit(0), q, 2).count() == 0 and PV.knn_by_pivots(df, q.limit(0), 2).count() == 0


def test_same_over_several_tasks_and_for_cosine(spark):
    X = _clustered(600, 8)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "id bigint, vec array<double>").repartition(7)
    unit = K.l2_normalize(df)
    q = unit.filter("id % 20 = 0").select(F.col("id").alias("q_id"), "unit", F.col("id").alias("own"))
    a = {(r.q_id, r.rank): (r.id, round(-r.d, 9)) for r in K.knn(unit, q, 4, "cosine", vec_col="unit", q_vec="unit", exclude_col="own").collect()}
    b = {(r.q_id, r.rank): (r.id, round(1 - r.d**2 / 2, 9)) for r in PV.knn_by_pivots(unit, q, 4, vec_col="unit", q_vec="unit", exclude_col="own").collect()}
    assert a == b
