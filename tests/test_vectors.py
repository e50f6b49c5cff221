import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidewater.operators import knn as K
from tidewater.operators import lsh as LSH


def _data(spark, n=300, d=8, seed=3):
    rs = np.random.RandomState(seed)
    X = rs.normal(size=(n, d))
    df = spark.createDataFrame([(i, X[i].tolist()) for i in range(n)], "id bigint, vec array<double>")
    return X, df


def test_knn_euclidean_matches_brute_force(spark):
    X, df = _data(spark)
    Q = X[[0, 5, 17]] + 0.01
    qdf = spark.createDataFrame([(i, Q[i].tolist()) for i in range(3)], "q_id bigint, vec array<double>")
    for metric in ("euclidean", "euclidean_expanded"):
        got = {(r.q_id, r.rank): r.id for r in K.knn(df, qdf, 3, metric).collect()}
        for qi in range(3):
            d = np.sqrt(((X - Q[qi]) ** 2).sum(axis=1))
            order = np.lexsort((np.arange(len(X)), d))[:3]
            assert [got[(qi, k + 1)] for k in range(3)] == order.tolist()


def test_knn_ties_go_to_smaller_id(spark):
    df = spark.createDataFrame([(5, [1.0, 0.0]), (2, [1.0, 0.0]), (9, [3.0, 0.0])], "id bigint, vec array<double>")
    q = spark.createDataFrame([(0, [0.0, 0.0])], "q_id bigint, vec array<double>")
    assert [r.id for r in K.knn(df, q, 2, "euclidean").orderBy("rank").collect()] == [2, 5]


def test_cosine_excludes_self_and_zero_vector(spark):
    X, df = _data(spark, n=100)
    df = df.unionByName(spark.createDataFrame([(1000, [0.0] * 8)], "id bigint, vec array<double>"))
    unit = K.l2_normalize(df, "vec", "unit")
    assert unit.filter("id = 1000").first().unit is None  # D8
    q = unit.filter("id = 7").select(F.col("id").alias("q_id"), "unit", F.col("id").alias("self"))
    res = K.knn(unit.filter("unit IS NOT NULL"), q, 3, "cosine", vec_col="unit", q_vec="unit", exclude_col="self")
    ids = [r.id for r in res.orderBy("rank").collect()]
    U = X / np.linalg.norm(X, axis=1, keepdims=True)
    sims = U @ U[7]
    sims[7] = -np.inf
    assert ids == np.argsort(-sims, kind="stable")[:3].tolist()


def test_haversine(spark):
    r = lambda *a: [float(np.radians(x)) for x in a]
    pts = spark.createDataFrame([(1, r(51.5, -0.12)), (2, r(48.85, 2.35))], "id bigint, vec array<double>")
    q = spark.createDataFrame([(0, r(50.0, 1.8))], "q_id bigint, vec array<double>")
    assert K.knn(pts, q, 1, "haversine").first().id == 2


def test_centroids(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (0, [3.0, 4.0]), (1, [5.0, 5.0])], "label int, vec array<double>")
    got = {r.label: list(r.vec) for r in K.centroids(df, "label", "vec").collect()}
    assert got == {0: [2.0, 3.0], 1: [5.0, 5.0]}


def test_lsh_similarities_exact_and_recall_monotone(spark):
    X, df = _data(spark, n=400, d=16, seed=9)
    unit = K.l2_normalize(df, "vec", "unit")
    q = unit.filter("id IN (3, 40)").select(F.col("id").alias("q_id"), "vec", "unit", F.col("id").alias("self"))
    exact = {(r.q_id, r.id): -r.d for r in K.knn(unit, q, 400, "cosine", vec_col="unit", q_vec="unit",
                                                 exclude_col="self").collect()}
    found_prev = 0
    for tables in (2, 4, 8):
        planes, pos = LSH.lsh_params(16, n_planes=12, n_tables=8, seed=1)
        pos = pos[:tables, :4]
        res = LSH.topk_lsh(unit, q, 400, planes, pos, exclude_col="self").collect()
        for r in res:
            assert abs(r.sim - exact[(r.q_id, r.id)]) < 1e-9
        assert len(res) >= found_prev  # more tables never lose candidates
        found_prev = len(res)


def test_geo_grid_exact_under_skew(spark):
    from tidewater.operators.geogrid import nn_grid
    rs = np.random.RandomState(11)
    n = 1500
    lat = np.concatenate([rs.uniform(-89, 89, n - 500), 10 + rs.uniform(0, 0.01, 500)])  # a third in one cell
    lon = np.concatenate([rs.uniform(-180, 180, n - 500), 20 + rs.uniform(0, 0.01, 500)])
    pts = spark.createDataFrame([(i, float(lat[i]), float(lon[i])) for i in range(n)], "id bigint, lat double, lon double")
    qlat = np.concatenate([rs.uniform(-90, 90, 150), [89.9, -89.9, 10.005, 0.0]])
    qlon = np.concatenate([rs.uniform(-180, 180, 150), [0.0, 179.9, 20.005, -179.99]])
    qs = spark.createDataFrame([(i, float(qlat[i]), float(qlon[i])) for i in range(len(qlat))],
                               "q_id bigint, lat double, lon double")
    want = sorted((r.q_id, r.id) for r in K.knn(
        pts.select("id", F.array(F.radians("lat"), F.radians("lon")).alias("vec")),
        qs.select("q_id", F.array(F.radians("lat"), F.radians("lon")).alias("vec")), 2, "haversine").collect())
    got = sorted((r.q_id, r.id) for r in nn_grid(pts, qs, 2, cell_deg=5.0, max_points=40, max_queries=7).collect())
    assert got == want


def test_query_sets_of_any_size(spark):
    X, df = _data(spark, n=40, d=3, seed=4)
    rs = np.random.RandomState(8)
    many = spark.range(200_001).select(F.col("id").alias("q_id"), F.array(*[(F.col("id") % (7 + j)).cast("double") / 5 for j in range(3)]).alias("vec"))
    got = K.knn(df, many, 1, "euclidean")
    assert got.count() == 200_001
    some = rs.randint(0, 200_001, 20).tolist()
    found = {r.q_id: r.id for r in got.filter(F.col("q_id").isin(some)).collect()}
    for q in some:
        v = np.array([(q % (7 + j)) / 5 for j in range(3)])
        d = np.sqrt(((X - v) ** 2).sum(axis=1))
        assert found[q] == int(np.argmin(d))
    unit = K.l2_normalize(df, "vec", "unit")
    queries = K.l2_normalize(spark.range(25_001).select(F.col("id").alias("q_id"), F.array(*[((F.col("id") % (5 + j)) - 2).cast("double") for j in range(3)]).alias("vec")),
                             "vec", "unit")
    planes, pos = LSH.lsh_params(3, n_planes=4, n_tables=2, seed=1)
    assert LSH.topk_lsh(unit, queries, 1, planes, pos[:, :1]).select("q_id").distinct().count() > 20_000


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_probed_recall_and_candidates(spark, sf):
    """Recall at 3 against brute force, with few candidates, at two sizes."""
    t = pq.read_table(f"/root/testdata/sf{sf}/embeddings.parquet")
    X, ids = np.stack(t.column("embedding").to_numpy()).astype(float), t.column("vec_id").to_numpy()
    U = X / np.linalg.norm(X, axis=1, keepdims=True)
    own = np.flatnonzero(ids % 20 == 0)
    sims = U[own] @ U.T
    sims[np.arange(len(own)), own] = -9
    planes, n = LSH.superbit_planes(X.shape[1]), LSH.probe_rows(len(X))
    code = U @ planes.T >= 0
    far = (code[own][:, None, :] != code[None]).sum(2)
    far[np.arange(len(own)), own] = 9_999
    radius = np.sort(far, axis=1)[:, n - 1]
    assert (far <= radius[:, None]).mean() < 0.05
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, X)], "id bigint, vec array<double>").repartition(5)
    unit = K.l2_normalize(df)
    q = unit.filter("id % 20 = 0").select(F.col("id").alias("q_id"), "unit", F.col("id").alias("self"))
    found = {(r["q_id"], r["rank"]): r["id"] for r in LSH.topk_probed(unit, q, 3, planes, n, exclude_col="self", query_block=7).collect()}
    best = {(int(ids[o]), k + 1): int(ids[j]) for o, row in zip(own, np.argsort(-sims, axis=1)[:, :3]) for k, j in enumerate(row)}
    recall = len({(a, b) for (a, _), b in found.items()} & {(a, b) for (a, _), b in best.items()}) / len(best)
    assert recall >= 0.95
    balls = {(int(ids[o]), int(ids[j])) for o, row, r in zip(own, far, radius) for j in np.flatnonzero(row <= r)}
    assert {(a, b) for (a, _), b in found.items()} <= balls


def test_probed_edges(spark):
    """Ties, repeated rows, null and zero vectors, fewer rows than a ball holds, no rows."""
    rows = [(1, [1.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, [0.0, 0.0, 0.0]), (4, None), (5, [-1.0, 0.0, 0.0])]
    df = K.l2_normalize(spark.createDataFrame(rows, "id bigint, vec array<double>"))
    q = df.select(F.col("id").alias("q_id"), "unit", F.col("id").alias("self")).dropDuplicates(["q_id"])
    planes = LSH.superbit_planes(3, 24)
    got = sorted((r["q_id"], r["rank"], r["id"]) for r in LSH.topk_probed(df, q, 2, planes, 16, exclude_col="self").collect())
    assert got == [(1, 1, 2), (1, 2, 2), (2, 1, 1), (2, 2, 5), (5, 1, 1), (5, 2, 2)]
    assert LSH.topk_probed(df.limit(0), q, 2, planes, 16).count() == 0 and LSH.topk_probed(df, q.limit(0), 2, planes, 16).count() == 0


def test_superbits_are_orthogonal_in_blocks():
    planes = LSH.superbit_planes(8, 20)
    assert planes.shape == (20, 8) and np.allclose(planes[:8] @ planes[:8].T, np.eye(8), atol=1e-8) and np.allclose(planes[16:] @ planes[16:].T, np.eye(4), atol=1e-8)
    assert [LSH.probe_rows(n) for n in (0, 100, 400, 10_000, 10**12)] == [16, 16, 20, 100, 10**6]


def test_buckets_grow_with_the_table(spark, tmp_path):
    """A bucket has as many bits as the logarithm of the rows, at its table's places of the signature."""
    from tidewater.plans.vectors import ORDERS, vec_lsh_buckets
    assert [LSH.lsh_bits(n) for n in (0, 1, 256, 257, 10**9, 10**12)] == [8, 8, 8, 9, 30, 32]
    X = np.random.default_rng(3).normal(size=(4_100, 64)).astype(np.float32)
    for n, bits in ((300, 9), (4_100, 13)):
        (tmp_path / str(n)).mkdir()
        pq.write_table(pa.table({"vec_id": pa.array(range(n), pa.int64()), "embedding": pa.array(X[:n].tolist(), pa.list_(pa.float32())), "label": pa.array([0] * n, pa.int32())}),
                       tmp_path / str(n) / "embeddings.parquet")
        found = vec_lsh_buckets(spark, str(tmp_path / str(n))).collect()
        assert len(found) == n
        assert all(r["buckets"] == ",".join("".join(r["signature"][i] for i in order[:bits]) for order in ORDERS) for r in found)


def test_nearest_points_compare_neighbouring_cells_only(spark, monkeypatch):
    """The default needs no scan of all pairs, and finds what the scan finds."""
    from tidewater.operators import knn as K
    from tidewater.plans.geo import nn_haversine
    points = spark.range(2000).selectExpr("id", "concat('p', id) AS name", "(id * 37 % 1701) / 10.0D - 85 AS lat", "(id * 991 % 3601) / 10.0D - 180 AS lon")
    queries = spark.range(60).selectExpr("id AS q_id", "(id * 53 % 1601) / 10.0D - 80 AS lat", "(id * 577 % 3601) / 10.0D - 180 AS lon")
    wanted = sorted((r.q_id, r.id, r.name, round(r.d, 9)) for r in nn_haversine(points, queries, method="scan").collect())

    def scan(data, queries, *rest, **more):
        raise AssertionError("all pairs were compared")
    monkeypatch.setattr(K, "knn", scan)
    assert sorted((r.q_id, r.id, r.name, round(r.d, 9)) for r in nn_haversine(points, queries).collect()) == wanted
