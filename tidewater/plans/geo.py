"""K5 geographic nearest neighbour (haversine on the unit sphere)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import knn as K
from tidewater.plans.fixtures import GEO_SQL, geo_points, geo_queries
from tidewater.functions.geo import haversine
from tidewater.operators.geogrid import nn_grid
from tidewater.plans.registry import query
from tidewater.sources.tables import Tables


def nn_haversine(points, queries, k: int = 1, method: str = "grid"):
    """J8 + P11 + J6: nearest point(s) of every query, names attached.

    ``grid`` compares only neighbouring cells, for large sets on both sides;
    ``scan`` reads the points once and the queries block by block (|Q|·|X|
    distances). Both are exact for any number of queries."""
    if method == "grid":
        nn = nn_grid(points, queries, k)
    else:
        data = points.select("id", F.array(F.radians("lat"), F.radians("lon")).alias("vec"))
        qs = queries.select("q_id", F.array(F.radians("lat"), F.radians("lon")).alias("vec"))
        nn = K.knn(data, qs, k, "haversine")
    return nn.join(points.select("id", "name"), "id")


def nn_haversine_checked(points, queries, k: int = 1):
    """J8 with the winning pair's distance recomputed by the JVM column
    function (F10) from the original degrees; neighbours by the grid."""
    nn = nn_grid(points, queries, k)
    return (nn.join(points.select("id", "name", F.col("lat").alias("plat"), F.col("lon").alias("plon")), "id")
              .join(queries.select("q_id", F.col("lat").alias("qlat"), F.col("lon").alias("qlon")), "q_id")
              .withColumn("d_jvm", haversine(F.col("qlat"), F.col("qlon"), F.col("plat"), F.col("plon"))))


@query("geo_nearest", "WITH " + GEO_SQL + """
SELECT q_id, id, name, round(d, 6) AS d FROM (
  SELECT qs.q_id, pts.id, pts.name,
         2 * asin(sqrt(pow(sin((radians(pts.lat) - radians(qs.lat)) / 2), 2)
             + cos(radians(pts.lat)) * cos(radians(qs.lat)) * pow(sin((radians(pts.lon) - radians(qs.lon)) / 2), 2))) AS d,
         row_number() OVER (PARTITION BY qs.q_id ORDER BY 2 * asin(sqrt(pow(sin((radians(pts.lat) - radians(qs.lat)) / 2), 2)
             + cos(radians(pts.lat)) * cos(radians(qs.lat)) * pow(sin((radians(pts.lon) - radians(qs.lon)) / 2), 2))), pts.id) AS rn
  FROM qs, pts) WHERE rn = 1
""")
def geo_nearest(spark, d):
    t = Tables(spark, d)
    r = nn_haversine(geo_points(t), geo_queries(t), 1)
    return r.select("q_id", "id", "name", F.round("d", 6).alias("d")).orderBy("q_id")  # O5


@query("geo_nearest_distance_km", "WITH " + GEO_SQL + """,
nn AS (SELECT * FROM (
  SELECT qs.q_id, pts.id,
         2 * asin(sqrt(pow(sin((radians(pts.lat) - radians(qs.lat)) / 2), 2)
             + cos(radians(pts.lat)) * cos(radians(qs.lat)) * pow(sin((radians(pts.lon) - radians(qs.lon)) / 2), 2))) AS d,
         row_number() OVER (PARTITION BY qs.q_id ORDER BY 2 * asin(sqrt(pow(sin((radians(pts.lat) - radians(qs.lat)) / 2), 2)
             + cos(radians(pts.lat)) * cos(radians(qs.lat)) * pow(sin((radians(pts.lon) - radians(qs.lon)) / 2), 2))), pts.id) AS rn
  FROM qs, pts) WHERE rn = 1)
SELECT q_id, id, round(d * 6371.0, 3) AS km FROM nn
""")
def geo_nearest_distance_km(spark, d):
    t = Tables(spark, d)
    r = nn_haversine_checked(geo_points(t), geo_queries(t), 1)
    return r.select("q_id", "id", F.round(F.col("d_jvm") * 6371.0, 3).alias("km"))


@query("geo_nearest_grid", "WITH " + GEO_SQL + """
SELECT q_id, id, name, round(d, 6) AS d FROM (
  SELECT qs.q_id, pts.id, pts.name,
         2 * asin(sqrt(pow(sin((radians(pts.lat) - radians(qs.lat)) / 2), 2)
             + cos(radians(pts.lat)) * cos(radians(qs.lat)) * pow(sin((radians(pts.lon) - radians(qs.lon)) / 2), 2))) AS d,
         row_number() OVER (PARTITION BY qs.q_id ORDER BY 2 * asin(sqrt(pow(sin((radians(pts.lat) - radians(qs.lat)) / 2), 2)
             + cos(radians(pts.lat)) * cos(radians(qs.lat)) * pow(sin((radians(pts.lon) - radians(qs.lon)) / 2), 2))), pts.id) AS rn
  FROM qs, pts) WHERE rn = 1
""")
def geo_nearest_grid(spark, d):
    """J8 through the grid co-group join."""
    t = Tables(spark, d)
    nn = nn_haversine(geo_points(t), geo_queries(t), 1, method="grid")
    return nn.select("q_id", "id", "name", F.round("d", 6).alias("d"))
