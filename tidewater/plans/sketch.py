"""K3 cardinality-sketch queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import sketch as SK
from tidewater.operators.common import attach_scalars
from tidewater.plans.registry import query
from tidewater.sources.tables import Tables

LOG2M = 10
_M = 1 << LOG2M


def _regs_sql(table: str, col: str, where: str = "") -> str:
    return f"""
SELECT CAST(((14439580439569971107::UHUGEINT * ({col}::UHUGEINT)) % 18446744073709551616::UHUGEINT)
             // {2 ** (64 - LOG2M)}::UHUGEINT AS INTEGER) AS register,
       CAST(max(CASE WHEN hv = 0 THEN 33 ELSE 33 - length(bin(hv)) END) AS INTEGER) AS rho
FROM (SELECT {col}, ('0x' || substr(md5({col}::VARCHAR), 1, 8))::BIGINT AS hv FROM {table} {where})
GROUP BY 1
"""


def _estimate_sql(regs: str) -> str:
    return f"""
WITH r AS ({regs}),
a AS (SELECT (0.7213 / (1 + 1.079 / {_M})) * {_M * _M} / (sum(pow(2.0, -rho)) + ({_M} - count(*))) AS e,
             CAST({_M} - count(*) AS DOUBLE) AS v FROM r)
SELECT round(CASE WHEN e <= 2.5 * {_M} AND v > 0 THEN {_M} * ln({_M} / v)
                  WHEN e > 4294967296.0 / 30 THEN -4294967296.0 * ln(1 - e / 4294967296.0)
                  ELSE e END, 4) AS estimate,
       CAST(v AS BIGINT) AS zero_registers
FROM a
"""


@query("sketch_registers_partkey", _regs_sql("lineitem", "l_partkey"))
def sketch_registers_partkey(spark, d):
    return SK.hll_registers(Tables(spark, d).lineitem, "l_partkey", LOG2M)


@query("sketch_estimate_partkey", _estimate_sql(_regs_sql("lineitem", "l_partkey")))
def sketch_estimate_partkey(spark, d):
    return SK.hll_estimate(SK.hll_registers(Tables(spark, d).lineitem, "l_partkey", LOG2M), LOG2M)


@query("sketch_estimate_orderkey", _estimate_sql(_regs_sql("lineitem", "l_orderkey")))
def sketch_estimate_orderkey(spark, d):
    return SK.hll_estimate(SK.hll_registers(Tables(spark, d).lineitem, "l_orderkey", LOG2M), LOG2M)


@query("sketch_merge_users", _regs_sql("events", "user_id"))
def sketch_merge_users(spark, d):
    # two sketches (even and odd event ids) merged must equal the sketch of all
    e = Tables(spark, d).events
    a = SK.hll_registers(e.filter(F.col("event_id") % 2 == 0), "user_id", LOG2M)
    b = SK.hll_registers(e.filter(F.col("event_id") % 2 == 1), "user_id", LOG2M)
    return SK.hll_merge(a, b)


@query("sketch_hash_histogram", """
WITH h AS (SELECT ('0x' || substr(md5(event_id::VARCHAR), 1, 8))::BIGINT AS h FROM events),
mm AS (SELECT min(h) AS lo, max(h) AS hi FROM h)
SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(49, ((h - lo) * 50) // (hi - lo)) END + 1 AS INTEGER) AS bin,
       CAST(count(*) AS BIGINT) AS n
FROM h, mm GROUP BY 1
""")
def sketch_hash_histogram(spark, d):
    return SK.hash_histogram(Tables(spark, d).events, "event_id", 50)


_WITHIN_SQL = "SELECT CAST(count(DISTINCT l_orderkey) AS BIGINT) AS n_distinct, TRUE AS within FROM lineitem"


def _within(estimate, exact, bound: float):
    """The exact distinct count, and whether an estimate lies within ``bound`` of it."""
    both = attach_scalars(exact, estimate.select("estimate"))
    return both.select("n_distinct", (F.abs(F.col("estimate") - F.col("n_distinct")) <= bound * F.col("n_distinct")).alias("within"))


@query("sketch_estimate_tabulation", _WITHIN_SQL)
def sketch_estimate_tabulation(spark, d):
    """A16 over the tabulation hash (F7), within four standard errors."""
    li = Tables(spark, d).lineitem
    est = SK.hll_estimate(SK.hll_registers(li, "l_orderkey", LOG2M, hash="tabulation"), LOG2M)
    return _within(est, li.agg(F.countDistinct("l_orderkey").alias("n_distinct")), 4 * SK.relative_error_bound(LOG2M))


@query("sketch_builtin_hll", _WITHIN_SQL)
def sketch_builtin_hll(spark, d):
    li = Tables(spark, d).lineitem
    return _within(SK.builtin_distinct(li, "l_orderkey"), li.agg(F.countDistinct("l_orderkey").alias("n_distinct")), 4 * SK.relative_error_bound(12))


@query("sketch_edge_list_estimate", _estimate_sql(
    _regs_sql("(SELECT l_suppkey AS id FROM lineitem UNION ALL SELECT l_partkey FROM lineitem)", "id")))
def sketch_edge_list_estimate(spark, d):
    """S3 + A14 + A16: an edge list printed as ``src dst`` text lines (from
    lineitem's supplier and part keys) is parsed back into one id per row and
    sketched, as the reference does with its edge file."""
    from tidewater.sources.readers import parse_edge_ids
    li = Tables(spark, d).lineitem
    lines = li.select(F.concat_ws(" ", F.col("l_suppkey").cast("string"),
                                  F.col("l_partkey").cast("string")).alias("value"))
    ids = parse_edge_ids(lines)
    return SK.hll_estimate(SK.hll_registers(ids, "id", LOG2M), LOG2M)
