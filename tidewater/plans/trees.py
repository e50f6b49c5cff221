"""T1–T6 split-search and tree queries over lineitem.

Classification: label = l_returnflag over (l_quantity, l_discount, l_tax).
Regression: y = ln(l_extendedprice) over the same features."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import evaluate as EV
from tidewater.operators import trees as TR
from tidewater.plans.registry import query
from tidewater.sources.tables import Tables

# fixed values: the feature set, classes and tree depth of the tree queries
FEATURES = ["l_quantity", "l_discount", "l_tax"]
CLASSES = ["A", "N", "R"]
DEPTH = 2


def _cls(spark, d):
    return Tables(spark, d).lineitem.select(*FEATURES, F.col("l_returnflag").alias("label"))


def _reg(spark, d):
    return Tables(spark, d).lineitem.select(*FEATURES, F.log("l_extendedprice").alias("y"))


# ---- oracle SQL generation --------------------------------------------------

def _ent(cs, n):
    return "-(" + " + ".join(f"CASE WHEN {c} > 0 THEN ({c} / {n}) * log2({c} / {n}) ELSE 0 END" for c in cs) + ")"


def _gini(cs, n):
    return "(1 - (" + " + ".join(f"({c} / {n}) * ({c} / {n})" for c in cs) + "))"


def candidates_sql(src: str, score: str, label: str) -> str:
    """Candidate splits of relation ``src`` (columns node, features, label)."""
    long = " UNION ALL ".join(
        f"SELECT node, {i} AS fidx, '{f}' AS feature, CAST({f} AS DOUBLE) AS x, {label} AS lab FROM {src}"
        for i, f in enumerate(FEATURES))
    part = "PARTITION BY node, fidx, feature"
    if score in TR.CLASS_SCORES:
        k = len(CLASSES)
        cnt = ", ".join(f"count(*) FILTER (WHERE lab = '{c}') AS c{i}" for i, c in enumerate(CLASSES))
        wins = ", ".join(
            f"sum(c{i}) OVER ({part} ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS l{i}, "
            f"sum(c{i}) OVER ({part}) AS t{i}" for i in range(k))
        L = [f"l{i}" for i in range(k)]
        R = [f"(t{i} - l{i})" for i in range(k)]
        nl, nr = "(" + " + ".join(L) + ")", "(" + " + ".join(R) + ")"
        if score == "maj_sum":
            sc = f"greatest({', '.join(L)}) + greatest({', '.join(R)})"
        elif score == "info_gain":
            sc = f"-({nl} * {_ent(L, nl)} + {nr} * {_ent(R, nr)}) / ({nl} + {nr})"
        else:
            sc = f"-({nl} * {_gini(L, nl)} + {nr} * {_gini(R, nr)}) / ({nl} + {nr})"
        agg = f"SELECT node, fidx, feature, x, {cnt} FROM ({long}) WHERE x IS NOT NULL GROUP BY node, fidx, feature, x"
        run = f"SELECT *, lead(x) OVER ({part} ORDER BY x) AS nx, {wins} FROM ({agg})"
    else:
        agg = (f"SELECT node, fidx, feature, x, count(*) AS c, sum(lab) AS sy, sum(lab * lab) AS syy "
               f"FROM ({long}) WHERE x IS NOT NULL GROUP BY node, fidx, feature, x")
        w = f"OVER ({part} ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        run = (f"SELECT *, lead(x) OVER ({part} ORDER BY x) AS nx, sum(c) {w} AS nl, sum(sy) {w} AS sl, "
               f"sum(syy) {w} AS ql, sum(c) OVER ({part}) AS n, sum(sy) OVER ({part}) AS st, "
               f"sum(syy) OVER ({part}) AS qt FROM ({agg})")
        sse_l = "(ql - sl * sl / nl)"
        sse_r = "((qt - ql) - (st - sl) * (st - sl) / (n - nl))"
        overall = "(qt / n - (st / n) * (st / n))"
        if score == "variance":
            sc = f"{overall} - ({sse_l} + {sse_r}) / n"
        else:
            sc = f"{overall} - (nl / n) * {sse_l} - ((n - nl) / n) * {sse_r}"
    return (f"SELECT node, fidx, feature, (x + nx) / 2 AS threshold, round({sc}, 9) AS score "
            f"FROM ({run}) WHERE nx IS NOT NULL")


def best_split_sql(score: str, base: str) -> str:
    c = candidates_sql("base", score, "lab0")
    return f"""
WITH base AS ({base})
SELECT feature, threshold, CAST(round(score, 6) AS DOUBLE) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY fidx ORDER BY score DESC, threshold) AS rn FROM ({c}))
WHERE rn = 1
"""


_CLS_BASE = "SELECT 1 AS node, l_quantity, l_discount, l_tax, l_returnflag AS lab0 FROM lineitem"
_REG_BASE = "SELECT 1 AS node, l_quantity, l_discount, l_tax, ln(l_extendedprice) AS lab0 FROM lineitem"


def grow_tree_sql(score: str = "gini", base: str = _CLS_BASE, var_threshold: float = 0.0) -> str:
    """Depth-DEPTH tree as a chain of CTEs (one block per level)."""
    fval = "CASE n.feature " + " ".join(f"WHEN '{f}' THEN CAST(d.{f} AS DOUBLE)" for f in FEATURES) + " END"
    ctes = [f"d0 AS ({base})"]
    for lv in range(DEPTH + 1):
        if score in TR.REG_SCORES:
            ctes.append(f"""s{lv} AS (
  SELECT node, avg(lab0) AS prediction, count(*) AS n, var_pop(lab0) >= {var_threshold} AS split
  FROM d{lv} GROUP BY node)""")
        else:
            ctes.append(f"""s{lv} AS (
  SELECT node, max(CASE WHEN rk = 1 THEN lab0 END) AS prediction, sum(cnt) AS n, count(*) > 1 AS split FROM (
    SELECT node, lab0, count(*) AS cnt, row_number() OVER (PARTITION BY node ORDER BY count(*) DESC, lab0) AS rk
    FROM d{lv} GROUP BY node, lab0) GROUP BY node)""")
        if lv < DEPTH:
            ctes.append(f"""b{lv} AS (
  SELECT node, feature, threshold FROM (
    SELECT *, row_number() OVER (PARTITION BY node ORDER BY score DESC, fidx, threshold) AS rn
    FROM ({candidates_sql(f'd{lv}', score, 'lab0')})) WHERE rn = 1)""")
            ctes.append(f"""n{lv} AS (
  SELECT s.node, {lv} AS depth, CASE WHEN s.split THEN b.feature END AS feature,
         CASE WHEN s.split THEN b.threshold END AS threshold, s.prediction, s.n
  FROM s{lv} s LEFT JOIN b{lv} b ON s.node = b.node)""")
            ctes.append(f"""d{lv + 1} AS (
  SELECT CASE WHEN {fval} <= n.threshold THEN d.node * 2 ELSE d.node * 2 + 1 END AS node,
         d.l_quantity, d.l_discount, d.l_tax, d.lab0
  FROM d{lv} d JOIN n{lv} n ON d.node = n.node WHERE n.feature IS NOT NULL)""")
        else:
            ctes.append(f"""n{lv} AS (
  SELECT node, {lv} AS depth, CAST(NULL AS VARCHAR) AS feature, CAST(NULL AS DOUBLE) AS threshold, prediction, n
  FROM s{lv})""")
    # from the bottom up, splits whose children are leaves of equal prediction become leaves
    ctes.append(f"m{DEPTH} AS (SELECT * FROM n{DEPTH})")
    outs = ["SELECT * FROM m0"]
    for lv in range(DEPTH - 1, -1, -1):
        ctes.append(f"""m{lv} AS (
  SELECT n.node, n.depth, CASE WHEN c.same THEN NULL ELSE n.feature END AS feature, CASE WHEN c.same THEN NULL ELSE n.threshold END AS threshold,
         CASE WHEN c.same AND n.feature IS NOT NULL THEN c.leaf ELSE n.prediction END AS prediction, n.n
  FROM n{lv} n LEFT JOIN (SELECT node // 2 AS p, count(*) = 2 AND count(feature) = 0 AND min(prediction) = max(prediction) AS same,
                                 min(prediction) AS leaf FROM m{lv + 1} GROUP BY 1) c ON c.p = n.node)""")
        outs.append(f"SELECT c.* FROM m{lv + 1} c JOIN m{lv} p ON c.node // 2 = p.node AND p.feature IS NOT NULL")
    return "WITH " + ",\n".join(ctes) + ",\nnodes AS (" + " UNION ALL ".join(outs) + ")\n"


_NODES_OUT = """SELECT CAST(node AS BIGINT) AS node, CAST(depth AS INTEGER) AS depth, feature, threshold,
       prediction, CAST(n AS BIGINT) AS n FROM nodes"""


def _leaf_of(depth: int) -> str:
    """SQL: route every row to its deepest node (no merging needed for accuracy)."""
    fval = lambda k: "CASE {0}.feature ".format(k) + " ".join(
        f"WHEN '{f}' THEN CAST(l.{f} AS DOUBLE)" for f in FEATURES) + " END"
    sql = "SELECT l.*, 1 AS node0 FROM lineitem l"
    for lv in range(depth):
        sql = (f"SELECT l.*, CASE WHEN t.feature IS NULL THEN l.node{lv} WHEN {fval('t')} <= t.threshold "
               f"THEN l.node{lv} * 2 ELSE l.node{lv} * 2 + 1 END AS node{lv + 1} "
               f"FROM ({sql}) l JOIN nodes t ON t.node = l.node{lv}")
    return sql


# ---- registered queries -----------------------------------------------------

for _score in TR.CLASS_SCORES:
    def _make(score):
        def fn(spark, d):
            b = TR.best_split(_cls(spark, d), FEATURES, "label", score, CLASSES)
            return b.select("feature", "threshold", F.round(F.col("score").cast("double"), 6).alias("score"))
        return fn
    query(f"tree_best_split_{_score}", best_split_sql(_score, _CLS_BASE))(_make(_score))

for _score in TR.REG_SCORES:
    def _make_r(score):
        def fn(spark, d):
            b = TR.best_split(_reg(spark, d), FEATURES, "y", score)
            return b.select("feature", "threshold", F.round(F.col("score").cast("double"), 6).alias("score"))
        return fn
    query(f"tree_best_split_{_score}", best_split_sql(_score, _REG_BASE))(_make_r(_score))


@query("tree_grow_depth2", grow_tree_sql() + _NODES_OUT)
def tree_grow_depth2(spark, d):
    return TR.grow_tree(_cls(spark, d), FEATURES, "label", CLASSES, DEPTH, "gini")


@query("tree_apply_accuracy", grow_tree_sql() + f""",
routed AS ({_leaf_of(DEPTH)})
SELECT round(avg(CASE WHEN r.l_returnflag = t.prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       CAST(count(*) AS BIGINT) AS n
FROM routed r JOIN nodes t ON t.node = r.node{DEPTH}
""")
def tree_apply_accuracy(spark, d):
    data = _cls(spark, d)
    nodes = TR.grow_tree(data, FEATURES, "label", CLASSES, DEPTH, "gini")
    return EV.accuracy(TR.apply_tree(data, nodes))


@query("tree_apply_by_levels", grow_tree_sql() + f""",
routed AS ({_leaf_of(DEPTH)})
SELECT round(avg(CASE WHEN r.l_returnflag = t.prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       CAST(count(*) AS BIGINT) AS n
FROM routed r JOIN nodes t ON t.node = r.node{DEPTH}
""")
def tree_apply_by_levels(spark, d):
    """T6 by joins with the node table, as for deep trees."""
    data = _cls(spark, d)
    nodes = TR.grow_tree(data, FEATURES, "label", CLASSES, DEPTH, "gini")
    return EV.accuracy(TR.apply_tree_by_levels(data, nodes, FEATURES, DEPTH))


@query("tree_best_split_price_blocks", """
WITH c AS (SELECT l_extendedprice AS x, count(*) FILTER (WHERE l_returnflag = 'A') AS c0, count(*) FILTER (WHERE l_returnflag = 'N') AS c1,
                  count(*) FILTER (WHERE l_returnflag = 'R') AS c2 FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY 1),
r AS (SELECT x, lead(x) OVER w AS nx, sum(c0) OVER w AS l0, sum(c1) OVER w AS l1, sum(c2) OVER w AS l2,
             sum(c0) OVER () AS t0, sum(c1) OVER () AS t1, sum(c2) OVER () AS t2 FROM c WINDOW w AS (ORDER BY x)),
s AS (SELECT (x + nx) / 2 AS threshold, greatest(l0, l1, l2) + greatest(t0 - l0, t1 - l1, t2 - l2) AS score FROM r WHERE nx IS NOT NULL)
SELECT 'l_extendedprice' AS feature, threshold, CAST(score AS DOUBLE) AS score FROM s ORDER BY score DESC, threshold LIMIT 1
""")
def tree_best_split_price_blocks(spark, d):
    """W2 on a continuous feature through the blocked prefix sums."""
    li = Tables(spark, d).lineitem.select("l_extendedprice", F.col("l_returnflag").alias("label"))
    b = TR.best_split(li, ["l_extendedprice"], "label", "maj_sum", CLASSES, blocks=16)
    return b.select("feature", "threshold", F.col("score").cast("double").alias("score"))


VAR_THRESHOLD = 0.01


@query("tree_grow_regression_depth2", grow_tree_sql("variance", _REG_BASE, VAR_THRESHOLD) + """
SELECT CAST(node AS BIGINT) AS node, CAST(depth AS INTEGER) AS depth, feature, threshold,
       round(prediction, 6) AS prediction, CAST(n AS BIGINT) AS n FROM nodes""")
def tree_grow_regression_depth2(spark, d):
    nodes = TR.grow_tree(_reg(spark, d), FEATURES, "y", None, DEPTH, "variance", var_threshold=VAR_THRESHOLD)
    return nodes.withColumn("prediction", F.round("prediction", 6))
