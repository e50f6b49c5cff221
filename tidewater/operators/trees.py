"""Decision-tree split search and growth as table operators.

Split search: features are unpivoted to ``(node, feature, x, label)``, then
pre-aggregated to one row per distinct ``(node, feature, x)`` with per-class
counts (or count/Σy/Σy² for regression) — partial aggregation, so the
windows only ever see distinct values, never raw rows. Running sums over
``x`` (W2/W3) give the left side of every candidate split, the total gives
the right side, and ``lead(x)`` (W4) gives the next distinct value for the
midpoint threshold. The running sums are a two-level (block) prefix sum, so
a continuous feature with billions of distinct values is spread over many
window tasks instead of one. Scores are rounded to 9 decimals before
the arg-max so ties break the same way everywhere: highest score, then
smallest threshold (the reference keeps the first best), then feature order.

Growth (T5) is level-wise over *histograms*: one row per distinct ``(node,
feature, x)`` with class counts (or count/Σy/Σy²), and one more for the node
itself. A level aggregates rows once; node statistics and candidate splits both
come from its histogram. Of two children only the smaller one's rows are
counted: the other's histogram is the parent's less the sibling's (class counts
are integers, so that is exact; the sums of a regression are counted for both).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators.common import attach_scalars
from tidewater.session import cut_lineage

CLASS_SCORES = ("maj_sum", "info_gain", "gini")
REG_SCORES = ("variance", "variance_ref")


def _unpivot(df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(i).alias("fidx"), F.lit(f).alias("feature"),
                             F.col(f).cast("double").alias("x")) for i, f in enumerate(features)])
    return df.select(*keep, F.inline(arr))


def _entropy(cs: list[Column], n: Column) -> Column:
    terms = [F.when(c > 0, (c / n) * F.log2(c / n)).otherwise(0.0) for c in cs]
    return -sum(terms[1:], terms[0])


def _gini(cs: list[Column], n: Column) -> Column:
    return 1 - sum([(c / n) * (c / n) for c in cs[1:]], (cs[0] / n) * (cs[0] / n))


def _running(cnt: DataFrame, keys: list[str], cols: list[str], blocks: int) -> DataFrame:
    """Running (≤ x) and total sums of ``cols`` per ``keys`` plus the next
    distinct value ``nx``, over a table with one row per distinct x.

    With ``blocks > 1`` this is a two-level prefix sum, so no window ever
    holds more than one block of a feature's distinct values:

    1. per-key block bounds from ``percentile_approx`` (``blocks − 1`` values);
    2. per-block totals and minima, prefix-summed over the small block table
       (keys × blocks rows);
    3. running sums inside each block plus the block's offset; the next value
       after a block's last x is the next block's minimum.
    Block choice only moves work between tasks; results are exact."""
    run = Window.unboundedPreceding, Window.currentRow
    if blocks <= 1:
        w = Window.partitionBy(*keys).orderBy("x")
        whole = Window.partitionBy(*keys)
        return cnt.select(*keys, "x", F.lead("x").over(w).alias("nx"),
                          *[F.sum(c).over(w.rowsBetween(*run)).alias(f"run_{c}") for c in cols],
                          *[F.sum(c).over(whole).alias(f"tot_{c}") for c in cols])
    fracs = [i / blocks for i in range(1, blocks)]
    bounds = cnt.groupBy(*keys).agg(F.percentile_approx("x", fracs, 10000).alias("_b"))
    c = (cnt.join(bounds, keys)
         .withColumn("_blk", F.size(F.filter("_b", lambda b: b < F.col("x")))).drop("_b"))
    bt = c.groupBy(*keys, "_blk").agg(F.min("x").alias("_bmin"), *[F.sum(x).alias(f"_bs_{x}") for x in cols])
    wb = Window.partitionBy(*keys).orderBy("_blk")
    whole = Window.partitionBy(*keys)
    bt = bt.select(*keys, "_blk", F.lead("_bmin").over(wb).alias("_next"),
                   *[F.coalesce(F.sum(f"_bs_{x}").over(wb.rowsBetween(Window.unboundedPreceding, -1)),
                                F.lit(0)).alias(f"_off_{x}") for x in cols],
                   *[F.sum(f"_bs_{x}").over(whole).alias(f"tot_{x}") for x in cols])
    j = c.join(bt, keys + ["_blk"])
    w = Window.partitionBy(*keys, "_blk").orderBy("x")
    return j.select(*keys, "x", F.coalesce(F.lead("x").over(w), F.col("_next")).alias("nx"),
                    *[(F.col(f"_off_{x}") + F.sum(x).over(w.rowsBetween(*run))).alias(f"run_{x}") for x in cols],
                    *[F.col(f"tot_{x}") for x in cols])


ROWS_PER_BLOCK = 1_000_000  # distinct values one window task may hold


def auto_blocks(df: DataFrame, features: list[str], rows_per_block: int = ROWS_PER_BLOCK) -> int:
    """Blocks for the prefix sums: enough that no window task holds more
    than ``rows_per_block`` distinct values of a feature (one small
    approximate-distinct aggregate)."""
    r = df.agg(*[F.approx_count_distinct(f).alias(f"d{i}") for i, f in enumerate(features)]).first()
    most = max(r[i] or 0 for i in range(len(features)))
    return max(1, -(-most // rows_per_block))


def _histogram(df: DataFrame, features: list[str], label: str, score: str, classes: list | None, keys: list[str], whole: bool = False) -> DataFrame:
    """One row per distinct ``x`` of each feature (per ``keys``) with the sums
    that the score needs; ``whole`` adds a row for all rows of ``keys``, with
    the feature number -1. Nulls have no x, but count in the whole."""
    every = F.array(*([F.struct(F.lit(-1).alias("fidx"), F.lit("").alias("feature"), F.lit(0.0).alias("x"))] if whole else []),
                    *[F.struct(F.lit(i).alias("fidx"), F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for i, f in enumerate(features)])
    long = df.select(*keys, label, F.inline(every)).filter(F.col("x").isNotNull())
    if score in CLASS_SCORES:
        if not classes:
            raise ValueError("classes are required for classification scores")
        sums = [F.count_if(F.col(label) == F.lit(c)).alias(f"c{i}") for i, c in enumerate(classes)]
    elif score in REG_SCORES:
        y = F.col(label).cast("double")
        sums = [F.count(F.lit(1)).alias("c"), F.sum(y).alias("sy"), F.sum(y * y).alias("syy")]
    else:
        raise ValueError(score)
    return long.groupBy(*keys, "fidx", "feature", "x").agg(*sums)


def _scored(cnt: DataFrame, keys: list[str], score: str, classes: list | None, blocks: int) -> DataFrame:
    """Candidate splits of a histogram: keys, threshold, score and the rows below."""
    if score in CLASS_SCORES:
        k = len(classes)
        s = _running(cnt, keys, [f"c{i}" for i in range(k)], blocks).filter(F.col("nx").isNotNull())
        L = [F.col(f"run_c{i}") for i in range(k)]
        R = [F.col(f"tot_c{i}") - F.col(f"run_c{i}") for i in range(k)]
        nl, nr = sum(L[1:], L[0]), sum(R[1:], R[0])
        if score == "maj_sum":
            sc = F.greatest(*L) + F.greatest(*R) if k > 1 else L[0] + R[0]
        elif score == "info_gain":
            sc = -(nl * _entropy(L, nl) + nr * _entropy(R, nr)) / (nl + nr)
        else:
            sc = -(nl * _gini(L, nl) + nr * _gini(R, nr)) / (nl + nr)
    else:
        s = _running(cnt, keys, ["c", "sy", "syy"], blocks).filter(F.col("nx").isNotNull())
        nl, n = F.col("run_c"), F.col("tot_c")
        sl, ql, st, qt = F.col("run_sy"), F.col("run_syy"), F.col("tot_sy"), F.col("tot_syy")
        nr = n - nl
        sse_l = ql - sl * sl / nl
        sse_r = (qt - ql) - (st - sl) * (st - sl) / nr
        overall = qt / n - (st / n) * (st / n)
        if score == "variance":
            sc = overall - (sse_l + sse_r) / n
        else:  # fixed formula, as printed (D9)
            sc = overall - (nl / n) * sse_l - (nr / n) * sse_r
    return s.select(*keys, ((F.col("x") + F.col("nx")) / 2).alias("threshold"), F.round(sc, 9).alias("score"), (2 * nl <= nl + nr).alias("low_is_small"))


def split_candidates(df: DataFrame, features: list[str], label: str, score: str,
                     classes: list | None = None, node: str | None = None, blocks: int | None = None) -> DataFrame:
    """Every candidate split: (node?, fidx, feature, threshold, score).
    ``blocks=None`` sizes the prefix-sum blocks from the data."""
    if blocks is None:
        blocks = auto_blocks(df, features)
    keys = [node] if node else []
    cnt = _histogram(df, features, label, score, classes, keys)
    return _scored(cnt, keys + ["fidx", "feature"], score, classes, blocks).drop("low_is_small")


def best_split(df: DataFrame, features: list[str], label: str, score: str = "gini",
               classes: list | None = None, blocks: int | None = None) -> DataFrame:
    """Best threshold per feature → (feature, threshold, score)."""
    c = split_candidates(df, features, label, score, classes, blocks=blocks)
    best = c.groupBy("fidx", "feature").agg(
        F.min(F.struct((-F.col("score")).alias("o"), F.col("threshold").alias("t"))).alias("b"))
    return best.select("feature", F.col("b.t").alias("threshold"), (-F.col("b.o")).alias("score"))


def _feature_value(features: list[str], fcol: Column) -> Column:
    expr = None
    for f in features:
        cond = fcol == F.lit(f)
        expr = F.when(cond, F.col(f).cast("double")) if expr is None else expr.when(cond, F.col(f).cast("double"))
    return expr


def _node_stats(hist: DataFrame, score: str, classes: list | None, var_threshold: float) -> DataFrame:
    """Per node of a histogram: prediction, n and whether the node may split
    (classification: more than one class; regression: variance at least
    ``var_threshold``)."""
    whole = hist.filter("fidx = -1")
    if score in REG_SCORES:
        mean = F.col("sy") / F.col("c")
        return whole.select("node", mean.alias("prediction"), F.col("c").alias("n"), (F.col("syy") / F.col("c") - mean * mean >= var_threshold).alias("_split"))
    counts = [F.col(f"c{i}") for i in range(len(classes))]
    most = F.array_min(F.array(*[F.struct((-n).alias("o"), F.lit(c).alias("c")) for n, c in zip(counts, classes)]))
    several = sum([(n > 0).cast("int") for n in counts[1:]], (counts[0] > 0).cast("int")) > 1
    return whole.select("node", most["c"].alias("prediction"), sum(counts[1:], counts[0]).alias("n"), several.alias("_split"))


def grow_tree(df: DataFrame, features: list[str], label: str, classes: list | None = None,
              max_depth: int = 2, score: str = "gini", checkpoint_every: int = 4,
              var_threshold: float = 1e-6) -> DataFrame:
    """T5: node table (node, depth, feature, threshold, prediction, n).

    Node ids are heap-numbered (root 1; children 2i for ``x <= t`` and
    2i+1 otherwise). A node is a leaf at max depth, when it is homogeneous
    (one class; or, for the regression scores, variance below
    ``var_threshold``), or when no feature has two distinct values.
    Classification leaves predict the majority class (ties → smallest) of
    ``classes``, which rows of another label don't count in; regression leaves
    the mean. A split whose children are leaves of equal prediction is a leaf
    itself (over the whole tree, from the bottom up); its ``n`` is the split's.
    Growth ends at the first level without a split."""
    # every level rescans the data: write the projected columns once (reliable
    # checkpoint in the shared folder) and grow from that narrow copy
    data = df.select(*features, label).withColumn("node", F.lit(1).cast("bigint"))
    data = cut_lineage(data.filter(F.col(label).isin(classes)) if score in CLASS_SCORES and classes else data.filter(F.col(label).isNotNull()))
    blocks = auto_blocks(data, features)  # sized once from the root data
    by = ["node", "fidx", "feature"]
    hist = cut_lineage(_histogram(data, features, label, score, classes, ["node"], whole=True))
    node_tables = []
    for depth in range(max_depth + 1):
        stats = _node_stats(hist, score, classes, var_threshold)
        if depth < max_depth:
            cands = _scored(hist.filter("fidx >= 0"), by, score, classes, blocks)
            best = cands.groupBy("node").agg(F.min(F.struct(
                (-F.col("score")).alias("o"), F.col("fidx").alias("fi"), F.col("threshold").alias("t"),
                F.col("feature").alias("f"), F.col("low_is_small").alias("s"))).alias("b"))
            splits = (stats.join(best, "node", "left")
                      .select("node", F.when(F.col("_split"), F.col("b.f")).alias("feature"),
                              F.when(F.col("_split"), F.col("b.t")).alias("threshold"),
                              "prediction", "n", (F.col("node") * 2 + F.when(F.col("b.s"), 0).otherwise(1)).alias("_small")))
        else:
            splits = stats.select("node", F.lit(None).cast("string").alias("feature"),
                                  F.lit(None).cast("double").alias("threshold"), "prediction", "n")
        splits = splits.withColumn("depth", F.lit(depth))
        # one row per node of this level, read by the next levels and at the end
        splits = cut_lineage(splits)
        node_tables.append(splits.drop("_small"))
        if depth == max_depth or splits.filter(F.col("feature").isNotNull()).isEmpty():
            break
        inner = splits.filter(F.col("feature").isNotNull()).select(
            "node", F.col("feature").alias("_f"), F.col("threshold").alias("_t"), "_small")
        data = (data.join(inner, "node")
                .withColumn("node", F.when(_feature_value(features, F.col("_f")) <= F.col("_t"),
                                           F.col("node") * 2).otherwise(F.col("node") * 2 + 1))
                .drop("_f", "_t"))
        if depth % checkpoint_every == checkpoint_every - 1:
            data = cut_lineage(data)
        hist = cut_lineage(_children(hist, data, inner, features, label, score, classes))
        data = data.drop("_small")
    # deepest level first, so that a merged pair can merge again further up;
    # children of what is a leaf then are gone
    level, kept = node_tables[-1], []
    for t in reversed(node_tables[:-1]):
        above = cut_lineage(_merge_level(t, level))
        parents = above.filter(F.col("feature").isNotNull()).select(F.col("node").alias("_p"))
        kept.append(level.join(parents, F.floor(F.col("node") / 2) == F.col("_p"), "left_semi"))
        level = above
    out = level
    for t in kept:
        out = out.unionByName(t)
    return out.select("node", "depth", "feature", "threshold", "prediction", "n")


def _children(hist: DataFrame, data: DataFrame, inner: DataFrame, features: list[str], label: str, score: str, classes: list | None) -> DataFrame:
    """The histogram of the next level from the rows (with ``_small``, the
    child whose rows are counted) and the level's own histogram."""
    if score in REG_SCORES:
        return _histogram(data, features, label, score, classes, ["node"], whole=True)
    cols = [f"c{i}" for i in range(len(classes))]
    keys = ["node", "fidx", "feature", "x"]
    small = cut_lineage(_histogram(data.filter("node = _small"), features, label, score, classes, ["node"], whole=True))
    # 2i and 2i + 1 differ in the last bit
    sibling = F.col("_small").bitwiseXOR(F.lit(1).cast("bigint"))
    parent = hist.join(inner.select("node", "_small"), "node").select(sibling.alias("node"), "fidx", "feature", "x", *cols)
    less = small.select(F.col("node").bitwiseXOR(F.lit(1).cast("bigint")).alias("node"), "fidx", "feature", "x", *[F.col(c).alias(f"_{c}") for c in cols])
    rest = parent.join(less, keys, "left").select(*keys, *[(F.col(c) - F.coalesce(F.col(f"_{c}"), F.lit(0))).alias(c) for c in cols])
    left = sum([F.col(c) for c in cols[1:]], F.col(cols[0]))
    return small.unionByName(rest.filter(left > 0))


def _merge_level(level: DataFrame, below: DataFrame) -> DataFrame:
    """Splits of a level whose children are leaves of equal prediction become
    leaves, as the recursive growth does."""
    pairs = below.groupBy(F.floor(F.col("node") / 2).cast("bigint").alias("node")).agg(
        ((F.count(F.lit(1)) == 2) & (F.count("feature") == 0) & (F.min("prediction") == F.max("prediction"))).alias("_same"),
        F.min("prediction").alias("_leaf"))
    same = F.coalesce(F.col("_same"), F.lit(False)) & F.col("feature").isNotNull()
    return level.join(pairs, "node", "left").select(
        "node", F.when(~same, F.col("feature")).alias("feature"), F.when(~same, F.col("threshold")).alias("threshold"),
        F.when(same, F.col("_leaf")).otherwise(F.col("prediction")).alias("prediction"), "n", "depth")


def apply_tree(df: DataFrame, nodes: DataFrame, out: str = "prediction") -> DataFrame:
    """The prediction of the leaf that a row comes to (``<=`` goes low,
    null high), by levels; only the features' names and the depth are asked for."""
    r = nodes.agg(F.collect_set("feature").alias("features"), F.max("depth").alias("depth")).first()
    return apply_tree_by_levels(df, nodes, sorted(r["features"]), r["depth"] or 0, out)


def apply_tree_by_levels(df: DataFrame, nodes: DataFrame, features: list[str], max_depth: int, out: str = "prediction") -> DataFrame:
    """T6 for deep trees: rows go down a level at a time by a join with the node
    table, so neither the driver nor one expression holds the tree."""
    step = nodes.select("node", F.col("feature").alias("_f"), F.col("threshold").alias("_t"))
    low = _feature_value(features, F.col("_f")) <= F.col("_t") if features else F.lit(True)

    def down(rows: DataFrame, node: Column) -> DataFrame:
        below = F.when(F.col("_f").isNull(), node).otherwise(node * 2 + F.when(low, 0).otherwise(1))
        return rows.withColumn("node", below.cast("bigint")).drop("_f", "_t")

    # the root is one row: its split comes as scalars, as a join on a constant would be no equi-join
    root = step.filter("node = 1").agg(F.first("_f").alias("_f"), F.first("_t").alias("_t"))
    rows = down(attach_scalars(df, root), F.lit(1)) if max_depth else df.withColumn("node", F.lit(1).cast("bigint"))
    for _ in range(max_depth - 1):
        rows = down(rows.join(step.filter(F.col("_f").isNotNull()), "node", "left"), F.col("node"))
    return rows.join(nodes.select("node", F.col("prediction").alias(out)), "node").drop("node")
