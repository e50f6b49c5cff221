"""Model-pipeline queries (M1–M15). A fitted model's metric differs from
engine to engine, so each query gives what SQL can check: the rows that it was
tested on, the baseline on them, and whether the model is no worse."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import evaluate as EV
from tidewater.operators import folds as FD
from tidewater.operators import forest as FO
from tidewater.operators import ml as ML
from tidewater.operators import prep as PR
from tidewater.operators import textgrid as TG
from tidewater.operators.common import attach_scalars
from tidewater.operators.mlp import fit_tanh_network
from tidewater.operators.perceptron import fit_perceptron
from tidewater.plans.fixtures import hash_sql
from tidewater.plans.registry import query
from tidewater.session import cut_lineage
from tidewater.sources.tables import Tables

# fixed values: feature set, split seed and the market segments of customer
FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SEED = 1
# the classes are bands of the price paid, which the features determine (the tables' flags are random)
BANDS = (33_000, 66_000)
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _split(spark, d):
    paid = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    li = Tables(spark, d).lineitem.select("l_orderkey", *FEATURES, F.when(paid < BANDS[0], "A").when(paid < BANDS[1], "N").otherwise("R").alias("label"),
                                          F.log(paid * (1 + F.col("l_tax"))).alias("y"))
    # iterative fits read the split many times: written once
    s = cut_lineage(PR.split_by_hash(li, "l_orderkey", [0.8, 0.2], SEED, ["train", "test"]))
    return s.filter("split = 'train'"), s.filter("split = 'test'")


_SPLIT_SQL = f"""
WITH s AS (SELECT CASE WHEN l_extendedprice * (1 - l_discount) < {BANDS[0]} THEN 'A' WHEN l_extendedprice * (1 - l_discount) < {BANDS[1]} THEN 'N'
                       ELSE 'R' END AS label, ln(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS y,
                  CASE WHEN {hash_sql('l_orderkey', SEED)} % 100 < 80 THEN 'train' ELSE 'test' END AS split FROM lineitem)
"""


def _majority_sql(label: str = "label") -> str:
    return _SPLIT_SQL + f""",
maj AS (SELECT {label} AS m FROM s WHERE split = 'train' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT CAST(count(*) AS BIGINT) AS n, round(avg(CASE WHEN {label} = m THEN 1.0 ELSE 0.0 END), 6) AS baseline, TRUE AS reaches
FROM s, maj WHERE split = 'test'
"""


_MEAN_SQL = _SPLIT_SQL + """
SELECT CAST(count(*) AS BIGINT) AS n, round(avg(pow(y - (SELECT avg(y) FROM s WHERE split = 'train'), 2)), 6) AS baseline, TRUE AS reaches
FROM s WHERE split = 'test'
"""


@query("ml_one_hot_segments", "SELECT c_custkey, " + ", ".join(
    f"CAST(c_mktsegment = '{v}' AS INTEGER) AS seg_{v.lower()}" for v in SEGMENTS) + " FROM customer")
def ml_one_hot_segments(spark, d):
    c = Tables(spark, d).customer.select("c_custkey", "c_mktsegment")
    return ML.one_hot(c, "c_mktsegment", SEGMENTS, "seg").drop("c_mktsegment")


def _det3(m):
    return (f"(({m[0][0]}) * (({m[1][1]}) * ({m[2][2]}) - ({m[1][2]}) * ({m[2][1]}))"
            f" - ({m[0][1]}) * (({m[1][0]}) * ({m[2][2]}) - ({m[1][2]}) * ({m[2][0]}))"
            f" + ({m[0][2]}) * (({m[1][0]}) * ({m[2][1]}) - ({m[1][1]}) * ({m[2][0]})))")


def _normal_eq_sql() -> str:
    A = [["n", "sa", "sb"], ["sa", "saa", "sab"], ["sb", "sab", "sbb"]]
    rhs = ["sy", "say", "sby"]
    d = _det3(A)
    cols = []
    for j in range(3):
        m = [[rhs[i] if k == j else A[i][k] for k in range(3)] for i in range(3)]
        cols.append(f"round({_det3(m)} / {d}, 6) AS b{j}")
    return f"""
WITH s AS (SELECT CAST(count(*) AS DOUBLE) AS n, sum(a) AS sa, sum(b) AS sb, sum(a * a) AS saa, sum(a * b) AS sab,
                  sum(b * b) AS sbb, sum(y) AS sy, sum(a * y) AS say, sum(b * y) AS sby
           FROM (SELECT l_quantity AS a, l_discount AS b, ln(l_extendedprice) AS y FROM lineitem))
SELECT {', '.join(cols)} FROM s
"""


@query("ml_normal_equations", _normal_eq_sql())
def ml_normal_equations(spark, d):
    li = Tables(spark, d).lineitem.select("l_quantity", "l_discount", F.log("l_extendedprice").alias("y"))
    return ML.normal_equations_2(li, "l_quantity", "l_discount", "y")


def _clf(kind, **kw):
    def fn(spark, d):
        train, test = _split(spark, d)
        return ML.against_majority(ML.fit_classifier(train, FEATURES, "label", kind, **kw), train, test, "label", margin=0.2)
    return fn


# reference settings: tree depth 5, forest 100 trees depth 10, 100 boosted stumps (lr 1.0)
query("ml_tree_classifier", _majority_sql())(_clf("tree", max_depth=5))
query("ml_forest_classifier", _majority_sql())(_clf("forest", num_trees=100, max_depth=10))
query("ml_gbt_one_vs_rest", _majority_sql())(_clf("gbt", iters=100))
query("ml_logistic", _majority_sql())(_clf("logistic"))


def _binary(kind, flag):
    """One class against the others, two learners that need or favour it."""
    def fn(spark, d):
        train, test = (x.withColumn("label", F.when(F.col("label") == flag, flag).otherwise("other")) for x in _split(spark, d))
        return ML.against_majority(ML.fit_classifier(train, FEATURES, "label", kind), train, test, "label", margin=0.15)
    return fn


_BINARY = "CASE WHEN label = 'R' THEN 'R' ELSE 'other' END"
query("ml_linear_svc", _majority_sql(_BINARY))(_binary("svc", "R"))
query("ml_mlp_binary", _majority_sql(_BINARY))(_binary("mlp", "R"))


def _own(fit):
    """A learner of our own for class R against the others, 15 points above the majority."""
    def fn(spark, d):
        train, test = (x.withColumn("label_idx", (F.col("label") == "R").cast("int")) for x in _split(spark, d))
        model = fit(train, FEATURES, F.col("label") == "R")
        return ML.against_majority(model, train, test, "label_idx", margin=0.15)
    return fn


query("ml_perceptron", _majority_sql(_BINARY))(_own(fit_perceptron))
query("ml_mlp_tanh", _majority_sql(_BINARY))(_own(fit_tanh_network))


def _reg_split(spark, d):
    train, test = _split(spark, d)
    return train, test, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("ml_forest_regressor", _MEAN_SQL)
def ml_forest_regressor(spark, d):
    train, test, feats = _reg_split(spark, d)
    return ML.against_mean(ML.fit_forest_regressor(train, feats, "y", num_trees=100, max_depth=10), train, test, "y", share=0.1)


@query("ml_lasso", _MEAN_SQL)
def ml_lasso(spark, d):
    train, test, feats = _reg_split(spark, d)
    return ML.against_mean(ML.fit_lasso(train, feats, "y"), train, test, "y", share=0.5)


def _labelled_texts(spark, d):
    t = Tables(spark, d)
    docs = t.labels.join(t.documents.select("doc_id", "text", "lang"), "doc_id").select(
        "doc_id", "text", F.col("lang").alias("label"))
    s = cut_lineage(PR.split_by_hash(docs, "doc_id", [0.8, 0.2], SEED, ["train", "test"]))
    return s.filter("split = 'train'"), s.filter("split = 'test'")


@query("ml_text_classifier", f"""
WITH s AS (SELECT lang AS label, CASE WHEN {hash_sql('doc_id', SEED)} % 100 < 80 THEN 'train' ELSE 'test' END AS split
           FROM labels JOIN documents USING (doc_id)),
maj AS (SELECT label AS m FROM s WHERE split = 'train' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT CAST(count(*) AS BIGINT) AS n, round(avg(CASE WHEN label = m THEN 1.0 ELSE 0.0 END), 6) AS baseline, TRUE AS reaches
FROM s, maj WHERE split = 'test'
""")
def ml_text_classifier(spark, d):
    """M14 against the majority."""
    train, test = _labelled_texts(spark, d)
    return ML.against_majority(ML.text_classifier("label", "text").fit(train), train, test, "label", margin=0.2)


@query("ml_text_grid", f"""
WITH s AS (SELECT lang AS label, {hash_sql('doc_id', SEED)} % 5 AS fold FROM labels JOIN documents USING (doc_id) WHERE lang IS NOT NULL),
folds AS (SELECT DISTINCT fold AS f FROM s),
maj AS (SELECT f, label AS m FROM (SELECT f, label, row_number() OVER (PARTITION BY f ORDER BY count(*) DESC, label) AS k FROM s JOIN folds ON fold <> f GROUP BY f, label) WHERE k = 1),
base AS (SELECT f, count(*) AS n, avg(CASE WHEN label = m THEN 1.0 ELSE 0.0 END) AS a FROM s JOIN maj ON f = fold GROUP BY f)
SELECT CAST(v AS INTEGER) AS vocab, CAST(g AS INTEGER) AS ngram, CAST(c AS DOUBLE) AS c, CAST(l AS DOUBLE) AS l1, CAST(sum(n) AS BIGINT) AS n, CAST(min(n) AS BIGINT) AS smallest_fold,
       round(avg(a), 6) AS majority, TRUE AS reaches
FROM base, unnest([1000, 2000, 3000]) AS a(v), unnest([1, 2]) AS b(g), unnest([0.1, 1.0, 10.0]) AS d(c), unnest([0.0, 1.0]) AS e(l) GROUP BY v, g, c, l
""")
def ml_text_grid(spark, d):
    """All 36 points of the text grid over five folds, 20 points above the
    majority class (languages are told apart by their words)."""
    t = Tables(spark, d)
    docs = t.labels.select("doc_id").join(t.documents.select("doc_id", "text", F.col("lang").alias("label")), "doc_id").filter("label IS NOT NULL")
    docs = cut_lineage(docs.withColumn("fold", (PR.hash_key(F.col("doc_id"), SEED) % 5).cast("int")))
    found = cut_lineage(TG.cross_validate_grid(docs))
    sizes = docs.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("k"))
    total = sizes.groupBy("label").agg(F.sum("k").alias("total"))
    folds = sizes.groupBy("fold").agg(F.sum("k").alias("size"), F.map_from_entries(F.collect_list(F.struct("label", "k"))).alias("own"))
    totals = total.agg(F.map_from_entries(F.collect_list(F.struct("label", "total"))).alias("totals"))  # one entry a language
    others = F.transform(F.map_entries("totals"), lambda e: F.struct((F.coalesce(F.col("own")[e["key"]], F.lit(0)) - e["value"]).alias("o"), e["key"].alias("label")))
    right = F.coalesce(F.col("own")[F.array_min(others)["label"]], F.lit(0)) / F.col("size")
    base = attach_scalars(folds, totals).agg(F.avg(right).alias("majority"), F.min("size").alias("smallest_fold"))
    means = found.groupBy("vocab", "ngram", "c", "l1").agg(F.sum("n").alias("n"), F.avg(F.col("correct") / F.col("n")).alias("accuracy"))
    both = attach_scalars(means, base)
    return both.select("vocab", "ngram", "c", "l1", "n", "smallest_fold", F.round("majority", 6).alias("majority"), (F.col("accuracy") >= F.col("majority") + 0.2).alias("reaches"))


@query("ml_text_classifier_report")
def ml_text_classifier_report(spark, d):
    train, test = _labelled_texts(spark, d)
    model = ML.text_classifier("label", "text").fit(train)
    pred = model.transform(test)
    labels = model.stages[-2].labels  # index → class name (model metadata)
    name = F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("prediction").cast("int") + 1)
    return EV.classification_report(pred.select("label", name.alias("prediction")))


# fixed values: folds, the features of the tree that is cross validated (each has at most 64 values), penalties
FOLDS, CV_FEATURES, PENALTIES = 5, ["l_quantity", "l_discount", "l_tax"], [0.0, 1.0, 100.0, 10_000.0]
_FOLD_SQL = f"""
WITH s AS (SELECT CASE WHEN l_extendedprice * (1 - l_discount) < {BANDS[0]} THEN 'A' WHEN l_extendedprice * (1 - l_discount) < {BANDS[1]} THEN 'N' ELSE 'R' END AS label,
                  l_quantity, l_discount, l_tax, ln(l_extendedprice) AS y, {hash_sql('l_orderkey', SEED)} % {FOLDS} AS fold FROM lineitem)
"""


def _folds(spark, d):
    paid = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return Tables(spark, d).lineitem.select(*CV_FEATURES, F.when(paid < BANDS[0], "A").when(paid < BANDS[1], "N").otherwise("R").alias("label"),
                                            F.log("l_extendedprice").alias("y"), (PR.hash_key(F.col("l_orderkey"), SEED) % FOLDS).cast("int").alias("fold"))


@query("ml_cross_validate", _FOLD_SQL + """
, long AS (SELECT fold, label, 0 AS fidx, l_quantity::DOUBLE AS x FROM s UNION ALL SELECT fold, label, 1, l_discount::DOUBLE FROM s UNION ALL SELECT fold, label, 2, l_tax::DOUBLE FROM s),
folds AS (SELECT DISTINCT fold AS f FROM s),
cnt AS (SELECT f, fidx, x, count(*) FILTER (WHERE label = 'A' AND fold <> f) AS a, count(*) FILTER (WHERE label = 'N' AND fold <> f) AS n,
               count(*) FILTER (WHERE label = 'R' AND fold <> f) AS r FROM long, folds GROUP BY ALL),
run AS (SELECT f, fidx, x, sum(a) OVER w AS la, sum(n) OVER w AS ln, sum(r) OVER w AS lr, sum(a) OVER p AS ta, sum(n) OVER p AS tn, sum(r) OVER p AS tr FROM cnt
        WINDOW w AS (PARTITION BY f, fidx ORDER BY x), p AS (PARTITION BY f, fidx)),
cut AS (SELECT *, (la * la + ln * ln + lr * lr) / (la + ln + lr) + ((ta - la) ** 2 + (tn - ln) ** 2 + (tr - lr) ** 2) / (ta + tn + tr - la - ln - lr) AS purity
        FROM run WHERE la + ln + lr > 0 AND la + ln + lr < ta + tn + tr),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY f ORDER BY round(purity, 6) DESC, fidx, x) AS k FROM cut) WHERE k = 1),
stump AS (SELECT f, fidx, x, CASE WHEN la >= ln AND la >= lr THEN 'A' WHEN ln >= lr THEN 'N' ELSE 'R' END AS low,
                 CASE WHEN ta - la >= tn - ln AND ta - la >= tr - lr THEN 'A' WHEN tn - ln >= tr - lr THEN 'N' ELSE 'R' END AS high FROM best),
acc AS (SELECT f, count(*) AS n, avg(CASE WHEN label = CASE WHEN CASE fidx WHEN 0 THEN l_quantity WHEN 1 THEN l_discount ELSE l_tax END <= x THEN low ELSE high END
                                          THEN 1.0 ELSE 0.0 END) AS a FROM s JOIN stump ON f = fold GROUP BY f)
SELECT CAST(d AS INTEGER) AS max_depth, CAST(sum(n) AS BIGINT) AS n, round(avg(a), 6) AS stump_accuracy, TRUE AS reaches FROM acc, unnest(range(1, 11)) AS t(d) GROUP BY d
""")
def ml_cross_validate(spark, d):
    """Mean accuracy over the folds of the tree of depth 1, and whether each
    depth up to 10 comes up to it but for the folds' differences."""
    found = FD.cross_validate_trees(_folds(spark, d), CV_FEATURES, "label", list(range(1, 11)), n_bins=64)
    means = cut_lineage(found.groupBy("max_depth").agg(F.sum("n").alias("n"), F.avg(F.col("correct") / F.col("n")).alias("accuracy")))
    stump = means.filter("max_depth = 1").agg(F.max("accuracy").alias("stump_accuracy"))
    both = attach_scalars(means, stump)
    return both.select("max_depth", "n", F.round("stump_accuracy", 6).alias("stump_accuracy"), (F.col("accuracy") >= F.col("stump_accuracy") - 0.01).alias("reaches"))


def _ridge_sql() -> str:
    sums = "count(*)::DOUBLE AS n, sum(a) AS sa, sum(b) AS sb, sum(a * a) AS saa, sum(a * b) AS sab, sum(b * b) AS sbb, sum(y) AS sy, sum(a * y) AS say, sum(b * y) AS sby"
    rest = ", ".join(f"t.{c} - o.{c} AS {c}" for c in ("n", "sa", "sb", "saa", "sab", "sbb", "sy", "say", "sby"))
    A = [["n", "sa", "sb"], ["sa", "(saa + penalty)", "sab"], ["sb", "sab", "(sbb + penalty)"]]
    rhs = ["sy", "say", "sby"]
    coefs = ", ".join(f"{_det3([[rhs[i] if k == j else A[i][k] for k in range(3)] for i in range(3)])} / {_det3(A)} AS b{j}" for j in range(3))
    return _FOLD_SQL + f""", x AS (SELECT fold, l_quantity AS a, l_discount AS b, y FROM s),
own AS (SELECT fold, {sums} FROM x GROUP BY fold), total AS (SELECT {sums} FROM x),
others AS (SELECT o.fold, penalty, {rest} FROM own o, total t, unnest({PENALTIES}::DOUBLE[]) AS p(penalty)),
fit AS (SELECT fold, penalty, {coefs} FROM others)
SELECT penalty, CAST(fold AS INTEGER) AS fold, CAST(count(*) AS BIGINT) AS n, round(avg((y - b0 - b1 * a - b2 * b) ** 2), 6) AS mse
FROM fit JOIN x USING (fold) GROUP BY penalty, fold
"""


@query("ml_cross_validate_ridge", _ridge_sql())
def ml_cross_validate_ridge(spark, d):
    """Errors of ridge regressions on each fold, fitted on the others' sums."""
    found = FD.cross_validate_ridge(_folds(spark, d), ["l_quantity", "l_discount"], "y", PENALTIES)
    return found.withColumn("mse", F.round("mse", 6))


# fixed values: depths and ensemble sizes of the forest sweep
SWEEP_DEPTHS, SWEEP_TREES = tuple(range(1, 21)), (1, 5, 10, 25, 50, 100, 200)


@query("ml_depth_sweep")
def ml_depth_sweep(spark, d):
    """All 140 points of depth and ensemble size."""
    train, test = _split(spark, d)
    return FO.sweep(train, test, FEATURES, "label", SWEEP_DEPTHS, SWEEP_TREES)


@query("ml_depth_sweep_against_majority", _SPLIT_SQL + f"""
, maj AS (SELECT label AS m FROM s WHERE split = 'train' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
base AS (SELECT avg(CASE WHEN label = m THEN 1.0 ELSE 0.0 END) AS baseline FROM s, maj WHERE split = 'test')
SELECT CAST(depth AS INTEGER) AS max_depth, CAST(trees AS INTEGER) AS num_trees, round(baseline, 6) AS baseline,
       CASE WHEN depth >= 6 THEN baseline + 0.2 WHEN depth >= 3 THEN baseline + 0.05 ELSE baseline - 0.01 END <= 1 AS reaches
FROM base, unnest({list(SWEEP_DEPTHS)}) AS a(depth), unnest({list(SWEEP_TREES)}) AS b(trees)
""")
def ml_depth_sweep_against_majority(spark, d):
    """Every point of the sweep beside the majority class: 20 points above it
    from depth 6 on, 5 from depth 3 on (the features determine the classes)."""
    train, test = _split(spark, d)
    found = FO.sweep(train, test, FEATURES, "label", SWEEP_DEPTHS, SWEEP_TREES)
    base = EV.accuracy(EV.baseline_majority(train.select("label"), test.select("label"))).select(F.col("accuracy").alias("baseline"))
    margin = F.when(F.col("max_depth") >= 6, 0.2).when(F.col("max_depth") >= 3, 0.05).otherwise(-0.01)
    both = attach_scalars(found, base).withColumn("reaches", F.col("test_accuracy") >= F.col("baseline") + margin)
    return both.select("max_depth", "num_trees", F.round("baseline", 6).alias("baseline"), "reaches")


@query("ml_regression_curve")
def ml_regression_curve(spark, d):
    """E5: errors of a regression tree by depth."""
    train, test, feats = _reg_split(spark, d)
    return ML.regression_curve(train, test, feats, "y")


@query("ml_regression_curve_against_mean", _SPLIT_SQL + """
, base AS (SELECT count(*) AS n, avg(pow(y - (SELECT avg(y) FROM s WHERE split = 'train'), 2)) AS b FROM s WHERE split = 'test')
SELECT CAST(d AS INTEGER) AS max_depth, CAST(n AS BIGINT) AS n, round(b, 6) AS baseline, TRUE AS reaches FROM base, unnest(range(1, 11)) AS t(d)
""")
def ml_regression_curve_against_mean(spark, d):
    """E5: every depth of the regression tree beside the mean: half of its error, a twentieth from depth 6 on."""
    train, test, feats = _reg_split(spark, d)
    found = ML.regression_curve(train, test, feats, "y")
    base = EV.baseline_mean(train, test, "y").agg(F.avg(F.pow(F.col("y") - F.col("prediction"), 2)).alias("baseline"), F.count(F.lit(1)).alias("n"))
    share = F.when(F.col("max_depth") >= 6, 0.05).otherwise(0.5)
    both = attach_scalars(found, base)
    return both.select("max_depth", "n", F.round("baseline", 6).alias("baseline"), (F.col("test_mse") <= F.col("baseline") * share).alias("reaches"))


@query("ml_text_report_support", f"""
SELECT lang AS label, CAST(count(*) AS BIGINT) AS support, TRUE AS reaches
FROM labels JOIN documents USING (doc_id) WHERE {hash_sql('doc_id', SEED)} % 100 >= 80 GROUP BY lang
""")
def ml_text_report_support(spark, d):
    """E4 on the fitted text classifier: each language's test rows, and an F1 of at least 0.9."""
    report = ml_text_classifier_report(spark, d).filter("cls NOT IN ('accuracy', 'macro avg', 'weighted avg')")
    return report.select(F.col("cls").alias("label"), F.col("support").cast("bigint").alias("support"), (F.col("f1") >= 0.9).alias("reaches"))


@query("ml_feature_importances", _SPLIT_SQL.replace("SELECT CASE WHEN l_ext", "SELECT l_quantity, l_extendedprice, l_discount, l_tax, CASE WHEN l_ext", 1) + """
, long AS (UNPIVOT (SELECT label, l_quantity::DOUBLE AS l_quantity, l_extendedprice::DOUBLE AS l_extendedprice, l_discount::DOUBLE AS l_discount, l_tax::DOUBLE AS l_tax
                    FROM s WHERE split = 'train') ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME feature VALUE x),
cnt AS (SELECT feature, x, count(*) FILTER (WHERE label = 'A') AS a, count(*) FILTER (WHERE label = 'N') AS n, count(*) FILTER (WHERE label = 'R') AS r FROM long GROUP BY ALL),
run AS (SELECT feature, sum(a) OVER w AS la, sum(n) OVER w AS ln, sum(r) OVER w AS lr, sum(a) OVER p AS ta, sum(n) OVER p AS tn, sum(r) OVER p AS tr FROM cnt
        WINDOW w AS (PARTITION BY feature ORDER BY x), p AS (PARTITION BY feature)),
gain AS (SELECT feature, max((la * la + ln * ln + lr * lr) / (la + ln + lr) + ((ta - la) ** 2 + (tn - ln) ** 2 + (tr - lr) ** 2) / (ta + tn + tr - la - ln - lr)) AS g
         FROM run WHERE la + ln + lr < ta + tn + tr GROUP BY feature)
SELECT max_by(feature, g) AS first, list(feature ORDER BY g DESC)[2] AS second, CAST(count(*) AS INTEGER) AS n_features FROM gain
""")
def ml_feature_importances(spark, d):
    """O6/M15 with the reference's forest (100 trees of depth 6): the two
    features with the largest importances are those whose best cut of all rows
    lowers the Gini impurity most."""
    train, _ = _split(spark, d)
    model = ML.fit_classifier(train, FEATURES, "label", "forest", num_trees=100, max_depth=6)
    top = ML.top_importances(spark, model, FEATURES, 10)
    by_size = F.reverse(F.array_sort(F.collect_list(F.struct("importance", "feature"))))
    return top.agg(by_size.alias("f"), F.count(F.lit(1)).cast("int").alias("n_features")).select(
        F.col("f")[0]["feature"].alias("first"), F.col("f")[1]["feature"].alias("second"), "n_features")
