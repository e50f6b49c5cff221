"""Forest grids by one fit.

Features are binned once, and rows that fall in the same bins are one *cell*
with a count for each class, so the work of a fit follows the cells, which the
bins bound (``MAX_CELLS``), and not the rows. ``grow`` grows every tree level
by level to the largest depth: a task takes one tree, draws Poisson(1) weights
of the rows (for a cell: Poisson of its counts) and chooses each node's
features by a hash of seed, tree and node. Nothing that a node does depends on
how deep the tree will grow or on how many trees there are, so the tree cut at a
depth is the tree of that depth, and the first trees are the smaller forest.
``sweep`` scores all depths and ensemble sizes in one pass over the cells.

The node table has a row for each node: ``tree``, ``node`` (1 is the root,
children of n are 2n and 2n + 1), ``depth``, ``feature`` and ``bin`` (null: a
leaf; rows up to the bin go to 2n) and ``shares``, the classes' shares, which
are what the tree predicts where it is cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.knn import write_queries
from tidewater.session import cut_lineage, shared_file, ship_package

#: Cells that a task holds; the product of the features' bins must not be over it.
MAX_CELLS = 1 << 22
_BLOCK = 20_000  # cells scored at a time


def bin_edges(df: DataFrame, features: list[str], n_bins: int = 32) -> list[list[float]]:
    """Upper edges of each feature's bins but the last: all values of a feature
    that has at most ``n_bins``, else approximate quantiles. Nulls are left out."""
    shares = [i / n_bins for i in range(1, n_bins)]
    x = {f: F.col(f).cast("double") for f in features}
    found = df.agg(*[F.percentile_approx(x[f], shares, 10_000).alias(f) for f in features], *[F.max(x[f]).alias(f"{f}_max") for f in features],
                   *[F.approx_count_distinct(x[f]).alias(f"{f}_n") for f in features]).first()
    values = {f: found[f] or [] for f in features}
    for f in features:
        if found[f"{f}_n"] <= n_bins + n_bins // 4:  # the estimate may be a little off
            few = [r[0] for r in df.select(x[f].alias("x")).filter("x IS NOT NULL").distinct().limit(n_bins + 1).collect()]
            values[f] = few if len(few) <= n_bins else values[f]
    return [sorted({e for e in values[f] if e < found[f"{f}_max"]}) for f in features]


def _bin(x: Column, edges: list[float]) -> Column:
    return F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges]).cast("array<double>"), lambda e: e < x.cast("double")))


def cells_by(df: DataFrame, features: list[str], edges: list[list[float]], others: list, sums: list[Column]) -> DataFrame:
    """b0, b1, … (bins) and the sums, over ``others``, of the rows of each cell."""
    most = int(np.prod([len(e) + 1 for e in edges], dtype=np.float64))
    if most > MAX_CELLS:
        raise ValueError(f"{most} cells of bins are over {MAX_CELLS}: take fewer bins, or a forest of pyspark.ml")
    binned = df.dropna(subset=features).select(*[_bin(F.col(f), e).alias(f"b{i}") for i, (f, e) in enumerate(zip(features, edges))], *others)
    return binned.groupBy(*[f"b{i}" for i in range(len(features))]).agg(*sums)


def cells(df: DataFrame, features: list[str], label: str, classes: list[str], edges: list[list[float]]) -> DataFrame:
    """b0, b1, … (bins) and c0, c1, … (rows of each class); rows with a null
    feature or another label are left out."""
    sums = [F.count_if(F.col("_label") == c).alias(f"c{k}") for k, c in enumerate(classes)]
    return cells_by(df.filter(F.col(label).isin(classes)), features, edges, [F.col(label).alias("_label")], sums)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shift and multiply)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def chosen_features(seed: int, tree: int, nodes: np.ndarray, n_features: int, n_chosen: int) -> np.ndarray:
    """(nodes × features): whether a node may split by a feature."""
    if n_chosen >= n_features:
        return np.ones((len(nodes), n_features), bool)
    start = _mix(np.array([(seed << 32) + tree], np.uint64))
    draws = _mix(_mix(nodes.astype(np.uint64)[:, None] ^ start) + np.arange(1, n_features + 1, dtype=np.uint64)[None, :])
    return draws.argsort(1, kind="stable").argsort(1, kind="stable") < n_chosen


def read_integers(files: list[str]) -> np.ndarray:
    """A written table of integers as a matrix, its rows in a fixed order."""
    parts = []
    for uri in files:
        with shared_file(uri) as file:
            t = pq.read_table(file)
            if t.num_rows:
                parts.append(np.stack([t.column(c).to_numpy() for c in t.column_names], 1).astype(np.int64))
    if not parts:
        return np.zeros((0, 0), np.int64)
    rows = np.concatenate(parts)
    return rows[np.lexsort(rows.T[::-1])]


def grow_tree(bins: np.ndarray, weights: np.ndarray, max_depth: int, seed: int, tree: int, n_chosen: int) -> Iterator[dict]:
    """Levels of a tree: arrays node, feature (-1: leaf), bin, shares."""
    n_features, n_classes = bins.shape[1], weights.shape[1]
    width = int(bins.max(initial=0)) + 1
    at = np.zeros(len(bins), np.int64)  # place of each cell's node in the level
    live = weights.sum(1) > 0
    bins, weights, at = bins[live], weights[live], at[live]
    nodes = np.array([1], np.int64)
    for depth in range(max_depth + 1):
        totals = np.stack([np.bincount(at, weights[:, c], len(nodes)) for c in range(n_classes)], 1)
        size = totals.sum(1)
        shares = totals / np.maximum(size, 1)[:, None]
        best = (shares**2).sum(1) * size  # the more, the purer
        feature, cut = np.full(len(nodes), -1), np.full(len(nodes), -1)
        if depth < max_depth:
            allowed = chosen_features(seed, tree, nodes, n_features, n_chosen)
            threshold = best + 1e-9 * np.maximum(size, 1)
            for f in range(n_features):
                counts = np.stack([np.bincount(at * width + bins[:, f], weights[:, c], len(nodes) * width).reshape(-1, width) for c in range(n_classes)], 2)
                left = np.cumsum(counts, 1)[:, :-1]
                right = totals[:, None] - left
                n_left, n_right = left.sum(2), right.sum(2)
                purity = (left**2).sum(2) / np.maximum(n_left, 1) + (right**2).sum(2) / np.maximum(n_right, 1)
                purity[(n_left == 0) | (n_right == 0) | ~allowed[:, f, None]] = -1
                if purity.shape[1]:
                    place = purity.argmax(1)
                    value = purity[np.arange(len(nodes)), place]
                    better = value > threshold
                    feature[better], cut[better], threshold[better] = f, place[better], value[better]
        yield {"node": nodes, "feature": feature, "bin": cut, "shares": shares, "depth": depth}
        inner = feature >= 0
        if not inner.any():
            return
        stays = inner[at]
        bins, weights, at = bins[stays], weights[stays], at[stays]
        high = bins[np.arange(len(at)), feature[at]] > cut[at]
        place = np.cumsum(inner) - 1  # children of the level, two for each inner node
        at = 2 * place[at] + high
        nodes = np.stack([2 * nodes[inner], 2 * nodes[inner] + 1], 1).ravel()


NODES = "tree int, node bigint, depth int, feature int, bin int, shares array<double>"


def grow(cell_table: DataFrame, n_trees: int, max_depth: int, n_chosen: int | None = None, seed: int = 7) -> DataFrame:
    """The node table of a forest (a single tree is fitted to all rows, by all
    features). Written to the shared folder, a file for each tree."""
    if max_depth > 60:
        raise ValueError("a node's number has 63 bits: max_depth is at most 60")
    spark = cell_table.sparkSession
    ship_package(spark)
    n_features = sum(c.startswith("b") for c in cell_table.columns)
    files = write_queries(cell_table)
    chosen = n_features if n_trees == 1 else n_chosen or max(1, int(np.sqrt(n_features)))

    def run(batches):
        for batch in batches:
            for tree in batch.column(0).to_pylist():
                rows = read_integers(files)
                if not len(rows):
                    continue
                bins, counts = rows[:, :n_features], rows[:, n_features:]
                weights = counts if n_trees == 1 else np.random.default_rng([seed, tree]).poisson(counts)
                for level in grow_tree(bins, weights.astype(np.float64), max_depth, seed, tree, chosen):
                    n, k = level["shares"].shape
                    leaf = level["feature"] < 0
                    shares = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k), pa.array(level["shares"].ravel()))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, tree, np.int32)), pa.array(level["node"]), pa.array(np.full(n, level["depth"], np.int32)),
                                                      pa.array(level["feature"].astype(np.int32), mask=leaf), pa.array(level["bin"].astype(np.int32), mask=leaf), shares],
                                                     ["tree", "node", "depth", "feature", "bin", "shares"])

    trees = spark.range(n_trees, numPartitions=n_trees)
    return cut_lineage(trees.mapInArrow(run, NODES))


def _tree_files(nodes: DataFrame) -> list[str]:
    """Files of the node table in the order of their trees (``grow`` writes one a tree)."""
    rows = nodes.select("tree", F.input_file_name().alias("file")).filter("tree IS NOT NULL").groupBy("file").agg(F.min("tree").alias("tree")).collect()
    return [r["file"] for r in sorted(rows, key=lambda r: r["tree"])]


def _load(uri: str):
    """A tree's nodes in the order of their numbers, and each level's begin."""
    with shared_file(uri) as file:
        t = pq.read_table(file)
    node = t.column("node").to_numpy()
    order = np.argsort(node, kind="stable")
    shares = t.column("shares").combine_chunks()
    k = len(shares.flatten()) // max(len(shares), 1)
    feature, cut = (t.column(c).fill_null(-1).to_numpy()[order] for c in ("feature", "bin"))
    return node[order], feature, cut, shares.flatten().to_numpy().reshape(-1, k)[order]


def score(cell_table: DataFrame, nodes: DataFrame, n_classes: int, depths: list[int], sizes: list[int]) -> DataFrame:
    """(max_depth, num_trees, correct, n): rows of the cells whose class the
    forest of the first ``num_trees`` trees, cut at ``max_depth``, predicts: the
    class of the largest sum of shares, of equal ones the first."""
    files = _tree_files(nodes)
    n_features = sum(c.startswith("b") for c in cell_table.columns)
    deepest = max(depths)

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        rows = np.stack([table.column(c).to_numpy() for c in table.column_names], 1).astype(np.int64)
        correct = {(d, s): 0 for d in depths for s in sizes}
        for begin in range(0, len(rows), _BLOCK):
            bins, counts = rows[begin:begin + _BLOCK, :n_features], rows[begin:begin + _BLOCK, n_features:]
            sums = np.zeros((deepest + 1, len(bins), n_classes))
            index = np.arange(len(bins))
            for tree, uri in enumerate(files[:max(sizes)], start=1):
                node, feature, cut, shares = _load(uri)
                at, number = np.zeros(len(bins), np.int64), np.ones(len(bins), np.int64)
                for d in range(deepest + 1):
                    sums[d] += shares[at]
                    if d == deepest:
                        break
                    f = feature[at]
                    on = np.flatnonzero(f >= 0)
                    if not len(on):
                        sums[d + 1:] += shares[at]
                        break
                    number[on] = 2 * number[on] + (bins[on, f[on]] > cut[at[on]])
                    at[on] = np.searchsorted(node, number[on])
                if tree in sizes:
                    for d in depths:
                        correct[d, tree] += int(counts[index, sums[d].argmax(1)].sum())
        yield pa.RecordBatch.from_pylist([{"max_depth": d, "num_trees": s, "correct": c, "n": int(rows[:, n_features:].sum())} for (d, s), c in correct.items()],
                                         pa.schema([("max_depth", pa.int32()), ("num_trees", pa.int32()), ("correct", pa.int64()), ("n", pa.int64())]))

    found = cell_table.mapInArrow(run, "max_depth int, num_trees int, correct bigint, n bigint")
    return found.groupBy("max_depth", "num_trees").agg(F.sum("correct").alias("correct"), F.sum("n").alias("n"))


def sweep(train: DataFrame, test: DataFrame, features: list[str], label: str, depths=tuple(range(1, 21)),
          sizes=(1, 5, 10, 25, 50, 100, 200), n_bins: int = 32, seed: int = 7) -> DataFrame:
    """(max_depth, num_trees, train_accuracy, test_accuracy) of every depth and
    ensemble size by one fit. The size 1 is the first tree of the forest."""
    classes = sorted(r[0] for r in train.select(label).filter(F.col(label).isNotNull()).distinct().collect())
    if not classes:
        return train.sparkSession.createDataFrame([], "max_depth int, num_trees int, train_accuracy double, test_accuracy double")
    edges = bin_edges(train, features, n_bins)
    parts = [cut_lineage(cells(df, features, label, classes, edges)) for df in (train, test)]
    nodes = grow(parts[0], max(sizes), max(depths), seed=seed)
    spread = parts[0].sparkSession.sparkContext.defaultParallelism
    rates = [score(p.repartition(spread), nodes, len(classes), list(depths), list(sizes)).select("max_depth", "num_trees", F.round(F.col("correct") / F.col("n"), 6).alias(name))
             for p, name in zip(parts, ("train_accuracy", "test_accuracy"))]
    return rates[0].join(rates[1], ["max_depth", "num_trees"])
