"""Prefix trie of conversations by truncation peeling.

``sequences`` orders the turns of each conversation and keeps, of a turn, the
MD5 digest of its role and text and the code points of its text; ``path`` is
the digests one after another, so that a node of the trie is a prefix of paths.
``trie`` sorts the paths over all tasks and peels each run of them (a bounded
number of rows) from its greatest depth down: conversations that end at a depth
are merged with the nodes that survived from the depth below, each node hands
its sums to its parent and is cut by its last turn, and what then has an equal
path is one node. Nodes and their sums come out of the same descent.

A node whose members all lie inside a run is finished there. Only prefixes of a
run's first or last path can go on in another run; their partial sums (at most
two for each depth and run) are peeled once more, in the same way, in one task
that holds two depths at a time.

Rows with a null conv_id belong to no conversation. A null role or text is
empty. Turns come by ``turn`` (null first), of one turn by their digest, so
repeated rows are turns of their own. An empty table has no nodes, not even a
root. A conversation is one row of 20 bytes a turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.shared import saved

DIGEST = 16
#: Bounds of a run: rows, and bytes of their paths.
RUN_ROWS, RUN_BYTES = 200_000, 32 << 20
ID_BYTES = 1 << 20  # of a list of ids in one row
NOBODY = (1 << 63) - 1

NODE = pa.schema([("kind", pa.int8()), ("key", pa.binary()), ("parent", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
                  ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("size", pa.int64()), ("ends_sha256", pa.string()),
                  ("ids", pa.binary())])
NODE_DDL = ("kind byte, key binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
            "size long, ends_sha256 string, ids binary")
FINISHED, OPEN, ENDS = 0, 1, 2
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_digest(role, text):
    """Hex MD5 of a turn; the role's length keeps role and text apart."""
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as structs of
    turn, digest and size."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn"), turn_digest(role, text).alias("digest"), F.length(text).alias("size")).alias("t"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def with_family_openings(seqs: DataFrame, family: int = 100, opening: int = 6) -> DataFrame:
    """Conversations as their family's first one opens: the first h turns of
    conversation c - c % family (none if it is absent), then c's own turns
    after its first h; h = crc32(decimal c) % opening."""
    first = seqs.filter(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, opening - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % opening).cast("int")
    own = seqs.select("conv_id", "turns", (F.col("conv_id") - F.col("conv_id") % family).alias("base"), h.alias("h"))
    head = F.when(F.col("head").isNotNull(), F.expr("slice(head, 1, h)")).otherwise(F.expr("slice(turns, 1, 0)"))
    return own.join(first, "base", "left").select("conv_id", F.concat(head, F.expr("slice(turns, h + 1, size(turns))")).alias("turns"))


def paths(seqs: DataFrame) -> DataFrame:
    """(path, conv_id, sizes): digests one after another, code points of each turn."""
    return seqs.select(F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("path"), "conv_id",
                       F.transform("turns", lambda t: t["size"].cast("int")).alias("sizes"))


class Rows:
    """Rows of NODE, handed on in batches."""

    def __init__(self):
        self.rows: list[dict] = []
        self.held = 0

    def add(self, **values) -> None:
        self.rows.append(values)
        self.held += len(values.get("ids") or b"")

    def batches(self, least: int = 1) -> Iterator[pa.RecordBatch]:
        if len(self.rows) >= least or self.held > 8 << 20:
            for i in range(0, len(self.rows), 20_000):
                yield pa.RecordBatch.from_pylist(self.rows[i:i + 20_000], NODE)
            self.rows, self.held = [], 0


def _key(path: bytes) -> bytes:
    return hashlib.md5(path).digest()


def peel_run(run: list[tuple[bytes, int]], sizes: list[np.ndarray], out: Rows) -> None:
    """Nodes of sorted (path, conv_id) rows, from the greatest depth down."""
    first, last = run[0][0], run[-1][0]

    def is_open(path: bytes) -> bool:
        return first.startswith(path) or last.startswith(path)

    ended: dict[int, list] = {}
    for path, rows in groupby(range(len(run)), key=lambda i: run[i][0]):
        rows = list(rows)
        digest = hashlib.sha256()
        if is_open(path):
            key, step = _key(path), ID_BYTES // 21
            for i in range(0, len(rows), step):
                out.add(kind=ENDS, key=key, conv_id=run[rows[i]][1], ids=",".join(str(run[r][1]) for r in rows[i:i + step]).encode())
        else:
            digest.update(",".join(str(run[r][1]) for r in rows).encode())
        ended.setdefault(len(path) // DIGEST, []).append((path, len(rows), run[rows[0]][1], rows[0], digest.hexdigest()))

    survivors: dict[bytes, list] = {}
    above: list[tuple[bytes, dict]] = []  # finished nodes whose parent's smallest member isn't known yet
    for depth in range(max(ended), -1, -1):
        for path, n, least, row, digest in ended.get(depth, ()):
            node = survivors.setdefault(path, [0, NOBODY, 0, 0, 0, row, NO_ENDS])
            node[0] += n
            node[1] = min(node[1], least)
            node[6] = digest
        for path, values in above:
            if is_open(path):
                values["parent"] = _key(path)
            else:
                values["parent_conv_id"] = survivors[path][1]
            out.add(**values)
        above, parents = [], {}
        for path, (n, least, children, leaves, tokens, row, digest) in survivors.items():
            size = int(sizes[row][depth - 1]) if depth else 0
            up = parents.setdefault(path[:-DIGEST], [0, NOBODY, 0, 0, 0, row, NO_ENDS]) if depth else None
            if is_open(path):
                out.add(kind=OPEN, key=_key(path), parent=_key(path[:-DIGEST]) if depth else None, depth=depth, conv_id=least, n_convs=n, n_children=children, n_leaves=leaves,
                        saved_tokens=tokens, size=size)
                continue
            leaves, tokens = leaves or 1, tokens + (n - 1) * size
            above.append((path[:-DIGEST], dict(kind=FINISHED, depth=depth, conv_id=least, n_convs=n, n_children=children, n_leaves=leaves, saved_tokens=tokens, ends_sha256=digest)))
            up[0] += n
            up[1] = min(up[1], least)
            up[2] += 1
            up[3] += leaves
            up[4] += tokens
        survivors = parents


def _runs(batches, run_rows: int):
    """Finished nodes, open nodes and the ids that end at open nodes, run by run."""
    out, run, sizes, held = Rows(), [], [], 0
    for batch in batches:
        lists = batch.column("sizes")
        values, at = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
        for i, (path, conv) in enumerate(zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist(), strict=True)):
            run.append((path, conv))
            sizes.append(values[at[i]:at[i + 1]])
            held += len(path)
            if len(run) >= run_rows or held >= RUN_BYTES:
                peel_run(run, sizes, out)
                run, sizes, held = [], [], 0
                yield from out.batches()
    if run:
        peel_run(run, sizes, out)
    yield from out.batches()


def _peel_open(batches):
    """Open nodes of all runs, by falling depth: those of one key are merged."""
    out, level, parents, above, depth = Rows(), {}, {}, [], None

    def flush():
        nonlocal level, parents, above, depth
        for parent, values in above:
            out.add(**values, parent_conv_id=level[parent][1])
        above, parents = [], {}
        for key, (n, least, children, leaves, tokens, size, parent) in level.items():
            leaves, tokens = leaves or 1, tokens + (n - 1) * size
            values = dict(kind=FINISHED, key=key, depth=depth, conv_id=least, n_convs=n, n_children=children, n_leaves=leaves, saved_tokens=tokens)
            if parent is None:
                out.add(**values)
                continue
            above.append((parent, values))
            up = parents.setdefault(parent, [0, NOBODY, 0, 0, 0, 0, None])
            for k, x in ((0, n), (2, 1), (3, leaves), (4, tokens)):
                up[k] += x
            up[1] = min(up[1], least)
        level, depth = parents, depth - 1

    for batch in batches:
        for r in batch.to_pylist():
            if depth is None:
                depth = r["depth"]
            while depth > r["depth"]:
                flush()
            node = level.setdefault(r["key"], [0, NOBODY, 0, 0, 0, 0, None])
            for k, name in ((0, "n_convs"), (2, "n_children"), (3, "n_leaves"), (4, "saved_tokens")):
                node[k] += r[name]
            node[1], node[5], node[6] = min(node[1], r["conv_id"]), r["size"], r["parent"]
        yield from out.batches(20_000)
    while depth is not None and depth >= 0:
        flush()
    yield from out.batches()


def _hash_ends(batches):
    """SHA-256 of the ids that end at each open node, in the order of the rows."""
    key, digest, rows = None, None, []
    for batch in batches:
        for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if k != key:
                if key is not None:
                    rows.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256(ids)
            else:
                digest.update(b"," + ids)
    if key is not None:
        rows.append((key, digest.hexdigest()))
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows])], ["key", "ends"])


def trie(rows: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """Nodes of (path, conv_id, sizes): conv_id (the smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    ``run_rows`` bounds the rows that a task peels at once; no result depends on it."""
    rows = saved(rows, "conversation-paths")
    order = ["path", "conv_id"]
    found = saved(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(lambda batches: _runs(batches, run_rows), NODE_DDL), "conversation-nodes")
    opened = found.filter(f"kind = {OPEN}").repartition(1).sortWithinPartitions(F.desc("depth"), "key").mapInArrow(_peel_open, NODE_DDL)
    ends = found.filter(f"kind = {ENDS}").select("key", "conv_id", "ids").repartition("key").sortWithinPartitions("key", "conv_id")
    opened = saved(opened.drop("ends_sha256").join(ends.mapInArrow(_hash_ends, "key binary, ends string"), "key", "left"), "conversation-open-nodes")

    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    finished = found.filter(f"kind = {FINISHED}")
    root = opened.filter("depth = 0").select("conv_id").scalar()
    inner = finished.filter("parent IS NULL").select(columns)
    top = finished.filter("parent IS NOT NULL AND depth = 1").withColumn("parent_conv_id", root).select(columns)
    known = opened.select(F.col("key").alias("parent"), F.col("conv_id").alias("_parent_conv"))
    rest = finished.filter("parent IS NOT NULL AND depth > 1").join(known, "parent", "left").withColumn("parent_conv_id", F.col("_parent_conv")).select(columns)
    edge = opened.withColumn("ends_sha256", F.coalesce("ends", F.lit(NO_ENDS))).select(columns)
    return inner.unionByName(top).unionByName(rest).unionByName(edge)


#: The same nodes by whole prefixes: crc32 bit by bit, nodes by grouping all
#: prefixes, subtrees by their keys.
SQL = """
WITH t AS (
    SELECT conv_id, turn, length(coalesce(text, '')) AS size, md5(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
    FROM conversations WHERE conv_id IS NOT NULL),
own AS (
    SELECT conv_id, list(digest ORDER BY turn NULLS FIRST, digest, size) AS d, list(size ORDER BY turn NULLS FIRST, digest, size) AS n,
        xor(list_reduce(list_prepend(4294967295::UBIGINT, [ascii(c)::UBIGINT FOR c IN string_split(conv_id::varchar, '')]),
            lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)::UBIGINT[]),
                lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)), 4294967295::UBIGINT) % 6 AS h
    FROM t GROUP BY conv_id),
rebuilt AS (
    SELECT o.conv_id, list_concat(coalesce(b.d[1:o.h], []), o.d[o.h + 1:]) AS d, list_concat(coalesce(b.n[1:o.h], []), o.n[o.h + 1:]) AS n
    FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100),
prefixes AS (
    SELECT conv_id, depth, array_to_string(d[1:depth], '') AS key, CASE WHEN depth = 0 THEN 0 ELSE n[depth] END AS size, depth = len(d) AS ends
    FROM (SELECT conv_id, d, n, unnest(range(0, len(d) + 1)) AS depth FROM rebuilt)),
nodes AS (
    SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS own_saved,
        sha256(coalesce(string_agg(conv_id::varchar, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM prefixes GROUP BY key, depth),
children AS (
    SELECT left(key, 32 * (depth - 1)) AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
subtrees AS (
    SELECT n.key, sum(s.own_saved) AS saved_tokens, count(*) FILTER (c.n IS NULL) AS n_leaves
    FROM nodes n JOIN nodes s ON starts_with(s.key, n.key) LEFT JOIN children c ON c.key = s.key GROUP BY n.key)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, s.n_leaves,
    s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN subtrees s USING (key) LEFT JOIN children c USING (key) LEFT JOIN nodes p ON n.depth > 0 AND p.key = left(n.key, 32 * (n.depth - 1))
"""
