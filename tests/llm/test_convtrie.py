import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidewater.llm import convtrie
from tidewater.llm.queries import QUERIES
from tests.conftest import SF001

DDL = "conv_id long, turn long, role string, text string, path string, depth int, `key` int"


def rebuilt(rows):
    """conv_id -> its rebuilt turns, in plain Python."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0), digest, role, text))
    own = {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def expected(convs):
    """Nodes by listing all prefixes of all conversations."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[c] for c in children[p]) or 1
        saved[p] = sum(saved[c] for c in children[p]) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(children[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p)).encode()).hexdigest()) for p, m in members.items())


def found(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert df.columns == columns
    return sorted(tuple(-1 if x is None else x for x in r) for r in df.collect())


def rows_of(kind):
    if kind == "edges":
        rows = [(None, 0, "user", "lost"), (None, None, None, None), (7, None, None, None), (7, 1, "user", None), (7, 1, "user", None), (8, 3, "", ""), (8, 1, "user", "x" * 50_000),
                (100, 0, "a", "bc"), (101, 0, "ab", "c"), (102, 0, "a", "bc"), (103, 0, "user", "é日\U0001d11e")]
        return rows + [(200, t, "user", f"deep {t}") for t in range(300)] + [(201, t, "user", f"deep {t}") for t in range(290)] + [(9_000_000_000, 1, "user", "far")]
    if kind == "copies":  # exact copies, shared openings, and every prefix of one conversation
        return ([(c, t, "user", f"hello {t}") for c in range(300) for t in range(4)] + [(c, t, "u", f"{t} {c % 5 if t > 2 else ''}") for c in range(1_000, 1_100) for t in range(7)]
                + [(c, t, "u", f"step {t}") for c in range(2_000, 2_030) for t in range(c - 2_000)])
    return []


@pytest.mark.parametrize("kind", ["edges", "copies", "empty"])
@pytest.mark.parametrize("run_rows", [2, 7, 200_000])
def test_trie_equals_all_prefixes(spark, kind, run_rows):
    rows = rows_of(kind)
    df = spark.createDataFrame([(*r, None, None, None) for r in rows], DDL).repartition(3)
    seqs = convtrie.with_family_openings(convtrie.sequences(df))
    assert found(convtrie.trie(convtrie.paths(seqs), run_rows)) == expected(rebuilt(rows))


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op11_truncation_peeling_trie"](spark, SF001)) == expected(rebuilt(rows))


def test_plain_sequences_without_rebuilding(spark):
    df = spark.createDataFrame([(c, t, "user", f"{t} {c // 2 if t else ''}") for c in range(6) for t in range(3)], "conv_id long, turn int, role string, text string")
    nodes = convtrie.trie(convtrie.paths(convtrie.sequences(df)))
    by_depth = {r["depth"]: r["n"] for r in nodes.groupBy("depth").agg(F.count("*").alias("n")).collect()}
    assert by_depth == {0: 1, 1: 1, 2: 3, 3: 3}
