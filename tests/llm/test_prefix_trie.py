import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import prefix_trie as trie
from tessera.llm.prefix_trie import TernaryTree, _middle_first

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turn_digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, turn_digest(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    return out


def brute(rows):
    convs = rebuilt(rows)
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[b] for b in below) or 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[b] for b in below)
    out = []
    for node, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(convs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(who), len(node), parent, len(who), len(children.get(node, [])), leaves[node], saved[node], sha))
    return sorted(out, key=str)


def found(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def talks(n=60, seed=12, longest=14):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(n * 2), n):
        for t in range(rng.randrange(1, longest)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["yes", "no", "é" * 3])))
    return rows


@pytest.mark.parametrize("block, run, parts", [(1024, 100_000, 3), (3, 10, 7), (1, 1, 5), (4, 25, 1)])
def test_against_brute_force(spark, monkeypatch, block, run, parts):
    """Blocks, runs and shards so small that every border case occurs."""
    monkeypatch.setattr(trie, "BLOCK", block)
    monkeypatch.setattr(trie, "RUN", run)
    monkeypatch.setattr(trie, "LISTED", 2)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = talks()
        # Copies, ties, nulls, repeated rows, a hot conversation, a pair of long equal ones, negative ids.
        rows += [(c, t, "user", f"t{t}") for c in range(200, 240) for t in range(10)]
        rows += [(301, None, None, None), (301, None, "user", "x"), (301, 0, "", ""), (302, 1, "a", "b"), (302, 1, "a", "b"), (302, 1, "b", "a")]
        rows += [(400, t, "user", str(t)) for t in range(60)] + [(c, t, "user", str(t)) for c in (405, 410) for t in range(25)]
        rows += [(-7, 0, "user", "yes"), (-5, 0, "user", "no"), (-5, 1, "user", "yes"), (None, 0, "user", "lost")]
        df = spark.createDataFrame(rows, SCHEMA).withColumns({"base": F.lit("b"), "id": F.lit(0), "n": F.lit("n")}).repartition(3)
        assert found(trie.prefix_trie(df)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_whole_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert found(trie.prefix_trie(df)) == brute(rows)


def test_empty_table_and_turnless_conversations(spark):
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    lone = [c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0][:3]
    rows = [(c, 0, "user", "gone") for c in lone]  # the family's first is absent, the own turn falls under h
    assert found(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert len(brute(rows)) == 1


def test_very_long_texts_and_conversations(spark):
    rows = [(0, t, "user", "w" * (1 + t % 3)) for t in range(2500)] + [(5, 0, "user", "é" * 300_000), (6, 0, None, "x" * 300_000)]
    assert found(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_a_hot_conversation_is_spread(spark):
    """Half of all turns in one conversation: no partition of the sorted turns holds them all."""
    rows = [(0, t, "user", str(t)) for t in range(4000)] + [(c, 0, "user", "x") for c in range(10, 4010)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        order = ["base", "own", "conv_id", F.col("turn").asc_nulls_first(), "id"]
        sizes = trie.coded_turns(df).repartitionByRange(*order).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(r["count"] for r in sizes) < 2000


def test_ternary_tree_is_balanced_by_median_insertion():
    tree = TernaryTree()
    for i in _middle_first(1000):
        tree.insert([i, 7], [1, 1])
    deepest = 0
    for start in range(1000):
        node, steps = tree.eq[0], 1
        while tree.split[node] != start:
            node, steps = (tree.lo if start < tree.split[node] else tree.hi)[node], steps + 1
        deepest = max(deepest, steps)
    assert deepest == 10 and len(tree.split) == 2001
    assert sorted(_middle_first(77)) == list(range(77))
