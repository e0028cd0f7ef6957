"""The prefix trie against a dictionary of prefixes, and the rollup against plain subtree sums."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonelens.llm import trie

TURNS = "conv_id long, turn long, role string, text string, node string, depth int, weight string"


def conversations():
    r = random.Random(7)
    rows = []
    for c in range(-4, 50):
        for t in range(r.choice([1, 3, 6, 12, 40])):
            rows.append((c, t if r.random() > 0.05 else None, r.choice(["user", "assistant", None]) if t % 3 else "user",
                         r.choice(["a", "b", None, "éé"]) if t > 2 else "x"))
    rows += [(100 + k, 0, "user", "same") for k in range(40)] + [(None, 0, "user", "same")] + [(7, 2, "user", "x")] * 3
    return rows + [(500, t, "user", f"deep {t}") for t in range(300)]


def key(role, text):
    return hashlib.md5(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()


def brute(rows):
    paths = {}
    for c in {r[0] for r in rows if r[0] is not None}:
        own = sorted(((t is not None, t or 0, key(r, x), len(x or "")) for i, t, r, x in rows if i == c))
        paths[c] = [(k, n) for _, _, k, n in own]
    nodes = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            nodes.setdefault(tuple(k for k, _ in path[:d]), []).append((c, path[d - 1][1] if d else 0, d == len(path)))
    saved, leaves, kids = {}, {}, {}
    for p in nodes:
        if p:
            kids[p[:-1]] = kids.get(p[:-1], 0) + 1
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            saved[p[:d]] = saved.get(p[:d], 0) + (len(members) - 1) * members[0][1]
            leaves[p[:d]] = leaves.get(p[:d], 0) + (p not in kids)
    out = []
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c, _, end in members if end))
        out.append((min(c for c, *_ in members), len(p), min(c for c, *_ in nodes[p[:-1]]) if p else None, len(members), kids.get(p, 0),
                    leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("task_nodes", [4, 1 << 16])
def test_against_prefixes(spark, task_nodes):
    rows = conversations()
    df = spark.createDataFrame([(*r, "n", 0, "w") for r in rows], TURNS).repartition(3)
    got = trie.conversation_trie(df, task_nodes).drop("node")
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_a_long_conversation_is_spread(spark):
    """A conversation over many tasks is numbered and digested like one in a single task."""
    rows = [(c, t, "user", f"{t % 7} {c % 2}") for c in (1, 2, 3) for t in range(4000 if c == 2 else 50)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    was = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        many = trie.positions(df)
        assert many.filter("conv_id = 2").select("task").distinct().count() > 3
        many = sorted((r.conv_id, r["at"], bytes(r.sums), bytes(r.before)) for r in many.collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was)
    keys = {t: np.frombuffer(bytes.fromhex(key("user", t)), np.uint64) for t in {r[3] for r in rows}}
    at = 0
    for c, t, _, text in sorted(rows):
        if t == 0:
            sums = [0, 0]
        last = list(sums)
        sums = [(x + int(k) * pow(b, t + 1, 1 << 64)) % (1 << 64) for x, k, b in zip(sums, keys[text], trie.BASE)]
        pack = lambda v: np.array(v, np.uint64).tobytes()
        assert many[at] == (c, t + 1, pack(sums), pack(last))
        at += 1


def test_many_ends_at_one_node(spark):
    df = spark.range(20_000).select(F.col("id").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role"),
                                    F.lit("same").alias("text"))
    got = trie.conversation_trie(df).filter("depth = 1").first()
    assert got.n_convs == 20_000 and got.saved_tokens == 19_999 * 4
    assert got.ends_sha256 == hashlib.sha256(",".join(map(str, range(20_000))).encode()).hexdigest()


def test_no_conversations(spark):
    assert trie.conversation_trie(spark.createDataFrame([], TURNS)).collect() == []
    only_null = spark.createDataFrame([(None, 0, "user", "x", None, None, None)], TURNS)
    assert trie.conversation_trie(only_null).collect() == []


def test_roll_up_is_the_subtree_sum():
    r = np.random.default_rng(0)
    for _ in range(300):
        n, shape = int(r.integers(1, 60)), r.integers(3)
        parent = np.array([-1] + [i - 1 if shape == 0 else int(r.integers(0 if shape == 1 else -1, i)) for i in range(1, n)])
        weight, own = r.integers(1, 5, n), r.integers(0, 10, (n, 2))
        below, total = weight.copy(), own.copy()
        for i in range(n - 1, 0, -1):
            if parent[i] >= 0:
                below[parent[i]] += below[i]
                total[parent[i]] += total[i]
        deal = r.permutation(n)
        place = np.argsort(deal)
        mixed = np.array([place[parent[o]] if parent[o] >= 0 else -1 for o in deal])
        assert (trie.centroid_roll_up(mixed, below[deal], own[deal]) == total[deal]).all()
