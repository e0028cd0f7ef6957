"""Prefix trie of conversations, rolled up by centroid decomposition.

Every distinct sequence of first d turns is a node; its parent is the sequence
without its last turn, so the parent edges form a forest with the textless root
on top.  Subtree totals are rolled up without walking the forest level by level
(a single long conversation is a path as deep as it has turns):

* A component starts as the whole forest.  Its node weights are the numbers of
  conversations through a node, so the weight below a node, the sum over its
  conversations of the turns from there on, is known from one aggregation.
* The centroid of a component is the deepest node that more than half of the
  component's weight lies at or below.  The nodes above it with more than half
  are exactly its path to the component's top, so a node tells by its own weight
  whether it is on that path.
* The component splits into the parts below the centroid's children and the part
  above.  The centroid's total is the sum of what lies at or below it in the
  component; that total is added along the path to the top, and the weight of
  the path nodes drops by the centroid's.
* Every part weighs half of its component at most, so the rounds grow with the
  logarithm of the corpus, whatever the depth.

Components of more than `task_nodes` nodes are split by Spark jobs: a
conversation through a node names the node's ancestor at any depth, so which
child of the centroid a node lies below is one join with the prefix table.
Smaller components are streamed to tasks, a bounded number of nodes at a time,
and split by the same rule in numpy.

Nodes are told apart by 128-bit digests of their turns: two lanes of 64 bits,
each the sum of a turn's digest times a power of an odd number that its place
sets.  Such sums are a prefix scan: turns are dealt by ranges of (conversation,
turn), so a conversation with a third of all turns is spread over many tasks;
each task numbers and sums its stretch, and the few conversations that cross a
boundary of tasks get their offsets from a table of at most two rows per task and
conversation.  What is dealt are rows of about 40 bytes without texts.

Defined results: a NULL conv_id is no conversation; turns are ordered by turn
(NULL first), ties by the digest of role and text; a NULL role or text is empty;
repeated rows are turns each; an empty table has no nodes, not even the root;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelens.llm.common import written

ROOT = bytes(16)
TASK_NODES = 1 << 16
_U = np.uint64
BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)         # odd: every power has an inverse


def powers(base: int, exponents: np.ndarray) -> np.ndarray:
    """base ** exponents modulo 2^64."""
    out, square, left = np.ones(len(exponents), _U), base, exponents.astype(_U)
    while left.any():
        out[(left & _U(1)) > 0] *= _U(square)
        square, left = square * square % (1 << 64), left >> _U(1)
    return out


TURNS = "conv_id long, task int, at long, chars long, sums binary, before binary"


def _lanes(sums: np.ndarray) -> pa.Array:
    """Rows of two 64-bit lanes as 16-byte values."""
    raw = np.ascontiguousarray(sums).tobytes()
    return pa.Array.from_buffers(pa.binary(16), len(sums), [None, pa.py_buffer(raw)]).cast(pa.binary())


def _unlaned(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), _U).reshape(-1, 2)


def _scan(batches):
    """Number the turns of each conversation's stretch in this task and sum their digests."""
    task = TaskContext.get().partitionId()
    conv, at, held = None, 0, np.zeros(2, _U)
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("conv_id").to_numpy()
        first = np.concatenate([[ids[0] != conv], ids[1:] != ids[:-1]])
        begin = np.flatnonzero(np.concatenate([[True], first[1:]]))              # runs inside the batch
        size = np.diff(np.concatenate([begin, [len(ids)]]))
        carried = not first[0]
        place = np.arange(len(ids)) - np.repeat(begin, size) + 1
        if carried:
            place[:size[0]] += at
        keys = _unlaned(batch.column("key"))
        terms = np.stack([keys[:, k] * powers(BASE[k], place) for k in (0, 1)], 1)
        run = np.cumsum(terms, axis=0, dtype=_U)
        start = np.concatenate([np.zeros((1, 2), _U), run])[begin]                 # what came before each run
        if carried:
            start[0] -= held
        sums = run - np.repeat(start, size, axis=0)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array(np.full(len(ids), task), pa.int32()), pa.array(place), batch.column("chars"),
             _lanes(sums), _lanes(sums - terms)], names=["conv_id", "task", "at", "chars", "sums", "before"])
        conv, at, held = ids[-1], int(place[-1]), sums[-1]


def _shifted(crossing: dict):
    """Places and sums of the stretches that go on a conversation begun in another task."""
    def run(batches):
        for batch in batches:
            ids, tasks = batch.column("conv_id").to_numpy(), batch.column("task").to_numpy()
            at = batch.column("at").to_numpy().copy()
            sums, before = _unlaned(batch.column("sums")).copy(), _unlaned(batch.column("before")).copy()
            for i in np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (tasks[1:] != tasks[:-1])])) if len(ids) else []:
                found = crossing.get((int(tasks[i]), int(ids[i])))
                if found:
                    rows = slice(i, i + int(np.argmin(np.concatenate([(ids[i:] == ids[i]) & (tasks[i:] == tasks[i]), [False]]))))
                    offset, earlier = found
                    at[rows] += offset
                    factor = np.array([pow(b, offset, 1 << 64) for b in BASE], _U)
                    sums[rows] = sums[rows] * factor + np.array(earlier, _U)
                    before[rows] = before[rows] * factor + np.array(earlier, _U)
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("task"), pa.array(at), batch.column("chars"),
                                              _lanes(sums), _lanes(before)], names=["conv_id", "task", "at", "chars", "sums", "before"])
    return run


def positions(conversations: DataFrame) -> DataFrame:
    """The turns in their order: conv_id, at (from 1), chars, and the digests of the conversation up
    to the turn (`sums`) and up to the one before (`before`)."""
    spark = conversations.sparkSession
    said = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
                                F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.filter("conv_id is not null").select("conv_id", "turn", F.unhex(F.md5(said.cast("binary"))).alias("key"),
                                                     F.length("text").cast("long").alias("chars"))
    order = ["conv_id", "turn", "key"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "key", "chars")
    turns = written(spark, dealt.mapInArrow(_scan, TURNS), "trie-scan")
    stretches = turns.groupBy("conv_id", "task").agg(F.max("at").alias("n"), F.max_by("sums", "at").alias("sums"))
    several = stretches.groupBy("conv_id").agg(F.count(F.lit(1)).alias("tasks")).filter("tasks > 1").select("conv_id")
    crossing: dict = {}
    # conversations that cross a boundary: one per boundary, so at most two rows per task
    for row in stretches.join(several, "conv_id").orderBy("conv_id", "task").collect():
        own = np.frombuffer(row.sums, _U)
        offset, earlier = crossing.get(("next", row.conv_id), (0, (0, 0)))
        if offset:
            crossing[(row.task, row.conv_id)] = (offset, earlier)
        total = tuple((e + pow(b, offset, 1 << 64) * int(o)) % (1 << 64) for e, b, o in zip(earlier, BASE, own))
        crossing[("next", row.conv_id)] = (offset + row.n, total)
    crossing = {k: v for k, v in crossing.items() if k[0] != "next"}
    return turns.mapInArrow(_shifted(crossing), TURNS) if crossing else turns


def paths_of(turns: DataFrame) -> DataFrame:
    """One row per conversation and depth: its node there, the node above and the conversation's length."""
    length = turns.groupBy("conv_id").agg(F.max("at").alias("length"))
    deep = (turns.join(length.withColumnRenamed("conv_id", "_id"), F.col("conv_id") == F.col("_id"))
            .select("conv_id", F.col("at").alias("depth"), F.col("sums").alias("node"), F.col("before").alias("parent"), "chars", "length"))
    return deep.unionByName(_roots(length))


def _roots(length: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    return length.select("conv_id", zero.alias("depth"), F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"),
                         zero.alias("chars"), "length")


def _moved(batches):
    """Digests of a conversation whose first turns were exchanged: own x factor + what is ahead."""
    for batch in batches:
        gap = batch.column("gap").to_numpy()
        ahead, skipped = _unlaned(batch.column("ahead")), _unlaned(batch.column("skipped"))
        # places move down by `gap`: multiply by the inverse power
        factor = np.stack([powers(pow(b, -1, 1 << 64), gap) for b in BASE], 1)
        cols = [_lanes((_unlaned(batch.column(c)) - skipped) * factor + ahead) for c in ("sums", "before")]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv_id", "depth")), *cols, batch.column("chars"),
                                          batch.column("length")], names=["conv_id", "depth", "node", "parent", "chars", "length"])


PATHS = "conv_id long, depth long, node binary, parent binary, chars long, length long"


def rebuilt_paths(turns: DataFrame, head, base, most: int) -> DataFrame:
    """`paths_of` conversations whose first `head` turns (an expression over conv_id, `most` at most) are
    replaced by those of the conversation `base` (another): all if it has fewer, none if it is absent."""
    ids = turns.groupBy("conv_id").agg(F.max("at").alias("own"))
    plan = ids.select("conv_id", "own", head.cast("long").alias("h"), base.alias("b"))
    heads = turns.filter(F.col("at") <= most)                  # the few turns that may be lent or skipped
    lent = heads.join(plan.filter("h > 0").select(F.col("conv_id").alias("to"), "h", "b"),
                      (F.col("conv_id") == F.col("b")) & (F.col("at") <= F.col("h"))).select("to", "at", "chars", "sums", "before")
    # what lies ahead of a conversation's own rest, and what it leaves out
    taken = lent.groupBy(F.col("to").alias("t_id")).agg(F.max("at").alias("taken"), F.max_by("sums", "at").alias("ahead"))
    left = (heads.join(plan.select(F.col("conv_id").alias("l_id"), "h"), (F.col("conv_id") == F.col("l_id")) & (F.col("at") == F.col("h")))
            .select("l_id", F.col("sums").alias("skipped")))
    plan = (plan.join(taken, F.col("conv_id") == F.col("t_id"), "left").join(left, F.col("conv_id") == F.col("l_id"), "left")
            .select("conv_id", "h", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), F.coalesce("ahead", F.lit(ROOT)).alias("ahead"),
                    F.coalesce("skipped", F.lit(ROOT)).alias("skipped"),
                    (F.coalesce("taken", F.lit(0)) + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")))
    plan = written(turns.sparkSession, plan, "trie-plan")
    own = (turns.join(plan.withColumnRenamed("conv_id", "p_id"), (F.col("conv_id") == F.col("p_id")) & (F.col("at") > F.col("h")))
           .select("conv_id", (F.col("at") - F.col("h") + F.col("taken")).alias("depth"), (F.col("h") - F.col("taken")).alias("gap"),
                   "sums", "before", "ahead", "skipped", "chars", "length"))
    first = (lent.join(plan.select(F.col("conv_id").alias("p_id"), "length"), F.col("to") == F.col("p_id"))
             .select(F.col("to").alias("conv_id"), F.col("at").alias("depth"), F.col("sums").alias("node"),
                     F.col("before").alias("parent"), "chars", "length"))
    return own.mapInArrow(_moved, PATHS).unionByName(first).unionByName(_roots(plan.select("conv_id", "length")))


def _chunks(batches):
    """Runs of one node's ids as comma-joined text, in pieces of bounded size."""
    rows: list = []
    node, ids = None, []

    def out():
        table = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()),
                                            pa.array([r[2] for r in rows], pa.string())], names=["node", "first", "ids"])
        rows.clear()
        return table
    for batch in batches:
        for n, c in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
            if n != node or len(ids) >= 4096:
                if ids:
                    rows.append((node, ids[0], ",".join(map(str, ids))))
                node, ids = n, []
            ids.append(c)
        if len(rows) >= 1000:
            yield out()
    if ids:
        rows.append((node, ids[0], ",".join(map(str, ids))))
    if rows:
        yield out()


def _digests(batches):
    rows: list = []
    node, sha = None, None

    def out():
        table = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()),
                                            pa.array([r[1] for r in rows], pa.string())], names=["node", "ends_sha256"])
        rows.clear()
        return table
    for batch in batches:
        for n, text in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if n != node:
                if sha is not None:
                    rows.append((node, sha.hexdigest()))
                node, sha = n, hashlib.sha256()
                sha.update(text.encode())
            else:
                sha.update(f",{text}".encode())
        if len(rows) >= 10_000:
            yield out()
    if sha is not None:
        rows.append((node, sha.hexdigest()))
    if rows:
        yield out()


def end_digests(paths: DataFrame) -> DataFrame:
    """node, ends_sha256 of the conversations that end there.  Ranges of (node, id) join ids to
    pieces, so a node where very many end is split; its pieces, a four-thousandth of the rows,
    are then digested in order."""
    ends = paths.filter("depth = length").select("node", "conv_id")
    pieces = (ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
              .mapInArrow(_chunks, "node binary, first long, ids string"))
    return (pieces.repartition("node").sortWithinPartitions("node", "first").select("node", "ids")
            .mapInArrow(_digests, "node binary, ends_sha256 string"))


def _tops(parent: np.ndarray) -> np.ndarray:
    """The top of every node, by doubling the steps taken."""
    at = np.where(parent < 0, np.arange(len(parent)), parent)
    while True:
        to = at[at]
        if np.array_equal(to, at):
            return at
        at = to


def centroid_roll_up(parent: np.ndarray, weight: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Subtree totals of `own` (a row per node) over a forest.  `parent`: index or -1; `weight`:
    sum of positive node weights at or below each node."""
    alive, live = np.arange(len(parent)), np.asarray(parent).copy()
    weight, added, total = weight.copy(), np.zeros_like(own), np.zeros_like(own)
    top = _tops(live)
    while len(alive):
        heavy = alive[2 * weight[alive] > weight[top[alive]]]
        heavy = heavy[np.lexsort((weight[heavy], top[heavy]))]
        least = np.concatenate([[True], top[heavy][1:] != top[heavy][:-1]])
        centroid = np.full(len(live), -1)
        centroid[top[heavy[least]]] = heavy[least]                 # by the component's top
        chosen, of = heavy[least], top.copy()
        cut = alive[live[alive] == centroid[of[alive]]]
        cut = cut[live[cut] >= 0]
        above = heavy[~least]                                      # the path from the centroid to the top
        hung = live[cut]
        live[cut] = -1
        live[chosen] = -1
        alive = np.setdiff1d(alive, chosen, assume_unique=True)
        top = _tops(live)
        sums = np.zeros_like(own)
        np.add.at(sums, top[alive], own[alive])
        at_or_below = np.zeros_like(own)
        at_or_below[chosen] = own[chosen]
        np.add.at(at_or_below, hung, sums[cut])
        total[chosen] = added[chosen] + at_or_below[chosen]
        mine = centroid[of[above]]
        added[above] += at_or_below[mine]
        weight[above] -= weight[mine]
    return total


VALUES = ["n_leaves", "saved_tokens"]
TOTALS = "node binary, " + ", ".join(f"{v} long" for v in VALUES)


def _finish(limit: int):
    """Whole components of a partition, about `limit` nodes at a time."""
    def solve(table: pa.Table) -> pa.RecordBatch:
        node = table.column("node").combine_chunks()
        parent = pc.fill_null(pc.index_in(table.column("parent").combine_chunks(), value_set=node), -1).to_numpy(zero_copy_only=False)
        own = np.stack([table.column(v).to_numpy() for v in VALUES], 1)
        added = np.stack([table.column(f"{v}_added").to_numpy() for v in VALUES], 1)
        total = centroid_roll_up(parent.astype(np.int64), table.column("weight").to_numpy(), own) + added
        return pa.RecordBatch.from_arrays([node, *(pa.array(total[:, k]) for k in range(len(VALUES)))], names=["node", *VALUES])

    def run(batches):
        held: list = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if size >= limit:                        # close at the last change of component
                comp = batch.column("comp")
                same = pc.equal(comp, held[-1].column("comp")[-1]).to_numpy(zero_copy_only=False)
                change = int(np.argmin(same)) if not same.all() else len(same)
                held.append(batch.slice(0, change))
                size += change
                if change < batch.num_rows:
                    yield solve(pa.Table.from_batches(held))
                    held, size = [batch.slice(change)], batch.num_rows - change
            else:
                held.append(batch)
                size += batch.num_rows
        if held:
            yield solve(pa.Table.from_batches(held))
    return run


def _split(open_: DataFrame, large: DataFrame, paths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round over the large components: (their parts, the totals of their centroids)."""
    rows = open_.join(large, "comp")
    chosen = (rows.filter("2 * weight > whole").groupBy(F.col("comp").alias("of"))
              .agg(F.min_by(F.struct("node", "depth", "weight"), "weight").alias("c"))
              .select("of", F.col("c.node").alias("c_node"), F.col("c.depth").alias("c_depth"), F.col("c.weight").alias("c_weight")))
    rows = rows.join(chosen, F.col("comp") == F.col("of"))
    step = paths.select(F.col("conv_id").alias("p_conv"), F.col("depth").alias("p_depth"), F.col("node").alias("child"),
                        F.col("parent").alias("p_parent"))
    rows = rows.join(step, (F.col("conv_id") == F.col("p_conv")) & (F.col("c_depth") + 1 == F.col("p_depth"))
                     & (F.col("depth") > F.col("c_depth")) & (F.col("p_parent") == F.col("c_node")), "left")
    is_c = F.col("node") == F.col("c_node")
    rows = written(rows.sparkSession, rows.withColumn("below", F.col("child").isNotNull() | is_c)
                   .withColumn("above", ~is_c & F.col("child").isNull() & (2 * F.col("weight") > F.col("whole")))
                   .select(*open_.columns, "child", "below", "above", "c_node", "c_weight"), "trie-split")
    sums = (rows.filter("below").groupBy(F.col("comp").alias("of"))
            .agg(*(F.sum(v).alias(f"{v}_sum") for v in VALUES)))
    rows = rows.join(sums, F.col("comp") == F.col("of"))
    done = rows.filter("node = c_node").select("node", *((F.col(f"{v}_added") + F.col(f"{v}_sum")).alias(v) for v in VALUES))
    parts = rows.filter("node <> c_node").withColumns(
        {"comp": F.coalesce("child", "comp"), "weight": F.col("weight") - F.when(F.col("above"), F.col("c_weight")).otherwise(0)}
        | {f"{v}_added": F.col(f"{v}_added") + F.when(F.col("above"), F.col(f"{v}_sum")).otherwise(0) for v in VALUES})
    return parts.select(*open_.columns), done


def subtree_totals(nodes: DataFrame, paths: DataFrame, task_nodes: int = TASK_NODES) -> DataFrame:
    """node and the sums of VALUES over its subtree.  `nodes`: node, parent, depth, conv_id (of any
    conversation through it), weight (at or below it), VALUES; `paths`: the prefix table."""
    spark = nodes.sparkSession
    open_ = nodes.select("node", "parent", "depth", "conv_id", F.lit(ROOT).alias("comp"), "weight", *VALUES,
                         *(F.lit(0).cast("long").alias(f"{v}_added") for v in VALUES))
    finished: list[DataFrame] = []
    while True:
        open_ = written(spark, open_, "trie-open")
        sizes = written(spark, open_.groupBy("comp").agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("whole")), "trie-sizes")
        large = sizes.filter(F.col("n") > task_nodes)
        more = not large.isEmpty()
        small = open_.join(sizes.filter(F.col("n") <= task_nodes).select("comp"), "comp", "left_semi") if more else open_
        columns = ["comp", "node", "parent", "weight", *VALUES, *(f"{v}_added" for v in VALUES)]
        finished.append(small.select(*columns).repartition("comp").sortWithinPartitions("comp").mapInArrow(_finish(task_nodes), TOTALS))
        if not more:
            break
        open_, done = _split(open_, large.select("comp", "whole"), paths)
        finished.append(done)
    out = finished[0]
    for part in finished[1:]:
        out = out.unionByName(part)
    return out


def prefix_trie(paths: DataFrame, task_nodes: int = TASK_NODES) -> DataFrame:
    """One row per node of the conversations in `paths`: node, conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = paths.sparkSession
    paths = written(spark, paths, "trie-paths")
    nodes = written(spark, paths.groupBy("node").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight")), "trie-nodes")
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("above")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = written(spark, nodes.join(children, F.col("node") == F.col("above"), "left").drop("above")
                    .withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
                    .withColumn("n_leaves", (F.col("n_children") == 0).cast("long"))
                    .withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("chars")), "trie-counted")
    totals = subtree_totals(nodes, paths, task_nodes)
    upper = nodes.filter("n_children > 0").select(F.col("node").alias("p_node"), F.col("conv_id").alias("parent_conv_id"))
    none = hashlib.sha256(b"").hexdigest()
    return (nodes.drop("n_leaves", "saved_tokens")
            .join(totals.withColumnRenamed("node", "t_node"), F.col("node") == F.col("t_node"))
            .join(end_digests(paths).withColumnRenamed("node", "e_node"), F.col("node") == F.col("e_node"), "left")
            .join(upper, F.col("parent") == F.col("p_node"), "left")
            .select("node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", *VALUES,
                    F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")))


def conversation_trie(conversations: DataFrame, task_nodes: int = TASK_NODES) -> DataFrame:
    """The trie of conversations as they are."""
    return prefix_trie(paths_of(written(conversations.sparkSession, positions(conversations), "trie-turns")), task_nodes)
