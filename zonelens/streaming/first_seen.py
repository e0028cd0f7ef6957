"""STR-6 / STR-8: permanent first-seen state kept by `foreachBatch`.

Each micro-batch carries NS observations of one or more windows.  For each
(provider, domain) the batch's earliest window is compared with the state:
a pair is new in window W when neither the state nor the batch has it in a
window before W.  New pairs are appended to the state table as one
directory per batch id; re-running a batch id overwrites its own directory,
so a replay after a failure leaves the state unchanged (idempotent), and
re-running an earlier window does not wipe its delta (only strictly earlier
windows suppress a pair).  The state lives in files, never in memory.

Inside a batch directory pairs are laid out by slot, a hash of the pair.  A
micro-batch reads the slots of its own pairs only (a directory prune), and the
state is reduced to the batch's pairs before anything is grouped, so a small
batch costs neither a scan nor a shuffle of the whole state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelens.operators.parking import match_providers, ns_rows
from zonelens.schemas import SEEN
from zonelens.session import checkpoint_root, list_paths
from zonelens.streaming.budget import finish


SLOTS = 64                   # fixed for a state: the layout of its files
_STORED = T.StructType([*SEEN.fields, T.StructField("batch", T.IntegerType()), T.StructField("slot", T.IntegerType())])


def slot_of(provider="provider", domain="domain") -> Column:
    return F.pmod(F.xxhash64(provider, domain), F.lit(SLOTS)).cast("int")


def read_state(spark: SparkSession, state_root: str, without_batch: int | None = None,
               slots: list[int] | None = None) -> DataFrame:
    """SRC-13: all state files, or an empty state when no batch has been written yet.

    Only a missing path means "empty"; a folder that cannot be reached raises.
    `without_batch` leaves one batch's own folder out (a replay rewrites it);
    `slots` names the slots to read.
    """
    root = state_root.rstrip("/")
    if not list_paths(spark, f"{root}/batch=*/slot=*"):
        return spark.createDataFrame([], SEEN)
    rows = spark.read.schema(_STORED).parquet(root)
    if without_batch is not None:
        rows = rows.filter(F.col("batch") != without_batch)
    if slots is not None:
        rows = rows.filter(F.col("slot").isin(slots))
    return rows.select(*SEEN.names)


def write_state(pairs: DataFrame, path: str) -> None:
    """One batch folder of the state: a file per slot."""
    (pairs.select(*SEEN.names, slot_of().alias("slot")).repartition(SLOTS, "slot").sortWithinPartitions("slot", "provider", "domain")
     .write.mode("overwrite").partitionBy("slot").option("partitionOverwriteMode", "static")
     .option("compression", "zstd").parquet(path))


def window_pairs(batch: DataFrame, providers: DataFrame, snap_col: str = "snap") -> DataFrame:
    """The pairs of a batch with the time they were first seen in each of its windows."""
    m = match_providers(ns_rows(batch), providers)
    return m.groupBy("provider", F.col("d").alias("domain"), F.col(snap_col).alias("snap")).agg(
        F.min("fs").alias("first_ms"))


def new_pairs(per: DataFrame, state: DataFrame) -> DataFrame:
    """One batch's new pairs: (provider, domain, first_snap, first_ms).

    The state is reduced to the batch's pairs first; what is grouped is no larger than the batch
    and its pairs' entries in the state.
    """
    known = state.join(per.select("provider", "domain").distinct(), ["provider", "domain"], "left_semi")
    earlier = (per.select("provider", "domain", "snap")
               .unionByName(known.select("provider", "domain", F.col("first_snap").alias("snap")))
               .groupBy("provider", "domain").agg(F.min("snap").alias("min_snap")))
    new = per.join(earlier, ["provider", "domain"]).filter(F.col("snap") == F.col("min_snap"))
    return new.select("provider", "domain", F.col("snap").alias("first_snap"), "first_ms")


def first_seen_batch(batch: DataFrame, providers: DataFrame, state: DataFrame, snap_col: str = "snap") -> DataFrame:
    return new_pairs(window_pairs(batch, providers, snap_col), state)


def make_batch_writer(state_root: str, providers: DataFrame, snap_col: str = "snap"):
    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        # the batch's pairs are read for their slots, for the reduction and for the result
        per = window_pairs(batch, providers, snap_col).checkpoint(eager=True)
        slots = [r.slot for r in per.select(slot_of().alias("slot")).distinct().collect()]         # SLOTS rows at most
        state = read_state(spark, state_root, without_batch=epoch_id, slots=slots)
        write_state(new_pairs(per, state), f"{state_root.rstrip('/')}/batch={epoch_id:08d}")
    return write


def run_first_seen(stream: DataFrame, providers: DataFrame, state_root: str, checkpoint: str,
                   snap_col: str = "snap", timeout_s: int | None = None) -> None:
    checkpoint_root(stream.sparkSession)
    q = (stream.writeStream.foreachBatch(make_batch_writer(state_root, providers, snap_col))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finish(q, timeout_s)


def final_state(spark: SparkSession, state_root: str) -> DataFrame:
    """The merged state: one row per pair, earliest window wins (AGG-10)."""
    s = read_state(spark, state_root)
    best = F.min(F.struct("first_ms", "first_snap"))
    return (s.groupBy("provider", "domain").agg(best.alias("b"))
            .select("provider", "domain", F.col("b.first_snap").alias("first_snap"),
                    F.col("b.first_ms").alias("first_ms")))


def compact_state(spark: SparkSession, state_root: str, out_path: str) -> None:
    """Merge all batch directories into one at a new path (SNK-8), in the layout of a batch; the
    caller then points the stream at it (as `batch=00000000` of a fresh state root)."""
    write_state(final_state(spark, state_root), out_path)
