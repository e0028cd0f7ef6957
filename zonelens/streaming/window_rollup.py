"""STR-1 / STR-3: observation windows on broker time, with late messages kept.

A message belongs to the 12-hour window of its broker timestamp; the answers'
own times are data only, so an answer without a time is counted like any other.
A window closes when the newest broker timestamp has passed its end by `delay_ms`.
A message that comes for a closed window is late: it is counted, written as a
correction, and added to the finished window by a merge, so no row is lost.

Each micro-batch is rolled up by itself and written as partial observations in
folders of its own.  Partials merge exactly (minima, maxima, sums and the first
arrival with its place in the order), so there is no state beside these files:

    partials/late=false/batch=N/window_end_ms=W    on time
    partials/late=true/batch=N/window_end_ms=W     corrections
    closed/batch=N/window_end_ms=W                 on-time partials merged when batch N closed W
    progress/batch=N                               newest timestamp, messages, late ones, closed up to

What a batch writes follows from the batches before it alone, and its folders
are overwritten when it is run again, so a replay changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelens.functions.timefmt import window_end_ms
from zonelens.operators.rollup import OBS_KEY, finish_rollup, flatten_measurements, merge_partials, partial_rollup
from zonelens.schemas import OBSERVATION
from zonelens.session import list_paths
from zonelens.streaming.budget import finish

WINDOW = "window_end_ms"
DELAY_MS = 3_600_000
PROGRESS = "newest_ms long, messages long, late long, closed_ms long, batch int"
_KEY = [OBSERVATION[c] for c in OBS_KEY]
_FORM = T.StructType(_KEY + [
    T.StructField("fs", T.LongType()), T.StructField("ls", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("f", T.StructType([OBSERVATION[c] for c in ("tl", "a", "c", "p")])), T.StructField("ord", T.DecimalType(38, 0)),
    T.StructField("batch", T.IntegerType()), T.StructField(WINDOW, T.LongType())])


def _read(spark: SparkSession, path: str) -> DataFrame:
    """Partials below `path` (batch and window are its folders); empty when nothing is there."""
    if not list_paths(spark, f"{path}/batch=*/{WINDOW}=*"):
        return spark.createDataFrame([], _FORM)
    return spark.read.schema(_FORM).parquet(path)


def _write(partials: DataFrame, path: str) -> None:
    (partials.sortWithinPartitions(WINDOW, "k", "d").write.mode("overwrite").partitionBy(WINDOW)
     .option("partitionOverwriteMode", "static").option("compression", "zstd").parquet(path))


def progress(spark: SparkSession, out_root: str) -> DataFrame:
    """One row per micro-batch: newest broker time, messages, late messages, time closed up to."""
    root = f"{out_root.rstrip('/')}/progress"
    if not list_paths(spark, f"{root}/batch=*"):
        return spark.createDataFrame([], PROGRESS)
    return spark.read.schema(PROGRESS).parquet(root)


def _watermark(spark: SparkSession, out_root: str, before: int) -> int | None:
    """Up to where windows had been closed before a batch."""
    return progress(spark, out_root).filter(F.col("batch") < before).agg(F.max("closed_ms")).first()[0]


def make_writer(out_root: str, delay_ms: int = DELAY_MS):
    out = out_root.rstrip("/")

    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        was = _watermark(spark, out, epoch_id)
        ms = F.unix_millis("timestamp")
        late = F.lit(False) if was is None else F.coalesce(window_end_ms(ms) <= was, F.lit(False))
        seen = Observation()
        env = batch.withColumn(WINDOW, window_end_ms(ms)).withColumn("late", late)
        env = env.observe(seen, F.max(ms).alias("newest_ms"), F.count(F.lit(1)).alias("messages"), F.count_if("late").alias("late"))
        rolled = partial_rollup(flatten_measurements(env, keep=[WINDOW, "late"]), [WINDOW, "late"]).checkpoint(eager=True)
        for name, some in (("true", rolled.filter("late")), ("false", rolled.filter("not late"))):
            _write(some.drop("late"), f"{out}/partials/late={name}/batch={epoch_id:08d}")
        got = seen.get
        now = max((t for t in (was, got.get("newest_ms") and got["newest_ms"] - delay_ms) if t is not None), default=None)
        row = (got.get("newest_ms"), got.get("messages"), got.get("late"), now)
        spark.createDataFrame([row], PROGRESS.rsplit(",", 1)[0]).coalesce(1) \
            .write.mode("overwrite").parquet(f"{out}/progress/batch={epoch_id:08d}")
        if now is not None and (was is None or now > was):
            ready = _read(spark, f"{out}/partials/late=false").filter(
                (F.col("batch") <= epoch_id) & (F.col(WINDOW) <= now) & (F.col(WINDOW) > (was if was is not None else -(1 << 62))))
            _write(merge_partials(ready, [WINDOW]), f"{out}/closed/batch={epoch_id:08d}")
    return write


def run_window_rollup(envelopes: DataFrame, out_root: str, checkpoint: str, delay_ms: int = DELAY_MS,
                      timeout_s: int | None = None) -> None:
    """Roll up a stream of decoded messages (topic, partition, offset, timestamp, measurement)."""
    from zonelens.session import checkpoint_root
    checkpoint_root(envelopes.sparkSession)
    q = (envelopes.writeStream.foreachBatch(make_writer(out_root, delay_ms))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finish(q, timeout_s)


def window_observations(spark: SparkSession, out_root: str, include_open: bool = False) -> DataFrame:
    """The finished windows with their corrections merged in: window_end_ms and the observation
    columns.  `include_open` adds what the windows still open have so far."""
    out = out_root.rstrip("/")
    parts = _read(spark, f"{out}/closed").unionByName(_read(spark, f"{out}/partials/late=true"))
    if include_open:
        closed_ms = progress(spark, out).agg(F.max("closed_ms")).first()[0]
        held = F.lit(True) if closed_ms is None else F.coalesce(F.col(WINDOW) > closed_ms, F.lit(True))
        parts = parts.unionByName(_read(spark, f"{out}/partials/late=false").filter(held))
    return finish_rollup(merge_partials(parts, [WINDOW]), [WINDOW])


def corrections(spark: SparkSession, out_root: str) -> DataFrame:
    """What late messages add to windows that were closed before they came."""
    return finish_rollup(merge_partials(_read(spark, f"{out_root.rstrip('/')}/partials/late=true"), [WINDOW]), [WINDOW])
