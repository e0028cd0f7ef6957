"""Sinks of the pipeline.

All writers are plain DataFrameWriter calls: the tasks write in parallel,
a lost executor only re-runs its tasks, and a rewritten window replaces its
own partition only (dynamic partition overwrite).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = ["write_observations", "write_json_lines", "write_csv", "write_per_provider",
           "write_seen_state", "write_audit", "sample_first_n", "write_rows_per_group", "write_ingest", "write_clustered", "sample_decoded"]

# fixed values of the observation files
ZSTD_LEVEL = 3
ROW_GROUP_ROWS = 200_000


# point lookups filter on domain (`d`) and name server (`s`): bloom filters let
# the reader skip row groups whose min / max cannot exclude the value.  A filter
# takes up to 1 MB per column and row group, so it is worth it for large
# window files only (opt-in), not for small per-shard files.
BLOOM_COLUMNS = ("d", "s")


def _parquet(df: DataFrame, mode: str, bloom=()):
    w = (df.write.mode(mode).option("compression", "zstd")
         .option("parquet.compression.codec.zstd.level", ZSTD_LEVEL)
         .option("parquet.enable.dictionary", "true"))
    for c in bloom:
        if c in df.columns:
            w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    return w


def write_observations(obs: DataFrame, path: str, partition_cols: Sequence[str] = (),
                       mode: str = "overwrite", one_file_per_partition: bool = False,
                       bloom: bool = False) -> None:
    """SNK-1 / SNK-7: zstd-3 Parquet, rows clustered by (k, d) inside each file so
    that row-group statistics skip most groups for kind / domain filters.

    No repartition by the partition columns: that would send one window to
    one task.  Each task sorts its rows by (partition columns, k, d) and
    writes one file per partition value; with dynamic overwrite only the
    windows present in `obs` are replaced.  A DataFrame without rows still
    writes a valid (empty) file.

    `bloom` adds bloom filters on `d` and `s` (for large window files).
    `one_file_per_partition` shuffles by the partition columns first; use it
    only when one partition value is bounded in size (an offset slice of a
    window, as in the per-shard archive), never for a whole window.
    """
    if one_file_per_partition and partition_cols:
        # an explicit count: AQE would otherwise coalesce a small shuffle into a
        # few tasks that then write every directory one after the other
        n = int(obs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = obs.repartition(max(n, obs.sparkSession.sparkContext.defaultParallelism), *partition_cols)
    else:
        df = obs
    df = df.sortWithinPartitions(*partition_cols, "k", "d")
    w = _parquet(df, mode, BLOOM_COLUMNS if bloom else ())
    if partition_cols:
        # whatever the session says: only the windows present in `obs` are replaced
        w = w.partitionBy(*partition_cols).option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def write_clustered(obs: DataFrame, path: str, partition_cols: Sequence[str] = (), files: int | None = None,
                    mode: str = "overwrite") -> None:
    """SNK-1 with disjoint key ranges: rows are dealt by sampled ranges of (partition columns, k, d,
    s, ip) and sorted, so the files of a window follow one another in (k, d) and a lookup of a
    domain opens one or two of them.  A kind or domain with very many rows is cut at its name
    server or address instead of filling one task.  `files`: ranges over all windows."""
    keys = [*partition_cols, "k", "d", "s", "ip"]
    n = files or int(obs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df = obs.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    w = _parquet(df, mode)
    if partition_cols:
        w = w.partitionBy(*partition_cols).option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def write_ingest(rows: DataFrame, path: str) -> None:
    """The rows of an ingest job, split by `kind`; the folder is this run's alone."""
    _parquet(rows, "overwrite").partitionBy("kind").option("partitionOverwriteMode", "static").parquet(path)


def write_rows_per_group(df: DataFrame, path: str, rows: int = ROW_GROUP_ROWS) -> None:
    """SNK-2: bounded memory per row group: at most `rows` rows in each (files may hold many)."""
    _parquet(df, "overwrite").option("parquet.block.row.count.limit", rows).parquet(path)


def write_json_lines(df: DataFrame, path: str, gzip: bool = True, mode: str = "overwrite", nulls: bool = False) -> None:
    """SNK-3: JSON lines; NULL fields are left out of each line (`nulls`: written)."""
    w = df.write.mode(mode).option("ignoreNullFields", str(not nulls).lower())
    if gzip:
        w = w.option("compression", "gzip")
    w.json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-5 / SNK-9: CSV with header (one file: these are small count tables)."""
    df.coalesce(1).write.mode(mode).option("header", True).csv(path)


def write_per_provider(delta: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """SNK-4: one output directory per provider (`provider=<name>/`).

    Spark writes no directory for a provider without rows; `jobs.run_delta`
    adds an empty Parquet file for each of them (counts come from AGG-13).
    """
    # whatever the session says: the output is this run's alone, so a provider that is no
    # longer in the result leaves nothing behind
    w = delta.write.mode(mode).partitionBy("provider").option("partitionOverwriteMode", "static")
    if fmt == "parquet":
        w.option("compression", "zstd").parquet(path)
    else:
        w.json(path)


def write_seen_state(seen: DataFrame, path: str, partitions: int | None = None) -> None:
    """SNK-8: state ordered by (provider, domain), written to a NEW path.

    Range partitioning gives globally ordered, evenly sized files (sampled
    boundaries, no single-task sort); the caller swaps the path in after the
    write succeeded, so a failed run leaves the old state intact.  The new
    path belongs to this run: a re-run after a failure overwrites its own
    partial output.
    """
    n = partitions or seen.sparkSession.sparkContext.defaultParallelism
    (seen.repartitionByRange(n, "provider", "domain").sortWithinPartitions("provider", "domain")
     .write.mode("overwrite").option("compression", "zstd").parquet(path))


def write_audit(topk: DataFrame, path: str) -> None:
    """SNK-9: audit table as zstd Parquet plus a CSV copy (lists joined)."""
    topk.write.mode("overwrite").option("compression", "zstd").parquet(path + "/topk_ns.parquet")
    flat = topk.withColumn("sample_domains", F.array_join("sample_domains", ","))
    write_csv(flat, path + "/topk_ns.csv")


def plain_values(c: Column, kind: T.DataType) -> Column:
    """A value as JSON can carry it, at any depth: binary as hex, times as ISO text."""
    if isinstance(kind, T.BinaryType):
        return F.lower(F.hex(c))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") if not isinstance(kind, T.DateType) else c.cast("string")
    if isinstance(kind, T.StructType):
        inner = F.struct(*[plain_values(c.getField(f.name), f.dataType).alias(f.name) for f in kind.fields])
        return F.when(c.isNotNull(), inner)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: plain_values(x, kind.elementType))
    return c


def sample_decoded(envelopes: DataFrame, n: int) -> DataFrame:
    """SNK-10, decoded: the first N messages of each topic with every field of the decoded message
    beside its broker time and offset.  A message that did not decode (NULL) is no sample."""
    from pyspark.sql import Window
    kind = envelopes.schema["measurement"].dataType
    w = Window.partitionBy("topic").orderBy("offset", "partition")
    r = (envelopes.filter(F.col("measurement").isNotNull()).withColumn("_rn", F.row_number().over(w))
         .filter(F.col("_rn") <= n))
    fields = [plain_values(F.col("measurement").getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
    return r.select("topic", F.unix_millis("timestamp").alias("_kafka_ts"), F.col("offset").alias("_kafka_offset"), *fields)


def sample_first_n(envelopes: DataFrame, n: int) -> DataFrame:
    """SNK-10: the first N messages of each topic, full fidelity, binary as hex.

    The ranked filter runs as a per-partition group limit before the
    shuffle, so each map task sends at most N rows per topic.
    """
    from pyspark.sql import Window
    w = Window.partitionBy("topic").orderBy("offset")
    r = envelopes.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    return r.select("topic", F.col("offset").alias("_kafka_offset"), F.col("timestamp").alias("_kafka_ts"),
                    F.hex("value").alias("value"))
