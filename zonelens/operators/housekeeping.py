"""Archive bookkeeping: shard slicing, expected / missing shards, row counts
per window, retention of releases and the back-fill plan.

The listings involved hold one row per file or per release (thousands, not
billions); they are still plain DataFrames so that the same plans run on a
listing of any size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelens.functions.names import (BACKFILL_TAG_PATTERN, RETENTION_DELTA_PATTERN,
                                      RETENTION_SNAP_PATTERN, file_is_sample, file_shard, file_topic)
from zonelens.functions.timefmt import WINDOW_MS, cutoff_date, from_ms, window_end_ms
from zonelens.operators.joins import broadcast_if_small

# fixed values: shards per topic in one window (three Avro topics + the certificate-log topic)
SHARD_CONFIG = [
    ("newly_issued_certificates_measurements", 3, "avro_dns"),
    ("newly_registered_fqdn_measurements", 4, "avro_dns"),
    ("newly_registered_domains_measurements", 11, "avro_dns"),
    ("certstream_domains", 2, "json"),
]


def shard_config(spark) -> DataFrame:
    return spark.createDataFrame(SHARD_CONFIG, "topic string, shards int, format string")


def assign_shards(msgs: DataFrame, config: DataFrame, window_col: str = "window_end_ms",
                  topic_col: str = "topic") -> DataFrame:
    """STR-4: contiguous offset slices per (topic, window); the last slice takes the remainder.

    start / end are the window's first offset and one past its last (with a
    Kafka source they come from the broker's offset-for-time lookup).  Both
    small sides are broadcast so the messages are never shuffled by topic
    (a handful of keys): the bounds hold one row per topic and 12-hour window
    (bounded by the configured topics and the time range, not by the data),
    and the shard configuration is size-checked.
    """
    bounds = msgs.groupBy(topic_col, window_col).agg(
        F.min("offset").alias("_start"), (F.max("offset") + 1).alias("_end"))
    cfg = broadcast_if_small(config.select(F.col("topic").alias(topic_col), "shards"))
    x = msgs.join(F.broadcast(bounds), [topic_col, window_col]).join(cfg, topic_col)
    chunk = F.floor((F.col("_end") - F.col("_start")) / F.col("shards"))
    shard = F.when(chunk == 0, F.col("shards") - 1).otherwise(
        F.least(F.floor((F.col("offset") - F.col("_start")) / chunk), F.col("shards") - 1))
    return x.withColumn("shard", shard.cast("int")).drop("_start", "_end", "shards")


def windows_spanning(df: DataFrame, ms_col: str) -> DataFrame:
    """GEN-4 helper: every 12-hour window (date, hour of its end) from the first to
    the last time in `ms_col`, including windows without any row.  One partial
    min / max per map task, then one generated row per window."""
    span = df.agg(F.min(window_end_ms(ms_col)).alias("a"), F.max(window_end_ms(ms_col)).alias("b"))
    ends = span.select(F.explode(F.sequence("a", "b", F.lit(WINDOW_MS))).alias("end_ms"))
    return ends.select(F.date_format(from_ms("end_ms"), "yyyy-MM-dd").alias("date"),
                       F.date_format(from_ms("end_ms"), "HH").alias("hour"))


def expected_shards(windows: DataFrame, config=SHARD_CONFIG) -> DataFrame:
    """SRC-16 / GEN-4: every (topic, date, hour, shard) file a complete window has.

    `config` is the parsed shard configuration (topic, shards[, format]); each
    window row generates its files, so no join is involved.
    """
    files = F.array(*[F.struct(F.lit(t).alias("topic"), F.lit(i).alias("shard"))
                      for t, n, *_ in config for i in range(int(n))])
    return windows.select("date", "hour", F.explode(files).alias("f")).select(
        F.col("f.topic").alias("topic"), "date", "hour", F.col("f.shard").alias("shard"))


def missing_shards(expected: DataFrame, inventory: DataFrame) -> DataFrame:
    """JOB-9 / JOIN-9: expected files that have not landed."""
    have = inventory.select("topic", "date", "hour", "shard")
    return expected.join(have, ["topic", "date", "hour", "shard"], "left_anti")


def window_counts(obs: DataFrame) -> DataFrame:
    """AGG-14: rows per (topic, date, hour)."""
    return (obs.groupBy(F.col("topic_name").alias("topic"), "date", "hour")
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .orderBy(F.desc("date"), F.desc("hour"), "topic"))


def short_windows(inventory: DataFrame, config: DataFrame) -> DataFrame:
    """AGG-15 / PRJ-19: windows of a topic with fewer distinct shards than configured."""
    per = inventory.groupBy("topic", "date", "hour").agg(F.countDistinct("shard").alias("shards_present"))
    return (per.join(config.select("topic", F.col("shards").alias("shards_expected")), "topic")
            .filter(F.col("shards_present") < F.col("shards_expected"))
            .orderBy(F.desc("date"), F.desc("hour"), "topic"))


def expired_tags(tags: DataFrame, today: str, keep_days: int = 30) -> DataFrame:
    """JOB-10: snapshot and day-delta tags dated before today - keep_days; others stay."""
    t = F.col("tag")
    d = (F.when(t.rlike(RETENTION_SNAP_PATTERN), F.regexp_extract(t, RETENTION_SNAP_PATTERN, 1))
         .when(t.rlike(RETENTION_DELTA_PATTERN), F.regexp_extract(t, RETENTION_DELTA_PATTERN, 1)))
    return (tags.select("tag", d.alias("tag_date"))
            .filter(F.col("tag_date").isNotNull() & (F.col("tag_date") < cutoff_date(today, keep_days))))


def backfill_plan(listing: DataFrame, local: DataFrame, date: str | None = None, since: str | None = None,
                  until: str | None = None, topics: list | None = None, include_samples: bool = False,
                  max_releases: int = 0) -> DataFrame:
    """JOB-11: release files still to fetch, oldest window first.

    `listing` (tag, name, size) is the published release listing, `local`
    (tag, name, size) what the archive already holds; a local file counts only
    with the same size.  `max_releases` keeps the files of the N oldest
    pending windows.
    """
    tag = F.col("tag")
    x = listing.filter(tag.rlike(BACKFILL_TAG_PATTERN)).select(
        "tag", "name", "size", F.regexp_extract(tag, BACKFILL_TAG_PATTERN, 1).alias("date"),
        F.regexp_extract(tag, BACKFILL_TAG_PATTERN, 2).alias("hour"),
        file_topic("name").alias("topic"), file_shard("name").alias("shard"),
        file_is_sample("name").alias("is_sample"))
    x = x.filter(F.col("topic") != "")
    if date:
        x = x.filter(F.col("date") == date)
    if since:
        x = x.filter(F.col("date") >= since)
    if until:
        x = x.filter(F.col("date") <= until)
    if not include_samples:
        x = x.filter(~F.col("is_sample"))
    if topics:
        x = x.filter(F.col("topic").isin(list(topics)))
    pending = x.join(local.select("tag", "name", "size"), ["tag", "name", "size"], "left_anti")
    if max_releases > 0:
        # the N oldest pending windows: a distributed top-N (no single-task ranking window)
        oldest = pending.select("date", "hour").distinct().orderBy("date", "hour").limit(max_releases)
        pending = pending.join(F.broadcast(oldest), ["date", "hour"], "left_semi")
    return pending.orderBy("date", "hour", "topic", "shard", "name")
