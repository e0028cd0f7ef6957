"""Fixture relations as Spark DataFrames (the Spark side of `oracle.py`).

The observation table is what the ingest job writes: the rollup of the
measurement messages, stored once per session as zstd Parquet below the
checkpoint folder (partitioned by window, clustered by kind and domain).
Catalogue queries read it, as the reference's queries read the stored
observation files; the `obs_rollup` query measures the rollup itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelens.operators.rollup import rollup_measurements
from zonelens.schemas import OBSERVATION
from zonelens.session import path_version, scratch_path
from zonelens.sinks.writers import write_observations
from zonelens.sources import projection as P

_STORED: dict = {}
OBS_FILE_SCHEMA = T.StructType(OBSERVATION.fields + [T.StructField("half", T.StringType(), True)])


def rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observation rollup of the fixture measurements, per half ('prev' / 'now')."""
    return rollup_measurements(P.measurement_envelopes(spark, sf_dir), window_cols=["half"])


def _source_key(spark: SparkSession, sf_dir: str) -> tuple:
    """Identifies the state of the events table that a stored table was derived from."""
    src = f"{sf_dir.rstrip('/')}/events.parquet"
    return spark.sparkContext.applicationId, src, path_version(spark, src)


def _stored_path(spark: SparkSession, sf_dir: str) -> str:
    key = _source_key(spark, sf_dir)
    path = _STORED.get(key)
    if path is None:
        path = scratch_path(spark, "obs")
        write_observations(rollup(spark, sf_dir), path, partition_cols=["half"], bloom=True)
        _STORED[key] = path
    return path


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored observation table (S2 + half); one DataFrame per session, so its
    file listing is done once."""
    path = _stored_path(spark, sf_dir)
    key = ("obs-df", path)
    df = _STORED.get(key)
    if df is None:
        df = _STORED[key] = spark.read.schema(OBS_FILE_SCHEMA).parquet(path)
    return df


CLUSTERED_FILES = 16


def clustered(spark: SparkSession, sf_dir: str) -> str:
    """The observation table in files of disjoint key ranges."""
    from zonelens.sinks.writers import write_clustered
    key = ("clustered", *_source_key(spark, sf_dir))
    if key not in _STORED:
        path = scratch_path(spark, "obs-clustered")
        write_clustered(rollup(spark, sf_dir), path, partition_cols=["half"], files=CLUSTERED_FILES)
        _STORED[key] = path
    return _STORED[key]


def obs_half(spark: SparkSession, sf_dir: str, half: str) -> DataFrame:
    return obs(spark, sf_dir).filter(F.col("half") == half)


def seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-seen state before the 'now' half: the pairs of the earlier half first seen
    before the state's cut-off (so pairs first seen after it are new later on)."""
    from zonelens.functions.timefmt import snap_tag_of_ms
    from zonelens.operators.parking import match_providers
    o = obs_half(spark, sf_dir, "prev").filter(F.col("k") == "ns")
    m = match_providers(o, P.providers(spark))
    return (m.groupBy("provider", F.col("d").alias("domain")).agg(F.min("fs").alias("first_ms"))
            .filter(F.col("first_ms") < F.lit(P.SEEN_CUTOFF_MS))
            .select("provider", "domain", snap_tag_of_ms("first_ms").alias("first_snap"), "first_ms"))


def layered_state(spark: SparkSession, root: str, prior: DataFrame, fanout: int = 3):
    """The state before the 'now' half as layers: one run per window, then compacted."""
    from zonelens.operators.seen_layers import SeenLayers
    layers = SeenLayers(spark, root, fanout=fanout)
    for row in prior.select("first_snap").distinct().orderBy("first_snap").collect():       # one row per window
        layers.append(prior.filter(F.col("first_snap") == row.first_snap), row.first_snap)
    layers.compact()
    return layers


def seen_layers(spark: SparkSession, sf_dir: str):
    """`layered_state` of the fixture, written once per session."""
    from zonelens.operators.seen_layers import SeenLayers
    key = ("seen-layers", *_source_key(spark, sf_dir))
    if key not in _STORED:
        root = scratch_path(spark, "seen-layers")
        layered_state(spark, root, seen(spark, sf_dir))
        _STORED[key] = root
    return SeenLayers(spark, _STORED[key])


def certs_half(spark: SparkSession, sf_dir: str, half: str) -> DataFrame:
    return P.certificates(spark, sf_dir).filter(F.col("half") == half)


def delta(spark: SparkSession, sf_dir: str, half: str = "now", with_seen: bool = True) -> DataFrame:
    """The parking delta of one half (S4)."""
    from zonelens.operators.parking import parking_delta
    snap = P.NOW_SNAP if half == "now" else P.PREV_SNAP
    return parking_delta(obs_half(spark, sf_dir, half), certs_half(spark, sf_dir, half),
                         P.providers(spark), seen(spark, sf_dir) if with_seen else None, snap)


# --- the 12-hour archive: messages sliced into shards, rolled up per shard file ---
ARCHIVE_TOPICS = ["newly_issued_certificates_measurements", "newly_registered_fqdn_measurements",
                  "newly_registered_domains_measurements"]


def sliced_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurement messages with their window (date, hour = window end) and shard."""
    from zonelens.functions.timefmt import snap_date_of_ms, snap_hour_of_ms, window_end_ms
    from zonelens.operators.housekeeping import assign_shards, shard_config
    env = P.measurement_envelopes(spark, sf_dir)
    ms = F.col("measurement.request_timestamp")
    env = env.select("*", window_end_ms(ms).alias("window_end_ms"), snap_date_of_ms(ms).alias("date"),
                     snap_hour_of_ms(ms).alias("hour"), F.col("topic").alias("topic_name"))
    return assign_shards(env, shard_config(spark), "window_end_ms", topic_col="topic_name")


ARCHIVE_PARTS = ["topic_name", "date", "hour", "shard"]


def archive_root(spark: SparkSession, sf_dir: str) -> str:
    """The observation archive of the fixture, written once per session."""
    key = ("archive", *_source_key(spark, sf_dir))
    path = _STORED.get(key)
    if path is None:
        path = scratch_path(spark, "archive")
        env = sliced_envelopes(spark, sf_dir).withColumn("shard", F.col("shard").cast("string"))
        o = rollup_measurements(env, window_cols=ARCHIVE_PARTS)
        write_observations(o, path, partition_cols=ARCHIVE_PARTS, one_file_per_partition=True)
        _STORED[key] = path
    return path
