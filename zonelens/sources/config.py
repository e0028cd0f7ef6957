"""Configuration tables: parking providers (SRC-14 / SRC-15) and shard layout (SRC-16)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelens.functions.names import SNAP_TAG_PATTERN
from zonelens.schemas import PROVIDER_FILE

# fixed values: shapes the provider configuration must follow
PROVIDER_NAME_PATTERN = r"^[a-z][a-z0-9_]*$"
SUFFIX_PATTERN = r"^\.[a-z0-9.-]+$"


def load_providers(spark: SparkSession, path: str, active_only: bool = False) -> DataFrame:
    """SRC-14: the provider file (version + list) as one row per provider."""
    f = spark.read.option("multiLine", True).schema(PROVIDER_FILE).json(path)
    p = f.select("version", F.explode("providers").alias("p")).select("version", "p.*")
    return p.filter(F.col("active")) if active_only else p


def provider_suffixes(providers: DataFrame) -> DataFrame:
    """GEN-3: one row per (provider, suffix, active)."""
    return providers.select(F.col("name").alias("provider"), F.explode("ns_suffix").alias("suffix"), "active")


def provider_violations(providers: DataFrame) -> DataFrame:
    """SRC-15: every rule a provider row breaks, as (name, rule, value) rows."""
    s = providers.select("name", F.explode_outer("ns_suffix").alias("suffix"))
    bad_suffix = s.filter(F.col("suffix").isNotNull() & ~F.col("suffix").rlike(SUFFIX_PATTERN)).select(
        "name", F.lit("suffix_format").alias("rule"), F.col("suffix").alias("value"))
    p = providers
    checks = [
        (F.col("name").isNull() | ~F.coalesce(F.col("name"), F.lit("")).rlike(PROVIDER_NAME_PATTERN),
         "name_format", F.col("name")),
        (F.col("active").isNull(), "active_missing", F.lit(None).cast("string")),
        (F.coalesce(F.size("ns_suffix"), F.lit(0)) <= 0, "suffix_missing", F.lit(None).cast("string")),
        (F.col("seeded_from").isNotNull() & ~F.coalesce(F.col("seeded_from"), F.lit("")).rlike(SNAP_TAG_PATTERN),
         "seeded_from_format", F.col("seeded_from")),
    ]
    out = bad_suffix
    for cond, rule, val in checks:
        out = out.unionByName(p.filter(cond).select("name", F.lit(rule).alias("rule"), val.cast("string").alias("value")))
    dup = (p.groupBy("name").count().filter(F.col("count") > 1)
           .select("name", F.lit("duplicate_name").alias("rule"), F.col("count").cast("string").alias("value")))
    return out.unionByName(dup)


def load_shard_config(spark: SparkSession, path: str) -> DataFrame:
    """SRC-16: {topic: {shards, format}} -> (topic, shards, format) rows."""
    t = spark.read.text(path, wholetext=True)
    m = F.from_json("value", "map<string, struct<shards:int, format:string>>")
    return t.select(F.explode(m).alias("topic", "c")).select("topic", "c.shards", "c.format")


def shard_files(config: DataFrame, tag) -> DataFrame:
    """SRC-16: every file a snapshot must hold: (tag, topic, shard, name)."""
    tagc = F.lit(tag) if isinstance(tag, str) else tag
    return config.select(tagc.alias("tag"), "topic", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard")) \
        .withColumn("name", F.format_string("%s.shard-%d.parquet", "topic", "shard"))
