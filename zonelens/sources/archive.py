"""Views over a Hive-partitioned observation archive, and its file inventory.

Two layouts are read:
* ``spark``   (what `sinks.write_observations` produces here):
  ``<root>/topic_name=<topic>/date=YYYY-MM-DD/hour=HH/shard=N/part-*.parquet``.
  The long topic name lives in the path, the short tag stays in the file's
  `topic` column, so the two never collide.
* ``release`` (the mirror of the published release files):
  ``<root>/topic=<topic>/date=YYYY-MM-DD/hour=HH/shard-N.parquet`` and
  ``.../sample=true/shard-N.sample.parquet``.  Here the path's `topic`
  shadows the file column (as in any Hive reader), so `topic` is re-derived
  from the long name and the long name is kept as `topic_name`.

Partition columns are declared as strings: inference would turn hour '00'
into the integer 0.  Filters on topic / date / hour prune directories.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelens.functions.names import topic_tag
from zonelens.schemas import OBSERVATION

_STR = T.StringType()
SPARK_PARTS = ["topic_name", "date", "hour", "shard"]
RELEASE_PARTS = ["topic", "date", "hour"]


def _with_parts(schema: T.StructType, parts) -> T.StructType:
    have = {f.name for f in schema.fields}
    return T.StructType([f for f in schema.fields if f.name not in parts] +
                        [T.StructField(p, _STR, True) for p in parts if p not in have or p in parts])


def observations(spark: SparkSession, root: str, layout: str = "spark", samples: bool = False,
                 schema: T.StructType = OBSERVATION) -> DataFrame:
    """SRC-7 / SRC-8 / SRC-10 / SRC-11: the archive as one DataFrame with `file_path`.

    The declared schema drives the read: columns are found by name, and one that an older
    file lacks reads as NULL.
    """
    root = root.rstrip("/")
    r = spark.read.option("basePath", root)
    if layout == "spark":
        df = r.schema(_with_parts(schema, SPARK_PARTS)).parquet(f"{root}/topic_name=*/date=*/hour=*/shard=*")
    else:
        glob = "sample=true/shard-*.sample.parquet" if samples else "shard-*.parquet"
        df = r.schema(_with_parts(schema, RELEASE_PARTS)).parquet(f"{root}/topic=*/date=*/hour=*/{glob}")
        df = (df.withColumnRenamed("topic", "topic_name").withColumn("topic", topic_tag("topic_name"))
              .withColumn("shard", F.regexp_extract(F.col("_metadata.file_path"), r"shard-(\d+)(\.sample)?\.parquet$", 1)))
    return df.withColumn("file_path", F.col("_metadata.file_path"))


def file_listing(spark: SparkSession, glob: str) -> DataFrame:
    """Files matching a glob with their size, without reading their content.

    `binaryFile` only reads bytes when the `content` column is selected.
    """
    return (spark.read.format("binaryFile").load(glob)
            .select(F.col("path").alias("file_path"), F.col("length").alias("size")))


def inventory(spark: SparkSession, root: str, layout: str = "spark") -> DataFrame:
    """SRC-9: one row per data file: topic, date, hour, shard, file_path, size.

    Empty files are listed as well (they carry a footer but no rows).
    """
    root = root.rstrip("/")
    if layout == "spark":
        files = file_listing(spark, f"{root}/topic_name=*/date=*/hour=*/shard=*/*.parquet")
        shard = F.regexp_extract("file_path", r"/shard=(\d+)/", 1)
        topic = F.regexp_extract("file_path", r"/topic_name=([^/]+)/", 1)
    else:
        files = file_listing(spark, f"{root}/topic=*/date=*/hour=*/shard-*.parquet")
        shard = F.regexp_extract("file_path", r"shard-(\d+)\.parquet$", 1)
        topic = F.regexp_extract("file_path", r"/topic=([^/]+)/", 1)
    return files.select(
        topic.alias("topic"), F.regexp_extract("file_path", r"/date=([^/]+)/", 1).alias("date"),
        F.regexp_extract("file_path", r"/hour=([^/]+)/", 1).alias("hour"),
        shard.cast("int").alias("shard"), "file_path", "size")


def read_legacy_json(spark: SparkSession, glob: str) -> DataFrame:
    """SRC-12: legacy gzip JSON lines (S7), read with the declared schema."""
    from zonelens.schemas import LEGACY_ROW
    return spark.read.schema(LEGACY_ROW).json(glob)


def legacy_as_observations(legacy: DataFrame) -> DataFrame:
    """Legacy per-answer rows renamed to the observation vocabulary (one row, n = 1)."""
    return legacy.select(
        F.col("kind").alias("k"), "topic", F.col("domain").alias("d"), F.col("ns").alias("s"),
        F.col("mx").alias("m"), F.col("qtype").alias("q"), "ip", F.col("as").alias("a"),
        F.col("country").alias("c"), F.col("prefix").alias("p"), F.col("preference").alias("pr"),
        F.col("ttl").alias("tl"), F.col("ts").alias("fs"), F.col("ts").alias("ls"),
        F.lit(1).cast("bigint").alias("n"), F.nullif(F.col("rcode"), F.lit(0).cast("bigint")).alias("rc"))


def union_legacy(parquet_obs: DataFrame, legacy: DataFrame) -> DataFrame:
    """SRC-12 / SET-3: Parquet observations UNION the renamed legacy rows, by name."""
    return parquet_obs.unionByName(legacy_as_observations(legacy), allowMissingColumns=True)
