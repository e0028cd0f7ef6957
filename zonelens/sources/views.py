"""SQL views over an archive, and readers for snapshot folders and file lists.

`register_views` makes `observations`, `inventory` and, where the layout has
them, `samples` available to `spark.sql`; they are temporary views over the
lazy readers, so filters on topic, date and hour still prune folders.
`snapshots` reads `<base>/<tag>/<topic>.shard-<n>.parquet` for one tag, several
or all, `files` an explicit list of files.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelens.functions.names import topic_tag
from zonelens.schemas import OBSERVATION
from zonelens.session import list_paths
from zonelens.sources import archive as A

# fixed format: the tag of a 12-hour snapshot
SNAPSHOT_TAG = re.compile(r"snap-\d{4}-\d{2}-\d{2}-(00|12)")
SHARD_FILE = r"/([^/]+)/([^/]+)\.shard-(\d+)\.parquet$"


def wider_schema(spark: SparkSession, paths: Sequence[str], schema: T.StructType = OBSERVATION) -> T.StructType:
    """`schema` plus the columns that some of the files have beyond it (merged from footers)."""
    known = {f.name for f in schema.fields}
    found = spark.read.option("mergeSchema", "true").parquet(*paths).schema
    return T.StructType(schema.fields + [T.StructField(f.name, f.dataType, True) for f in found.fields if f.name not in known])


def files(spark: SparkSession, paths: Sequence[str], new_columns: bool = False) -> DataFrame:
    """SRC-5: observations of an explicit list of files (globs allowed), with `file_path`.
    `new_columns` keeps columns that were added to the files later."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        return spark.createDataFrame([], OBSERVATION).withColumn("file_path", F.lit(None).cast("string"))
    schema = wider_schema(spark, paths) if new_columns else OBSERVATION
    return spark.read.schema(schema).parquet(*paths).withColumn("file_path", F.col("_metadata.file_path"))


def snapshots(spark: SparkSession, base: str, tags: Sequence[str] | None = None, topic: str | None = None,
              new_columns: bool = False) -> DataFrame:
    """SRC-6: snapshot folders with their tag, long topic name (`topic_name`) and shard; `topic` is
    the short tag.  `tags`: the snapshots to read (None: all); a name that is no snapshot tag is
    refused, as is a snapshot without files."""
    base = base.rstrip("/")
    for t in tags or ():
        if not SNAPSHOT_TAG.fullmatch(t):
            raise ValueError(f"not a snapshot tag: {t!r}")
    paths = []
    for t in tags or ["snap-*"]:
        found = list_paths(spark, f"{base}/{t}/{topic or '*'}.shard-*.parquet")
        if tags and not found:
            raise FileNotFoundError(f"{base}/{t} holds no shard files" + (f" of {topic}" if topic else ""))
        paths += [p for p in found if SNAPSHOT_TAG.fullmatch(p.rsplit("/", 2)[1])]
    df = files(spark, paths, new_columns)
    part = lambda k: F.regexp_extract("file_path", SHARD_FILE, k)
    return (df.withColumn("tag", part(1)).withColumn("topic_name", part(2)).withColumn("shard", part(3))
            .withColumn("topic", topic_tag("topic_name")))


def register_views(spark: SparkSession, root: str, layout: str = "spark", prefix: str = "",
                   new_columns: bool = False) -> list[str]:
    """SRC-7 / SRC-8 / SRC-9: temporary views over the archive below `root`; returns their names."""
    root = root.rstrip("/")
    glob = f"{root}/topic_name=*/date=*/hour=*/shard=*" if layout == "spark" else f"{root}/topic=*/date=*/hour=*/shard-*.parquet"
    schema = wider_schema(spark, [glob]) if new_columns else OBSERVATION
    views = {"observations": A.observations(spark, root, layout, schema=schema), "inventory": A.inventory(spark, root, layout)}
    if layout != "spark" and list_paths(spark, f"{root}/topic=*/date=*/hour=*/sample=true/shard-*.sample.parquet"):
        views["samples"] = A.observations(spark, root, layout, samples=True)
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + name for name in views]
