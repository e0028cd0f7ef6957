"""Files under given names: the release layout of the archive and snapshot folders.

Spark names its own files; other readers of the archive want `shard-<n>.parquet`
below a topic and window, or `<tag>/<topic>.shard-<n>.parquet`.  The rows are
written once, each file's rows by one task (a file is a bounded offset slice of
a window), and the finished files are then renamed to their place: a metadata step
per file, after the write has succeeded.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelens.sinks.writers import _parquet

FILE = "file"


def write_named(rows: DataFrame, root: str, scratch: str, n: int | None = None) -> int:
    """Write `rows` to the files that their column `file` names, relative to `root`; returns how
    many there are.  A file that is there already is replaced."""
    spark = rows.sparkSession
    n = n or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    order = [c for c in ("k", "d") if c in rows.columns]
    dealt = rows.repartition(n, FILE).sortWithinPartitions(FILE, *order)
    _parquet(dealt, "overwrite").partitionBy(FILE).option("partitionOverwriteMode", "static").parquet(scratch)
    return _place(spark, scratch, root.rstrip("/"))


def _place(spark: SparkSession, scratch: str, root: str) -> int:
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    done = 0
    for status in fs.globStatus(path(f"{scratch}/{FILE}=*/part-*.parquet")) or []:
        name = unquote(status.getPath().getParent().getName()[len(FILE) + 1:])
        target = path(f"{root}/{name}")
        fs.mkdirs(target.getParent())
        if fs.exists(target):
            fs.delete(target, False)
        if not fs.rename(status.getPath(), target):
            raise OSError(f"cannot place {target}")
        done += 1
    return done


def snapshot_file(topic_name, tag, shard):
    """`<tag>/<topic>.shard-<n>.parquet`."""
    return F.concat(tag, F.lit("/"), topic_name, F.lit(".shard-"), shard, F.lit(".parquet"))
