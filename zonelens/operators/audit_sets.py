"""JOB-8, incremental: the audit's distinct sets kept per window and merged for a report.

A window's distinct (apex, domain) and (apex, host) pairs are written once, sorted
and bucketed by the pair.  A report over many windows takes the union of their
sets: equal pairs are in the same bucket of every window, so the union is made
without exchanging them, and the observations themselves are not read again.
Sliding the report by one window costs that window's sets.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelens.operators.audit import audit_of_sets, ns_base
from zonelens.operators.catalogue import TOPIC, pinned
from zonelens.session import list_paths

SETS = {"domains": "d", "hosts": "s"}


class AuditSets:
    """The sets below `root`, one folder per window (named by its tag) and kind."""

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        key = hashlib.md5(f"{self.root}|{self.buckets}".encode()).hexdigest()[:16]
        self.tables = {name: f"zonelens_audit_{name}_{key}" for name in SETS}
        for name, column in SETS.items():
            spark.sql(f"""CREATE TABLE IF NOT EXISTS {self.tables[name]} (ns_apex STRING, {column} STRING, snap STRING)
                USING parquet OPTIONS (compression 'zstd') PARTITIONED BY (snap)
                CLUSTERED BY (ns_apex, {column}) SORTED BY (ns_apex, {column}) INTO {self.buckets} BUCKETS
                LOCATION '{self.root}/{name}'""")
            known = {r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {self.tables[name]}").collect()}
            there = {p.rsplit("snap=", 1)[1] for p in list_paths(spark, f"{self.root}/{name}/snap=*")}
            for snap in sorted(there - known):
                spark.sql(f"ALTER TABLE {self.tables[name]} ADD IF NOT EXISTS PARTITION (snap='{snap}')")

    def append(self, obs: DataFrame, snap: str, topic: str | None = TOPIC) -> None:
        """The sets of one window; a re-run replaces them."""
        base = ns_base(pinned(obs, topic))
        for name, column in SETS.items():
            pairs = base.select("ns_apex", column).distinct().repartition(self.buckets, "ns_apex", column)
            view = f"{self.tables[name]}_rows"
            pairs.sortWithinPartitions("ns_apex", column).createOrReplaceTempView(view)
            self.spark.sql(f"INSERT OVERWRITE TABLE {self.tables[name]} PARTITION (snap='{snap}') SELECT * FROM {view}")
            self.spark.catalog.dropTempView(view)

    def merged(self, name: str, first: str, last: str) -> DataFrame:
        """The union of one kind's sets over the windows from `first` to `last`."""
        some = self.spark.table(self.tables[name]).filter(F.col("snap").between(first, last))
        return some.select("ns_apex", SETS[name]).distinct()

    def report(self, first: str, last: str, k: int = 500, samples: int = 5) -> DataFrame:
        """`ns_audit_topk` over the windows from `first` to `last`."""
        return audit_of_sets(self.merged("domains", first, last), self.merged("hosts", first, last), k, samples)
