"""SNK-8 / JOB-6 / SRC-13 / JOIN-2: the first-seen state as layers of immutable sorted runs.

Writing a window appends its own pairs as one run; nothing that is already
there is read or rewritten.  Runs are merged level by level: `fanout` runs of
one level become a single run of the next, so a pair is rewritten once per
level and the number of live runs stays logarithmic in the number of windows.

All runs belong to one table that is bucketed by (provider, domain) and
partitioned by (year, run).  A window's new pairs are found by an anti join that
exchanges the window's side only, and merging runs needs no exchange either:
equal pairs are in the same bucket of every run.  Keep the bucket count (fixed
when the state is created) at `spark.sql.shuffle.partitions` or above, or Spark
prefers to exchange both sides.

The live runs are named by a manifest, one folder per version, complete when its
_SUCCESS marker is there.  A run's files exist before the manifest names them and
are never changed, so a writer that dies leaves the state as it was, a reader of
an older version keeps its runs, and of two writers of one version the second
fails.  Re-running a window replaces its run.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelens.functions.names import SNAP_TAG_PATTERN
from zonelens.schemas import SEEN
from zonelens.session import list_paths

PAIR = ("provider", "domain")
MANIFEST = "run string, snap string, level int, year int, n_pairs long, lo string, hi string, buckets int"


@dataclass(frozen=True)
class Run:
    run: str            # unique name, also the partition value
    snap: str           # the window it was written for; the newest of a merged run
    level: int
    year: int
    n_pairs: int
    lo: str             # smallest and largest domain
    hi: str
    buckets: int


class SeenLayers:
    """The first-seen state below `root`."""

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None, fanout: int = 4):
        self.spark, self.root, self.fanout = spark, root.rstrip("/"), fanout
        self.version, self.runs = self._latest()
        stored = {r.buckets for r in self.runs}
        if stored and buckets is not None and stored != {buckets}:
            raise ValueError(f"{root} has {stored} buckets, not {buckets}")
        self.buckets = stored.pop() if stored else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.table = "zonelens_seen_" + hashlib.md5(f"{self.root}|{self.buckets}".encode()).hexdigest()[:16]
        spark.sql(f"""CREATE TABLE IF NOT EXISTS {self.table}
            (provider STRING, domain STRING, first_snap STRING, first_ms BIGINT, year INT, run STRING)
            USING parquet OPTIONS (compression 'zstd') PARTITIONED BY (year, run)
            CLUSTERED BY (provider, domain) SORTED BY (provider, domain) INTO {self.buckets} BUCKETS
            LOCATION '{self.root}/runs'""")
        self._sync()

    # --- manifest -------------------------------------------------------------

    def _latest(self) -> tuple[int, list[Run]]:
        done = list_paths(self.spark, f"{self.root}/manifest/v=*/_SUCCESS")
        if not done:
            return 0, []
        path = done[-1].rsplit("/", 1)[0]
        rows = self.spark.read.schema(MANIFEST).json(path).filter("run is not null").collect()      # one row per live run
        return int(path.rsplit("v=", 1)[1]), sorted((Run(**r.asDict()) for r in rows), key=lambda r: (r.snap, r.run))

    def _commit(self, runs: list[Run]) -> None:
        rows = self.spark.createDataFrame([asdict(r) for r in runs], MANIFEST)
        rows.coalesce(1).write.mode("errorifexists").json(f"{self.root}/manifest/v={self.version + 1:08d}")
        self.version, self.runs = self.version + 1, sorted(runs, key=lambda r: (r.snap, r.run))
        self._sync()

    def _sync(self) -> None:
        """Register exactly the live runs as partitions of the table."""
        live = {(r.year, r.run) for r in self.runs}
        have = set()
        for row in self.spark.sql(f"SHOW PARTITIONS {self.table}").collect():
            year, run = (p.split("=", 1)[1] for p in row[0].split("/"))
            have.add((int(year), run))
        for verb, some in (("DROP IF EXISTS", have - live), ("ADD IF NOT EXISTS", live - have)):
            if some:
                parts = [f"PARTITION (year={y}, run='{r}')" for y, r in sorted(some)]
                self.spark.sql(f"ALTER TABLE {self.table} {verb} " + (", " if verb[0] == "D" else " ").join(parts))

    # --- reading --------------------------------------------------------------

    def read(self) -> DataFrame:
        """All rows of the live runs; a pair has one row per run it is in."""
        if not self.runs:
            return self.spark.createDataFrame([], SEEN)
        rows = self.spark.table(self.table).filter(F.col("run").isin([r.run for r in self.runs]))
        return rows.select(*SEEN.names)

    def merged(self) -> DataFrame:
        """One row per pair: the entry with the lowest time, ties to the lowest tag."""
        best = self.read().groupBy(*PAIR).agg(F.min(F.struct("first_ms", "first_snap")).alias("b"))
        return best.select(*PAIR, F.col("b.first_snap").alias("first_snap"), F.col("b.first_ms").alias("first_ms"))

    def of_domain(self, domain: str) -> DataFrame:
        """Every entry of one domain, from the runs whose range holds it."""
        some = [r.run for r in self.runs if r.lo <= domain <= r.hi]
        rows = self.spark.table(self.table).filter(F.col("run").isin(some) & (F.col("domain") == domain))
        return rows.select(*SEEN.names)

    # --- writing --------------------------------------------------------------

    def _write(self, pairs: DataFrame, snap: str, level: int) -> Run | None:
        """The pairs as one run: a file per bucket, sorted."""
        year, name = int(snap.split("-")[1]), f"{snap}.{level}.{uuid.uuid4().hex[:8]}"
        view = f"{self.table}_{uuid.uuid4().hex[:8]}"
        rows = pairs.select(*SEEN.names).repartition(self.buckets, *PAIR)
        rows.sortWithinPartitions(*PAIR).createOrReplaceTempView(view)
        # the session that holds the view is the one of the rows (a micro-batch brings its own)
        session = pairs.sparkSession
        try:
            session.sql(f"INSERT INTO {self.table} PARTITION (year={year}, run='{name}') SELECT * FROM {view}")
        finally:
            session.catalog.dropTempView(view)
        path = f"{self.root}/runs/year={year}/run={name}"
        if not list_paths(self.spark, f"{path}/*.parquet"):
            return None
        n, lo, hi = self.spark.read.schema(SEEN).parquet(path).agg(F.count(F.lit(1)), F.min("domain"), F.max("domain")).first()
        return Run(name, snap, level, year, n, lo or "", hi or "", self.buckets) if n else None

    def append(self, pairs: DataFrame, snap: str) -> None:
        """The pairs of one window (provider, domain, first_ms) as a run; a re-run replaces it.
        Costs the window's own pairs, whatever the size of the state."""
        if not re.search(SNAP_TAG_PATTERN, snap):
            raise ValueError(f"not a snapshot tag: {snap}")
        rows = pairs.select(*PAIR, F.lit(snap).alias("first_snap"), F.col("first_ms").cast("long").alias("first_ms"))
        run = self._write(rows, snap, 0)
        kept = [r for r in self.runs if r.level or r.snap != snap]
        self._commit(kept + [run] if run else kept)

    def compact(self) -> int:
        """Merge full levels, lowest first; returns the number of merges."""
        merges = 0
        while True:
            by_level: dict[int, list[Run]] = {}
            for r in self.runs:
                by_level.setdefault(r.level, []).append(r)
            full = [level for level, some in sorted(by_level.items()) if len(some) >= self.fanout]
            if not full:
                return merges
            some = by_level[full[0]]
            rows = self.spark.table(self.table).filter(F.col("run").isin([r.run for r in some]))
            best = rows.groupBy(*PAIR).agg(F.min(F.struct("first_ms", "first_snap")).alias("b"))
            run = self._write(best.select(*PAIR, "b.first_snap", "b.first_ms"), max(r.snap for r in some), full[0] + 1)
            self._commit([r for r in self.runs if r not in some] + ([run] if run else []))
            merges += 1


def seed_provider(obs: DataFrame, providers: DataFrame, provider: str) -> DataFrame:
    """The pairs of one provider in an older snapshot, to start its state from (`seeded_from`)."""
    from zonelens.operators.parking import parking_today
    today = parking_today(obs, providers.filter(F.col("provider") == provider))
    return today.select(*PAIR, "first_ms")


def rebuild_seen(deltas: DataFrame) -> DataFrame:
    """The state from stored deltas (provider, domain, first_ms and the window's `snap`): every pair
    keeps its earliest entry, as folding the windows in order would leave it."""
    best = deltas.groupBy(*PAIR).agg(F.min(F.struct("first_ms", F.col("snap").alias("first_snap"))).alias("b"))
    return best.select(*PAIR, F.col("b.first_snap").alias("first_snap"), F.col("b.first_ms").alias("first_ms"))
