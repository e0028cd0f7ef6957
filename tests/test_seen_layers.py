"""The layered first-seen state: runs, re-runs, compaction, faults, and joins without an exchange."""

import random

import pytest

from zonelens.operators.parking import merge_seen, parking_new
from zonelens.operators.seen_layers import SeenLayers, rebuild_seen
from zonelens.schemas import SEEN
from zonelens.session import list_paths

PAIRS = "provider string, domain string, first_ms long"


def windows(n, seed=1):
    r = random.Random(seed)
    for k in range(n):
        rows = {(r.choice("pq"), f"d{r.randrange(60)}.com") for _ in range(25)}
        yield f"snap-2026-01-{k // 2 + 1:02d}-{12 * (k % 2):02d}", [(p, d, 1000 * k + r.randrange(900)) for p, d in sorted(rows)]


def rows_of(df):
    return sorted(map(tuple, df.select("provider", "domain", "first_snap", "first_ms").collect()))


def test_layers_equal_the_merge(spark, tmp_out):
    layers, plain = SeenLayers(spark, f"{tmp_out}/s", buckets=8, fanout=3), None
    for snap, rows in windows(10):
        df = spark.createDataFrame(rows, PAIRS)
        layers.append(df, snap)
        plain = spark.createDataFrame(merge_seen(plain, df, snap).select(*SEEN.names).collect(), SEEN)
        layers.compact()
        assert rows_of(layers.merged()) == rows_of(plain)
    assert max(r.level for r in layers.runs) == 2 and len(layers.runs) <= 5
    # a new handle sees the same state; so does one that reads the files without a catalogue entry
    spark.sql(f"DROP TABLE {layers.table}")
    again = SeenLayers(spark, f"{tmp_out}/s")
    assert again.buckets == 8 and rows_of(again.merged()) == rows_of(plain)
    assert {r.domain for r in again.of_domain("d7.com").collect()} <= {"d7.com"}
    assert again.of_domain("d7.com").count() == again.read().filter("domain = 'd7.com'").count()


def test_a_window_costs_its_own_pairs(spark, tmp_out):
    layers = SeenLayers(spark, f"{tmp_out}/s", buckets=8)
    layers.append(spark.range(20_000).selectExpr("'p' AS provider", "concat('d', id) AS domain", "id AS first_ms"), "snap-2026-01-01-00")
    before = set(list_paths(spark, f"{tmp_out}/s/runs/*/*/*.parquet"))
    layers.append(spark.createDataFrame([("p", "new.com", 5)], PAIRS), "snap-2026-01-01-12")
    after = set(list_paths(spark, f"{tmp_out}/s/runs/*/*/*.parquet"))
    assert before < after and len(after - before) == 1


def test_a_rerun_replaces_its_run(spark, tmp_out):
    layers = SeenLayers(spark, f"{tmp_out}/s", buckets=8)
    layers.append(spark.createDataFrame([("p", "a.com", 5), ("p", "b.com", 6)], PAIRS), "snap-2026-01-01-00")
    old = SeenLayers(spark, f"{tmp_out}/s").runs
    layers.append(spark.createDataFrame([("p", "a.com", 5)], PAIRS), "snap-2026-01-01-00")
    assert rows_of(layers.read()) == [("p", "a.com", "snap-2026-01-01-00", 5)] and len(layers.runs) == 1
    layers.append(spark.createDataFrame([], PAIRS), "snap-2026-01-01-00")
    assert layers.runs == [] and rows_of(layers.merged()) == [] and old[0].n_pairs == 2
    assert rows_of(SeenLayers(spark, f"{tmp_out}/s").read()) == []


def test_half_written_versions_do_not_count(spark, tmp_out):
    layers = SeenLayers(spark, f"{tmp_out}/s", buckets=8)
    layers.append(spark.createDataFrame([("p", "a.com", 5)], PAIRS), "snap-2026-01-01-00")
    # a run without a manifest version, and a version without its marker
    layers._write(spark.createDataFrame([("p", "lost.com", "snap-2026-01-01-12", 6)], SEEN), "snap-2026-01-01-12", 0)
    spark.range(1).write.json(f"{tmp_out}/s/manifest/v=00000009")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{tmp_out}/s/manifest/v=00000009/_SUCCESS")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)
    again = SeenLayers(spark, f"{tmp_out}/s")
    assert again.version == 1 and rows_of(again.read()) == [("p", "a.com", "snap-2026-01-01-00", 5)]
    assert again._latest()[0] == 1


def test_two_writers_of_one_version(spark, tmp_out):
    a, b = (SeenLayers(spark, f"{tmp_out}/s", buckets=8) for _ in range(2))
    a.append(spark.createDataFrame([("p", "a.com", 5)], PAIRS), "snap-2026-01-01-00")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        b.append(spark.createDataFrame([("p", "b.com", 5)], PAIRS), "snap-2026-01-01-12")
    assert rows_of(SeenLayers(spark, f"{tmp_out}/s").read()) == [("p", "a.com", "snap-2026-01-01-00", 5)]


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan


def test_the_state_is_not_exchanged(spark, tmp_out):
    layers = SeenLayers(spark, f"{tmp_out}/s", buckets=16, fanout=99)
    for snap, rows in windows(3):
        layers.append(spark.createDataFrame(rows, PAIRS), snap)
    today = spark.createDataFrame([("p", "d1.com"), ("p", "fresh.com")], "provider string, domain string")
    key = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(key)
    spark.conf.set(key, -1)
    try:
        new = parking_new(today.repartition(3), layers.read(), "snap-2026-02-01-00")
        n, plan = exchanges(new)
        assert n == 1 and "Bucketed: true" in plan, plan          # the window's side only
        assert [r.domain for r in new.collect()][-1:] == ["fresh.com"]
        n, plan = exchanges(layers.merged())
        assert n == 0 and "Bucketed: true" in plan, plan
    finally:
        spark.conf.set(key, was)


def test_bad_tags_and_bucket_counts(spark, tmp_out):
    layers = SeenLayers(spark, f"{tmp_out}/s", buckets=8)
    with pytest.raises(ValueError):
        layers.append(spark.createDataFrame([("p", "a.com", 5)], PAIRS), "snap-2026-01-01")
    layers.append(spark.createDataFrame([("p", None, 5), (None, "a.com", None)], PAIRS), "snap-2026-01-01-00")
    assert layers.merged().count() == 2
    with pytest.raises(ValueError):
        SeenLayers(spark, f"{tmp_out}/s", buckets=4)


def test_rebuild(spark):
    rows = [("p", "a.com", 5, "s2"), ("p", "a.com", 5, "s1"), ("p", "a.com", 9, "s0"), ("q", "a.com", 1, "s3")]
    got = rebuild_seen(spark.createDataFrame(rows, PAIRS + ", snap string"))
    assert rows_of(got) == [("p", "a.com", "s1", 5), ("q", "a.com", "s3", 1)]
