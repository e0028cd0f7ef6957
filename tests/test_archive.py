"""Archive layout, inventory, config tables and the back-fill plan."""

import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from zonelens.operators import housekeeping as H
from zonelens.sinks.writers import write_observations
from zonelens.sources import archive as A
from zonelens.sources import config as C

OBS_ROW = dict(k="ip", topic="domains", d="a.com", s=None, m=None, q="A", ip="1.1.1.1", a="1", c="US", p=None,
               pr=None, tl=60, fs=1, ls=2, n=3, rc=None)


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_release_layout_and_inventory(spark, tmp_out):
    root = _local(tmp_out)
    topic = "newly_registered_domains_measurements"
    tbl = pa.Table.from_pylist([OBS_ROW], schema=pa.schema(
        [(k, pa.int64() if k in ("pr", "tl", "fs", "ls", "n", "rc") else pa.string()) for k in OBS_ROW]))
    for hour, shard, t in [("00", 0, tbl), ("00", 1, tbl.slice(0, 0)), ("12", 0, tbl)]:
        d = f"{root}/topic={topic}/date=2026-05-25/hour={hour}"
        os.makedirs(d, exist_ok=True)
        pq.write_table(t, f"{d}/shard-{shard}.parquet")
    o = A.observations(spark, root, layout="release")
    rows = o.filter(F.col("hour") == "00").collect()                 # hour stays the string '00'
    assert len(rows) == 1 and rows[0].topic == "domains" and rows[0].topic_name == topic and rows[0].shard == "0"
    inv = sorted((r.hour, r.shard) for r in A.inventory(spark, root, layout="release").collect())
    assert inv == [("00", 0), ("00", 1), ("12", 0)]                  # the empty file is listed too
    exp = H.expected_shards(spark.createDataFrame([("2026-05-25", "00"), ("2026-05-25", "12")], "date string, hour string"),
                            [(topic, 2, "avro_dns")])
    miss = H.missing_shards(exp, A.inventory(spark, root, layout="release")).collect()
    assert [(r.hour, r.shard) for r in miss] == [("12", 1)]
    short = H.short_windows(A.inventory(spark, root, layout="release"), spark.createDataFrame([(topic, 2)], "topic string, shards int"))
    assert [(r.hour, r.shards_present) for r in short.collect()] == [("12", 1)]


def test_spark_layout_roundtrip(spark, tmp_out):
    from zonelens.schemas import OBSERVATION
    row = tuple(OBS_ROW[f.name] for f in OBSERVATION.fields) + ("t", "2026-01-01", "00", "3")
    df = spark.createDataFrame([row], OBSERVATION.simpleString()[len("struct<"):-1]
                               + ",topic_name:string,date:string,hour:string,shard:string")
    write_observations(df, tmp_out, A.SPARK_PARTS)
    o = A.observations(spark, tmp_out).collect()
    assert (o[0].hour, o[0].shard, o[0].topic, o[0].n) == ("00", "3", "domains", 3)
    inv = A.inventory(spark, tmp_out).collect()
    assert [(r.topic, r.hour, r.shard) for r in inv] == [("t", "00", 3)]


def test_provider_config(spark, tmp_out):
    p = _local(tmp_out) + ".json"
    os.makedirs(os.path.dirname(p), exist_ok=True)
    cfg = {"version": 1, "providers": [
        {"name": "alpha", "org": "Alpha", "active": True, "watchlist": False, "ns_suffix": [".alpha-park.example"]},
        {"name": "Bad-Name", "active": True, "ns_suffix": ["noleadingdot.com"]},
        {"name": "watch", "active": False, "watchlist": True, "ns_suffix": [".w.net"], "seeded_from": "snap-2026-05-28-06"}]}
    with open(p, "w") as f:
        json.dump(cfg, f)
    prov = C.load_providers(spark, p)
    assert prov.count() == 3 and C.load_providers(spark, p, active_only=True).count() == 2
    v = sorted((r.name, r.rule) for r in C.provider_violations(prov).collect())
    assert v == [("Bad-Name", "name_format"), ("Bad-Name", "suffix_format"), ("watch", "seeded_from_format")]
    sfx = sorted((r.provider, r.suffix) for r in C.provider_suffixes(prov).collect())
    assert ("alpha", ".alpha-park.example") in sfx


def test_shard_config_and_files(spark, tmp_out):
    p = _local(tmp_out) + "-shards.json"
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w") as f:
        json.dump({"certstream_domains": {"shards": 2, "format": "json"}, "a_topic": {"shards": 3, "format": "avro_dns"}}, f)
    cfg = C.load_shard_config(spark, p)
    files = sorted(r.name for r in C.shard_files(cfg, "snap-2026-05-25-00").collect())
    assert files == ["a_topic.shard-0.parquet", "a_topic.shard-1.parquet", "a_topic.shard-2.parquet",
                     "certstream_domains.shard-0.parquet", "certstream_domains.shard-1.parquet"]


def test_backfill_plan(spark):
    L = "tag string, name string, size bigint"
    listing = spark.createDataFrame([
        ("snap-2026-05-24-12", "t1.shard-0.parquet", 10), ("snap-2026-05-24-12", "t1.shard-0.sample.parquet", 1),
        ("snap-2026-05-25-00", "t1.shard-0.parquet", 10), ("snap-2026-05-25-00", "t2.shard-0.parquet", 10),
        ("snap-2026-05-25-12", "t1.shard-0.parquet", 10), ("parking-DAY-2026-05-25-00", "t1.shard-0.parquet", 10)], L)
    local = spark.createDataFrame([("snap-2026-05-24-12", "t1.shard-0.parquet", 10),
                                   ("snap-2026-05-25-00", "t1.shard-0.parquet", 9)], L)
    got = [(r.tag, r.name) for r in H.backfill_plan(listing, local, max_releases=1).collect()]
    assert got == [("snap-2026-05-25-00", "t1.shard-0.parquet"), ("snap-2026-05-25-00", "t2.shard-0.parquet")]
    got = [(r.tag, r.name) for r in H.backfill_plan(listing, local, topics=["t1"], since="2026-05-25").collect()]
    assert got == [("snap-2026-05-25-00", "t1.shard-0.parquet"), ("snap-2026-05-25-12", "t1.shard-0.parquet")]


def test_assign_shards_slices(spark):
    msgs = spark.createDataFrame([("t", 0, o) for o in range(100, 110)] + [("t", 1, 500)],
                                 "topic string, window_end_ms bigint, offset bigint")
    cfg = spark.createDataFrame([("t", 3)], "topic string, shards int")
    got = {(r.window_end_ms, r.offset): r.shard for r in H.assign_shards(msgs, cfg).collect()}
    # 10 offsets, chunk 3: [100-102]->0, [103-105]->1, rest->2; one message: chunk 0 -> last shard
    assert [got[(0, o)] for o in range(100, 110)] == [0, 0, 0, 1, 1, 1, 2, 2, 2, 2]
    assert got[(1, 500)] == 2
