"""End-to-end jobs with their sinks."""

import json
import os

from pyspark.sql import functions as F

from zonelens import jobs
from zonelens.plans import fixture as X
from zonelens.sources import projection as P

SF = "/root/testdata/sf0.001"


def _local(p):
    return p[len("file:"):] if p.startswith("file:") else p


def test_delta_job_outputs(spark, tmp_out):
    paths = jobs.run_delta(X.obs_half(spark, SF, "now"), X.certs_half(spark, SF, "now"), P.providers(spark),
                           X.seen(spark, SF), P.NOW_SNAP, tmp_out, f"{tmp_out}/seen-new")
    counts = {r.provider: int(r.new_domains) for r in spark.read.option("header", True).csv(paths["counts"]).collect()}
    assert set(counts) == {"park_a", "park_b", "park_dual", "park_none"} and counts["park_none"] == 0
    delta = spark.read.parquet(paths["delta"])
    assert delta.count() == sum(counts.values())
    dirs = sorted(d for d in os.listdir(_local(paths["delta"])) if d.startswith("provider="))
    assert [d.split("=")[1] for d in dirs] == sorted(counts)          # also the providers without rows
    assert spark.read.parquet(paths["delta"] + "/provider=park_none").count() == 0
    m = spark.read.json(paths["manifest"]).collect()[0]
    assert m.snap_tag == P.NOW_SNAP and [p.new_domains for p in m.providers] == sorted(counts.values(), reverse=True)
    seen = spark.read.parquet(paths["seen"])
    assert seen.count() == X.seen(spark, SF).count() + delta.count()
    assert seen.filter(F.col("first_snap") == P.NOW_SNAP).count() == delta.count()


def test_audit_job(spark, tmp_out):
    topk, unhandled, configured = jobs.run_audit(X.obs(spark, SF), P.providers(spark), tmp_out, k=10, threshold=1)
    assert topk.count() == spark.read.parquet(f"{tmp_out}/topk_ns.parquet").count()
    assert spark.read.option("header", True).csv(f"{tmp_out}/topk_ns.csv").count() == topk.count()
    conf = {r.ns_apex for r in configured.collect()}
    assert conf <= {"parkone.com", "parktwo.net", "dualpark.com", "dualpark.net"}
    assert {r.ns_apex for r in unhandled.collect()}.isdisjoint(conf)


def test_ingest_job(spark, tmp_out):
    from zonelens.operators.rollup import rollup_measurements
    from zonelens.sources.archive import _with_parts
    from zonelens.schemas import OBSERVATION
    env = X.sliced_envelopes(spark, SF)
    jobs.run_ingest(env, tmp_out)
    back = spark.read.schema(_with_parts(OBSERVATION, ["date", "hour"])).parquet(tmp_out)
    assert back.count() == rollup_measurements(env, ["date", "hour"]).count()
    assert {r.hour for r in back.select("hour").distinct().collect()} == {"00", "12"}


def test_incomplete_window_writes_nothing(spark, tmp_out):
    import pytest
    gap = spark.createDataFrame([("newly_registered_domains_measurements", "2026-05-25", "00", 2)],
                                "topic string, date string, hour string, shard int")
    with pytest.raises(jobs.IncompleteWindow, match="shard 2"):
        jobs.run_delta(X.obs_half(spark, SF, "now"), X.certs_half(spark, SF, "now"), P.providers(spark),
                       X.seen(spark, SF), P.NOW_SNAP, tmp_out, f"{tmp_out}/seen", missing=gap)
    assert not os.path.exists(_local(tmp_out))
