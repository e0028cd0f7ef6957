"""Faults that must not pass silently: overwrite modes, changed configuration, lost state, budgets."""

import pytest
from pyspark.sql import functions as F

from zonelens import session
from zonelens.operators.certs import coerce_int
from zonelens.operators.parking import match_providers
from zonelens.sinks.writers import write_observations, write_per_provider
from zonelens.sources.kafka import avro_body, decode_errors
from zonelens.streaming.budget import BudgetExceeded, finish
from zonelens.streaming.first_seen import read_state


@pytest.fixture
def static(spark):
    key = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(key, "static")
    yield spark
    spark.conf.unset(key)


def test_a_window_does_not_wipe_others(static, tmp_out):
    rows = static.createDataFrame([("w1", "ip", "a.com"), ("w2", "ip", "b.com")], "half string, k string, d string")
    write_observations(rows, tmp_out, partition_cols=["half"])
    write_observations(rows.filter("half = 'w2'").withColumn("d", F.lit("c.com")), tmp_out, partition_cols=["half"])
    assert sorted(r.d for r in static.read.parquet(tmp_out).collect()) == ["a.com", "c.com"]


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_a_provider_that_disappears_leaves_nothing(spark, tmp_out, mode):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    rows = spark.createDataFrame([("a", "x.com"), ("b", "y.com")], "provider string, domain string")
    for fmt in ("parquet", "json"):
        write_per_provider(rows, f"{tmp_out}-{fmt}", fmt)
        write_per_provider(rows.filter("provider = 'a'"), f"{tmp_out}-{fmt}", fmt)
        assert [r.provider for r in spark.read.format(fmt).load(f"{tmp_out}-{fmt}").collect()] == ["a"]
    spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_changed_provider_file_is_seen(spark, tmp_out):
    ns = spark.createDataFrame([("d.com", "ns1.park.com"), ("e.com", "dark.com")], "d string, s string")
    schema = "provider string, suffix string, active boolean"
    for rows, n in (([("p", ".park.com", True)], 1), ([("p", ".park.com", True), ("p", "ark.com", True)], 3)):
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(tmp_out)
        providers = spark.read.schema(schema).parquet(tmp_out)
        assert match_providers(ns, providers).count() == match_providers(ns, providers, method="theta").count() == n


def test_unreachable_state_raises(spark, tmp_out):
    assert read_state(spark, tmp_out).count() == 0
    with pytest.raises(Exception):
        read_state(spark, "nosuchscheme://host/state").count()


def test_budget_stops_the_query(spark, tmp_out):
    slow = spark.readStream.format("rate").option("rowsPerSecond", 5).load()
    q = slow.writeStream.format("noop").option("checkpointLocation", tmp_out).start()
    with pytest.raises(BudgetExceeded):
        finish(q, 2)
    assert not q.isActive


def test_no_temp_folder_on_a_cluster():
    class Sc:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Sc()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(RuntimeError):
        session.checkpoint_root(Session())


def test_other_time_zone_is_an_error(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Amsterdam")
    try:
        with pytest.raises(ValueError):
            session.ensure_scale_conf(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_coercion_is_exact(spark):
    cases = {"1716.9999999": 1716, "0.9999999": 0, "-0.9999999": 0, "-5.5": -5, "1e18": 10 ** 18, "9007199254740993": 2 ** 53 + 1,
             "9223372036854775807": 2 ** 63 - 1, "9223372036854775808": None, "1.5e1": 15, "12e-1": 1, "1e400": None, "0e999": 0,
             "5e-400": 0, "1.23456789012345678e17": 123456789012345678, "x": None, "": None, "true": None, " 7 ": 7, "-1e2": -100}
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", coerce_int(F.col("t")).alias("v")).collect()
    assert {r.t: r.v for r in rows} == cases


def test_avro_header_on_any_column(spark):
    df = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x00\x01abc"),), (bytearray(b"\x00"),), (bytearray(b"\x00\x00\x00\x00\x01"),)], "payload binary")
    assert [r[0] and bytes(r[0]) for r in df.select(avro_body(F.col("payload"))).collect()] == [b"abc", None, bytearray()]


def test_decode_errors_count_records_of_nulls(spark):
    df = spark.createDataFrame([("t", ("a",)), ("t", (None,)), ("t", None)], "topic string, measurement struct<id: string>")
    r = decode_errors(df).first()
    assert (r.errors, r.msgs) == (2, 3)
