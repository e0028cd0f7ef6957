"""Column functions, with the unit cases of the reference's own tests."""

from pyspark.sql import functions as F

from zonelens.functions import names as N
from zonelens.functions import timefmt as T
from zonelens.operators.housekeeping import expired_tags


def one(spark, col, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(col).collect()]


def test_apex_of(spark):
    cases = {"example.com": "example.com", "www.example.com": "example.com", "a.b.c.example.com": "example.com",
             "www.example.com.": "example.com", "EXAMPLE.COM": "example.com", "xn--80ak6aa92e.com": "xn--80ak6aa92e.com",
             "foo.io": "foo.io", "": "", "singlelabel": "singlelabel", "x.com..": "x.com"}
    got = one(spark, N.apex_of("x"), list(cases))
    assert got == list(cases.values())
    assert one(spark, N.apex_of("x"), [None]) == [""]


def test_ns_apex_keeps_case(spark):
    assert one(spark, N.ns_apex("x"), ["NS1.Park.COM", "a.b"]) == ["Park.COM", "a.b"]


def test_snap_tag(spark):
    ok = {"snap-2026-05-28-00": ("2026-05-28", "00"), "snap-2026-05-28-12": ("2026-05-28", "12")}
    bad = ["snap-2026-05-28", "snap-2026-5-28-00", "snap-2026-05-28-06", "parking-DAY-2026-05-28-00", ""]
    got = one(spark, N.parse_snap_tag("x"), list(ok) + bad)
    assert [tuple(g) if g else None for g in got] == list(ok.values()) + [None] * len(bad)
    assert one(spark, N.snap_tag_valid("x"), list(ok) + bad + [None]) == [True, True] + [False] * 6


def test_target_url(spark):
    assert one(spark, N.target_url("x"), ["foo.bar.io"]) == ["http://foo.bar.io/"]


def test_strip_dots_and_primary(spark):
    assert one(spark, N.strip_dots("x"), ["a.b..", None, "...", "a"]) == ["a.b", "", "", "a"]
    df = spark.createDataFrame([("", "a"), ("a", "a"), ("b", "a"), ("A", "a")], "q string, d string")
    assert [r[0] for r in df.select(N.is_primary("q", "d")).collect()] == [False, True, False, False]


def test_topic_tag(spark):
    assert one(spark, N.topic_tag("x"), ["newly_registered_domains_measurements",
                                          "newly_issued_certificates_measurements", "other"]) == ["domains", "certs", "other"]


def test_label_suffixes(spark):
    got = one(spark, N.label_suffixes("x"), ["ns1.a.b.com", "com", ""])
    assert got == [[".a.b.com", ".b.com", ".com"], [], []]


def test_file_names(spark):
    names = ["newly_registered_domains_measurements.shard-10.parquet", "certstream_domains.shard-1.sample.parquet", "x.txt"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = df.select(N.file_topic("n"), N.file_shard("n"), N.file_is_sample("n")).collect()
    assert [tuple(r) for r in got] == [("newly_registered_domains_measurements", 10, False),
                                        ("certstream_domains", 1, True), ("", None, False)]


def test_window_end_and_tags(spark):
    # 2024-01-01 00:00 UTC is a boundary: it opens the window ending 12:00
    ms = [1704067200000, 1704067200000 - 1, 1704110399999]
    got = one(spark, T.snap_tag_of_ms("x"), ms, "bigint")
    assert got == ["snap-2024-01-01-12", "snap-2024-01-01-00", "snap-2024-01-01-12"]


def test_retention_case(spark):
    tags = ["snap-2026-05-28-12", "snap-2026-04-15-00", "parking-DAY-2026-05-28-12", "parking-DAY-2026-04-15-00",
            "parking-state", "parking-audit-2026-04", "v1.0"]
    df = spark.createDataFrame([(t,) for t in tags], "tag string")
    # cut-off 2026-05-01 = today minus keep_days
    got = sorted(r.tag for r in expired_tags(df, "2026-05-31", 30).collect())
    assert got == ["parking-DAY-2026-04-15-00", "snap-2026-04-15-00"]
