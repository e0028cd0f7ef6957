"""Forms that exist for scale: digests at the scan, chunked lists, clustered files, mergeable sets, baselines."""

import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from zonelens.functions.bitmaps import key_digest, maybe_in
from zonelens.operators import audit as A
from zonelens.operators import parking as K
from zonelens.operators.audit_sets import AuditSets
from zonelens.sinks.writers import write_clustered

CERT = "source string, fingerprint string, domain_list array<string>"


@pytest.mark.parametrize("bits", [15, 20, 27])
def test_digest_keeps_every_member(spark, bits):
    keys = spark.range(0, 3000, 3).select(F.concat(F.lit("k"), "id").alias("key")).unionByName(
        spark.createDataFrame([(None,)], "key string"))
    rows = spark.range(3000).select("id", F.concat(F.lit("k"), "id").alias("key")).unionByName(
        spark.createDataFrame([(-1, None)], "id long, key string"))
    got = {r.id for r in maybe_in(rows, "key", key_digest(keys, "key", bits), bits).collect()}
    assert set(range(0, 3000, 3)) <= got and -1 not in got
    assert len(got) - 1000 <= 2000 * 3 * 1000 / (1 << bits) + 5
    assert maybe_in(rows, "key", key_digest(keys.limit(0), "key", bits), bits).count() == 0
    assert key_digest(keys, "key", bits).count() <= (1 << bits) // 32768


def test_certificates_are_reduced_before_their_shuffle(spark):
    """Names that reach the exact join follow the matches, not the log."""
    log = spark.range(50_000).select(F.lit("log").alias("source"), F.md5(F.col("id").cast("string").cast("binary")).alias("fingerprint"),
                                     F.array(F.concat(F.lit("www.d"), F.col("id") % 10_000, F.lit(".com"))).alias("domain_list"))
    wanted = spark.createDataFrame([(f"d{k}.com",) for k in range(20)], "domain string")
    joined = K.wanted_names(log, wanted)
    assert joined.count() == 100
    # the scan's rows meet the digest in a broadcast join, before any exchange of the names
    reduced = maybe_in(K.ct_names(log), "apex", key_digest(wanted.withColumnRenamed("domain", "apex"), "apex"))
    assert 100 <= reduced.count() <= 110
    plan = reduced._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning(apex" not in plan


def test_chunks_hold_every_fingerprint(spark):
    certs = [("l", f"f{k % 900}", ["www.big.com", "big.com"]) for k in range(2000)] + [("l", None, ["big.com"]), ("l", "x", ["a.small.org"])]
    today = spark.createDataFrame([("big.com",), ("small.org",), ("none.net",)], "domain string")
    rows = K.ct_signal_chunks(today, spark.createDataFrame(certs, CERT), chunk=50).collect()
    big = [r for r in rows if r.domain == "big.com"]
    assert sorted(f for r in big for f in r.ct_fingerprints) == sorted({f"f{k}" for k in range(900)})
    assert {r.n_chunks for r in big} == {18} and {r.chunk for r in big} <= set(range(18))
    assert all(r.n_values == len(r.ct_fingerprints) < 100 and list(r.ct_fingerprints) == sorted(r.ct_fingerprints) for r in big)
    assert [(r.domain, r.chunk, list(r.ct_fingerprints)) for r in rows if r.domain != "big.com"] == [("small.org", 0, ["x"])]


def test_chunks_never_gather_an_apex(spark):
    """Fingerprints are dealt by (apex, part), never by the apex alone, and no join broadcasts them."""
    certs = spark.range(4000).select(F.lit("l").alias("source"), F.concat(F.lit("f"), F.col("id") % 3000).alias("fingerprint"),
                                     F.array(F.lit("a.big.com"), F.lit("B.big.com."), F.lit(None), F.lit("..")).alias("domain_list"))
    today = spark.createDataFrame([("big.com",), (None,)], "domain string")
    got = K.ct_signal_chunks(today, certs, chunk=100)
    plan = got._jdf.queryExecution().executedPlan().toString().splitlines()
    dealt = [(line, under) for line, under in zip(plan, plan[1:]) if "Exchange hashpartitioning(apex" in line and "fingerprint" in under]
    assert dealt and not [line for line, _ in dealt if re.search(r"hashpartitioning\(apex#\d+, \d+\)", line)]
    rows = got.collect()
    assert sum(r.n_values for r in rows) == 3000 and {r.n_chunks for r in rows} == {30} and len({r.chunk for r in rows}) == 30
    assert sorted(f for r in rows for f in r.ct_fingerprints) == sorted(f"f{k}" for k in range(3000))


def test_clustered_files_do_not_overlap(spark, tmp_out):
    """By the footers, a lookup can skip all but one or two files of a window, hot domain or not."""
    obs = spark.range(40_000).selectExpr("CASE WHEN id % 2 = 0 THEN 'ns' ELSE 'ip' END AS k",
                                         "CASE WHEN id % 3 = 0 THEN 'hot.com' ELSE concat('d', lpad(id, 6, '0'), '.com') END AS d",
                                         "concat('ns', id, '.org') AS s", "concat('10.0.', id) AS ip",
                                         "CASE WHEN id < 20000 THEN 'w1' ELSE 'w2' END AS w")
    write_clustered(obs, tmp_out, ["w"], files=12)
    assert spark.read.parquet(tmp_out).count() == 40_000
    ranges: dict = {}
    local = tmp_out[len("file:"):] if tmp_out.startswith("file:") else tmp_out
    import glob
    sizes = []
    for path in glob.glob(f"{local}/w=*/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        sizes.append(meta.num_rows)
        at = {meta.row_group(0).column(c).path_in_schema: c for c in range(meta.num_columns)}
        stats = [[meta.row_group(g).column(at[c]).statistics for c in ("k", "d")] for g in range(meta.num_row_groups)]
        ranges.setdefault(path.split("w=")[1][:2], []).append((min((k.min, d.min) for k, d in stats), max((k.max, d.max) for k, d in stats),
                                                               [(k.min, k.max, d.min, d.max) for k, d in stats]))
    assert set(ranges) == {"w1", "w2"} and sum(map(len, ranges.values())) >= 12
    assert max(sizes) < 2.5 * (sum(sizes) / len(sizes))             # the hot domain does not fill one file
    for files in ranges.values():
        for point in ("d000001.com", "d010001.com", "d020001.com"):
            some = [f for f in files if any(a <= "ns" <= b and c <= point <= e for a, b, c, e in f[2])]
            assert len(some) <= 2


def test_audit_sets(spark, tmp_out):
    rows = [("ns", "domains", f"d{k % 30}.com", f"ns{k % 4}.apex{k % 3}.org", w) for k in range(120) for w in ("a", "b", "c")[:1 + k % 3]]
    obs = spark.createDataFrame(rows + [("ns", "fqdn", "x.com", "ns.other.org", "a"), ("ns", "domains", None, "ns1.apex1.org", "a")],
                                "k string, topic string, d string, s string, w string")
    sets = AuditSets(spark, f"{tmp_out}/sets", buckets=16)
    for w in ("a", "b", "c", "b"):
        sets.append(obs.filter(F.col("w") == w), w)
    sets.append(obs.limit(0), "d")
    key = lambda df: sorted(map(str, df.collect()))
    again = AuditSets(spark, f"{tmp_out}/sets", buckets=16)
    for first, last in (("a", "c"), ("b", "b"), ("c", "z"), ("d", "d")):
        want = A.ns_audit_topk(obs.filter(F.col("w").between(first, last)), 500)
        assert key(sets.report(first, last)) == key(want) == key(again.report(first, last))
    plan = sets.merged("domains", "a", "c")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan


def test_top_asn_ties(spark):
    rows = [("ns", "domains", d, "ns1.p.com", None) for d in ("a", "b", "c")]
    rows += [("ip", "domains", "a", None, "2"), ("ip", "domains", "a", None, "1"), ("ip", "domains", "b", None, "2"),
             ("ip", "domains", "b", None, "2"), ("ip", "domains", "c", None, "1"), ("ip", "domains", "z", None, "9"),
             ("ip", "domains", "c", None, None)]
    obs = spark.createDataFrame(rows, "k string, topic string, d string, s string, a string")
    assert [tuple(r) for r in A.top_asn_per_apex(obs).collect()] == [("p.com", "1", 2, 2, 4)]


def test_surge_baseline(spark):
    flat = [("p", w, 10 + w % 2) for w in range(20)]
    rows = flat[:15] + [("p", 15, 60), ("p", 16, 11), ("p", 17, 61)] + [("q", w, 0) for w in range(17)] + [("q", 17, 4)]
    got = A.surge_report(spark.createDataFrame(rows, "provider string, window_end_ms long, domains long"), n=6).collect()
    # the first surge is in the second one's baseline and does not hide it; too few domains are none
    assert sorted((r.provider, r.window_end_ms, r.domains, r.baseline) for r in got) == [("p", 15, 60, 10.5), ("p", 17, 61, 11.0)]
    assert {r.spread for r in got} == {1.0}


def test_windows_without_a_row_count_as_zero(spark):
    obs = spark.createDataFrame([("ns", "domains", "a.com", "ns1.x.io", 2)], "k string, topic string, d string, s string, window_end_ms long")
    prov = spark.createDataFrame([("x", ".x.io", True), ("y", ".y.io", True)], "provider string, suffix string, active boolean")
    got = A.provider_windows(obs, prov, spark.range(1, 4).withColumnRenamed("id", "window_end_ms"))
    assert sorted(map(tuple, got.collect())) == [("x", 1, 0), ("x", 2, 1), ("x", 3, 0), ("y", 1, 0), ("y", 2, 0), ("y", 3, 0)]
    assert A.provider_windows(obs, prov.limit(0), spark.range(1, 4).withColumnRenamed("id", "window_end_ms")).collect() == []
