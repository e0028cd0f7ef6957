"""Parking delta semantics on hand-made rows."""

from pyspark.sql import functions as F

from zonelens.operators import audit as A
from zonelens.operators import parking as K

OBS = "k string, topic string, d string, s string, fs bigint, ls bigint, n bigint"
CERT = "source string, fingerprint string, domain_list array<string>"


def providers(spark):
    rows = [("p_one", ".park.com", True), ("p_two", ".two.net", True), ("p_two", ".x.two.net", True),
            ("p_empty", ".nothing.org", True), ("p_off", ".off.io", False)]
    return spark.createDataFrame(rows, "provider string, suffix string, active boolean")


def obs(spark):
    rows = [("ns", "domains", "a.com", "ns1.park.com", 10, 20, 2),
            ("ns", "fqdn", "a.com", "ns2.park.com", 5, 30, 1),
            ("ns", "domains", "b.com", "park.com", 1, 1, 1),          # bare suffix: no match
            ("ns", "certs", "c.com", "ns1.x.two.net", 7, 8, 3),       # matches two suffixes of one provider
            ("ns", "domains", "d.com", "ns.off.io", 1, 2, 1),         # inactive provider
            ("ip", "domains", "a.com", None, 1, 1, 1)]
    return spark.createDataFrame(rows, OBS)


def test_theta_and_label_join_agree(spark):
    a = K.match_providers(K.ns_rows(obs(spark)), providers(spark), "labels")
    b = K.match_providers(K.ns_rows(obs(spark)), providers(spark), "theta")
    key = lambda r: (r.provider, r.d, r.s, r.topic)
    assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))
    assert sorted(map(key, a.collect())) == [("p_one", "a.com", "ns1.park.com", "domains"),
                                            ("p_one", "a.com", "ns2.park.com", "fqdn"),
                                            ("p_two", "c.com", "ns1.x.two.net", "certs"),
                                            ("p_two", "c.com", "ns1.x.two.net", "certs")]


def test_today_delta_counts(spark):
    t = {(r.provider, r.domain): r for r in K.parking_today(obs(spark), providers(spark)).collect()}
    a = t[("p_one", "a.com")]
    assert (a.ns_set, a.source_topics, a.first_ms, a.last_ms, a.observations) == (
        ["ns1.park.com", "ns2.park.com"], ["domains", "fqdn"], 5, 30, 3)
    assert t[("p_two", "c.com")].observations == 6       # counted once per matching suffix
    certs = spark.createDataFrame([("log1", "f1", ["*.A.COM.", "www.a.com"]), ("log2", "f2", None),
                                   ("log3", None, ["a.com"]), ("log4", "f4", ["", "z.org"])], CERT)
    seen = spark.createDataFrame([("p_two", "c.com", "snap-2026-01-01-00", 7)],
                                 "provider string, domain string, first_snap string, first_ms bigint")
    d = K.parking_delta(obs(spark), certs, providers(spark), seen, "snap-2026-01-01-12")
    rows = {r.domain: r for r in d.collect()}
    assert set(rows) == {"a.com"}
    assert rows["a.com"].ct_sources == ["log1", "log3"] and rows["a.com"].ct_fingerprints == ["f1"]
    c = {r.provider: (r.new_domains, r.ct_signal_count) for r in K.delta_counts(d, providers(spark)).collect()}
    assert c == {"p_one": (1, 1), "p_two": (0, 0), "p_empty": (0, 0)}


def test_no_ct_match_gives_null(spark):
    certs = spark.createDataFrame([("log1", "f1", ["www.zzz.com"])], CERT)
    d = K.parking_delta(obs(spark), certs, providers(spark), None, "snap-2026-01-01-12").collect()
    assert all(r.ct_sources is None and r.ct_fingerprints is None for r in d)


def test_rerun_is_idempotent(spark):
    certs = spark.createDataFrame([], CERT)
    snap = "snap-2026-01-01-12"
    d1 = K.parking_delta(obs(spark), certs, providers(spark), None, snap)
    state = K.merge_seen(None, d1, snap)
    d2 = K.parking_delta(obs(spark), certs, providers(spark), state, snap)   # same window again
    assert sorted(r.domain for r in d2.collect()) == sorted(r.domain for r in d1.collect())
    later = K.parking_delta(obs(spark), certs, providers(spark), state, "snap-2026-01-02-00")
    assert later.count() == 0
    s2 = K.merge_seen(state, d2, snap).collect()
    assert sorted((r.provider, r.domain, r.first_snap) for r in s2) == [
        ("p_one", "a.com", snap), ("p_two", "c.com", snap)]


def test_merge_seen_earliest_wins(spark):
    seen = spark.createDataFrame([("p", "a.com", "snap-2026-01-03-00", 50), ("p", "b.com", "snap-2026-01-01-00", 5)],
                                 "provider string, domain string, first_snap string, first_ms bigint")
    delta = spark.createDataFrame([("p", "a.com", 10), ("p", "c.com", 11)],
                                  "provider string, domain string, first_ms bigint")
    got = {r.domain: (r.first_snap, r.first_ms) for r in K.merge_seen(seen, delta, "snap-2026-01-02-00").collect()}
    assert got == {"a.com": ("snap-2026-01-02-00", 10), "b.com": ("snap-2026-01-01-00", 5),
                   "c.com": ("snap-2026-01-02-00", 11)}


def test_day_rollup_and_candidates(spark):
    a = spark.createDataFrame([("p", "a.com", ["n1"], ["domains"], 1, 2, 3, None, None)],
                              "provider string, domain string, ns_set array<string>, source_topics array<string>, "
                              "first_ms bigint, last_ms bigint, observations bigint, ct_sources array<string>, "
                              "ct_fingerprints array<string>")
    b = spark.createDataFrame([("p", "a.com", ["n0", "n1"], ["fqdn"], 0, 5, 1, ["l"], ["f"])], a.schema)
    r = K.day_rollup(a, b).collect()[0]
    assert (r.ns_set, r.source_topics, r.first_ms, r.last_ms, r.observations, r.ct_sources) == (
        ["n0", "n1"], ["domains", "fqdn"], 0, 5, 4, ["l"])
    c = K.archive_candidates(K.day_rollup(a, b)).collect()
    assert [(x.domain, x.url) for x in c] == [("a.com", "http://a.com/")]


def test_audit(spark):
    rows = [("ns", "domains", f"d{i}.com", f"ns{i % 3}.big.net", 1, 1, 1) for i in range(12)] + \
           [("ns", "domains", "x.com", "ns1.park.com", 1, 1, 1)]
    o = spark.createDataFrame(rows, OBS)
    t = {r.ns_apex: r for r in A.ns_audit_topk(o, k=10).collect()}
    assert t["big.net"].new_domains == 12 and t["big.net"].distinct_ns_hosts == 3
    assert t["big.net"].sample_domains == ["d0.com", "d1.com", "d10.com", "d11.com", "d2.com"]
    assert t["big.net"].sample_ns_host == "ns0.big.net"
    top = A.ns_audit_topk(o, k=10)
    assert [r.ns_apex for r in A.audit_unhandled(top, providers(spark), threshold=2).collect()] == ["big.net"]
    assert [r.ns_apex for r in A.audit_configured(top, providers(spark), threshold=1).collect()] == ["park.com"]


def test_archive_summary(spark):
    res = spark.createDataFrame([("a", "u", "queued", 200, None), ("b", "u", "error", 429, "http_429 slow down"),
                                 ("c", "u", "error", 500, "http_500"), ("d", "u", "no_job_id", 200, "")],
                                "domain string, url string, status string, http int, error string")
    got = {r.status: (r.n, r.rate_429) for r in K.archive_summary(res).collect()}
    assert got == {"queued": (1, 0), "error": (2, 1), "no_job_id": (1, 0)}


def test_manifest_order(spark):
    c = spark.createDataFrame([("b", 5, 1), ("a", 5, 0), ("z", 9, 2)], "provider string, new_domains bigint, ct_signal_count bigint")
    m = K.delta_manifest(c, "snap-2026-01-01-00", 1).collect()[0]
    assert [p.name for p in m.providers] == ["z", "b", "a"]


def test_ct_signal_rows_match_lists(spark):
    certs = spark.createDataFrame([("log1", "f1", ["*.A.COM.", "www.a.com"]), ("log3", "f3", ["a.com"])], CERT)
    today = K.parking_today(obs(spark), providers(spark))
    rows = sorted((r.provider, r.domain, r.source, r.fingerprint) for r in K.ct_signal_rows(today, certs).collect())
    assert rows == [("p_one", "a.com", "log1", "f1"), ("p_one", "a.com", "log3", "f3")]


def test_suffix_without_leading_dot_matches_literally(spark):
    p = spark.createDataFrame([("p_one", ".park.com", True), ("p_raw", "ark.com", True), ("p_all", "", True)],
                              "provider string, suffix string, active boolean")
    a = K.match_providers(K.ns_rows(obs(spark)), p, "labels")
    b = K.match_providers(K.ns_rows(obs(spark)), p, "theta")
    key = lambda r: (r.provider, r.d, r.s, r.topic)
    assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))
    assert {r.provider for r in a.collect()} == {"p_one", "p_raw", "p_all"}
