"""Observation rollup on hand-made measurement messages (edge rows)."""

from zonelens.operators.rollup import extract_rows, flatten_measurements, rollup_measurements
from zonelens.schemas import DNS_ROW

ENV = ("topic string, offset bigint, measurement struct<id: string, resultList: array<"
       + DNS_ROW.simpleString()[len("struct<"):-1].join(["struct<", ">"]) + ">>")


def row(qt, qn, ts, rc=0, ttl=60, ip4=None, ip6=None, asn=None, cc=None, ns=None, mx=None, pref=None):
    return (qt, qn, ts, rc, ttl, ip4, ip6, asn, cc, None, ns, mx, pref, 1.5)


def envs(spark, msgs):
    return spark.createDataFrame(msgs, ENV)


def test_edge_rows(spark):
    T = "newly_registered_domains_measurements"
    msgs = [
        (T, 1, ("ex.com..", [row("A", "ex.com.", 100, ip4="1.1.1.1", asn="1", cc="US"),
                             row("A", "ex.com", 50, ip4="1.1.1.1", asn="2", cc="NL"),   # lower ts, later arrival
                             row("AAAA", "ex.com", 70, ip4="", ip6="::1"),
                             row("A", "", 10, ip4="9.9.9.9"),                             # empty name -> ns_ip, s=''
                             row("NS", "other.com", 10, ns="ns1.x.com"),                  # not primary -> dropped
                             row("NS", "ex.com", None, ns="ns1.x.com."),                  # null ts still counted
                             row("NS", "ex.com", 30, rc=None, ns="ns1.x.com"),
                             row("NS", "ex.com", 31, rc=3, ns="ns1.x.com"),
                             row("NS", "ex.com", 32, ns=""),                              # empty target -> dropped
                             row("MX", "ex.com", 40, mx="mx.ex.com.", pref=10),
                             row("TXT", "ex.com", 40)])),
        (T, 2, ("", [row("A", "", 1, ip4="1.1.1.1")])),      # empty id -> nothing
        (T, 3, ("null.com", None)),                            # null list -> nothing
        (T, 4, ("empty.com", [])),
    ]
    o = rollup_measurements(envs(spark, msgs))
    got = {(r.k, r.d, r.s, r.m, r.q, r.ip, r.rc): r for r in o.collect()}
    ip = got[("ip", "ex.com", None, None, "A", "1.1.1.1", None)]
    assert (ip.fs, ip.ls, ip.n, ip.a, ip.c, ip.topic) == (50, 100, 2, "1", "US", "domains")
    assert got[("ip", "ex.com", None, None, "AAAA", "::1", None)].n == 1
    assert got[("ns_ip", None, "", None, "A", "9.9.9.9", None)].n == 1
    ns = got[("ns", "ex.com", "ns1.x.com", None, None, None, None)]
    assert (ns.n, ns.fs, ns.ls) == (2, 30, 30)          # rc NULL and 0 share a key; NULL ts ignored in min/max
    assert got[("ns", "ex.com", "ns1.x.com", None, None, None, 3)].n == 1
    mx = got[("mx", "ex.com", None, "mx.ex.com", None, None, None)]
    assert mx.pr == 10 and mx.a is None
    assert len(got) == 6


def test_first_arrival_null_is_kept(spark):
    T = "newly_registered_fqdn_measurements"
    msgs = [(T, 1, ("a.io", [row("A", "a.io", 5, ip4="1.2.3.4", asn=None)])),
            (T, 2, ("a.io", [row("A", "a.io", 1, ip4="1.2.3.4", asn="7")]))]
    r = rollup_measurements(envs(spark, msgs)).collect()
    assert len(r) == 1 and r[0].a is None and r[0].fs == 1 and r[0].topic == "fqdn"


def test_flatten_keeps_order_and_extract(spark):
    T = "newly_registered_domains_measurements"
    msgs = [(T, 7, ("b.com", [row("NS", "b.com", 1, ns="n1.x"), row("NS", "b.com", 2, rc=0, ns="n2.x")]))]
    f = flatten_measurements(envs(spark, msgs)).orderBy("pos").collect()
    assert [(r.offset, r.pos, r.ns_address) for r in f] == [(7, 0, "n1.x"), (7, 1, "n2.x")]
    x = extract_rows(flatten_measurements(envs(spark, msgs))).collect()
    assert sorted((r.kind, r.ns, r.rcode, r.qtype) for r in x) == [("ns", "n1.x", 0, None), ("ns", "n2.x", 0, None)]
