"""Spark operators against plain-Python models of the same semantics on random inputs."""

import random

from zonelens.operators import parking as K
from zonelens.operators.rollup import rollup_measurements
from zonelens.schemas import DNS_ROW, OBS_COLUMNS

ENV = ("topic string, offset bigint, measurement struct<id: string, resultList: array<"
       + DNS_ROW.simpleString()[len("struct<"):-1].join(["struct<", ">"]) + ">>")
FIELDS = [f.name for f in DNS_ROW.fields]
TAG = {"newly_registered_domains_measurements": "domains", "newly_issued_certificates_measurements": "certs"}


def _messages(rng, n):
    doms = ["a.com", "b.net", "c.io", "A.com", "d.org"]
    offs = rng.sample(range(10_000), n)
    out = []
    for off in offs:
        mid = rng.choice(doms + ["", None]) or None
        if mid and rng.random() < 0.3:
            mid += "." * rng.randint(1, 2)
        rl = None if rng.random() < 0.05 else []
        for _ in range(rng.randint(0, 4) if rl is not None else 0):
            base = (mid or "x").rstrip(".")
            r = dict(
                query_type=rng.choice(["A", "AAAA", "NS", "MX", "TXT", None]),
                query_name=rng.choice([base, base + ".", "ns1.host.net", "", None, "A.com"]),
                timestamp=None if rng.random() < 0.1 else rng.randint(0, 1000),
                status_code=rng.choice([None, 0, 3, 2]), response_ttl=rng.choice([None, 60, 300]),
                ip4_address=rng.choice([None, "", "1.1.1.1", "2.2.2.2"]), ip6_address=rng.choice([None, "", "::1"]),
                **{"as": rng.choice([None, "1", "2"])}, country=rng.choice([None, "US", "NL"]),
                ip_prefix=rng.choice([None, "1.0.0.0/8"]),
                ns_address=rng.choice([None, "", "ns1.x.com", "ns1.x.com.", "ns2.y.net"]),
                mx_address=rng.choice([None, "", "mx.a.com."]), mx_preference=rng.choice([None, 0, 10]),
                rtt=1.0)
            rl.append(r)
        out.append((rng.choice(list(TAG)), off, mid, rl))
    return out


def _bare(name):
    """A name without trailing dots; None for an empty one."""
    return (name or "").rstrip(".") or None


def _addresses(r, own):
    ip = r["ip4_address"] or r["ip6_address"]
    place = dict(k="ip", d=own) if _bare(r["query_name"]) == own else dict(k="ns_ip", s=(r["query_name"] or "").rstrip("."))
    return ip is not None and dict(place, q=r["query_type"], ip=ip, a=r["as"], c=r["country"], p=r["ip_prefix"])


def _delegations(r, own):
    return _bare(r["query_name"]) == own and _bare(r["ns_address"]) and dict(k="ns", d=own, s=_bare(r["ns_address"]))


def _exchanges(r, own):
    return _bare(r["query_name"]) == own and _bare(r["mx_address"]) and dict(
        k="mx", d=own, m=_bare(r["mx_address"]), pr=r["mx_preference"])


# the documented rules, one per record type: what an answer says, or nothing
RULES = {"A": _addresses, "AAAA": _addresses, "NS": _delegations, "MX": _exchanges}
IDENTITY = ("k", "topic", "d", "s", "m", "q", "ip", "pr")


def _model(msgs):
    """Observations by the documented rules: say what each answer states, put the statements in
    order of (offset, position), gather those of one identity, describe the group by its head."""
    stated = []
    for topic, off, mid, answers in msgs:
        for pos, r in enumerate(answers or []):
            says = RULES.get(r["query_type"], lambda *_: False)(r, _bare(mid)) if _bare(mid) else False
            if says:
                row = {**dict.fromkeys(OBS_COLUMNS), **says, "topic": TAG[topic], "tl": r["response_ttl"], "rc": r["status_code"] or None}
                stated.append(((off, pos), row, r["timestamp"]))
    groups = {}
    for _, row, ts in sorted(stated, key=lambda x: x[0]):
        groups.setdefault(tuple(row[c] for c in IDENTITY) + (row["rc"],), []).append((row, ts))
    out = []
    for members in groups.values():
        times = [ts for _, ts in members if ts is not None]
        head = dict(members[0][0], n=len(members), fs=min(times, default=None), ls=max(times, default=None))
        out.append(tuple(head[c] for c in OBS_COLUMNS))
    return sorted(out, key=repr)


def test_rollup_matches_python_model(spark):
    rng = random.Random(7)
    msgs = _messages(rng, 600)
    rows = [(t, o, (m, [tuple(r[f] for f in FIELDS) for r in rl] if rl is not None else None)) for t, o, m, rl in msgs]
    got = rollup_measurements(spark.createDataFrame(rows, ENV)).collect()
    want = _model(msgs)
    assert sorted((tuple(r[c] for c in OBS_COLUMNS) for r in got), key=repr) == want
    assert len(want) > 50 and {w[0] for w in want} == {"ip", "ns_ip", "ns", "mx"}


def _apex(name):
    s = name.rstrip(".").lower()
    return ".".join(s.split(".")[-2:])


def test_parking_delta_matches_python_model(spark):
    rng = random.Random(11)
    suffixes = [("pa", ".park.com", True), ("pa", ".b.park.com", True), ("pb", ".two.net", True),
                ("pc", ".off.io", False), ("pd", ".none.org", True)]
    hosts = ["ns1.park.com", "ns2.b.park.com", "park.com", "ns.two.net", "ns.Two.net", "x.off.io", "ns.other.com"]
    obs = []
    for i in range(400):
        obs.append((rng.choice(["ns", "ns", "ip"]), rng.choice(["domains", "fqdn", "certs"]),
                    rng.choice([f"d{j}.com" for j in range(40)] + [None]), rng.choice(hosts + [None]),
                    rng.randint(0, 100), rng.randint(100, 200), rng.randint(1, 5)))
    snap = "snap-2026-01-02-00"
    seen = [(p, f"d{j}.com", rng.choice(["snap-2026-01-01-12", snap, "snap-2026-01-03-00"]), 1)
            for j in range(0, 40, 3) for p in ("pa", "pb")]
    certs = [(f"log{rng.randint(0, 2)}", rng.choice([f"f{i}", None]),
              None if rng.random() < 0.1 else [rng.choice([f"www.d{j}.com", f"*.D{j}.COM.", "", f"d{j}.com"])
                                               for _ in range(2)]) for i, j in enumerate(rng.choices(range(40), k=60))]
    O = spark.createDataFrame(obs, "k string, topic string, d string, s string, fs bigint, ls bigint, n bigint")
    P = spark.createDataFrame(suffixes, "provider string, suffix string, active boolean")
    S = spark.createDataFrame(seen, "provider string, domain string, first_snap string, first_ms bigint")
    C = spark.createDataFrame(certs, "source string, fingerprint string, domain_list array<string>")
    got = {(r.provider, r.domain): (r.ns_set, r.source_topics, r.first_ms, r.last_ms, r.observations,
                                    r.ct_sources, r.ct_fingerprints)
           for r in K.parking_delta(O, C, P, S, snap).collect()}

    today = {}
    for k, topic, d, s, fs, ls, n in obs:
        if k != "ns" or d is None or s is None:
            continue
        for p, suf, active in suffixes:
            if active and s.endswith(suf):
                e = today.setdefault((p, d), [set(), set(), fs, ls, 0])
                e[0].add(s), e[1].add(topic)
                e[2], e[3], e[4] = min(e[2], fs), max(e[3], ls), e[4] + n
    old = {(p, d) for p, d, fsnap, _ in seen if fsnap < snap}
    ct = {}
    for src, fp, names in certs:
        for nm in names or []:
            if nm.rstrip(".").lower() == "":
                continue
            e = ct.setdefault(_apex(nm), [set(), set()])
            if src is not None:
                e[0].add(src)
            if fp is not None:
                e[1].add(fp)
    want = {}
    for (p, d), (ns, tp, fs, ls, n) in today.items():
        if (p, d) in old:
            continue
        srcs, fps = ct.get(d, [set(), set()])
        want[(p, d)] = (sorted(ns), sorted(tp), fs, ls, n, sorted(srcs) or None, sorted(fps) or None)
    assert got == want and len(want) > 5


def test_label_suffix_join_equals_ends_with_on_adversarial_names(spark):
    rng = random.Random(3)
    parts = ["a", "b", "ab", "", "x-y"]
    def name():
        return ".".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))
    hosts = list({name() for _ in range(300)} | {"", ".", "..", "a.", ".a", "a..b"})
    sufs = list({("." + name()) for _ in range(40)} | {".", "..", ".a", "a", "", "b.ab"})
    O = spark.createDataFrame([("ns", "t", f"d{i}", h, 0, 0, 1) for i, h in enumerate(hosts)],
                              "k string, topic string, d string, s string, fs bigint, ls bigint, n bigint")
    P = spark.createDataFrame([(f"p{i}", s, True) for i, s in enumerate(sufs)], "provider string, suffix string, active boolean")
    got = sorted((r.provider, r.d) for r in K.match_providers(K.ns_rows(O), P, "labels").collect())
    want = sorted((f"p{j}", f"d{i}") for i, h in enumerate(hosts) for j, s in enumerate(sufs) if h.endswith(s))
    assert got == want and len(want) > 100
