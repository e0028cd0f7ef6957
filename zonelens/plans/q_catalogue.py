"""Rollup and ad-hoc catalogue queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonelens.operators import catalogue as C
from zonelens.operators.rollup import extract_rows, rollup_measurements
from zonelens.plans import fixture as X
from zonelens.plans import oracle as O
from zonelens.plans.registry import joined, register
from zonelens.sources import projection as P

W = O.with_(*O.OBS_CTES)
WP = O.with_(*O.OBS_CTES, O.PINNED)

# parameters of the catalogue queries on the fixture
ASN = "64530"
NS_HOST = "ns1.parkone.com"
NS_SUFFIX = ".parktwo.net"


@register("obs_rollup", W + "SELECT * FROM obs")
def obs_rollup(spark, sf):
    # full path: measurement messages -> posexplode -> classify -> rollup
    return rollup_measurements(P.measurement_envelopes(spark, sf), window_cols=["half"])


@register("extract_rows", O.with_(O.DNS_ROWS, O.KEYED) + """
SELECT half, off AS "offset", k AS kind, ts, topic,
       CASE WHEN k <> 'ns_ip' THEN domain END AS domain,
       CASE WHEN k = 'ns_ip' THEN qname WHEN k = 'ns' THEN ns END AS ns,
       CASE WHEN k = 'mx' THEN mx END AS mx, CASE WHEN k = 'mx' THEN pref END AS preference,
       CASE WHEN k IN ('ip', 'ns_ip') THEN qtype END AS qtype, CASE WHEN k IN ('ip', 'ns_ip') THEN ip END AS ip,
       CASE WHEN k IN ('ip', 'ns_ip') THEN asn END AS "as", CASE WHEN k IN ('ip', 'ns_ip') THEN cc END AS country,
       CAST(NULL AS VARCHAR) AS prefix, ttl, CASE WHEN k IN ('ip', 'ns_ip') THEN rtt END AS rtt,
       CAST(rcode AS BIGINT) AS rcode
FROM keyed WHERE k IS NOT NULL""")
def q_extract_rows(spark, sf):
    return extract_rows(P.answers(spark, sf), keep=["half"]).drop("pos")


@register("kind_counts", W + "SELECT k, count(*) AS n_rows FROM obs GROUP BY k")
def kind_counts(spark, sf):
    return C.kind_counts(X.obs(spark, sf))


@register("top_asn", WP + """
SELECT a AS asn, count(*) AS n_rows FROM pinned WHERE (half, k) = ('now', 'ip')
GROUP BY a QUALIFY row_number() OVER (ORDER BY n_rows DESC, asn NULLS LAST) <= 15""")
def top_asn(spark, sf):
    return C.top_asn(X.obs_half(spark, sf, "now"), 15)


@register("ip_churn", WP + """
SELECT domain, count(*) AS distinct_ips FROM (
  SELECT DISTINCT d AS domain, ip FROM pinned WHERE (half, k) = ('now', 'ip') AND d IS NOT NULL AND ip IS NOT NULL)
GROUP BY domain QUALIFY row_number() OVER (ORDER BY distinct_ips DESC, domain) <= 20""")
def ip_churn(spark, sf):
    return C.ip_churn(X.obs_half(spark, sf, "now"), 20)


@register("cert_ip_join", O.with_(*O.OBS_CTES, O.PINNED, O.CERT_NAMES) + f"""
SELECT source, fingerprint, d AS domain, ip, a AS asn
FROM (SELECT d, ip, a FROM pinned WHERE (half, k, a) = ('now', 'ip', '{ASN}'))
JOIN (SELECT source, fingerprint, {O.apex_sql('name')} AS d FROM cert_names WHERE half = 'now' GROUP BY ALL) USING (d)""")
def cert_ip_join(spark, sf):
    certs = P.cert_names(spark, sf).filter(F.col("half") == "now")
    return C.cert_ip_join(certs, X.obs_half(spark, sf, "now"), ASN, match="apex")


@register("cert_ip_exact", O.with_(*O.OBS_CTES, O.PINNED, O.CERT_NAMES) + f"""
SELECT source, fingerprint, d AS domain, ip, a AS asn
FROM (SELECT d, ip, a FROM pinned WHERE (half, k, a) = ('now', 'ip', '{ASN}'))
JOIN (SELECT source, fingerprint, name AS d FROM cert_names WHERE half = 'now' GROUP BY ALL) USING (d)""")
def cert_ip_exact(spark, sf):
    certs = P.cert_names(spark, sf).filter(F.col("half") == "now")
    return C.cert_ip_join(certs, X.obs_half(spark, sf, "now"), ASN, match="exact")


NS_DOMAINS_SQL = WP + f"""
SELECT d AS domain, fs, ls, n FROM pinned WHERE (half, k, s) = ('now', 'ns', '{NS_HOST}')"""


@register("ns_domains", NS_DOMAINS_SQL)
def ns_domains(spark, sf):
    return C.ns_domains(X.obs_half(spark, sf, "now"), NS_HOST)


@register("ns_concentration", WP + f"""
SELECT ns_host, count(*) AS new_domains, CAST(sum(seen) AS BIGINT) AS total_measurements,
       min(first_ms) AS first_ms, max(last_ms) AS last_ms
FROM (SELECT s AS ns_host, d, sum(n) AS seen, min(fs) AS first_ms, max(ls) AS last_ms
      FROM pinned WHERE (half, k) = ('now', 'ns') AND suffix(s, '{NS_SUFFIX}') GROUP BY s, d)
GROUP BY ns_host""")
def ns_concentration(spark, sf):
    return C.ns_concentration(X.obs_half(spark, sf, "now"), NS_SUFFIX)


@register("ns_asn_reverse", WP + f"""
SELECT d AS domain, s AS ns_host, fs, ls, n FROM pinned AS del
WHERE (half, k) = ('now', 'ns')
  AND EXISTS (FROM pinned h WHERE (h.half, h.k, h.a) = ('now', 'ns_ip', '{ASN}') AND h.s = del.s)""")
def ns_asn_reverse(spark, sf):
    return C.ns_asn_reverse(X.obs_half(spark, sf, "now"), ASN)


@register("ns_hosting_as", WP + f"""
SELECT a AS asn, c AS country, count(DISTINCT d) AS domain_cnt, count(DISTINCT ip) AS distinct_ips
FROM pinned WHERE (half, k) = ('now', 'ip')
  AND d IN (SELECT d FROM pinned WHERE (half, k, s) = ('now', 'ns', '{NS_HOST}'))
GROUP BY ALL""")
def ns_hosting_as(spark, sf):
    return C.ns_hosting_as(X.obs_half(spark, sf, "now"), NS_HOST)


@register("ns_set_change", WP + f"""
SELECT d AS domain, {O.sorted_set('s', "half = 'prev'")} AS prev_ns, {O.sorted_set('s', "half = 'now'")} AS now_ns
FROM pinned WHERE k = 'ns' GROUP BY d HAVING prev_ns <> now_ns""")
def ns_set_change(spark, sf):
    o = X.obs(spark, sf)
    r = C.ns_set_change(o.filter(F.col("half") == "prev"), o.filter(F.col("half") == "now"))
    return r.select("domain", joined("prev_ns").alias("prev_ns"), joined("now_ns").alias("now_ns"))


@register("as_change", WP + """
SELECT d AS domain, min(a) FILTER (WHERE half = 'prev') AS prev_asn, min(a) FILTER (WHERE half = 'now') AS now_asn
FROM pinned WHERE k = 'ip' GROUP BY d HAVING prev_asn <> now_asn""")
def as_change(spark, sf):
    o = X.obs(spark, sf)
    return C.as_change(o.filter(F.col("half") == "prev"), o.filter(F.col("half") == "now"))


LOOKUP_DOMAIN = "d7.net"


LOOKUP_SQL = W + f"""
SELECT half, k, topic, d, s, m, q, ip, a, c, p, pr, tl, fs, ls, n, rc FROM obs WHERE d = '{LOOKUP_DOMAIN}' ORDER BY fs"""


@register("domain_lookup", LOOKUP_SQL)
def domain_lookup(spark, sf):
    """Point lookup of one domain over the stored observations (all kinds, all windows)."""
    o = X.obs(spark, sf)
    return o.filter(F.col("d") == LOOKUP_DOMAIN).select(o.columns).orderBy("fs")


@register("ip_rows", W + "SELECT count(*) AS n_rows FROM obs WHERE half = 'now' AND k = 'ip'")
def ip_rows(spark, sf):
    """AGG-17: global count with a filter (one window's `ip` rows)."""
    return X.obs_half(spark, sf, "now").filter(F.col("k") == "ip").agg(F.count(F.lit(1)).alias("n_rows"))


def _clustered(spark, sf):
    return spark.read.schema(X.OBS_FILE_SCHEMA).parquet(X.clustered(spark, sf))


@register("domain_lookup_clustered", LOOKUP_SQL)
def domain_lookup_clustered(spark, sf):
    """The point lookup over files of disjoint key ranges."""
    o = _clustered(spark, sf)
    return o.filter(F.col("d") == LOOKUP_DOMAIN).select(o.columns).orderBy("fs")


@register("ns_domains_clustered", NS_DOMAINS_SQL)
def ns_domains_clustered(spark, sf):
    return C.ns_domains(_clustered(spark, sf).filter(F.col("half") == "now"), NS_HOST)
