"""The ad-hoc query catalogue over observation tables.

Each function takes an observation DataFrame (S2 columns, optionally
with window columns) and returns a DataFrame; filters come first so that
they reach the Parquet scan, and semi joins replace DISTINCT + inner join.
Top-K queries carry a tie-break key so that their output is deterministic.
The catalogue reads the rows of one topic (`topic`, by default the registered
domains); None reads all topics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelens.functions.names import apex_of


TOPIC = "domains"


def pinned(obs: DataFrame, topic: str | None) -> DataFrame:
    """The rows of one topic (None: all)."""
    return obs if topic is None else obs.filter(F.col("topic") == topic)


def kind_counts(obs: DataFrame) -> DataFrame:
    """AGG-16: rows per kind."""
    return obs.groupBy("k").agg(F.count(F.lit(1)).alias("n_rows"))


def top_asn(obs: DataFrame, k: int = 15, topic: str | None = TOPIC) -> DataFrame:
    """AGG-2 / TOP-1: hosting ASN distribution of `ip` rows, top K."""
    obs = pinned(obs, topic)
    return (obs.filter(F.col("k") == "ip").groupBy(F.col("a").alias("asn"))
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .orderBy(F.desc("n_rows"), F.asc_nulls_last("asn")).limit(k))


def ip_churn(obs: DataFrame, k: int = 20, topic: str | None = TOPIC) -> DataFrame:
    """AGG-3: domains with the most distinct IPs, top K."""
    obs = pinned(obs, topic)
    return (obs.filter((F.col("k") == "ip") & F.col("d").isNotNull())
            .groupBy(F.col("d").alias("domain")).agg(F.countDistinct("ip").alias("distinct_ips"))
            .orderBy(F.desc("distinct_ips"), "domain").limit(k))


def cert_ip_join(cert_names: DataFrame, obs: DataFrame, asn: str, match: str = "exact",
                 topic: str | None = TOPIC) -> DataFrame:
    """JOIN-4 / GEN-2: certificates whose name was measured on an `ip` row of one ASN.

    `cert_names` has one row per certificate name (certIndex, source,
    fingerprint, name), i.e. `explode(domain_list)` of the list form.
    `match='exact'` joins the raw name; `match='apex'` joins its apex (the rule
    the parking delta uses), so `www.` and wildcard names count as well.
    """
    key = apex_of("name") if match == "apex" else F.col("name")
    # several names of a certificate can give one key: it counts once
    cs = cert_names.select("source", "fingerprint", key.alias("d")).distinct()
    ip = pinned(obs, topic).filter((F.col("k") == "ip") & (F.col("a") == asn)).select("d", "ip", F.col("a").alias("asn"))
    return cs.join(ip, "d").select("source", "fingerprint", F.col("d").alias("domain"), "ip", "asn")


def ns_domains(obs: DataFrame, ns_host: str, topic: str | None = TOPIC) -> DataFrame:
    """PRJ-13 / TOP-4: domains delegated to one name-server host, in time order."""
    obs = pinned(obs, topic)
    return (obs.filter((F.col("k") == "ns") & (F.col("s") == ns_host))
            .select(F.col("d").alias("domain"), "fs", "ls", "n").orderBy("fs", "domain"))


def ns_concentration(obs: DataFrame, suffix: str, topic: str | None = TOPIC) -> DataFrame:
    """AGG-4 / PRJ-14: per NS host under a suffix: distinct domains, measurements, first / last time."""
    obs = pinned(obs, topic)
    return (obs.filter((F.col("k") == "ns") & F.col("s").endswith(suffix))
            .groupBy(F.col("s").alias("ns_host"))
            .agg(F.countDistinct("d").alias("new_domains"), F.sum("n").alias("total_measurements"),
                 F.min("fs").alias("first_ms"), F.max("ls").alias("last_ms"))
            .orderBy(F.desc("new_domains"), "ns_host"))


def ns_asn_reverse(obs: DataFrame, asn: str, topic: str | None = TOPIC) -> DataFrame:
    """JOIN-5: NS hosts seen on an ASN (`ns_ip` rows) -> the domains delegated to them."""
    obs = pinned(obs, topic)
    hosts = obs.filter((F.col("k") == "ns_ip") & (F.col("a") == asn)).select(F.col("s").alias("ns_host"))
    ns = obs.filter(F.col("k") == "ns")
    return (ns.join(hosts, ns["s"] == hosts["ns_host"], "left_semi")
            .select(F.col("d").alias("domain"), F.col("s").alias("ns_host"), "fs", "ls", "n")
            .orderBy("fs", "domain"))


def ns_hosting_as(obs: DataFrame, ns_host: str, topic: str | None = TOPIC) -> DataFrame:
    """JOIN-6 / AGG-5: for the domains of one NS host, hosting AS / country concentration."""
    obs = pinned(obs, topic)
    doms = obs.filter((F.col("k") == "ns") & (F.col("s") == ns_host)).select("d")
    ip = obs.filter(F.col("k") == "ip")
    return (ip.join(doms, "d", "left_semi")
            .groupBy(F.col("a").alias("asn"), F.col("c").alias("country"))
            .agg(F.countDistinct("d").alias("domain_cnt"), F.countDistinct("ip").alias("distinct_ips"))
            .orderBy(F.desc("domain_cnt"), "asn", "country"))


def _ns_sets(obs: DataFrame) -> DataFrame:
    # the NS set of a domain is small (its delegation), and collect_set is
    # combined map-side, so the list per group stays bounded by distinct hosts
    return (obs.filter(F.col("k") == "ns").groupBy("d")
            .agg(F.sort_array(F.collect_set("s")).alias("ns_set")))


def ns_set_change(prev_obs: DataFrame, now_obs: DataFrame, topic: str | None = TOPIC) -> DataFrame:
    """JOIN-7 / AGG-6: domains whose sorted NS set differs between two windows."""
    prev_obs, now_obs = pinned(prev_obs, topic), pinned(now_obs, topic)
    y, t = _ns_sets(prev_obs).alias("y"), _ns_sets(now_obs).alias("t")
    return (y.join(t, "d").filter(F.col("y.ns_set") != F.col("t.ns_set"))
            .select(F.col("d").alias("domain"), F.col("y.ns_set").alias("prev_ns"), F.col("t.ns_set").alias("now_ns")))


def as_change(prev_obs: DataFrame, now_obs: DataFrame, topic: str | None = TOPIC) -> DataFrame:
    """JOIN-8 / AGG-11: domains whose (string-)minimum hosting ASN changed between two windows."""
    prev_obs, now_obs = pinned(prev_obs, topic), pinned(now_obs, topic)
    def per(o):
        return o.filter(F.col("k") == "ip").groupBy("d").agg(F.min("a").alias("asn"))
    y, t = per(prev_obs).alias("y"), per(now_obs).alias("t")
    return (y.join(t, "d").filter(F.col("y.asn") != F.col("t.asn"))
            .select(F.col("d").alias("domain"), F.col("y.asn").alias("prev_asn"), F.col("t.asn").alias("now_asn")))


def domain_history(obs_with_path: DataFrame, domain: str, kind: str = "ip") -> DataFrame:
    """SRC-10 / TOP-4: one domain across all windows with the source file of each row.

    Expects a `file_path` column (from `_metadata.file_path`)."""
    return (obs_with_path.filter((F.col("d") == domain) & (F.col("k") == kind))
            .select("file_path", "d", "ip", "fs", "n").orderBy("fs", "ip"))
