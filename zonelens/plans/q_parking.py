"""Parking delta, seen state and audit queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonelens.functions.names import ns_apex
from zonelens.operators import audit as A
from zonelens.operators import parking as K
from zonelens.plans import fixture as X
from zonelens.plans import oracle as O
from zonelens.plans.registry import joined, register
from zonelens.sources import projection as P

# audit threshold for the fixture scale (an apex of the pinned topic holds a few domains, not thousands)
AUDIT_THRESHOLD = 3
AUDIT_TOPK = 500


def hits_sql(name: str, half: str) -> str:
    """`name`: each provider's domains in one half.  A delegation counts once per suffix it ends in."""
    return f"""{name} AS (
SELECT provider, d AS domain, {O.sorted_set('s')} AS ns_set, {O.sorted_set('topic')} AS source_topics,
       min(fs) AS first_ms, max(ls) AS last_ms, CAST(sum(n) AS BIGINT) AS observations
FROM obs, providers
WHERE active AND (half, k) = ('{half}', 'ns') AND d IS NOT NULL AND suffix(s, providers.suffix)
GROUP BY ALL)"""


def unseen_sql(name: str, src: str) -> str:
    """`name`: the rows of `src` that the state does not have from an earlier window."""
    return f"""{name} AS (
SELECT * FROM {src} AS t WHERE NOT EXISTS (
  FROM seen WHERE first_snap < '{P.NOW_SNAP}' AND seen.provider = t.provider AND seen.domain = t.domain))"""


def signed_sql(name: str, src: str, half: str) -> str:
    """`name`: `src` with the certificates of each domain, gathered per apex beforehand."""
    return f"""{name}_certs AS (
SELECT {O.apex_sql('name')} AS domain, {O.sorted_set('source')} AS ct_sources, {O.sorted_set('fingerprint')} AS ct_fingerprints
FROM cert_names WHERE half = '{half}' AND rtrim(name, '.') <> '' GROUP BY 1),
{name} AS (SELECT * FROM {src} LEFT JOIN {name}_certs USING (domain))"""


BASE = (*O.OBS_CTES, O.CERT_NAMES, O.PROVIDERS, O.SEEN)
FRESH = (hits_sql("hits", "now"), unseen_sql("fresh", "hits"))
DELTA_NOW = O.with_(*BASE, *FRESH, signed_sql("delta", "fresh", "now"))
NS_COLS = "provider, domain, ns_set, source_topics, first_ms, last_ms, observations"

LIST_COLS = ["ns_set", "source_topics", "ct_sources", "ct_fingerprints"]


def _lists(df, cols=LIST_COLS):
    return df.select(*[joined(c).alias(c) if c in cols else F.col(c) for c in df.columns])


@register("parking_today", O.with_(*BASE, FRESH[0]) + f"SELECT {NS_COLS} FROM hits")
def parking_today(spark, sf):
    t = K.parking_today(X.obs_half(spark, sf, "now"), P.providers(spark))
    return _lists(t)


@register("parking_new", O.with_(*BASE, *FRESH) + f"SELECT {NS_COLS} FROM fresh")
def parking_new(spark, sf):
    t = K.parking_today(X.obs_half(spark, sf, "now"), P.providers(spark))
    return _lists(K.parking_new(t, X.seen(spark, sf), P.NOW_SNAP))


@register("parking_delta_ct", DELTA_NOW + f"SELECT {NS_COLS}, ct_sources, ct_fingerprints FROM delta")
def parking_delta_ct(spark, sf):
    return _lists(X.delta(spark, sf, "now"))


COUNTS_SQL = """
SELECT provider, count(domain) AS new_domains, count(ct_sources) AS ct_signal_count
FROM (SELECT provider FROM providers WHERE active GROUP BY provider) LEFT JOIN delta USING (provider) GROUP BY provider"""


@register("parking_counts", DELTA_NOW + COUNTS_SQL)
def parking_counts(spark, sf):
    return K.delta_counts(X.delta(spark, sf, "now"), P.providers(spark))


@register("archive_candidates_of", DELTA_NOW + """
SELECT domain, provider, 'http://' || domain || '/' AS url FROM delta
WHERE provider = 'park_dual' AND 'domains' IN (SELECT unnest(string_split(source_topics, ',')))
ORDER BY domain LIMIT 10""")
def archive_candidates_of(spark, sf):
    """One provider's candidates, limited (the limit is the feature)."""
    return K.archive_candidates(X.delta(spark, sf, "now"), limit=10, provider="park_dual")


SEEN_MERGED_SQL = DELTA_NOW + f"""
SELECT provider, domain, first_snap, first_ms
FROM (SELECT provider, domain, first_snap, first_ms FROM seen
      UNION ALL BY NAME SELECT provider, domain, first_ms, '{P.NOW_SNAP}' AS first_snap FROM delta)
QUALIFY row_number() OVER (PARTITION BY provider, domain ORDER BY first_ms, first_snap) = 1"""


@register("seen_merge", SEEN_MERGED_SQL)
def seen_merge(spark, sf):
    return K.merge_seen(X.seen(spark, sf), X.delta(spark, sf, "now"), P.NOW_SNAP)


@register("seen_layers", SEEN_MERGED_SQL)
def seen_layers(spark, sf):
    """The state as layers: several windows, the current one written twice, compacted."""
    from zonelens.session import scratch_path
    layers = X.layered_state(spark, scratch_path(spark, "seen-layers"), X.seen(spark, sf))
    for _ in range(2):
        layers.append(K.parking_delta(X.obs_half(spark, sf, "now"), X.certs_half(spark, sf, "now"), P.providers(spark),
                                      layers.read(), P.NOW_SNAP), P.NOW_SNAP)
    layers.compact()
    return layers.merged()


@register("parking_new_layers", O.with_(*BASE, *FRESH) + f"SELECT {NS_COLS} FROM fresh")
def parking_new_layers(spark, sf):
    """The window's new pairs against the bucketed state, which is not exchanged."""
    t = K.parking_today(X.obs_half(spark, sf, "now"), P.providers(spark))
    return _lists(K.parking_new(t, X.seen_layers(spark, sf).read(), P.NOW_SNAP))


@register("delta_job_layers", SEEN_MERGED_SQL)
def delta_job_layers(spark, sf):
    """The delta job with a layered state: the state after it."""
    from zonelens.jobs import run_delta
    from zonelens.session import scratch_path
    base = scratch_path(spark, "delta-layers")
    layers = X.layered_state(spark, f"{base}/seen", X.seen(spark, sf))
    run_delta(X.obs_half(spark, sf, "now"), X.certs_half(spark, sf, "now"), P.providers(spark), layers, P.NOW_SNAP, f"{base}/out")
    return layers.merged()


REBUILT_SQL = O.with_(*BASE, hits_sql("before", "prev"), hits_sql("hits", "now")) + f"""
SELECT provider, domain, arg_min(snap, (first_ms, snap)) AS first_snap, min(first_ms) AS first_ms
FROM (SELECT provider, domain, first_ms, '{P.PREV_SNAP}' AS snap FROM before
      UNION ALL SELECT provider, domain, first_ms, '{P.NOW_SNAP}' FROM hits)
GROUP BY provider, domain"""


@register("seen_rebuild", REBUILT_SQL)
def seen_rebuild(spark, sf):
    """Two windows run one after the other, the first seeding each provider; the state is then
    rebuilt from the stored deltas and must equal the running one, which has a row more per difference."""
    from zonelens.operators.seen_layers import SeenLayers, rebuild_seen, seed_provider
    from zonelens.session import scratch_path
    base = scratch_path(spark, "seen-rebuild")
    layers = SeenLayers(spark, f"{base}/seen")
    prev = X.obs_half(spark, sf, "prev")
    names = [r.provider for r in K.active_provider_names(P.providers(spark)).collect()]     # config rows
    seeds = None
    for name in names:
        part = seed_provider(prev, P.providers(spark), name)
        seeds = part if seeds is None else seeds.unionByName(part)
    seeds.write.parquet(f"{base}/deltas/snap={P.PREV_SNAP}")
    layers.append(spark.read.parquet(f"{base}/deltas/snap={P.PREV_SNAP}"), P.PREV_SNAP)
    today = K.parking_today(X.obs_half(spark, sf, "now"), P.providers(spark))
    K.parking_new(today, layers.read(), P.NOW_SNAP).select("provider", "domain", "first_ms") \
        .write.parquet(f"{base}/deltas/snap={P.NOW_SNAP}")
    layers.append(spark.read.parquet(f"{base}/deltas/snap={P.NOW_SNAP}"), P.NOW_SNAP)
    rebuilt = rebuild_seen(spark.read.parquet(f"{base}/deltas"))
    return rebuilt.unionAll(layers.merged().exceptAll(rebuilt))


def united(c: str) -> str:
    """The union of comma-joined sets over the rows of a group."""
    return f"list_aggregate(list_sort(list_distinct(string_split(string_agg({c}, ','), ','))), 'string_agg', ',') AS {c}"


@register("day_rollup", O.with_(*BASE, hits_sql("before", "prev"), signed_sql("first_half", "before", "prev"), *FRESH,
                                signed_sql("delta", "fresh", "now")) + f"""
SELECT provider, domain, {", ".join(united(c) for c in LIST_COLS)},
       min(first_ms) AS first_ms, max(last_ms) AS last_ms, CAST(sum(observations) AS BIGINT) AS observations
FROM (FROM first_half UNION ALL BY NAME FROM delta) GROUP BY provider, domain""")
def day_rollup(spark, sf):
    prev = X.delta(spark, sf, "prev", with_seen=False)
    now = X.delta(spark, sf, "now")
    return _lists(K.day_rollup(prev, now))


@register("archive_candidates", DELTA_NOW + """
SELECT domain, provider, 'http://' || domain || '/' AS url FROM delta
WHERE 'domains' IN (SELECT unnest(string_split(source_topics, ',')))""")
def archive_candidates(spark, sf):
    return K.archive_candidates(X.delta(spark, sf, "now"))


AUDIT_SQL = O.with_(*O.OBS_CTES, O.PROVIDERS, O.PINNED, O.audit_sql(
    "SELECT d, s FROM pinned WHERE k = 'ns' AND s IS NOT NULL AND d IS NOT NULL", AUDIT_TOPK))
RULED = "ns_apex IN (SELECT ltrim(suffix, '.') FROM providers WHERE active)"


@register("ns_audit_topk", AUDIT_SQL + "SELECT * FROM audit")
def ns_audit_topk(spark, sf):
    t = A.ns_audit_topk(X.obs(spark, sf), AUDIT_TOPK)
    return t.withColumn("sample_domains", F.array_join("sample_domains", ","))


@register("audit_unhandled", AUDIT_SQL + f"""
SELECT * FROM audit WHERE new_domains >= {AUDIT_THRESHOLD} AND NOT {RULED}
ORDER BY new_domains DESC, ns_apex LIMIT 50""")
def audit_unhandled(spark, sf):
    t = A.ns_audit_topk(X.obs(spark, sf), AUDIT_TOPK)
    u = A.audit_unhandled(t, P.providers(spark), AUDIT_THRESHOLD)
    return u.withColumn("sample_domains", F.array_join("sample_domains", ","))


@register("audit_configured", AUDIT_SQL + f"""
SELECT ns_apex, new_domains, distinct_ns_hosts FROM audit WHERE new_domains >= {AUDIT_THRESHOLD} AND {RULED}
ORDER BY new_domains DESC, ns_apex LIMIT 30""")
def audit_configured(spark, sf):
    t = A.ns_audit_topk(X.obs(spark, sf), AUDIT_TOPK)
    return A.audit_configured(t, P.providers(spark), AUDIT_THRESHOLD)


@register("delta_job", DELTA_NOW + COUNTS_SQL)
def delta_job(spark, sf):
    """The whole delta job; its counts read back."""
    return spark.read.schema("provider string, new_domains bigint, ct_signal_count bigint") \
        .option("header", True).csv(_delta_job(spark, sf)["counts"])


def _delta_job(spark, sf) -> dict:
    """One run of the whole job (files per provider, counts CSV, manifest, new state)."""
    from zonelens.jobs import run_delta
    from zonelens.session import scratch_path
    base = scratch_path(spark, "delta-job")
    return run_delta(X.obs_half(spark, sf, "now"), X.certs_half(spark, sf, "now"), P.providers(spark),
                     X.seen(spark, sf), P.NOW_SNAP, base, f"{base}/seen-new")


@register("delta_job_files", DELTA_NOW + f"SELECT {NS_COLS}, ct_sources, ct_fingerprints FROM delta")
def delta_job_files(spark, sf):
    """The per-provider Parquet files of a delta run, read back."""
    paths = _delta_job(spark, sf)
    like = X.delta(spark, sf, "now")
    return _lists(spark.read.schema(like.schema).parquet(paths["delta"]).select(*like.columns))


@register("delta_job_state", SEEN_MERGED_SQL)
def delta_job_state(spark, sf):
    """The new first-seen state of a delta run, read back."""
    from zonelens.schemas import SEEN
    return spark.read.schema(SEEN).parquet(_delta_job(spark, sf)["seen"])


VOLUME_NS = f"""vol AS (
SELECT 'ns' AS k, CASE l_returnflag WHEN 'A' THEN 'domains' WHEN 'N' THEN 'fqdn' ELSE 'certs' END AS topic,
       concat('p', CAST(l_partkey AS VARCHAR), '.com') AS d,
       concat('ns', CAST(l_linenumber % 2 + 1 AS VARCHAR), '.', CASE WHEN l_suppkey % 3 = 0 THEN '{P.HOT_APEX}'
              ELSE concat('h', CAST(l_suppkey % {P.COLD_APEXES} AS VARCHAR), '.org') END) AS s,
       CAST(l_quantity AS BIGINT) AS n, epoch_us(l_shipdate) // 1000 AS fs, epoch_us(l_shipdate) // 1000 AS ls
FROM lineitem)"""


@register("volume_audit", O.with_(VOLUME_NS, O.audit_sql("SELECT d, s FROM vol", AUDIT_TOPK)) + "SELECT * FROM audit")
def volume_audit(spark, sf):
    t = A.ns_audit_topk(P.lineitem_ns_obs(spark, sf), AUDIT_TOPK, topic=None)
    return t.withColumn("sample_domains", F.array_join("sample_domains", ","))


@register("volume_concentration", "WITH " + VOLUME_NS + f"""
SELECT s AS ns_host, count(DISTINCT d) AS new_domains, CAST(sum(n) AS BIGINT) AS total_measurements,
       min(fs) AS first_ms, max(ls) AS last_ms
FROM vol WHERE ends_with(s, '.{P.HOT_APEX}') GROUP BY s""")
def volume_concentration(spark, sf):
    from zonelens.operators.catalogue import ns_concentration
    return ns_concentration(P.lineitem_ns_obs(spark, sf), "." + P.HOT_APEX, topic=None)


# certificates of the volume fixture: one per line, for the name server's apex; chunks of so many fingerprints
VOLUME_CHUNK = 500


@register("volume_ct_chunks", "WITH " + VOLUME_NS.replace("SELECT 'ns' AS k", "SELECT md5(l_orderkey || '-' || l_linenumber) AS fp, 'ns' AS k") + f"""
, certs AS (SELECT DISTINCT {O.last_two_labels('s')} AS domain, fp FROM vol),
sizes AS (SELECT domain, (count(*) + {VOLUME_CHUNK - 1}) // {VOLUME_CHUNK} AS n_chunks FROM certs GROUP BY domain)
SELECT domain, CAST(('0x' || substr(md5(fp), 1, 8))::BIGINT % n_chunks AS BIGINT) AS chunk, n_chunks, count(*) AS n_values,
       string_agg(fp, ',' ORDER BY fp) AS ct_fingerprints
FROM certs JOIN sizes USING (domain) GROUP BY ALL""")
def volume_ct_chunks(spark, sf):
    """The certificate signal of apexes of which one holds a third of all certificates, in numbered lists."""
    certs = P.lineitem_certs(spark, sf)
    wanted = P.lineitem_ns_obs(spark, sf).select(ns_apex("s").alias("domain")).distinct()
    return _lists(K.ct_signal_chunks(wanted, certs, VOLUME_CHUNK))
