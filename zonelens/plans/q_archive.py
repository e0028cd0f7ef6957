"""Archive, shard and release bookkeeping queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonelens.functions.names import file_topic, release_asset_name
from zonelens.functions.timefmt import snap_tag_of_ms, to_ms, window_end_ms
from zonelens.operators import housekeeping as H
from zonelens.plans import fixture as X
from zonelens.plans import oracle as O
from zonelens.plans.registry import register
from zonelens.session import scratch_path
from zonelens.sources import archive as A
from zonelens.sources.tables import table

TODAY = "2024-01-31"
KEEP_DAYS = 14
EXTRA_TAGS = ["parking-state", "parking-audit-2024-01", "v1.0"]
BACKFILL = dict(since="2024-01-05", topics=["newly_registered_domains_measurements",
                                             "newly_issued_certificates_measurements"], max_releases=5)
LOCAL_UNTIL = "2024-01-10"

CFG_SQL = "cfg AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{t}', {n})" for t, n, _ in H.SHARD_CONFIG) + ") AS c(topic_name, shards))"

SLICED = r"""sliced AS (
SELECT x.*, CASE WHEN (e0 - s0) // shards = 0 THEN shards - 1
                 ELSE least((off - s0) // ((e0 - s0) // shards), shards - 1) END AS shard
FROM (SELECT k.*, CASE topic WHEN 'domains' THEN 'newly_registered_domains_measurements'
                             WHEN 'fqdn' THEN 'newly_registered_fqdn_measurements'
                             ELSE 'newly_issued_certificates_measurements' END AS topic_name,
             (ts // 43200000 + 1) * 43200000 AS end_ms FROM keyed k) x
JOIN (SELECT topic_name, end_ms, min(off) AS s0, max(off) + 1 AS e0 FROM
        (SELECT off, (ts // 43200000 + 1) * 43200000 AS end_ms,
                CASE topic WHEN 'domains' THEN 'newly_registered_domains_measurements'
                           WHEN 'fqdn' THEN 'newly_registered_fqdn_measurements'
                           ELSE 'newly_issued_certificates_measurements' END AS topic_name FROM dns_rows) m
      GROUP BY topic_name, end_ms) b USING (topic_name, end_ms)
JOIN cfg USING (topic_name)),
sliced_w AS (SELECT *, strftime(epoch_ms(end_ms), '%Y-%m-%d') AS date, strftime(epoch_ms(end_ms), '%H') AS hour FROM sliced)"""

ARCHIVE_OBS = r"""aobs AS (
SELECT topic_name, date, hour, CAST(shard AS VARCHAR) AS shard, k, topic, d, s, m, q, ip,
       CASE WHEN k IN ('ip', 'ns_ip') THEN arg_min(asn, off) END AS a,
       CASE WHEN k IN ('ip', 'ns_ip') THEN arg_min(cc, off) END AS c,
       CAST(NULL AS VARCHAR) AS p, CAST(pref AS BIGINT) AS pr,
       CAST(arg_min(ttl, off) AS BIGINT) AS tl, CAST(min(ts) AS BIGINT) AS fs, CAST(max(ts) AS BIGINT) AS ls,
       CAST(count(*) AS BIGINT) AS n, CAST(NULLIF(rcode, 0) AS BIGINT) AS rc
FROM (SELECT topic_name, date, hour, shard, off, ts, topic, rcode, asn, cc, ttl, ip, pref, k,
             CASE WHEN qname = domain THEN domain END AS d,
             CASE WHEN qtype IN ('A', 'AAAA') AND qname <> domain THEN qname WHEN qtype = 'NS' THEN ns END AS s,
             mx AS m, CASE WHEN qtype IN ('A', 'AAAA') THEN qtype END AS q
      FROM sliced_w) x
WHERE k IS NOT NULL
GROUP BY topic_name, date, hour, shard, k, topic, d, s, m, q, ip, pref, rcode)"""

W_ARCH = O.with_(O.DNS_ROWS, O.KEYED, CFG_SQL, SLICED, ARCHIVE_OBS)


def _archive(spark, sf):
    return A.observations(spark, X.archive_root(spark, sf))


@register("archive_roundtrip", W_ARCH + "SELECT * FROM aobs")
def archive_roundtrip(spark, sf):
    o = _archive(spark, sf)
    return o.select(*A.SPARK_PARTS, *[c for c in o.columns if c not in A.SPARK_PARTS + ["file_path"]])


@register("window_counts", W_ARCH + """
SELECT topic_name AS topic, date, hour, count(*) AS n_rows FROM aobs GROUP BY 1, 2, 3 ORDER BY date DESC, hour DESC, topic""")
def window_counts(spark, sf):
    return H.window_counts(_archive(spark, sf))


@register("shard_slices", W_ARCH + """
SELECT topic_name AS topic, date, hour, CAST(shard AS INTEGER) AS shard, count(*) AS n_msgs,
       min(off) AS first_offset, max(off) AS last_offset
FROM sliced_w GROUP BY 1, 2, 3, 4""")
def shard_slices(spark, sf):
    e = X.sliced_envelopes(spark, sf)
    return e.groupBy(F.col("topic_name").alias("topic"), "date", "hour", "shard").agg(
        F.count(F.lit(1)).alias("n_msgs"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))


# landed files = shards with at least one message; expected = every window between the
# first and the last one of the data, for the three measurement topics
EXPECTED_SQL = r"""span AS (SELECT min((ts // 43200000 + 1) * 43200000) AS a, max((ts // 43200000 + 1) * 43200000) AS b FROM dns_rows),
wins AS (SELECT strftime(epoch_ms(e), '%Y-%m-%d') AS date, strftime(epoch_ms(e), '%H') AS hour
         FROM (SELECT unnest(range(a, b + 1, 43200000)) AS e FROM span) r),
expected AS (SELECT c.topic_name AS topic, w.date, w.hour, CAST(s.shard AS INTEGER) AS shard
             FROM wins w, cfg c, (SELECT unnest(range(0, 11)) AS shard) s WHERE s.shard < c.shards),
landed AS (SELECT DISTINCT topic_name AS topic, date, hour, CAST(shard AS INTEGER) AS shard FROM aobs)"""


def _inventory(spark, sf):
    return A.inventory(spark, X.archive_root(spark, sf))


def _expected(spark, sf):
    e = table(spark, sf, "events", "ts").select(to_ms("ts").alias("ms"))
    wins = H.windows_spanning(e, "ms")
    cfg = [c for c in H.SHARD_CONFIG if c[0] in X.ARCHIVE_TOPICS]
    return H.expected_shards(wins, cfg)


@register("missing_shards", O.with_(O.DNS_ROWS, O.KEYED, CFG_SQL.replace(
    "('certstream_domains', 2), ", "").replace(", ('certstream_domains', 2)", ""), SLICED, ARCHIVE_OBS, EXPECTED_SQL) + """
SELECT * FROM expected EXCEPT SELECT * FROM landed""")
def missing_shards(spark, sf):
    return H.missing_shards(_expected(spark, sf), _inventory(spark, sf))


@register("short_windows", W_ARCH + """
SELECT l.topic_name AS topic, date, hour, count(DISTINCT shard) AS shards_present, c.shards AS shards_expected
FROM (SELECT DISTINCT topic_name, date, hour, shard FROM aobs) l JOIN cfg c USING (topic_name)
GROUP BY l.topic_name, date, hour, c.shards HAVING count(DISTINCT shard) < c.shards""")
def short_windows(spark, sf):
    return H.short_windows(_inventory(spark, sf), H.shard_config(spark))


def _tags(spark, sf):
    e = table(spark, sf, "events", "ts")
    snap = snap_tag_of_ms(to_ms("ts"))
    t = e.select(snap.alias("t")).distinct()
    tags = (t.select(F.col("t").alias("tag"))
            .unionByName(t.select(F.concat(F.lit("parking-DAY-"), F.substring("t", 6, 13)).alias("tag")))
            .unionByName(t.select(F.substring("t", 1, 15).alias("tag")).distinct()))
    extra = spark.createDataFrame([(x,) for x in EXTRA_TAGS], "tag string")
    return tags.unionByName(extra)


@register("expired_snapshots", O.with_(O.DNS_ROWS) + f"""
, t AS (SELECT DISTINCT 'snap-' || strftime(epoch_ms((ts // 43200000 + 1) * 43200000), '%Y-%m-%d-%H') AS t FROM dns_rows)
, tags AS (SELECT t AS tag FROM t UNION ALL SELECT 'parking-DAY-' || substr(t, 6, 13) FROM t
           UNION ALL SELECT DISTINCT substr(t, 1, 15) FROM t
           UNION ALL SELECT unnest([{", ".join(repr(x) for x in EXTRA_TAGS)}]))
SELECT tag, CASE WHEN tag LIKE 'snap-%' THEN substr(tag, 6, 10) ELSE substr(tag, 13, 10) END AS tag_date FROM tags
WHERE (regexp_matches(tag, '^snap-\\d{{4}}-\\d{{2}}-\\d{{2}}(-(00|12))?$') AND substr(tag, 6, 10) < CAST('{TODAY}'::DATE - {KEEP_DAYS} AS VARCHAR))
   OR (regexp_matches(tag, '^parking-DAY-\\d{{4}}-\\d{{2}}-\\d{{2}}-(00|12)$') AND substr(tag, 13, 10) < CAST('{TODAY}'::DATE - {KEEP_DAYS} AS VARCHAR))""")
def expired_snapshots(spark, sf):
    return H.expired_tags(_tags(spark, sf), TODAY, KEEP_DAYS)


def _listing(spark, sf):
    # one release asset per landed shard slice, plus a sample file per slice of the domains topic
    s = shard_slices(spark, sf)
    tag = F.concat(F.lit("snap-"), F.col("date"), F.lit("-"), F.col("hour"))
    full = F.struct(release_asset_name("topic", "shard").alias("name"),
                    (F.lit(1000) + F.lit(64) * F.col("n_msgs")).cast("bigint").alias("size"))
    sample = F.when(F.col("topic") == "newly_registered_domains_measurements", F.struct(
        F.format_string("%s.shard-%d.sample.parquet", "topic", "shard").alias("name"),
        F.lit(500).cast("bigint").alias("size")))
    x = s.select(tag.alias("tag"), F.explode(F.array(full, sample)).alias("f")).filter(F.col("f").isNotNull())
    return x.select("tag", "f.name", "f.size")


def _local(listing):
    # held locally: windows up to LOCAL_UNTIL; certificate-topic files held with a stale size
    held = listing.filter(F.substring("tag", 6, 10) <= LOCAL_UNTIL)
    return held.select("tag", "name", F.when(file_topic("name") == "newly_issued_certificates_measurements",
                                             F.col("size") - 1).otherwise(F.col("size")).alias("size"))


@register("backfill_plan", W_ARCH + f"""
, files AS (
  SELECT 'snap-' || date || '-' || hour AS tag, topic_name || '.shard-' || CAST(shard AS VARCHAR) || '.parquet' AS name,
         CAST(1000 + 64 * count(*) AS BIGINT) AS size, date, hour, topic_name AS topic, CAST(shard AS INTEGER) AS shard
  FROM sliced_w GROUP BY topic_name, date, hour, shard)
, local_files AS (
  SELECT tag, name, CASE WHEN topic = 'newly_issued_certificates_measurements' THEN size - 1 ELSE size END AS size
  FROM files WHERE date <= '{LOCAL_UNTIL}')
, pending AS (
  SELECT * FROM files f WHERE date >= '{BACKFILL["since"]}'
    AND topic IN ({", ".join(repr(t) for t in BACKFILL["topics"])})
    AND NOT EXISTS (SELECT 1 FROM local_files l WHERE l.tag = f.tag AND l.name = f.name AND l.size = f.size))
, ranked AS (SELECT date, hour, dense_rank() OVER (ORDER BY date, hour) AS r FROM (SELECT DISTINCT date, hour FROM pending) d)
SELECT p.tag, p.name, p.size, p.date, p.hour, p.topic, p.shard, false AS is_sample
FROM pending p JOIN ranked USING (date, hour) WHERE r <= {BACKFILL["max_releases"]}""")
def backfill_plan(spark, sf):
    listing = _listing(spark, sf)
    return H.backfill_plan(listing, _local(listing), **BACKFILL)


@register("snap_boundary", """
SELECT event_id, epoch_us(ts) // 1000 AS ms, (epoch_us(ts) // 1000 // 43200000 + 1) * 43200000 AS window_end_ms,
       'snap-' || strftime(epoch_ms((epoch_us(ts) // 1000 // 43200000 + 1) * 43200000), '%Y-%m-%d-%H') AS snap_tag
FROM events""")
def snap_boundary(spark, sf):
    e = table(spark, sf, "events", "event_id", "ts")
    ms = to_ms("ts")
    return e.select("event_id", ms.alias("ms"), window_end_ms(ms).alias("window_end_ms"),
                    snap_tag_of_ms(ms).alias("snap_tag"))


AUDIT_TODAY, AUDIT_DAYS = "2024-01-31", 14


@register("ns_audit_recent", W_ARCH + ", " + O.audit_sql(f"""
SELECT d, s FROM aobs WHERE date >= CAST(DATE '{AUDIT_TODAY}' - {AUDIT_DAYS} AS VARCHAR)
  AND topic = 'domains' AND k = 'ns' AND s IS NOT NULL AND d IS NOT NULL""", 500) + "SELECT * FROM audit")
def ns_audit_recent(spark, sf):
    """JOB-8 over the last days of the archive, registered domains only."""
    from zonelens.operators.audit import ns_audit_topk, recent
    t = ns_audit_topk(recent(_archive(spark, sf), AUDIT_TODAY, AUDIT_DAYS), 500)
    return t.withColumn("sample_domains", F.array_join("sample_domains", ","))


SLIDES = 10                     # the report is slid over so many days
SLIDE_DAYS = 5                  # of so many days each


def _slides() -> list[tuple[str, str]]:
    from datetime import date, timedelta
    last = date.fromisoformat(AUDIT_TODAY)
    ends = [last - timedelta(days=SLIDES - 1 - i) for i in range(SLIDES)]
    return [((d - timedelta(days=SLIDE_DAYS)).isoformat(), d.isoformat()) for d in ends]


def _sliding_sql() -> str:
    parts = []
    for first, last in _slides():
        body = O.audit_sql(f"""SELECT d, s FROM aobs WHERE date BETWEEN '{first}' AND '{last}'
            AND topic = 'domains' AND k = 'ns' AND s IS NOT NULL AND d IS NOT NULL""", 500)
        parts.append(f"SELECT '{last}' AS today, * FROM (WITH {body} SELECT * FROM audit)")
    return W_ARCH + " UNION ALL ".join(parts)


@register("audit_sliding", _sliding_sql())
def audit_sliding(spark, sf):
    """The audit slid over ten days, each report merged from the windows' stored sets."""
    from zonelens.operators.audit_sets import AuditSets
    key = ("audit-sets", *X._source_key(spark, sf))
    if key not in X._STORED:
        root = scratch_path(spark, "audit-sets")
        sets, archive = AuditSets(spark, root), _archive(spark, sf)
        first = _slides()[0][0]
        wins = archive.filter(F.col("date") >= first).select("date", "hour").distinct().orderBy("date", "hour").collect()
        for w in wins:                                       # one row per window
            sets.append(archive.filter((F.col("date") == w.date) & (F.col("hour") == w.hour)), f"snap-{w.date}-{w.hour}")
        X._STORED[key] = root
    sets = AuditSets(spark, X._STORED[key])
    out = None
    for first, last in _slides():
        part = sets.report(f"snap-{first}-00", f"snap-{last}-12").select(F.lit(last).alias("today"), "*")
        out = part if out is None else out.unionByName(part)
    return out.withColumn("sample_domains", F.array_join("sample_domains", ","))


@register("apex_top_asn", W_ARCH + f""", doms AS (
SELECT DISTINCT {O.last_two_labels('s')} AS ns_apex, d FROM aobs WHERE topic = 'domains' AND k = 'ns' AND s IS NOT NULL AND d IS NOT NULL),
hosted AS (SELECT DISTINCT d, a FROM aobs WHERE topic = 'domains' AND k = 'ip' AND d IS NOT NULL AND a IS NOT NULL),
per AS (SELECT ns_apex, a, count(*) AS n FROM doms JOIN hosted USING (d) GROUP BY ns_apex, a)
SELECT ns_apex, a AS top_asn, n AS asn_domains, n_asns, CAST(hosted_domains AS BIGINT) AS hosted_domains
FROM (SELECT *, count(*) OVER (PARTITION BY ns_apex) AS n_asns, sum(n) OVER (PARTITION BY ns_apex) AS hosted_domains,
             row_number() OVER (PARTITION BY ns_apex ORDER BY n DESC, a) AS r FROM per) WHERE r = 1""")
def apex_top_asn(spark, sf):
    """The AS that hosts most domains of each name-server apex."""
    from zonelens.operators.audit import top_asn_per_apex
    return top_asn_per_apex(_archive(spark, sf))


# in the planted window every delegation of the archive goes to the inactive provider
SURGE_DATE, SURGE_HOUR, SURGE_HOST, SURGE_N = "2024-01-20", "12", "ns1.bigdns.io", 14


@register("surge", O.with_(O.DNS_ROWS, O.KEYED, CFG_SQL, SLICED, ARCHIVE_OBS, O.PROVIDERS, f"""
planted AS (SELECT epoch_ms(strptime(date || hour, '%Y-%m-%d%H')) AS window_end_ms, d, k,
                   CASE WHEN (date, hour) = ('{SURGE_DATE}', '{SURGE_HOUR}') THEN '{SURGE_HOST}' ELSE s END AS s FROM aobs),
hits AS (SELECT provider, window_end_ms, count(DISTINCT d) AS domains FROM planted JOIN providers ON ends_with(s, suffix)
         WHERE NOT active AND k = 'ns' AND d IS NOT NULL GROUP BY ALL),
grid AS (SELECT w.window_end_ms, p.provider FROM (SELECT DISTINCT window_end_ms FROM planted) w,
         (SELECT DISTINCT provider FROM providers WHERE NOT active) p),
filled AS (SELECT provider, window_end_ms, coalesce(domains, 0) AS domains FROM grid LEFT JOIN hits USING (provider, window_end_ms)),
based AS (SELECT *, median(domains) OVER f AS baseline, mad(domains) OVER f AS spread_of, count(*) OVER f AS n FROM filled
          WINDOW f AS (PARTITION BY provider ORDER BY window_end_ms ROWS BETWEEN {SURGE_N} PRECEDING AND 1 PRECEDING))""") + f"""
SELECT provider, window_end_ms, domains, CAST(baseline AS DOUBLE) AS baseline, greatest(1.0, 1.4826 * spread_of)::DOUBLE AS spread
FROM based WHERE n = {SURGE_N} AND domains >= 5 AND domains > baseline + 3.0 * greatest(1.0, 1.4826 * spread_of)""")
def surge(spark, sf):
    """Windows in which an inactive provider surges against its last windows."""
    from zonelens.operators.audit import provider_windows, surge_report
    from zonelens.sources.projection import providers
    o = _archive(spark, sf)
    end = F.unix_millis(F.to_timestamp(F.concat("date", "hour"), "yyyy-MM-ddHH"))
    there = (F.col("date") == SURGE_DATE) & (F.col("hour") == SURGE_HOUR)
    o = o.withColumn("window_end_ms", end).withColumn("s", F.when(there, SURGE_HOST).otherwise(F.col("s")))
    idle = providers(spark).filter("not active").select("provider", "suffix", F.lit(True).alias("active"))
    return surge_report(provider_windows(o, idle, o.select("window_end_ms")), SURGE_N)
