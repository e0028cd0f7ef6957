"""Streaming queries and the legacy-format union."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonelens.operators.rollup import extract_rows, flatten_measurements, rollup_measurements
from zonelens.plans import fixture as X
from zonelens.plans import oracle as O
from zonelens.plans.registry import register
from zonelens.session import scratch_path
from zonelens.sinks.writers import write_json_lines
from zonelens.sources import archive as A
from zonelens.sources import projection as P
from zonelens.streaming.first_seen import final_state, run_first_seen
from zonelens.streaming.rollup_stream import run_available_now, streaming_rollup
from zonelens.streaming.window_rollup import run_window_rollup, window_observations

WATERMARK = "1 hour"
WATERMARK_MS = 3_600_000


def _event_stream(spark, sf):
    path = f"{sf.rstrip('/')}/events.parquet"
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{sf.rstrip('/')}/events*.parquet")


@register("stream_rollup", O.with_(O.DNS_ROWS, O.KEYED) + f"""
, w AS (SELECT *, (ts // 43200000 + 1) * 43200000 AS window_end_ms FROM keyed WHERE k IS NOT NULL)
, r AS (
SELECT window_end_ms, k, topic, d, s, m, q, ip,
       CASE WHEN k IN ('ip', 'ns_ip') THEN arg_min(asn, off) END AS a,
       CASE WHEN k IN ('ip', 'ns_ip') THEN arg_min(cc, off) END AS c,
       CAST(NULL AS VARCHAR) AS p, CAST(pref AS BIGINT) AS pr,
       CAST(arg_min(ttl, off) AS BIGINT) AS tl, CAST(min(ts) AS BIGINT) AS fs, CAST(max(ts) AS BIGINT) AS ls,
       CAST(count(*) AS BIGINT) AS n, CAST(NULLIF(rcode, 0) AS BIGINT) AS rc
FROM (SELECT window_end_ms, off, ts, topic, rcode, asn, cc, ttl, ip, pref, k,
             CASE WHEN qname = domain THEN domain END AS d,
             CASE WHEN qtype IN ('A', 'AAAA') AND qname <> domain THEN qname WHEN qtype = 'NS' THEN ns END AS s,
             mx AS m, CASE WHEN qtype IN ('A', 'AAAA') THEN qtype END AS q FROM w) x
GROUP BY window_end_ms, k, topic, d, s, m, q, ip, pref, rcode)
SELECT CAST(window_end_ms AS BIGINT) AS window_end_ms, strftime(epoch_ms(window_end_ms), '%Y-%m-%d') AS date,
       strftime(epoch_ms(window_end_ms), '%H') AS hour, k, topic, d, s, m, q, ip, a, c, p, pr, tl, fs, ls, n, rc
FROM r WHERE window_end_ms <= (SELECT max(ts) FROM w) - {WATERMARK_MS}""")
def stream_rollup(spark, sf):
    base = scratch_path(spark, "stream-rollup")
    answers = flatten_measurements(P.measurement_envelopes_of(P.dns_rows_of(_event_stream(spark, sf))))
    run_available_now(streaming_rollup(answers, WATERMARK), f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out")


@register("stream_first_seen", O.with_(*O.OBS_CTES, O.PROVIDERS) + f"""
SELECT p.provider, o.d AS domain,
       arg_min(CASE o.half WHEN 'prev' THEN '{P.PREV_SNAP}' ELSE '{P.NOW_SNAP}' END, o.fs) AS first_snap,
       min(o.fs) AS first_ms
FROM obs o JOIN providers p ON ends_with(o.s, p.suffix)
WHERE o.k = 'ns' AND o.s IS NOT NULL AND o.d IS NOT NULL AND p.active
GROUP BY p.provider, o.d""")
def stream_first_seen(spark, sf):
    base = scratch_path(spark, "first-seen")
    X.obs(spark, sf)  # the stored observation table is the stream's source
    src = X._stored_path(spark, sf)
    stream = (spark.readStream.schema(X.OBS_FILE_SCHEMA).option("maxFilesPerTrigger", 4)
              .option("basePath", src).parquet(f"{src}/half=*"))
    snap = F.when(F.col("half") == "prev", P.PREV_SNAP).otherwise(P.NOW_SNAP)
    run_first_seen(stream.withColumn("snap", snap), P.providers(spark), f"{base}/state", f"{base}/checkpoint")
    return final_state(spark, f"{base}/state")


def _legacy_root(spark, sf):
    key = ("legacy", *X._source_key(spark, sf))
    path = X._STORED.get(key)
    if path is None:
        path = scratch_path(spark, "legacy")
        rows = extract_rows(P.answers(spark, sf), keep=["half"]).filter(F.col("half") == "prev")
        write_json_lines(rows.drop("half", "offset", "pos"), path)
        X._STORED[key] = path
    return path


@register("legacy_union", O.with_(*O.OBS_CTES) + """
SELECT k, topic, d, s, m, q, ip, a, c, p, pr, tl, fs, ls, n, rc FROM obs WHERE half = 'now'
UNION ALL
SELECT k, topic, CASE WHEN k <> 'ns_ip' THEN domain END AS d,
       CASE WHEN k = 'ns_ip' THEN qname WHEN k = 'ns' THEN ns END AS s,
       CASE WHEN k = 'mx' THEN mx END AS m, CASE WHEN k IN ('ip', 'ns_ip') THEN qtype END AS q,
       CASE WHEN k IN ('ip', 'ns_ip') THEN ip END AS ip, CASE WHEN k IN ('ip', 'ns_ip') THEN asn END AS a,
       CASE WHEN k IN ('ip', 'ns_ip') THEN cc END AS c, CAST(NULL AS VARCHAR) AS p,
       CASE WHEN k = 'mx' THEN pref END AS pr, ttl AS tl, ts AS fs, ts AS ls, CAST(1 AS BIGINT) AS n,
       CAST(NULLIF(rcode, 0) AS BIGINT) AS rc
FROM keyed WHERE half = 'prev' AND k IS NOT NULL""")
def legacy_union(spark, sf):
    legacy = A.read_legacy_json(spark, _legacy_root(spark, sf) + "/*.json.gz")
    return A.union_legacy(X.obs_half(spark, sf, "now").drop("half"), legacy)


MESSAGE_CTES = (O.DNS_ROWS, O.KEYED, O.MESSAGES)


@register("obs_rollup_messages", O.with_(*MESSAGE_CTES, O.message_rollup("half")) + "SELECT * FROM rolled")
def obs_rollup_messages(spark, sf):
    """The rollup of messages that carry many answers, over several partitions."""
    return rollup_measurements(P.message_envelopes(spark, sf), window_cols=["half"])


@register("stream_rollup_messages", O.with_(*MESSAGE_CTES, O.message_rollup("window_end_ms")) + "SELECT * FROM rolled")
def stream_rollup_messages(spark, sf):
    """The same messages in files out of order, streamed: windows of broker time, late messages
    added to the windows that were closed before they came, the windows still open on top."""
    base = scratch_path(spark, "stream-messages")
    env = P.message_envelopes(spark, sf)
    env.repartition(5, F.pmod(F.xxhash64("offset", "partition", "topic"), F.lit(5))).write.parquet(f"{base}/in")
    stream = spark.readStream.schema(env.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    run_window_rollup(stream, f"{base}/out", f"{base}/checkpoint")
    return window_observations(spark, f"{base}/out", include_open=True)
