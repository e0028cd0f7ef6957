"""Ingest-side queries: certificate JSON, drift, statistics, samples, legacy rows, names."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonelens.functions.names import apex_of, topic_tag
from zonelens.jobs import run_certificate_stream, run_certificates
from zonelens.operators import certs as CT
from zonelens.operators.catalogue import domain_history
from zonelens.plans import fixture as X
from zonelens.plans import oracle as O
from zonelens.plans.q_archive import W_ARCH
from zonelens.plans.registry import joined, register
from zonelens.schemas import CERTIFICATE
from zonelens.session import scratch_path
from zonelens.sinks.writers import sample_first_n
from zonelens.sources import archive as A
from zonelens.sources import projection as P
from zonelens.sources.tables import table

SAMPLE_N = 5
HISTORY_DOMAIN = "d7.net"

DOM_SQL = ("concat('d', CAST(user_id AS VARCHAR), CASE user_id % 3 WHEN 0 THEN '.com' WHEN 1 THEN '.net' ELSE '.io' END)")


COERCE_SQL = f"""
SELECT event_id AS certIndex, epoch_us(ts) // 1000000 AS seen, CAST(trunc(value) AS BIGINT) AS submission_timestamp,
       'log' || CAST(event_id % 4 AS VARCHAR) AS source,
       CASE WHEN event_id % 2 = 0 THEN 'X509LogEntry' ELSE 'PrecertLogEntry' END AS updateType,
       md5(CAST(event_id AS VARCHAR)) AS fingerprint,
       array_to_string(list_sort([{DOM_SQL}, 'www.' || {DOM_SQL}, '*.' || upper({DOM_SQL}) || '.']), ',') AS domain_list,
       {DOM_SQL} AS sld_list
FROM events WHERE event_type <> 'error'"""


def _joined_lists(c):
    return c.withColumn("domain_list", joined("domain_list")).withColumn("sld_list", joined("sld_list"))


@register("json_coerce", COERCE_SQL)
def json_coerce(spark, sf):
    return _joined_lists(CT.certificates_only(CT.parse_certificates(P.cert_envelopes(spark, sf))))


DRIFT_SQL = """
SELECT 'certstream_domains' AS topic, field, min(event_id) AS first_offset, count(*) AS n
FROM (SELECT event_id, unnest(json_keys(props)) AS field FROM events WHERE event_type <> 'error') k
WHERE field NOT IN ('certIndex', 'seen', 'submission_timestamp', 'source', 'updateType', 'fingerprint', 'domain_list', 'sld_list')
GROUP BY field"""


@register("json_drift", DRIFT_SQL)
def json_drift(spark, sf):
    return CT.json_drift(P.cert_envelopes(spark, sf))


STATS_SQL = """
SELECT 'certstream_domains' AS topic, count(*) FILTER (WHERE event_type <> 'error') AS lines_written,
       count(*) FILTER (WHERE event_type = 'error') AS errors, count(*) AS msgs
FROM events"""


def _cert_job(spark, sf) -> dict:
    """The certificate job, run once per session."""
    key = ("cert-job", *X._source_key(spark, sf))
    if key not in X._STORED:
        X._STORED[key] = run_certificates(P.cert_envelopes(spark, sf), scratch_path(spark, "cert-job"))
    return X._STORED[key]


@register("cert_job", COERCE_SQL)
def cert_job(spark, sf):
    """The certificates that the one-pass job wrote."""
    return _joined_lists(spark.read.schema(CERTIFICATE).parquet(_cert_job(spark, sf)["rows"] + "/kind=certificate"))


@register("cert_job_drift", DRIFT_SQL)
def cert_job_drift(spark, sf):
    return CT.drift_of(spark.read.parquet(_cert_job(spark, sf)["rows"]))


SPAN_SQL = """, max(event_id) - min(event_id) + 1 AS offset_span,
       round(100.0 * count(*) / (max(event_id) - min(event_id) + 1), 2) AS coverage_pct
FROM events"""


@register("cert_job_stats", STATS_SQL.replace("\nFROM events", SPAN_SQL))
def cert_job_stats(spark, sf):
    return CT.metrics_report(spark.read.schema(CT.METRICS).parquet(_cert_job(spark, sf)["stats"])).drop("bytes_in")


@register("cert_stream_stats", STATS_SQL.replace("\nFROM events", SPAN_SQL))
def cert_stream_stats(spark, sf):
    """The same numbers from the streaming job over the messages in several files."""
    base = scratch_path(spark, "cert-stream")
    env = P.cert_envelopes(spark, sf)
    env.repartitionByRange(4, "offset").write.parquet(f"{base}/in")
    stream = spark.readStream.schema(env.schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/in")
    done = run_certificate_stream(stream, f"{base}/out", f"{base}/checkpoint")
    return CT.metrics_report(spark.read.schema(CT.METRICS).parquet(done["stats"])).drop("bytes_in")


@register("json_errors", STATS_SQL)
def json_errors(spark, sf):
    s = CT.json_stats(CT.parse_certificates(P.cert_envelopes(spark, sf)))
    return s.select("topic", "lines_written", "errors", "msgs")


@register("ingest_stats", O.with_(*O.OBS_CTES) + """
, m AS (SELECT topic, half, count(*) AS msgs, max(off) - min(off) + 1 AS offset_span FROM dns_rows GROUP BY topic, half)
, k AS (SELECT topic, half, count(*) AS keys, CAST(sum(n) AS BIGINT) AS answers FROM obs GROUP BY topic, half)
SELECT m.topic, m.half, msgs, coalesce(answers, 0) AS answers, coalesce(keys, 0) AS keys, offset_span,
       round(100.0 * msgs / greatest(offset_span, 1), 2) AS coverage_pct,
       round(coalesce(answers, 0) / greatest(coalesce(keys, 0), 1), 2) AS reduction_ratio
FROM m LEFT JOIN k USING (topic, half)""")
def ingest_stats(spark, sf):
    env = P.measurement_envelopes(spark, sf)
    msgs = env.select(topic_tag("topic").alias("topic"), "half", "offset")
    return CT.ingest_stats(msgs, X.obs(spark, sf), group=("topic", "half"))


@register("sample_first_n", f"""
SELECT topic, off AS _kafka_offset, epoch_us(ts) // 1000 AS _kafka_ts, hex(props) AS value
FROM (SELECT CASE event_id % 3 WHEN 0 THEN 'newly_registered_domains_measurements'
                               WHEN 1 THEN 'newly_registered_fqdn_measurements'
                               ELSE 'newly_issued_certificates_measurements' END AS topic,
             event_id AS off, ts, props,
             row_number() OVER (PARTITION BY event_id % 3 ORDER BY event_id) AS rn FROM events) x
WHERE rn <= {SAMPLE_N}""")
def q_sample_first_n(spark, sf):
    s = sample_first_n(P.payload_envelopes(spark, sf), SAMPLE_N)
    return s.withColumn("_kafka_ts", F.unix_millis("_kafka_ts"))


@register("apex_labels", """
SELECT page_id, host, array_to_string(list_slice(string_split(lower(rtrim(host, '.')), '.'), -2, -1), '.') AS apex
FROM (SELECT page_id, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]*)', 1) AS host FROM pages) p""")
def apex_labels(spark, sf):
    p = table(spark, sf, "pages", "page_id", "url")
    host = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]*)", 1)
    return p.select("page_id", host.alias("host")).select("page_id", "host", apex_of("host").alias("apex"))


@register("domain_history", W_ARCH + f"""
SELECT topic_name, date, hour, shard, d, ip, fs, n FROM aobs WHERE d = '{HISTORY_DOMAIN}' AND k = 'ip'""")
def q_domain_history(spark, sf):
    o = A.observations(spark, X.archive_root(spark, sf))
    h = domain_history(o, HISTORY_DOMAIN)
    part = lambda k: F.regexp_extract("file_path", rf"/{k}=([^/]+)/", 1).alias(k)
    return h.select(part("topic_name"), part("date"), part("hour"), part("shard"), "d", "ip", "fs", "n")
