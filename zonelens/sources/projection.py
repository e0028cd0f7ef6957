"""Projection of the driver tables into the data model of DNS measurements.

`events` becomes a stream of DNS answers (one answer per event, offset =
event_id) carried by measurement messages; `providers` is the parking
provider dimension; `seen` a first-seen state before the `now` half.  The
rules below are the test fixture (FIXTURES.md section B); the DuckDB oracle
in `zonelens.plans.oracle` states the same rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelens import schemas
from zonelens.functions.names import TOPIC_TAGS
from zonelens.sources.tables import table

# fixed values of the fixture --------------------------------------------------
# the two consecutive "snapshots": events before this date are 'prev', else 'now'
HALF_SPLIT_DATE = "2024-01-16"
PREV_SNAP = "snap-2024-01-15-12"   # tag of the last window of the 'prev' half
SEEN_CUTOFF_MS = 1704240000000     # 2024-01-03 00:00 UTC: the prior state holds pairs first seen before it
NOW_SNAP = "snap-2024-01-16-00"    # tag of the 'now' half
# name-server host by user_id % 6
NS_HOSTS = ["parkone.com", "cust.parktwo.net", "dualpark.com", "dualpark.net", "bigdns.io", "otherdns.org"]
# TLD by user_id % 3
TLDS = [".com", ".net", ".io"]
# topic by event_id % 3
TOPICS = ["domains", "fqdn", "certs"]
# query type by event type (others -> TXT)
QTYPES = {"click": "A", "view": "AAAA", "purchase": "NS", "signup": "MX"}
# country by event_id % 4
COUNTRIES = ["US", "NL", "DE", "CN"]
# provider dimension: (provider, suffix, active)
PROVIDER_ROWS = [
    ("park_a", ".parkone.com", True),
    ("park_b", ".parktwo.net", True),
    ("park_dual", ".dualpark.com", True),
    ("park_dual", ".dualpark.net", True),
    ("park_none", ".nowhere.example", True),
    ("watch_c", ".bigdns.io", False),
]
# ------------------------------------------------------------------------------

_LONG_TOPIC = {v: k for k, v in TOPIC_TAGS.items()}


def _case(expr: str, values: list) -> str:
    return "CASE " + expr + " " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def dns_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per DNS answer (flat, fixture vocabulary: off, ts, domain, qname, ...)."""
    return dns_rows_of(table(spark, sf_dir, "events", *EVENT_COLUMNS))


def dns_rows_of(e: DataFrame) -> DataFrame:
    """`dns_rows` over any events DataFrame (batch or streaming)."""
    qtype = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in QTYPES.items()) + " ELSE 'TXT' END"
    base = e.selectExpr(
        "event_id AS off", "unix_millis(CAST(ts AS TIMESTAMP)) AS ts", "user_id", "value AS rtt",
        r"try_cast(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS kk",
        _case("user_id % 6", NS_HOSTS) + " AS host",
        "concat('d', CAST(user_id AS STRING), " + _case("user_id % 3", TLDS) + ") AS domain",
        _case("event_id % 3", TOPICS) + " AS topic",
        qtype + " AS qtype",
        f"CASE WHEN ts < DATE '{HALF_SPLIT_DATE}' THEN 'prev' ELSE 'now' END AS half",
    )
    return base.selectExpr(
        "off", "ts", "domain", "half", "topic", "qtype",
        "CASE WHEN kk % 4 <> 0 THEN domain ELSE concat('ns', CAST(off % 2 + 1 AS STRING), '.', host) END AS qname",
        "CASE qtype WHEN 'A' THEN concat('10.0.', CAST(user_id % 5 AS STRING), '.', CAST(kk % 7 AS STRING))"
        " WHEN 'AAAA' THEN concat('2001:db8::', CAST(kk % 7 AS STRING)) END AS ip",
        "CASE WHEN qtype = 'NS' THEN concat('ns', CAST(kk % 2 + 1 AS STRING), '.', host) END AS ns",
        "CASE WHEN qtype = 'MX' THEN concat('mx', CAST(kk % 3 AS STRING), '.mail', CAST(user_id % 4 AS STRING), '.com') END AS mx",
        "CASE WHEN qtype = 'MX' THEN CAST((kk % 3) * 10 AS BIGINT) END AS pref",
        "CASE WHEN kk % 10 = 9 THEN 3 ELSE 0 END AS rcode",
        "CAST(300 * (1 + off % 4) AS BIGINT) AS ttl",
        "concat('645', CAST((user_id + CASE WHEN half = 'now' AND user_id % 5 = 0 THEN 1 ELSE 0 END) % 6 AS STRING),"
        " CAST(off % 2 AS STRING)) AS asn",
        _case("off % 4", COUNTRIES) + " AS cc",
        "rtt",
    )


def _answer_row(r: DataFrame) -> Column:
    q = F.col("qtype")
    fields = {
        "query_type": q, "query_name": F.col("qname"), "timestamp": F.col("ts"),
        "status_code": F.col("rcode"), "response_ttl": F.col("ttl"),
        "ip4_address": F.when(q == "A", F.col("ip")), "ip6_address": F.when(q == "AAAA", F.col("ip")),
        "as": F.col("asn"), "country": F.col("cc"), "ip_prefix": F.lit(None),
        "ns_address": F.col("ns"), "mx_address": F.col("mx"), "mx_preference": F.col("pref"), "rtt": F.col("rtt"),
    }
    return F.struct(*[fields[f.name].cast(f.dataType).alias(f.name) for f in schemas.DNS_ROW.fields])


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DNS answers in measurement vocabulary: the flattened measurement messages."""
    from zonelens.operators.rollup import flatten_measurements
    return flatten_measurements(measurement_envelopes(spark, sf_dir), keep=["half"])


def measurement_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded measurement messages with their envelope (topic, partition, offset, timestamp).

    Each event is one message whose `resultList` holds its answer; the
    column layout is what a Kafka read followed by an Avro decode yields.
    """
    return measurement_envelopes_of(dns_rows(spark, sf_dir))


def measurement_envelopes_of(r: DataFrame) -> DataFrame:
    """`measurement_envelopes` over a `dns_rows` DataFrame (batch or streaming)."""
    long_topic = F.create_map(*[F.lit(x) for kv in _LONG_TOPIC.items() for x in kv])[F.col("topic")]
    return r.select(
        long_topic.alias("topic"), F.lit(0).alias("partition"), F.col("off").alias("offset"),
        F.timestamp_millis("ts").alias("timestamp"), "half",
        F.struct(F.col("domain").alias("id"), F.lit("DNS").alias("measurement_type"), F.lit("OK").alias("state"),
                 F.col("ts").alias("request_timestamp"),
                 F.array(_answer_row(r)).alias("resultList")).alias("measurement"),
    )


# fixed values of the message fixture: partitions of a topic, answers without an origin AS, without a time
MESSAGE_PARTITIONS = 3
NO_ASN_EVERY = 7
NO_TIME_EVERY = 11


def message_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurement messages with many answers each, over several partitions: a domain's answers of
    one topic and day are one message, newest answer first; the broker stamps it with the time of
    its last answer.  Offsets are counted per partition, so different messages share them.  Some
    answers have no origin AS, some no time."""
    r = dns_rows(spark, sf_dir).withColumn("day", F.floor(F.col("ts") / 86_400_000))
    r = r.withColumn("asn", F.when(F.col("off") % NO_ASN_EVERY != 0, F.col("asn"))).withColumn("at", F.col("ts"))
    r = r.withColumn("ts", F.when(F.col("off") % NO_TIME_EVERY != 0, F.col("ts")))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("off", _answer_row(r).alias("answer"))), asc=False),
                         lambda x: x["answer"])
    m = r.groupBy("domain", "topic", "day", "half").agg(listed.alias("resultList"), F.min("off").alias("first"), F.max("at").alias("at"))
    long_topic = F.create_map(*[F.lit(x) for kv in _LONG_TOPIC.items() for x in kv])[F.col("topic")]
    return m.select(
        long_topic.alias("topic"), (F.col("first") % MESSAGE_PARTITIONS).cast("int").alias("partition"),
        F.expr(f"first DIV {MESSAGE_PARTITIONS}").alias("offset"), F.timestamp_millis("at").alias("timestamp"), "half",
        F.struct(F.col("domain").alias("id"), F.lit("DNS").alias("measurement_type"), F.lit("OK").alias("state"),
                 F.col("at").alias("request_timestamp"), "resultList").alias("measurement"))


def cert_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Certificate log entries already unnested: certIndex, source, fingerprint, half, name."""
    c = certificates(spark, sf_dir)
    return c.select("certIndex", "source", "fingerprint", "half", F.explode("domain_list").alias("name"))


def certificates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Certificates in list form (S3 + half): one row per certificate, names in `domain_list`.

    Built per row (no grouping): every AAAA answer issues one certificate.
    """
    r = dns_rows(spark, sf_dir).filter("qtype = 'AAAA'")
    return r.selectExpr(
        "off AS certIndex", "CAST(ts DIV 1000 AS BIGINT) AS seen", "CAST(ts DIV 1000 AS BIGINT) AS submission_timestamp",
        "concat('log', CAST(off % 4 AS STRING)) AS source",
        "CASE WHEN off % 2 = 0 THEN 'X509LogEntry' ELSE 'PrecertLogEntry' END AS updateType",
        "md5(CAST(off AS STRING)) AS fingerprint",
        "array(domain, concat('www.', domain), concat('*.', upper(domain), '.')) AS domain_list",
        "array(domain) AS sld_list", "half")


def providers(spark: SparkSession) -> DataFrame:
    """Provider dimension, one row per suffix: provider, suffix, active."""
    rows = ", ".join(f"('{p}', '{s}', {str(a).lower()})" for p, s, a in PROVIDER_ROWS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS p(provider, suffix, active)")


def cert_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Certificate-log messages as JSON envelopes (topic certstream_domains), one per event.

    The event's `value` (a fraction) is the producer's float-typed
    `submission_timestamp`; the event's `props` object is merged in as an
    unknown field; events of type 'error' carry truncated, unparseable text.
    """
    e = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    dom = "concat('d', CAST(user_id AS STRING), " + _case("user_id % 3", TLDS) + ")"
    body = ("to_json(named_struct('certIndex', event_id, "
            "'seen', CAST(unix_millis(CAST(ts AS TIMESTAMP)) DIV 1000 AS BIGINT), "
            "'submission_timestamp', value, 'source', concat('log', CAST(event_id % 4 AS STRING)), "
            "'updateType', CASE WHEN event_id % 2 = 0 THEN 'X509LogEntry' ELSE 'PrecertLogEntry' END, "
            "'fingerprint', md5(CAST(event_id AS STRING)), "
            f"'domain_list', array({dom}, concat('www.', {dom}), concat('*.', upper({dom}), '.')), "
            f"'sld_list', array({dom})))")
    x = e.selectExpr("event_id", "ts", "event_type", "props", f"{body} AS body")
    text = ("CASE WHEN event_type = 'error' THEN substring(body, 1, 20) "
            "ELSE concat(substring(body, 1, length(body) - 1), ', ', substring(props, 2)) END")
    return x.selectExpr("'certstream_domains' AS topic", "0 AS partition", "event_id AS offset",
                        "CAST(ts AS TIMESTAMP) AS timestamp", f"CAST({text} AS BINARY) AS value")


def payload_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurement-topic envelopes with a raw payload (the event's props bytes), from one scan."""
    e = table(spark, sf_dir, "events", "event_id", "ts", "props")
    long_topic = "CASE event_id % 3 " + " ".join(
        f"WHEN {i} THEN '{_LONG_TOPIC[t]}'" for i, t in enumerate(TOPICS)) + " END"
    return e.selectExpr(f"{long_topic} AS topic", "0 AS partition", "event_id AS offset",
                        "CAST(ts AS TIMESTAMP) AS timestamp", "CAST(props AS BINARY) AS value")


# fixed values of the volume fixture: one name-server apex takes a third of all rows
HOT_APEX = "bigpark.net"
COLD_APEXES = 97


def lineitem_ns_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`lineitem` as NS observations, for volume: part -> domain, supplier -> name server,
    return flag -> topic, quantity -> n, ship date -> time.  Suppliers with key % 3 = 0
    all delegate to one apex, so that apex holds a third of the rows (a hot group)."""
    li = table(spark, sf_dir, "lineitem", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
               "l_returnflag", "l_shipdate")
    return li.selectExpr(
        "'ns' AS k", "CASE l_returnflag WHEN 'A' THEN 'domains' WHEN 'N' THEN 'fqdn' ELSE 'certs' END AS topic",
        "concat('p', CAST(l_partkey AS STRING), '.com') AS d",
        f"concat('ns', CAST(l_linenumber % 2 + 1 AS STRING), '.', CASE WHEN l_suppkey % 3 = 0 THEN '{HOT_APEX}' "
        f"ELSE concat('h', CAST(l_suppkey % {COLD_APEXES} AS STRING), '.org') END) AS s",
        "CAST(l_quantity AS BIGINT) AS n", "unix_millis(CAST(l_shipdate AS TIMESTAMP)) AS fs",
        "unix_millis(CAST(l_shipdate AS TIMESTAMP)) AS ls")


def lineitem_certs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`lineitem` as certificates, for volume: one per line, naming its name server (so one apex
    is named by a third of them)."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_linenumber")
    host = (f"CASE WHEN l_suppkey % 3 = 0 THEN '{HOT_APEX}' ELSE concat('h', CAST(l_suppkey % {COLD_APEXES} AS STRING), '.org') END")
    return li.selectExpr("concat('log', CAST(l_linenumber % 2 AS STRING)) AS source",
                         "md5(CAST(concat(l_orderkey, '-', l_linenumber) AS BINARY)) AS fingerprint",
                         f"array(concat('ns', CAST(l_linenumber % 2 + 1 AS STRING), '.', {host}), concat('*.', upper({host}), '.')) AS domain_list")
