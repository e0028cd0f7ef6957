"""Queries over written files: release layout, snapshot folders, file lists, samples, row groups, job outputs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from zonelens import jobs
from zonelens.functions.names import archive_path
from zonelens.operators import audit as AU
from zonelens.plans import fixture as X
from zonelens.plans import oracle as O
from zonelens.plans.q_archive import CFG_SQL, SLICED, W_ARCH
from zonelens.plans.q_parking import AUDIT_SQL, AUDIT_TOPK, COUNTS_SQL, DELTA_NOW, _delta_job
from zonelens.plans.q_stream import MESSAGE_CTES
from zonelens.plans.registry import register
from zonelens.schemas import MEASUREMENT, OBS_COLUMNS
from zonelens.session import list_paths, scratch_path
from zonelens.sinks.release import snapshot_file, write_named
from zonelens.sinks.writers import sample_decoded, write_json_lines, write_rows_per_group
from zonelens.sources import archive as A
from zonelens.sources import projection as P
from zonelens.sources import views as V

# in the fixture, files of this date and later have a column more; samples hold so many rows of a shard
ADDED_FROM = "2024-01-20"
SAMPLE_ROWS = 2
LISTED_TOPIC, LISTED_DATES = "newly_registered_domains_measurements", ("2024-01-10", "2024-01-11")
TAGS = ["snap-2024-01-05-12", "snap-2024-01-20-00"]
ORDER = ["k", "d", "s", "m", "q", "ip", "pr", "rc"]
OBS = ", ".join(OBS_COLUMNS)


def _release(spark, sf) -> str:
    """The archive in the release layout, with samples; later files have a column more."""
    key = ("release", *X._source_key(spark, sf))
    if key not in X._STORED:
        root, base = scratch_path(spark, "release"), scratch_path(spark, "release-parts")
        o = A.observations(spark, X.archive_root(spark, sf)).select(*A.SPARK_PARTS, *OBS_COLUMNS)
        at = [F.col("shard").cast("int") if c == "shard" else F.col(c) for c in A.SPARK_PARTS]
        full = o.withColumn("file", F.substring(archive_path("", *at), 2, 1000))
        write_named(full.filter(F.col("date") < ADDED_FROM).select("file", *OBS_COLUMNS), root, f"{base}/old")
        write_named(full.filter(F.col("date") >= ADDED_FROM).select("file", *OBS_COLUMNS, (F.col("n") * 2).alias("added")), root, f"{base}/new")
        w = Window.partitionBy(*A.SPARK_PARTS).orderBy(*ORDER)
        some = o.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= SAMPLE_ROWS)
        some = some.withColumn("file", F.substring(archive_path("", *at, sample=F.lit(True)), 2, 1000))
        write_named(some.select("file", *OBS_COLUMNS), root, f"{base}/samples")
        X._STORED[key] = root
    return X._STORED[key]


@register("release_observations", W_ARCH + "SELECT * FROM aobs")
def release_observations(spark, sf):
    o = A.observations(spark, _release(spark, sf), "release")
    return o.select(*A.SPARK_PARTS, *OBS_COLUMNS)


@register("sql_samples", W_ARCH + f"""
SELECT topic_name, date, hour, shard, {OBS} FROM aobs
QUALIFY row_number() OVER (PARTITION BY topic_name, date, hour, shard
  ORDER BY {", ".join(f"{c} NULLS FIRST" for c in ORDER)}) <= {SAMPLE_ROWS}""")
def sql_samples(spark, sf):
    """The samples view."""
    V.register_views(spark, _release(spark, sf), "release", "release_")
    return spark.sql(f"SELECT topic_name, date, hour, shard, {OBS} FROM release_samples")


@register("added_columns", W_ARCH + f"""
SELECT topic, date, hour, count(*) AS n_rows, count(CASE WHEN date >= '{ADDED_FROM}' THEN n END) AS with_added,
       CAST(coalesce(sum(CASE WHEN date >= '{ADDED_FROM}' THEN 2 * n END), 0) AS BIGINT) AS added
FROM aobs GROUP BY topic, date, hour""")
def added_columns(spark, sf):
    """A column that only later files have, found in their footers; earlier files read NULL."""
    V.register_views(spark, _release(spark, sf), "release", "wider_", new_columns=True)
    return spark.sql("""SELECT topic, date, hour, count(*) AS n_rows, count(added) AS with_added, coalesce(sum(added), 0) AS added
                        FROM wider_observations GROUP BY topic, date, hour""")


@register("files_listed", W_ARCH + f"""
SELECT {OBS} FROM aobs WHERE topic_name = '{LISTED_TOPIC}' AND date IN {LISTED_DATES}""")
def files_listed(spark, sf):
    """Observations of an explicit list of files."""
    root = _release(spark, sf)
    listed = [p for d in LISTED_DATES for p in list_paths(spark, f"{root}/topic={LISTED_TOPIC}/date={d}/hour=*/shard-*.parquet")]
    return V.files(spark, listed).select(*OBS_COLUMNS)


@register("snapshot_tags", W_ARCH + f"""
SELECT 'snap-' || date || '-' || hour AS tag, topic_name, shard, {OBS} FROM aobs
WHERE 'snap-' || date || '-' || hour IN {tuple(TAGS)}""")
def snapshot_tags(spark, sf):
    """Some snapshot folders by their tags."""
    key = ("snapshots", *X._source_key(spark, sf))
    if key not in X._STORED:
        root = scratch_path(spark, "snapshots")
        o = A.observations(spark, X.archive_root(spark, sf))
        tag = F.concat(F.lit("snap-"), "date", F.lit("-"), "hour")
        o = o.withColumn("file", snapshot_file(F.col("topic_name"), tag, F.col("shard")))
        write_named(o.select("file", *OBS_COLUMNS), root, scratch_path(spark, "snapshot-parts"))
        X._STORED[key] = root
    return V.snapshots(spark, X._STORED[key], TAGS).select("tag", "topic_name", "shard", *OBS_COLUMNS)


@register("row_group_files", O.with_(*O.OBS_CTES) + f"SELECT {OBS} FROM obs")
def row_group_files(spark, sf):
    """Observations through files of bounded row groups."""
    path = scratch_path(spark, "row-groups")
    write_rows_per_group(X.obs(spark, sf).select(*OBS_COLUMNS), path, 500)
    return spark.read.parquet(path)


@register("ingest_rerun", O.with_(O.DNS_ROWS, O.KEYED, CFG_SQL, SLICED) + """
SELECT date, hour, k, topic, d, s, m, q, ip, CASE WHEN k IN ('ip', 'ns_ip') THEN arg_min(asn, off) END AS a,
       CASE WHEN k IN ('ip', 'ns_ip') THEN arg_min(cc, off) END AS c, CAST(NULL AS VARCHAR) AS p, CAST(pref AS BIGINT) AS pr,
       CAST(arg_min(ttl, off) AS BIGINT) AS tl, CAST(min(ts) AS BIGINT) AS fs, CAST(max(ts) AS BIGINT) AS ls,
       CAST(count(*) AS BIGINT) AS n, CAST(NULLIF(rcode, 0) AS BIGINT) AS rc
FROM (SELECT *, CASE WHEN qname = domain THEN domain END AS d,
             CASE WHEN qtype IN ('A', 'AAAA') AND qname <> domain THEN qname WHEN qtype = 'NS' THEN ns END AS s,
             mx AS m, CASE WHEN qtype IN ('A', 'AAAA') THEN qtype END AS q FROM sliced_w)
WHERE k IS NOT NULL GROUP BY date, hour, k, topic, d, s, m, q, ip, pref, rcode""")
def ingest_rerun(spark, sf):
    """The ingest job, then again for one window: that window's files are replaced, no other's."""
    path = scratch_path(spark, "ingest")
    env = X.sliced_envelopes(spark, sf)
    jobs.run_ingest(env, path)
    jobs.run_ingest(env.filter(F.col("date") == LISTED_DATES[0]), path)
    return spark.read.schema(A._with_parts(A.OBSERVATION, ["date", "hour"])).parquet(path).select("date", "hour", *OBS_COLUMNS)


@register("delta_manifest_file", DELTA_NOW + f"""
SELECT CAST(row_number() OVER (ORDER BY new_domains DESC, provider DESC) - 1 AS INTEGER) AS place, snap_tag, provider AS name,
       new_domains, ct_signal_count FROM ({COUNTS_SQL}), (SELECT '{P.NOW_SNAP}' AS snap_tag)""")
def delta_manifest_file(spark, sf):
    """The manifest that a delta run wrote."""
    m = spark.read.schema("snap_tag string, providers array<struct<name string, new_domains long, ct_signal_count long>>") \
        .json(_delta_job(spark, sf)["manifest"])
    return m.select("snap_tag", F.posexplode("providers").alias("place", "p")).select("place", "snap_tag", "p.*")


@register("audit_files", AUDIT_SQL + "SELECT * FROM audit")
def audit_files(spark, sf):
    """The audit table that the audit job wrote."""
    path = scratch_path(spark, "audit")
    jobs.run_audit(X.obs(spark, sf), P.providers(spark), path, k=AUDIT_TOPK, threshold=1)
    return spark.read.parquet(f"{path}/topk_ns.parquet").withColumn("sample_domains", F.array_join("sample_domains", ","))


SAMPLED = 4


@register("sample_decoded", O.with_(*MESSAGE_CTES, f"""
said AS (SELECT topic, arrival // 100000 % 10000000000 AS off_in, arrival // 1000000000000000 AS part, min(broker_ms) AS broker_ms,
                any_value(domain) AS id, count(*) AS n_answers, count(asn) AS n_asn, string_agg(qname, ',' ORDER BY arrival) AS names,
                coalesce(string_agg(CAST(ts AS VARCHAR), ',' ORDER BY arrival), '') AS times
         FROM messages GROUP BY ALL)""") + f"""
SELECT CASE topic WHEN 'domains' THEN 'newly_registered_domains_measurements' WHEN 'fqdn' THEN 'newly_registered_fqdn_measurements'
            ELSE 'newly_issued_certificates_measurements' END AS topic, broker_ms AS _kafka_ts, CAST(off_in AS BIGINT) AS _kafka_offset,
       id, n_answers, n_asn, names, times
FROM said QUALIFY row_number() OVER (PARTITION BY topic ORDER BY off_in, part) <= {SAMPLED}""")
def q_sample_decoded(spark, sf):
    """The first decoded messages of each topic, written as JSON lines and read back."""
    path = scratch_path(spark, "sample-decoded")
    write_json_lines(sample_decoded(P.message_envelopes(spark, sf), SAMPLED), path, nulls=True)
    schema = f"topic string, _kafka_ts long, _kafka_offset long, id string, resultList {MEASUREMENT['resultList'].dataType.simpleString()}"
    s = spark.read.schema(schema).json(path)
    return s.select("topic", "_kafka_ts", "_kafka_offset", "id", F.size("resultList").cast("long").alias("n_answers"),
                    F.size(F.filter(F.col("resultList.as"), lambda a: a.isNotNull())).cast("long").alias("n_asn"),
                    F.array_join("resultList.query_name", ",").alias("names"), F.array_join("resultList.timestamp", ",").alias("times"))
