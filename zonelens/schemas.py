"""Declared schemas of the data model. Nothing is inferred at a boundary."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# One DNS answer inside a measurement (pruned to the fields the jobs read).
DNS_ROW = _struct(
    ("query_type", S), ("query_name", S), ("timestamp", L), ("status_code", I),
    ("response_ttl", I), ("ip4_address", S), ("ip6_address", S), ("as", S),
    ("country", S), ("ip_prefix", S), ("ns_address", S), ("mx_address", S),
    ("mx_preference", I), ("rtt", D),
)

# One decoded measurement message (S1, pruned).
MEASUREMENT = _struct(
    ("id", S), ("measurement_type", S), ("state", S), ("request_timestamp", L),
    ("resultList", T.ArrayType(DNS_ROW, True)),
)

# Message envelope as a Kafka source yields it.
ENVELOPE = _struct(("topic", S), ("partition", I), ("offset", L),
                   ("timestamp", T.TimestampType()), ("value", T.BinaryType()))

# S2: observation rollup (16 columns, epoch milliseconds as BIGINT).
OBSERVATION = _struct(
    ("k", S), ("topic", S), ("d", S), ("s", S), ("m", S), ("q", S), ("ip", S),
    ("a", S), ("c", S), ("p", S), ("pr", L), ("tl", L), ("fs", L), ("ls", L),
    ("n", L), ("rc", L),
)
OBS_COLUMNS = [f.name for f in OBSERVATION.fields]

# S3: certificate-transparency entry.
CERTIFICATE = _struct(
    ("certIndex", L), ("seen", L), ("submission_timestamp", L), ("source", S),
    ("updateType", S), ("fingerprint", S), ("domain_list", T.ArrayType(S)),
    ("sld_list", T.ArrayType(S)),
)
CERT_COLUMNS = [f.name for f in CERTIFICATE.fields]
# Parsing schema: integers read as text first so that '1716.9' can be coerced.
CERTIFICATE_TEXT = _struct(*[(f.name, S if isinstance(f.dataType, T.LongType) else f.dataType)
                             for f in CERTIFICATE.fields])

# S4: per-window parking delta.
DELTA = _struct(
    ("provider", S), ("domain", S), ("ns_set", T.ArrayType(S)), ("source_topics", T.ArrayType(S)),
    ("first_ms", L), ("last_ms", L), ("observations", L),
    ("ct_sources", T.ArrayType(S)), ("ct_fingerprints", T.ArrayType(S)),
)

# S5: permanent first-seen state.
SEEN = _struct(("provider", S), ("domain", S), ("first_snap", S), ("first_ms", L))

# S6: audit top-K.
TOPK_NS = _struct(("ns_apex", S), ("new_domains", L), ("distinct_ns_hosts", L),
                  ("sample_ns_host", S), ("sample_domains", T.ArrayType(S)))

# S7: legacy per-answer rows (gzip JSON lines before the Parquet switch).
LEGACY_ROW = _struct(
    ("kind", S), ("ts", L), ("topic", S), ("domain", S), ("ns", S), ("mx", S),
    ("preference", L), ("qtype", S), ("ip", S), ("as", S), ("country", S),
    ("prefix", S), ("ttl", L), ("rtt", D), ("rcode", L),
)

# S8: provider configuration, one row per provider.
PROVIDER = _struct(("name", S), ("org", S), ("tier", S), ("active", B), ("watchlist", B),
                   ("ns_suffix", T.ArrayType(S)), ("note", S), ("seeded_from", S))
PROVIDER_FILE = T.StructType([
    T.StructField("version", I, True),
    T.StructField("providers", T.ArrayType(PROVIDER), True),
])

# Shard layout of one snapshot: topic -> number of shards, format.
SHARDS = _struct(("topic", S), ("shards", I), ("format", S))

# Release listing and page-archive results.
RELEASE_ASSET = _struct(("tag", S), ("name", S), ("size", L))
ARCHIVE_RESULT = _struct(("domain", S), ("url", S), ("status", S), ("http", I), ("error", S))
