"""Name handling: trailing dots, apex, topic tags, file names, addresses.

Every function returns a Column built from Spark's own expressions, so the
work stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "TOPIC_TAGS", "SNAP_TAG_PATTERN", "ARCHIVE_FILE_PATTERN", "BACKFILL_TAG_PATTERN",
    "RETENTION_SNAP_PATTERN", "RETENTION_DELTA_PATTERN",
    "col_", "strip_dots", "apex_of", "ns_apex", "topic_tag", "is_primary",
    "suffix_match", "strip_leading_dot", "target_url", "file_topic",
    "file_shard", "file_is_sample", "archive_path", "release_asset_name",
    "parse_snap_tag", "snap_tag_valid", "label_suffixes",
]

# --- fixed values (must equal the reference's for the same results) --------
# Kafka topic name -> short tag stored in the `topic` column of observations.
TOPIC_TAGS = {
    "newly_registered_domains_measurements": "domains",
    "newly_registered_fqdn_measurements": "fqdn",
    "newly_issued_certificates_measurements": "certs",
}
# A snapshot tag names the END of a 12-hour window.
SNAP_TAG_PATTERN = r"^snap-(\d{4}-\d{2}-\d{2})-(00|12)$"
# Archive / release file names: <topic>.shard-<N>[.sample].parquet
ARCHIVE_FILE_PATTERN = r"^(.+?)\.shard-(\d+)(\.sample)?\.parquet$"
# Release tags the archive back-fill accepts (any two-digit hour)
BACKFILL_TAG_PATTERN = r"^snap-(\d{4}-\d{2}-\d{2})-(\d{2})$"
# Tags the retention job may delete: snapshots (with or without hour) and day deltas
RETENTION_SNAP_PATTERN = r"^snap-(\d{4}-\d{2}-\d{2})(-(00|12))?$"
RETENTION_DELTA_PATTERN = r"^parking-DAY-(\d{4}-\d{2}-\d{2})-(00|12)$"
# ---------------------------------------------------------------------------

_FILE_RE_SPARK = ARCHIVE_FILE_PATTERN


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_dots(c) -> Column:
    """All trailing dots removed; NULL becomes ''."""
    return F.rtrim(F.coalesce(col_(c), F.lit("")), F.lit("."))


def apex_of(c) -> Column:
    """Lowercase, no trailing dots, last two labels; '' and one label pass through."""
    return F.substring_index(F.lower(strip_dots(c)), ".", -2)


def ns_apex(c) -> Column:
    """Apex of a name-server host as the audit takes it: last two labels, case kept."""
    return F.substring_index(col_(c), ".", -2)


def topic_tag(c) -> Column:
    """Long topic name -> short tag; unknown names pass through."""
    m = F.create_map(*[F.lit(x) for kv in TOPIC_TAGS.items() for x in kv])
    return F.coalesce(m[col_(c)], col_(c))


def is_primary(qname, domain) -> Column:
    """Query name equals the measured domain; an empty name is never primary."""
    q, d = col_(qname), col_(domain)
    return F.when(q != F.lit(""), q == d).otherwise(F.lit(False))


def suffix_match(host, suffix) -> Column:
    return col_(host).endswith(col_(suffix))


def strip_leading_dot(c) -> Column:
    return F.ltrim(col_(c), F.lit("."))


def label_suffixes(host) -> Column:
    """Every dot-led suffix of a host: 'ns1.a.b.com' -> ['.a.b.com', '.b.com', '.com'].

    A suffix rule '.x.y' matches a host exactly when '.x.y' is in this list,
    which turns the suffix theta join into an equi join.
    """
    h = col_(host)
    parts = F.split(h, r"\.", -1)
    n = F.size(parts)
    idx = F.sequence(F.lit(2), F.greatest(n, F.lit(1)))
    return F.when(n >= 2, F.transform(
        idx, lambda i: F.concat(F.lit("."), F.array_join(F.slice(parts, i, n), ".")))
    ).otherwise(F.array().cast("array<string>"))


def target_url(domain) -> Column:
    return F.concat(F.lit("http://"), col_(domain), F.lit("/"))


def file_topic(name) -> Column:
    return F.regexp_extract(col_(name), _FILE_RE_SPARK, 1)


def file_shard(name) -> Column:
    s = F.regexp_extract(col_(name), _FILE_RE_SPARK, 2)
    return F.when(s != "", s.cast("int"))


def file_is_sample(name) -> Column:
    return F.regexp_extract(col_(name), _FILE_RE_SPARK, 3) != ""


def release_asset_name(topic, shard) -> Column:
    return F.format_string("%s.shard-%d.parquet", col_(topic), col_(shard))


def archive_path(root: str, topic, date, hour, shard, sample=None) -> Column:
    """<root>/topic=<t>/date=<d>/hour=<h>/[sample=true/]shard-<n>[.sample].parquet"""
    base = F.format_string(root.rstrip("/") + "/topic=%s/date=%s/hour=%s/", col_(topic), col_(date), col_(hour))
    if sample is None:
        return F.concat(base, F.format_string("shard-%d.parquet", col_(shard)))
    return F.when(col_(sample), F.concat(base, F.format_string("sample=true/shard-%d.sample.parquet", col_(shard)))) \
        .otherwise(F.concat(base, F.format_string("shard-%d.parquet", col_(shard))))


def snap_tag_valid(tag) -> Column:
    return F.coalesce(col_(tag), F.lit("")).rlike(SNAP_TAG_PATTERN)


def parse_snap_tag(tag) -> Column:
    """struct(date, hour) for a valid tag, NULL otherwise."""
    t = F.coalesce(col_(tag), F.lit(""))
    return F.when(t.rlike(SNAP_TAG_PATTERN), F.struct(
        F.regexp_extract(t, SNAP_TAG_PATTERN, 1).alias("date"),
        F.regexp_extract(t, SNAP_TAG_PATTERN, 2).alias("hour")))
