"""Certificate-log messages (JSON) and ingest statistics.

Parsing is one `from_json` per message with a declared schema; integer
fields are read as text and coerced (`1716.9` -> 1716) so that a float
emitted by the producer does not void the row.  Unknown top-level fields
are dropped from the rows and reported once each by the drift query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelens.functions.timefmt import pct, ratio
from zonelens.schemas import CERTIFICATE, CERTIFICATE_TEXT


def coerce_int(text: Column) -> Column:
    """PRJ-10: JSON number text -> BIGINT, fraction dropped (toward zero); NULL if not a number
    or beyond BIGINT.  Exact: a whole number is cast, of a plain fraction the digits before the
    point are, and a number with an exponent has its point moved in the text, so nothing is ever
    rounded.  The patterns run only on texts that the cheap casts leave over."""
    t = F.trim(text)
    return F.when(t.rlike(WHOLE), t.try_cast(T.LongType())) \
        .when(t.rlike(FRACTION), F.substring_index(t, ".", 1).try_cast(T.LongType())) \
        .when(t.rlike(NUMBER), _with_exponent(t))


def _with_exponent(t: Column) -> Column:
    """The whole part of a number with an exponent, of any size: exponents are compared as BIGINT,
    and one of more than 18 digits moves every digit there is out of reach."""
    part = lambda k: F.regexp_extract(t, NUMBER, k)
    written = F.regexp_replace(part(4), "^[-+]?0*", "")
    size = F.when(F.length(written) > 18, F.lit(10 ** 18)).otherwise(
        F.coalesce(written.try_cast(T.LongType()), F.lit(0).cast("bigint")))
    all_digits = F.concat(part(2), part(3))
    digits = F.regexp_replace(all_digits, "^0+", "")
    point = (F.length(part(2)) - F.length(all_digits) + F.length(digits)
             + F.when(t.rlike("[eE]-"), -size).otherwise(size))
    places = point.try_cast(T.IntegerType())
    moved = F.rpad(F.substring(digits, F.lit(1), places), places, "0")
    out = F.when((digits == "") | (point <= 0), F.lit("0")).when(point <= 19, moved)       # 20 digits are beyond BIGINT
    return F.concat(part(1), out).try_cast(T.LongType())


def payload_text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


WHOLE = r"^[-+]?[0-9]+$"
FRACTION = r"^[-+]?[0-9]+\.[0-9]*$"
# sign, digits before and after the point, exponent
NUMBER = r"^([-+]?)([0-9]+)(?:\.([0-9]*))?(?:[eE]([-+]?[0-9]+))?$"
CORRUPT = "_corrupt"
_PARSE_SCHEMA = T.StructType(CERTIFICATE_TEXT.fields + [T.StructField(CORRUPT, T.StringType(), True)])


def parse_certificates(envelopes: DataFrame, extra: list[Column] | None = None) -> DataFrame:
    """JOB-3 / SRC-3 / PRJ-10..12: JSON envelopes -> certificate rows (S3) + `_offset`, `_ok`.

    `_ok` is false for an empty payload, text that is not a JSON object or
    does not parse (captured in the corrupt-record field of the one parse).
    Such rows carry NULL fields and are counted as errors by `json_stats`.
    The parse is emitted through a one-row generator, so a later filter on
    `_ok` cannot be pushed beneath it and parse the text a second time.
    `extra` columns over the envelope are carried along.
    """
    txt = payload_text(F.col("value"))
    parsed = F.from_json(txt, _PARSE_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    row = F.struct(F.col("topic"), F.col("offset").alias("_offset"), F.coalesce(F.octet_length("value"), F.lit(0)).alias("_bytes"), parsed.alias("j"),
                   *(extra or []))
    x = envelopes.select(F.inline(F.array(row)))
    j = F.col("j")
    ok = (F.col("_bytes") > 0) & j.isNotNull() & j.getField(CORRUPT).isNull()
    fields = []
    for f in CERTIFICATE.fields:
        c = j.getField(f.name)
        fields.append((coerce_int(c) if isinstance(f.dataType, T.LongType) else c).alias(f.name))
    carried = x.columns[4:]
    return x.select("topic", "_offset", F.coalesce(ok, F.lit(False)).alias("_ok"), "_bytes", *fields, *carried)


KNOWN = tuple(f.name for f in CERTIFICATE.fields)


def ingest_rows(envelopes: DataFrame, known=KNOWN) -> DataFrame:
    """JOB-3 in one pass: every message as one row that says all the job wants of it: `kind`
    (certificate or reject), the certificate's fields, its `unknown` top-level fields (NULL: none)
    and, for a reject, the raw payload."""
    named = F.json_object_keys(payload_text(F.col("value")))
    unknown = F.filter(F.array_except(named, F.array(*[F.lit(k) for k in known])), lambda k: k.isNotNull())
    parsed = parse_certificates(envelopes, extra=[F.when(F.size(unknown) > 0, unknown).alias("unknown"), F.col("value").alias("_raw")])
    kind = F.when(F.col("_ok"), "certificate").otherwise("reject")
    return parsed.select(kind.alias("kind"), "topic", "_offset", "_bytes", *CERTIFICATE.names, "unknown",
                         F.when(~F.col("_ok"), F.col("_raw")).alias("raw"))


def ingest_metrics() -> list[Column]:
    """What is counted while `ingest_rows` are written (one topic)."""
    return [F.max("topic").alias("topic"), F.count_if(F.col("_bytes") > 0).alias("msgs"),
            F.count_if(F.col("kind") == "reject").alias("errors"), F.coalesce(F.sum("_bytes"), F.lit(0)).alias("bytes_in"),
            F.count_if(F.col("kind") == "certificate").alias("lines_written"),
            F.min("_offset").alias("first_offset"), F.max("_offset").alias("last_offset")]


METRICS = ("topic string, msgs long, errors long, bytes_in long, lines_written long, first_offset long, last_offset long")


def metrics_report(metrics: DataFrame) -> DataFrame:
    """`json_stats` from the counts of one or more writes of a topic."""
    out = metrics.filter("topic is not null").groupBy("topic").agg(
        *(F.sum(c).alias(c) for c in ("msgs", "errors", "bytes_in", "lines_written")),
        (F.max("last_offset") - F.min("first_offset") + 1).alias("offset_span"))
    return out.withColumn("coverage_pct", pct("msgs", "offset_span"))


def drift_of(rows: DataFrame) -> DataFrame:
    """STR-7 from written `ingest_rows`: reads the few rows with unknown fields."""
    keys = rows.filter("unknown is not null").select("topic", "_offset", F.explode("unknown").alias("field"))
    return keys.groupBy("topic", "field").agg(F.min("_offset").alias("first_offset"), F.count(F.lit(1)).alias("n"))


def certificates_only(parsed: DataFrame) -> DataFrame:
    return parsed.filter("_ok").select(*[f.name for f in CERTIFICATE.fields])


def json_drift(envelopes: DataFrame, known=tuple(f.name for f in CERTIFICATE.fields)) -> DataFrame:
    """STR-7: each unknown top-level field once, with the first offset it appeared at.

    Arrays and broken text have no keys and add nothing; the known-field list
    is a broadcast of at most a few dozen names.
    """
    txt = payload_text(F.col("value"))
    keys = envelopes.select("topic", "offset", F.explode(F.json_object_keys(txt)).alias("field"))
    kn = envelopes.sparkSession.createDataFrame([(k,) for k in known], "field string")
    return (keys.join(F.broadcast(kn), "field", "left_anti")
            .groupBy("topic", "field").agg(F.min("offset").alias("first_offset"),
                                           F.count(F.lit(1)).alias("n")))


def json_stats(parsed: DataFrame) -> DataFrame:
    """AGG-19 for the JSON consumer: messages, errors, bytes, rows written, offsets covered."""
    return parsed.groupBy("topic").agg(
        F.count_if(F.col("_bytes") > 0).alias("msgs"),
        F.count_if(~F.col("_ok")).alias("errors"),
        F.sum("_bytes").alias("bytes_in"),
        F.count_if("_ok").alias("lines_written"),
        (F.max("_offset") - F.min("_offset") + 1).alias("offset_span"),
    ).withColumn("coverage_pct", pct("msgs", "offset_span"))


def ingest_stats(envelopes: DataFrame, obs: DataFrame, group=("topic",)) -> DataFrame:
    """AGG-19 / FN-13 for the measurement consumer, per topic: messages, usable
    answers, distinct keys, offsets covered and the rollup's reduction ratio
    (answers per key; the count of keys only, unlike the reference's ratio
    which counts new keys twice and is always 1)."""
    g = list(group)
    m = envelopes.groupBy(*g).agg(F.count(F.lit(1)).alias("msgs"),
                                  (F.max("offset") - F.min("offset") + 1).alias("offset_span"))
    k = obs.groupBy(*g).agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("answers"))
    return (m.join(k, g, "left")
            .select(*g, "msgs", F.coalesce("answers", F.lit(0)).alias("answers"),
                    F.coalesce("keys", F.lit(0)).alias("keys"), "offset_span",
                    pct("msgs", "offset_span").alias("coverage_pct"),
                    ratio(F.coalesce("answers", F.lit(0)), F.coalesce("keys", F.lit(0))).alias("reduction_ratio")))
