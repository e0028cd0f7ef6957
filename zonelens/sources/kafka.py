"""Message sources: bounded Kafka reads and Avro decoding (SRC-1, SRC-2, SRC-4, SRC-12).

These use Spark's own Kafka and Avro connectors (`spark-sql-kafka-0-10`,
`spark-avro`), which must be on the classpath; without them the functions
raise a clear error.  Everything downstream takes the envelope DataFrame
these produce: (topic, partition, offset, timestamp, value BINARY).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed value: a Confluent-framed Avro message starts with 1 magic byte + 4 schema-id bytes
FRAME_HEADER_BYTES = 5


class ConnectorMissing(RuntimeError):
    pass


def read_window(spark: SparkSession, bootstrap: str, topic: str, start_ms: int, end_ms: int | None = None,
                min_partitions: int | None = None, extra: dict | None = None) -> DataFrame:
    """SRC-1 / STR-1: one topic between two broker times, as a bounded batch read.

    The start offset is resolved from `start_ms` and must exist (the read
    fails otherwise); a missing end offset falls back to the latest offset.
    `min_partitions` splits the offset range into that many input
    partitions (STR-4: the same contiguous slicing the shard jobs use).
    """
    r = (spark.read.format("kafka").option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", topic).option("startingTimestamp", str(start_ms))
         .option("startingOffsetsByTimestampStrategy", "error"))
    if end_ms is not None:
        r = r.option("endingTimestamp", str(end_ms))
    else:
        r = r.option("endingOffsets", "latest")
    if min_partitions:
        r = r.option("minPartitions", str(min_partitions))
    for k, v in (extra or {}).items():
        r = r.option(k, v)
    df = _load(r)
    return df.select("topic", "partition", "offset", "timestamp", "value")


def _absent(error: Exception) -> bool:
    """Whether an error says that a connector is not on the classpath; all others are passed on."""
    text = str(error)
    return any(w in text for w in ("DATA_SOURCE_NOT_FOUND", "Failed to find data source", "ClassNotFoundException",
                                   "NoClassDefFoundError", "AVRO_NOT_LOADED", "TypeError: 'JavaPackage'", "JavaPackage"))


def _load(reader) -> DataFrame:
    try:
        return reader.load()
    except Exception as e:
        if _absent(e):
            raise ConnectorMissing(f"Kafka source unavailable: {e}") from e
        raise


def stream_topic(spark: SparkSession, bootstrap: str, topic: str, start_ms: int,
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """STR-5: the same topic as a stream (use with `availableNow` to stop at the end)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", topic).option("startingTimestamp", str(start_ms)))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    df = _load(r)
    return df.select("topic", "partition", "offset", "timestamp", "value")


def within(envelopes: DataFrame, start_ms: int, end_ms: int | None = None, max_msgs: int | None = None) -> DataFrame:
    """SRC-4: row-level time bound on the broker timestamp, optional first-N cap (a sampling feature)."""
    t = F.unix_millis(F.col("timestamp"))
    x = envelopes.filter(t >= F.lit(start_ms))
    if end_ms is not None:
        x = x.filter(t < F.lit(end_ms))
    return x.orderBy("offset").limit(max_msgs) if max_msgs else x


def avro_body(value: Column) -> Column:
    """PRJ-12: payload without its frame header; NULL when shorter than the header."""
    return F.when(F.length(value) >= FRAME_HEADER_BYTES, F.substring(value, F.lit(FRAME_HEADER_BYTES + 1), F.length(value) - FRAME_HEADER_BYTES))


def decode_measurements(envelopes: DataFrame, writer_schema_json: str) -> DataFrame:
    """SRC-2: Avro decode with the writer schema; undecodable messages give a NULL
    `measurement` (PERMISSIVE) and are counted by `decode_errors`."""
    try:
        from pyspark.sql.avro.functions import from_avro
    except ImportError as e:  # pragma: no cover
        raise ConnectorMissing("pyspark avro functions unavailable") from e
    body = avro_body(F.col("value"))
    try:
        decoded = from_avro(body, writer_schema_json, {"mode": "PERMISSIVE"})
        return envelopes.select("topic", "partition", "offset", "timestamp", decoded.alias("measurement"))
    except Exception as e:
        if _absent(e):
            raise ConnectorMissing(f"Avro functions unavailable: {e}") from e
        raise


def decode_errors(decoded: DataFrame) -> DataFrame:
    """Messages and undecodable ones per topic.  PERMISSIVE decoding of a record schema yields a
    record of NULLs, so a message counts as undecodable when its required id is NULL."""
    return decoded.groupBy("topic").agg(F.count_if(F.col("measurement.id").isNull()).alias("errors"),
                                        F.count(F.lit(1)).alias("msgs"))
