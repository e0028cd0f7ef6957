"""Windows on broker time: closing, late messages, replays; messages of many answers."""

from pyspark.sql import functions as F

from zonelens.operators.rollup import rollup_measurements
from zonelens.schemas import DNS_ROW, MEASUREMENT
from zonelens.functions.timefmt import window_end_ms
from zonelens.streaming.window_rollup import corrections, progress, run_window_rollup, window_observations
from tests.test_streaming import _order_files

H = 3_600_000
ENV = "topic string, partition int, offset long, broker_ms long"


def message(spark, rows):
    """Messages from (partition, offset, broker hour, [(answer hour, ip, asn)])."""
    schema = "partition int, offset long, ms long, answers array<struct<ts long, ip string, asn string>>"
    df = spark.createDataFrame([(p, o, int(h * H), [(None if t is None else int(t * H), ip, a) for t, ip, a in rs])
                                for p, o, h, rs in rows], schema)
    fields = {"query_type": "'A'", "query_name": "'a.com'", "timestamp": "x.ts", "status_code": "0", "response_ttl": "60",
              "ip4_address": "x.ip", "as": "x.asn", "country": "'US'"}
    answer = ", ".join(f"'{f.name}', CAST({fields.get(f.name, 'NULL')} AS {f.dataType.simpleString()})" for f in DNS_ROW.fields)
    return df.select(F.lit("newly_registered_domains_measurements").alias("topic"), "partition", "offset",
                     F.timestamp_millis("ms").alias("timestamp"),
                     F.struct(F.lit("a.com").alias("id"), F.lit("DNS").alias("measurement_type"), F.lit("OK").alias("state"),
                              F.col("ms").alias("request_timestamp"),
                              F.expr(f"transform(answers, x -> named_struct({answer}))").alias("resultList"))
                     .cast(MEASUREMENT).alias("measurement"))


BATCHES = [
    [(0, 1, 1, [(0.5, "1.1.1.1", "1"), (None, "1.1.1.1", "2")]), (1, 1, 30, [(29, "3.3.3.3", "3")])],   # closes both windows before 29 h
    [(1, 0, 2, [(50, "1.1.1.1", "4"), (1, "2.2.2.2", None)])],                                          # late for [0, 12 h)
    [(0, 0, 3, [(3, "1.1.1.1", "5")]), (2, 9, 31, [(None, "3.3.3.3", "6")])],                           # late and on time
    [(0, 7, 60, [(60, "9.9.9.9", "7")])],
]


def run(spark, tmp_out):
    dirs = [f"{tmp_out}/in/{k}" for k in range(len(BATCHES))]
    for rows, d in zip(BATCHES, dirs):
        message(spark, rows).coalesce(1).write.parquet(d)
    _order_files(dirs)
    schema = message(spark, BATCHES[0]).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_out}/in/*")
    run_window_rollup(stream, f"{tmp_out}/out", f"{tmp_out}/ck")
    return stream


def rows_of(df):
    return sorted((r.window_end_ms // H, r.ip, r.n, r.a, r.fs, r.ls) for r in df.collect())


def test_late_messages_are_kept(spark, tmp_out):
    stream = run(spark, tmp_out)
    whole = None
    for rows in BATCHES:
        df = message(spark, rows)
        whole = df if whole is None else whole.unionByName(df)
    batch = rollup_measurements(whole.withColumn("window_end_ms", window_end_ms(F.unix_millis("timestamp"))), ["window_end_ms"])
    everything = window_observations(spark, f"{tmp_out}/out", include_open=True)
    assert everything.columns == batch.columns and rows_of(everything) == rows_of(batch)
    finished = window_observations(spark, f"{tmp_out}/out")
    assert rows_of(finished) == [r for r in rows_of(batch) if r[0] <= 59]
    # the first arrival of 1.1.1.1 is the late message of partition 0, offset 0; one answer has no time
    first = [r for r in rows_of(finished) if r[:2] == (12, "1.1.1.1")]
    assert first == [(12, "1.1.1.1", 4, "5", H // 2, 50 * H)]
    assert rows_of(corrections(spark, f"{tmp_out}/out")) == [(12, "1.1.1.1", 2, "5", 3 * H, 50 * H), (12, "2.2.2.2", 1, None, H, H)]
    seen = [(r.batch, r.messages, r.late, r.closed_ms // H) for r in progress(spark, f"{tmp_out}/out").orderBy("batch").collect()]
    assert seen == [(0, 2, 0, 29), (1, 1, 1, 29), (2, 2, 1, 30), (3, 1, 0, 59)]
    # a batch that is run again leaves everything as it is
    fs = spark._jvm.org.apache.hadoop.fs
    for name in ("3", ".3.crc"):
        p = fs.Path(f"{tmp_out}/ck/commits/{name}")
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, False)
    run_window_rollup(stream, f"{tmp_out}/out", f"{tmp_out}/ck")
    assert rows_of(window_observations(spark, f"{tmp_out}/out", include_open=True)) == rows_of(batch)


def test_nothing_streamed(spark, tmp_out):
    assert window_observations(spark, f"{tmp_out}/none", include_open=True).collect() == []


def test_arrival_is_by_partition_first(spark):
    rows = [(1, 5, 1, [(1, "1.1.1.1", "b")]), (0, 9, 2, [(2, "2.2.2.2", "x"), (2, "1.1.1.1", None), (2, "1.1.1.1", "c")]),
            (2, 0, 1, [(1, "1.1.1.1", "d")])]
    got = {r.ip: (r.a, r.n) for r in rollup_measurements(message(spark, rows)).collect()}
    assert got == {"1.1.1.1": (None, 4), "2.2.2.2": ("x", 1)}
