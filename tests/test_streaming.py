"""Streaming rollup and first-seen state on small landed files."""

import time

from pyspark.sql import functions as F

from zonelens.operators.rollup import rollup_observations
from zonelens.streaming.first_seen import final_state, run_first_seen
from zonelens.streaming.rollup_stream import late_rows, run_available_now, streaming_rollup

ANS = ("offset bigint, pos int, topic string, id string, query_type string, query_name string, timestamp bigint, "
       "status_code int, response_ttl int, ip4_address string, ip6_address string, `as` string, country string, "
       "ip_prefix string, ns_address string, mx_address string, mx_preference int, rtt double")
H = 3_600_000


def _order_files(dirs):
    """Give the files of each directory a distinct, increasing modification time,
    so the file source reads them in that order (one file per trigger)."""
    import glob
    import os
    base = time.time() - 1000
    for i, d in enumerate(dirs):
        local = d[len("file:"):] if d.startswith("file:") else d
        for f in glob.glob(local + "/*.parquet"):
            os.utime(f, (base + 100 * i, base + 100 * i))


def ans(off, ts, ip, asn):
    return (off, 0, "domains", "a.com", "A", "a.com", ts, 0, 60, ip, None, asn, "US", None, None, None, None, 1.0)


def test_stream_rollup_matches_batch_for_closed_windows(spark, tmp_out):
    rows = [ans(1, 1 * H, "1.1.1.1", "1"), ans(2, 2 * H, "1.1.1.1", "2"), ans(3, 13 * H, "2.2.2.2", "3"),
            ans(4, 30 * H, "2.2.2.2", "4")]
    src = spark.createDataFrame(rows, ANS)
    src.write.parquet(f"{tmp_out}/in")
    stream = spark.readStream.schema(src.schema).parquet(f"{tmp_out}/in")
    prog = run_available_now(streaming_rollup(stream, "1 hour"), f"{tmp_out}/out", f"{tmp_out}/ck")
    assert late_rows(prog) == 0 and len(prog) >= 1
    got = sorted((r.window_end_ms, r.ip, r.n, r.a) for r in spark.read.parquet(f"{tmp_out}/out").collect())
    # the window ending at 36h is still open (watermark = 30h - 1h)
    assert got == [(12 * H, "1.1.1.1", 2, "1"), (24 * H, "2.2.2.2", 1, "3")]
    b = rollup_observations(src.withColumn("w", F.floor(F.col("timestamp") / (12 * H))), ["w"])
    assert b.count() == 3


def test_first_seen_replay_is_idempotent(spark, tmp_out):
    prov = spark.createDataFrame([("p", ".park.com", True)], "provider string, suffix string, active boolean")
    sch = "k string, topic string, d string, s string, fs bigint, ls bigint, n bigint, snap string"
    b1 = spark.createDataFrame([("ns", "domains", "a.com", "ns1.park.com", 50, 60, 1, "snap-2026-01-02-00")], sch)
    b2 = spark.createDataFrame([("ns", "domains", "a.com", "ns1.park.com", 10, 20, 1, "snap-2026-01-01-12"),
                                ("ns", "domains", "b.com", "ns1.park.com", 11, 20, 1, "snap-2026-01-01-12")], sch)
    b1.coalesce(1).write.parquet(f"{tmp_out}/in/1")
    b2.coalesce(1).write.parquet(f"{tmp_out}/in/2")
    _order_files([f"{tmp_out}/in/1", f"{tmp_out}/in/2"])
    stream = spark.readStream.schema(b1.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_out}/in/*")
    run_first_seen(stream, prov, f"{tmp_out}/state", f"{tmp_out}/ck")
    st = sorted((r.domain, r.first_snap, r.first_ms) for r in final_state(spark, f"{tmp_out}/state").collect())
    assert st == [("a.com", "snap-2026-01-01-12", 10), ("b.com", "snap-2026-01-01-12", 11)]
    # a restart from the same checkpoint processes nothing new and leaves the state as it is
    run_first_seen(stream, prov, f"{tmp_out}/state", f"{tmp_out}/ck")
    st2 = sorted((r.domain, r.first_snap, r.first_ms) for r in final_state(spark, f"{tmp_out}/state").collect())
    assert st2 == st
    from zonelens.streaming.first_seen import compact_state
    compact_state(spark, f"{tmp_out}/state", f"{tmp_out}/state2/batch=00000000")
    st3 = sorted((r.domain, r.first_snap, r.first_ms) for r in final_state(spark, f"{tmp_out}/state2").collect())
    assert st3 == st


def test_late_rows_are_dropped_and_counted(spark, tmp_out):
    # batch 0 moves the watermark to 29h; a row is late against the watermark of
    # the previous batch, so the late row comes in a third batch
    early = spark.createDataFrame([ans(1, 1 * H, "1.1.1.1", "1"), ans(2, 30 * H, "2.2.2.2", "2")], ANS)
    mid = spark.createDataFrame([ans(3, 31 * H, "3.3.3.3", "3")], ANS)
    late = spark.createDataFrame([ans(4, 2 * H, "1.1.1.1", "4")], ANS)       # window [0, 12h) already closed
    dirs = [f"{tmp_out}/in/{x}" for x in ("a", "b", "c")]
    for df, d in zip((early, mid, late), dirs):
        df.coalesce(1).write.parquet(d)
    _order_files(dirs)
    stream = spark.readStream.schema(early.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_out}/in/*")
    prog = run_available_now(streaming_rollup(stream, "1 hour"), f"{tmp_out}/out", f"{tmp_out}/ck")
    got = [(r.window_end_ms, r.ip, r.n) for r in spark.read.parquet(f"{tmp_out}/out").collect()]
    assert got == [(12 * H, "1.1.1.1", 1)]
    assert late_rows(prog) == 1


def test_a_batch_reads_the_slots_of_its_pairs(spark, tmp_out):
    from zonelens.streaming.first_seen import SLOTS, new_pairs, read_state, slot_of, write_state
    state = spark.range(4000).selectExpr("'p' AS provider", "concat('d', id, '.com') AS domain", "'snap-2026-01-01-00' AS first_snap",
                                         "id AS first_ms")
    write_state(state, f"{tmp_out}/batch=00000003")
    per = spark.createDataFrame([("p", "d7.com", "snap-2026-01-02-00", 1), ("p", "new.com", "snap-2026-01-02-00", 2)],
                                "provider string, domain string, snap string, first_ms long")
    slots = [r[0] for r in per.select(slot_of()).distinct().collect()]
    some = read_state(spark, tmp_out, slots=slots)
    assert some.select(F.input_file_name()).distinct().count() == len(slots) <= 2 < SLOTS
    assert some.count() < 4000 / SLOTS * 2 * len(slots)
    assert [tuple(r) for r in new_pairs(per, some).collect()] == [("p", "new.com", "snap-2026-01-02-00", 2)]
    assert read_state(spark, tmp_out, without_batch=3).count() == 0 and read_state(spark, tmp_out).count() == 4000
