"""Certificate JSON: coercion, unknown fields, broken payloads, statistics."""

from zonelens.operators import certs as C

ENV = "topic string, partition int, offset bigint, timestamp timestamp, value binary"


def env(spark, payloads):
    rows = [("certstream_domains", 0, i, None, None if p is None else bytearray(p.encode())) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, ENV)


def test_parse_and_coerce(spark):
    p = ['{"certIndex": 5, "submission_timestamp": 1716.9, "source": "s", "domain_list": ["a.com"], "extra": 1}',
         '{"certIndex": "x", "seen": -3.7}',
         '[1, 2]', 'not json', '', None]
    parsed = C.parse_certificates(env(spark, p)).orderBy("_offset").collect()
    assert [r._ok for r in parsed] == [True, True, False, False, False, False]
    assert (parsed[0].certIndex, parsed[0].submission_timestamp, parsed[0].domain_list) == (5, 1716, ["a.com"])
    assert (parsed[1].certIndex, parsed[1].seen) == (None, -3)
    s = C.json_stats(C.parse_certificates(env(spark, p))).collect()[0]
    assert (s.msgs, s.errors, s.lines_written) == (4, 4, 2)


def test_drift_once_per_field(spark):
    p = ['{"certIndex": 1, "new_a": 1}', '{"new_a": 2, "new_b": 3}', '[1]', 'broken']
    got = {(r.field, r.first_offset, r.n) for r in C.json_drift(env(spark, p)).collect()}
    assert got == {("new_a", 0, 2), ("new_b", 1, 1)}


def test_exponents_of_any_size(spark):
    """A certificate log can quote any number; none of them may end the query."""
    from decimal import Decimal, localcontext
    import re
    texts = ["1e3", "1.25e1", "1e2147483647", "1e99999999999", "1e-99999999999", "-1e99999999999999999999999",
             "0e99999999999999999999999", "9223372036854775807", "9223372036854775808", "9223372036854775807.9",
             "9.223372036854775807e18", "9.223372036854775808e18", "-9.223372036854775808e18", "1e18", "1e19", "123456e-3",
             "0." + "0" * 49 + "1e60", "0" * 60 + "5e1", "0" * 60 + "12", "-0.5", "+3", "1.", "1.x", ".5", "1e", "", "x", " 7 "]

    def exact(t):
        if not re.fullmatch(r"\s*[-+]?[0-9]+(\.[0-9]*)?([eE][-+]?[0-9]+)?\s*", t):
            return None
        with localcontext() as c:
            c.prec, c.Emax, c.Emin = 300, 10 ** 17, -10 ** 17
            head, _, exp = t.strip().lower().partition("e")
            if Decimal(head) == 0 or int(exp or 0) < -200:
                return 0
            if int(exp or 0) > 200:
                return None
            whole = int(Decimal(head) * Decimal(10) ** int(exp or 0))
        return whole if -2 ** 63 <= whole < 2 ** 63 else None
    rows = [f'{{"certIndex": {i}, "seen": "{t}"}}' for i, t in enumerate(texts)]
    got = {r.certIndex: r.seen for r in C.parse_certificates(env(spark, rows)).collect()}
    assert got == {i: exact(t) for i, t in enumerate(texts)}


def test_job_is_one_pass(spark, tmp_out):
    """Rows, rejects, statistics and drift of the job, from one scan of the input."""
    from zonelens.jobs import run_certificates
    p = ['{"certIndex": 1, "new_a": 1}', '{"new_a": 2, "new_b": 3, "domain_list": ["a.com"]}', '[1]', 'broken', '', None,
         '{"certIndex": "1e5", "seen": 7.9}']
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    e = env(spark, p)
    done = run_certificates(e.mapInArrow(count, ENV), tmp_out)
    rows = spark.read.parquet(done["rows"])
    assert seen.value == len(p) == rows.count()
    got = {r._offset: (r.kind, r.certIndex, r.seen, r.raw and bytes(r.raw)) for r in rows.collect()}
    assert got == {0: ("certificate", 1, None, None), 1: ("certificate", None, None, None), 2: ("reject", None, None, b"[1]"),
                   3: ("reject", None, None, b"broken"), 4: ("reject", None, None, b""), 5: ("reject", None, None, None),
                   6: ("certificate", 100000, 7, None)}
    stats = C.metrics_report(spark.read.parquet(done["stats"])).first()
    plain = C.json_stats(C.parse_certificates(e)).first()
    assert all(stats[c] == plain[c] for c in ("msgs", "errors", "bytes_in", "lines_written", "offset_span", "coverage_pct"))
    key = lambda d: sorted(tuple(r[c] for c in ("topic", "field", "first_offset", "n")) for r in d.collect())
    assert key(C.drift_of(rows)) == key(C.json_drift(e)) and len(key(C.drift_of(rows))) == 2


def test_job_without_messages(spark, tmp_out):
    from zonelens.jobs import run_certificates
    done = run_certificates(env(spark, []), tmp_out)
    assert C.metrics_report(spark.read.parquet(done["stats"])).collect() == []


def test_stream_counts_a_replayed_batch_once(spark, tmp_out):
    from zonelens.jobs import run_certificate_stream
    for k in range(3):
        env(spark, [f'{{"certIndex": {k}}}', "bad"]).coalesce(1).write.parquet(f"{tmp_out}/in/{k}")
    stream = spark.readStream.schema(ENV).option("maxFilesPerTrigger", 1).parquet(f"{tmp_out}/in/*")
    done = run_certificate_stream(stream, f"{tmp_out}/out", f"{tmp_out}/ck")
    # the commit of the last batch is lost: a restart runs that batch again
    fs = spark._jvm.org.apache.hadoop.fs
    for path in (f"{tmp_out}/ck/commits/2", f"{tmp_out}/ck/commits/.2.crc"):
        p = fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, False)
    run_certificate_stream(stream, f"{tmp_out}/out", f"{tmp_out}/ck")
    got = C.metrics_report(spark.read.schema(C.METRICS).parquet(done["stats"])).first()
    assert (got.msgs, got.errors, got.lines_written) == (6, 3, 3)
    assert spark.read.parquet(done["rows"]).count() == 6
