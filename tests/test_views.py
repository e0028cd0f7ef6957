import pytest

from zonelens.schemas import OBSERVATION
from zonelens.sources import views

ROW = {"k": "ip", "topic": "domains", "d": "a.com", "ip": "1.1.1.1", "fs": 1, "ls": 2, "n": 3}


def _file(spark, path, rows=1, **extra):
    """One Parquet file of a given name."""
    r = [tuple(ROW.get(f.name) for f in OBSERVATION.fields)] * rows
    df = spark.createDataFrame(r, OBSERVATION)
    for c, v in extra.items():
        from pyspark.sql import functions as F
        df = df.withColumn(c, F.lit(v))
    tmp = path + ".parts"
    df.coalesce(1).write.parquet(tmp)
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path
    fs = p(tmp).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.rename(fs.globStatus(p(tmp + "/part-*.parquet"))[0].getPath(), p(path))


DOMAINS, CERTS = "newly_registered_domains_measurements", "newly_issued_certificates_measurements"


def test_snapshot_folders(spark, tmp_out):
    for tag, topic, shard, n in (("snap-2026-05-25-00", DOMAINS, 0, 2), ("snap-2026-05-25-00", CERTS, 1, 1), ("snap-2026-05-25-12", DOMAINS, 10, 4)):
        _file(spark, f"{tmp_out}/{tag}/{topic}.shard-{shard}.parquet", n)
    got = views.snapshots(spark, tmp_out).groupBy("tag", "topic_name", "topic", "shard").count().collect()
    assert {(r.tag, r.topic_name, r.topic, r.shard, r["count"]) for r in got} == {
        ("snap-2026-05-25-00", DOMAINS, "domains", "0", 2), ("snap-2026-05-25-00", CERTS, "certs", "1", 1),
        ("snap-2026-05-25-12", DOMAINS, "domains", "10", 4)}
    assert views.snapshots(spark, tmp_out, ["snap-2026-05-25-12"], DOMAINS).count() == 4
    for bad in ("snap-2026-05-25-06", "../other", "snap-*"):
        with pytest.raises(ValueError):
            views.snapshots(spark, tmp_out, [bad])
    with pytest.raises(FileNotFoundError):
        views.snapshots(spark, tmp_out, ["snap-2026-06-01-00"])


def test_file_list_and_new_columns(spark, tmp_out):
    _file(spark, f"{tmp_out}/old.parquet")
    _file(spark, f"{tmp_out}/new.parquet", 2, added="x")
    both = [f"{tmp_out}/old.parquet", f"{tmp_out}/new.parquet"]
    assert "added" not in views.files(spark, both).columns
    got = views.files(spark, both, new_columns=True)
    assert sorted((r.added or "") for r in got.collect()) == ["", "x", "x"]
    assert views.files(spark, []).count() == 0


def test_release_views(spark, tmp_out):
    d = f"{tmp_out}/topic={DOMAINS}/date=2026-05-25/hour=00"
    _file(spark, f"{d}/shard-0.parquet", 3)
    _file(spark, f"{d}/sample=true/shard-0.sample.parquet")
    assert views.register_views(spark, tmp_out, "release", "rel_") == ["rel_observations", "rel_inventory", "rel_samples"]
    r = spark.sql("SELECT topic, topic_name, date, hour, shard, count(*) AS n FROM rel_observations GROUP BY ALL").collect()
    assert [tuple(x) for x in r] == [("domains", DOMAINS, "2026-05-25", "00", "0", 3)]
    assert spark.sql("SELECT count(*) FROM rel_samples").first()[0] == 1
    assert spark.sql("SELECT shard FROM rel_inventory").collect() == [(0,)]
