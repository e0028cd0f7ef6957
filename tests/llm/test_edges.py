"""Every operator on NULLs, empty and long texts, repeated rows, empty tables, clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from zonelens.llm import (credentials, decontam, langid, lm, packing, parity_join, pii_crf, quality, repeats,
                          topk)
from zonelens.llm.queries import tokenizer_path

ITEMS = "item_id long, text string"


def run_all(spark, docs):
    items = spark.createDataFrame([(1, "the mat and the dog ran off to the far hill"), (2, None), (None, "word"), (3, "")], ITEMS)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 1, 0), (5, None, None), (1, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    model = langid.fit(docs)
    return {
        "langid": langid.predict(docs, model, ["doc_id"]),
        "secrets": credentials.scan(docs),
        "classes": parity_join.similarity_classes(docs),
        "pii": pii_crf.scan(docs),
        "redacted": pii_crf.scan(docs, redact=True),
        "matches": decontam.match_items(docs, items),
        "clean": decontam.clean(docs, items),
        "repeats": repeats.remove_repeats(docs),
        "packed": packing.pack(docs, tokenizer_path()),
        "quality": quality.resample(docs, labels),
        "lm": lm.score(docs, F.col("doc_id") % 2 == 0),
    }


def test_odd_rows(spark, odd_docs):
    out = {k: d.collect() for k, d in run_all(spark, odd_docs).items()}
    n = odd_docs.count()
    for name in ("langid", "secrets", "classes", "pii", "redacted", "matches", "repeats", "quality", "lm"):
        assert len(out[name]) == n, name
    by = {k: {r["doc_id"]: r for r in v} for k, v in out.items()}
    assert {by["langid"][i]["lang_pred"] for i in (2, 3, 4, 9)} == {"und"}
    assert by["classes"][6]["component_id"] == 1 and by["classes"][None]["component_id"] is None
    assert by["classes"][2]["n_shingles"] == 0 and by["classes"][8]["n_shingles"] == 1
    assert by["classes"][5]["n_shingles"] == 3
    assert by["repeats"][6]["n_removed"] == by["repeats"][6]["n_bytes"] > 50 and by["repeats"][1]["n_removed"] == 0
    assert by["repeats"][2]["n_bytes"] == 0 and by["repeats"][None]["n_removed"] == 0
    assert by["matches"][2]["n_words"] == 0 and by["matches"][8]["n_hit"] == 1 and by["matches"][8]["item_ids"] == ["null"]
    assert by["matches"][1]["n_hit"] == 11 and not {1, 8} & set(by["clean"])      # mostly benchmark words
    assert by["lm"][2]["n_tokens"] == 1 and by["lm"][5]["n_tokens"] == 60_001
    pieces = [r for r in out["packed"] if r["doc_id"] == 2]
    assert [(p["piece"], p["length"]) for p in pieces] == [(0, 1)]
    assert by["redacted"][2]["text"] is None


def test_empty_tables(spark, no_docs):
    for name, d in run_all(spark, no_docs).items():
        assert d.collect() == [], name


def test_empty_items_and_labels(spark, odd_docs):
    none = spark.createDataFrame([], ITEMS)
    assert decontam.match_items(odd_docs, none).agg(F.sum("n_hit")).first()[0] == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.resample(odd_docs, labels).filter("not keep").isEmpty()


def test_topk_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [0.5, 0.5]), (50, [0.5, 0.5]), (1, [0.25]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]),
            (6, [0.5, 0.5]), (6, [0.5, 0.5]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, k=5).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [
        (0, 1, 6), (0, 2, 6), (0, 3, 50), (0, 4, 1), (50, 1, 0), (50, 2, 6), (50, 3, 6), (50, 4, 1)]
    assert topk.top_k(df.filter("vec_id = -1"), F.col("vec_id") % 50 == 0).collect() == []


def test_topk_of_large_numbers(spark):
    """Scores beyond what a double holds exactly, up to 64 bits; beyond that an error."""
    rows = [(0, [3e4, 2.0]), (1, [2e9, 1.0]), (2, [2e9, 2.0]), (3, [-2e9, 5.0]), (4, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df, F.col("vec_id") == 0, k=3).orderBy("rank").collect()
    q = [int(3e4 * 256), 512]
    want = sorted(((-(q[0] * int(v[0] * 256) + q[1] * int(v[1] * 256)), i) for i, v in rows[1:]))[:3]
    assert [(r.vec_id, r.score) for r in got] == [(i, -s) for s, i in want] and got[0].score > 1 << 53
    for big in ([1e300, 1.0], [3e12, 3e12]):
        with pytest.raises(Exception, match="fit 64 bits"):
            topk.top_k(spark.createDataFrame([(0, big), (1, big)], "vec_id long, embedding array<double>"), F.col("vec_id") == 0).collect()


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_stages(spark, tmp_path_factory, odd_docs, no_docs, k):
    d = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(1, "the mat and the dog ran off to the far hill"), (2, None)], ITEMS).write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0), (8, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    name, stage = corpus_pipeline.STAGES[k]
    last = k == len(corpus_pipeline.STAGES) - 1
    assert stage(spark, no_docs, d).collect() == []
    out = stage(spark, odd_docs, d)
    assert last or out.columns == corpus_pipeline.COLUMNS
    rows = out.collect()
    if name == "near_duplicates":
        assert sorted(r.doc_id for r in rows if r.doc_id) == [1, 2, 3, 4, 5, 7, 8, 9]


def test_joined_sketches_tell_long_sets_apart(spark):
    """The distance that the last join takes of long sets is the one of their sketches at a common size:
    never above the true difference, and out of reach for unrelated ones."""
    import numpy as np
    from pyspark.sql import functions as F

    from zonelens.llm import parity_join as PJ
    rng = np.random.default_rng(7)
    sizes = [1000, 1344, 1366, 1792, 2047, 2100, 2731, 2800, 5000, 6100, 9000]
    sets = {}
    for k, n in enumerate(sizes):
        x = rng.integers(0, 2 ** 63, n, dtype=np.uint64)
        near = np.concatenate([x[: n - n // 10], rng.integers(0, 2 ** 63, n // 12, dtype=np.uint64)])
        sets[2 * k], sets[2 * k + 1] = np.sort(x), np.sort(near)
    rows = [(d, len(x), bytearray(PJ.bit_sketch(x).tobytes())) for d, x in sets.items()]
    profiles = spark.createDataFrame(rows, "doc_id long, n int, sketch binary")
    words = PJ._sketch_words(profiles, profiles.select(F.col("doc_id").alias("d")))
    assert {r.d for r in words.filter("longer is null").collect()} == {d for d, x in sets.items() if len(x) < PJ.LONG}
    words = words.join(profiles.select(F.col("doc_id").alias("d"), "n"), "d").select("d", "n", "longer")
    pairs = words.toDF("a", "an", "alonger").join(words, (F.col("a") < F.col("d")) & PJ._fits("an", "n", 75) & (F.greatest("an", "n") >= PJ.VOID))
    got = {(r.a, r.d): r.x for r in pairs.select("a", "d", PJ._distance("alonger", "longer").alias("x")).collect()}
    assert len(got) > 10
    for (a, d), x in got.items():
        true = len(np.setxor1d(sets[a], sets[d]))
        assert x <= true and (x - true) % 2 == 0
        assert (7 * x <= len(sets[a]) + len(sets[d])) == (a // 2 == d // 2)


def test_a_pair_passes_the_last_join_once(spark):
    """Texts that share many values are one row of the last join for each pair, not one for each value
    and direction; the pairs are those that meeting under every value finds."""
    import numpy as np

    from zonelens.llm import parity_join as PJ
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2 ** 63, 400, dtype=np.uint64)
    profiles, rows = [], []
    for d in range(12):                    # near copies of one text; 7 to 11 lie in two components of their own
        x = np.sort(np.concatenate([base[: 380 + d % 3], rng.integers(0, 2 ** 63, 20 - d % 3, dtype=np.uint64)]))
        profiles.append((d, len(x), bytearray(PJ.bit_sketch(x).tobytes())))
        rows += [(v, d, len(x), 0 if d < 7 else 7 + d % 2, 0) for v in range(100, 160) if v % 12 != d]
    rows += [(1000 + d, e, 400, 0 if e < 7 else 7 + e % 2, 0) for d in range(7) for e in (d, 7 + d % 5)]
    profiles = spark.createDataFrame(profiles, "doc_id long, n int, sketch binary")
    open_ = spark.createDataFrame(rows, "value long, d long, dn int, component long, main long")
    got = PJ._meetings(open_, PJ._meeting_words(profiles, open_), 75).select("a", "d").collect()
    pairs = {frozenset(p) for p in got}
    component = {d: c for _, d, _, c, _ in rows}
    assert pairs == {frozenset((a, d)) for a in range(12) for d in range(12) if component[a] != component[d]}
    assert len(got) == len(pairs)


def test_values_of_the_same_members_count_once(spark):
    """Open values: one of those with the same members, all of those that differ."""
    from zonelens.llm import parity_join as PJ
    sets = {1: (1, 2, 3), 2: (1, 2, 3), 3: (1, 2, 3, 4), 4: (1, 2, 4), 5: (1, 2, 3), 6: (1, 5, 6), 7: (1, 2)}
    members = spark.createDataFrame([(v, d, 10) for v, ds in sets.items() for d in ds], "value long, d long, dn int")
    comp = spark.createDataFrame([(1, 1), (2, 1), (5, 1), (6, 1)], "node long, component long")
    got = PJ._unsettled(members, comp).collect()
    kept = {}
    for r in got:
        kept.setdefault(r.value, set()).add(r.d)
        assert r.main == 1 and r.component == {3: 3, 4: 4}.get(r.d, 1)
    assert kept == {1: {1, 2, 3}, 3: {1, 2, 3, 4}, 4: {1, 2, 4}}


def test_ids_with_texts_of_several_sizes_meet_under_every_value(spark):
    """A repeated id whose texts differ: a value of one text must not hide that of the other."""
    from zonelens.llm import parity_join as PJ
    words = "one two three four five six seven eight nine ten".split()
    long = " ".join(f"{w}{k}" for k in range(30) for w in words)
    short = " ".join(f"x{k}" for k in range(12))
    docs = spark.createDataFrame([(1, short), (1, long), (2, long + " end"), (3, long + " fin"), (4, short + " end")], "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in PJ.similarity_classes(docs).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 1)}


def test_driver_holds_no_sketches_and_no_long_tables(spark, monkeypatch):
    """The driver gathers and sends what is broadcast: never the sketches of the last join, nor a table of many rows."""
    from zonelens.llm import parity_join as PJ

    def hinted(df):
        return "strategy=broadcast" in df._jdf.queryExecution().optimizedPlan().toString()
    assert hinted(spark.range(9).join(PJ._few(spark.range(1000)), "id"))
    assert not hinted(spark.range(9).join(PJ._few(spark.range(200_000)), "id"))
    met, meetings = [], PJ._meetings
    monkeypatch.setattr(PJ, "_meetings", lambda *a: met.append(meetings(*a)) or met[-1])
    common = " ".join(f"w{k}" for k in range(160))          # too little of a text to link two
    rows = [(d, common + " " + " ".join(f"x{d}_{k}" for k in range(40))) for d in range(12)]
    rows += [(d + 100, text + " end") for d, text in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in PJ.similarity_classes(docs).collect()}
    assert got == {d: d % 100 for d, _ in rows}
    assert met and not any(hinted(df) for df in met)


def test_classes_do_not_depend_on_what_is_broadcast(spark, monkeypatch):
    """Tables beyond the broadcast bound are joined by a shuffle, with the same classes."""
    from zonelens.llm import parity_join as PJ
    words = [f"w{k}" for k in range(120)]
    rows = [(d, " ".join(words[d % 6 * 4: 100 + d % 6 * 4])) for d in range(40)]
    rows += [(100 + d, " ".join(words[:70]) + " " + " ".join(f"x{d % 9}_{k}" for k in range(30))) for d in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    few = sorted(map(tuple, PJ.similarity_classes(docs).collect()))
    monkeypatch.setattr(PJ, "FEW_ROWS", 0)
    assert sorted(map(tuple, PJ.similarity_classes(docs).collect())) == few
    assert 1 < len({c for *_, c in few}) < 20
