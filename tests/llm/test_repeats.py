"""op7's exchanges: what they hold, and the same result however the work is cut up."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from zonelens.llm import repeats


def words(r, n):
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9))) for _ in range(n))


def plain(rows):
    """doc_id -> (n_bytes, n_removed, n_spans, kept_sha256), by looking every window up."""
    seen, want = set(), {}
    for i, t in sorted(rows):
        b = t.encode()
        own, gone = set(), np.zeros(len(b), bool)
        for k in range(len(b) - 49):
            if b[k:k + 50] in seen:
                gone[k:k + 50] = True
            own.add(b[k:k + 50])
        seen |= own
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want[i] = (len(b), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest())
    return want


def test_reports_are_packed():
    """One row for each bucket from a stretch of the input, however many parts or blocks lie in it."""
    r = random.Random(1)
    numbers = [k // 2 for k in range(80)]
    docs = pa.table({"doc_id": pa.array(range(80), pa.int64()), "text": [words(r, 200) for _ in range(80)],
                     "part": pa.array(numbers, pa.int32()), "block": pa.array(numbers, pa.int64())})
    got = pa.Table.from_batches(list(repeats._reports(50, 64)(docs.to_batches())))
    assert sorted(got.column("bucket").to_pylist()) == list(range(64))


def test_windows_at_their_own_anchor():
    """A window of a hot anchor is sent once, not under every anchor that lies in it."""
    r = random.Random(2)
    line = words(r, 60)
    docs = pa.table({"doc_id": pa.array([1], pa.int64()), "text": [line], "part": pa.array([0], pa.int32())})
    buf = np.frombuffer(line.encode(), np.uint8)
    pos, h, first, last, _ = repeats.anchors(buf, np.array([0, len(buf)]), 50)
    assert (last - first + 1).sum() == len(buf) - 49 and (first <= pos).all() and (pos + repeats.GRAM <= last + 50).all()
    low = repeats._bytes(h)[:, :repeats.KEY].T.tobytes()
    marks = pa.table({"part": pa.array([0], pa.int32()), "key": pa.array([b""], pa.binary()), "hot": pa.array([low], pa.binary())})
    got = repeats._suffixes(50, 8)(docs, marks)
    entries, _ = repeats._unpack([d for k, d in zip(got.column("kind").to_pylist(), got.column("data").to_pylist()) if k == 1], 0)
    assert sorted(entries["at"].astype(int) - entries["left"]) == list(range(len(buf) - 49))


def test_parts_and_buckets_grow_with_the_input():
    gb = 1 << 30
    assert repeats.parts_of(gb // 100) == 32 and repeats.parts_of(6 * gb) == repeats.parts_of(30 * gb) == 1024
    assert repeats.parts_of(1024 * gb) == 32768                    # parts hold 32 MB at most


@pytest.mark.parametrize("hot_from", [1 << 13, 5])
def test_many_parts_and_buckets(spark, tmp_out, monkeypatch, hot_from):
    """Shared passages, copies, rows of one id, a long text (a piece of its own) and multi-byte letters over
    many files, parts and buckets."""
    r = random.Random(7)
    passages = [words(r, 40) + " été 你好 " + words(r, 20) for _ in range(12)]
    rows = [(k, words(r, r.randint(0, 30)) + r.choice(passages) * r.randint(0, 2) + words(r, r.randint(0, 30))) for k in range(300)]
    rows += [(300 + k, rows[r.randrange(300)][1]) for k in range(60)] + [(400, words(r, 14_000) + passages[0])]
    rows.append((401, rows[-1][1][5:-5]))
    monkeypatch.setattr(repeats, "PIECE", 8)
    monkeypatch.setattr(repeats, "PART_LEAST", 1 << 10)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(6).write.parquet(tmp_out)
    docs = spark.read.parquet(tmp_out)
    got = {x.doc_id: tuple(x)[1:] for x in repeats.remove_repeats(docs, hot_from=hot_from, bucket_bytes=1 << 12).collect()}
    assert got == plain(rows) and got[401][1] == got[401][0]


def test_flushes(monkeypatch):
    """A part that is packed in several goes covers the same bytes."""
    r = random.Random(9)
    passages = [words(r, 30) for _ in range(8)]
    docs = pa.table({"doc_id": pa.array(range(200), pa.int64()), "text": [words(r, 20) + r.choice(passages) + words(r, 20) for _ in range(200)],
                     "part": pa.array([0] * 200, pa.int32())})

    def removed(hot_from):
        reports = pa.Table.from_batches(list(repeats._reports(50, 1)(docs.to_batches())))
        entries = repeats._suffixes(50, 1)(docs, repeats._shared(hot_from, 1)(reports))
        return repeats._removal(False)(docs, repeats._trees(50)(entries)).column("n_removed").to_pylist()
    want = {h: removed(h) for h in (1000, 3)}
    assert want[1000] == want[3] and sum(want[3]) > 10_000
    monkeypatch.setattr(repeats, "HELD", 40)
    monkeypatch.setattr(repeats, "SLICE", 1000)
    monkeypatch.setattr(repeats, "STEP", 7)
    monkeypatch.setattr(repeats, "SENT", 100)
    assert all(removed(h) == want[h] for h in (1000, 3))
