"""Shared helpers: Arrow text access, vectorised word hashing, packed exchanges.

Texts reach the Python workers as Arrow string columns.  The helpers here see
such a column as one flat UTF-8 byte array plus document offsets, so words,
n-grams and windows are computed by numpy over many documents at once.  Bytes
are safe for the word rules used here: every separator is ASCII and no byte of
a multi-byte UTF-8 character is.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = 8 << 20        # bytes of an Arrow batch that goes to a worker, but for a longer row
CHUNK_BYTES = 1 << 19        # texts are worked on in slices of about this many bytes
_U = np.uint64


def text_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most `rows` rows for the session: rows here are whole texts or packed
    arrays, so Spark's default of 10,000 would hold far more bytes than a worker should.  A
    smaller setting of the caller's stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, rows)
    # and of at most BATCH_BYTES, whatever the rows hold: a batch is kept by the executor and by its worker
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int("".join(c for c in spark.conf.get(key) if c.isdigit())) > BATCH_BYTES:
        spark.conf.set(key, BATCH_BYTES)
    # shuffles are coalesced to the session's advisory size rather than to one partition per core: the
    # operators write many small tables, which should be one file each
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver tables."""
    text_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet below spark.checkpoint.dir and read again: cuts the lineage
    with a table that every executor can read, so a lost executor costs no recomputation."""
    from zonelens.session import scratch_path
    text_batches(spark)
    path = scratch_path(spark, name)
    # nobody waits for the table but this call, so it needs no marker file
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def few_files(df: DataFrame, buckets: int) -> DataFrame:
    """`df`, the result of `buckets` small groups dealt by number, in fewer partitions: a task works
    through several buckets one after the other (and holds one at a time) and writes one file,
    instead of a file per bucket."""
    parts = max(4 * df.sparkSession.sparkContext.defaultParallelism, buckets // 32)
    return df.coalesce(parts) if buckets > parts else df


SMALL_IDS = 500_000          # id lists up to this many rows are broadcast, longer ones are joined by a shuffle


def by_ids(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """`docs` with (left_semi) or without (left_anti) the rows whose doc_id is in `ids`."""
    ids = ids.select(F.col(ids.columns[0]).alias("__listed")).distinct()
    small = ids.limit(SMALL_IDS + 1).count() <= SMALL_IDS
    return docs.join(F.broadcast(ids) if small else ids, F.col("doc_id") == F.col("__listed"), how)


def release() -> None:
    """Hand freed memory of a Python worker back to the system (workers live on between tasks)."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def _find_trim():
    import ctypes
    import sys
    if not sys.platform.startswith("linux"):
        return None
    return getattr(ctypes.CDLL(None), "malloc_trim", None)          # glibc only


_TRIM = _find_trim()


def input_bytes(df: DataFrame) -> int:
    """Size of the plan's input as the optimizer knows it; where it knows none (rows that come
    from no file), the text is measured."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= 1 << 60:
        size = df.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return size


def crc_fold(doc_id: str = "doc_id", mod: int = 5):
    """crc32 of the id as text, modulo `mod` (NULL id: NULL)."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(mod))


def flat_text(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; NULL counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    big = pa.types.is_large_string(col.type)
    if not big and not pa.types.is_string(col.type):
        col, big = col.cast(pa.large_string()), True
    _, off, data = col.buffers()
    kind = np.int64 if big else np.int32
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(off, dtype=kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def slices(offs: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents of about `limit` bytes (a longer document stands alone)."""
    n, i = len(offs) - 1, 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


def ascii_lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


LOWER = ascii_lower_table()


def separators(spaces_only: bool) -> np.ndarray:
    """Truth table over bytes that belong to a word: `[^\\x20\\x09-\\x0D]` or, after
    lower-casing, `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`."""
    t = np.ones(256, dtype=bool)
    if spaces_only:
        t[[0x20, *range(0x09, 0x0E)]] = False
    else:
        t[0x00:0x30] = False
        t[0x3A:0x61] = False
        t[0x7B:0x80] = False
    return t


SPACE_WORDS, ALNUM_WORDS = separators(True), separators(False)


def word_spans(buf: np.ndarray, offs: np.ndarray, is_word: np.ndarray):
    """Starts and ends (byte positions) of all words and the number of words of each document."""
    n_docs = len(offs) - 1
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(n_docs, np.int64)
    inside = is_word[buf]
    edge = np.zeros(len(buf) + 1, dtype=bool)      # a document begins here
    edge[offs] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    counts = np.diff(np.searchsorted(starts, offs))
    return starts, ends, counts


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), in place on a copy."""
    h = h ^ (h >> _U(32))
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    return h


class SpanHasher:
    """64-bit hashes of byte spans from prefix sums of a polynomial over random byte values."""

    BASE = 0x9E3779B97F4A7C15
    BASE_INV = pow(0x9E3779B97F4A7C15, -1, 1 << 64)

    def __init__(self, seed: int = 11):
        r = np.random.default_rng(seed)
        self.values = r.integers(1, 2 ** 63, 256, dtype=np.uint64)
        self.pow = self.inv = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.pow) < n:
            n = max(n, CHUNK_BYTES + 1)
            for name, base in (("pow", self.BASE), ("inv", self.BASE_INV)):
                p = np.full(n, base, dtype=np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))

    def prefix(self, buf: np.ndarray) -> np.ndarray:
        self._grow(len(buf) + 1)
        out = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(self.values[buf] * self.pow[:len(buf)], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (prefix[ends] - prefix[starts]) * self.inv[starts]
        return mix(h + (ends - starts).astype(np.uint64))


HASHER = SpanHasher()


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of words whose bytes are already lower-cased."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    return HASHER.spans(HASHER.prefix(buf), starts, ends)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values, by sorting (numpy's own hash table is several times slower here)."""
    s = np.sort(values)
    return s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s


def combine(hashes: np.ndarray, width: int) -> np.ndarray:
    """Order-dependent hashes of all runs of `width` consecutive items."""
    n = len(hashes) - width + 1
    return combine_all([hashes[k:k + n] for k in range(width)]) if n > 0 else np.zeros(0, np.uint64)


def combine_all(columns: list[np.ndarray]) -> np.ndarray:
    """The same hashes from the items' columns."""
    acc = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        acc *= _U(0xC2B2AE3D27D4EB4F)
        acc += c
    return mix(acc)
