r"""Phrase collocation mining by sampling and negative border (Toivonen).

Texts are lower-cased (A-Z), cut into pieces at `[.,;:!?\x0A-\x0D]` and those
into words `[^\x20\x09]+`; a phrase is a run of words inside a piece.  Wanted are
the exact counts of all phrases with `min_count` occurrences or more, per
language:

1. A sample of the documents (by a hash of doc_id) proposes the phrases that
   are frequent in it at a lowered threshold.
2. One pass over all documents counts the proposals and their negative border:
   phrases that are not proposed but whose shorter parts all are (every single
   word is one or the other).  Proposals travel with their text, border phrases
   as keys alone.
3. A border phrase that reaches `min_count` after all is a failure of the sample:
   it becomes a proposal, its extensions enter the border, and another pass
   counts what is new.  Passes go on until no border phrase fails, at most one
   per word of the longest phrase and one more.  A phrase is frequent only if
   its parts are, so nothing frequent is left uncounted then.

The proposals are told to the tasks as one bitmap per phrase length over the
keys' leading bits, of a size fixed by `filter_bits` (2^27 bits, 16 MiB): a key
that shares its bit with a proposal is counted as one, which costs space and
changes nothing.  Tasks add up the phrases of some megabytes of text before they
are exchanged, packed by leading bits of the key; a word that occurs everywhere
sends one entry per flush of a task.

Defined results: a NULL text is empty, a NULL language `und`; a NULL id and
repeated rows count as rows; an empty table has no phrases; extra columns are
ignored.  Phrases are told apart by 64-bit hashes of language and words while
they are counted.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonelens.llm.common import LOWER, combine, few_files, flat_text, input_bytes, release, slices, word_hashes, word_spans, written

_U = np.uint64
FLUSH = 1 << 22              # keys held by a task before they are added up and sent
TEXT = 1 << 21               # bytes of text worked on at a time
ENTRY = "bucket int, lang string, width int, keys binary, n binary, phrases binary"
COUNTED = "lang string, width int, phrase string, f long, bucket int, bits binary"

BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
WORD = ~BREAK
WORD[[0x20, 0x09]] = False


def _salt(lang: str, width: int) -> np.uint64:
    return _U(int.from_bytes(hashlib.blake2b(f"{width}:{lang}".encode(), digest_size=8).digest(), "little"))


class Phrases:
    """Words of a slice of texts of one language, and the keys of their runs."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, lang: str):
        low = LOWER[buf]
        starts, ends, counts = word_spans(low, offs, WORD)
        self.hashes, self.lang = word_hashes(low, starts, ends), lang
        breaks = np.concatenate([[0], np.cumsum(BREAK[low])])
        doc = np.repeat(np.arange(len(counts)), counts)
        self.linked = (breaks[starts[1:]] == breaks[ends[:-1]]) & (doc[1:] == doc[:-1])
        lengths = np.concatenate([[0], np.cumsum(ends - starts)])
        self.words = pa.Array.from_buffers(pa.large_binary(), len(starts), [
            None, pa.py_buffer(lengths.astype(np.int64)), pa.py_buffer(low[WORD[low]])])

    def keys(self, width: int) -> np.ndarray:
        """A key for every position (of runs that cross a piece's end too)."""
        return combine(self.hashes, width) ^ _salt(self.lang, width)

    def spelled(self, at: np.ndarray, width: int) -> pa.Array:
        at = pa.array(at)
        if width == 1:
            return self.words.take(at)
        return pc.binary_join_element_wise(*(self.words.take(pc.add(at, k)) for k in range(width)),
                                           pa.scalar(b" ", pa.large_binary()))


def _in(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    shift = _U(64 - (len(bitmap).bit_length() + 2))
    spot = (keys >> shift).astype(np.int64)
    return (bitmap[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 > 0


def _standing(words: Phrases, keys: list[np.ndarray], bitmaps: list[np.ndarray]):
    """For each length (counted, proposed) of every position under these proposals."""
    counted = np.ones(len(words.hashes), bool)
    out = []
    for w, k in enumerate(keys):
        if w:
            counted = above[:-1] & above[1:] & words.linked[:len(k)]
        above = counted.copy()
        spots = np.flatnonzero(counted)
        above[spots] = _in(bitmaps[w], k[spots])
        out.append((counted, above))
    return out


def _pack(a: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes()       # byte planes
    return len(a).to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(b: bytes, kind) -> np.ndarray:
    size, n = np.dtype(kind).itemsize, int.from_bytes(b[:4], "little")
    raw = pa.decompress(b[4:], decompressed_size=n * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(kind).ravel()


def _text_pack(words: pa.Array) -> bytes:
    raw = b"\n".join(words.to_pylist())                                # no phrase holds a line end
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _text_unpack(b: bytes) -> list[bytes]:
    raw = pa.decompress(b[8:], decompressed_size=int.from_bytes(b[:8], "little"), codec="zstd", asbytes=True)
    return raw.split(b"\n")


class _Held:
    """What a task has counted since its last flush."""

    def __init__(self, bucket_bits: int):
        self.shift, self.plain, self.told, self.size = _U(64 - bucket_bits), {}, {}, 0

    def add(self, lang: str, width: int, keys: np.ndarray) -> None:
        if len(keys):
            self.plain.setdefault((lang, width), []).append(keys)
            self.size += len(keys)

    def tell(self, words: Phrases, width: int, keys: np.ndarray, spots: np.ndarray) -> None:
        if len(spots):
            some, first, n = np.unique(keys[spots], return_index=True, return_counts=True)
            self.told.setdefault((words.lang, width), []).append((some, n, words.spelled(spots[first], width)))
            self.size += 4 * len(some)

    def flush(self):
        rows: list = []
        for (lang, width), parts in self.plain.items():
            keys, n = np.unique(np.concatenate(parts), return_counts=True)
            self._cut(rows, lang, width, keys, n, None)
        for (lang, width), parts in self.told.items():
            keys, first, inv = np.unique(np.concatenate([p[0] for p in parts]), return_index=True, return_inverse=True)
            n = np.zeros(len(keys), np.int64)
            np.add.at(n, inv, np.concatenate([p[1] for p in parts]))
            self._cut(rows, lang, width, keys, n, pa.concat_arrays([p[2] for p in parts]).take(pa.array(first)))
        self.plain, self.told, self.size = {}, {}, 0
        release()
        kinds = (pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                          names=["bucket", "lang", "width", "keys", "n", "phrases"])

    def _cut(self, rows, lang, width, keys, n, phrases) -> None:
        bucket = (keys >> self.shift).astype(np.int64)
        cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])).tolist() + [len(keys)]
        for a, b in zip(cut, cut[1:]):
            rows.append((int(bucket[a]), lang, width, _pack(np.diff(keys[a:b], prepend=_U(0))), _pack(n[a:b].astype(np.uint32)),
                         None if phrases is None else _text_pack(phrases.slice(a, b - a))))


def _by_language(batches):
    """Slices of texts of one language."""
    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            texts = batch.column("text").filter(pc.equal(langs.indices, code))
            buf, offs = flat_text(texts)
            for i, j in slices(offs, TEXT):
                yield lang, buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i]


def _proposer(max_words: int, bucket_bits: int):
    """All phrases of the sample, as keys."""
    def run(batches):
        held = _Held(bucket_bits)
        for lang, buf, offs in _by_language(batches):
            words = Phrases(buf, offs, lang)
            whole = np.ones(len(words.hashes), bool)
            for w in range(1, max_words + 1):
                if w > 1:
                    whole = whole[:-1] & words.linked[:len(whole) - 1] if w == 2 else whole[:-1] & whole[1:]
                held.add(lang, w, words.keys(w)[whole])
            if held.size >= FLUSH:
                yield held.flush()
        if held.size:
            yield held.flush()
    return run


def _counter(now, before, bucket_bits: int):
    """Phrases that the proposals `now` count and those `before` (None: no pass yet) did not."""
    def run(batches):
        held = _Held(bucket_bits)
        bitmaps, old = now.value, before.value if before is not None else None
        for lang, buf, offs in _by_language(batches):
            words = Phrases(buf, offs, lang)
            keys = [words.keys(w) for w in range(1, len(bitmaps) + 1)]
            standing = _standing(words, keys, bitmaps)
            earlier = _standing(words, keys, old) if old is not None else [(None, None)] * len(keys)
            for w, (k, (counted, proposed), (was_counted, was_proposed)) in enumerate(zip(keys, standing, earlier), 1):
                border = counted & ~proposed
                if old is not None:
                    border &= ~was_counted
                    proposed = proposed & ~was_proposed
                held.add(lang, w, k[border])
                held.tell(words, w, k, np.flatnonzero(proposed))
            if held.size >= FLUSH:
                yield held.flush()
        if held.size:
            yield held.flush()
    return run


def _adder(min_count: int, filter_bits: list[int], bucket_bits: int):
    """Totals of one bucket: phrases that reach `min_count`, the words of each language (width 0),
    and the bits of keys without text that reach it."""
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        parts: dict = {}
        for lang, width, keys, n, phrases in zip(*(table.column(c).to_pylist() for c in ("lang", "width", "keys", "n", "phrases"))):
            parts.setdefault((lang, width, phrases is not None), []).append(
                (np.cumsum(_unpack(keys, _U), dtype=_U), _unpack(n, np.uint32), phrases))
        rows, bits, words = [], {}, {}
        for (lang, width, told), sent in parts.items():
            keys, inv = np.unique(np.concatenate([s[0] for s in sent]), return_inverse=True)
            total = np.zeros(len(keys), np.int64)
            np.add.at(total, inv, np.concatenate([s[1] for s in sent]).astype(np.int64))
            if width == 1:
                words[lang] = words.get(lang, 0) + int(total.sum())
            many = total >= min_count
            if told:
                at = 0
                for k, _, phrases in sent:
                    mine = inv[at:at + len(k)]
                    at += len(k)
                    new = np.flatnonzero(many[mine])
                    if len(new):
                        text = _text_unpack(phrases)
                        rows += [(lang, width, text[i].decode(), int(total[mine[i]]), None, None) for i in new.tolist()]
                        many[mine[new]] = False
            elif many.any():
                width_bits = filter_bits[width - 1] - bucket_bits
                spot = ((keys[many] << _U(bucket_bits)) >> _U(64 - width_bits)).astype(np.int64)
                have = bits.setdefault(width, np.zeros(1 << (width_bits - 3), np.uint8))
                np.bitwise_or.at(have, spot >> 3, np.uint8(1) << (spot & 7).astype(np.uint8))
        rows += [(lang, 0, None, n, None, None) for lang, n in words.items()]
        rows += [(None, width, None, None, bucket, pa.compress(b.tobytes(), codec="zstd", asbytes=True)) for width, b in bits.items()]
        release()
        kinds = (pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.binary())
        names = ("lang", "width", "phrase", "f", "bucket", "bits")
        return pa.table({n: pa.array([r[i] for r in rows], k) for i, (n, k) in enumerate(zip(names, kinds))})
    return run


def _gathered(counted: DataFrame, bitmaps: list[np.ndarray], bucket_bits: int) -> tuple[list[np.ndarray], bool]:
    """The bitmaps with the bits of one pass added (their size is fixed), and whether any was new."""
    out, new = [b.copy() for b in bitmaps], False
    for row in counted.filter("bits is not null").select("width", "bucket", "bits").toLocalIterator():
        size = len(out[row.width - 1]) >> bucket_bits
        part = np.frombuffer(pa.decompress(bytes(row.bits), decompressed_size=size, codec="zstd", asbytes=True), np.uint8)
        out[row.width - 1][row.bucket * size:(row.bucket + 1) * size] |= part
        new = True
    return out, new


def frequent_phrases(docs: DataFrame, min_count: int = 10, max_words: int = 3, sample: int = 4, sample_count: int = 2,
                     filter_bits: int = 27, bucket_bytes: int = 4 << 20) -> DataFrame:
    """lang, width, phrase, f of all phrases of up to `max_words` words with `min_count` occurrences
    or more, and the number of words of each language as width 0.  One in `sample` documents
    proposes the phrases that occur `sample_count` times or more there."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    bucket_bits = int(min(20, max(3, (input_bytes(rows) // bucket_bytes).bit_length())))
    bits = [max(bucket_bits + 3, filter_bits - (2 if w == 0 else 0)) for w in range(max_words)]

    def counts(source: DataFrame, mapper, least: int, name: str) -> DataFrame:
        entries = source.select("lang", "text").mapInArrow(mapper, ENTRY)
        return written(spark, few_files(entries.repartition(1 << bucket_bits, "bucket").groupBy("bucket")
                                        .applyInArrow(_adder(least, bits, bucket_bits), COUNTED), 1 << bucket_bits), name)
    picked = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(sample)) == 0)
    proposals = counts(picked, _proposer(max_words, bucket_bits), sample_count, "phrase-sample")
    now, _ = _gathered(proposals, [np.zeros(1 << (b - 3), np.uint8) for b in bits], bucket_bits)
    before, passes = None, []
    while True:
        told = spark.sparkContext.broadcast(now)
        passes.append(counts(rows, _counter(told, before, bucket_bits), min_count, "phrase-counts"))
        now, failed = _gathered(passes[-1], now, bucket_bits)
        if before is not None:
            before.destroy()
        if not failed:
            told.destroy()
            break
        before = told
    # later passes see words only where one is newly spelled: the first has all words of a language
    out = passes[0].filter("bits is null")
    for more in passes[1:]:
        out = out.unionByName(more.filter("bits is null and width > 0"))
    return out.select("lang", "width", "phrase", "f")


def _exact(name: str):
    return F.col(name).cast("decimal(19,0)")


def collocations(docs: DataFrame, top: int = 2000, min_count: int = 10, max_words: int = 3, overlap: int = 50, **mining) -> DataFrame:
    """The `top` phrases of two or more words of each language by the score of their weakest cut,
    floor(10^6 a^2 / (l r)); a phrase goes when a longer one accounts for `overlap` per cent of it."""
    found = written(docs.sparkSession, frequent_phrases(docs, min_count, max_words, **mining), "phrases")
    counted = found.filter("width > 0")
    some = counted.filter("width > 1").select("lang", "width", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = some.select("lang", "phrase", "a", "w", F.explode(F.expr("sequence(1, width - 1)")).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.expr("slice(w, 1, k)"), " ").alias("head"),
        F.array_join(F.expr("slice(w, k + 1, size(w) - k)"), " ").alias("tail"))
    for part, count in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(counted.select("lang", F.col("phrase").alias(part), F.col("f").alias(count)), ["lang", part])
    cuts = cuts.withColumns({"aa": F.lit(1000000).cast("decimal(7,0)") * (_exact("a") * _exact("a")), "lr": _exact("l") * _exact("r")})
    best = cuts.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.min(F.struct(
        F.expr("aa div lr").alias("score"), "k", "l", "r")).alias("cut"))
    inner = F.expr(f"""flatten(transform(sequence(2, {max(2, max_words - 1)}), m ->
        CASE WHEN m < width THEN transform(sequence(1, width - m + 1), i -> array_join(slice(w, i, m), ' ')) ELSE array() END))""")
    within = (some.filter("width > 2").select("lang", F.explode(inner).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = (best.join(within, ["lang", "phrase"], "left")
            .filter(F.coalesce(100 * _exact("longer") < overlap * _exact("a"), F.lit(True))))
    words = found.filter("width = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = (kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
              .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top))
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase",
                                             *(F.col(c).cast("long").alias(c) for c in ("a", "l", "r", "n", "score")))
