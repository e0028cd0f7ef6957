"""Quality classifier by importance resampling.

Two generative models over hashed n-grams: the *target* (documents labelled
good) and the *raw* corpus.  A document's importance is the sum of the log
ratios of its n-grams; documents are drawn without replacement by Gumbel
top-k: key = sharpness x log weight / |cut| + Gumbel noise, the k largest keys
stay.

N-grams are words, their heads of four bytes, all pairs of neighbours (hashed
into buckets of their own) and
word shapes (letter / capital / digit runs and punctuation), each counted once per document so that
one page cannot flood a bucket; the share of words that repeat the one before
them adds its binary levels.  The target model is fitted on at most `sample`
labelled rows (documented bound, chosen by a hash of the id; 15 % of them
are held back to set k); the raw model counts every document.

Log ratios are taken relative to their mass-weighted median (the ratio of
ordinary text) and only shortfalls that are certain (upper confidence bound of
the target's count) and exceed `dead_zone` count.  So ordinary text
weighs about 0 whatever its length or language, while text with n-grams that
the target lacks loses weight; without this, one n-gram of junk in a long page
would vanish in the drift of the ordinary ones.

k = number of documents whose log weight reaches the cut that best separates
the held-back labelled rows (Youden's index).  The k-th largest key is found
exactly by counting in ever finer bins over the written weights, so nothing is
sorted whole or gathered.

Defined results: a NULL or wordless text has weight 0 ratio, that is log
weight 0; rows with equal id and text share one key and fall on the same side;
without usable labels every document stays; repeated label rows count once;
extra columns are left alone.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelens.llm.common import (HASHER, LOWER, SPACE_WORDS, combine, distinct, flat_text, mix, release, slices, word_hashes, word_spans,
                                 written)
from zonelens.llm.lm import _packed, _unpacked

BITS = 21
PAIR_BITS = 22               # pairs have buckets of their own, after the others
SIZE = (1 << BITS) + (1 << PAIR_BITS)
PART = 1 << 15               # buckets whose counts travel as one packed row
COUNTS = "part int, salt int, raw binary, target binary"
SALTS = 32                   # groups of tasks whose counts are added first
HEAD = 4                     # bytes of a word's head
SAME = np.uint64(0x51ED270B)


def _shape_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91], t[97:123], t[48:58], t[128:] = 65, 97, 48, 97
    return t


_SHAPES = _shape_table()


def hashed_ngrams(buf: np.ndarray, offs: np.ndarray):
    """Bucket of every distinct n-gram of each document of a slice, and that document's place."""
    s, e, counts = word_spans(buf, offs, SPACE_WORDS)
    doc = np.repeat(np.arange(len(counts)), counts)
    if not len(s):
        return np.zeros(0, np.int64), doc
    low = LOWER[buf]
    word, head = word_hashes(low, s, e), word_hashes(low, s, np.minimum(e, s + HEAD))
    same_doc = doc[1:] == doc[:-1]
    again = same_doc & (word[1:] == word[:-1])
    pair, pair_doc = combine(word, 2)[same_doc], doc[:-1][same_doc]
    runs = _SHAPES[buf]
    edge = np.ones(len(runs), bool)
    edge[1:] = runs[1:] != runs[:-1]
    edge[s] = True
    rank = np.concatenate([[0], np.cumsum(edge)])
    squeezed = runs[edge]
    shape = HASHER.spans(HASHER.prefix(squeezed), rank[s], rank[e])
    share = np.bincount(doc[1:][again], minlength=len(counts)) * 128 // np.maximum(1, counts)
    level, level_doc = np.nonzero(share[None, :] >= (1 << np.arange(8))[:, None])
    ids = np.concatenate([mix(word), mix(shape + np.uint64(3)), mix(head + np.uint64(4)),
                          mix(SAME + level.astype(np.uint64))]) >> np.uint64(64 - BITS)
    pair = (mix(pair + np.uint64(2)) >> np.uint64(64 - PAIR_BITS)) + np.uint64(1 << BITS)
    every = np.concatenate([doc, doc, doc, level_doc, pair_doc])
    key = distinct((every << (PAIR_BITS + 1)) | np.concatenate([ids, pair]).astype(np.int64))
    return key & ((1 << (PAIR_BITS + 1)) - 1), key >> (PAIR_BITS + 1)


def _count(batches, with_target: bool):
    # a task's documents are fewer than 2^31, and so is each of its counts
    raw = np.zeros(SIZE, np.int32)
    target = None
    for batch in batches:
        buf, offs = flat_text(batch.column("text"))
        good = batch.column("target").to_numpy(zero_copy_only=False).astype(bool) if with_target else None
        for i, j in slices(offs):
            ids, doc = hashed_ngrams(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
            np.add.at(raw, ids, 1)
            if with_target and good[i:j].any():
                target = np.zeros(SIZE, np.int32) if target is None else target
                np.add.at(target, ids[good[i:j][doc]], 1)
    salt = TaskContext.get().partitionId() % SALTS
    none = np.zeros(PART, np.int32)
    for k in range(SIZE // PART):
        part = slice(k * PART, (k + 1) * PART)
        if raw[part].any():
            yield _parts(k, salt, raw[part], none if target is None else target[part])
    del raw, target
    release()


def _parts(part: int, salt: int, raw: np.ndarray, target: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([salt], pa.int32()),
                                       pa.array([_packed(raw.astype(np.int64))], pa.binary()),
                                       pa.array([_packed(target.astype(np.int64))], pa.binary())], names=["part", "salt", "raw", "target"])


def _add(table: pa.Table) -> pa.Table:
    """The counts of one part over some tasks."""
    sums = [np.zeros(PART, np.int64), np.zeros(PART, np.int64)]
    for total, name in zip(sums, ("raw", "target")):
        for a in table.column(name):
            total += _unpacked(a.as_py(), np.int64)
    return pa.Table.from_batches([_parts(table.column("part")[0].as_py(), 0, *sums)])


def _spans(size: int, step: int = 1 << 18):
    return [slice(i, min(size, i + step)) for i in range(0, size, step)]


def _plain(raw: np.ndarray, target: np.ndarray, scale: float, part: slice) -> np.ndarray:
    return np.log((target[part] + 0.5) / (raw[part] * scale + 0.5))


def _middle(raw: np.ndarray, target: np.ndarray, scale: float) -> float:
    """Median of the plain log ratios by mass, found in ever finer bins over stretches of the
    buckets: the driver holds the counts and little else."""
    half, parts = raw.sum() / 2, _spans(len(raw))
    low, high, bins = -np.inf, np.inf, 1 << 12
    while True:
        inside, least, most, below = 0, np.inf, -np.inf, 0.0
        for part in parts:
            v = _plain(raw, target, scale, part)
            on = (v >= low) & (v <= high)
            below += float(raw[part][v < low].sum())
            inside += int(on.sum())
            if on.any():
                least, most = min(least, v[on].min()), max(most, v[on].max())
        if inside <= 1 << 16 or least == most:
            got = [(v[on], raw[part][on]) for part in parts for v in [_plain(raw, target, scale, part)]
                   for on in [(v >= low) & (v <= high)]]
            values, mass = (np.concatenate([g[i] for g in got]) for i in (0, 1))
            order = np.argsort(values, kind="stable")
            at = np.searchsorted(below + np.cumsum(mass[order]), half)
            return float(values[order[min(at, len(order) - 1)]])
        edges = np.linspace(least, most, bins + 1)
        mass = np.zeros(bins)
        for part in parts:
            v = _plain(raw, target, scale, part)
            on = (v >= least) & (v <= most)
            mass += np.bincount(np.clip(np.searchsorted(edges, v[on], side="right") - 1, 0, bins - 1), weights=raw[part][on], minlength=bins)
        b = min(int(np.searchsorted(below + np.cumsum(mass), half)), bins - 1)
        low, high = edges[b], edges[b + 1]


def log_ratios(raw: np.ndarray, target: np.ndarray, z: float, pair_z: float, dead_zone: float) -> np.ndarray:
    """Shortfall of every bucket in the target: 0 for ordinary n-grams, negative where even the
    upper confidence bound of the target's count (Poisson, `z` deviations) lies beyond the dead zone."""
    scale = target.sum() / max(1, raw.sum())
    middle = _middle(raw, target, scale) if raw.any() else 0.0
    out = np.empty(len(raw), np.float32)
    for part in _spans(len(raw)):
        t = target[part]
        d = np.where(np.arange(part.start, part.stop) < 1 << BITS, z, pair_z)
        upper = t + d * d / 2 + d * np.sqrt(t + d * d / 4)
        out[part] = np.minimum(0.0, np.log(upper / np.maximum(raw[part] * scale, 1e-9)) - middle + dead_zone)
    return out


def fit(docs: DataFrame, labels: DataFrame, sample: int = 200_000, z: float = 1.5, dead_zone: float = 0.3,
        pair_z: float = 3.0) -> dict:
    """Ratios per bucket and the held-back labelled rows ({id: good}) that set k.  A text has many
    more rare pairs than rare words, so a pair's shortfall has to be surer (`pair_z` deviations)."""
    spark = docs.sparkSession
    rated = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
             .groupBy("doc_id").agg(F.min((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)).alias("good")))
    n = rated.count()
    unit = F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("string"), F.lit("quality")), 11) / F.lit(float(1 << 53))
    picked = rated.withColumn("_u", unit).filter(F.col("_u") < F.lit(min(1.0, sample / max(1, n))))
    picked = written(spark, picked.withColumn("held", (F.col("_u") * 7919 % 1) < 0.15).select("doc_id", "good", "held"), "labels")
    # at most about `sample` rows: a bounded broadcast
    mark = F.broadcast(picked.filter("good and not held").select(F.col("doc_id").alias("_id"), F.lit(True).alias("target")))
    texts = docs.select("doc_id", "text").join(mark, F.col("doc_id") == F.col("_id"), "left") \
        .select("text", F.coalesce("target", F.lit(False)).alias("target"))
    # every task sends each part once: they are added in two levels, so no worker gathers one array per task
    counted = texts.mapInArrow(lambda b: _count(b, True), COUNTS)
    for keys in (("part", "salt"), ("part",)):
        counted = counted.groupBy(*keys).applyInArrow(_add, COUNTS)
    raw, target = np.zeros(SIZE, np.float64), np.zeros(SIZE, np.float64)
    packed = counted.select("part", "raw", "target").toArrow()         # SIZE counts, packed
    for k, r, t in zip(*(packed.column(c) for c in ("part", "raw", "target"))):
        at = slice(k.as_py() * PART, (k.as_py() + 1) * PART)
        raw[at], target[at] = _unpacked(r.as_py(), np.int64), _unpacked(t.as_py(), np.int64)
    del packed
    ratios = log_ratios(raw, target, z, pair_z, dead_zone) if target.any() else None
    del raw, target
    release()
    return {"ratios": ratios, "held": picked.filter("held").select("doc_id", "good")}


def weigh(docs: DataFrame, ratios: np.ndarray | None) -> DataFrame:
    """`docs` plus log_weight (0 without a model)."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)
    cols = docs.columns

    def run(batches):
        table = shared.value
        for batch in batches:
            buf, offs = flat_text(batch.column("text"))
            out = np.zeros(len(offs) - 1)
            if table is not None:
                for i, j in slices(offs):
                    ids, doc = hashed_ngrams(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                    out[i:j] = np.bincount(doc, weights=table[ids], minlength=j - i)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in cols), pa.array(out)], names=[*cols, "log_weight"])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{fields}, log_weight double")


def best_cut(weights: np.ndarray, good: np.ndarray) -> float:
    """Log weight that best separates good from bad rows (Youden's index); the lowest one of a tie."""
    if not len(weights) or good.all() or not good.any():
        return -math.inf
    order = np.argsort(weights, kind="stable")
    w, g = weights[order], good[order]
    lost = np.concatenate([[0], np.cumsum(g)]) / g.sum()          # good rows below the cut
    out = np.concatenate([[0], np.cumsum(~g)]) / (~g).sum()       # bad rows below the cut
    usable = np.concatenate([[True], w[1:] != w[:-1], [False]])
    k = int(np.argmax(np.where(usable, out - lost, -1)))
    return -math.inf if k == 0 else float((w[k - 1] + w[k]) / 2)


def kth_largest(keys: DataFrame, column: str, k: int, bins: int = 4096, few: int = 2000) -> float:
    """Exact k-th largest value by counting in ever finer bins (a bounded result per round)."""
    low, high = keys.agg(F.min(column), F.max(column)).first()
    need = k
    while True:
        inside = keys.filter(F.col(column).between(low, high))
        n = inside.count()
        if n <= few:
            return sorted((r[0] for r in inside.select(column).collect()), reverse=True)[need - 1]
        if high <= low:
            return low
        width = (high - low) / bins
        b = F.least(F.lit(bins - 1), F.floor((F.col(column) - low) / width))
        rows = inside.groupBy(b.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).collect()
        for r in sorted(rows, key=lambda r: -r["b"]):
            if need <= r["n"]:
                low, high = r["lo"], r["hi"]
                break
            need -= r["n"]


def resample(docs: DataFrame, labels: DataFrame, sharpness: float = 20.0, seed: int = 7, **fit_args) -> DataFrame:
    """doc_id, log_weight, gumbel_key, keep of every document."""
    spark = docs.sparkSession
    model = fit(docs, labels, **fit_args)
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.col("text"), F.lit("")), F.lit(seed))
    unit = (F.shiftrightunsigned(key, 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    scored = weigh(docs.select("doc_id", "text", (-F.log(-F.log(unit))).alias("noise")), model["ratios"])
    scored = written(spark, scored.select("doc_id", "log_weight", "noise"), "weights")
    held = scored.join(F.broadcast(model["held"].withColumnRenamed("doc_id", "_id")), F.col("doc_id") == F.col("_id")) \
        .select("log_weight", "good").toPandas()          # at most about 15 % of `sample` labelled rows
    cut = best_cut(held["log_weight"].to_numpy(float), held["good"].to_numpy(bool)) if model["ratios"] is not None else -math.inf
    scale = sharpness / abs(cut) if math.isfinite(cut) and cut else 1.0
    scored = scored.select("doc_id", "log_weight", (scale * F.col("log_weight") + F.col("noise")).alias("gumbel_key"))
    k = scored.filter(F.col("log_weight") >= F.lit(cut)).count()
    if not k:
        return scored.withColumn("keep", F.lit(True))
    least = kth_largest(scored, "gumbel_key", k)
    return scored.withColumn("keep", F.col("gumbel_key") >= F.lit(least))
