"""N-gram Jaccard join by parity sketches.

A document is the set of hashes of its distinct `width`-word shingles.  A
parity sketch XORs every element into one of k segments; equal elements
cancel, so two sketches differ in at most as many segments as the sets differ
in elements.  A pair with Jaccard t or more differs in at most
D = (1 - t) / (1 + t) x (|A| + |B|) elements, hence (pigeonhole) agrees in all
but D segments.

Bands.  k is fixed per band of set sizes [2^i, 2^(i+1)); a set just above a
band also takes part in it as the larger partner, so every pair that can reach
t meets in one band.  Of a sketch's non-empty segments the first D + 1 in one
global order are enough for two similar sketches to share one (prefix
argument); sketches with too few non-empty segments also give a prefix of
their elements.  The order puts *hot* segments last, the hotter the later:
those that several sketches of one task share, such as a licence line on its
own.  Any order is right; this one keeps unrelated texts with a common passage
apart.

Steps.
1. One pass writes size, fingerprint and a foldable bit sketch of each text
   and counts hot segments (a bounded table, at most `max_hot` rows).
2. A second pass sends (segment value, document) entries, packed by bucket.
   A task sends one document per distinct set, and for a segment value that
   several of its sets share it sends the first one and links the rest to it.
3. A bucket links the documents of a value to their smallest one (a star, not
   all pairs).  Star pairs with fitting sizes pass the bit sketch (Hamming
   distance at most D) and are verified on the whole sets; verified links
   give components.
4. A value whose documents lie in several components may hide further links.
   Values of the same members count once.  Under values of many members those
   outside the largest component first meet some of that component's (the same
   ones under all values), which merges what belongs together; then those still
   outside meet all members.  Pairs that share several values pass this join
   under the first one.  The same checks follow, and the links give the final
   components.
Equal sets are one class throughout, so copies never multiply.

Defined results: a NULL text or one without words has 0 shingles and links
with nothing; a text of fewer words than `width` is one shingle; a NULL id
takes no part and gets a NULL component; repeated rows share their result;
extra columns are ignored.  Hashes have 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelens.llm.common import (LOWER, SPACE_WORDS, by_ids, combine, distinct, few_files, flat_text, input_bytes, mix,
                                 release, slices, word_hashes, word_spans, written)
from zonelens.llm.components import components

_U = np.uint64
WORDS = 16                   # 64-bit words of the sketch size that a join compares
FLUSH = 1 << 19              # entries a task holds before it combines and sends them
SHARED = 1 << 22             # segment values a task holds to find the shared ones


def shingle_sets(buf: np.ndarray, offs: np.ndarray, width: int):
    """Sorted distinct shingle hashes of each text of a slice."""
    low = LOWER[buf]
    s, e, counts = word_spans(low, offs, SPACE_WORDS)
    h = word_hashes(low, s, e)
    sh = combine(h, width)
    at = np.concatenate([[0], np.cumsum(counts)])
    for k in range(len(counts)):
        a, b = int(at[k]), int(at[k + 1])
        if b - a >= width:
            yield distinct(sh[a:b - width + 1])
        elif b > a:
            yield combine(h[a:b], b - a) ^ _U(b - a)
        else:
            yield np.zeros(0, _U)


def bit_sketch(x: np.ndarray) -> np.ndarray:
    """Parity bits of a set: a power of two, at least a bit per element and 64 * WORDS bits; halves
    XORed give the sketch of half the size.  Sets that differ in all their elements differ in half
    of the bits or little less, well over the 2/7 that similar ones may."""
    m = max(64 * WORDS, 1 << (max(1, len(x)) - 1).bit_length())
    odd = np.bincount((x & _U(m - 1)).astype(np.int64), minlength=m) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def hamming(a: np.ndarray, b: np.ndarray) -> int:
    """Distance of two bit sketches at the smaller one's size."""
    if len(a) < len(b):
        a, b = b, a
    while len(a) > len(b):
        a = a[:len(a) // 2] ^ a[len(a) // 2:]
    return int(np.bitwise_count(a ^ b).sum())


def bands(n: int) -> list[tuple[int, int]]:
    """(band, most differing elements) of a set size: its own band, and the one below when a
    partner there can reach 0.75."""
    own = n.bit_length() - 1
    out = [(own, (n + 4 * n // 3) // 7)]
    if own and 3 * n < 4 << own:
        out.append((own - 1, 2 * n // 7))
    return out


def band_segments(x: np.ndarray, band: int):
    """Values of the non-empty segments of a set's sketch in a band."""
    top = (4 * (2 << band)) // 3 + 1
    k = 4 * top
    seg = (x >> _U(33)) % _U(k)
    order = np.argsort(seg, kind="stable")
    seg, x = seg[order], x[order]
    first = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
    return mix(np.bitwise_xor.reduceat(x, first) + seg[first] * _U(0x9E3779B97F4A7C15) + _U(band))


def every_value(x: np.ndarray) -> np.ndarray:
    return np.concatenate([band_segments(x, band) for band, _ in bands(len(x))])


def signatures(x: np.ndarray, hot: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Values under which a set meets every set it may be similar to.  `hot`: sorted values that
    many sets share and how late each comes in the order."""
    out = []
    for band, most in bands(len(x)):
        values = np.sort(band_segments(x, band))
        if len(values) <= most:                    # too few segments: also meet by elements
            out.append(mix(x[:len(x) - -(-3 * len(x) // 4) + 1] + _U(0x5851F42D) + _U(band)))
        if len(hot[0]):
            at = np.searchsorted(hot[0], values)
            at[at == len(hot[0])] = 0
            late = np.where(hot[0][at] == values, hot[1][at], 0)
            values = values[np.argsort(late, kind="stable")]
        out.append(values[:most + 1])
    return distinct(np.concatenate(out))


# ------------------------------------------------------------------ passes over the texts

def _texts(batches, width: int):
    for batch in batches:
        buf, offs = flat_text(batch.column("text"))
        ids = batch.column("doc_id").to_pylist()
        for i, j in slices(offs):
            yield from zip(ids[i:j], shingle_sets(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i], width))


def _fingerprint(x: np.ndarray) -> tuple[int, int]:
    a = np.bitwise_xor.reduce(x) if len(x) else _U(0)
    b = mix(x).sum(dtype=_U) if len(x) else _U(0)
    return int(np.int64(a.view(np.int64))), int(np.int64(b.view(np.int64)))


PROFILE = "doc_id long, n int, k1 long, k2 long, sketch binary, shared binary"


def _profiles(width: int):
    """One row per text; one more per task with the segment values that its texts share."""
    def run(batches):
        rows, held, size, seen = [], [], 0, set()

        def out(shared=None):
            cols = list(zip(*rows)) or [()] * 5
            extra = [] if shared is None else [shared]
            pad = [None] * len(extra)
            arrays = [pa.array(list(cols[0]) + pad, pa.int64()), pa.array(list(cols[1]) + [-1] * len(extra), pa.int32()),
                      pa.array(list(cols[2]) + pad, pa.int64()), pa.array(list(cols[3]) + pad, pa.int64()),
                      pa.array(list(cols[4]) + pad, pa.binary()), pa.array([None] * len(cols[0]) + extra, pa.binary())]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "k1", "k2", "sketch", "shared"])

        def shared():
            v, c = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            v, c = v[c > 1], c[c > 1]
            return np.concatenate([v, c.astype(_U)]).tobytes()
        for doc, x in _texts(batches, width):
            key = _fingerprint(x)
            rows.append((doc, len(x), *key, bit_sketch(x).tobytes() if len(x) else b""))
            if len(x) and key not in seen:
                seen.add(key)
                held.append(every_value(x))
                size += len(held[-1])
            if size >= SHARED:
                size = 0
                yield out(shared())
                release()
            elif len(rows) >= 2000:
                yield out()
        yield out(shared() if held else None)
    return run


def planes(a: np.ndarray, keep: int) -> bytes:
    """The low `keep` bytes of 64-bit integers, byte by byte, so that equal high bytes compress."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8)[:, :keep].T).tobytes()


def unplanes(b: bytes, keep: int) -> np.ndarray:
    part = np.frombuffer(b, np.uint8).reshape(keep, -1)
    out = np.zeros((part.shape[1], 8), np.uint8)
    out[:, :keep] = part.T
    return out.view(np.int64).ravel()


ENTRY = "bucket int, value binary, head binary, doc binary, head_n binary, doc_n binary, more binary"
BYTES = {"value": 6, "head": 8, "doc": 8, "head_n": 4, "doc_n": 4, "more": 1}


def _entries(width: int, buckets: int, hot: tuple[np.ndarray, np.ndarray]):
    """Packed (segment value, head, document) entries; head = document for the one that
    stands for its task, which goes to the value's bucket, others go anywhere."""
    def run(batches):
        held, seen, size = [], set(), 0

        def out():
            v = np.concatenate([h[2] for h in held])
            d = np.repeat(np.array([h[0] for h in held], np.int64), [len(h[2]) for h in held])
            n = np.repeat(np.array([h[1] for h in held], np.int64), [len(h[2]) for h in held])
            held.clear()
            order = np.lexsort((d, v))
            v, d, n = v[order], d[order], n[order]
            first = np.concatenate([[True], v[1:] != v[:-1]])
            at = np.flatnonzero(first)[np.cumsum(first) - 1]
            size = np.bincount(np.cumsum(first) - 1)[np.cumsum(first) - 1]       # documents here with the value
            to = np.where(first, (v >> _U(40)) % _U(buckets), (mix(d.view(_U)) ^ v) % _U(buckets)).astype(np.int32)
            cols = {"value": v.view(np.int64), "head": d[at], "doc": d, "head_n": n[at], "doc_n": n, "more": (size > 1).astype(np.int64)}
            order = np.argsort(to, kind="stable")
            cut = np.searchsorted(to[order], np.arange(buckets + 1))
            used = np.flatnonzero(np.diff(cut))
            arrays = [pa.array(used.astype(np.int32))]
            for name, c in cols.items():
                c = c[order]
                arrays.append(pa.array([planes(c[cut[b]:cut[b + 1]], BYTES[name]) for b in used], pa.binary()))
            return pa.RecordBatch.from_arrays(arrays, names=["bucket", *cols])
        for doc, x in _texts(batches, width):
            if doc is None or not len(x):
                continue
            key = _fingerprint(x)
            if key in seen:
                continue
            seen.add(key)
            held.append((doc, len(x), signatures(x, hot)))
            size += len(held[-1][2])
            if size >= FLUSH:
                yield out()
                size = 0
                release()
        if held:
            yield out()
        release()
    return run


STAR = "value long, head long, doc long, head_n int, doc_n int, several boolean"


def _stars(table: pa.Table) -> pa.Table:
    """Stars of one bucket: every value that two documents share, hung on its smallest head.
    `several`: the value may have three documents or more."""
    cols = {c: np.concatenate([unplanes(b, k) for b in table.column(c).to_pylist()]) for c, k in BYTES.items()}
    lead = cols["head"] == cols["doc"]
    v, d, n, more = (cols[c][lead] for c in ("value", "doc", "doc_n", "more"))
    order = np.lexsort((d, v))
    v, d, n, more = v[order], d[order], n[order], more[order]
    first = np.concatenate([[True], v[1:] != v[:-1]]) if len(v) else np.zeros(0, bool)
    at = np.flatnonzero(first)[np.cumsum(first) - 1] if len(v) else np.zeros(0, np.int64)
    group = np.cumsum(first) - 1
    several = ((np.bincount(group) > 2) | (np.bincount(group, weights=more) > 0))[group] if len(v) else np.zeros(0, bool)
    hung = ~first & (d != d[at])
    parts = [(v[hung], d[at][hung], d[hung], n[at][hung], n[hung], several[hung].astype(np.int64)),
             tuple(cols[c][~lead] for c in ("value", "head", "doc", "head_n", "doc_n", "more"))]
    out = [np.concatenate(p) for p in zip(*parts)]
    del cols, parts, v, d, n, order, at, group
    release()
    return pa.table({"value": pa.array(out[0]), "head": pa.array(out[1]), "doc": pa.array(out[2]),
                     "head_n": pa.array(out[3].astype(np.int32)), "doc_n": pa.array(out[4].astype(np.int32)), "several": pa.array(out[5] > 0)})


# ------------------------------------------------------------------ verification

def _sketch_filter(batches):
    for b in batches:
        xs, ys = b.column("sx").to_pylist(), b.column("sy").to_pylist()
        n = b.column("nx").to_numpy().astype(np.int64) + b.column("ny").to_numpy()
        keep = [hamming(np.frombuffer(p, np.uint8), np.frombuffer(q, np.uint8)) * 7 <= k for p, q, k in zip(xs, ys, n.tolist())]
        yield b.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))


def _exact(percent: int):
    def run(batches):
        for b in batches:
            keep = []
            for p, q in zip(b.column("sx").to_pylist(), b.column("sy").to_pylist()):
                p, q = np.frombuffer(p, _U), np.frombuffer(q, _U)
                at = np.searchsorted(p, q)
                at[at == len(p)] = 0
                both = int((p[at] == q).sum())
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield b.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))
    return run


def _sets_of(width: int):
    def run(batches):
        for batch in batches:
            out = list(_texts([batch], width))
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in out], pa.int64()),
                                              pa.array([x.tobytes() for _, x in out], pa.binary())], names=["doc_id", "s"])
    return run


FEW_ROWS = 1 << 17           # narrow rows of a table that is broadcast: about 8 MB, several of which may be on the driver at once


def _few(rows: DataFrame) -> DataFrame:
    """A written table of a few numbers a row, as the broadcast side of its joins when it has at
    most FEW_ROWS.  The driver gathers, builds and sends a broadcast, so wider ones never are."""
    return F.broadcast(rows) if rows.limit(FEW_ROWS + 1).count() <= FEW_ROWS else rows


def _attach(pairs: DataFrame, side: DataFrame) -> DataFrame:
    """Both partners' rows of `side` (doc_id, s, n) on every pair."""
    x = side.select(F.col("doc_id").alias("x"), *[F.col(c).alias(f"{c}x") for c in side.columns if c != "doc_id"])
    y = side.select(F.col("doc_id").alias("y"), *[F.col(c).alias(f"{c}y") for c in side.columns if c != "doc_id"])
    return pairs.join(x, "x").join(y, "y")


def _links(docs: DataFrame, profiles: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (distinct x < y) that are similar."""
    spark = docs.sparkSession
    sketches = profiles.select("doc_id", F.col("sketch").alias("s"), "n")
    near = _attach(pairs, sketches).filter(F.least("nx", "ny") * 100 >= F.greatest("nx", "ny") * percent)
    near = written(spark, near.mapInArrow(_sketch_filter, "x long, y long"), "near")
    ids = near.select(F.explode(F.array("x", "y")).alias("id"))
    sets = (by_ids(docs.select("doc_id", "text"), ids, "left_semi")
            .mapInArrow(_sets_of(width), "doc_id long, s binary"))
    return written(spark, _attach(near, sets).mapInArrow(_exact(percent), "x long, y long"), "similar")


PIVOT_ROUNDS, PIVOTS, FEW = 1, 8, 64
VOID = 7 * 64 * WORDS // 4   # from this size on, similar sets may differ in half the bits of the joined sketch
LONG = 3 * VOID // 4         # from this size on, sets may meet one of VOID or more: they also carry a longer sketch
FIRST = 4                    # open values that a document carries into the last join, to meet a partner once


def _fits(n: str, m: str, percent: int):
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _sketch_words(profiles: DataFrame, ids: DataFrame) -> DataFrame:
    """d and the bit sketch of some documents: at one size as columns s0, s1, ... so that joins
    compare them in generated code, and for sets of LONG elements or more also as an array of
    0.75 to 1.5 bits an element."""
    def run(batches):
        for b in batches:
            rows = [np.frombuffer(s, np.uint8) for s in b.column("sketch").to_pylist()]       # at least 8 * WORDS bytes
            out, longer = np.zeros((len(rows), 8 * WORDS), np.uint8), []
            for k, (s, n) in enumerate(zip(rows, b.column("n").to_pylist())):
                while 16 * len(s) > 3 * n and len(s) > 8 * WORDS:
                    s = s[:len(s) // 2] ^ s[len(s) // 2:]
                longer.append(s.view(np.int64) if n >= LONG else None)
                if n >= VOID:
                    continue                       # nothing to tell at the one size: zeros travel for little
                while len(s) > 8 * WORDS:
                    s = s[:len(s) // 2] ^ s[len(s) // 2:]
                out[k] = s
            v = out.view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(v[:, i].copy()) for i in range(WORDS)), pa.array(longer, pa.list_(pa.int64()))],
                                             names=["d", *(f"s{i}" for i in range(WORDS)), "longer"])
    some = profiles.select("doc_id", "n", "sketch").join(ids.withColumnRenamed("d", "doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return some.mapInArrow(run, "d long, " + ", ".join(f"s{i} long" for i in range(WORDS)) + ", longer array<long>")


def _distance(a: str, b: str):
    """Hamming distance of two sketches kept as arrays, at the smaller one's size; sets of fitting
    sizes have sketches of one size or of twice that."""
    size = F.least(F.size(a), F.size(b))

    def at_size(c: str):
        halves = F.zip_with(F.slice(c, F.lit(1), size), F.slice(c, size + 1, size), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(c) > size, halves).otherwise(F.col(c))
    bits = F.zip_with(at_size(a), at_size(b), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return F.aggregate(bits, F.lit(0), lambda total, c: total + c)


def _unsettled(members: DataFrame, comp: DataFrame) -> DataFrame:
    """Members (value, d, dn) of the values of three or more documents that lie in several
    components, with their component and the value's largest one (`main`).  Of the values that
    have the same members (by two 64-bit hashes) one stays: similar texts share hundreds."""
    spark = members.sparkSession
    m = (members.join(_few(comp.withColumnRenamed("node", "d")), "d", "left")
         .withColumn("component", F.coalesce("component", "d")))
    prints = [F.bit_xor(F.xxhash64("d", "dn", F.lit(i))).alias(f"h{i}") for i in range(2)]
    main = (m.groupBy("value", "component").agg(F.count(F.lit(1)).alias("c"), *prints)
            .groupBy("value").agg(F.max(F.struct("c", F.col("component").alias("m"))).alias("top"), F.sum("c").alias("all"),
                                  *[F.bit_xor(f"h{i}").alias(f"h{i}") for i in range(2)])
            .filter("all > 2 and all > top.c")
            .groupBy("all", "h0", "h1", F.col("top.m").alias("main")).agg(F.min("value").alias("value")).select("value", "main"))
    main = written(spark, main, "open-values")
    return written(spark, m.join(_few(main), "value"), "open")


def _meeting_words(profiles: DataFrame, open_: DataFrame) -> DataFrame:
    """d, the sketch and the FIRST smallest values of every member of the open values; none of an
    id whose texts differ in size, which so meets under every value."""
    first = open_.groupBy("d").agg(F.when(F.min("dn") == F.max("dn"), F.slice(F.array_sort(F.collect_list("value")), 1, FIRST))
                                   .otherwise(F.array().cast("array<long>")).alias("first"))
    first = written(open_.sparkSession, first, "first")
    return _sketch_words(profiles, first.select("d")).join(first, "d")


def _meetings(open_: DataFrame, words: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, d) of documents of different components that share an open value and may be
    similar by size and sketch.  Two members outside `main` meet once, not once each.  A pair
    that has common values among the first ones of both passes under the smallest of these, so
    it is one row however many values it shares; only a pair without any is a row per value."""
    bits = [f"s{i}" for i in range(WORDS)]
    left = open_.filter("component <> main").select("value", F.col("d").alias("a"), F.col("dn").alias("an"), F.col("component").alias("ac")) \
        .join(words.select(F.col("d").alias("a"), *[F.col(c).alias(f"a{c}") for c in [*bits, "longer", "first"]]), "a")
    right = open_.select(F.col("value").alias("v"), "d", "dn", "component", "main").join(words, "d")
    most = F.col("an") + F.col("dn")
    small = F.greatest("an", "dn") < VOID
    differ = sum((F.bit_count(F.col(f"a{c}").bitwiseXOR(F.col(c))) for c in bits), F.lit(0))
    once = F.coalesce(F.array_min(F.array_intersect("afirst", "first")) >= F.col("value"), F.lit(True))
    return left.join(right, (F.col("value") == F.col("v")) & (F.col("ac") != F.col("component"))
                     & ((F.col("component") == F.col("main")) | (F.col("a") < F.col("d"))) & _fits("an", "dn", percent)
                     & (~small | (differ * 7 <= most)) & once & (small | (_distance("alonger", "longer") * 7 <= most)))


def similarity_classes(docs: DataFrame, width: int = 5, percent: int = 75, hot_from: int = 2,
                       max_hot: int = 1 << 18, bucket_bytes: int = 2 << 20) -> DataFrame:
    """doc_id, n_shingles, component_id of every document (`docs`: doc_id, text).
    Sizes and bands are laid out for `percent` of 75 and more."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    raw = written(spark, docs.mapInArrow(_profiles(width), PROFILE), "profiles")
    profiles = raw.filter("n >= 0").select("doc_id", "n", "k1", "k2", "sketch")

    def unpack(batches):
        for b in batches:
            for s in b.column("shared").to_pylist():
                v = np.frombuffer(s, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(v[:len(v) // 2]), pa.array(v[len(v) // 2:])], names=["v", "c"])
    shared = raw.filter("n < 0").select("shared").mapInArrow(unpack, "v long, c long")
    counts = shared.groupBy("v").agg(F.sum("c").alias("c")).filter(F.col("c") >= hot_from)
    counts = written(spark, counts, "hot")
    total = counts.agg(F.sum("c")).first()[0] or 0
    hot = counts.filter(F.col("c") >= F.lit(max(hot_from, total // max_hot))).toArrow()              # <= max_hot rows
    values = hot.column("v").to_numpy().view(_U) if hot.num_rows else np.zeros(0, _U)
    order = np.argsort(values)
    late = np.log2(hot.column("c").to_numpy()).astype(np.int64) if hot.num_rows else np.zeros(0, np.int64)
    hot = (values[order], late[order])
    shared_hot = spark.sparkContext.broadcast(hot)
    buckets = int(max(8, min(1 << 20, input_bytes(docs) // bucket_bytes)))

    def entries(batches):
        yield from _entries(width, buckets, shared_hot.value)(batches)
    stars = (docs.mapInArrow(entries, ENTRY).repartition(buckets, "bucket")
             .groupBy("bucket").applyInArrow(_stars, STAR))
    stars = written(spark, few_files(stars, buckets), "stars")
    fits = F.least("head_n", "doc_n") * 100 >= F.greatest("head_n", "doc_n") * percent
    pairs = stars.filter(fits).select(F.least("head", "doc").alias("x"), F.greatest("head", "doc").alias("y")).distinct()
    pairs = written(spark, pairs, "pairs")
    links = _links(docs, profiles, pairs, width, percent)

    classes = profiles.filter("n > 0 and doc_id is not null").groupBy("n", "k1", "k2").agg(F.min("doc_id").alias("rep"))
    classes = written(spark, profiles.select("doc_id", "n", "k1", "k2").join(classes, ["n", "k1", "k2"], "left")
                      .select("doc_id", "n", "rep"), "classes")
    rep_of = written(spark, classes.filter("doc_id <> rep").select("doc_id", "rep").distinct(), "reps")

    def on_reps(found: DataFrame) -> DataFrame:
        for c in ("x", "y"):
            found = found.join(_few(rep_of.select(F.col("doc_id").alias(c), F.col("rep").alias("_r"))), c, "left") \
                .withColumn(c, F.coalesce("_r", c)).drop("_r")
        return found.filter("x <> y").distinct()
    links = written(spark, on_reps(links), "links")
    comp = written(spark, components(links), "components")

    # values of three or more documents that lie in several components
    wide = stars.filter("several")
    members = wide.select("value", F.col("doc").alias("d"), F.col("doc_n").alias("dn")).unionByName(
        wide.select("value", F.col("head").alias("d"), F.col("head_n").alias("dn")).distinct())
    members = members.join(_few(rep_of.withColumnRenamed("doc_id", "d")), "d", "left") \
        .select("value", F.coalesce("rep", "d").alias("d"), "dn").distinct()
    members = written(spark, members, "members")
    open_ = _unsettled(members, comp)
    turn = 0
    while turn <= PIVOT_ROUNDS:
        if open_.isEmpty():
            break
        if turn < PIVOT_ROUNDS:                # under values of few members the last step is cheap: no rounds before it
            large = written(spark, open_.groupBy("value").count().filter(F.col("count") > FEW).select("value"), "large-values")
            if large.isEmpty():
                turn = PIVOT_ROUNDS
        turn += 1
        if turn <= PIVOT_ROUNDS:
            held = open_.join(_few(large), "value", "left_semi")
            others = held.filter("component <> main").select("value", F.col("d").alias("a"), F.col("dn").alias("an"), F.col("component").alias("ac"))
            salts = [F.min(F.struct(F.xxhash64("d", F.lit(8 * turn + i)).alias("h"), "d", "dn", "component")).alias(f"p{i}") for i in range(PIVOTS)]
            centre = held.filter("component = main").groupBy("value").agg(*salts)
            met = others.join(centre, "value").select("a", "an", "ac", F.array(*[f"p{i}" for i in range(PIVOTS)]).alias("ps")).distinct() \
                .select("a", "an", "ac", F.explode("ps").alias("p")).select("a", "an", "ac", "p.d", "p.dn", "p.component")
            met = met.filter((F.col("ac") != F.col("component")) & _fits("an", "dn", percent))
        else:
            met = _meetings(open_, written(spark, _meeting_words(profiles, open_), "words"), percent)
        rest = written(spark, met.select(F.least("a", "d").alias("x"), F.greatest("a", "d").alias("y")).distinct()
                       .join(pairs, ["x", "y"], "left_anti"), "pairs")
        if rest.isEmpty():
            continue
        pairs = pairs.unionByName(rest)
        more = written(spark, on_reps(_links(docs, profiles, rest, width, percent)), "links")
        if more.isEmpty():
            continue
        # only the new links need joining: between the components so far
        known = comp.withColumnRenamed("component", "_c")
        for c in ("x", "y"):
            more = more.join(known.withColumnRenamed("node", c), c, "left").withColumn(c, F.coalesce("_c", c)).drop("_c")
        merged = written(spark, components(more), "merged")
        before = comp.withColumnRenamed("component", "_c").join(merged.select(F.col("node").alias("_c"), F.col("component").alias("_m")), "_c", "left") \
            .select("node", F.coalesce("_m", "_c").alias("component"))
        fresh = merged.join(comp.select("node"), "node", "left_anti")
        comp = written(spark, before.unionByName(fresh), "components")
        if turn <= PIVOT_ROUNDS:               # any merged component will do as the one the others lie outside of
            for c in ("component", "main"):
                open_ = open_.join(_few(merged.select(F.col("node").alias(c), F.col("component").alias("_m"))), c, "left") \
                    .withColumn(c, F.coalesce("_m", c)).drop("_m")
            open_ = written(spark, open_, "open")
    return (classes.join(comp.withColumnRenamed("node", "rep"), "rep", "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                    F.coalesce("component", "rep", "doc_id").alias("component_id")))
