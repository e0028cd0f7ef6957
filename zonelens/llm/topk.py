"""Exact top-k search by no-random-access aggregation.

Every dimension of a block of candidate vectors is a list sorted by value.
Queries read the lists sequentially from the end that scores best (descending
for a positive query weight, ascending for a negative one), every list down to
the same depth per round.  The frontier value of a list bounds every entry not
read yet, so each candidate has a lower score bound (what was read plus the
list's worst value for the rest) and an upper one (the frontier for the rest).
A candidate whose upper bound is below the k-th best lower bound cannot
qualify; reading stops for a query when few candidates can, and those get
their final scores from the entries not read yet.  Ties go to the smaller id,
so a candidate whose upper bound equals the k-th lower bound stays in.  The
bounds of all queries of a batch are two matrix products per round over the
entries read so far; all numbers are integers held exactly in floats.

Distribution.  Queries and candidates are cut into blocks by a hash; each pair
of blocks is one group (bounded memory on both sides), and the k best of all
blocks per query are ranked at the end.  The work is queries x candidates by
definition; the lists of a block are sorted once per query block.

Vectors are integers: floor(scale x component).  Defined results: vectors that
are NULL or hold NULL or a non-finite component take no part; a shorter vector
counts as 0 beyond its end; a candidate with the query's own id is skipped;
fewer than k candidates give fewer rows; repeated rows are candidates each; a
NULL id takes no part.  Scores are exact at any size that fits 64 bits; a scaled
component or a result beyond them is an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonelens.llm.common import written

ROUNDS = (0.5, 0.75, 0.9)      # share of each list read by the end of a round
BATCH = 256                    # queries whose bounds are held at a time


class SortedLists:
    """The sorted lists of one block of candidates."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.values = np.sort(vectors, axis=0)                 # ascending, per dimension

    def read(self, share: float, kind):
        """Best and worst case of every entry once all lists are read to a depth: for positive
        query weights (read from the top) stacked over those for negative ones."""
        n = len(self.ids)
        depth = min(n, max(1, int(n * share)))
        high, low = self.values[n - depth], self.values[depth - 1]          # frontiers
        v = self.vectors
        best = np.concatenate([np.maximum(v, high), np.minimum(v, low)], axis=1)
        worst = np.concatenate([np.where(v >= high, v, self.values[0]), np.where(v <= low, v, self.values[-1])], axis=1)
        return best.astype(kind).T, worst.astype(kind).T

    def _whole(self, queries: np.ndarray, own: np.ndarray, k: int):
        """`top` for scores beyond 2^53, where bounds in floating point are not exact: whole
        scores in unbounded integers.  One beyond 64 bits has no column to go to and is an error."""
        for r, q in enumerate(queries.astype(object)):
            live = np.flatnonzero(self.ids != own[r])
            score = (self.vectors[live].astype(object) @ q).tolist()
            best = sorted(range(len(live)), key=lambda b: (-score[b], self.ids[live[b]]))[:k]
            if any(abs(score[b]) >= 1 << 63 for b in best):
                raise OverflowError("an inner product does not fit 64 bits")
            yield from ((r, score[b], int(self.ids[live[b]])) for b in best)

    def top(self, queries: np.ndarray, own: np.ndarray, k: int):
        """(query row, score, id) of the k best candidates of each query, its own id left out."""
        n = len(self.ids)
        # sums of magnitudes as Python integers: they tell what the scores can be, exactly
        heavy = max((sum(map(abs, q)) for q in queries.tolist()), default=0)
        largest = heavy * max((max(map(abs, v), default=0) for v in (self.values[[0, -1]].tolist() if n else [])), default=0)
        if largest >= 1 << 53:
            yield from self._whole(queries, own, k)
            return
        kind = np.float32 if largest < 1 << 24 else np.float64
        bounds = [self.read(s, kind) for s in ROUNDS] if n > 16 * k else []
        for i in range(0, len(queries), BATCH):
            q = queries[i:i + BATCH]
            signed = np.concatenate([np.maximum(q, 0), np.minimum(q, 0)], axis=1).astype(kind)
            alive = self.ids[None, :] != own[i:i + BATCH, None]
            reading = np.arange(len(q))
            for best, worst in bounds:
                lower = signed[reading] @ worst
                lower[~alive[reading]] = -np.inf
                floor = np.partition(lower, n - k, axis=1)[:, n - k]
                alive[reading] &= signed[reading] @ best >= floor[:, None]
                reading = reading[alive[reading].sum(1) > max(4 * k, n // 50)]
                if not len(reading):
                    break
            for r in range(len(q)):
                live = np.flatnonzero(alive[r])
                score = self.vectors[live] @ q[r]
                if len(live) > k:
                    keep = score >= np.partition(score, len(score) - k)[len(score) - k]
                    live, score = live[keep], score[keep]
                order = np.lexsort((self.ids[live], -score))[:k]
                yield from ((i + r, int(score[b]), int(self.ids[live[b]])) for b in order)


def _matrix(col: pa.ChunkedArray) -> np.ndarray:
    col = col.combine_chunks()
    size = np.diff(col.offsets.to_numpy())
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(size), int(size.max(initial=0))), np.int64)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _block(k: int):
    def run(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        asks = table.column("ask").to_numpy(zero_copy_only=False).astype(bool)
        vectors = _matrix(table.column("v"))
        rows = []
        if asks.any() and not asks.all():
            lists = SortedLists(ids[~asks], vectors[~asks])
            own = ids[asks]
            rows = [(int(own[r]), v, s) for r, s, v in lists.top(vectors[asks], own, k)]
        cols = list(zip(*rows)) or [(), (), ()]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()),
                         "score": pa.array(cols[2], pa.int64())})
    return run


def quantised(vectors: DataFrame, vector: str, scale: int) -> DataFrame:
    """id and integer vector of the rows that take part."""
    v = F.col(vector)
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = lambda x: F.floor(x.cast("double") * scale)
    fits = lambda x: F.abs(x.cast("double") * scale) < F.lit(float(1 << 63))
    return (vectors.filter(F.col("vec_id").isNotNull() & v.isNotNull()).filter(sound)
            .select(F.col("vec_id").cast("long").alias("id"),
                    F.transform(v, lambda x: F.when(fits(x), whole(x)).otherwise(
                        F.raise_error(F.lit("a scaled component does not fit 64 bits")).cast("long"))).alias("v")))


def top_k(vectors: DataFrame, is_query, k: int = 5, scale: int = 256, vector: str = "embedding",
          query_block: int = 2048, candidate_block: int = 8192) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of `vectors` where `is_query` holds, its k best others."""
    # written once, so that a row's place, which deals the candidates, is the same in every pass and retry
    rows = written(vectors.sparkSession, quantised(vectors, vector, scale), "vectors")
    asking = quantised(vectors.filter(is_query), vector, scale).distinct()
    n, m = rows.count(), asking.count()
    nc, nq = max(1, -(-n // candidate_block)), max(1, -(-m // query_block))
    block = lambda salt, blocks: F.pmod(F.xxhash64("id", "v", F.lit(salt)), F.lit(blocks)).cast("int")
    grid = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    spread = F.monotonically_increasing_id()           # equal rows go to different blocks
    cand = rows.select("id", "v", F.lit(False).alias("ask"), F.pmod(F.hash(spread), F.lit(nc)).alias("cb"), grid(nq).alias("qb"))
    asked = asking.select("id", "v", F.lit(True).alias("ask"), block("query", nq).alias("qb"), grid(nc).alias("cb"))
    found = (cand.unionByName(asked).groupBy("cb", "qb")
             .applyInArrow(_block(k), "query_id long, vec_id long, score long"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w).cast("int")).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
