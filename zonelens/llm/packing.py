"""Best-fit packing with large-item matching.

Documents become token ids plus one end id; only documents longer than the
capacity are cut.  A piece above a third of the capacity is *large*: at most
two fit one sequence, so large pieces are matched greedily, the largest with
the largest that still fits.  Smaller pieces then go, longest first, to the
sequence with the smallest remaining gap that holds them.

Scale.  Which piece goes where depends on lengths alone, and there are at most
`capacity` lengths.  So Spark counts pieces by length, the plan is made for
the counts (a bin pattern stands for all bins that look alike; its size is
bounded by the capacity, not by the rows), and each piece finds its place from
its length and its rank among pieces of that length.  Ranks come from a rank
inside the task that made the piece plus the number of such pieces in earlier
tasks, a sum over the small (task, length) table; no piece is sorted or
gathered, and a length that holds a third of all rows is no hot key.

Tokenising.  Words repeat, so each task runs the tokenizer library once per
distinct unit: a maximal run of letters, one digit or a run of punctuation for
plain ASCII / Latin-1-letter words, and the whole blank-separated chunk for all
others (control characters, apostrophes, other scripts, special-token text).
The rule of the vocabulary never joins across those borders; tests compare
with the library's own result on whole texts.

Defined results: a NULL or empty text is the single end id; repeated rows are
packed each; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonelens.llm.common import HASHER, LOWER, SPACE_WORDS, flat_text, release, slices, word_spans, written

SLICE = 1 << 20              # bytes of text whose units are looked up together
CACHE_UNITS = 1 << 19        # distinct units a task remembers before it starts anew


def _byte_classes() -> np.ndarray:
    t = np.full(256, 4, np.uint8)             # 4: anything that needs the whole chunk
    t[0x21:0x7F] = 3                          # ASCII punctuation
    t[0x27] = 4                               # apostrophe: contractions
    t[0x30:0x3A] = 2
    t[0x61:0x7B] = 1
    t[[0x20, *range(0x09, 0x0E)]] = 0
    return t


_CLASSES = _byte_classes()


def byte_alphabet() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class UnitTokenizer:
    """Token ids of texts through a table of distinct units."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.alphabet = byte_alphabet()
        self._reset()

    def _reset(self) -> None:
        self.slot: dict[int, int] = {}
        self.ids, self.first = array("I"), array("q", [0])

    def _unit(self, raw: bytes, whole: bool) -> list[int]:
        if whole:
            return self.tok.encode(raw.decode("utf-8", "replace"), add_special_tokens=False).ids
        return [t.id for t in self.model.tokenize("".join(map(self.alphabet.__getitem__, raw)))]

    def encode(self, buf: np.ndarray, offs: np.ndarray):
        """(ids of all texts, offsets of each text's ids)."""
        starts, ends, whole, text, counts = units(buf, offs)
        low = text
        h = HASHER.spans(HASHER.prefix(low), starts, ends) ^ whole.astype(np.uint64)
        distinct, at, inv = np.unique(h, return_index=True, return_inverse=True)
        if len(self.slot) > CACHE_UNITS:
            self._reset()
        slots = np.empty(len(distinct), np.int64)
        raw = low.tobytes()
        for k, (key, i) in enumerate(zip(distinct.tolist(), at.tolist())):
            s = self.slot.get(key)
            if s is None:
                s = self.slot[key] = len(self.first) - 1
                self.ids.extend(self._unit(raw[starts[i]:ends[i]], bool(whole[i])))
                self.first.append(len(self.ids))
            slots[k] = s
        pool, first = np.frombuffer(self.ids.tobytes(), np.uint32), np.frombuffer(self.first.tobytes(), np.int64)
        slots = slots[inv]
        size = first[slots + 1] - first[slots]
        begin = np.concatenate([[0], np.cumsum(size)])
        take = np.repeat(first[slots] - begin[:-1], size) + np.arange(begin[-1])
        return pool[take], begin[np.concatenate([[0], np.cumsum(counts)])]


def units(buf: np.ndarray, offs: np.ndarray):
    """Spans of tokenizer units, whether each is a whole chunk, the bytes with the case of
    plain units folded, and the number of units of each text."""
    low = LOWER[buf]
    lead = np.flatnonzero((low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] <= 0xBF)
                          & (low[1:] != 0x97) & (low[1:] != 0xB7))
    folded = low.copy()
    upper = lead[low[lead + 1] <= 0x9E] + 1
    folded[upper] += 0x20
    cls = _CLASSES[low]
    cls[lead] = cls[lead + 1] = 1
    special = np.flatnonzero((buf[:-1] == 0x3C) & (buf[1:] == 0x7C))          # "<|"
    cls[special] = 4
    cs, ce, cc = word_spans(buf, offs, SPACE_WORDS)
    odd = np.concatenate([[0], np.cumsum(cls == 4)])
    generic = odd[ce] > odd[cs]
    for a, b in zip(cs[generic].tolist(), ce[generic].tolist()):
        cls[a:b] = 5
        folded[a:b] = buf[a:b]
    n = len(buf)
    first = cls > 0
    if n:
        first[1:] &= (cls[1:] != cls[:-1]) | (cls[1:] == 2)
    begin = offs[:-1][offs[:-1] < n]
    first[begin] = cls[begin] > 0
    starts = np.flatnonzero(first)
    blank = np.flatnonzero(cls == 0)
    stop = np.minimum(np.append(starts[1:], n), np.append(blank, n)[np.searchsorted(blank, starts)])
    stop = np.minimum(stop, offs[np.searchsorted(offs, starts, side="right")])
    counts = np.diff(np.searchsorted(starts, offs))
    return starts, stop, cls[starts] == 5, folded, counts


PIECES = "doc_id {0}, piece int, start long, length long, ids_crc32 long, task int, local long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """Pieces of every document, with the task that made them and their rank among that
    task's pieces of equal length."""
    def run(batches):
        tok, seen = UnitTokenizer(tokenizer), np.zeros(capacity + 1, np.int64)
        task = TaskContext.get().partitionId()
        for batch in batches:
            buf, offs = flat_text(batch.column("text"))
            rows = []                                     # (row, piece, start, length, crc, rank)
            for i, j in slices(offs, SLICE):
                ids, at = tok.encode(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                for k in range(j - i):
                    own = np.append(ids[at[k]:at[k + 1]], np.uint32(end_id)).astype("<u4")
                    for p, s in enumerate(range(0, len(own), capacity)):
                        part = own[s:s + capacity]
                        rows.append((i + k, p, s, len(part), zlib.crc32(part.tobytes()), int(seen[len(part)])))
                        seen[len(part)] += 1
            cols = list(zip(*rows)) or [()] * 6
            release()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()),
                 pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64()),
                 pa.array([task] * len(rows), pa.int32()), pa.array(cols[5], pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "local"])
    return docs.select("doc_id", "text").mapInArrow(run, PIECES.format(docs.schema["doc_id"].dataType.simpleString()))


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Places for `counts` pieces of each length, as (length, first rank, ranks, first sequence,
    offset): the piece of rank r in [first, first + ranks) goes to sequence + (r - first)."""
    left = {n: c for n, c in counts.items() if c > 0}
    groups: list[list] = []                    # [bins, gap, [(length, copies in a row), ...]]
    by_gap: dict[int, list[int]] = {}          # gap -> groups
    gaps: list[int] = []                       # sorted keys of by_gap that hold groups

    def place(bins: int, gap: int, items: list) -> None:
        groups.append([bins, gap, items])
        if gap and not by_gap.get(gap):
            bisect.insort(gaps, gap)
        if gap:
            by_gap.setdefault(gap, []).append(len(groups) - 1)

    def gap_for(n: int) -> int | None:
        k = bisect.bisect_left(gaps, n)
        return gaps[k] if k < len(gaps) else None

    third = capacity // 3
    large = sorted(n for n in left if n > third)
    while large:                               # the largest with the largest that fits
        n = large[-1]
        k = bisect.bisect_right(large, capacity - n) - 1
        if k < 0:
            place(left.pop(n), capacity - n, [(n, 1)])
            large.pop()
            continue
        m = large[k]
        c = left[n] // 2 if m == n else min(left[n], left[m])
        if c == 0:                             # one piece of this length is left
            k -= 1
            place(1, capacity - n - (large[k] if k >= 0 else 0), [(n, 1)] + ([(large[k], 1)] if k >= 0 else []))
            used = [n] + ([large[k]] if k >= 0 else [])
            c = 1
        else:
            place(c, capacity - n - m, [(n, 1), (m, 1)])
            used = [n, m]
        for u in used:
            left[u] -= c
            if left[u] == 0:
                del left[u]
                large.remove(u)
    for n in sorted(left, reverse=True):       # best fit, longest first
        c = left[n]
        while c:
            gap = gap_for(n)
            if gap is None:
                per = capacity // n
                full, rest = divmod(c, per)
                if full:
                    place(full, capacity - per * n, [(n, per)])
                if rest:
                    place(1, capacity - rest * n, [(n, rest)])
                break
            g = by_gap[gap].pop()
            if not by_gap[gap]:
                gaps.remove(gap)
            bins, _, items = groups[g]
            per = gap // n
            full, rest = divmod(c, per)
            full = min(full, bins)
            rest = rest if full < bins else 0
            groups[g] = [0, 0, []]
            if full:
                place(full, gap - per * n, items + [(n, per)])
            if rest:
                place(1, gap - rest * n, items + [(n, rest)])
            if bins - full - (rest > 0):
                place(bins - full - (rest > 0), gap, items)
            c -= full * per + rest
    out, rank, sequence = [], {}, 0
    for bins, _, items in groups:
        if not bins:
            continue
        offset = 0
        for n, copies in items:
            for _ in range(copies):
                r = rank.get(n, 0)
                out.append((n, r, bins, sequence, offset))
                rank[n] = r + bins
                offset += n
        sequence += bins
    return out


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """One row per piece with its sequence and its offset there."""
    spark = docs.sparkSession
    made = written(spark, pieces(docs, tokenizer, capacity, end_id), "pieces")
    per_task = made.groupBy("length", "task").agg(F.count(F.lit(1)).alias("_c"))
    per_task = written(spark, per_task, "piece-counts")
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("_c").alias("n")).collect()}
    w = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select("length", "task", F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_before"))
    slots: dict[int, list] = {}
    for n, first, ranks, sequence, offset in plan(counts, capacity):      # bounded by the capacity
        slots.setdefault(n, []).append((first, sequence, offset))
    shared = spark.sparkContext.broadcast({n: tuple(np.array(x, np.int64) for x in zip(*v)) for n, v in slots.items()})

    def run(batches):
        table = shared.value
        for b in batches:
            length, rank = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length).tolist():
                first, s, o = table[n]
                rows = np.flatnonzero(length == n)
                k = np.searchsorted(first, rank[rows], side="right") - 1
                seq[rows], off[rows] = s[k] + rank[rows] - first[k], o[k]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(seq), pa.array(off)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    ranked = (made.join(before, ["length", "task"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("local") + F.col("_before")).alias("rank")))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, "
                                  "sequence_id long, offset long")
