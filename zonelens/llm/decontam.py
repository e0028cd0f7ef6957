"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of all test items go into one suffix automaton (an item
boundary restarts at the root).  Every document is streamed through it: the
state and the matching length say, at each word, the longest run of words
ending there that occurs inside some item.  A word is *hit* when it lies in an
occurrence of a window: `window` consecutive words of an item, or the whole of
a shorter item.  `clean` cuts the hit spans out of the text and drops a
document whose share of hit words exceeds `max_coverage`.

Distribution.  The automaton is built from at most `block_words` item words
(documented bound, checked by a count); a larger benchmark is dealt into
blocks by a hash of the item, each with its own automaton, and the documents
pass through one after the other, narrow maps without a shuffle.  Before the
automaton steps, numpy drops runs of words that no item pair of neighbours
links and that are shorter than the shortest window: such a run cannot hold
an occurrence, so nothing is lost.

Defined results: a NULL or wordless text has 0 words and no hit; a NULL or
wordless item has no window; an empty benchmark hits nothing; a NULL item id
counts hits under the text `null`; repeated rows give repeated results; extra
columns are left alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelens.llm.common import ALNUM_WORDS, LOWER, flat_text, slices, word_hashes, word_spans


class SuffixAutomaton:
    """Generalised suffix automaton over integer words."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]

    def _state(self, length: int, nxt: dict[int, int], link: int) -> int:
        self.next.append(nxt)
        self.len.append(length)
        self.link.append(link)
        return len(self.len) - 1

    def _clone(self, p: int, q: int, word: int) -> int:
        c = self._state(self.len[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = c
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = c
            p = self.link[p]
        return c

    def add(self, words: list[int]) -> None:
        last = 0
        for w in words:
            q = self.next[last].get(w)
            if q is not None:                      # the prefix is known from an earlier item
                last = q if self.len[q] == self.len[last] + 1 else self._clone(last, q, w)
                continue
            cur, p = self._state(self.len[last] + 1, {}, 0), last
            while p >= 0 and w not in self.next[p]:
                self.next[p][w] = cur
                p = self.link[p]
            if p >= 0:
                q = self.next[p][w]
                self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._clone(p, q, w)
            last = cur

    def walk(self, words):
        """State and matching length after each word."""
        s, n = 0, 0
        for w in words:
            while s and w not in self.next[s]:
                s = self.link[s]
                n = self.len[s]
            t = self.next[s].get(w)
            if t is not None:
                s, n = t, n + 1
            yield s, n


class ItemMatcher:
    """The automaton plus, for each state, which windows end there."""

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int):
        self.window = window
        every = np.unique(np.concatenate([h for _, h in items])) if items else np.zeros(0, np.uint64)
        self.vocab = every
        coded = [(i, np.searchsorted(every, h)) for i, h in items]
        self.sam = SuffixAutomaton()
        for _, w in coded:
            self.sam.add(w.tolist())
        n = len(self.sam.len)
        self.home = list(range(n))                 # shallowest ancestor still `window` long
        for s in sorted(range(n), key=self.sam.len.__getitem__):
            p = self.sam.link[s]
            if p > 0 and self.sam.len[p] >= window:
                self.home[s] = self.home[p]
        self.items: dict[int, set[str]] = {}       # home state -> items with that window
        short: dict[int, list[tuple[int, str]]] = {}
        for i, w in coded:
            last = 0
            for s, m in self.sam.walk(w.tolist()):
                last = s
                if m >= window:
                    self.items.setdefault(self.home[s], set()).add(i)
            if len(w) < window:
                short.setdefault(last, []).append((len(w), i))
        # whole short items end at their own state; `below` leads from a state to the next one down
        # its suffix links that has some, so equal items are listed once, however many states follow
        self.short = {s: [(m, [i for k, i in some if k == m]) for m in sorted({k for k, _ in some}, reverse=True)]
                      for s, some in short.items()}
        self.below = [-1] * n
        for s in sorted(range(n), key=self.sam.len.__getitem__):
            p = self.sam.link[s]
            self.below[s] = s if s in self.short else self.below[p] if p >= 0 else -1
        self.least = min([window, *(len(w) for _, w in coded)], default=window)
        pairs = [w[:-1] * len(every) + w[1:] for _, w in coded if len(w) > 1]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)

    def match(self, hashes: np.ndarray):
        """(word index from, to, longest match, items) for each occurrence end of a document."""
        if not len(self.vocab) or not len(hashes):
            return
        at = np.searchsorted(self.vocab, hashes)
        at[at == len(self.vocab)] = 0
        known = self.vocab[at] == hashes
        joined = np.zeros(len(hashes) + 1, bool)   # the word goes on from the one before
        if len(self.pairs):
            key = at[:-1] * len(self.vocab) + at[1:]
            pos = np.searchsorted(self.pairs, key)
            pos[pos == len(self.pairs)] = 0
            joined[1:-1] = known[:-1] & known[1:] & (self.pairs[pos] == key)
        starts = np.flatnonzero(known & ~joined[:-1])
        ends = np.flatnonzero(known & ~joined[1:]) + 1
        long = ends - starts >= self.least
        for a, b in zip(starts[long].tolist(), ends[long].tolist()):
            for k, (s, n) in enumerate(self.sam.walk(at[a:b].tolist())):
                if n >= self.window:
                    yield a + k + 1 - self.window, a + k + 1, n, self.items.get(self.home[s], ())
                q = self.below[s]
                while q >= 0:
                    for m, some in self.short[q]:
                        if m <= n:
                            yield a + k + 1 - m, a + k + 1, n, some
                    q = self.below[self.sam.link[q]] if self.sam.link[q] >= 0 else -1


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _item_words(texts: pa.Array) -> list[np.ndarray]:
    buf, offs = flat_text(texts)
    low = LOWER[buf]
    s, e, c = word_spans(low, offs, ALNUM_WORDS)
    return np.split(word_hashes(low, s, e), np.cumsum(c)[:-1]) if len(c) else []


FIELDS = ("n_words long, n_hit long, longest long, item_ids array<string>, "
          "hit_spans array<struct<start: long, end: long>>")


def _pass(docs: DataFrame, matcher, first: bool) -> DataFrame:
    """Add (first block) or widen the result columns with one block's matches.
    `hit_spans` are byte ranges of the UTF-8 text, word start to word end."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(matcher)
    keep = [c for c in docs.columns if first or c not in ("n_words", "n_hit", "longest", "item_ids", "hit_spans")]
    kept = [f for f in docs.schema.fields if f.name in keep]

    def run(batches):
        m: ItemMatcher = shared.value
        for batch in batches:
            buf, offs = flat_text(batch.column("text"))
            rows = {k: [] for k in ("n_words", "n_hit", "longest", "item_ids", "hit_spans")}
            prior = None if first else [batch.column(k).to_pylist() for k in ("longest", "item_ids", "hit_spans")]
            base = 0
            for i, j in slices(offs):
                low, o = LOWER[buf[offs[i]:offs[j]]], offs[i:j + 1] - offs[i]
                s, e, c = word_spans(low, o, ALNUM_WORDS)
                h = word_hashes(low, s, e)
                cut = np.concatenate([[0], np.cumsum(c)])
                for k in range(j - i):
                    a, b = int(cut[k]), int(cut[k + 1])
                    found = list(m.match(h[a:b]))
                    spans = [(int(s[a + x]) - int(o[k]), int(e[a + y - 1]) - int(o[k])) for x, y in
                             merged([(x, y) for x, y, _, _ in found])] if found else []
                    longest, items = max([f[2] for f in found], default=0), {t for f in found for t in f[3]}
                    if prior:
                        longest = max(longest, prior[0][base + k])
                        items |= set(prior[1][base + k])
                        spans = spans + [(x["start"], x["end"]) for x in prior[2][base + k]]
                        spans = _word_merge(spans, s[a:b] - o[k], e[a:b] - o[k])
                    ws = s[a:b] - o[k]
                    n_hit = sum(int(np.searchsorted(ws, y)) - int(np.searchsorted(ws, x)) for x, y in spans)
                    for name, v in zip(rows, (b - a, n_hit, longest, sorted(items),
                                              [{"start": x, "end": y} for x, y in spans])):
                        rows[name].append(v)
                base += j - i
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep]
                + [pa.array(rows["n_words"], pa.int64()), pa.array(rows["n_hit"], pa.int64()),
                   pa.array(rows["longest"], pa.int64()), pa.array(rows["item_ids"], pa.list_(pa.string())),
                   pa.array(rows["hit_spans"], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=[*keep, *rows])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return docs.select(*keep, *([] if first else list(("n_words", "n_hit", "longest", "item_ids", "hit_spans")))) \
        .mapInArrow(run, f"{fields}, {FIELDS}")


def _word_merge(spans, starts, ends):
    """Union of byte spans in whole words."""
    hit = np.zeros(len(starts), bool)
    for x, y in spans:
        hit[np.searchsorted(starts, x):np.searchsorted(starts, y)] = True
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return [(int(starts[a]), int(ends[b - 1])) for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]


def match_items(docs: DataFrame, items: DataFrame, window: int = 10, block_words: int = 2_000_000) -> DataFrame:
    """`docs` (a `text` column and whatever else) plus n_words, n_hit, longest, item_ids, hit_spans.
    `items`: item_id, text."""
    items = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0     # a word has at least one character
    blocks = max(1, -(-int(size) // (2 * block_words)))
    taken = [c for c in ("n_words", "n_hit", "longest", "item_ids", "hit_spans") if c in docs.columns]
    docs = docs.drop(*taken)
    for b in range(blocks):
        part = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        rows = part.toArrow()
        words = _item_words(rows.column("text").combine_chunks().cast(pa.string()) if rows.num_rows else pa.array([], pa.string()))
        matcher = ItemMatcher([(i, h) for i, h in zip(rows.column("item_id").to_pylist(), words) if len(h)], window)
        docs = _pass(docs, matcher, b == 0)
    return docs


def clean(docs: DataFrame, items: DataFrame, window: int = 10, max_coverage: float = 0.5) -> DataFrame:
    """`docs` without their hit spans (text rewritten, white space around a cut kept on its left
    side); documents with more than `max_coverage` of their words hit are dropped.  Columns named
    like the match columns are not kept."""
    cols = [c for c in docs.columns if c not in ("n_words", "n_hit", "longest", "item_ids", "hit_spans")]
    m = match_items(docs, items, window)
    keep = F.col("n_hit") <= F.lit(max_coverage) * F.greatest(F.col("n_words"), F.lit(1))
    raw = F.col("text").cast("binary")
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform("hit_spans", lambda s: s["end"]))
    begins = F.concat(F.transform("hit_spans", lambda s: s["start"]), F.array(F.octet_length("text").cast("long")))
    parts = F.transform(F.arrays_zip(ends.alias("a"), begins.alias("b")),
                        lambda p: F.substring(raw, (p["a"] + 1).cast("int"), (p["b"] - p["a"]).cast("int")).cast("string"))
    text = F.when(F.size("hit_spans") > 0, F.array_join(parts, "")).otherwise(F.col("text"))
    return m.filter(keep).withColumn("text", text).select(*cols)
