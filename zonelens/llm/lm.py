"""Language-model scoring with a weighted backoff automaton.

Tokens are the blank-separated, ASCII-lower-cased words of a text and one end.
The states are the n-grams of the training text up to two words (and the start
of a text); every n-gram of three words or fewer is an arc from the state of
all its words but the last.  A state's failure arc leads to the state without
its first word, and so on down to the root, with the weight that makes each
state a distribution:

    p(w)        = (c(w) + 1/2) / (N + (V + 1) / 2)                  root
    p(w | v)    = (c(v, w) + K p(w)) / (c(v) + K)                   one word
    p(w | u, v) = (c(u, v, w) + K p(w | v)) / (c(u, v) + K)         two words

No n-gram is left out, so the arcs of a state stand for all c(.) tokens that
followed it.  Scoring is one left-to-right traversal: after a token the state is
the longest one that ends there, which training has seen (the root if it has
not seen the token); an n-gram without an arc follows the failure arcs, whose
weights are the K terms.  All positions of a block take their step at once, as
a position's state is the n-gram that ends at the one before.

Distribution.  Documents are dealt into blocks (row ranges of a file, a long
text alone).
1. Blocks count their distinct n-grams of each length, by a hash of their tokens, in
   one pass; buckets of those hashes add them up over all training documents.
2. A bucket answers every block with the totals of the keys that it sent, in
   their order and without the keys: the block knows them from its own text.
3. Each block meets its totals, which tell the states' counts and the arcs'
   counts of its positions, and is scored.
What is gathered grows with the corpus and stays in Spark (the driver gets N
and V); an n-gram that occurs everywhere sends one entry per block.
Entries travel packed, as numpy arrays.

Defined results: a NULL or empty text is one end token; without training rows
N = V = 0; a NULL id is training text (its fold is unknown) and not held out;
repeated rows count and score each; extra columns are ignored.  N-grams are
told apart by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelens.llm.common import (LOWER, SPACE_WORDS, combine_all, distinct, few_files, flat_text, input_bytes, mix, release, slices,
                                 word_hashes, word_spans, written)

_U = np.uint64
END, START = _U(0x0E0D0E0D0E0D0E0D), _U(0x5A5A5A5A5A5A5A5A)
FLUSH = 1 << 22             # n-grams held before they are combined and sent


LONG = 1 << 16               # bytes of a text that is a block of its own


def with_blocks(docs: DataFrame, columns: list[str], rows: int = 2048) -> DataFrame:
    """Some columns of `docs` plus `block`: a row range of its file, which keeps neighbours together,
    or one row where its text is long, so a block holds `rows` x LONG bytes at the very most.  Rows
    that come from no file are written to one first.  A block is a function of the row, so every
    pass (and every retry) deals alike, whatever ids and texts repeat."""
    def dealt(d: DataFrame) -> DataFrame:
        row = F.col("_metadata.row_index")
        own = F.when(F.octet_length("text") > LONG, row)
        return d.select(*columns, F.xxhash64("_metadata.file_path", F.floor(row / rows), F.coalesce(own, F.lit(-1))).alias("block"))
    try:
        if "_metadata" not in docs.columns:
            return dealt(docs)
    except Exception as e:
        if "UNRESOLVED_COLUMN" not in str(e) and "FIELD_NOT_FOUND" not in str(e):
            raise
    return dealt(written(docs.sparkSession, docs.select(*columns), "rows"))


def token_hashes(buf: np.ndarray, offs: np.ndarray):
    """Hashes of all tokens of a slice (each text's words, then END) and the texts' offsets."""
    low = LOWER[buf]
    s, e, counts = word_spans(low, offs, SPACE_WORDS)
    at = np.concatenate([[0], np.cumsum(counts + 1)])
    out = np.empty(at[-1], _U)
    last = np.zeros(at[-1], bool)
    last[at[1:] - 1] = True
    out[~last], out[last] = word_hashes(low, s, e), END
    return out, at


def before(tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The token before each one (START for a text's first)."""
    prev = np.concatenate([[START], tokens[:-1]])
    prev[at[:-1]] = START
    return prev


def planes(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes()


def unplanes(b: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _block_runs(blocks: np.ndarray):
    """(block, from, to) of runs of equal blocks."""
    cut = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1]])).tolist() + [len(blocks)]
    return [(int(blocks[a]), a, b) for a, b in zip(cut, cut[1:])]


def word_keys(tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    return tokens


def pair_keys(tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Keys of (token before, token) of every position."""
    return combine_all([before(tokens, at), tokens])


def triple_keys(tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Keys of (token before that, token before, token); a text's first token has no such run and
    gets a key that is not counted as one."""
    prev = before(tokens, at)
    return combine_all([before(prev, at), prev, tokens])


KINDS = (word_keys, pair_keys, triple_keys)


def _packed(a: np.ndarray) -> bytes:
    return len(a).to_bytes(4, "little") + pa.compress(planes(a), codec="zstd", asbytes=True)


def _unpacked(b: bytes, kind) -> np.ndarray:
    n = int.from_bytes(b[:4], "little")
    return unplanes(pa.decompress(b[4:], decompressed_size=n * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind)


def _cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted keys: buckets are ranges of the (hashed) keys."""
    edges = np.array([(b << 64) // buckets for b in range(buckets)], dtype=_U)
    return np.concatenate([np.searchsorted(keys, edges), [len(keys)]])


ENTRY = "kind int, bucket int, block long, key binary, n binary"


def _emit(held: dict, buckets: int):
    """Each block's distinct n-grams with their counts, cut by bucket."""
    rows: list = [[], [], [], [], []]
    for (block, kind), (train, other) in held.items():
        known, count = np.unique(np.concatenate(train), return_counts=True)
        keys = distinct(np.concatenate([known, *other]))
        n = np.zeros(len(keys), np.uint32)
        n[np.searchsorted(keys, known)] = count
        cut = _cuts(keys, buckets)
        for b in np.flatnonzero(np.diff(cut)).tolist():
            part = slice(cut[b], cut[b + 1])
            for col, v in zip(rows, (kind, b, block, _packed(np.diff(keys[part], prepend=_U(0))), _packed(n[part]))):
                col.append(v)
    held.clear()
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names=["kind", "bucket", "block", "key", "n"])


def _counter(buckets: int, order: int):
    """Distinct n-grams of every block with their training counts (0: held-out text only)."""
    def run(batches):
        held: dict = {}
        size = 0
        for batch in batches:
            buf, offs = flat_text(batch.column("text"))
            train = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
            blocks = batch.column("block").to_numpy()
            for block, a, b in _block_runs(blocks) if len(blocks) else []:
                for i, j in slices(offs[a:b + 1]):
                    i, j = a + i, a + j
                    tokens, at = token_hashes(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                    own = np.repeat(train[i:j], np.diff(at))
                    for kind in range(order):
                        keys = KINDS[kind](tokens, at)
                        known, other = held.setdefault((block, kind), ([np.zeros(0, _U)], []))
                        known.append(keys[own])
                        other.append(keys[~own])
                        size += len(keys)
                if size >= FLUSH:
                    yield _emit(held, buckets)
                    size = 0
                    release()
        if held:
            yield _emit(held, buckets)
        release()
    return run


TOTAL = "kind int, bucket int, block long, n binary, tokens long, words long"


def _totals(table: pa.Table) -> pa.Table:
    """Totals of one bucket's keys, returned to every block in the order of the keys it sent,
    and a summary row (block NULL): sum and number of counted keys."""
    kind, bucket = table.column("kind")[0].as_py(), table.column("bucket")[0].as_py()
    sent = [np.cumsum(_unpacked(k, _U), dtype=_U) for k in table.column("key").to_pylist()]
    keys = distinct(np.concatenate(sent))
    places = [np.searchsorted(keys, k) for k in sent]
    total = np.zeros(len(keys), np.int64)
    for at, n in zip(places, table.column("n").to_pylist()):
        total[at] += _unpacked(n, np.uint32)                       # the keys of one sender are distinct
    of: dict = {}
    for block, at in zip(table.column("block").to_pylist(), places):
        of.setdefault(block, []).append(at)
    rows = [(kind, bucket, block, _packed(total[parts[0] if len(parts) == 1 else distinct(np.concatenate(parts))].astype(_U)), None, None)
            for block, parts in of.items()]
    rows.append((kind, bucket, None, None, int(total.sum()), int((total > 0).sum())))
    del sent, keys, places, total, of
    release()
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
    return pa.table({name: pa.array(c, k) for name, c, k in zip(("kind", "bucket", "block", "n", "tokens", "words"), zip(*rows), kinds)})


class BackoffAutomaton:
    """The root, a state for every n-gram of one or two words of the training text, and one for
    the start of a text.  Blocks bring the counts of their states and arcs."""

    def __init__(self, tokens: int, distinct: int, prior: float):
        self.prior, self.total = prior, tokens + 0.5 * (distinct + 1)

    def root(self, c: np.ndarray) -> np.ndarray:
        return (c + 0.5) / self.total

    def walk(self, at: np.ndarray, counts: list[np.ndarray]) -> np.ndarray:
        """log10 probability of every token; `counts`: training counts of the n-grams of one, two
        and three words that end at each position (0: no arc, follow the failure arc)."""
        p = self.root(counts[0])
        for shorter, arcs in zip(counts, counts[1:]):
            # the state: the n-gram of one word less that ends at the position before
            state = np.concatenate([[0], shorter[:-1]])
            if shorter is counts[0]:
                state[at[:-1]] = shorter[at[1:] - 1]                 # as many starts as ends
            else:
                state[at[:-1]] = 0                                   # nothing longer than the start
                arcs = arcs.copy()
                arcs[at[:-1]] = 0
            p = (arcs + self.prior * p) / (state + self.prior)
        return np.log10(p)


def _answered(totals: pa.Table, kind: int, keys: np.ndarray, buckets: int) -> np.ndarray:
    """Counts of a block's sorted distinct keys from the buckets' answers."""
    cut = _cuts(keys, buckets)
    counts = np.zeros(len(keys), np.int64)
    mine = totals.filter(pa.compute.equal(totals.column("kind"), kind))
    for b, n in zip(mine.column("bucket").to_pylist(), mine.column("n").to_pylist()):
        counts[cut[b]:cut[b + 1]] = _unpacked(n, _U).astype(np.int64)
    return counts


def _scorer(automaton: BackoffAutomaton, buckets: int, order: int):
    def run(docs: pa.Table, totals: pa.Table) -> pa.Table:
        ids, held = docs.column("doc_id").combine_chunks(), docs.column("held_out").combine_chunks()
        cols: dict = {k: [] for k in ("n_tokens", "n_known", "base_score", "score")}
        buf, offs = flat_text(docs.column("text"))
        parts = [token_hashes(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i]) for i, j in slices(offs)]
        found: list = [[] for _ in parts]                  # counts of each slice's n-grams, one length after the other
        size = np.cumsum([0] + [len(tokens) for tokens, _ in parts])
        for kind in range(order if parts else 0):
            keys, place = np.unique(np.concatenate([KINDS[kind](*p) for p in parts]), return_inverse=True)
            counts = _answered(totals, kind, keys, buckets)[place]
            for k, out in enumerate(found):
                out.append(counts[size[k]:size[k + 1]])
            del keys, place, counts
        for (tokens, at), counts in zip(parts, found):
            c = counts[0]
            cols["n_tokens"].append(np.diff(at))
            cols["n_known"].append(np.add.reduceat((c > 0).astype(np.int64), at[:-1]))
            cols["base_score"].append(np.add.reduceat(np.log10(automaton.root(c)), at[:-1]))
            cols["score"].append(np.add.reduceat(automaton.walk(at, counts), at[:-1]))
        del parts, found
        release()
        return pa.table({"doc_id": ids, "held_out": held,
                         **{k: pa.array(np.concatenate(v) if v else [], pa.float64() if "score" in k else pa.int64())
                            for k, v in cols.items()}})
    return run


def score(docs: DataFrame, held_out, prior: float = 100.0, order: int = 3, bucket_bytes: int = 4 << 20) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every text.
    `held_out`: condition that keeps a row out of training.  `order`: words of the longest n-grams, 3 at most."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    held = F.coalesce(held_out, F.lit(False))
    dealt = with_blocks(docs, ["doc_id", "text"]).select("doc_id", "text", "block", held.alias("held_out"), (~held).alias("train"))
    buckets = int(max(8, min(1 << 20, input_bytes(docs) // bucket_bytes)))

    entries = dealt.select("text", "block", "train").mapInArrow(_counter(buckets, order), ENTRY)
    sums = entries.repartition(buckets, "kind", "bucket").groupBy("kind", "bucket").applyInArrow(_totals, TOTAL)
    sums = written(spark, few_files(sums, buckets), "totals")
    size = sums.filter("kind = 0").agg(F.sum("tokens").alias("n"), F.sum("words").alias("v")).first()
    n, v = int(size["n"] or 0), int(size["v"] or 0)
    totals = sums.filter("block is not null").select("block", "kind", "bucket", "n")
    scored = (dealt.select("block", "doc_id", "text", "held_out").groupBy("block")
              .cogroup(totals.groupBy("block"))
              .applyInArrow(_scorer(BackoffAutomaton(n, v, prior), buckets, order),
                            f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                         "base_score", "score")
