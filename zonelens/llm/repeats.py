"""Repeat removal with common-prefix interval trees over a sparse suffix array.

A repeat is a string of `length` bytes (default 50) that also starts in a
document with a smaller id.  Every window of `length` bytes holds an *anchor*,
the smallest hash of its 18-byte grams, chosen by content alone; equal windows
hold the same anchor at the same place.  The suffixes that start at equal
anchors are one stretch of the suffix array of the whole corpus.  So

1. parts of the documents report their anchors, buckets find those of two or more
   documents, and the parts learn which of theirs they are;
2. each such suffix is sent to its anchor's bucket, with the bytes to its right and
   left that the windows reach whose anchor it is (a window is looked for at its own
   anchor only);
3. there the suffixes are sorted (suffix array), neighbours compared (common
   prefixes), and the tree of common-prefix intervals is cut at every depth r:
   members of one interval share r bytes to the right.  They are split by their
   left extension of `length` - r bytes, found the same way from the array
   sorted leftwards, so a group is one repeated string with *all* its
   sent occurrences, not just neighbours.  All but those of the smallest document
   are covered;
4. covered stretches go back to the parts, where the bytes are cut out.

The removal needs the cuts at `length` bytes only, so the query reports no
maximal repeats.  `maximal_repeats` is the plain form of step 3 on one sorted
stretch, off the query's path: a stack scan yields every interval, and the
diversity of the bytes to the left tells which ones are maximal repeats.

Packing.  A row of an exchange holds what one part (in step 1: one task's stretch of
the input) has for one bucket, so the rows are parts times buckets.  Buckets have a
size and grow in number with the input; parts grow in size first, and in number again
only when they hold PART_MOST bytes.

Skew.  A part sends the smallest document's occurrences of each distinct
neighbourhood; the other documents' are covered without leaving it.  Anchors with
`hot_from` occurrences or more travel as window hashes instead, one entry per
distinct window and part, so even a passage that a third of all documents
share spreads over all buckets.

Defined results: a NULL or empty text has 0 bytes; texts shorter than `length`
keep all; repeats inside one document stay, as do equal rows of one id (an id
is not smaller than itself); a NULL id neither loses bytes nor covers others;
matches never cross documents; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelens.llm.common import HASHER, distinct, few_files, flat_text, input_bytes, mix, release, slices, written
from zonelens.llm.lm import _block_runs, planes, unplanes, with_blocks

_U = np.uint64
GRAM = 18
HELD = 1 << 18                # suffixes or windows of a part that are held before they are settled and packed
STEP = 1 << 13                # anchors whose neighbourhoods are cut out at a time
PLACE = 28                    # low bits that break ties by position
KEY = 5                       # low bytes of an anchor's hash that its report carries (the bucket tells the others)
LOW = _U((1 << 8 * KEY) - 1)
SLICE = 1 << 16               # bytes hashed at a time, which stay in the processor's cache
PIECE = 512                   # rows of a file that are in one part
PARTS = 1024                  # parts of PART_LEAST to PART_MOST bytes of input
PART_LEAST, PART_MOST = 4 << 20, 32 << 20
SENT = 4 << 20                # bytes of packed rows in one Arrow batch


def anchors(buf: np.ndarray, offs: np.ndarray, length: int):
    """Of each anchor of a slice: its position, its hash, the first and the last window whose anchor
    it is (such windows follow each other); and the prefix sums of the slice's bytes."""
    n, reach = len(buf), length - GRAM + 1
    prefix = HASHER.prefix(buf)
    if n < length:
        z = np.zeros(0, np.int64)
        return z, np.zeros(0, _U), z, z, prefix
    at = np.arange(n - GRAM + 1)
    h = mix((prefix[GRAM:] - prefix[:-GRAM]) * HASHER.inv[:len(at)])
    least = ((h >> _U(PLACE)) << _U(PLACE)) | at.astype(_U)
    size = 1
    while size * 2 <= reach:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < reach:
        least = np.minimum(least[:len(least) - (reach - size)], least[reach - size:])
    end = np.repeat(offs[1:], np.diff(offs))                      # end of the text at each byte
    window = np.flatnonzero(at[:len(least)] + length <= end[:len(least)])
    pick = (least[window] & _U((1 << PLACE) - 1)).astype(np.int64)
    turn = np.flatnonzero(pick[1:] != pick[:-1])
    first = np.concatenate([[0], turn + 1]) if len(pick) else turn
    last = np.append(turn, len(pick) - 1) if len(pick) else turn
    pos = pick[first]
    return pos, h[pos], window[first], window[last], prefix


def _spans(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of spans of a slice whose prefix sums `anchors` gave (by this module's HASHER: a function
    that is sent to a worker takes a copy of its own along)."""
    return HASHER.spans(prefix, starts, ends)


def _prints(prefix: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A 32-bit print of each text, which tells rows of one id apart."""
    return (_spans(prefix, offs[:-1], offs[1:]) & _U(0xFFFFFFFF)).astype(np.uint32)


def text_prints(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    return _prints(HASHER.prefix(buf), offs)


def _with_id(docs: pa.Table | pa.RecordBatch):
    """(ids, bytes, offsets) of the documents that have an id."""
    docs = docs.filter(pa.compute.is_valid(docs.column("doc_id")))
    return docs.column("doc_id").to_numpy().astype(np.int64), *flat_text(docs.column("text"))


def _dealt(to: np.ndarray, most: int) -> np.ndarray:
    """Stable order by small numbers (16 bits are sorted by counting)."""
    return np.argsort(to.astype(np.uint16) if most <= 1 << 16 else to, kind="stable")


def _by_bucket(keys: np.ndarray, buckets: int):
    """Stable order by bucket, and (bucket, from, to) in it of each bucket that has rows."""
    to = (keys >> _U(8 * KEY)) % _U(buckets)
    order = _dealt(to, buckets)
    return order, _block_runs(to[order]) if len(to) else []


def _bytes(a: np.ndarray) -> np.ndarray:
    """The bytes of each number as a row: `_bytes(a).T.tobytes()` are its planes."""
    return np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize)


def _groups(key: np.ndarray):
    """Order that sorts a key, and the start of each distinct one in it."""
    order = np.argsort(key)
    k = key[order]
    return order, np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)


# ------------------------------------------------------------------ 1. shared anchors

REPORT = "bucket int, part binary, size binary, key binary, n binary"


def _reports(length: int, buckets: int):
    """Distinct anchors of each part with their occurrences (65535: that many or more).  A row holds all
    that a stretch of the input has for one bucket: the parts, how many anchors each has, the anchors."""
    def out(held):
        key, n, part = [], [], []
        for p, found in held.items():
            h, docs = (np.concatenate([f[k] for f in found]) for k in (0, 1))
            order, first = _groups(h)
            docs = docs[order]
            several = np.minimum.reduceat(docs, first) != np.maximum.reduceat(docs, first)
            times = np.diff(np.append(first, len(h)))
            key.append(h[order[first]])
            n.append(np.where(several, np.minimum(times, 65535), 1).astype(np.uint16))
            part.append(np.full(len(first), p, np.int32))
        held.clear()
        rows = []
        if key:
            key, n, part = np.concatenate(key), np.concatenate(n), np.concatenate(part)
            order, runs = _by_bucket(key, buckets)
            key, n, part = _bytes(key[order])[:, :KEY], _bytes(n[order]), part[order]
            for b, i, j in runs:
                p = part[i:j]
                cut = np.flatnonzero(p[1:] != p[:-1]) + 1
                size = np.diff(cut, prepend=0, append=j - i).astype(np.uint32)
                rows.append((b, p[np.append(0, cut)].tobytes(), size.tobytes(), key[i:j].T.tobytes(), n[i:j].T.tobytes()))
        cols = list(zip(*rows)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])],
                                          names=["bucket", "part", "size", "key", "n"])

    def run(batches):
        held: dict = {}
        size = 0
        for batch in batches:
            parts = batch.column("part").to_numpy()
            for part, a, b in _block_runs(parts) if len(parts) else []:
                ids, buf, offs = _with_id(batch.slice(a, b - a))
                for i, j in slices(offs, SLICE):
                    own = offs[i:j + 1] - offs[i]
                    pos, h, *_ = anchors(buf[offs[i]:offs[j]], own, length)
                    if len(pos):
                        held.setdefault(part, []).append((h, ids[i:j][np.searchsorted(own, pos, side="right") - 1]))
                        size += len(pos)
            if size >= 1 << 20:
                yield out(held)
                size = 0
                release()
        yield out(held)
    return run


def _low(b: bytes) -> np.ndarray:
    part = np.frombuffer(b, np.uint8).reshape(KEY, -1)
    full = np.zeros((part.shape[1], 8), np.uint8)
    full[:, :KEY] = part.T
    return full.view(_U).ravel()


def _shared(hot_from: int, parts: int):
    """Per part: its anchors that two or more documents have; hot ones apart."""
    def run(table: pa.Table) -> pa.Table:
        cols = {c: table.column(c).to_pylist() for c in ("part", "size", "key", "n")}
        key = np.concatenate([_low(k) for k in cols["key"]])
        n = np.concatenate([unplanes(x, np.uint16) for x in cols["n"]]).astype(np.int64)
        part = np.repeat(np.frombuffer(b"".join(cols["part"]), np.int32), np.frombuffer(b"".join(cols["size"]), np.uint32))
        order, first = _groups(key)
        total = np.empty(len(key), np.int64)
        total[order] = np.repeat(np.add.reduceat(n[order], first), np.diff(np.append(first, len(key))))
        pick = np.flatnonzero(total > 1)
        to = 2 * part[pick] + (total[pick] >= hot_from)
        order = _dealt(to, 2 * parts)
        to, key = to[order], _bytes(key[pick][order])[:, :KEY]
        known = np.flatnonzero(np.bincount(part[pick], minlength=1))
        rows = [(int(p), key[i:m].T.tobytes(), key[m:j].T.tobytes())
                for p, i, m, j in zip(known, *(np.searchsorted(to, 2 * known + k).tolist() for k in (0, 1, 2)))]
        return pa.table({"part": pa.array([r[0] for r in rows], pa.int32()), "key": pa.array([r[1] for r in rows], pa.binary()),
                         "hot": pa.array([r[2] for r in rows], pa.binary())})
    return run


# ------------------------------------------------------------------ 2. suffixes and windows

ENTRY = "bucket int, kind int, part int, data binary"
FIELDS = [("key", _U), ("doc", np.int64), ("text", np.uint32), ("at", np.uint32), ("left", np.uint8), ("right", np.uint8)]


WIDTH = sum(np.dtype(t).itemsize for _, t in FIELDS)


def _pack(numbers: np.ndarray, near: np.ndarray) -> bytes:
    """Entries as one byte string: numbers byte by byte, neighbourhoods entropy-coded (text has
    few long matches but a narrow alphabet)."""
    return len(numbers).to_bytes(4, "little") + numbers.T.tobytes() + pa.compress(near.tobytes(), codec="zstd", asbytes=True)


def _unpack(rows: list[bytes], width: int) -> tuple[dict, np.ndarray]:
    """The entries of several byte strings, and how many each has."""
    n = np.array([int.from_bytes(r[:4], "little") for r in rows], np.int64)
    numbers = np.concatenate([np.frombuffer(r, np.uint8, WIDTH * k, 4).reshape(WIDTH, k) for r, k in zip(rows, n.tolist())], axis=1)
    at, out = 0, {}
    for k, t in FIELDS:
        size = np.dtype(t).itemsize
        out[k] = np.ascontiguousarray(numbers[at:at + size].T).view(t).ravel()
        at += size
    near = [pa.decompress(r[4 + WIDTH * k:], decompressed_size=k * width, codec="zstd", asbytes=True) for r, k in zip(rows, n.tolist())] if width else []
    out["near"] = np.frombuffer(b"".join(near), np.uint8).reshape(-1, width) if width else np.zeros((len(out["key"]), 0), np.uint8)
    return out, n


def _smallest(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each row: the smallest document with its key."""
    order, first = _groups(key)
    head = np.empty(len(key), np.int64)
    if len(key):
        head[order] = np.repeat(np.minimum.reduceat(doc[order], first), np.diff(np.append(first, len(key))))
    return head


def _neighbourhoods(buf: np.ndarray, place: np.ndarray, before: np.ndarray, after: np.ndarray, length: int) -> np.ndarray:
    """Bytes around the anchors at `place` without the anchors' own: `before` and `after` of them, the others 0.
    `buf` has `length` more bytes on both sides."""
    left = length - GRAM
    near = np.lib.stride_tricks.sliding_window_view(buf, left + length)[place + length - left]
    at = np.arange(left + length)
    near = near * ((at >= left - before.astype(np.int64)[:, None]) & (at < left + after.astype(np.int64)[:, None]))
    return np.delete(near, np.s_[left:left + GRAM], axis=1)       # equal keys: equal anchors


def _suffixes(length: int, buckets: int):
    """Entries of one part: suffixes at shared anchors, windows at hot ones, and what is
    covered inside the part already (kind 2)."""
    def run(docs: pa.Table, marks: pa.Table) -> pa.Table:
        plain, hot = (distinct(np.concatenate([np.zeros(0, _U), *map(_low, marks.column(c).to_pylist())])) for c in ("key", "hot"))
        parts: dict = {0: [], 1: []}
        rows: list = []
        sent: list = []
        part = docs.column("part")[0].as_py() if docs.num_rows else None
        ids, buf, offs = _with_id(docs) if docs.num_rows and len(plain) + len(hot) else (np.zeros(0, np.int64), *flat_text(pa.array([], pa.string())))
        wide = np.concatenate([np.zeros(length, np.uint8), buf, np.zeros(length, np.uint8)])

        def settle(c: dict) -> dict:
            """Record what smaller documents here cover; go on with the smallest document's rows."""
            head = _smallest(c["same"], c["doc"])
            done = c["doc"] > head
            if done.any():
                rows.extend((-1, 2, part, data) for _, data in _covers(c, done, c["left"], c["right"], np.zeros(len(done), np.int32)))
            return {k: v[~done] for k, v in c.items()}

        def pack(kind: int) -> None:
            c = settle({k: np.concatenate([f[k] for f in parts[kind]]) for k in parts[kind][0]})
            parts[kind].clear()
            order, runs = _by_bucket(c["key"], buckets)
            c = {k: v[order] for k, v in c.items()}
            numbers = np.concatenate([_bytes(c[k]) for k, _ in FIELDS], axis=1)
            near = np.zeros((len(order), 0 if kind else 2 * (length - GRAM)), np.uint8)
            for i in range(0, 0 if kind else len(near), STEP):
                own = slice(i, i + STEP)
                near[own] = _neighbourhoods(wide, c["place"][own], c["left"][own], c["right"][own], length)
            for b, i, j in runs:
                rows.append((b, kind, part, _pack(numbers[i:j], near[i:j])))
                if len(rows) % 64 == 0 and sum(len(r[3]) for r in rows) >= SENT:
                    send()

        def send() -> None:
            cols = list(zip(*rows)) or [()] * 4
            sent.append(pa.table({"bucket": pa.array(cols[0], pa.int32()), "kind": pa.array(cols[1], pa.int32()),
                                  "part": pa.array(cols[2], pa.int32()), "data": pa.array(cols[3], pa.binary())}))
            rows.clear()

        for i, j in slices(offs, SLICE):
            own, base = offs[i:j + 1] - offs[i], offs[i]
            pos, h, first, last, prefix = anchors(buf[base:offs[j]], own, length)
            if not len(pos):
                continue
            low = h & LOW
            prints = _prints(prefix, own)
            for kind, known in ((0, plain), (1, hot)):
                if not len(known):
                    continue
                k = np.searchsorted(known, low)
                k[k == len(known)] = 0
                is_known = known[k] == low
                p, a, b, key = pos[is_known], first[is_known], last[is_known], h[is_known]
                if kind:                                          # each window whose anchor is hot, with its hash as key
                    times = b - a + 1
                    p, a = np.repeat(p, times), np.repeat(a - np.cumsum(times) + times, times) + np.arange(times.sum())
                    b = a
                if not len(p):
                    continue
                same = _spans(prefix, a, b + length)
                d = np.searchsorted(own, p, side="right") - 1
                c = {"doc": ids[i:j][d], "text": prints[d], "at": (p - own[d]).astype(np.uint32),
                     "left": (p - a).astype(np.uint8), "right": (b + length - p).astype(np.uint8)}
                if kind:
                    c["key"] = c["same"] = mix(same + _U(77))
                else:
                    c |= {"key": key, "same": mix(same + key + (c["left"].astype(_U) << _U(8)) + c["right"]), "place": base + p}
                parts[kind].append(settle(c) if kind else c)
                if sum(len(f["doc"]) for f in parts[kind]) >= HELD:
                    pack(kind)
        for kind in parts:
            if parts[kind]:
                pack(kind)
        send()
        release()
        return pa.concat_tables(sent)
    return run


COVER = [("doc", np.int64), ("text", np.uint32), ("a", np.uint32), ("b", np.uint32)]


def _covers(c: dict, pick: np.ndarray, left: np.ndarray, right: np.ndarray, part: np.ndarray):
    """(part, covered stretches [at - left, at + right) of its picked rows), one stretch per anchor (stretches
    of one anchor all hold it, so their union is a stretch)."""
    part, at = part[pick], c["at"][pick].astype(np.int64)
    doc, text, a, b = c["doc"][pick], c["text"][pick], at - left[pick], at + right[pick]
    order = np.lexsort((at, text, doc, part))
    part, at, doc, text, a, b = part[order], at[order], doc[order], text[order], a[order], b[order]
    turn = (at[1:] != at[:-1]) | (text[1:] != text[:-1]) | (doc[1:] != doc[:-1]) | (part[1:] != part[:-1])
    first = np.flatnonzero(np.concatenate([[True], turn])) if len(at) else np.zeros(0, np.int64)
    cols = {"doc": doc[first], "text": text[first], "a": np.minimum.reduceat(a, first), "b": np.maximum.reduceat(b, first)} if len(first) else {}
    cols = {k: np.ascontiguousarray(cols[k], dtype=t) for k, t in COVER if cols}
    part = part[first]
    cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])).tolist() if len(part) else []
    for i, j in zip(cut, cut[1:] + [len(part)]):
        yield int(part[i]), (j - i).to_bytes(4, "little") + b"".join(planes(cols[k][i:j]) for k, _ in COVER)


def _covered(data: bytes) -> dict:
    n, at, out = int.from_bytes(data[:4], "little"), 4, {}
    for k, t in COVER:
        size = n * np.dtype(t).itemsize
        out[k] = unplanes(data[at:at + size], t)
        at += size
    return out


# ------------------------------------------------------------------ 3. interval trees

def _words(rows: np.ndarray) -> list[np.ndarray]:
    """Columns of big-endian words of byte rows, last first, as lexsort keys."""
    pad = -rows.shape[1] % 8
    rows = np.ascontiguousarray(np.pad(rows, ((0, 0), (0, pad))))
    words = rows.view(">u8").astype(_U)
    return [words[:, k] for k in range(words.shape[1] - 1, -1, -1)]


def sorted_stretch(rows: np.ndarray, size: np.ndarray, key: np.ndarray | None = None):
    """Suffix array of byte rows (zero beyond `size`) and the common prefix of each row with the
    one before it (-1 where the key changes)."""
    order = np.lexsort([size, *_words(rows)] + ([key] if key is not None else []))
    r, s = rows[order], size[order].astype(np.int64)
    common = np.zeros(len(order), np.int64)
    if len(order) > 1:
        differs = r[1:] != r[:-1]
        common[1:] = np.where(differs.any(1), differs.argmax(1), rows.shape[1])
        common[1:] = np.minimum(common[1:], np.minimum(s[1:], s[:-1]))
        if key is not None:
            common[1:][key[order][1:] != key[order][:-1]] = -1
    return order, common


def _tree_cover(c: dict, length: int):
    """Covered stretches of one bucket's suffixes, from the cuts of its interval tree."""
    left = length - GRAM
    back = np.ascontiguousarray(c["near"][:, :left][:, ::-1])
    ahead = c["near"][:, left:]
    sa, lcp = sorted_stretch(ahead, c["right"] - np.uint8(GRAM), c["key"])      # beyond the anchor itself
    la, lcs = sorted_stretch(back, c["left"])
    reach_l, reach_r = np.zeros(len(sa), np.int64), np.zeros(len(sa), np.int64)
    for r in range(GRAM, length + 1):
        ext = length - r
        node, side = np.empty(len(sa), np.int64), np.empty(len(sa), np.int64)
        node[sa] = np.cumsum(lcp < r - GRAM)
        side[la] = np.cumsum(lcs < ext)
        fits = np.flatnonzero((c["right"] >= r) & (c["left"] >= ext))
        for own in (node, side, node):                            # a repeat has company on both sides
            fits = fits[np.bincount(own[fits])[own[fits]] > 1]
        if not len(fits):
            continue
        group = node[fits] * (len(sa) + 1) + side[fits]
        head = _smallest(group, c["doc"][fits])
        hit = fits[c["doc"][fits] > head]
        reach_r[hit] = r                                          # r ascends: the largest one stays
        reach_l[hit] = np.maximum(reach_l[hit], ext)
    return reach_l, reach_r


def _trees(length: int):
    width = 2 * (length - GRAM)

    def run(table: pa.Table) -> pa.Table:
        kinds, parts, data = (table.column(x).to_pylist() for x in ("kind", "part", "data"))
        rows = [(p, d) for k, p, d in zip(kinds, parts, data) if k == 2]
        for kind in (0, 1):
            got = [(p, d) for k, p, d in zip(kinds, parts, data) if k == kind]
            if not got:
                continue
            c, n = _unpack([d for _, d in got], 0 if kind else width)
            part = np.repeat(np.array([p for p, _ in got], np.int32), n)
            if kind:
                hit, reach_l, reach_r = c["doc"] > _smallest(c["key"], c["doc"]), c["left"], c["right"]
            else:
                reach_l, reach_r = _tree_cover(c, length)
                hit = reach_r > 0
            rows.extend(_covers(c, hit, reach_l, reach_r, part))
        release()
        return pa.table({"part": pa.array([r[0] for r in rows], pa.int32()), "data": pa.array([r[1] for r in rows], pa.binary())})
    return run


def lcp_intervals(common: np.ndarray):
    """(depth, from, to) of every common-prefix interval, by a stack scan."""
    stack: list[list[int]] = []
    for i, d in enumerate([*common.tolist()[1:], 0], start=1):
        begin = i - 1
        while stack and stack[-1][0] > d:
            depth, begin = stack.pop()
            yield depth, begin, i
        if d and (not stack or stack[-1][0] < d):
            stack.append([d, begin])


def maximal_repeats(rows: np.ndarray, size: np.ndarray, before: np.ndarray, least: int):
    """(depth, members) of the intervals of at least `least` bytes whose members differ in the
    byte before them (`before`: -1 at a text's start, which differs from everything)."""
    order, common = sorted_stretch(rows, size)
    for depth, a, b in lcp_intervals(common):
        if depth >= least:
            prev = before[order[a:b]]
            if (prev < 0).any() or (prev != prev[0]).any():
                yield depth, order[a:b]


# ------------------------------------------------------------------ 4. removal

RESULT = "doc_id {0}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _removal(with_text: bool):
    def run(docs: pa.Table, cover: pa.Table) -> pa.Table:
        got = [_covered(d) for d in cover.column("data").to_pylist()]
        by: dict = {}
        if got:
            c = {k: np.concatenate([g[k] for g in got]).astype(np.int64) for k in got[0]}
            order = np.lexsort((c["a"], c["text"], c["doc"]))
            c = {k: v[order] for k, v in c.items()}
            cut = np.flatnonzero(np.concatenate([[True], (c["doc"][1:] != c["doc"][:-1]) | (c["text"][1:] != c["text"][:-1])]))
            for a, b in zip(cut.tolist(), cut.tolist()[1:] + [len(c["doc"])]):
                by[(int(c["doc"][a]), int(c["text"][a]))] = (c["a"][a:b], c["b"][a:b])
        ids = docs.column("doc_id").to_pylist()
        buf, offs = flat_text(docs.column("text"))
        prints = np.concatenate([np.zeros(0, np.uint32), *(text_prints(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i]) for i, j in slices(offs, SLICE))])
        out = []
        for k, i in enumerate(ids):
            text = buf[offs[k]:offs[k + 1]]
            spans = by.get((i, int(prints[k])))
            removed = runs = 0
            if spans is not None:
                depth = np.bincount(spans[0], minlength=len(text) + 1) - np.bincount(spans[1], minlength=len(text) + 1)
                gone = np.cumsum(depth)[:-1] > 0
                removed = int(gone.sum())
                runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                text = text[~gone]
            out.append((i, int(offs[k + 1] - offs[k]), removed, runs,
                        text.tobytes() if with_text else hashlib.sha256(text.tobytes()).hexdigest()))
        cols = list(zip(*out)) or [()] * 5
        return pa.table({"doc_id": docs.column("doc_id").combine_chunks(), "n_bytes": pa.array(cols[1], pa.int64()),
                         "n_removed": pa.array(cols[2], pa.int64()), "n_spans": pa.array(cols[3], pa.int64()),
                         "kept" if with_text else "kept_sha256": pa.array(cols[4], pa.binary() if with_text else pa.string())})
    return run


def parts_of(size: int) -> int:
    """Number of parts of an input of `size` bytes."""
    return max(32, min(PARTS, size // PART_LEAST), size // PART_MOST)


def remove_repeats(docs: DataFrame, length: int = 50, hot_from: int = 1 << 13, bucket_bytes: int = 4 << 20,
                   with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 (or `kept`, the remaining bytes) of
    every document.  `length` may be 18 to 127."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    size = input_bytes(docs)
    buckets, parts = int(max(8, min(1 << 20, size // bucket_bytes))), int(parts_of(size))
    dealt = with_blocks(docs, ["doc_id", "text"], PIECE)
    dealt = dealt.select("doc_id", "text", F.pmod("block", F.lit(parts)).cast("int").alias("part"))
    reports = dealt.mapInArrow(_reports(length, buckets), REPORT)
    marks = written(spark, few_files(reports.repartition(buckets, "bucket").groupBy("bucket")
                                     .applyInArrow(_shared(hot_from, parts), "part int, key binary, hot binary"), buckets), "anchors")
    entries = dealt.groupBy("part").cogroup(marks.groupBy("part")).applyInArrow(_suffixes(length, buckets), ENTRY)
    salted = F.when(F.col("kind") == 2, F.pmod(F.hash("part", "data"), F.lit(buckets))).otherwise(F.col("bucket"))
    cover = (entries.withColumn("bucket", salted).repartition(buckets, "bucket").groupBy("bucket")
             .applyInArrow(_trees(length), "part int, data binary"))
    schema = RESULT.format(kind) if not with_text else RESULT.format(kind).replace("kept_sha256 string", "kept binary")
    return dealt.groupBy("part").cogroup(cover.groupBy("part")).applyInArrow(_removal(with_text), schema)
