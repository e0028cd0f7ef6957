"""Secret scan with multipart credential linking.

Credentials come in parts: an access identifier, a secret and the endpoint
they open.  Strong parts stand on their own (`assign`, `access`, `hex`, the
base kinds).  Weak parts prove nothing alone: a user or client id
(`weak_id`), a random-looking token of 20 or more characters
(`weak_secret`) and a URL or host with a port (`endpoint`).  Inside a scope
(parts of one document at most `scope` characters apart, a sorted interval
join per document) a weak part is reported only when complementary parts
co-occur: a weak secret needs an identifier and an endpoint, or one of them
when it is strong; a weak identifier needs a secret (weak ones only together
with an endpoint); an endpoint needs both an identifier and a secret.

Base spans follow the contract: leftmost non-overlapping matches per kind,
failing ones dropped afterwards, never replaced.  Weak spans that touch a
base span are that span's, and are left out.

Every decision needs one text only, so the scan is a narrow map: no shuffle,
no state across rows.  Defined results: a NULL or empty text has no spans;
repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import re

import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYS = "|".join([_either_case(w) for w in ("password", "passwd", "secret", "token")] + [_either_case("api") + "_?" + _either_case("key")])
ASSIGN = re.compile(rf"""(?=[PpSsTtAa])(?:{_KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
WEAK_ID = re.compile(r"""\b(?:client_id|account_id|user(?:name)?|login)["']?\x20{0,4}[:=]\x20{0,4}["']?([A-Za-z0-9_.@-]{3,})""")
WEAK_SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{20,}")
ENDPOINT = re.compile(r"""\b(?:https?|ftp|s3|jdbc:[a-z]{2,}+|postgres|mysql|redis|amqp)://[^\s"'<>|]{4,}+|\b[a-z0-9.-]{4,253}\.[a-z]{2,6}:[0-9]{2,5}\b""")

ROLE = {"assign": "secret", "hex": "secret", "access": "id", "weak_id": "id", "weak_secret": "secret", "endpoint": "endpoint"}


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the strong parts."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


def looks_random(token: str) -> bool:
    """Three character classes and few repeats: what generated secrets look like."""
    kinds = (any(c.islower() for c in token) + any(c.isupper() for c in token) + any(c.isdigit() for c in token))
    return kinds == 3 and len(set(token)) * 2 >= min(len(token), 40)


def weak_parts(text: str) -> list[tuple[int, int, str]]:
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(1), m.end(1), "weak_id") for m in WEAK_ID.finditer(text)]
        out += [(m.start(), m.end(), "endpoint") for m in ENDPOINT.finditer(text)]
    out += [(m.start(), m.end(), "weak_secret") for m in WEAK_SECRET.finditer(text) if looks_random(m.group())]
    return out


def overlaps(spans: list[tuple[int, int]]):
    """Test for a stretch that shares a character with some span: one look-up in their disjoint runs."""
    starts, ends = [], []
    for a, b in sorted(spans):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)

    def test(start: int, end: int) -> bool:
        k = bisect.bisect_left(starts, end) - 1
        return k >= 0 and ends[k] > start
    return test


def near(spans: list[tuple[int, int]], reach: list[int], start: int, end: int, scope: int) -> bool:
    """Whether some span of a list sorted by start lies within `scope` of [start, end).
    reach[k]: the largest end among the first k + 1 spans."""
    k = bisect.bisect_right(spans, (end + scope, 1 << 62)) - 1
    return k >= 0 and reach[k] >= start - scope


def linked(base, weak, scope: int) -> list[tuple[int, int, str]]:
    """Weak parts whose complements co-occur within the scope."""
    def index(parts):
        s = sorted((a, b) for a, b, _ in parts)
        reach, top = [], -1
        for _, b in s:
            top = max(top, b)
            reach.append(top)
        return s, reach
    taken = overlaps([(a, b) for a, b, _ in base])
    weak = [p for p in weak if not taken(p[0], p[1])]
    roles = {(strong, role): index([p for p in parts if ROLE[p[2]] == role])
             for strong, parts in ((True, base), (False, weak)) for role in ("id", "secret", "endpoint")}

    def has(role, p, strong=None):
        return any(near(*roles[(s, role)], p[0], p[1], scope) for s in (True, False) if strong in (None, s))
    out = []
    for p in weak:
        role = ROLE[p[2]]
        if role == "secret":
            ok = has("id", p, True) or has("id", p) and has("endpoint", p)
        elif role == "id":
            ok = has("secret", p, True) or has("secret", p) and has("endpoint", p)
        else:
            ok = has("id", p) and has("secret", p)
        if ok:
            out.append(p)
    return out


def scan(docs: DataFrame, scope: int = 200) -> DataFrame:
    """doc_id and `spans`: array of (kind, start, end), code points, by start, then kind as in KINDS."""
    order = {k: i for i, k in enumerate(KINDS)}

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                if not text:
                    out.append([])
                    continue
                base = base_spans(text)
                weak = weak_parts(text)
                found = base + (linked(base, weak, scope) if weak else [])
                found.sort(key=lambda s: (s[0], order[s[2]], s[1]))
                out.append([{"kind": k, "start": a, "end": b} for a, b, k in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out, pa.list_(pa.struct(
                    [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))], names=["doc_id", "spans"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, spans array<struct<kind: string, start: long, end: long>>")
