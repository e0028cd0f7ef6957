r"""Chat formatting with a grammar round trip.

Conversations become training text of one template:

    conversation := "<s>" turn*
    turn         := "[INST] " TEXT " [/INST]"                  role user
                  | "[SYS] " TEXT " [/SYS]"                    role system
                  | " " TEXT "</s>"                            role assistant
                  | "[ROLE] " NAME " [/ROLE] " TEXT "</s>"     any other role

A lexer cuts rendered text into control strings and plain text, and the parser
decides every turn by its first token (no look-back, no guessing), so a text
that says a control string changes what is read back.  Such a conflict is
found, not guessed: a turn is rendered as it is, reparsed and compared with its
source, and while the two differ its content is escaped and rendered again; the
assembled segment is then reparsed as a whole.  Escaping puts one backslash
after the first character of a control string (and of one that has backslashes
there already), which the parser takes out again, so the result is reversible
for every text.

`format_chats` returns the formatted text in segments of whole turns with the
loss mask (ranges of code points of the assistants' texts as they stand there);
`read_back` parses segments and returns what they say.  A conversation is dealt
to one task and streamed there in order: a task holds one batch and one segment
whatever the conversation's size, as the digests of a conversation are
sequential.

Defined results: turns are ordered by turn (NULL first), then role, then text;
a NULL role or text is empty; a NULL conv_id is a conversation of its own;
repeated rows are turns each; an empty table has no conversations; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelens.llm.common import text_batches

LEXER = re.compile(r"</?s>|\[/?(?:INST|SYS|ROLE)\]")
CLEAR = ((re.compile(r"<(\\*/?s>)"), r"<\\\1"), (re.compile(r"\[(\\*/?(?:INST|SYS|ROLE)\])"), r"[\\\1"))
PLAIN = ((re.compile(r"<\\(\\*/?s>)"), r"<\1"), (re.compile(r"\[\\(\\*/?(?:INST|SYS|ROLE)\])"), r"[\1"))
BEGIN = "<s>"
SEGMENT = 1 << 20            # a segment ends with the turn that brings it to so many characters
FORMATTED = "conv_id long, segment int, text string, loss array<struct<start:int,end:int>>"
DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


class GrammarError(ValueError):
    """The text is no sentence of the template's grammar."""


def escape(text: str) -> str:
    for pattern, to in CLEAR:
        text = pattern.sub(to, text)
    return text


def unescape(text: str) -> str:
    for pattern, to in PLAIN:
        text = pattern.sub(to, text)
    return text


def render(role: str, text: str) -> str:
    if role == "user":
        return f"[INST] {text} [/INST]"
    if role == "system":
        return f"[SYS] {text} [/SYS]"
    if role == "assistant":
        return f" {text}</s>"
    return f"[ROLE] {role} [/ROLE] {text}</s>"


class Parser:
    """Deterministic parser of a run of turns: (role, text, start, end) of each, the text
    unescaped, start and end its place in the input."""

    def __init__(self, rendered: str):
        self.s, self.marks, self.at = rendered, LEXER.finditer(rendered), 0
        self.mark = next(self.marks, None)

    def _take(self, control: str) -> None:
        if self.mark is None or self.mark.group() != control or self.mark.start() != self.at:
            raise GrammarError(f"{control} expected at {self.at}")
        self.at = self.mark.end()
        self.mark = next(self.marks, None)

    def _body(self, before: str, after: str) -> tuple[int, int]:
        """Plain text up to the next control string, between fixed blanks."""
        end = self.mark.start() if self.mark else len(self.s)
        a, b = self.at + len(before), end - len(after)
        if b < a or self.s[self.at:a] != before or self.s[b:end] != after:
            raise GrammarError(f"blank expected near {self.at}")
        self.at = end
        return a, b

    def turns(self):
        while self.at < len(self.s):
            first = self.mark.group() if self.mark and self.mark.start() == self.at else ""
            if first in ("[INST]", "[SYS]"):
                self._take(first)
                a, b = self._body(" ", " ")
                self._take(f"[/{first[1:]}")
                role = "user" if first == "[INST]" else "system"
            elif first == "[ROLE]":
                self._take(first)
                a, b = self._body(" ", " ")
                role = unescape(self.s[a:b])
                self._take("[/ROLE]")
                a, b = self._body(" ", "")
                self._take("</s>")
            else:
                a, b = self._body(" ", "")
                self._take("</s>")
                role = "assistant"
            yield role, unescape(self.s[a:b]), a, b


def says(rendered: str, turns: list[tuple[str, str]]) -> bool:
    """Whether the parser recovers exactly these turns."""
    try:
        return [t[:2] for t in Parser(rendered).turns()] == turns
    except GrammarError:
        return False


def settled(role: str, text: str) -> str:
    """The turn rendered with as little escaping as reads back identical."""
    for name, body in ((role, text), (role, escape(text)), (escape(role), escape(text))):
        piece = render(name, body)
        if says(piece, [(role, text)]):
            return piece
    raise GrammarError(f"no escaping reads back identical: {role!r} {text!r}")


def _segment(first: bool, turns: list[tuple[str, str]], pieces: list[str]) -> tuple[str, list[dict]]:
    """A segment's text and loss mask, reparsed as a whole and compared with its source."""
    body = "".join(pieces)
    read = list(Parser(body).turns())
    if [t[:2] for t in read] != turns:
        raise GrammarError("the segment does not read back as its source")
    skip = len(BEGIN) if first else 0
    return BEGIN * first + body, [{"start": a + skip, "end": b + skip} for role, _, a, b in read if role == "assistant"]


def _formatter(limit: int):
    def run(batches):
        kinds = [pa.int64(), pa.int32(), pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]
        names = ["conv_id", "segment", "text", "loss"]
        rows: list = []
        now, segment, turns, pieces, size = None, 0, [], [], 0

        def close():
            rows.append((now[0], segment, *_segment(segment == 0, turns, pieces)))

        def out():
            table = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
            rows.clear()
            return table
        held = 0
        for batch in batches:
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if now != (conv,):
                    if now is not None:
                        close()
                        held += size
                    now, segment, turns, pieces, size = (conv,), 0, [], [], 0
                elif size >= limit:
                    close()
                    held += size
                    segment, turns, pieces, size = segment + 1, [], [], 0
                turns.append((role, text))
                pieces.append(settled(role, text))
                size += len(pieces[-1])
                if held >= limit or len(rows) >= 1000:
                    if rows:
                        yield out()
                    held = 0
        if now is not None:
            close()
        if rows:
            yield out()
    return run


def format_chats(conversations: DataFrame, segment_chars: int = SEGMENT) -> DataFrame:
    """conv_id, segment, text, loss of all conversations, ordered within the partitions."""
    text_batches(conversations.sparkSession)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn",
                                F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.select("conv_id", "role", "text").mapInArrow(_formatter(segment_chars), FORMATTED)


def _reader(batches):
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    rows: list = []
    now = None
    for batch in batches:
        for conv, segment, text, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "segment", "text", "loss"))):
            if now != (conv,):
                if now is not None:
                    rows.append((now[0], n, said.hexdigest(), chars, learnt.hexdigest(), size))
                now, n, chars, size = (conv,), 0, 0, 0
                said, learnt = hashlib.sha256(), hashlib.sha256()
                if segment or not text.startswith(BEGIN):
                    raise GrammarError(f"conversation {conv} does not begin with {BEGIN}")
            size += len(text)
            for role, body, _, _ in Parser(text[len(BEGIN):] if segment == 0 else text).turns():
                said.update(f"{role}\n{body}\n".encode())
                n += 1
            for span in loss:
                body = unescape(text[span["start"]:span["end"]])
                learnt.update(body.encode())
                chars += len(body)
        if len(rows) >= 1000:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
            rows = []
    if now is not None:
        rows.append((now[0], n, said.hexdigest(), chars, learnt.hexdigest(), size))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def read_back(formatted: DataFrame, in_order: bool = False) -> DataFrame:
    """What the segments say: turns and loss text of every conversation, as digests.
    `in_order`: the rows come from `format_chats` itself and need no dealing."""
    rows = formatted.select("conv_id", "segment", "text", "loss")
    if not in_order:
        rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    return rows.mapInArrow(_reader, DIGEST)
