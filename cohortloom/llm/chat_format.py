"""Chat formatting with a grammar round trip (operator 2).

Grammar of one turn, all of it deterministic:

    turn   = "### " ROLE ": " BODY "</turn>" "\\n"
    ROLE   = any text without an open ":" or line end;  BODY = any text without an open control string
    escape = "\\\\" before "###", "</turn>", "\\\\" (and, in a role, before ":" or a line end)

Rendering starts without any escape. The rendered turn is parsed again; if what is recovered differs
from the source, the next level escapes the control strings, and the last one every backslash as
well, until both are identical. A turn ends in the parser's start state, so turns that round-trip
one by one also round-trip when they are put together. A conversation is read back from its own text: its turns are put
together, the parser finds where each begins and ends, and the spans of what an assistant says must be those of the loss mask.
That happens some READ_CHARS at a time, so a conversation of many turns is never in memory as a whole.

Defined results: a null text or role is empty; a null conv_id is a conversation of its own; turns are
ordered by (turn, role, text), nulls first, so ties and repeated rows are all kept, in that order; a very long text is one
turn; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

_CONTROL = re.compile(r"###|</turn>")
_MARK = re.compile(r"\\(?:\\|###|</turn>)|###|</turn>")
_ROLE_MARK = re.compile(r"\\[\\:\n]|[:\n]")
LEVELS = (0, 1, 2)
#: Characters of a conversation that are put together before they are read.
READ_CHARS = 1 << 20


def escape(text: str, level: int) -> str:
    if level > 1:
        text = text.replace("\\", "\\\\")
    return _CONTROL.sub(lambda m: "\\" + m[0], text) if level else text


def render_turn(role: str, text: str, level: int) -> tuple[str, int, int]:
    """(chunk, start, end): the chunk and the span of its body."""
    shown = re.sub(r"[\\:\n]", lambda m: "\\" + m[0], role)
    head = f"### {shown[:1].upper() + shown[1:] if shown in ('system', 'user', 'assistant') else '=' + shown}: "
    body = escape(text, level)
    return f"{head}{body}</turn>\n", len(head), len(head) + len(body)


def parse_turn(chunk: str, at: int = 0) -> tuple[str, str, int, int, int]:
    """(role, text, next, start, end) of the turn that starts at `at`; ValueError if none does."""
    if not chunk.startswith("### ", at):
        raise ValueError("no turn starts here")
    p, role = at + 4, []
    while True:
        m = _ROLE_MARK.search(chunk, p)
        if not m or m[0] == "\n":
            raise ValueError("the role does not end")
        role.append(chunk[p : m.start()])
        p = m.end()
        if m[0] == ":":
            break
        role.append(m[0][1:])
    name = "".join(role)
    if name in ("System", "User", "Assistant"):
        name = name.lower()
    elif name.startswith("="):
        name = name[1:]
    else:
        raise ValueError("unknown role")
    if not chunk.startswith(" ", p):
        raise ValueError("no space after the role")
    p += 1
    start, text = p, []
    while True:
        m = _MARK.search(chunk, p)
        if not m or m[0] == "###":
            raise ValueError("the body does not end")
        text.append(chunk[p : m.start()])
        p = m.end()
        if m[0] == "</turn>":
            break
        text.append(m[0][1:])
    if not chunk.startswith("\n", p):
        raise ValueError("no line end after the turn")
    return name, "".join(text), p + 1, start, m.start()


def parse_conversation(text: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start, end) of every turn of a rendered conversation; start and end span its body."""
    at = 0
    while at < len(text):
        role, body, at, start, end = parse_turn(text, at)
        yield role, body, start, end


def round_trip(role: str, text: str) -> tuple[str, int, int, int]:
    """(chunk, start, end, level): the first level whose parse equals the source."""
    for level in LEVELS:
        chunk, start, end = render_turn(role, text, level)
        try:
            if parse_turn(chunk) == (role, text, len(chunk), start, end):
                return chunk, start, end, level
        except ValueError:
            pass
    raise AssertionError("the last level is always reversible")


def format_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn: conv_id, turn, role, source text, rendered chunk, level, and the mask.

    loss_start and loss_end (code points in the chunk) span what an assistant says; elsewhere null.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            role, text = b["role"].fillna(""), b["text"].fillna("")
            made = [round_trip(r, t) for r, t in zip(role, text)]
            out = pd.DataFrame({"conv_id": b["conv_id"].astype("Int64"), "turn": b["turn"].astype("Int64"), "role": role, "text": text, "chunk": [m[0] for m in made], "level": [m[3] for m in made]})
            spoken = [m if r == "assistant" else (None, None, None) for m, r in zip(made, role)]
            out["loss_start"] = pd.array([m[1] for m in spoken], dtype="Int64")
            out["loss_end"] = pd.array([m[2] for m in spoken], dtype="Int64")
            yield out

    return conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")).mapInPandas(run, "conv_id long, turn long, role string, text string, chunk string, level int, loss_start long, loss_end long")


class _Reader:
    """Reads one conversation from its text, which comes in parts that each end with a turn."""

    def __init__(self):
        self.n_turns = self.loss_chars = self.chars = self.level = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.waiting, self.length, self.mask = [], 0, []

    def add(self, chunk: str, start: int | None, end: int | None, level: int) -> None:
        if start is not None:
            self.mask.append((self.length + start, self.length + end))
        self.waiting.append(chunk)
        self.length += len(chunk)
        self.level = max(self.level, level)
        if self.length > READ_CHARS:
            self.read()

    def read(self) -> None:
        text, mask = "".join(self.waiting), self.mask
        spoken = []
        for role, body, start, end in parse_conversation(text):
            self.n_turns += 1
            self.turns.update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
            if role == "assistant":
                spoken.append((start, end))
                self.loss_chars += len(body)
                self.loss.update(body.encode("utf-8", "surrogatepass"))
        if spoken != mask:
            raise ValueError("the mask is not what the assistant says")
        self.chars += len(text)
        self.waiting, self.length, self.mask = [], 0, []

    def row(self, conv_id: int | None) -> tuple:
        self.read()
        return conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.level


def conversation_digests(turns: DataFrame) -> DataFrame:
    """What a reader recovers from the text of each conversation of format_turns(), one row per conversation."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, reader, done = None, None, []

        def close() -> None:
            if reader:
                done.append(reader.row(None if key[0] else key[1]))

        for b in batches:
            for missing, conv, chunk, start, end, level in zip(b["conv_id"].isna(), b["conv_id"].fillna(0).astype("int64"), b["chunk"], b["loss_start"], b["loss_end"], b["level"]):
                if key != (missing, conv):
                    close()
                    key, reader = (missing, conv), _Reader()
                masked = not pd.isna(start)
                reader.add(chunk, int(start) if masked else None, int(end) if masked else None, int(level))
            yield frame(done)
            done.clear()
        close()
        yield frame(done)

    def frame(rows: list) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "escape_level"])
        return out.astype({"conv_id": "Int64", "n_turns": "int64", "loss_chars": "int64", "formatted_chars": "int64", "escape_level": "int32"})

    ordered = turns.repartition("conv_id").sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")])
    return ordered.drop("role", "text").mapInPandas(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, escape_level int")
