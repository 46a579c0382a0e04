"""Chat formatting by a finite-state machine over roles.

A declarative ``Template`` gives each role its opening and closing control string
and a loss flag, and the allowed role transitions. ``format_chats`` turns the
rows of each conversation, in turn order, into text segments: an opening segment,
the text, a closing segment, each with its loss flag. Control strings inside
texts are escaped reversibly: a backslash is doubled, and a control string gets a
backslash after its first character, so that no text can fake a turn.

Conversations are brought together by ``conv_id`` and sorted inside the
partition; the machine streams over the sorted rows and holds one turn at a time,
so a conversation of any length is formatted in bounded memory (all of its rows
do pass through one task: its turns are one ordered text).

Defined results: null text and null role count as empty; roles without a template
entry are written with their (escaped) name; rows with equal turn numbers follow
by role, then text; repeated rows are separate turns; a null conv_id is a
conversation of its own; an invalid order is formatted all the same and flagged
(``turn_ok`` false on the offending turn); an empty table gives empty tables;
columns other than the four of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


@dataclass(frozen=True)
class Turn:
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Declarative format: a Turn per role, one for all other roles (their name follows
    ``other.open`` and ends with ``name_end``), and the roles that may follow each role
    ("" is the start)."""

    turns: dict[str, Turn]
    other: Turn
    name_end: str
    follows: dict[str, tuple[str, ...]]
    last: tuple[str, ...] = field(default=("assistant",))

    def controls(self) -> list[str]:
        out = {self.other.open, self.other.close, self.name_end}
        for t in self.turns.values():
            out |= {t.open, t.close}
        return sorted(out, key=lambda c: (-len(c), c))


INSTRUCT = Template(
    turns={"system": Turn("<<SYS>>", "<</SYS>>"), "user": Turn("[INST]", "[/INST]"),
           "assistant": Turn("<s>", "</s>", loss=True)},
    other=Turn("<<ROLE>>", "<</TURN>>"), name_end="<</ROLE>>",
    follows={"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
)


class Codec:
    """Escaping, formatting and parsing for one template."""

    def __init__(self, template: Template):
        self.template = template
        controls = template.controls()
        if any(len(c) < 2 or "\\" in c for c in controls):
            raise ValueError("control strings have two characters or more, no backslash")
        for c in controls:
            for close in controls:
                if any(c[i:].startswith(close) or close.startswith(c[i:]) for i in range(1, len(c))):
                    raise ValueError(f"the end of a text and {close} could read as {c}")
        self.control = re.compile("|".join(map(re.escape, controls)))
        # An escape is read over as a whole; what it covers is never a control string.
        self.token = re.compile(r"\\.|" + self.control.pattern, re.S)

    def escape(self, text: str) -> str:
        return self.control.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.S)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        turn = self.template.turns.get(role)
        if turn:
            return [(turn.open, False), (self.escape(text), turn.loss), (turn.close, False)]
        turn = self.template.other
        return [(turn.open + self.escape(role) + self.template.name_end, False), (self.escape(text), turn.loss), (turn.close, False)]

    def parse(self, text: str, at: int = 0) -> tuple[str, str, int] | None:
        """(role, text, end) of the turn that begins at ``at``; None if it isn't complete."""
        t = self.template
        for role, turn in t.turns.items():
            if text.startswith(turn.open, at):
                at += len(turn.open)
                break
        else:
            if not text.startswith(t.other.open, at):
                return None
            turn, at = t.other, at + len(t.other.open)
            end = self._find(text, t.name_end, at)
            if end < 0:
                return None
            role, at = self.unescape(text[at:end]), end + len(t.name_end)
        end = self._find(text, turn.close, at)
        return None if end < 0 else (role, self.unescape(text[at:end]), end + len(turn.close))

    def _find(self, text: str, control: str, at: int) -> int:
        return next((m.start() for m in self.token.finditer(text, at) if m[0] == control), -1)


SEGMENTS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn_no", T.LongType()), T.StructField("segment_no", T.LongType()),
    T.StructField("role", T.StringType()), T.StructField("segment", T.StringType()), T.StructField("loss", T.BooleanType()),
    T.StructField("turn_ok", T.BooleanType()), T.StructField("conv_end", T.BooleanType()),
])


def format_chats(df: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Segments of every conversation, consecutive and in order within a partition.

    ``turn_ok``: the machine allows this role here. ``conv_end``: the last segment of
    the conversation, ``turn_ok`` there also says whether it may end so."""
    codec, arrow = Codec(template), to_arrow_schema(SEGMENTS)
    ordered = (df.select(F.col("conv_id").cast("long"), F.col("turn"),
                         F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
               .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))

    def run(batches):
        now, state, turn_no, seg_no = object(), "", 0, 0
        held = None  # the last segment, until it is known whether its conversation goes on
        for batch in batches:
            rows = []
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in (0, 2, 3))):
                if conv != now:
                    if held:
                        rows.append((*held[:6], held[6] and held[3] in template.last, True))
                    now, state, turn_no, seg_no, held = conv, "", 0, 0, None
                elif held:
                    rows.append(held)
                ok = role in template.follows.get(state, ())
                parts = [(conv, turn_no, seg_no + i, role, s, loss, ok, False) for i, (s, loss) in enumerate(codec.segments(role, text))]
                rows += parts[:-1]
                held, state, turn_no, seg_no = parts[-1], role, turn_no + 1, seg_no + len(parts)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)
        if held:
            rows = [(*held[:6], held[6] and held[3] in template.last, True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return ordered.mapInArrow(run, SEGMENTS)


DIGESTS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
    T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()),
    T.StructField("formatted_chars", T.LongType()), T.StructField("order_ok", T.BooleanType()),
])


def read_back(segments: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Parse formatted segments (in ``format_chats`` order) back into turns: one digest row
    per conversation. Turns are recovered from the formatted text alone, the loss text
    from the loss flags alone."""
    codec, arrow = Codec(template), to_arrow_schema(DIGESTS)

    class Reader:
        def __init__(self, conv):
            self.conv, self.pending, self.n, self.chars, self.loss_chars, self.ok = conv, "", 0, 0, 0, True
            self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

        def feed(self, text, loss, ok):
            self.chars += len(text)
            self.ok &= ok
            self.pending += text
            if loss:
                plain = codec.unescape(text)
                self.loss_chars += len(plain)
                self.loss.update(plain.encode())
            elif self.pending and (got := codec.parse(self.pending)):
                self.turns.update(f"{got[0]}\n{got[1]}\n".encode())
                self.n, self.pending = self.n + 1, self.pending[got[2]:]

        def row(self):
            if self.pending:
                raise ValueError(f"conversation {self.conv} ends inside a turn")
            return (self.conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.ok)

    def run(batches):
        reader = None
        for batch in batches:
            rows = []
            for conv, text, loss, ok, end in zip(*(batch.column(c).to_pylist() for c in (0, 4, 5, 6, 7))):
                reader = reader or Reader(conv)
                reader.feed(text, loss, ok)
                if end:
                    rows.append(reader.row())
                    reader = None
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)
        if reader:
            raise ValueError(f"conversation {reader.conv} has no end")

    return segments.mapInArrow(run, DIGESTS)
