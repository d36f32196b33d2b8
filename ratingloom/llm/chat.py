"""Chat formatting: a finite-state machine over roles and a declarative template.

A template names the control strings, the escape, and the moves of the machine. A conversation is
one row of turns; the machine walks over them, says whether the order is valid, and emits text
segments with a flag each: whether the loss counts them. Control strings inside a text are
escaped, so a conversation can be read back from its segments or from the formatted string.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm import shared


@dataclass(frozen=True)
class Template:
    """``moves`` maps a state and a role to the next state; what it lacks is out of order.

    A turn is ``start + role + after_role + text + end``. Control strings all begin with ``mark``,
    and inside roles and texts the ``escape`` is put into every mark and doubled itself.
    """

    start: str = "<|im_start|>"
    after_role: str = "\n"
    end: str = "<|im_end|>\n"
    mark: str = "<|"
    escape: str = "\\"
    loss_roles: frozenset[str] = frozenset({"assistant"})
    moves: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            "begin": {"system": "told", "user": "asked"},
            "told": {"user": "asked"},
            "asked": {"assistant": "answered"},
            "answered": {"user": "asked"},
        }
    )
    first_state: str = "begin"
    last_states: frozenset[str] = frozenset({"answered"})

    def escaped(self, text: str) -> str:
        text = text.replace(self.escape, self.escape * 2)
        return text.replace(self.mark, self.mark[0] + self.escape + self.mark[1:])

    def unescaped(self, text: str) -> str:
        return re.sub(re.escape(self.escape) + "(.)", r"\1", text, flags=re.DOTALL)

    def escaped_role(self, role: str) -> str:
        return self.escaped(role).replace(self.after_role, self.escape + "n")

    def unescaped_role(self, role: str) -> str:
        pattern = re.escape(self.escape) + "(.)"
        return re.sub(
            pattern, lambda m: self.after_role if m[1] == "n" else m[1], role, flags=re.DOTALL
        )


CHATML = Template()


def segments(template: Template, turns: list[dict]) -> tuple[list[tuple[str, bool]], bool]:
    """Segments (text, in loss) of turns in order, and whether the machine accepts the order."""
    out, state = [], template.first_state
    for turn in turns:
        role, text = turn["role"] or "", turn["text"] or ""
        state = template.moves.get(state, {}).get(role, "invalid")
        out.append(
            (template.start + template.escaped_role(role) + template.after_role, False)
        )
        out.append((template.escaped(text), role in template.loss_roles))
        out.append((template.end, False))
    return out, state in template.last_states


def read_back(template: Template, parts: list[dict]) -> tuple[list[tuple[str, str]], list[str]]:
    """Turns (role, text) from the joined string, and the unescaped texts under the loss mask."""
    whole = "".join(p["text"] for p in parts)
    turns = []
    for piece in whole.split(template.start)[1:]:
        role, _, text = piece.partition(template.after_role)
        if not text.endswith(template.end):
            raise ValueError("a turn does not end as the template says")
        turns.append(
            (
                template.unescaped_role(role),
                template.unescaped(text[: len(text) - len(template.end)]),
            )
        )
    return turns, [template.unescaped(p["text"]) for p in parts if p["loss"]]


_SEGMENTS = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))


def format_chats(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """``conv_id, valid, segments``, one row per conversation of ``turns``.

    ``turns`` has conv_id, turn, role and text; other columns are not looked at. Turns are ordered
    by turn, null first, and by role and text where turns tie; repeated rows are repeated turns. A
    null role or text is empty. Rows without conv_id are one conversation. Conversations in an
    order that the machine does not accept are formatted as well, with ``valid`` false. One
    conversation is gathered into one row, as it leaves as one; conversations never meet.
    """
    shared.ship(turns.sparkSession)
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    gathered = turns.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(
        F.array_sort(F.collect_list(turn)).alias("turns")
    )

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 256):
                part = batch.slice(low, 256)
                made = [segments(template, t) for t in part.column(1).to_pylist()]
                rows = [[{"text": t, "loss": f} for t, f in parts] for parts, _ in made]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([ok for _, ok in made], pa.bool_()),
                        pa.array(rows, _SEGMENTS),
                    ],
                    ["conv_id", "valid", "segments"],
                )

    return gathered.mapInArrow(
        emit, "conv_id long, valid boolean, segments array<struct<text string, loss boolean>>"
    )


def parse_chats(formatted: DataFrame, template: Template = CHATML) -> DataFrame:
    """``formatted`` with ``turns, loss_texts`` read back from its segments, and their length."""
    kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 256):
                part = batch.slice(low, 256)
                rows = part.column(2).to_pylist()
                read = [read_back(template, p) for p in rows]
                turns = [[{"role": r, "text": t} for r, t in turns] for turns, _ in read]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.array(turns, kind),
                        pa.array([texts for _, texts in read], pa.list_(pa.string())),
                        pa.array([sum(len(p["text"]) for p in row) for row in rows], pa.int64()),
                    ],
                    [*part.schema.names, "turns", "loss_texts", "formatted_chars"],
                )

    return formatted.select("conv_id", "valid", "segments").mapInArrow(
        parse,
        "conv_id long, valid boolean, segments array<struct<text string, loss boolean>>, "
        "turns array<struct<role string, text string>>, loss_texts array<string>, "
        "formatted_chars long",
    )


def digests(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """Per conversation, read back from its formatted form: counts and digests."""
    parsed = parse_chats(format_chats(turns, template), template)
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    loss = F.array_join("loss_texts", "")
    return parsed.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
        "valid",
    )
