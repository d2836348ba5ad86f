"""Conversations as marked text that a parser reads back turn by turn."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A turn is "### role: text</turn>\n"; a backslash takes the meaning from one of the marks' first characters.
OPEN, AFTER_ROLE, CLOSE, LINE = "### ", ": ", "</turn>", "\n"
TRAINED = "assistant"
MARKS = {"role": re.compile(r"\\([\\#<:])|### |</turn>|: "), "text": re.compile(r"\\([\\#<:])|### |</turn>")}
ENDS = {"role": AFTER_ROLE, "text": CLOSE}
# What a wider and wider escape puts a backslash before: marks, then backslashes that would be read as one of ours.
UNREAD = r"\\(?=[\\#<:]|\Z)"
WIDER = [
    {"role": re.compile(r"### |</turn>|: "), "text": re.compile(r"### |</turn>")},
    {"role": re.compile(rf"### |</turn>|: |{UNREAD}"), "text": re.compile(rf"### |</turn>|{UNREAD}")},
]


class GrammarError(ValueError):
    """Text that is not a sequence of turns."""


def field(text: str, at: int, name: str) -> tuple[str, int]:
    """The content of a field from ``at`` up to its end mark, and the place after that."""
    out = []
    for mark in MARKS[name].finditer(text, at):
        out.append(text[at : mark.start()])
        at = mark.end()
        if mark[1]:
            out.append(mark[1])
        elif mark[0] == ENDS[name]:
            return "".join(out), at
        else:
            raise GrammarError(f"{mark[0]!r} inside a {name} at {mark.start()}")
    raise GrammarError(f"a {name} does not end")


def turns(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn; reads from left to right without going back."""
    at = 0
    while at < len(text):
        if not text.startswith(OPEN, at):
            raise GrammarError(f"no turn at {at}")
        role, at = field(text, at + len(OPEN), "role")
        content, at = field(text, at, "text")
        if not text.startswith(LINE, at):
            raise GrammarError(f"no line end at {at}")
        at += len(LINE)
        yield role, content


def reads_as(text: str, wanted: list[tuple[str, str]]) -> bool:
    try:
        return list(turns(text)) == wanted
    except GrammarError:
        return False


def written(role: str, text: str) -> tuple[str, int, int]:
    """A turn that reads back as it was, and where its text begins and ends.

    It is written as it is, read, and compared; as long as it reads otherwise,
    more is escaped.  The widest escape always reads back.
    """
    for patterns in (None, *WIDER):
        a, b = (role, text) if patterns is None else (patterns[n].sub(r"\\\g<0>", x) for n, x in (("role", role), ("text", text)))
        head = f"{OPEN}{a}{AFTER_ROLE}"
        out = f"{head}{b}{CLOSE}{LINE}"
        if reads_as(out, [(role, text)]):
            return out, len(head), len(head) + len(b)
    raise GrammarError("a turn cannot be written")


def formatted(conversations: DataFrame, role: str = "role", text: str = "text") -> DataFrame:
    """Each turn with its marked text ``formatted`` in place of role and text.

    ``loss_begin`` and ``loss_end`` are the code points of it that training
    counts: the text of an assistant's turn, nothing of others.  The turns of
    a conversation one after the other are its whole text, which ``turns``
    reads back: every turn ends in a mark that escaped content cannot hold.
    Nulls are empty; other columns, repeated rows and their number stay, and
    columns called like the new ones are replaced.
    """
    made = ("formatted", "loss_begin", "loss_end")
    rest = [c for c in conversations.columns if c.lower() not in {*made, role.lower(), text.lower()}]
    content = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((role, "__role"), (text, "__text"))]
    whole = conversations.select(*[F.col(f"`{c}`") for c in rest], *content)
    numbers = [F.lit(None).cast("long").alias(c) for c in made[1:]]
    schema = whole.select(*[F.col(f"`{c}`") for c in rest], F.lit(None).cast("string").alias(made[0]), *numbers).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, begins, ends = [], [], []
            for who, said in zip(batch.column("__role").to_pylist(), batch.column("__text").to_pylist(), strict=True):
                turn, begin, end = written(who, said)
                out.append(turn)
                begins.append(begin if who == TRAINED else 0)
                ends.append(end if who == TRAINED else 0)
            columns = [pa.array(out, pa.string()), pa.array(begins, pa.int64()), pa.array(ends, pa.int64())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], *columns], names=[*rest, *made])

    return whole.mapInArrow(run, schema)


def unescaped(text: str) -> str:
    return re.sub(r"\\([\\#<:])", r"\1", text)


REPORT = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("conv_id", "formatted", "loss_begin", "loss_end")
    rows = (row for batch in batches for row in zip(*[batch.column(c).to_pylist() for c in names], strict=True))
    out: list[tuple] = []

    def batch() -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        columns = [x.split()[0] for x in REPORT.split(", ")]
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=columns)
        out.clear()
        return made

    for conv_id, parts in groupby(rows, key=itemgetter(0)):
        said, trained = hashlib.sha256(), hashlib.sha256()
        n = chars = size = 0
        for _, text, begin, end in parts:
            for role, content in turns(text):
                n += 1
                said.update(f"{role}\n{content}\n".encode())
            loss = unescaped(text[begin:end])
            chars += len(loss)
            trained.update(loss.encode())
            size += len(text)
        out.append((conv_id, n, said.hexdigest(), chars, trained.hexdigest(), size))
        if len(out) == 4096:
            yield batch()
    if out:
        yield batch()


def read_back(pieces: DataFrame) -> DataFrame:
    """What the formatted turns of each conversation read back as: one row per conv_id.

    Turns stand by ``turn`` (nulls first), then by their text.  They are read
    as a stream, so a long conversation is never held; all nulls of conv_id are
    one conversation.
    """
    order = ("conv_id", F.col("turn").asc_nulls_first(), "formatted")
    ordered = pieces.repartition("conv_id").sortWithinPartitions(*order)
    return ordered.select("conv_id", "formatted", "loss_begin", "loss_end").mapInArrow(read, REPORT)
