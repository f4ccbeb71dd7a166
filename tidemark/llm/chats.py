"""Chats formatted by a template: a finite-state machine over the roles, text with a loss mask.

`Template` declares the strings around a turn, the roles whose text is learned, and which role may
follow which. The machine's states are "start" and the roles; a turn that its state does not allow is marked
as out of order, and the machine goes on from that turn's role, so nothing is left out. Each
turn becomes segments (text, under the loss or not): head, body, tail. Control strings inside a text or
role get a backslash behind their "<", and one more where there are some, which is undone when read.

Turns are dealt by range of (chat, turn), so a chat of any length spans tasks, and each task streams its
turns in order into a file of its own. A task does not know the state in which the chat at its head was
left; it runs the machine from every state at once and writes down for which ones each turn is in order. The
manifest, a row a file, says where every machine ends, so one pass over its rows gives each
file its state and the files that carry on its last chat. Readers then stream a chat from
its files, in order, without a shuffle. Only files named in the stored manifest count, so a task that runs
twice or dies leaves nothing behind that is read.

Defined cases: a null text or role counts as empty; unknown roles may stand nowhere in order, and are
written all the same; turns with the same number follow by role, then by text (compared by their bytes), and
repeated rows are a turn each; a null turn comes first; rows with a null chat are one chat; a chat of any length
and a text of any length are whole, and a batch of turns is in memory at a time; an empty table gives
no file and no row. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import groupby, islice
from operator import itemgetter

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_of
from tidemark.llm.records import file_system
from tidemark.llm.words import give_back
from tidemark.scratch import store

START = "start"

#: Turns of a file read or written at a time, and the characters after which fewer are.
TURNS, CHARACTERS = 1024, 2_000_000

#: Characters of a text that deal turns of the same number and role to files.
TIE = 32

CONTROL = re.compile(r"<(\\*)\|")
ESCAPED = re.compile(r"<\\(\\*)\|")
IN_NAME = re.compile(r"\\(.)", re.DOTALL)


def escaped(text: str) -> str:
    return CONTROL.sub(r"<\\\1|", text)


def unescaped(text: str) -> str:
    return ESCAPED.sub(r"<\1|", text)


@dataclass(frozen=True)
class Template:
    """How a chat is written. Control strings begin with "<|"; a line feed ends the head of a turn.

    `follows` maps a state ("start" or a role) to the roles that may come next."""

    before_role: str = "<|im_start|>"
    after_text: str = "<|im_end|>\n"
    learned: frozenset[str] = frozenset({"assistant"})
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            START: ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user", "tool"),
            "tool": ("assistant", "tool"),
        }
    )

    @property
    def states(self) -> list[str]:
        """All states; the last one is that after an unknown role."""
        named = {START, *self.follows, *(r for roles in self.follows.values() for r in roles)}
        return [*sorted(named), "\0other"]

    def step(self, state: str, role: str) -> tuple[bool, str]:
        """Whether the role is in order here, and the state after it."""
        known = role in self.states[:-1] and role != START
        return role in self.follows.get(state, ()), role if known else self.states[-1]

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        name = escaped(role).replace("\\", "\\\\").replace("\n", "\\n")
        return [
            (f"{self.before_role}{name}\n", False),
            (escaped(text), role in self.learned),
            (self.after_text, False),
        ]

    def parsed(self, formatted: str) -> tuple[str, str]:
        """Role and text of a formatted turn."""
        if not (formatted.startswith(self.before_role) and formatted.endswith(self.after_text)):
            raise ValueError("not a turn of this template")
        name, text = formatted[len(self.before_role) : -len(self.after_text)].split("\n", 1)
        return unescaped(IN_NAME.sub(lambda m: "\n" if m[1] == "n" else m[1], name)), unescaped(text)


CHATML = Template()

FILE = pa.schema(
    [
        ("chat", pa.int64()),
        ("turn", pa.int64()),
        ("formatted", pa.large_string()),
        ("masked", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
        ("allowed", pa.int64()),
    ]
)
MANIFEST = "slice int, path string, turns long, first_chat long, last_chat long, ends array<int>"
MANIFEST_ARROW = pa.schema(
    [
        ("slice", pa.int32()),
        ("path", pa.string()),
        ("turns", pa.int64()),
        ("first_chat", pa.int64()),
        ("last_chat", pa.int64()),
        ("ends", pa.list_(pa.int32())),
    ]
)


class Machines:
    """The machine of a template, run from several states at once."""

    def __init__(self, template: Template):
        self.states = template.states
        self.numbers = {s: i for i, s in enumerate(self.states)}
        self.template = template
        self.known: dict[tuple[tuple[int, ...], str], tuple[int, tuple[int, ...]]] = {}
        self.all = tuple(range(len(self.states)))
        self.begin = (self.numbers[START],) * len(self.states)

    def step(self, at: tuple[int, ...], role: str) -> tuple[int, tuple[int, ...]]:
        """Bits of the first states for which the role is in order, and the states after it."""
        if role not in self.numbers:
            role = "\0other"
        if (at, role) not in self.known:
            steps = [self.template.step(self.states[s], role) for s in at]
            allowed = sum(1 << i for i, (fine, _) in enumerate(steps) if fine)
            self.known[at, role] = allowed, tuple(self.numbers[s] for _, s in steps)
        return self.known[at, role]


def turns_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for begin in range(0, len(batch), TURNS):
            yield from zip(*(c.to_pylist() for c in batch.slice(begin, TURNS).columns), strict=True)


def write_slice(batches: Iterator[pa.RecordBatch], folder: str, template: Template) -> Iterator[pa.RecordBatch]:
    """Formats the turns of a partition into a file, in order, and gives its manifest row."""
    number = TaskContext.get().partitionId()
    machines = Machines(template)
    name, writer, held, size = f"{folder}/turns-{number:06d}-{uuid.uuid4().hex}.parquet", None, [], 0
    turns, first, chat, at = 0, None, None, machines.all

    def flush() -> None:
        nonlocal writer, size
        if writer is None:
            fs, path = file_system(name)
            fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
            writer = pq.ParquetWriter(path, FILE, filesystem=fs, compression="zstd")
        arrays = [pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), FILE, strict=True)]
        writer.write_batch(pa.RecordBatch.from_arrays(arrays, schema=FILE))
        held.clear()
        size = 0

    for key, turn, role, text in turns_of(batches):
        if not turns:
            first = chat = key
        elif key != chat:
            chat, at = key, machines.begin
        allowed, at = machines.step(at, role)
        parts, place, masked = template.segments(role, text), 0, []
        for part, loss in parts:
            if loss:
                masked.append({"begin": place, "end": place + len(part)})
            place += len(part)
        held.append((key, turn, "".join(p for p, _ in parts), masked, allowed))
        turns, size = turns + 1, size + place
        if len(held) >= TURNS or size >= CHARACTERS:
            flush()
    if held:
        flush()
    if writer is not None:
        writer.close()
        row = [[number], [name], [turns], [first], [chat], [list(at)]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(row, MANIFEST_ARROW.types, strict=True)], schema=MANIFEST_ARROW
        )
    give_back()


CHAIN = "files array<struct<path: string, state: int>>, carried boolean"
CHAIN_ARROW = pa.schema(
    [
        ("files", pa.list_(pa.struct([("path", pa.string()), ("state", pa.int32())]))),
        ("carried", pa.bool_()),
    ]
)


def chains(batches: Iterator[pa.RecordBatch], start: int) -> Iterator[pa.RecordBatch]:
    """From all manifest rows in order: a row for each file in which a chat begins, with the files after it that
    carry on its last chat, the state in which each file is entered, and whether its first chat began before."""
    found: list[list[dict]] = []
    carried: list[bool] = []
    before = None
    for batch in batches:
        for row in batch.to_pylist():
            goes_on = before is not None and before[0] == row["first_chat"]
            state = before[1] if goes_on else start
            file = {"path": row["path"], "state": state}
            if goes_on:
                found[-1].append(file)
            if not goes_on or row["last_chat"] != row["first_chat"]:
                found.append([file])
                carried.append(goes_on)
            before = row["last_chat"], row["ends"][state]
    if found:
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, CHAIN_ARROW.types[0]), pa.array(carried, pa.bool_())], schema=CHAIN_ARROW
        )


def format_chats(
    chats: DataFrame,
    folder: str,
    template: Template = CHATML,
    chat_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    slices: int | None = None,
) -> DataFrame:
    """Writes the formatted turns into `folder` and returns the stored manifest, a row per file."""
    rows = chats.select(
        F.col(chat_col).cast("long").alias("chat"),
        F.col(turn_col).cast("long").alias("turn"),
        text_of(role_col).alias("role"),
        text_of(text_col).alias("text"),
    )
    by = ("chat", "turn", "role", F.substring("text", 1, TIE))
    dealt = rows.repartitionByRange(slices, *by) if slices else rows.repartitionByRange(*by)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return write_slice(batches, folder, template)

    ordered = dealt.sortWithinPartitions("chat", "turn", "role", "text")
    return store(ordered.mapInArrow(write, MANIFEST), "chat-manifest")[0]


def file_turns(path: str) -> Iterator[dict]:
    fs, inner = file_system(path)
    with fs.open_input_file(inner) as file:
        for batch in pq.ParquetFile(file).iter_batches(TURNS):
            yield from batch.to_pylist()


def chain_turns(files: list[dict], carried: bool) -> Iterator[dict]:
    """The turns, in order, of all chats that begin in the first file; `in_order` tells what the machine says."""
    chat = object()  # none yet
    for place, file in enumerate(files):
        for n, turn in enumerate(file_turns(file["path"])):
            if place and turn["chat"] != chat:
                return
            if not place:
                if not n:
                    chat = turn["chat"]
                carried = carried and turn["chat"] == chat
                chat = turn["chat"]
                if carried:
                    continue
            turn["in_order"] = bool(turn["allowed"] >> file["state"] & 1)
            yield turn


def per_chain(
    summary: Callable[[Iterator[dict]], Iterator[tuple]], schema: pa.Schema
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's work: rows made of the turns of each chain, TURNS at a time."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                made = summary(chain_turns(row["files"], row["carried"]))
                while some := list(islice(made, TURNS)):
                    arrays = [pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), schema, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=schema)
        give_back()

    return read


def chains_of(manifest: DataFrame, template: Template) -> DataFrame:
    """A row per chain, each for a task of its own. The manifest has a row per file, so one task orders it."""
    start = template.states.index(START)
    in_order = manifest.repartition(1).sortWithinPartitions("slice")
    found = in_order.mapInArrow(lambda batches: chains(batches, start), CHAIN)
    return store(found, "chat-chains")[0].repartition(manifest.sparkSession.sparkContext.defaultParallelism * 4, "files")


TURN_ROWS = pa.schema(
    [
        ("chat", pa.int64()),
        ("turn", pa.int64()),
        ("role", pa.string()),
        ("text", pa.string()),
        ("formatted", pa.string()),
        ("masked", FILE.field("masked").type),
        ("in_order", pa.bool_()),
    ]
)


def read_turns(manifest: DataFrame, template: Template = CHATML) -> DataFrame:
    """A row per turn from the files of a manifest: its role and text as they were, how it is written, which
    spans of that are under the loss, and whether the machine takes it in its place."""

    def rows(turns: Iterator[dict]) -> Iterator[tuple]:
        for t in turns:
            yield t["chat"], t["turn"], *template.parsed(t["formatted"]), t["formatted"], t["masked"], t["in_order"]

    ddl = (
        "chat long, turn long, role string, text string, formatted string, "
        "masked array<struct<begin: long, end: long>>, in_order boolean"
    )
    return chains_of(manifest, template).mapInArrow(per_chain(rows, TURN_ROWS), ddl)


CHAT_ROWS = pa.schema(
    [
        ("chat", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
        ("in_order", pa.bool_()),
    ]
)


def read_chats(manifest: DataFrame, template: Template = CHATML) -> DataFrame:
    """A row per chat from the files of a manifest: digests of what its turns say and of what is learned, and
    whether all its turns are in order. Hashes need a chat's turns one after another, so one task streams them."""

    def rows(turns: Iterator[dict]) -> Iterator[tuple]:
        for chat, some in groupby(turns, key=itemgetter("chat")):
            n = loss_chars = chars = 0
            in_order, said, learned = True, hashlib.sha256(), hashlib.sha256()
            for turn in some:
                formatted = turn["formatted"]
                role, text = template.parsed(formatted)
                said.update(f"{role}\n{text}\n".encode())
                for span in turn["masked"]:
                    part = unescaped(formatted[span["begin"] : span["end"]])
                    learned.update(part.encode())
                    loss_chars += len(part)
                n, chars, in_order = n + 1, chars + len(formatted), in_order and turn["in_order"]
            yield chat, n, said.hexdigest(), loss_chars, learned.hexdigest(), chars, in_order

    ddl = (
        "chat long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, in_order boolean"
    )
    return chains_of(manifest, template).mapInArrow(per_chain(rows, CHAT_ROWS), ddl)
