"""Cost-balanced packing of documents into sequences of a fixed number of tokens.

Every piece of a document costs `linear * length + quadratic * length^2`, the work of the dense layers
and of attention within the piece. Documents longer than a sequence are cut into whole sequences and a
rest. In a window of documents, the rests go by descending length to the cheapest sequence with
room for them. There are just as many sequences as the window's tokens need; what fits nowhere is cut to
the room that is left, so only one sequence a window can stay short.

A window is what one task has read once it holds `window_tokens`, so nothing is shuffled or
gathered, memory is bounded by the window and the longest document, and a lost task is simply run again.
Sequence numbers are made of the partition and a number in it.

Defined cases: a null or empty text is its end id alone; each row is a document, also when
ids repeat or are null; an empty table gives no piece. Other columns are not looked at.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import REMEMBERED, encoder
from tidemark.llm.common import text_of
from tidemark.llm.records import PIECE, text_batches
from tidemark.llm.words import give_back

#: (document, start, length, sequence, offset), documents and sequences numbered in the window.
Piece = tuple[int, int, int, int, int]

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)
PIECES_ARROW = pa.schema([(c.split()[0], pa.int64()) for c in PIECES.split(", ")])

#: Sequences of one partition.
PARTITION = 2**36


def pack(lengths: list[int], capacity: int, linear: float, quadratic: float) -> tuple[list[Piece], int]:
    """Pieces of one window of documents, and the number of sequences."""
    pieces: list[Piece] = []
    rests: list[tuple[int, int, int]] = []  # negative length, document, start
    sequence = 0
    for doc, length in enumerate(lengths):
        whole = length // capacity * capacity
        for start in range(0, whole, capacity):
            pieces.append((doc, start, capacity, sequence, 0))
            sequence += 1
        if length > whole:
            rests.append((whole - length, doc, whole))
    heapq.heapify(rests)
    first, count = sequence, -(sum(r[0] for r in rests) // capacity)
    room = [capacity] * count
    costs = [(0.0, i) for i in range(count)]  # a heap; a full sequence leaves it
    while rests:
        minus, doc, start = heapq.heappop(rests)
        length = -minus
        aside = []
        while costs and room[costs[0][1]] < length:
            aside.append(heapq.heappop(costs))
        if costs:
            cost, into = heapq.heappop(costs)
        else:  # fits nowhere: fill the roomiest sequence and go on with what is left
            cost, into = max(aside, key=lambda c: room[c[1]])
            aside.remove((cost, into))
            heapq.heappush(rests, (room[into] - length, doc, start + room[into]))
            length = room[into]
        pieces.append((doc, start, length, first + into, capacity - room[into]))
        room[into] -= length
        if room[into]:
            aside.append((cost + linear * length + quadratic * length * length, into))
        for item in aside:
            heapq.heappush(costs, item)
    return pieces, first + count


def some_texts(texts: list[str], size: int) -> Iterator[list[str]]:
    """The texts in order, about `size` characters at a time; a longer text is alone or the last of its group."""
    begin = held = 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= size:
            yield texts[begin : i + 1]
            begin, held = i + 1, 0
    if begin < len(texts):
        yield texts[begin:]


def pack_partition(
    batches: Iterator[pa.RecordBatch],
    tokenizer: str,
    end_id: int,
    capacity: int,
    linear: float,
    quadratic: float,
    window_tokens: int,
    keeps_blanks: bool,
    remembered: int,
    cut_at_once: int,
) -> Iterator[pa.RecordBatch]:
    """Packs the documents of one partition, window by window."""
    encode = encoder(tokenizer, keeps_blanks, remembered)
    width = encode.dtype.itemsize
    end = np.array([end_id], encode.dtype).tobytes()
    done = TaskContext.get().partitionId() * PARTITION
    ids: list[int | None] = []
    tokens: list[bytes] = []
    held = 0

    def flush() -> pa.RecordBatch:
        nonlocal done, held
        pieces, sequences = pack([len(t) // width for t in tokens], capacity, linear, quadratic)
        rows = [
            (ids[d], s, n, piece_crc(tokens[d], s, n, encode.dtype), len(tokens[d]) // width, done + q, o)
            for d, s, n, q, o in pieces
        ]
        done += sequences
        held = 0
        ids.clear()
        tokens.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=PIECES_ARROW)

    for numbers, texts in text_batches(batches):
        ids += numbers
        for some in some_texts(texts, cut_at_once):
            tokens += [raw + end for raw in encode.encode_all(some)]
        held += sum(len(t) for t in tokens[-len(texts) :]) // width
        if held >= window_tokens:
            yield flush()
    if ids:
        yield flush()
    give_back()


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = 4096,
    linear: float = 1.0,
    quadratic: float = 1 / 4096,
    window_tokens: int = 2_000_000,
    keeps_blanks: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
    remembered: int = REMEMBERED,
    cut_at_once: int = PIECE,
) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    The last two bound a Python worker's memory and leave the result as it is: chunks whose ids it keeps, and characters
    of texts that are cut into chunks at a time, about."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return pack_partition(
            batches, tokenizer, end_id, capacity, linear, quadratic, window_tokens, keeps_blanks, remembered, cut_at_once
        )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, PIECES)


def piece_crc(raw: bytes, start: int, length: int, dtype: np.dtype) -> int:
    """CRC-32 of the ids of a piece as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.frombuffer(raw, dtype, length, start * dtype.itemsize).astype("<u4").tobytes())
