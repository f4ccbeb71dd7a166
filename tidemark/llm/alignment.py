"""Two tokenizers over the same texts: where tokens of both end, and which ids go together.

Tokenizer A is a byte-level one of the `tokenizers` library and sees a blank and the text; B is a
`sentencepiece` one, which adds that blank itself. Tokens end at byte offsets. The offsets where tokens of both
end are found by a galloping intersection: for each end of the shorter list an exponential, then binary search
goes on in the longer one. These offsets cut the tokens into groups, whose sizes are the differences of
the ranks of successive common ends. The last A and the last B token of a group end together: a link.

Most texts are cut at blanks and line feeds where no token of either can reach across, and a worker
remembers how a chunk is aligned, so that it is encoded and intersected once while it is remembered. Chunks
whose neighbours matter are taken with their neighbours; a text whose chunks do not give back its bytes is
taken whole.

Links are counted over all texts (combined in each task, then by id pair). To look the counts up, the
frequent pairs go to every task: those above the least power of two that leaves at most `frequent` of them. Links
of the others, few each, are joined by id pair. Both ways give exact counts.

Defined cases: a null or empty text, and one whose tokens do not give back its bytes (it holds U+2581, for
example), has no tokens and no links; special tokens in a text are plain text; each row is a document, also
when ids repeat or are null; a text of any length is whole, and one text is in memory at a time; ties for the
highest count are all best; an empty table gives no row. Other columns are not looked at.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.chunks import CUT, WRITTEN
from tidemark.llm.common import text_of
from tidemark.llm.records import text_batches
from tidemark.llm.words import give_back
from tidemark.scratch import store

#: Chunks that a Python worker remembers; more are learned anew with each batch.
REMEMBERED = 150_000

#: Id pairs whose counts are sent to every task.
FREQUENT = 1_000_000

#: Rows of one partition.
PARTITION = 2**36

#: How sentencepiece writes a blank.
BLANK = "▁"

#: White space at an end or beside other white space; elsewhere every blank and line feed is a cut.
ODD_BLANKS = re.compile(r"\A\s|\s\s|\s\Z")

#: A and B tokens, the groups as text, and the links as pair codes.
Aligned = tuple[int, int, str, bytes]

NO_TOKENS: Aligned = (0, 0, "", b"")

_pairs: dict[tuple, PairEncoder] = {}


def common_ends(short: list[int], long: list[int]) -> list[tuple[int, int]]:
    """Places, in both ascending lists, of the numbers that both have."""
    found, low, size = [], 0, len(long)
    for place, end in enumerate(short):
        if low == size:
            break
        if long[low] < end:
            high, step = low + 1, 1
            while high < size and long[high] < end:
                low, step = high, 2 * step
                high += step
            low = bisect_left(long, end, low + 1, min(high, size))
        if low < size and long[low] == end:
            found.append((place, low))
            low += 1
    return found


def pair_encoder(path_a: str, path_b: str, layout: tuple[int, np.dtype], remembered: int = REMEMBERED) -> PairEncoder:
    """The encoder of this Python worker for two tokenizer files."""
    key = path_a, path_b, remembered
    if key not in _pairs:
        _pairs[key] = PairEncoder(path_a, path_b, layout, remembered)
    return _pairs[key]


class PairEncoder:
    def __init__(self, path_a: str, path_b: str, layout: tuple[int, np.dtype], remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.low_bits, self.dtype = layout
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        value = {sign: byte for byte, sign in WRITTEN.items()}
        entries = sorted((i, t) for t, i in self.a.get_vocab().items())
        self.bytes_a = [b""] * (entries[-1][0] + 1)
        for i, entry in entries:
            self.bytes_a[i] = b"".join(bytes([value[c]]) if c in value else c.encode() for c in entry)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        #: No piece goes on after a word has ended, or holds a line feed.
        self.cuts = not any(re.search(f"[^{BLANK}]{BLANK}|\n", p) for p in pieces)
        #: Marks that no piece joins to a letter, so that a word and its mark stand alone.
        letter_and = {p[i] for p in pieces for i in range(1, len(p)) if p[i] in ".," and p[i - 1].isalpha()}
        self.remembered = remembered
        self.memory: dict[str, Aligned | None] = {}
        self.marks = {}
        for mark in {".", ","} - letter_and:
            ids_a = self.a.encode(mark, add_special_tokens=False).ids
            ids_b = self.b.encode(f"a{mark}")[len(self.b.encode("a")) :]
            self.marks[mark] = self.align(ids_a, ids_b, mark.encode())

    def align(self, ids_a: list[int], ids_b: list[int], raw: bytes) -> Aligned | None:
        """None if the tokens of either do not give back the bytes."""
        of_a, of_b = self.bytes_a.__getitem__, self.bytes_b.__getitem__
        if b"".join(map(of_a, ids_a)) != raw or b"".join(map(of_b, ids_b)) != raw:
            return None
        ends_a = list(accumulate(map(len, map(of_a, ids_a))))
        ends_b = list(accumulate(map(len, map(of_b, ids_b))))
        if len(ends_a) <= len(ends_b):
            common = common_ends(ends_a, ends_b)
        else:
            common = [(a, b) for b, a in common_ends(ends_b, ends_a)]
        groups, codes, from_a, from_b, bits = [], [], 0, 0, self.low_bits
        for a, b in common:
            groups.append(",".join(map(str, ids_a[from_a : a + 1])) + "|" + ",".join(map(str, ids_b[from_b : b + 1])))
            codes.append(ids_a[a] << bits | ids_b[b])
            from_a, from_b = a + 1, b + 1
        return len(ids_a), len(ids_b), ";".join(groups), array(self.dtype.char, codes).tobytes()

    def encoded(self, chunks: list[str]) -> list[Aligned | None]:
        """Alignments of chunks on their own."""
        raw = [c if c[0] in "\n " else " " + c for c in chunks]
        all_a = self.a.encode_batch_fast(raw, add_special_tokens=False)
        all_b = self.b.encode([c[1:] if c[0] == " " else c for c in chunks], num_threads=1)
        return [
            self.align(a.ids, b[1:] if c[0] == "\n" else b, r.encode())
            for a, b, r, c in zip(all_a, all_b, raw, chunks, strict=True)
        ]

    def whole(self, text: str) -> Aligned:
        return self.encoded([" " + text])[0] or NO_TOKENS

    def learn(self, chunks: set[str]) -> dict[str, Aligned | None]:
        """Alignments of chunks that are not remembered; a word with a mark is the word and the mark."""
        marked = {c for c in chunks if c[-1] in self.marks and c[c[0] == "\n" : -1].isalpha()}
        plain = list({c[:-1] if c in marked else c for c in chunks} - self.memory.keys())
        found = dict(zip(plain, self.encoded(plain), strict=True)) if plain else {}
        for c in marked:
            word = found[c[:-1]] if c[:-1] in found else self.memory[c[:-1]]
            if word is None:
                found[c] = None
            else:
                mark = self.marks[c[-1]]
                found[c] = (word[0] + mark[0], word[1] + mark[1], f"{word[2]};{mark[2]}", word[3] + mark[3])
        return found

    def aligned(self, texts: list[str]) -> list[Aligned]:
        """Alignment of each text."""
        collecting = gc.isenabled()
        gc.disable()  # millions of small objects, no cycles
        try:
            if self.cuts:
                return self._aligned(texts)
            return [self.whole(t) if t else NO_TOKENS for t in texts]
        finally:
            if collecting:
                gc.enable()

    def _aligned(self, texts: list[str]) -> list[Aligned]:
        parts = [self.chunks(t) for t in texts]
        memory = self.memory
        every = [list(map(memory.get, chunks)) for chunks in parts]
        missing = {c for chunks, some in zip(parts, every, strict=True) if None in some for c, s in zip(chunks, some, strict=True) if s is None}
        found = self.learn(missing - memory.keys())
        if len(memory) < self.remembered:
            memory.update(found)
        out = []
        for text, chunks, some in zip(texts, parts, every, strict=True):
            if None in some:
                some = [found.get(c) if s is None else s for c, s in zip(chunks, some, strict=True)]
            if not some:
                out.append(NO_TOKENS)
            elif None in some:
                out.append(self.whole(text))
            else:
                count_a, count_b, groups, codes = zip(*some, strict=True)
                out.append((sum(count_a), sum(count_b), ";".join(groups), b"".join(codes)))
        return out

    @staticmethod
    def chunks(text: str) -> list[str]:
        """Chunks that stand alone: words, which have a blank before them, words after a line feed, which has
        none, and where that is not so, all between two cuts, with the blank."""
        if not text:
            return []
        if ODD_BLANKS.search(text):
            return [" " + p for p in CUT.split(text)]
        return text.replace("\n", " \n").split(" ")


def code_layout(path_a: str, path_b: str) -> tuple[int, np.dtype]:
    """Bits of a pair code that hold the B id, below those of the A id, and the type of codes."""
    import sentencepiece
    from tokenizers import Tokenizer

    low = (sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size() - 1).bit_length()
    high = max(Tokenizer.from_file(path_a).get_vocab().values()).bit_length()
    return low, np.dtype("<u4" if low + high <= 32 else "<u8")


ENCODED = "row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary, groups string"
ENCODED_ARROW = pa.schema(
    [
        ("row", pa.int64()),
        ("doc_id", pa.int64()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("groups_sha256", pa.string()),
        ("links", pa.binary()),
        ("groups", pa.string()),
    ]
)


def encode_partition(
    batches: Iterator[pa.RecordBatch], path_a: str, path_b: str, layout: tuple[int, np.dtype], keep: bool
) -> Iterator[pa.RecordBatch]:
    encoder = pair_encoder(path_a, path_b, layout)
    row = TaskContext.get().partitionId() * PARTITION
    for ids, texts in text_batches(batches):
        columns: list[list] = [[] for _ in ENCODED_ARROW]
        for doc, (n_a, n_b, groups, codes) in zip(ids, encoder.aligned(texts), strict=True):
            digest = hashlib.sha256(groups.encode()).hexdigest() if n_a else ""
            values = row, doc, n_a, n_b, len(codes) // layout[1].itemsize, digest, codes, groups if keep else None
            for column, value in zip(columns, values, strict=True):
                column.append(value)
            row += 1
        arrays = [pa.array(c, f.type) for c, f in zip(columns, ENCODED_ARROW, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, schema=ENCODED_ARROW)
    give_back()


def codes_of(links: pa.Array, dtype: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The codes of a column of links, and where those of each row end."""
    links = links.cast(pa.large_binary())
    offsets = np.frombuffer(links.buffers()[1], np.int64)[links.offset : links.offset + len(links) + 1]
    data = np.frombuffer(links.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data.view(dtype), (offsets[1:] - offsets[0]) // dtype.itemsize


def count_codes(batches: Iterator[pa.RecordBatch], dtype: np.dtype) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes, times = np.unique(codes_of(batch.column(0), dtype)[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int64)), pa.array(times)], names=["code", "n"])
    give_back()


class Counts:
    """Counts of the frequent pairs: codes in order, how many links hold each, whether it is its B id's best."""

    def __init__(self, rows: pa.Table, dtype: np.dtype):
        codes = rows["code"].to_numpy().astype(dtype)
        order = np.argsort(codes)
        self.codes, self.n = codes[order], rows["n"].to_numpy()[order]
        self.best = rows["best"].to_numpy()[order]


LOOKED_UP = "row long, n_best long, count_sum long, rare array<long>"


def look_up(batches: Iterator[pa.RecordBatch], counts: Counts) -> Iterator[pa.RecordBatch]:
    """Per row the sums over links of frequent pairs, and the codes of the other links."""
    for batch in batches:
        codes, ends = codes_of(batch.column(1), counts.codes.dtype)
        place = np.searchsorted(counts.codes, codes)
        known = np.zeros(len(codes), bool)
        inside = place < len(counts.codes)
        known[inside] = counts.codes[place[inside]] == codes[inside]
        sums = []
        for values in (counts.best, counts.n):
            of = np.zeros(len(codes) + 1, np.int64)
            np.cumsum(np.where(known, values[np.minimum(place, len(values) - 1)], 0) if len(values) else known, out=of[1:])
            sums.append(np.diff(of[ends], prepend=0))
        rare_before = np.concatenate([[0], np.cumsum(~known)])
        offsets = np.concatenate([[0], rare_before[ends]]).astype(np.int32)
        rare = pa.ListArray.from_arrays(pa.array(offsets), pa.array(codes[~known].astype(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sums[0]), pa.array(sums[1]), rare], names=["row", "n_best", "count_sum", "rare"]
        )
    give_back()


def count_pairs(encoded: DataFrame, layout: tuple[int, np.dtype]) -> DataFrame:
    """Every id pair of the links: code, n, and whether no other A id is linked more often with its B id."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return count_codes(batches, layout[1])

    counted = encoded.select("links").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    of_b = Window.partitionBy(F.col("code").bitwiseAND((1 << layout[0]) - 1))  # as many rows as A has ids at most
    return counted.withColumn("best", F.col("n") == F.max("n").over(of_b))


def frequent_above(pairs: DataFrame, most: int) -> int:
    """The least power of two that no more than `most` pairs reach."""
    sizes = pairs.groupBy(F.length(F.bin("n")).alias("bits")).agg(F.count("*").alias("n")).collect()
    total, above = 0, max((r.bits for r in sizes), default=0)
    for size in sorted(sizes, key=lambda r: -r.bits):
        total += size.n
        if total > most:
            break
        above = size.bits - 1
    return 1 << above


def align_tokens(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_groups: bool = False,
    frequent: int = FREQUENT,
) -> DataFrame:
    """A row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    `keep_groups` adds the column `groups`: ids as "a1,a2|b1;a3|b2,b3", three times the text's size. `n_best`
    counts the links whose pair no other A id beats for its B id; `count_sum` adds up the counts of all links."""
    layout = code_layout(path_a, path_b)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return encode_partition(batches, path_a, path_b, layout, keep_groups)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    encoded, _ = store(rows.mapInArrow(encode, ENCODED), "aligned")
    pairs, _ = store(count_pairs(encoded, layout), "pairs")
    reach = frequent_above(pairs, frequent)
    counts = Counts(pairs.where(F.col("n") >= reach).toArrow(), layout[1])
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return look_up(batches, shared.value)

    looked_up, _ = store(encoded.select("row", "links").mapInArrow(find, LOOKED_UP), "looked-up")
    rare = looked_up.select("row", F.explode("rare").alias("code")).groupBy("row", "code").agg(F.count("*").alias("times"))
    others = pairs.where(F.col("n") < reach)
    of_rare = (
        rare.join(others, "code")
        .groupBy("row")
        .agg(
            F.sum(F.col("best").cast("long") * F.col("times")).alias("rare_best"),
            F.sum(F.col("n") * F.col("times")).alias("rare_sum"),
        )
    )
    sums = looked_up.drop("rare").join(of_rare, "row", "left")

    def both(name: str, more: str):
        return (F.col(name) + F.coalesce(F.col(more), F.lit(0))).alias(name)

    return encoded.drop("links").join(sums, "row").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        F.col("n_groups").alias("n_links"),
        both("n_best", "rare_best"),
        both("count_sum", "rare_sum"),
        "groups_sha256",
        *(["groups"] if keep_groups else []),
    )
