"""Token ids as length-delimited binary records, with a separate offset index.

A shard is a file of records in ascending id order. A record is

    length u64 | masked checksum of the length u32 | payload | masked checksum of the payload u32

little-endian. The checksum is CRC-32, masked by a rotation of 15 bits and an addition, so that a
checksum stored inside checksummed data does no harm. The payload is `id i64 | null flag u8 |
n_tokens u32 | bytes per id u8 | zstd frame of the ids`. Beside each shard an index holds
`offset u64 | record bytes u64 | n_tokens u64 | id i64` a record, so that a reader in random order can
seek without a scan.

Texts are dealt by range of id (and hash of the text, which splits an id that many rows repeat), one
range a shard. A task writes under a name of its own and returns a manifest row; only files named in
the stored manifest count, so a task that runs twice or dies leaves nothing behind that is read. The
first token of a shard is the sum over the shards before it, from the manifest: a row a shard.

Defined cases: a null or empty text is a record with the end id alone; a null id comes first; rows that
repeat an id are a record each; an empty table writes no record. Texts are never cut. Other columns are
not looked at.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.chunks import encoder
from tidemark.llm.common import NULL_ID, text_of
from tidemark.scratch import scratch_path, store

HEAD = struct.Struct("<QI")
TAIL = struct.Struct("<I")
PAYLOAD = struct.Struct("<qBIB")
INDEX = struct.Struct("<QQQq")

#: Chunks that a writing task remembers: writing runs alone, and byte-level ids cost more to find.
REMEMBERED = 600_000

#: Text encoded at a time in a task.
PIECE = 4_000_000

MANIFEST = "shard int, path string, index_path string, records long, tokens long"
READ = "doc_id long, start long, n_tokens long, ids binary"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return size + TAIL.pack(masked(size)) + payload + TAIL.pack(masked(payload))


def unframe(data: bytes | memoryview, at: int) -> tuple[memoryview, int]:
    """The payload of the record at an offset, and the next offset."""
    data = memoryview(data)
    size, check = HEAD.unpack_from(data, at)
    if masked(data[at : at + 8]) != check:
        raise ValueError(f"length of the record at {at} is damaged")
    begin, end = at + HEAD.size, at + HEAD.size + size
    if masked(data[begin:end]) != TAIL.unpack_from(data, end)[0]:
        raise ValueError(f"record at {at} is damaged")
    return data[begin:end], end + TAIL.size


def file_system(path: str) -> tuple[pa.fs.FileSystem, str]:
    if urlsplit(path).scheme:
        return pa.fs.FileSystem.from_uri(path)
    return pa.fs.LocalFileSystem(), path


def text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts, about PIECE characters at a time."""
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        begin = size = 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= PIECE:
                yield ids[begin : i + 1], texts[begin : i + 1]
                begin, size = i + 1, 0
        if begin < len(ids):
            yield ids[begin:], texts[begin:]


MANIFEST_ARROW = pa.schema(
    [("shard", pa.int32()), ("path", pa.string()), ("index_path", pa.string()), ("records", pa.int64()), ("tokens", pa.int64())]
)
READ_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
)


def write_shard(
    batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, end_id: int | None, keeps_blanks: bool
) -> Iterator[pa.RecordBatch]:
    """Writes the rows of one partition as a shard and gives its manifest row."""
    shard = TaskContext.get().partitionId()
    name = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}"
    encode = encoder(tokenizer, keeps_blanks, REMEMBERED)
    end = b"" if end_id is None else np.array([end_id], encode.dtype).tobytes()
    width = encode.dtype.itemsize
    compress = zstandard.ZstdCompressor(level=1).compress
    out = index = None
    offset = records = tokens = 0
    for ids, texts in text_batches(batches):
        if out is None:
            fs, path = file_system(name)
            fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
            out, index = fs.open_output_stream(path + ".rec"), fs.open_output_stream(path + ".idx")
        for doc, raw in zip(ids, encode.encode_all(texts), strict=True):
            raw += end
            n = len(raw) // width
            number = NULL_ID if doc is None else doc
            record = frame(PAYLOAD.pack(number, doc is None, n, width) + compress(raw))
            out.write(record)
            index.write(INDEX.pack(offset, len(record), n, number))
            offset, records, tokens = offset + len(record), records + 1, tokens + n
    if out is not None:
        out.close()
        index.close()
        row = [[shard], [name + ".rec"], [name + ".idx"], [records], [tokens]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(row, MANIFEST_ARROW.types, strict=True)], schema=MANIFEST_ARROW
        )


def write_records(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int | None = None,
    keeps_blanks: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int | None = None,
) -> DataFrame:
    """Writes the shards and returns their stored manifest; `start` is a shard's first token."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    by = (F.col("id"), F.xxhash64("text"))
    rows = rows.repartitionByRange(shards, *by) if shards else rows.repartitionByRange(*by)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return write_shard(batches, folder, tokenizer, end_id, keeps_blanks)

    ordered = rows.sortWithinPartitions(*by)
    manifest, _ = store(ordered.mapInArrow(write, MANIFEST), "manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    return store(placed, "manifest")[0]


def read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of the shards named in manifest rows."""
    for batch in batches:
        for row in batch.to_pylist():
            fs, path = file_system(row["path"])
            _, index_path = file_system(row["index_path"])
            with fs.open_input_stream(index_path) as index:
                entries = list(INDEX.iter_unpack(index.read()))
            unpack = zstandard.ZstdDecompressor().decompress
            start = row["start"]
            with fs.open_input_file(path) as file:
                for group in grouped(entries):
                    data = file.read(sum(e[1] for e in group))
                    at, columns = 0, ([], [], [], [])
                    for _ in group:
                        payload, at = unframe(data, at)
                        number, is_null, n, width = PAYLOAD.unpack_from(payload)
                        ids = np.frombuffer(unpack(payload[PAYLOAD.size :]), f"<u{width}")
                        values = (None if is_null else number, start, n, ids.astype("<u4").tobytes())
                        for column, value in zip(columns, values, strict=True):
                            column.append(value)
                        start += n
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, READ_ARROW.types, strict=True)], schema=READ_ARROW
                    )


def read_records(manifest: DataFrame) -> DataFrame:
    """The records of the shards in a manifest: doc_id, start (ids before it), n_tokens, ids (binary,
    little-endian unsigned 32-bit). Every checksum is verified; shards are read in parallel."""
    spread = manifest.select("path", "index_path", "start").repartition(
        manifest.sparkSession.sparkContext.defaultParallelism * 4, "path"
    )
    return spread.mapInArrow(read_shards, READ)


def grouped(entries: list[tuple], tokens: int = 1_000_000) -> Iterator[list[tuple]]:
    """Runs of index entries with about so many tokens."""
    group, size = [], 0
    for entry in entries:
        group.append(entry)
        size += entry[2]
        if size >= tokens:
            yield group
            group, size = [], 0
    if group:
        yield group


def read_at(path: str, offset: int, size: int) -> tuple[int | None, np.ndarray]:
    """One record by its index entry, for readers in random order: id and token ids."""
    fs, inner = file_system(path)
    with fs.open_input_file(inner) as file:
        file.seek(offset)
        payload, _ = unframe(file.read(size), 0)
    number, is_null, _, width = PAYLOAD.unpack_from(payload)
    ids = zstandard.ZstdDecompressor().decompress(payload[PAYLOAD.size :])
    return None if is_null else number, np.frombuffer(ids, f"<u{width}")


def records_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "records")

