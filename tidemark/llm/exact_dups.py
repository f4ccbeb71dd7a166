"""Exact duplicates by progressive refinement: length, then hash of a prefix, then hash of the whole.

Texts are equal when they are identical after lower-casing A-Z. Each level looks only at rows whose
group of the level before has a second row: lengths and prefix hashes are a few bytes a row, and
the whole text is hashed for the rows left. Groups are counted by partial aggregation, so one text
that a third of the rows share costs one row a task; the joins back to the rows are sort-merge joins
on stored tables, whose hot keys adaptive execution splits.

Keys are sent to all tasks up to BROADCAST_KEYS of them, beyond that they meet the rows by shuffle.

Defined cases: texts of any length are compared whole. A null text is the empty text, and empty texts are one group. A null id is smaller
than any other. Rows that repeat an id and its text count in the group size, and all of them that
hold the largest id are marked kept, since nothing tells them apart; `drop_exact_duplicates` leaves
one. An empty table gives an empty result. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, lower_ascii, text_of
from tidemark.scratch import store

#: Characters whose hash is the second level.
PREFIX = 128

#: Keys of up to 60 bytes that are sent to every task at most.
BROADCAST_KEYS = 1_000_000


def text_hash(text: str) -> Column:
    """SHA-256 of the normalised text in UTF-8, lower-case hex."""
    return F.sha2(F.encode(lower_ascii(text_of(text)), "UTF-8"), 256)


def duplicate_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX
) -> DataFrame:
    """Groups of two rows and more: text_sha256, keep_id, group_size, keep_rows (rows that hold
    keep_id)."""
    return groups_of(candidates(docs, id_col, text_col, prefix))


def levels(id_col: str, text_col: str, prefix: int) -> dict[str, Column]:
    """What the first two levels look at: id, length in bytes, hash of the prefix."""
    text = text_of(text_col)
    return {
        "id": F.col(id_col),
        "bytes": F.octet_length(text),
        "head": F.xxhash64(lower_ascii(F.substring(text, 1, prefix))),
    }


def candidates(docs: DataFrame, id_col: str, text_col: str, prefix: int) -> DataFrame:
    """Rows whose length and prefix another row has too: id, bytes, head, text_sha256."""
    of = levels(id_col, text_col, prefix)
    rows = docs.select(*[c.alias(n) for n, c in of.items()], F.col(text_col).alias("text"))
    small = rows.select("bytes", "head")
    lengths, _ = store(_repeated(small, "bytes"), "lengths")
    heads, _ = store(_repeated(small.join(lengths, "bytes", "left_semi"), "bytes", "head"), "heads")
    surviving = rows.join(bounded(heads), ["bytes", "head"], "left_semi")
    return surviving.select("id", "bytes", "head", text_hash("text").alias("text_sha256"))


def bounded(keys: DataFrame) -> DataFrame:
    """A stored table of keys to join with rows: sent to every task if it has few enough, so that the
    texts need not move; beyond that rows and keys meet by shuffle."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def groups_of(hashed: DataFrame) -> DataFrame:
    by_id = hashed.groupBy("text_sha256", "id").agg(F.count("*").alias("n"))
    return (
        by_id.groupBy("text_sha256")
        .agg(
            F.max("id").alias("keep_id"),
            F.sum("n").alias("group_size"),
            F.max(F.struct(F.col("id").isNotNull(), "id", "n"))["n"].alias("keep_rows"),
        )
        .where("group_size > 1")
    )


def _repeated(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").drop("n")


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256."""
    groups, _ = store(duplicate_groups(docs, id_col, text_col, prefix), "copies")
    hashed = docs.select(F.col(id_col).alias(id_col), text_hash(text_col).alias("text_sha256"))
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col(id_col)).otherwise(F.col("keep_id"))
    return hashed.join(groups, "text_sha256", "left").select(
        id_col,
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col(id_col).eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX
) -> DataFrame:
    """The documents without copies, all columns as they are: of equal texts the row with the
    largest id, and one row only where rows repeat that id.

    Only texts of surviving groups are hashed; the rows to drop are named by id, length and prefix hash,
    and by the text's hash where these three agree."""
    hashed, _ = store(candidates(docs, id_col, text_col, prefix), "hashed")
    groups, _ = store(groups_of(hashed), "copies")
    placed = hashed.join(bounded(groups), "text_sha256")
    is_kept = F.col("id").eqNullSafe(F.col("keep_id"))
    key = ["id", "bytes", "head", "text_sha256"]
    dropped, _ = store(placed.where(~is_kept | (F.col("keep_rows") > 1)).select(*key).distinct(), "dropped")
    repeated, _ = store(placed.where(is_kept & (F.col("keep_rows") > 1)).select(*key).distinct(), "repeated")

    of = levels(id_col, text_col, prefix)

    def same(keys: DataFrame) -> tuple[DataFrame, Column]:
        """The keys under names that no column has, and when a row has such a key."""
        names = {n: free_name(docs, f"copy_{n}") for n in key}
        found = bounded(keys).select(*[F.col(n).alias(name) for n, name in names.items()])
        agree = [c.eqNullSafe(F.col(names[n])) for n, c in of.items()]
        return found, reduce(and_, agree) & (text_hash(text_col) == F.col(names["text_sha256"]))

    rest, agrees = same(dropped)
    single = docs.join(rest, agrees, "left_anti")
    again, agrees = same(repeated)
    several = docs.join(again, agrees).dropDuplicates([again.columns[-1]]).select(docs.columns)
    return single.unionAll(several)
