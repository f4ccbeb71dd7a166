"""Near duplicates by b-bit MinHash: bands propose, packed low bits estimate, full sets confirm.

1. A text's set holds the 64-bit hashes of its distinct shingles of five words; texts with equal sets
   form a class, the node of all that follows. So copies cost one row a class, not their pairs.
2. 96 minima a set; bands of four minima propose candidates (at similarity 0.85 one pair in 5*10^7 meets
   in none of the 24 bands), and the lowest four bits of every minimum are packed into six words.
3. Each member of a band's bucket is compared with the smallest, so a bucket gives as many pairs as
   members. Similarity is estimated from the packed signatures by bit counts, corrected for the 1/16
   of low bits that agree by chance; pairs six deviations below the threshold go.
4. The others are confirmed on the full sets. Linked classes, and classes with rows of the same id, become
   components.
5. A bucket whose other members still lie in several components is searched in full: those outside its
   largest component are compared with each other and with those in it, block by block, on packed
   signatures and then on the sets. A link that a task finds joins the components there and then, so it returns
   no more links than it has members, and pairs that components already join are not looked at. So no link
   that the bands propose is lost that would change a component, whatever a bucket's size. Buckets are
   taken for the same, and searched once, if they agree in their number of members and in two sums over
   them, 128 bits.

Nothing is collected; hot classes and buckets are combined before the shuffle or met in sort-merge joins
on stored tables, which adaptive execution splits. Texts of candidates are shuffled once.

Defined cases: a text without words, or null, has an empty set and no link; with one to four words the
whole sequence is its only shingle. Texts of any length are whole. Rows that share an id are in one component,
whatever their texts. A null id is an id like others and counts as the smallest. A pair exactly at the threshold is
linked. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import NULL_ID, arrow_rows, free_name, text_of
from tidemark.llm.components import components
from tidemark.llm.words import give_back, mixed, runs, spread_words
from tidemark.scratch import release, store

WORDS = 5
BANDS, ROWS = 24, 4
MINIMA = BANDS * ROWS
BITS = 4
PER_LONG = 64 // BITS
LONGS = MINIMA // PER_LONG

#: Texts in an Arrow batch.
BATCH = 1_000

#: Members of a bucket that one task compares with each other.
BLOCK = 2048

_random = np.random.default_rng(20)
FACTORS = _random.integers(1, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SUMMANDS = _random.integers(0, 2**63, MINIMA, dtype=np.uint64)
ORDER = _random.integers(1, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

SIGNATURES = (
    "row struct<id: long, hash: long>, n_shingles long, set_a long, set_b long, signature array<long>, bands array<long>"
)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each text; the texts lie one after another in data."""
    hashes, first = spread_words(data, bounds)
    order = ORDER if words == WORDS else np.resize(ORDER, words)
    total = np.zeros(max(len(hashes) - words + 1, 0), np.uint64)
    for i in range(words if len(total) else 0):
        total += hashes[i : i + len(total)] * order[i]
    total = mixed(total)
    sets = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= words:
            sets.append(np.unique(total[a : b - words + 1]))
        elif b > a:
            whole = (hashes[a:b] * order[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            sets.append(mixed(np.array([whole])))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """MINIMA minima for each of some sets that are not empty."""
    values = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), MINIMA), np.uint64)
    for k in range(MINIMA):
        out[:, k] = np.minimum.reduceat(values * FACTORS[k] + SUMMANDS[k], starts)
    return out


def bands(least: np.ndarray) -> np.ndarray:
    grouped = least.reshape(len(least), BANDS, ROWS)
    total = np.zeros((len(least), BANDS), np.uint64)
    for i in range(ROWS):
        total += mixed(grouped[:, :, i]) * ORDER[i]
    return mixed(total + np.arange(BANDS, dtype=np.uint64) * ORDER[-1])


def packed(least: np.ndarray) -> np.ndarray:
    """The low bits of the minima, PER_LONG to a word."""
    low = (mixed(least) & np.uint64(2**BITS - 1)).reshape(len(least), LONGS, PER_LONG)
    shifts = np.arange(PER_LONG, dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(low << shifts, axis=2)


def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, data, bounds in runs(batch):
            sets = shingle_sets(data, bounds)
            full = [i for i, s in enumerate(sets) if len(s)]
            rows = np.zeros((len(sets), LONGS + BANDS), np.int64)
            if full:
                least = minima([sets[i] for i in full])
                rows[full] = np.hstack([packed(least), bands(least)]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([int(mixed(s).sum(dtype=np.uint64).view(np.int64)) for s in sets], pa.int64()),
                    pa.array([int(mixed(s ^ ORDER[0]).sum(dtype=np.uint64).view(np.int64)) for s in sets], pa.int64()),
                    pa.array(list(rows[:, :LONGS]), pa.list_(pa.int64())),
                    pa.array([r if len(s) else [] for r, s in zip(rows[:, LONGS:], sets, strict=True)], pa.list_(pa.int64())),
                ],
                names=["row", "n_shingles", "set_a", "set_b", "signature", "bands"],
            )
    give_back()


def agreeing(x: Column, y: Column) -> Column:
    """How many of the packed low bits agree."""
    ones = sum(1 << BITS * i for i in range(PER_LONG))
    ones -= 1 << 64 if ones >= 1 << 63 else 0
    differ = F.lit(0)
    for i in range(LONGS):
        d = x[i].bitwiseXOR(y[i])
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        differ = differ + F.bit_count(d.bitwiseAND(F.lit(ones)))
    return MINIMA - differ


def fewest_agreeing(threshold: float) -> int:
    """Six deviations below what a pair at the threshold agrees in, chance agreements included."""
    p = threshold + (1 - threshold) / 2**BITS
    return int(MINIMA * p - 6 * (MINIMA * p * (1 - p)) ** 0.5)


def similarity(agree: Column) -> Column:
    """Estimated Jaccard similarity, corrected for agreement by chance."""
    chance = 1 / 2**BITS
    return (agree / F.lit(MINIMA) - chance) / (1 - chance)


def confirm(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, text_a, text_b) whose full sets reach the threshold."""
    known: dict[str, np.ndarray] = {}
    for batch in batches:
        a, b, first, second = (batch.column(i).to_pylist() for i in range(4))
        keep = []
        for i, (x, y) in enumerate(zip(first, second, strict=True)):
            if x not in known:
                known = {x: set_of(x)}  # rows come sorted by a
            one, other = known[x], set_of(y)
            if min(len(one), len(other)) * 100 < percent * max(len(one), len(other)):
                continue
            both = common(one, other)
            if both and 100 * both >= percent * (len(one) + len(other) - both):
                keep.append(i)
        yield pa.RecordBatch.from_arrays(
            [pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())], names=["a", "b"]
        )
    give_back()


def set_of(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return shingle_sets(data, np.array([0, len(data)]))[0]


def common(one: np.ndarray, other: np.ndarray) -> int:
    """How many values two sorted sets share."""
    place = np.searchsorted(other, one)
    return int((other[np.minimum(place, len(other) - 1)] == one).sum())


def bridges(key: tuple, table: pa.Table, fewest: int, percent: int) -> pa.Table:
    """Links between different components in one block of a bucket, or between two blocks, as many as
    it takes to join them."""
    low, high = key[1].as_py(), key[2].as_py()
    ids, comps, blocks = (table.column(n).to_numpy() for n in ("id", "component", "block"))
    words = np.array(table.column("signature").to_pylist(), np.int64).reshape(-1, LONGS).view(np.uint64)
    sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
    sizes = np.array([len(s) for s in sets])
    ones = np.uint64(sum(1 << BITS * i for i in range(PER_LONG)))
    _, group = np.unique(comps, return_inverse=True)  # joined as links are found
    left, right = np.flatnonzero(blocks == low), np.flatnonzero(blocks == high)
    found = []
    for i in left:
        near = right[(group[right] != group[i]) & (np.minimum(sizes[right], sizes[i]) * 100 >= percent * np.maximum(sizes[right], sizes[i]))]
        if low == high:
            near = near[ids[near] > ids[i]]
        x = words[i] ^ words[near]
        x |= x >> np.uint64(2)
        x |= x >> np.uint64(1)
        agree = MINIMA - np.bitwise_count(x & ones).sum(axis=1)
        for j in near[np.argsort(-agree, kind="stable")[: (agree >= fewest).sum()]]:
            if group[i] == group[j]:
                continue
            both = common(sets[i], sets[j])
            if both and 100 * both >= percent * (sizes[i] + sizes[j] - both):
                found.append((ids[i], ids[j]))
                group[group == group[j]] = group[i]
    return pa.table({"a": pa.array([p[0] for p in found], pa.int64()), "b": pa.array([p[1] for p in found], pa.int64())})


def shingle_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) to the id and its set as bytes."""
    for batch in batches:
        for ids, data, bounds in runs(batch):
            sets = [s.tobytes() for s in shingle_sets(data, bounds)]
            yield pa.RecordBatch.from_arrays([ids, pa.array(sets, pa.binary())], names=["id", "shingles"])
    give_back()


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of which the full sets reach the threshold."""
    one = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    other = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(other, "b").join(one, "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return confirm(batches, percent)

    return both.sortWithinPartitions("a").mapInArrow(run, "a long, b long")


def wide(number: Column) -> Column:
    """A long whose sums do not overflow."""
    return number.cast("decimal(20,0)")


def by_block(placed: DataFrame, split: DataFrame) -> DataFrame:
    """Members of split buckets, with the pairs of blocks (low, high) that they are compared in.

    `split` has per bucket (band) its largest component and how many members lie in it and outside. Blocks
    below `outer` hold those outside; only they are compared among themselves. A bucket that fits one block is one."""
    whole = F.col("outside") + F.col("inside") <= BLOCK
    outer = F.ceil(F.col("outside") / BLOCK).cast("long")
    inner = F.when(whole, 0).otherwise(F.ceil(F.col("inside") / BLOCK)).cast("long")
    dealt = placed.join(split, "band").withColumns({"outer": outer, "inner": inner, "outsider": F.col("component") != F.col("largest")})
    spread = F.xxhash64("id")
    dealt = dealt.withColumn(
        "block",
        F.when(F.col("outsider") | (F.col("inner") == 0), F.pmod(spread, "outer"))
        .otherwise(F.col("outer") + F.pmod(spread, F.greatest("inner", F.lit(1)))),
    )
    last = F.when(F.col("outsider"), F.col("outer") + F.col("inner")).otherwise(F.col("outer")) - 1
    return dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last))).select(
        "id", "band", "component", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )


def near_duplicates(
    docs: DataFrame, threshold_percent: int = 85, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept, class_id (the smallest id with
    an equal set)."""
    spark = docs.sparkSession
    fewest = fewest_agreeing(threshold_percent / 100)
    number = F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID))
    text = text_of(text_col)
    rows = docs.select(F.struct(number.alias("id"), F.xxhash64(text).alias("hash")).alias("row"), text.alias("text"))
    with arrow_rows(spark, BATCH):
        signed, _ = store(rows.mapInArrow(sign, SIGNATURES), "signatures")
    filled = signed.where("n_shingles > 0")
    same_set = ["n_shingles", "set_a", "set_b"]
    # written once, so a class keeps its node
    numbered = filled.groupBy(*same_set).agg(F.min("row").alias("row")).withColumn("node", F.monotonically_increasing_id())
    classes, classes_path = store(numbered, "classes")
    heads = filled.join(classes, [*same_set, "row"]).groupBy("node").agg(
        F.first("signature").alias("signature"), F.first("bands").alias("bands")
    )
    heads, heads_path = store(heads.withColumnRenamed("node", "id"), "heads")
    banded = heads.select("id", F.explode("bands").alias("band")).distinct()
    buckets = banded.groupBy("band").agg(F.min("id").alias("pivot"), F.count("*").alias("members"))
    buckets, buckets_path = store(buckets.where("members > 1"), "buckets")
    members, members_path = store(banded.join(buckets, "band").where("id <> pivot"), "members")

    candidates = members.select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
    in_buckets = candidates.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    signatures, signatures_path = store(heads.select("id", "signature").join(in_buckets, "id", "left_semi"), "signatures")
    estimated = (
        candidates.join(signatures.select(F.col("id").alias("b"), F.col("signature").alias("y")), "b")
        .join(signatures.select(F.col("id").alias("a"), F.col("signature").alias("x")), "a")
        .where(agreeing(F.col("x"), F.col("y")) >= fewest)
        .select("a", "b")
    )
    pairs, pairs_path = store(estimated, "pairs")
    wanted = classes.select("row", F.col("node").alias("id")).join(in_buckets, "id", "left_semi")
    texts, texts_path = store(rows.join(wanted, "row").groupBy("id").agg(F.min("text").alias("text")), "candidate-texts")
    by_id = filled.select("row.id", *same_set)
    repeated = by_id.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    of_repeated = by_id.join(repeated, "id", "left_semi").join(classes.drop("row"), same_set).select("id", "node").distinct()
    of_repeated, repeated_path = store(of_repeated, "repeated-ids")
    firsts = of_repeated.groupBy("id").agg(F.min("node").alias("a"))
    of_one_id = of_repeated.join(firsts, "id").where("a <> node").select("a", F.col("node").alias("b"))
    with arrow_rows(spark, BATCH):
        links, links_path = store(confirmed(pairs, texts, threshold_percent).unionAll(of_one_id), "links")
    found = components(links)
    paths = [buckets_path, members_path, signatures_path, pairs_path, texts_path, repeated_path, links_path, heads_path]

    # buckets whose members, without the one all were compared with, lie in several components
    placed = members.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    sizes = placed.groupBy("band", "component").agg(
        F.count("*").alias("n"), F.sum(wide(F.xxhash64("id"))).alias("of"), F.sum(wide(F.xxhash64("id", F.lit(1)))).alias("of_too")
    )
    split = (
        sizes.groupBy("band")
        .agg(
            F.max_by("component", F.struct("n", "component")).alias("largest"),
            F.max("n").alias("inside"),
            F.sum("n").alias("n"),
            F.sum("of").alias("of"),
            F.sum("of_too").alias("of_too"),
        )
        .where("n > inside")
    )
    one_each = split.groupBy("n", "of", "of_too").agg(F.min(F.struct("band", "largest", "inside", F.expr("n - inside").alias("outside"))).alias("one"))
    split, split_path = store(one_each.select("one.*"), "split")
    paths.append(split_path)
    if not split.isEmpty():
        searched = placed.join(split.select("band"), "band", "left_semi")
        sets = texts.join(searched.select("id").distinct(), "id", "left_semi").mapInArrow(
            shingle_bytes, "id long, shingles binary"
        )
        with arrow_rows(spark, BATCH):
            sets, sets_path = store(sets, "sets")
        dealt = by_block(placed, split).join(signatures, "id").join(sets, "id")

        def search(key: tuple, group: pa.Table) -> pa.Table:
            return bridges(key, group, fewest, threshold_percent)

        more = dealt.groupBy("band", "low", "high").applyInArrow(search, "a long, b long").distinct()
        links, more_path = store(links.unionAll(more), "links")
        found = components(links)
        paths += [sets_path, more_path]
    for path in paths:
        release(spark, path)

    # a component's smallest id
    named = classes.join(found.withColumnRenamed("id", "node"), "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    least = named.groupBy("component").agg(F.min("row.id").alias("least"))
    named, _ = store(named.join(least, "component").select(*same_set, F.col("row.id").alias("class"), "least"), "named")
    release(spark, classes_path)
    # a row without words goes with the other rows of its id
    empty = signed.where("n_shingles = 0").select("row.id").distinct()
    of_id = by_id.join(empty, "id", "left_semi").join(named, same_set).groupBy("id").agg(F.min("least").alias("of_id"))
    component = F.coalesce("least", F.when(F.col("n_shingles") == 0, F.col("of_id")), "id")
    null_back = lambda c: F.when(c != NULL_ID, c)
    rows = signed.select("row.id", *same_set).join(named, same_set, "left").join(of_id, "id", "left")
    return rows.select(
        null_back(F.col("id")).alias(id_col),
        "n_shingles",
        null_back(component).alias("component_id"),
        (F.col("id") == component).alias("kept"),
        null_back(F.coalesce("class", "id")).alias("class_id"),
    )


def drop_near_duplicates(
    docs: DataFrame, threshold_percent: int = 85, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents without those linked to a smaller id, all columns as they are."""
    gone = free_name(docs, "dropped_id")
    found = near_duplicates(docs, threshold_percent, id_col, text_col).where(~F.col("kept"))
    dropped, _ = store(found.select(F.col(id_col).alias(gone)).distinct(), "dropped")
    return docs.join(dropped, docs[id_col] == F.col(gone), "left_anti")
