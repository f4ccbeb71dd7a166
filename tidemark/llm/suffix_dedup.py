"""Repeated byte strings, by a suffix sort that stops at the threshold.

A string of `threshold` bytes counts as repeated where it also starts earlier (smaller id, or the same
document and a smaller start), and every byte that such an occurrence covers is removed. Suffixes are
ordered by most-significant-digit passes and only through the threshold: after the last pass equal
groups are exactly the repeated windows, and a suffix alone in its group leaves after any pass.

Sorting every suffix of the corpus would shuffle many times the input, so the first digit is taken at a
sparse choice of places that loses no repeat. A window holds `threshold - GRAM + 1` grams of 32
bytes; its anchor is the one with the smallest hash, the leftmost of equals. Equal windows have their
anchors at the same offset, and neighbouring windows mostly share theirs: one place in 35.

1. First digit, over the whole corpus: anchors meet by the hash of their gram. An anchor's context is all
   bytes of all windows that can hold it. Equal contexts (64 bits beside the 64 of the gram) repeat as a
   whole, so all but the earliest are settled at once, within a task before the shuffle already;
   copies cost one row a task. Anchors alone with their gram leave. A gram with OPEN contexts in a batch, or in
   the batches that a task has read, is dealt by context instead; two marks a batch tell its other anchors, which
   stay with the gram. So a gram that is in every text leaves a task's first OPEN contexts there, and from each
   further batch three contexts and two marks at most.
2. Second digit: anchors left, one for each different context of a gram, fetch their bytes and are
   dealt by which side of the gram a window may extend to: in each of FAMILIES cases the windows share 83
   bytes, so a frequent line does not gather all its occurrences in one group.
3. The other digits, eight bytes a pass, in each group: for every start in the contexts.

Grams with a mark or more than GROUP anchors are wide: instead of steps 2 and 3 each window of their
contexts is dealt by a hash of all its bytes (128 bits), and of equal windows that a task holds all but the
earliest are settled before the shuffle. So a frequent passage in different contexts costs one row a task
and window, and a group of step 2, which is sorted in one task, has at most GROUP rows.

The text is shuffled once, for the bytes of step 2 and for the result alike.

Defined cases: a null text is empty; texts shorter than the threshold repeat nothing. A null id comes
before all others. Rows that repeat an id and its text are the same document and get the same result;
rows that share an id with different texts are told apart by a checksum, which also orders equal
starts. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import NULL_ID, text_of
from tidemark.llm.words import mixed, runs
from tidemark.scratch import store

#: Bytes that one anchor's hash covers; a multiple of eight.
GRAM = 32

#: Cases of how far a window extends to the left of its anchor.
FAMILIES = 4

#: Different contexts of a gram in a batch from which on they are dealt by context; anchors of a gram from
#: which on its windows are; windows that a task holds to settle equal ones.
OPEN, GROUP, HELD = 64, 20_000, 200_000

#: Contexts of a gram in a batch from which on a task counts them over its batches, and the most grams so counted.
FEW, TALLIED = 4, 1_000_000

#: Kinds of rows of step 1: an anchor, a settled span, an anchor dealt by context, a mark of its gram.
ANCHOR, SETTLED, DEALT, MARK = range(4)

_random = np.random.default_rng(3)
ODD = _random.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
U = np.uint64

ANCHORS = "gram long, context long, id long, place long, kind byte"
CONTEXTS = "family_key long, family int, id long, place long, bytes binary, before int, after int"
SPANS = "id long, checksum long, begin long, end long"


def words8(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place as one number."""
    data = np.ascontiguousarray(data)
    return np.ndarray((max(len(data) - 7, 0),), "<u8", data, 0, (1,))


def anchors(data: np.ndarray, bounds: np.ndarray, threshold: int) -> np.ndarray:
    """Anchors of all windows within the texts that lie one after another in data."""
    grams = threshold - GRAM + 1
    lengths = np.diff(bounds)
    if not (lengths >= threshold).any():
        return np.empty(0, np.int64)
    eights = words8(data) * ODD[0]
    eights ^= eights >> U(32)
    n = len(data) - GRAM + 1
    value = np.zeros(n, U)
    for i in range(0, GRAM, 8):
        value += eights[i : i + n] * ODD[1 + i // 8]
    value ^= value >> U(29)
    value *= ODD[5]
    value &= U(0xFFFFFFFF00000000)
    value |= np.arange(n, dtype=U)
    width, least = 1, value
    while width * 2 <= grams:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    if width < grams:
        least = np.minimum(least[: n - grams + 1], least[grams - width : grams - width + n - grams + 1])
    edges = np.zeros(len(data) + 1, np.int8)
    long = lengths >= threshold
    edges[bounds[:-1][long]] += 1
    edges[bounds[1:][long] - threshold + 1] -= 1
    whole = np.cumsum(edges, dtype=np.int8)[: len(least)] > 0
    found = (least[whole] & U(0xFFFFFFFF)).astype(np.int64)
    return found[np.diff(found, prepend=-1) != 0]


def gram_hash(eights: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.zeros(len(at), U)
    for i in range(0, GRAM, 8):
        total += mixed(eights[at + i]) * ODD[8 + i // 8]
    return mixed(total)


def context_hash(data: np.ndarray, at: np.ndarray, before: np.ndarray, after: np.ndarray, reach: int) -> np.ndarray:
    """Hash of up to `reach` bytes before and after each gram, and of how many there are."""
    size = -(-(2 * reach + GRAM) // 8) * 8
    padded = np.zeros(len(data) + reach + size, np.uint8)
    padded[reach : reach + len(data)] = data
    eights = words8(padded)
    total = before.astype(U) * ODD[60] + after.astype(U) * ODD[61]
    inner = (before == reach) & (after == reach) & (size == 2 * reach + GRAM)
    place = at[inner]
    part = total[inner]
    for i in range(0, size, 8):
        part += mixed(eights[place + i]) * ODD[16 + i // 8]
    total[inner] = part
    outer = np.flatnonzero(~inner)
    for some in np.array_split(outer, len(outer) // 20_000 + 1):
        column = np.arange(size)
        cut = padded[at[some][:, None] + column]
        cut *= (column >= reach - before[some][:, None]) & (column < reach + GRAM + after[some][:, None])
        part = total[some]
        for i, word in enumerate(np.ascontiguousarray(cut).view("<u8").T):
            part += mixed(word) * ODD[16 + i]
        total[some] = part
    return mixed(total)


class Tally:
    """How many contexts the batches of a task have held of grams that had `few` and more in one of them.

    Beyond `most` grams the rarer ones are forgotten, which changes what is dealt how, not the result."""

    def __init__(self, few: int, most: int):
        self.few, self.most = few, most
        self.grams, self.counts = np.empty(0, U), np.empty(0, np.int64)

    def of(self, grams: np.ndarray) -> np.ndarray:
        if not len(self.grams):
            return np.zeros(len(grams), np.int64)
        place = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        return np.where(self.grams[place] == grams, self.counts[place], 0)

    def add(self, grams: np.ndarray, counts: np.ndarray) -> None:
        many = counts >= self.few
        self.grams, place = np.unique(np.r_[self.grams, grams[many]], return_inverse=True)
        self.counts = np.bincount(place, np.r_[self.counts, counts[many]], len(self.grams)).astype(np.int64)
        if len(self.grams) > self.most:
            kept = np.sort(np.argsort(-self.counts, kind="stable")[: self.most // 2])
            self.grams, self.counts = self.grams[kept], self.counts[kept]


def find_anchors(
    batches: Iterator[pa.RecordBatch], threshold: int, open_: int, few: int = FEW, tallied: int = TALLIED
) -> Iterator[pa.RecordBatch]:
    """Anchors of texts; of equal contexts in a batch all but the earliest as settled spans, merged:
    their `context` is the end, and the key of their row is arbitrary. A gram with `open_` different
    contexts in a batch, or in the batches of this task so far and some in this one, has rows keyed by
    context, and two marks."""
    reach = threshold - GRAM
    tally = Tally(few, tallied)
    for batch in batches:
        parts = []
        for ids, data, bounds in runs(batch):
            at = anchors(data, bounds, threshold)
            if not len(at):
                continue
            doc = np.searchsorted(bounds, at, "right") - 1
            before = np.minimum(at - bounds[doc], reach)
            after = np.minimum(bounds[doc + 1] - at - GRAM, reach)
            checks = np.zeros(len(bounds) - 1, np.int64)
            for d in np.unique(doc):
                checks[d] = zlib.crc32(data[bounds[d] : bounds[d + 1]])
            place = (at - bounds[doc] << 32) | checks[doc]
            parts.append(
                (gram_hash(words8(data), at), context_hash(data, at, before, after, reach), ids.to_numpy()[doc], place)
            )
        if not parts:
            continue
        gram, context, ids, place = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((place, ids, context, gram))
        same = (gram[order][1:] == gram[order][:-1]) & (context[order][1:] == context[order][:-1])
        again = np.zeros(len(order), bool)
        again[order[1:][same]] = True
        first = order[np.maximum.accumulate(np.where(np.r_[False, same], 0, np.arange(len(order))))]
        again[order] &= (ids[order] != ids[first]) | (place[order] != place[first])
        begin = np.maximum((place[again] >> 32) - reach, 0)
        id_, check, begin, end = merged(ids[again], place[again] & 0xFFFFFFFF, begin, (place[again] >> 32) + GRAM + reach)
        key = mixed(id_.view(U) ^ mixed(begin.view(U)))
        heads = order[~np.r_[False, same]]  # one anchor of each context
        runs_ = np.flatnonzero(np.r_[True, gram[heads][1:] != gram[heads][:-1]])
        counts = np.diff(np.r_[runs_, len(heads)])
        dealt = np.empty(len(order), bool)
        grams = gram[heads][runs_]
        is_open = (counts >= open_) | ((counts > 1) & (counts + tally.of(grams) >= open_))
        tally.add(grams, counts)
        dealt[order] = np.repeat(is_open, counts)[np.cumsum(~np.r_[False, same]) - 1]
        marks = runs_[is_open & (counts > 1)]
        marks = heads[np.r_[marks, marks + 1]]
        gram_key = np.where(dealt, mixed(gram ^ mixed(context)), gram)
        columns = [
            np.r_[gram_key[~again].view(np.int64), key.view(np.int64), gram[marks].view(np.int64)],
            np.r_[context[~again].view(np.int64), end, context[marks].view(np.int64)],
            np.r_[ids[~again], id_, ids[marks]],
            np.r_[place[~again], (begin << 32) | check, place[marks]],
            np.r_[np.where(dealt[~again], DEALT, ANCHOR), np.full(len(id_), SETTLED), np.full(len(marks), MARK)].astype(np.int8),
        ]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["gram", "context", "id", "place", "kind"])


def merged(ids: np.ndarray, check: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of one document joined where they touch."""
    if not len(ids):
        return ids, check, begin, end
    order = np.lexsort((end, begin, check, ids))
    ids, check, begin, end = ids[order], check[order], begin[order], end[order]
    starts = np.r_[True, (ids[1:] != ids[:-1]) | (check[1:] != check[:-1]) | (begin[1:] > end[:-1])]
    heads = np.flatnonzero(starts)  # ends rise with begins: all spans here reach equally far
    return ids[heads], check[heads], begin[heads], np.maximum.reduceat(end, heads)


def families(reach: int) -> list[tuple[int, int]]:
    """Ranges of bytes before the anchor, for the windows of each family."""
    cuts = [i * (reach + 1) // FAMILIES for i in range(FAMILIES + 1)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def cut_contexts(batches: Iterator[pa.RecordBatch], threshold: int, held: int) -> Iterator[pa.RecordBatch]:
    """For each family an anchor can have windows in, the bytes of those windows; of a wide gram the hashes
    of all windows (family FAMILIES) and spans that are settled here (family -1, `after` is their length).

    Rows are (id, text, checksum, grams, positions, wide) of a document."""
    reach = threshold - GRAM
    wide_windows = Windows(threshold)
    for batch in batches:
        rows: list[tuple] = []
        for id_, text, check, grams, places, wide in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
            data = text.encode()
            for gram, at, by_window in zip(grams, places, wide, strict=True):
                if by_window:
                    wide_windows.add(data, id_, check, at)
                    if len(wide_windows.first) >= held or len(wide_windows.settled) >= held:
                        yield from wide_windows.rows()
                    continue
                for family, (few, many) in enumerate(families(reach)):
                    shared = data[max(at - few, 0) : at + GRAM + reach - many + 1]
                    if at < few or len(shared) < few + GRAM + reach - many + 1:
                        continue
                    digest = hashlib.blake2b(shared, digest_size=8, key=b"%d,%d" % (family, gram)).digest()
                    begin = max(at - many + 1, 0)
                    piece = data[begin : at - few + threshold]
                    rows.append(
                        (int.from_bytes(digest, "little", signed=True), family, id_, at << 32 | check, piece, at - begin, at)
                    )
                    if len(rows) >= 50_000:
                        yield context_batch(rows)
                        rows = []
        if rows:
            yield context_batch(rows)
    yield from wide_windows.rows()


class Windows:
    """The earliest place of each window seen, and the later ones, which are settled."""

    def __init__(self, threshold: int):
        self.threshold = threshold
        self.first: dict[bytes, tuple[int, int]] = {}
        self.settled: list[tuple[int, int]] = []

    def add(self, data: bytes, id_: int, check: int, at: int) -> None:
        """All windows that hold the gram at a place."""
        for begin in range(max(at + GRAM - self.threshold, 0), min(at, len(data) - self.threshold) + 1):
            digest = hashlib.blake2b(data[begin : begin + self.threshold], digest_size=16).digest()
            spot = (id_, begin << 32 | check)
            first = self.first.setdefault(digest, spot)
            if first != spot:
                if spot < first:
                    self.first[digest] = spot
                self.settled.append(max(spot, first))

    def rows(self) -> Iterator[pa.RecordBatch]:
        """Batches like those of contexts; then it starts anew."""
        rows = [
            (int.from_bytes(digest[:8], "little", signed=True), FAMILIES, id_, place, digest[8:], 0, 0)
            for digest, (id_, place) in self.first.items()
        ]
        if self.settled:
            ids, place = np.array(self.settled, np.int64).T
            spans = merged(ids, place & 0xFFFFFFFF, place >> 32, (place >> 32) + self.threshold)
            key = mixed(spans[0].view(U) ^ mixed(spans[2].view(U))).view(np.int64)
            for key_, id_, check, begin, end in zip(key.tolist(), *(c.tolist() for c in spans), strict=True):
                rows.append((key_, -1, id_, begin << 32 | check, b"", 0, end - begin))
        self.first, self.settled = {}, []
        for i in range(0, len(rows), 50_000):
            yield context_batch(rows[i : i + 50_000])


def context_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
        names=[c.split()[0] for c in CONTEXTS.split(", ")],
    )


def sort_groups(batches: Iterator[pa.RecordBatch], threshold: int) -> Iterator[pa.RecordBatch]:
    """Repeated windows of rows sorted by group, id and place; several whole groups at a time."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        keys = batch.column(0).to_numpy()
        change = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        if rows + batch.num_rows >= 20_000 and len(change):
            cut = int(change[-1])
            yield from windows([*held, batch.slice(0, cut)], threshold)
            held, rows = [batch.slice(cut)], batch.num_rows - cut
        else:
            held.append(batch)
            rows += batch.num_rows
    if held:
        yield from windows(held, threshold)


def windows(held: list[pa.RecordBatch], threshold: int) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(held)
    family = table.column(1).to_numpy()
    by_bytes = (family >= 0) & (family < FAMILIES)
    if not by_bytes.all():
        yield from hashed_windows(table.filter(pa.array(~by_bytes)), threshold)
        table = table.filter(pa.array(by_bytes))
    group, family, ids, place = (table.column(i).to_numpy() for i in range(4))
    if not len(group):
        return
    # a group of one row repeats nothing
    more = np.r_[group[1:] == group[:-1], False]
    more[1:] |= more[:-1].copy()
    kept = np.flatnonzero(more)
    if not len(kept):
        return
    table = table.take(kept)
    group, family, ids, place = group[kept], family[kept], ids[kept], place[kept]
    before, at = table.column(5).to_numpy(), place >> 32
    texts = table.column(4).to_pylist()
    width = threshold + max(b - a for a, b in families(threshold - GRAM))
    bytes_ = np.frombuffer(b"".join(t.ljust(width + 8, b"\0") for t in texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    few = np.array([f[0] for f in families(threshold - GRAM)])[family]
    many = np.array([f[1] for f in families(threshold - GRAM)])[family]
    # window `offset` bytes before the anchor, for each offset of the row's family
    steps = int((many - few).max())
    row = np.repeat(np.arange(len(texts)), steps)
    offset = few[row] + np.tile(np.arange(steps), len(texts))
    begin = before[row] - offset
    fits = (offset < many[row]) & (begin >= 0) & (begin + threshold <= sizes[row])
    row, offset, begin = row[fits], offset[fits], begin[fits]
    if not len(row):
        return
    dense = np.cumsum(np.r_[True, group[1:] != group[:-1]])
    label = dense[row] * (threshold + 1) + offset
    first = row * (width + 8) + begin
    eights = words8(bytes_)
    for depth in range(0, threshold, 8):
        digit = eights[first + depth]
        if depth + 8 > threshold:
            digit = digit & U((1 << 8 * (threshold - depth)) - 1)
        order = np.lexsort((digit, label))
        row, offset, first, label, digit = row[order], offset[order], first[order], label[order], digit[order]
        new = np.r_[True, (label[1:] != label[:-1]) | (digit[1:] != digit[:-1])]
        label = np.cumsum(new)
        several = ~new
        several[:-1] |= ~new[1:]
        row, offset, first, label = row[several], offset[several], first[several], label[several]
        if not len(row):
            return
    order = np.lexsort((row, label))  # rows come in the order of id and place
    row, offset, label = row[order], offset[order], label[order]
    new = np.r_[True, label[1:] != label[:-1]]
    head = row[np.maximum.accumulate(np.where(new, np.arange(len(row)), 0))]
    again = (ids[row] != ids[head]) | (place[row] != place[head])
    row, start = row[again], at[row[again]] - offset[again]
    if not len(row):
        return
    order = np.argsort(row, kind="stable")
    row, start = row[order], start[order]
    heads = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    of = row[heads]
    columns = [
        ids[of],
        place[of] & 0xFFFFFFFF,
        np.minimum.reduceat(start, heads),
        np.maximum.reduceat(start, heads) + threshold,
    ]
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["id", "checksum", "begin", "end"])


def hashed_windows(table: pa.Table, threshold: int) -> Iterator[pa.RecordBatch]:
    """Spans of windows whose hash also stands earlier, and those settled before, merged."""
    group, family, ids, place = (table.column(i).to_numpy() for i in range(4))
    size = np.where(family < 0, table.column(6).to_numpy(), threshold)
    rest = np.array([int.from_bytes(b, "little") for b in table.column(4).to_pylist()], U)
    order = np.lexsort((place, ids, rest, group, family))
    new = np.r_[True, (group[order][1:] != group[order][:-1]) | (rest[order][1:] != rest[order][:-1])]
    head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    again = np.empty(len(order), bool)
    again[order] = (ids[order] != ids[head]) | (place[order] != place[head])
    for some in (np.flatnonzero((family == FAMILIES) & again), np.flatnonzero(family < 0)):
        begin = place[some] >> 32
        columns = (ids[some], place[some] & 0xFFFFFFFF, begin, begin + size[some])
        if len(some) and family[some[0]] == FAMILIES:  # all of one length
            columns = merged(*columns)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["id", "checksum", "begin", "end"])


def union_spans(spans: list[dict], size: int) -> list[tuple[int, int]]:
    """Spans joined where they overlap or touch, and cut to the text."""
    out: list[list[int]] = []
    for begin, end in sorted((s["begin"], min(s["end"], size)) for s in spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(a, b) for a, b in out]


def remove_spans(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    """(id, text, spans) to the result's rows."""
    for batch in batches:
        rows = []
        for id_, text, spans in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            data = text.encode()
            gone = union_spans(spans or [], len(data))
            cuts = [0, *(x for span in gone for x in span), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True)) if gone else data
            row = (id_, len(data), len(data) - len(kept), len(gone), hashlib.sha256(kept).hexdigest())
            rows.append((*row, kept) if with_text else row)
        names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 + with_text]
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names=names)


def remove_repeats(
    docs: DataFrame, threshold: int = 100, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False
) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256, and with_text `kept`, the
    remaining bytes."""
    if threshold < GRAM + FAMILIES:
        raise ValueError(f"the threshold must be {GRAM + FAMILIES} bytes at least")
    reach = threshold - GRAM
    number = F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID))
    rows = docs.select(number.alias("id"), text_of(text_col).alias("text"))

    open_, held, few, tallied = OPEN, HELD, FEW, TALLIED

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return find_anchors(batches, threshold, open_, few, tallied)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return cut_contexts(batches, threshold, held)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return sort_groups(batches, threshold)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return remove_spans(batches, with_text)

    anchored = rows.mapInArrow(find, ANCHORS)
    anchored.createOrReplaceTempView(view := f"anchors_{id(anchored)}")
    met = docs.sparkSession.sql(f"""
        SELECT gram, id, place & 4294967295 AS checksum, shiftright(place, 32) AS at,
               IF(kind = {SETTLED}, context, NULL) AS settled_end, earlier > 1 AS again,
               kind = {DEALT} OR marked OR n > {GROUP} AS wide
        FROM (
            SELECT *,
                   rank() OVER (PARTITION BY gram, context ORDER BY id, place) AS earlier,
                   min(context) OVER (PARTITION BY gram) AS low,
                   max(context) OVER (PARTITION BY gram) AS high,
                   max(kind = {MARK}) OVER (PARTITION BY gram) AS marked,
                   count(*) OVER (PARTITION BY gram) AS n
            FROM {view}
        )
        WHERE kind <> {MARK} AND (kind <> {ANCHOR} OR earlier > 1 OR low <> high)
    """)
    met, _ = store(met, "anchors")
    docs.sparkSession.catalog.dropTempView(view)
    settled = met.where("settled_end IS NOT NULL").selectExpr("id", "checksum", "at AS begin", "settled_end AS end")
    copies = met.where("settled_end IS NULL AND again").selectExpr(
        "id", "checksum", f"greatest(at - {reach}, 0) AS begin", f"at + {GRAM + reach} AS end"
    )
    left = met.where("settled_end IS NULL AND NOT again").groupBy("id", "checksum").agg(
        F.collect_list(F.struct("gram", "at", "wide")).alias("places")
    )
    texts = rows.withColumn("checksum", F.coalesce(F.crc32(F.encode("text", "UTF-8")), F.lit(0)))
    contexts = texts.join(left, ["id", "checksum"]).select("id", "text", "checksum", "places.gram", "places.at", "places.wide")
    sorted_groups = (
        contexts.mapInArrow(cut, CONTEXTS)
        .repartition("family_key")
        .sortWithinPartitions("family_key", "id", "place")
        .mapInArrow(sort, SPANS)
    )
    spans = settled.unionAll(copies).unionAll(sorted_groups)
    listed = spans.groupBy("id", "checksum").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    found = texts.join(listed, ["id", "checksum"], "left").select("id", "text", "spans")
    kept = ", kept binary" if with_text else ""
    out = found.mapInArrow(remove, f"id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string{kept}")
    named = F.when(F.col("id") != NULL_ID, F.col("id")).alias(id_col)
    return out.select(named, *out.columns[1:])
