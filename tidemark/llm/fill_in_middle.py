"""Fill-in-middle: texts cut in prefix, middle and suffix, written with the middle last.

A text is n units, each a word with the blanks before it (blanks at the end are a unit of their own). Two
hashes of the document's id draw two ranks among 0 to n, two more draw the form. An indexable skip list over
the units says where the ranks lie: every link of an express lane carries how many units and how many code
points it crosses, so a descent by accumulated widths ends at exactly the rank asked for.

The text itself does not pass through Python and back: tasks return ranks and code points, and the
pieces are cut and written by column functions. Nothing is shuffled.

Defined cases: a null text counts as the empty one, which is plain; a null id hashes as no digits; rows
that repeat an id are cut alike if their texts are equal; whole texts of any length are cut, one text is
held in memory at a time; an empty table gives no row. Other columns are handed on under their names, and
the new ones get longer names where these are taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, text_of
from tidemark.llm.words import SPACE, give_back, runs

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARK = "<[PSM]>"

#: Links of a lane that one link of the lane above crosses.
FAN = 16

CUTS = "n long, prefix_chars long, middle_chars long"
CUTS_ARROW = pa.struct([(c.split()[0], pa.int64()) for c in CUTS.split(", ")])


class SkipList:
    """Units in a row, by their widths in code points, under lanes of ever longer links."""

    def __init__(self, widths: np.ndarray):
        units = np.ones(len(widths), np.int64)
        self.lanes = [(units, widths)]
        while len(units) > FAN:
            starts = np.arange(0, len(units), FAN)
            units, widths = np.add.reduceat(units, starts), np.add.reduceat(widths, starts)
            self.lanes.append((units, widths))

    def __len__(self) -> int:
        return len(self.lanes[0][0])

    def seek(self, rank: int) -> int:
        """Code points before the unit of this rank; rank n is the end."""
        if not 0 <= rank <= len(self):
            raise IndexError(f"rank {rank} of {len(self)} units")
        link = crossed = points = 0
        for units, widths in reversed(self.lanes):
            link *= FAN  # where the links crossed above end in this lane
            while link < len(units) and crossed + units[link] <= rank:
                crossed += int(units[link])
                points += int(widths[link])
                link += 1
        return points


def unit_widths(data: np.ndarray) -> np.ndarray:
    """Code points of every unit of one text, given as its UTF-8 bytes."""
    inside = ~SPACE[data]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    if len(data):
        last[-1] = True  # of a word, or of the blanks after all words
    ends = np.flatnonzero(last)
    leads = np.cumsum((data & 0xC0) != 0x80)
    return np.diff(leads[ends], prepend=0)


def cut(data: np.ndarray, first: int, second: int) -> tuple[int, int, int]:
    """Units of a text, code points of its prefix and of its middle, for two draws."""
    units = SkipList(unit_widths(data))
    n = len(units)
    low, high = sorted((first % (n + 1), second % (n + 1)))
    prefix = units.seek(low)
    return n, prefix, units.seek(high) - prefix


def cut_all(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    for texts, firsts, seconds in batches:
        rows = []
        draws = zip(firsts.to_pylist(), seconds.to_pylist(), strict=True)
        numbered = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), texts], names=["row", "text"])
        for _, data, bounds in runs(numbered):
            for begin, end in zip(bounds, bounds[1:], strict=False):
                rows.append(cut(data[begin:end], *next(draws)))
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        arrays = [pa.array(c, pa.int64()) for c in columns]
        yield pa.StructArray.from_arrays(arrays, fields=list(CUTS_ARROW))
    give_back()


def draw(id_col: Column, seed: str, n: int) -> Column:
    """The n-th of the eight-digit groups of the id's hash, as an unsigned integer."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(hashed, 8 * n - 7, 8), 16, 10).cast("long")


def fill_in_middle(
    docs: DataFrame,
    seed: str = "42",
    share_percent: int = 50,
    suffix_first_percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The columns of the documents and n, form, prefix_chars, middle_chars, output.

    `form` is plain, psm or spm; `share_percent` of the documents are cut, of these
    `suffix_first_percent` have the suffix first."""
    text, key = text_of(text_col), F.col(id_col)
    names = {}
    for name in ("n", "form", "prefix_chars", "middle_chars", "output"):
        names[name] = free_name(docs, name)
    cuts = free_name(docs, "cuts")
    find = F.arrow_udf(cut_all, CUTS)
    plain = (text == "") | text.rlike(MARK) | (draw(key, seed, 3) % 100 >= share_percent)
    suffix_first = draw(key, seed, 4) % 100 < suffix_first_percent
    form = F.when(plain, "plain").when(suffix_first, "spm").otherwise("psm")
    at = docs.withColumn(cuts, find(text, draw(key, seed, 1), draw(key, seed, 2)))
    is_plain, of = F.col(names["form"]) == "plain", F.col(cuts)
    at = at.withColumn(names["form"], form).withColumns(
        {names["n"]: of["n"]}
        | {names[c]: F.when(~is_plain, of[c]) for c in ("prefix_chars", "middle_chars")}
    )
    begin, length = F.col(names["prefix_chars"]).cast("int"), F.col(names["middle_chars"]).cast("int")
    prefix, middle = F.substring(text, F.lit(1), begin), F.substring(text, begin + 1, length)
    suffix = F.substring(text, begin + length + 1, F.char_length(text))
    psm = F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)
    spm = F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)
    output = F.when(is_plain, text).when(F.col(names["form"]) == "spm", spm).otherwise(psm)
    return at.withColumn(names["output"], output).select(*docs.columns, *names.values())


def restored(output: Column, form: Column) -> Column:
    """The text an output was made from; no text that is cut holds a mark, so the marks tell all."""
    part = F.split(output, MARK)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(part[1], part[3], part[2]))
        .otherwise(F.concat(part[2], part[3], part[1]))
    )
