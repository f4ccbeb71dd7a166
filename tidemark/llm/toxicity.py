"""Toxicity of documents whose words may be disguised: a noisy channel, then a linear score.

1. A character trigram model is counted over every document of the corpus, task by task and summed in
   Spark. What reaches the driver is one row a trigram of Latin letters; letters beyond Latin count as
   one, so the table is bounded by the alphabet and not by the corpus.
2. A disguised token becomes a lattice: a digit or sign may stand for letters it looks like or be
   dropped, a letter that repeats the one before may be dropped, and single letters set apart by white
   space are one token. Viterbi decoding finds the letters that the trigram model and the costs of the
   channel like best. Tokens of letters without a repeat have one path and are left as they are; the word
   as written stays a feature beside the restored one. Tokens of digits alone stay numbers.
3. The words of the restored text, and the letters of a token as written, are features, and so are the
   beginnings of words: how many different words of the text begin with these four or five letters (one, two, three
   and more). So an ending that no training row holds still counts. Those that tell the labels apart
   (likelihood ratio) get weights by logistic regression with a penalty, fitted on a bounded sample: the
   TRAIN_ROWS labelled rows with the smallest hash, never a row held out. Of near copies in it one row counts,
   else every word of a copied text would look telling. Each row is seen whole, and once for each word that
   is SURE to be toxic alone, since one such word is enough.

Scoring is one pass over the documents with the model broadcast (its size is bounded by the sample and
the alphabet). Inputs of a score are the text's words alone.

Defined cases: a null text is empty; an empty text gets the score of a text without telling words; texts of any
length are read whole. Of paths through a lattice that cost the same, the one with the first spelling counts. A null
id counts as held out and never trains. Several labels of one id: it is toxic if one says so; null labels
are left out. Without usable labels every score is 0; with labels of one kind it is their smoothed
share. An empty table gives an empty result. Other columns are passed through or not looked at.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.chunks import forget
from tidemark.llm.common import free_name, text_of
from tidemark.llm.near_dups import FACTORS, SUMMANDS, set_of
from tidemark.llm.words import give_back
from tidemark.scratch import release, store

#: Labelled rows that are used to choose words and fit weights, at most.
TRAIN_ROWS = 20_000

#: Training rows with a toxic label that a feature must be in, and its likelihood ratio, at least: a ratio of
#: 24 comes by chance for one feature in a million.
LEAST_ROWS, LEAST_RATIO = 3, 24.0

#: Letters of the beginnings of words, and up to which number their words are counted.
BEGINNINGS, COUNTED = (4, 5), 3

#: The share of toxic rows, lower bound, from which a word alone is taken for toxic.
SURE = 0.9

#: Minima of a text's shingles by which copies in the sample are found: one in common is enough.
SKETCH = 4

#: Features of training rows that a task holds before it hands them on.
HELD = 50_000

#: Characters whose trigrams are counted at a time, about: each takes some 40 bytes meanwhile.
COUNTED_AT_ONCE = 1_000_000

#: Decoded tokens that a Python worker remembers.
REMEMBERED = 50_000

#: What digits and signs may stand for.
LOOKS = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c", "2": "z",
}

#: Costs of the channel in nats: a look-alike, a dropped sign, a dropped repeat, a digit kept. Signs that
#: look like letters are dropped at a higher price, since each letter they stand for has its own.
LOOK, DROP, DROP_LOOK, REPEAT, KEEP = 1.0, 2.0, 6.0, 0.5, 14.0

LATIN = 0x250
EDGES = " \t\n.,;:?!\"'`´()[]{}<>#%&*/\\|~^=_+-–—…¿¡«»„“”‘’$@€"
DOUBLE = re.compile(r"([^\W\d_])\1")
APART = re.compile(r"(?<!\S)(?:[^\W_]|[@$!|])(?:\s+(?:[^\W_]|[@$!|])){2,}(?!\S)")
GAPS = re.compile(r"\s{2,}|[^\S ]")
LETTERS = re.compile(r"[^\W\d_]+")

CODES = np.zeros(LATIN + 1, np.int32)
CODES[[c for c in range(LATIN) if chr(c).isalpha()]] = [c for c in range(LATIN) if chr(c).isalpha()]
CODES[LATIN] = 1


def char_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigrams of words with their edges, as one number of 3 * 10 bits, and their counts."""
    forget()  # the worker may come from an operator that encodes
    give_back()
    for batch in batches:
        texts, counted = batch.column(0), []
        size = pc.sum(pc.utf8_length(texts)).as_py() or 0
        for some in np.array_split(np.arange(len(texts)), max(1, size // COUNTED_AT_ONCE)):
            counted.append(trigrams([text.lower() for text in texts.take(pa.array(some)).to_pylist()]))
        gram, place = np.unique(np.concatenate([gram for gram, _ in counted]), return_inverse=True)
        n = np.zeros(len(gram), np.int64)
        np.add.at(n, place, np.concatenate([n for _, n in counted]))
        yield pa.RecordBatch.from_arrays([pa.array(gram, pa.int32()), pa.array(n, pa.int64())], names=["gram", "n"])
    give_back()


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The trigrams of some texts in lower case and their counts."""
    joined = " ".join(["", "", *texts, ""])
    points = np.frombuffer(joined.encode("utf-32-le", "replace"), "<u4")
    code = CODES[np.minimum(points, LATIN)]
    one, two, three = code[:-2].copy(), code[1:-1], code[2:]
    one[two == 0] = 0
    word = (two | three) > 0
    return np.unique((one << 20 | two << 10 | three)[word], return_counts=True)


class CharModel:
    """Interpolated trigram probabilities of letters; 0 is the edge of a word."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.three = dict(zip(grams.tolist(), counts.tolist(), strict=True))
        self.two: dict[int, int] = {}
        self.one: dict[int, int] = {}
        self.before: dict[int, int] = {}
        self.total = 1
        for gram, n in self.three.items():
            last = gram & 1023
            for table, key in ((self.before, gram >> 10), (self.two, gram & 0xFFFFF), (self.one, last)):
                table[key] = table.get(key, 0) + n
            self.total += n
        self.known: dict[tuple[int, int, int], float] = {}

    def cost(self, a: int, b: int, c: int) -> float:
        """Minus the log-probability of c after a and b."""
        if (a, b, c) not in self.known:
            ab, bc = a << 10 | b, b << 10 | c
            p3 = self.three.get(ab << 10 | c, 0) / (self.before.get(ab, 0) + 1e-9)
            p2 = self.two.get(bc, 0) / (self.one.get(b, 0) + 1e-9)
            p1 = self.one.get(c, 0) / self.total
            self.known[a, b, c] = -math.log(0.7 * p3 + 0.2 * min(p2, 1.0) + 0.0999 * p1 + 1e-6)
        return self.known[a, b, c]


def code(letter: str) -> int:
    return int(CODES[min(ord(letter), LATIN)])


def restore(token: str, model: CharModel) -> str:
    """The letters most likely meant by a token, by Viterbi decoding of its lattice."""
    states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}  # cost, (what was before, letter)
    for i, sign in enumerate(token):
        options: list[tuple[str, float]] = []
        if sign.isalpha():
            options.append((sign, 0.0))
            if token[i - 1 : i] == sign:
                options.append(("", REPEAT))
        else:
            options += [(letter, LOOK) for letter in LOOKS.get(sign, "")]
            options.append(("", DROP_LOOK if sign in LOOKS else DROP))
            if sign.isdigit():
                options.append((sign, KEEP))
        after: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (cost, text) in states.items():
            for letter, price in options:
                if not letter:
                    state, total = (a, b), cost + price
                elif letter.isalpha():
                    c = code(letter)
                    state, total = (b, c), cost + price + model.cost(a, b, c)
                else:
                    state, total = (0, 0), cost + price
                if state not in after or total < after[state][0]:
                    after[state] = (total, (text, letter))
        states = after
    least = min(cost + model.cost(a, b, 0) for (a, b), (cost, _) in states.items())
    return min(spelled(text) for (a, b), (cost, text) in states.items() if cost + model.cost(a, b, 0) == least)


def spelled(text: tuple) -> str:
    letters = []
    while text:
        text, letter = text
        letters.append(letter)
    return "".join(reversed(letters))


class Restorer:
    """Words of restored texts."""

    def __init__(self, model: CharModel):
        self.model = model
        self.memory: dict[str, tuple[str, ...]] = {}

    def read(self, token: str) -> tuple[str, ...]:
        if token not in self.memory:
            if len(self.memory) >= REMEMBERED:
                self.memory.clear()
            self.memory[token] = (*LETTERS.findall(token), *LETTERS.findall(restore(token, self.model)))
        return self.memory[token]

    def words(self, text: str) -> set[str]:
        low = text.lower()
        tokens = set(low.split())
        words = {t for t in tokens if t.isalpha()}
        # a bracket that is closed is one
        signs = "@$!|+€(" if low.count("(") > low.count(")") else "@$!|+€"
        for token in tokens - words:
            core = token.strip(EDGES)
            if "|)" in token:
                words.update(self.read(token.strip(".,;:?!\"'").replace("|)", "d")))
            if not any(map(str.isalpha, core)):
                whole = token.strip(".,;:?\"'")
                # look-alikes alone: a sign within, so no number or price, and no row of one sign
                if all(c in LOOKS for c in whole) and len(set(whole)) > 1 < len(whole) - 1:
                    if whole[0] == "@" or any(not c.isdigit() for c in whole[1:-1]):
                        words.update(self.read(whole))
                continue
            if core.isalpha():
                words.add(core)
            else:
                words.update(self.read(core))
            # a look-alike at an edge, but no row of signs put there as decoration
            edge = token.strip(".,;:?!\"'")
            if edge[:1] in "$@" and edge[1:2].isalnum() or edge[-1:] == "$" and edge[-3:-2].isalnum():
                words.update(self.read(edge))
            if core != token:
                words.update(w for option in edged(token, core, signs) for w in self.read(option))
        for token in [w for w in words if DOUBLE.search(w)]:
            words.update(self.read(token))
        for run in APART.findall(low):
            for part in {run, *GAPS.split(run)}:  # wider gaps may be within a word or between words
                letters = "".join(part.split())
                if len(letters) > 2 + letters.isdigit():
                    words.update(self.read(letters))
        return words


def edged(token: str, core: str, signs: str) -> list[str]:
    """A token's core with one or both of the look-alikes next to it, where they are no row of one sign."""
    begin = token.index(core)
    end = begin + len(core)
    first, last = token[:begin][-1:], token[end:][:1]
    first = first if first and first in signs and token[: begin - 1][-1:] != first else ""
    last = last if last and last in signs and token[end + 1 :][:1] != last else ""
    return [a + core + b for a, b in {(first, ""), ("", last), (first, last)} if a or b]


def char_model(docs: DataFrame, text_col: str = "text") -> CharModel:
    """The trigram model of all texts."""
    counted = docs.select(text_of(text_col).alias("text")).mapInArrow(char_counts, "gram int, n long")
    table = counted.groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    return CharModel(table["gram"].to_numpy(), table["n"].to_numpy())


def held_out(id_col: str = "doc_id") -> Column:
    """Whether the CRC-32 of the id as text is divisible by five; never used for training."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, rows: int) -> DataFrame:
    """(text, toxic) of the labelled rows that train: a sample of bounded size, by hash of the id."""
    usable = labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    one = usable.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    sample = one.orderBy(F.xxhash64("id"), "id").limit(rows)
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    found = texts.join(F.broadcast(sample), "id").select("text", "toxic")
    sketched, path = store(found.mapInArrow(sketch, "text string, toxic int, minima array<long>"), "training")
    distinct = sketched
    for i in range(SKETCH):
        first = F.row_number().over(Window.partitionBy(F.col("minima")[i]).orderBy(F.xxhash64("text"), "text", "toxic"))
        distinct = distinct.withColumn("first", first).where("first = 1")
    kept, _ = store(distinct.select("text", "toxic"), "training")
    release(docs.sparkSession, path)
    return kept


def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds minima of the shingles of each text (column 0); a text without any gets some of its own."""
    for batch in batches:
        rows = []
        for text in batch.column(0).to_pylist():
            shingles = set_of(text)
            if not len(shingles):
                shingles = np.array([zlib.crc32(text.encode())], np.uint64)
            rows.append((shingles * FACTORS[:SKETCH, None] + SUMMANDS[:SKETCH, None]).min(axis=1).view(np.int64))
        minima = pa.array(rows, pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.int32()), minima], names=["text", "toxic", "minima"])


def beginnings(words: set[str], wanted: set[str] | None = None) -> set[str]:
    """Beginnings of the words as "abcd*2": at least two different words begin with abcd."""
    count: dict[str, int] = {}
    for word in words:
        for size in BEGINNINGS:
            begin = word[:size]
            if len(begin) == size and (wanted is None or begin in wanted):
                count[begin] = count.get(begin, 0) + 1
    return {f"{begin}*{k}" for begin, n in count.items() for k in range(1, min(n, COUNTED) + 1)}


def doc_words(batches: Iterator[pa.RecordBatch], model: CharModel) -> Iterator[pa.RecordBatch]:
    """The features of each row with its label, about HELD of them at a time."""
    restorer = Restorer(model)
    words: list[str] = []
    toxic: list[int] = []

    def flush() -> pa.RecordBatch:
        done = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(toxic, pa.int32())], names=["word", "toxic"])
        words.clear()
        toxic.clear()
        return done

    for batch in batches:
        for text, label in zip(batch.column(0), batch.column(1), strict=True):
            found = restorer.words(text.as_py())
            found |= beginnings(found)
            words += found
            toxic += [label.as_py()] * len(found)
            if len(words) >= HELD:
                yield flush()
    yield flush()
    give_back()


def doc_features(
    batches: Iterator[pa.RecordBatch], model: CharModel, index: dict[str, int], sure: set[str]
) -> Iterator[pa.RecordBatch]:
    """Numbers of the chosen features of each row, and of those that each of its sure words has alone."""
    restorer = Restorer(model)
    wanted = begun(index)
    for batch in batches:
        rows, labels = [], []
        for text, label in zip(batch.column(0), batch.column(1), strict=True):
            words = restorer.words(text.as_py())
            whole = numbers(words, index, wanted)
            alone = [numbers({word}, index, wanted) for word in sorted(words & sure)]
            some = [whole, *(one for one in alone if one != whole)]
            rows += some
            labels += [label.as_py()] * len(some)
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32())), pa.array(labels, pa.int32())], names=["features", "toxic"])


def begun(features: Iterable[str]) -> set[str]:
    """The beginnings that some features count."""
    return {feature.partition("*")[0] for feature in features if "*" in feature}


def numbers(words: set[str], index: dict[str, int], wanted: set[str]) -> list[int]:
    return sorted(index[f] for f in (words | beginnings(words, wanted)) & index.keys())


def likelihood_ratio(rows: int, toxic_rows: int) -> Column:
    """Of a feature's presence (`toxic` of its `n` rows) against the label."""
    toxic, n = F.col("toxic"), F.col("n")
    clean_rows = rows - toxic_rows
    cells = [
        (toxic, n, toxic_rows),
        (n - toxic, n, clean_rows),
        (toxic_rows - toxic, rows - n, toxic_rows),
        (clean_rows - n + toxic, rows - n, clean_rows),
    ]
    ratio = F.lit(0.0)
    for seen, margin, column in cells:
        expected = margin * F.lit(column / rows)
        ratio = ratio + F.when(seen > 0, 2 * seen * F.ln(seen / expected)).otherwise(0.0)
    return ratio


def fit(features: list[list[int]], toxic: np.ndarray, size: int) -> tuple[float, np.ndarray]:
    """Bias and weights of a logistic regression with a quadratic penalty, by Newton steps on the
    diagonal with halving."""
    rows = np.repeat(np.arange(len(features)), [len(f) for f in features])
    columns = np.array([i for f in features for i in f], np.int64)
    penalty = 0.05
    share = (toxic.sum() + 1) / (len(toxic) + 2)
    bias, weights = math.log(share / (1 - share)), np.zeros(size)

    def loss(b: float, w: np.ndarray) -> tuple[float, np.ndarray]:
        z = b + np.bincount(rows, w[columns], len(toxic))
        return float(np.logaddexp(0, z).sum() - (z * toxic).sum() + penalty * (w @ w) / 2), z

    now, z = loss(bias, weights)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(z, -35, 35)))
        error, curve = p - toxic, p * (1 - p)
        grad = np.bincount(columns, error[rows], size) + penalty * weights
        second = np.bincount(columns, curve[rows], size) + penalty
        step_b, step = error.sum() / (curve.sum() + 1e-9), grad / second
        scale = 1.0
        while scale > 1e-4:
            then, z_then = loss(bias - scale * step_b, weights - scale * step)
            if then < now:
                break
            scale /= 2
        if scale <= 1e-4 or now - then < 1e-7 * abs(now):
            break
        bias, weights, now, z = bias - scale * step_b, weights - scale * step, then, z_then
    return bias, weights


class ToxicityModel:
    def __init__(self, chars: CharModel, bias: float, weights: dict[str, float]):
        self.chars, self.bias, self.weights = chars, bias, weights
        self.beginnings = begun(weights)

    def scores(self, texts: list[str | None], restorer: Restorer) -> list[float]:
        out = []
        for text in texts:
            words = restorer.words(text or "")
            found = (words | beginnings(words, self.beginnings)) & self.weights.keys()
            z = self.bias + sum(self.weights[f] for f in sorted(found))
            out.append(1 / (1 + math.exp(-max(-35.0, min(35.0, z)))))
        return out


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS
) -> ToxicityModel:
    chars = char_model(docs, text_col)
    sample = training_rows(docs, labels, id_col, text_col, rows)
    spread = sample.repartition(docs.sparkSession.sparkContext.defaultParallelism)
    count, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not count:
        return ToxicityModel(chars, -35.0, {})
    shared = docs.sparkSession.sparkContext.broadcast(chars)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return doc_words(batches, shared.value)

    words = spread.mapInArrow(find, "word string, toxic int").groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.count("*").alias("n")
    )
    share = toxic / count
    telling = words.where((F.col("toxic") >= LEAST_ROWS) & (F.col("toxic") > F.col("n") * (share + 1) / 2))
    table = telling.where(likelihood_ratio(count, toxic) >= LEAST_RATIO).orderBy("word").toPandas()
    index = {w: i for i, w in enumerate(table["word"])}
    # two rows of either label more, as for a share two deviations below the one seen
    certain = table["toxic"] / (table["n"] + 4) >= SURE
    sure = {w for w in table["word"][certain] if "*" not in w}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return doc_features(batches, shared.value, index, sure)

    data = spread.mapInArrow(encode, "features array<int>, toxic int").toPandas()
    bias, weights = fit([list(f) for f in data["features"]], data["toxic"].to_numpy(float), len(index))
    return ToxicityModel(chars, bias, dict(zip(index, weights.tolist(), strict=True)))


def with_scores(docs: DataFrame, model: ToxicityModel, name: str = "score", text_col: str = "text") -> DataFrame:
    """All columns of the documents and their score, 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        restorer = Restorer(shared.value.chars)
        for some in texts:
            yield pd.Series(shared.value.scores(some.tolist(), restorer), dtype="float64")
        restorer = some = None
        give_back()

    return docs.withColumn(name, score(text_of(text_col)))


def drop_toxic(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: float = 0.5
) -> DataFrame:
    """The documents that score below the limit, all columns as they are."""
    name = free_name(docs, "toxicity")
    scored = with_scores(docs, train(docs, labels, id_col, text_col), name, text_col)
    return scored.where(F.col(name) < limit).select(docs.columns)
