"""Token counts under a unigram model, by dynamic programming that shares prefixes.

A pre-token's count is that of its most probable segmentation into pieces of the vocabulary. A piece's
log-probability follows Zipf's law from its rank in the file, since the file holds no probabilities and no
tokenizer is trained here. Distinct pre-tokens that are not yet known are walked in the order of a trie
(sorted, so that a pre-token shares the path of the one before up to their common prefix): the
forward score and count of a prefix are computed once for all pre-tokens that begin with it, and those at a
terminal are stored.

Documents are read where they lie: nothing is shuffled, a task remembers a bounded number of pre-tokens,
and its memory is that of a batch.

Defined cases: a null or empty text has no token; texts of any length are counted whole; of segmentations with equal scores the one with
fewer tokens counts. Every single byte must be a piece, so each pre-token has a segmentation. Ids are
passed through as they are, repeated or null. An empty table gives an empty result. Other columns are
not looked at.
"""

from __future__ import annotations

import base64
import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_of
from tidemark.llm.records import text_batches

#: Pre-tokens remembered in a Python worker; beyond it the memory starts anew.
REMEMBERED = 500_000

COUNTS = "id {kind}, n_bytes long, n_pretokens long, n_tokens long, log_probability double"

_counters: dict[tuple[str, str], TokenCounter] = {}


def zipf_scores(ranks: dict[bytes, int]) -> dict[bytes, float]:
    """Log-probabilities that fall with the inverse of the rank."""
    total = math.log(sum(1 / (r + 1) for r in ranks.values()))
    return {piece: -math.log(rank + 1) - total for piece, rank in ranks.items()}


def read_ranks(path: str) -> dict[bytes, int]:
    """Pieces and ranks of a file with a base64 piece and its rank on every line."""
    with open(path, "rb") as file:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}


class TokenCounter:
    def __init__(self, scores: dict[bytes, float], pattern: str):
        self.scores = scores
        self.longest = max(map(len, scores))
        self.split = regex.compile(pattern).findall
        self.known: dict[str, tuple[int, float]] = {}

    def learn(self, words: set[str]) -> None:
        """Counts and scores of pre-tokens, along the paths of their trie."""
        scores, longest = self.scores, self.longest
        path = b""
        best, count = [0.0], [0]  # forward score and tokens of each prefix of the path
        for word in sorted(w.encode("utf-8", "surrogatepass") for w in words):
            shared = 0
            for a, b in zip(path, word, strict=False):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :], count[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                top, tokens = -math.inf, 0
                for begin in range(max(0, end - longest), end):
                    score = scores.get(word[begin:end])
                    if score is not None:
                        score += best[begin]
                        if score > top or score == top and count[begin] + 1 < tokens:
                            top, tokens = score, count[begin] + 1
                best.append(top)
                count.append(tokens)
            path = word
            self.known[word.decode("utf-8", "surrogatepass")] = count[-1], best[-1]

    def count_all(self, texts: list[str]) -> list[tuple[int, int, float]]:
        """Pre-tokens, tokens and log-probability of each text."""
        counted = [Counter(self.split(t)) for t in texts]
        known = self.known
        new = {w for words in counted for w in words if w not in known}
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = set().union(*counted)
        self.learn(new)
        out = []
        for words in counted:
            found = [(n, *known[w]) for w, n in words.items()]
            tokens = sum(n * c for n, c, _ in found)
            out.append((words.total(), tokens, math.fsum(n * s for n, _, s in found)))
        return out


def counter(path: str, pattern: str) -> TokenCounter:
    """The counter of this Python worker for a vocabulary."""
    if (path, pattern) not in _counters:
        _counters[path, pattern] = TokenCounter(zipf_scores(read_ranks(path)), pattern)
    return _counters[path, pattern]


def count_batches(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    counts = counter(path, pattern)
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
    for batch in batches:
        done = 0
        for ids, texts in text_batches(iter([batch])):
            sizes = [len(t.encode()) for t in texts]
            columns = zip(*((s, *c) for s, c in zip(sizes, counts.count_all(texts), strict=True)), strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(done, len(ids)), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["id", "n_bytes", "n_pretokens", "n_tokens", "log_probability"],
            )
            done += len(ids)


def token_counts(
    docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, n_bytes, n_pretokens, n_tokens, log_probability.

    `ranks` is a file of pieces and ranks that every executor has, `pattern` splits pre-tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return count_batches(batches, ranks, pattern)

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(count, COUNTS.format(kind=kind)).withColumnRenamed("id", id_col)
