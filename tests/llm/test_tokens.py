"""Chunked encoding, token records, packing and token counts."""

from __future__ import annotations

import os
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex

from tests.llm.conftest import odd_rows
from tidemark.llm import packing
from tidemark.llm.chunks import ChunkEncoder
from tidemark.llm.packing import PIECES_ARROW, pack, pack_documents, pack_partition, some_texts
from tidemark.llm.records import frame, read_at, read_records, unframe, write_records
from tidemark.llm.token_counts import TokenCounter, read_ranks, token_counts, zipf_scores

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module", params=[(BYTES, True), (WORDS, False)])
def encode(request):
    return ChunkEncoder(*request.param)


def test_chunks_give_the_ids_of_the_whole_text(encode):
    made = random.Random(3)
    texts = ["", " ", "  a", "a ", "\n\na", "don't  'x'", "a\tb c  d", "x" * 80 + " " * 7, "日本 語　テ", "İ Σς ẞ ﬁ é é", "a\x1cb \x1cc", "<|endoftext|> a<|endoftext|>"]
    texts += ["".join(made.choice("ab'. \n\té1 $Ñ,") for _ in range(made.randint(0, 40))) for _ in range(500)]
    texts += [t or "" for _, t, *_ in odd_rows()]
    whole = [e.ids for e in encode.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):  # unknown, then remembered
        assert [np.frombuffer(b, encode.dtype).tolist() for b in encode.encode_all(texts)] == whole


def test_special_tokens_in_other_cases_are_plain_text(encode):
    texts = ["<|EndOfText|>", "Two <|ENDOFTEXT|> and a<|StartOfText|>b", "Plain <|endoftext|> Text <|EndOfText|>", "<|endoftext|>", "Text <|"]
    whole = [e.ids for e in encode.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for several in (texts, texts[::-1]):
        assert [np.frombuffer(b, encode.dtype).tolist() for b in encode.encode_all(several)] == (whole if several is texts else whole[::-1])


def ids_of(path, text, end=2):
    return ChunkEncoder(path, False).tokenizer.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_frames_detect_damage():
    data = frame(b"abc") + frame(b"")
    payload, at = unframe(data, 0)
    assert bytes(payload) == b"abc" and bytes(unframe(data, at)[0]) == b""
    for i in range(len(frame(b"abc"))):
        bad = bytearray(data)
        bad[i] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            unframe(bytes(bad), 0)


def test_records_of_odd_rows(odd, nothing, tmp_path):
    manifest = write_records(odd, str(tmp_path / "r"), BYTES, 2, shards=3)
    back = read_records(manifest).collect()
    back.sort(key=lambda r: r.start)
    order = [r.doc_id for r in back]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    start, seen = 0, []
    for r in back:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == start and r.n_tokens == len(ids)
        start += len(ids)
        seen.append((r.doc_id, tuple(ids)))
    key = lambda row: (str(row[0]), row[1])
    assert sorted(seen, key=key) == sorted(((i, tuple(ids_of(BYTES, t))) for i, t, *_ in odd_rows()), key=key)
    files = manifest.collect()
    assert sum(f.tokens for f in files) == start and sum(f.records for f in files) == len(back)
    index = np.fromfile(files[0].index_path, "<i8").reshape(-1, 4)
    for offset, size, n, _ in index.tolist():
        number, ids = read_at(files[0].path, offset, size)
        assert len(ids) == n and (number, tuple(ids.tolist())) in seen
    empty = write_records(nothing, str(tmp_path / "none"), BYTES, 2)
    assert read_records(empty).count() == 0 and not os.path.exists(tmp_path / "none")


def test_pack_respects_capacity_and_covers_all():
    made = random.Random(1)
    for capacity in (1, 7, 64):
        lengths = [made.randint(1, 200) for _ in range(60)]
        pieces, sequences = pack(lengths, capacity, 1.0, 0.1)
        for doc, length in enumerate(lengths):
            at = 0
            for _, start, n, *_ in sorted(p for p in pieces if p[0] == doc):
                assert start == at and n > 0
                at += n
            assert at == length
        used = {}
        for _, _, n, sequence, offset in sorted(pieces, key=lambda p: (p[3], p[4])):
            assert used.get(sequence, 0) == offset
            used[sequence] = offset + n
        assert sorted(used) == list(range(sequences)) and max(used.values()) <= capacity
        assert sequences == -(-sum(lengths) // capacity)


def test_costs_are_balanced():
    made = random.Random(2)
    lengths = [made.randint(10, 900) for _ in range(2000)]
    pieces, sequences = pack(lengths, 4096, 1.0, 1 / 4096)
    cost = [0.0] * sequences
    for _, _, n, sequence, _ in pieces:
        cost[sequence] += n + n * n / 4096
    assert np.std(cost[:-1]) / np.mean(cost) < 0.05


def test_packing_odd_rows(odd, nothing):
    rows = pack_documents(odd, WORDS, 2, window_tokens=3000).collect()
    texts = {}
    for i, t, *_ in odd_rows():
        texts.setdefault(i, []).append(ids_of(WORDS, t))
    used = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert used.get(r.sequence_id, 0) == r.offset
        used[r.sequence_id] = r.offset + r.length
        assert any(
            r.doc_tokens == len(ids) and r.ids_crc32 == crc(ids[r.start : r.start + r.length]) for ids in texts[r.doc_id]
        )
    assert max(used.values()) <= 4096
    assert sum(used.values()) == sum(len(ids) for all_ids in texts.values() for ids in all_ids)
    assert pack_documents(nothing, WORDS, 2).count() == 0


def best(word: bytes, scores) -> tuple[float, int]:
    """Score and tokens of the most probable segmentation, over all prefixes anew."""
    table = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        options = [
            (table[b][0] + scores[word[b:end]], -(table[b][1] + 1)) for b in range(end) if word[b:end] in scores
        ]
        score, tokens = max(options)
        table.append((score, -tokens))
    return table[-1]


def test_token_counts(odd, nothing):
    scores = zipf_scores(read_ranks(RANKS))
    found = token_counts(odd, RANKS, public_tokenizers.PATTERN)
    rows = sorted((tuple(r) for r in found.collect()), key=str)
    expected = []
    for i, t, *_ in odd_rows():
        words = regex.findall(public_tokenizers.PATTERN, t or "")
        done = [best(w.encode(), scores) for w in words]
        expected.append((i, len((t or "").encode()), len(words), sum(n for _, n in done), sum(s for s, _ in done)))
    for a, b in zip(rows, sorted(expected, key=str), strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4])
    assert token_counts(nothing, RANKS, public_tokenizers.PATTERN).count() == 0


def test_prefixes_are_scored_once():
    scores = {bytes([b]): -5.0 for b in range(256)} | {b"ab": -3.0, b"abc": -9.0, b"bcd": -4.0}
    counter = TokenCounter(scores, r"\S+")
    counter.learn({"ab", "abc", "abcd", "abce", "b"})
    assert counter.known == {w: best(w.encode(), scores)[::-1] for w in ("ab", "abc", "abcd", "abce", "b")}


def test_texts_are_taken_in_order_a_few_at_a_time():
    texts = ["ab", "", "c" * 9, "d", "e", "", "fgh", "i"]
    groups = list(some_texts(texts, 4))
    assert groups == [["ab", "", "c" * 9], ["d", "e", "", "fgh"], ["i"]]
    assert list(some_texts([], 4)) == [] and list(some_texts(["", ""], 4)) == [["", ""]]


def test_packing_cuts_few_texts_at_a_time(monkeypatch):
    """A chunk is an object while its text is worked on, so a whole Arrow batch is not cut at once."""
    seen, encode = [], ChunkEncoder(WORDS, False)

    class Recorder:
        dtype = encode.dtype

        def encode_all(self, texts):
            seen.append(sum(map(len, texts)))
            return encode.encode_all(texts)

    class Context:
        @staticmethod
        def get():
            return Context

        @staticmethod
        def partitionId():
            return 0

    monkeypatch.setattr(packing, "encoder", lambda *_: Recorder())
    monkeypatch.setattr(packing, "TaskContext", Context)
    texts = [f"{i % 7} some words " * 3_500 for i in range(90)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(90)), pa.array(texts)], names=["id", "text"])
    done = list(pack_partition(iter([batch]), WORDS, 2, 4096, 1.0, 1 / 4096, 2_000_000, False, 10, 1_000_000))
    assert {b.schema for b in done} == {PIECES_ARROW} and sum(b.num_rows for b in done) >= 90
    assert sum(seen) == sum(map(len, texts)) > 4_000_000
    assert max(seen) < 1_000_000 + max(map(len, texts))


def test_remembering_fewer_chunks_packs_the_same(odd):
    frames = [pack_documents(odd, WORDS, 2), pack_documents(odd, WORDS, 2, remembered=3, cut_at_once=50)]
    whole, parts = (sorted(map(tuple, frame.collect()), key=repr) for frame in frames)
    assert whole == parts
