"""Whole texts encoded with a tokenizer of the `tokenizers` library, chunk by chunk.

A text is cut at blanks where no token of its tokenizer can reach across, and the ids of a chunk are
remembered, so the library sees a chunk once while it is remembered. The ids are those of the whole
text. Two rules where to cut are known here:

* `keeps_blanks=True`, byte-level vocabularies: a single blank between two characters that are no
  white space starts a new piece of the splitting pattern, so the cut lies before that blank; a single
  line feed between two such characters is a piece of its own.
* `keeps_blanks=False`, vocabularies whose splitting pattern drops white space and whose normaliser
  writes lower case: any blank or line feed.
"""

from __future__ import annotations

import gc
import os
import re
from array import array
from itertools import accumulate, chain

import numpy as np

#: No more chunks are remembered in one Python worker beyond these; frequent ones come early. A hundred
#: thousand take 25 to 40 MB.
REMEMBERED = 300_000

#: A blank between two characters that are no white space (Python's notion, the stricter one).
CUT = re.compile(r"(?<=\S) (?=\S)")

#: Letters up to here are precomposed and have one-letter lower case forms.
LATIN = "ɐ"

#: How byte-level vocabularies write bytes: printable Latin-1 as itself, the rest from U+0100 on.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
WRITTEN = {b: chr(b) for b in PRINTABLE} | {
    b: chr(0x100 + n) for n, b in enumerate(b for b in range(256) if b not in PRINTABLE)
}

_encoders: dict[tuple[str, bool], ChunkEncoder] = {}


def encoder(path: str, keeps_blanks: bool, remembered: int = REMEMBERED) -> ChunkEncoder:
    """The encoder of this Python worker for a tokenizer file."""
    if (path, keeps_blanks) not in _encoders:
        _encoders[path, keeps_blanks] = ChunkEncoder(path, keeps_blanks, remembered)
    _encoders[path, keeps_blanks].remembered = remembered
    return _encoders[path, keeps_blanks]


def forget() -> None:
    """Drop the encoders of this Python worker: it is kept for tasks of other operators, and so would they be."""
    _encoders.clear()


class ChunkEncoder:
    def __init__(self, path: str, keeps_blanks: bool, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.keeps_blanks = keeps_blanks
        self.remembered = remembered
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.memory: dict[str, bytes] = {}
        self.marks = {m: self.plain(m) for m in ".,"}
        self.feed = self.plain("\n")

    def plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def word(self, letters: str, after_feed: bool = False) -> bytes:
        """Ids of Latin letters alone, which the splitting pattern leaves in one piece."""
        if self.keeps_blanks:
            written = letters if after_feed else " " + letters
        else:
            written = letters.lower()
        if letters.isascii():
            written = written.replace(" ", WRITTEN[0x20])
        else:
            written = written.encode().decode("latin1").translate(WRITTEN)
        return array(self.dtype.char, [t.id for t in self.model.tokenize(written)]).tobytes()

    def learn(self, chunks: set[str]) -> dict[str, bytes]:
        """Ids of chunks that stand alone: words, with a mark or without, by the tokenizer's model,
        the others by the whole tokenizer."""
        known, others = {}, []
        for chunk in chunks:
            mark = chunk[-1:] if chunk[-1:] in self.marks else ""
            letters = chunk[:-1] if mark else chunk
            after_feed = letters[:1] == "\n"
            if after_feed:
                letters = letters[1:]
            if letters.isalpha() and (letters.isascii() or max(letters) < LATIN and "İ" not in letters):
                if after_feed:
                    ids = self.feed + self.word(letters, after_feed)
                else:
                    ids = self.memory.get(letters) or self.word(letters)
                known[chunk] = ids + self.marks[mark] if mark else ids
            elif self.alone(chunk):
                others.append(chunk)
        if others:
            led = [" " + c if self.keeps_blanks and c[0] != "\n" else c for c in others]
            encodings = self.tokenizer.encode_batch_fast(led, add_special_tokens=False)
            ids = [e.ids for e in encodings]
            ends = [0, *accumulate(len(i) * self.dtype.itemsize for i in ids)]
            raw = np.fromiter(chain.from_iterable(ids), self.dtype).tobytes()
            known.update((c, raw[a:b]) for c, a, b in zip(others, ends, ends[1:], strict=False))
        return known

    def alone(self, chunk: str) -> bool:
        """Whether its ids are the same wherever the chunk stands between two cuts."""
        if not self.keeps_blanks:
            return True
        inner = chunk[1:] if chunk[:1] == "\n" else chunk
        return bool(inner) and not inner[0].isspace() and not inner[-1].isspace()

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of each text, without any end id."""
        collecting = gc.isenabled()
        gc.disable()  # millions of small objects, no cycles
        try:
            return self._encode_all(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode_all(self, texts: list[str]) -> list[bytes]:
        if self.keeps_blanks:  # a chunk that begins with a line feed had no blank before it
            parts = [t.replace("\n", " \n").split(" ") for t in texts]
        else:
            flat = [t.replace("\n", " ") for t in texts]
            # added tokens match raw text only
            parts = [(t.lower() if t.isascii() and "<|" not in t else t).split(" ") for t in flat]
        memory = self.memory
        heads = [p.pop(0) for p in parts] if self.keeps_blanks else [""] * len(parts)
        found = [list(map(memory.get, p)) for p in parts]
        holes = [(p, f, [k for k, ids in enumerate(f) if ids is None]) for p, f in zip(parts, found, strict=True) if None in f]
        if holes:
            extra = self.learn({p[k] for p, _, gaps in holes for k in gaps})
            if len(memory) < self.remembered:
                memory.update(extra)
            for p, f, gaps in holes:
                for k in gaps:
                    f[k] = extra.get(p[k])
        out = []
        for text, head, f in zip(texts, heads, found, strict=True):
            if None in f or head and head[-1].isspace():
                out.append(self.encode_cut(text))
            else:
                out.append((self.plain(head) if head else b"") + b"".join(f))
        return out

    def encode_cut(self, text: str) -> bytes:
        """For texts with runs of white space: cut only where a single blank stands alone."""
        if not self.keeps_blanks:
            return self.plain(text)
        pieces = CUT.split(text)
        return b"".join([self.plain(pieces[0]), *(self.plain(" " + p) for p in pieces[1:])])
