"""Encoding whole text columns by the distinct chunks they are made of.

Both vocabularies split a text before merging, and no pre-token crosses a
single blank or line feed that stands between two other characters, nor the
place where a letter meets the marks that end a word.  A column is therefore cut
at these places (numpy over the bytes), the chunks are dictionary-encoded
(Arrow), each distinct chunk is encoded once by the ``tokenizers`` library and
kept in a cache bounded by bytes, and the ids of the texts are gathered from the
ids of their chunks.  Places where two white-space characters meet are never
cut, so the library sees such runs whole.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from .common import text_column

# The cache of a worker: two generations of so many bytes each.  Chunks longer
# than KEPT_CHUNK (texts without blanks, mostly) are encoded anew.
CACHE_BYTES = 96 << 20
ENTRY_BYTES = 200  # what an entry takes besides its texts
KEPT_CHUNK = 64
GATHER_CHUNKS = 1 << 20

# ASCII white space, the separators 0x1C-0x1F (cut conservatively), and the
# lead bytes of all other white-space characters.
_SPACE = np.zeros(256, bool)
_SPACE[[*range(9, 14), *range(28, 33)]] = True
_LEAD = np.zeros(256, bool)
_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_AFTER = _SPACE | _LEAD

# Marks that may end a word; runs longer than MARKS_CUT stay with it.
MARKS = ".,;:!?%*#$&"
MARKS_CUT = 8
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in MARKS]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True

_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(f" ?[{_LATIN}]+")


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in printable}
    rest = [b for b in range(256) if b not in out]
    return out | {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTERS = byte_letters()


def letters(text: str) -> str:
    """The bytes of ``text`` as the letters used in byte-level vocabularies."""
    return text.encode().decode("latin-1").translate(_LETTERS)


def _word_ends(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where chunks that end in marks have their last letter before: the marks begin there."""
    ending = _MARK[data[ends - 1]]
    starts, at = starts[ending], ends[ending] - 1
    for _ in range(MARKS_CUT):
        more = (at > starts) & _MARK[data[np.maximum(at - 1, 0)]]
        if not more.any():
            break
        at = at - more
    before, before2 = data[np.maximum(at - 1, 0)], data[np.maximum(at - 2, 0)]
    accented = (before >= 0x80) & (before < 0xC0) & (before != 0x97) & (before != 0xB7) & (before2 == 0xC3) & (at - 2 >= starts)
    return at[(at > starts) & (_LETTER[before] | accented)]


def chunk_column(texts: pa.LargeStringArray, marks: bool = True) -> tuple[pa.LargeStringArray, np.ndarray]:
    """All chunks of a column in order, and the first chunk of each text (with the end)."""
    offsets = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset:texts.offset + len(texts) + 1]
    lo, n = int(offsets[0]), int(offsets[-1] - offsets[0])
    ends = offsets - lo
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8, n, lo) if n else np.zeros(0, np.uint8)
    edge = np.zeros(n + 1, bool)
    edge[ends] = True
    cut = np.zeros(n + 1, bool)
    cut[ends] = True

    def clean(at: np.ndarray) -> np.ndarray:
        before, before2, before3 = (data[np.maximum(at - k, 0)] for k in (1, 2, 3))
        tail = (before >= 0x80) & (before < 0xC0) & ((before2 == 0xC2) | _LEAD[before3])
        after = data[np.minimum(at + 1, n - 1)]
        return at[(edge[at] | ~(_SPACE[before] | tail)) & (edge[at + 1] | ~_AFTER[after])]

    cut[clean(np.flatnonzero(data == 32))] = True
    feeds = clean(np.flatnonzero(data == 10))
    cut[feeds] = True
    cut[feeds + 1] = True
    starts = np.flatnonzero(cut[:n])
    if marks and len(starts):
        cut[_word_ends(data, starts, np.append(starts[1:], n))] = True
        starts = np.flatnonzero(cut[:n])
    bounds = np.append(starts, n) + lo
    chunks = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds.astype("<i8")), buffer)
    return chunks, np.searchsorted(starts, ends)


class ChunkCache(dict):
    """Distinct chunk -> its ids (unsigned 32-bit, little endian).

    Two generations: what is used moves to the younger one, and ``trim`` (between
    steps) lets the older one go when the younger is full.  ``marks``: whether
    chunks may be cut before the marks that end a word.
    """

    def __init__(self, encode, marks: bool = True):
        super().__init__()
        self.encode, self.marks = encode, marks
        self.older: dict = {}
        self.held = 0

    def __missing__(self, chunk):
        out = self.older.get(chunk)
        if out is None:
            out = array("I", self.encode(chunk)).tobytes()
            if len(chunk) > KEPT_CHUNK:
                return out
        self[chunk] = out
        self.held += len(chunk) + len(out) + ENTRY_BYTES
        return out

    def trim(self) -> None:
        if self.held > CACHE_BYTES:
            self.older, self.held = dict(self), 0
            self.clear()


def cuts_marks(special: list[str]) -> bool:
    """No special string holds a mark, so cutting before marks keeps them whole."""
    return not any(c in MARKS for text in special for c in text)


def library_encoder(path: str, word_ends: bool) -> tuple:
    """``chunk -> ids`` by the ``tokenizers`` library, and whether marks may be cut off.

    A chunk of one plain word goes straight to the library's merge model (it is
    evidently one pre-token); every other chunk goes through the whole chain.
    """
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    model = tokenizer.model

    def encode(chunk: str) -> list[int]:
        if _PLAIN.fullmatch(chunk) is None:
            return tokenizer.encode(chunk, add_special_tokens=False).ids
        return [t.id for t in model.tokenize(letters(chunk.lstrip(" ").lower() if word_ends else chunk))]

    return encode, cuts_marks([t.content for t in tokenizer.get_added_tokens_decoder().values()])


_CACHES: dict[tuple, ChunkCache] = {}


def worker_cache(key: tuple, build) -> ChunkCache:
    """The cache of this Python worker for ``key``; ``build()`` gives its ``chunk -> ids`` and whether marks may be cut off."""
    if key not in _CACHES:
        _CACHES[key] = ChunkCache(*build())
    return _CACHES[key]


def library_cache(path: str, word_ends: bool = False) -> ChunkCache:
    return worker_cache(("library", path, word_ends), lambda: library_encoder(path, word_ends))


def spread(values: np.ndarray, starts: np.ndarray, counts: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The runs ``values[starts[i]:starts[i] + counts[i]]`` for i in ``index``, one after another."""
    parts = []
    for at in range(0, len(index), GATHER_CHUNKS):
        i = index[at:at + GATHER_CHUNKS]
        n = counts[i]
        ends = np.cumsum(n)
        shift = np.repeat(starts[i] - (ends - n), n)
        parts.append(values[shift + np.arange(len(shift))])
    return np.concatenate(parts) if parts else values[:0]


def encode_column(texts: pa.Array, cache: ChunkCache) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in one array, and where each text's ids begin (with the end)."""
    chunks, first = chunk_column(text_column(texts), cache.marks)
    coded = chunks.dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False)
    cache.trim()
    known = list(map(cache.__getitem__, coded.dictionary.to_pylist()))
    counts = np.fromiter(map(len, known), np.int64, len(known)) // 4
    values = np.frombuffer(b"".join(known), "<u4")
    ids = spread(values, np.cumsum(counts) - counts, counts, index)
    ends = np.concatenate([[0], np.cumsum(counts[index])]) if len(index) else np.zeros(1, np.int64)
    return ids, ends[first]
