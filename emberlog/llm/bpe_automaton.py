"""Operator 10, BPE encoding and decoding: a tokenization automaton.

The automaton reads tokens and accepts exactly the token sequences that the
merge rules produce.  It starts as one state with a loop for every byte.  The
rules are applied to it in order, each by one merge gadget: for a rule
``a b -> ab``, the state that ``a`` leads to is split off and loses its arc
``b``; wherever ``a`` could be read and then ``b``, there is now an arc ``ab``
to where ``b`` led.  Every arc with one label leads to one state, so a state is
kept as its parent at the split, the rule at which it was split off, and the
arcs it lost since; whether a state has an arc follows from the rules on the
label's left side.  The answers are kept as a transition table.

A word has one accepted path, and each prefix of it is the path of that
prefix.  Encoding therefore goes through the word once, byte position by
position, following the arcs whose labels come next.  Decoding emits the
labels of the ids.

``encode_documents`` gives the ids of every whole text; ``decode_column`` the
texts of ids.  Texts are cut, pre-split and cached as in ``tokens``; the
strings of special tokens become their ids, as in the tokenizer's library.

Edge cases: null and empty texts have no ids and decode to the empty text;
rows repeated exactly and null doc_ids stay, one result row for each; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from . import tokens
from .common import prepare, steps

# Fixed value: the pattern of byte-level vocabularies that splits a text before merges.
PRE_SPLIT = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
WORDS_KEPT = 200_000
ARCS_KEPT = 1_000_000
NEVER = 1 << 30


class Automaton:
    """``labels``: bytes by token id; ``merges``: (left, right, merged) ids in rule order."""

    def __init__(self, labels: dict[int, bytes], merges: list[tuple[int, int, int]]):
        self.labels = labels
        self.left: dict[int, tuple[int, int]] = {}
        merged = {c for _, _, c in merges}
        if len(merged) < len(merges):
            raise ValueError("two rules make the same token")
        base = [t for t, label in labels.items() if len(label) == 1 and t not in merged]
        self.parent, self.split_at, self.lost = [-1], [NEVER], [{}]
        self.state = dict.fromkeys(base, 0)
        self._shared = [len(base) + 1]  # labels that lead to each state; 0 is also the start
        for rank, (a, b, c) in enumerate(merges):
            self._gadget(rank, a, b, c)
        self._arcs: dict[int, bool] = {}
        self._words: dict[bytes, list[int]] = {}
        self._trie: dict = {}
        for token in self.state:
            node = self._trie
            for byte in labels[token]:
                node = node.setdefault(byte, {})
            node[-1] = token

    def _gadget(self, rank: int, a: int, b: int, c: int) -> None:
        if a not in self.state or b not in self.state or not self.has_arc(self.state[a], b):
            return  # no text ever gets to this rule
        after_a, after_b = self.state[a], self.state[b]
        self.left[c] = a, rank
        self.state[c] = after_b
        self._shared[after_b] += 1
        if self._shared[after_a] > 1:
            self._shared[after_a] -= 1
            self.parent.append(after_a)
            self.split_at.append(rank)
            self.lost.append({})
            self._shared.append(1)
            self.state[a] = after_a = len(self.parent) - 1
        self.lost[after_a].setdefault(b, rank)

    def _lost_at(self, state: int, label: int) -> int:
        """The rule at which the state lost the arc (NEVER: it did not)."""
        limit = NEVER
        while state >= 0:
            rank = self.lost[state].get(label, NEVER)
            if rank < limit:
                return rank
            limit = min(limit, self.split_at[state])
            state = self.parent[state]
        return NEVER

    def has_arc(self, state: int, label: int) -> bool:
        """An arc exists if its left side was there when its rule came, and it was not lost since."""
        made = NEVER
        while True:
            lost = self._lost_at(state, label)
            if lost != NEVER and lost <= made:
                return False
            if label not in self.left:
                return True
            label, made = self.left[label]

    def encode(self, word: bytes) -> list[int]:
        """The labels of the accepted path over ``word``."""
        known = self._words.get(word)
        if known is not None:
            return known
        n, arcs, state = len(word), self._arcs, self.state
        at: list = [None] * (n + 1)
        came: list = [0] * (n + 1)
        at[0] = 0
        for i in range(n):
            here, node, j = at[i], self._trie, i
            while j < n and (node := node.get(word[j])) is not None:
                j += 1
                token = node.get(-1)
                if token is None or at[j] is not None:
                    continue
                key = here << 20 | token
                ok = arcs.get(key)
                if ok is None:
                    if len(arcs) >= ARCS_KEPT:
                        arcs.clear()
                    ok = arcs[key] = self.has_arc(here, token)
                if ok:
                    at[j], came[j] = state[token], token
        out = []
        while n:
            out.append(came[n])
            n -= len(self.labels[came[n]])
        out.reverse()
        if len(self._words) >= WORDS_KEPT:
            self._words.clear()
        self._words[word] = out
        return out


@lru_cache(2)
def load(path: str) -> tuple[Automaton, dict[str, int], pa.Array]:
    """The automaton of a byte-level vocabulary file, its special strings, and the labels by id."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    byte_of = {ord(c): b for b, c in tokens.byte_letters().items()}
    vocabulary = spec["model"]["vocab"]
    labels = {i: t.translate(byte_of).encode("latin-1") for t, i in vocabulary.items()}
    pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
    merges = [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in pairs]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    emitted = labels | {i: t.encode() for t, i in special.items()}
    by_id = pa.array([emitted.get(i, b"") for i in range(max(emitted) + 1)], pa.large_binary())
    return Automaton(labels, merges), special, by_id


def chunk_encoder(path: str) -> tuple:
    """``chunk -> ids`` by the automaton, and whether marks may be cut off words."""
    automaton, special, _ = load(path)
    cut = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None

    def encode(chunk: str) -> list[int]:
        out: list[int] = []
        for part in cut.split(chunk) if cut and cut.search(chunk) else [chunk]:
            if part in special:
                out.append(special[part])
            else:
                for word in PRE_SPLIT.findall(part):
                    out += automaton.encode(word.encode())
        return out

    return encode, tokens.cuts_marks(list(special))


def encode_column(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in one array, and where each text's ids begin (with the end)."""
    return tokens.encode_column(texts, tokens.worker_cache(("automaton", path), lambda: chunk_encoder(path)))


def joined(pieces: pa.Array, starts: np.ndarray, separator: bytes) -> list[bytes]:
    """``separator.join`` over each run of ``pieces``."""
    lists = pa.LargeListArray.from_arrays(pa.array(starts, pa.int64()), pieces)
    return pc.binary_join(lists, pa.scalar(separator, pieces.type)).to_pylist()


def decode_column(ids: np.ndarray, starts: np.ndarray, path: str) -> list[str]:
    """The texts of runs of ids: the labels one after another, as UTF-8 with replacement."""
    labels = load(path)[2].take(pa.array(ids))
    return [text.decode("utf-8", "replace") for text in joined(labels, starts, b"")]


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, "text"):
                ids, starts = encode_column(step.column("text"), path)
                lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([step.column("doc_id"), lists], names=["doc_id", "ids"])
    return run


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array of int) of every whole text."""
    prepare(docs.sparkSession)
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return rows.mapInArrow(_encode(path), "doc_id long, ids array<int>")


def _round_trip(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decimals = pa.array([str(i) for i in range(len(load(path)[2]))], pa.large_binary())
        for batch in batches:
            for step in steps(batch, "text"):
                ids, starts = encode_column(step.column("text"), path)
                listed = joined(decimals.take(pa.array(ids)), starts, b",")
                yield pa.RecordBatch.from_arrays([
                    step.column("doc_id"),
                    pa.array(np.diff(starts)),
                    pa.array([hashlib.sha256(x).hexdigest() for x in listed]),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decode_column(ids, starts, path)]),
                ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the text decoded from them."""
    prepare(docs.sparkSession)
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return rows.mapInArrow(_round_trip(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
