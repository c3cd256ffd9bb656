"""Byte-pair encoding by a deterministic automaton.

The automaton runs over tokens: it accepts a sequence if and only if merging the bytes of the
sequence, in the order of the merge table, gives that very sequence. It starts as one state that
every byte leads back to. Each merge (u, v) -> w is then built in, by priority, as a *gadget*: the
state that u leads to is replaced by a copy without the arc v, and wherever u could be followed by v
there is now an arc w to where v led. An accepted path is unique, so encoding a pre-split word means
following, from each position reached, the arcs whose labels are the next bytes; decoding a path
means emitting the labels of its arcs.

A copy without one arc is kept as (original, arc): a table of as many states as merges, instead of
states times tokens arcs. Whether a state has an arc is looked up in the tables, and the answer kept.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the pattern that splits text before merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Words kept per worker with their ids, the longest of them in bytes, and arcs looked up; a full store is emptied, which changes no result.
CACHE, LONGEST, ARCS = 300_000, 256, 3_000_000


def byte_letters() -> dict[str, int]:
    """The letter by which vocabulary files write each byte: printable Latin-1 as itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class _Words(dict):
    """Ids by word, found when first asked for."""

    def __init__(self, encode):
        super().__init__()
        self._encode = encode

    def __missing__(self, word: str) -> list[int]:
        raw = word.encode()
        ids = self._encode(raw)
        if len(raw) <= LONGEST:
            if len(self) >= CACHE:
                self.clear()
            self[word] = ids
        return ids


class TokenAutomaton:
    """Compiled merges of a byte-level BPE vocabulary (the text of its ``tokenizers`` JSON file)."""

    def __init__(self, vocabulary: str | bytes):
        model = json.loads(vocabulary)["model"]
        letters = byte_letters()
        spell = lambda t: bytes(letters[c] for c in t)
        ids = model["vocab"]
        size = max(ids.values()) + 1
        self.labels: list[bytes] = [b""] * size
        singles = {}
        for token, i in ids.items():
            if all(c in letters for c in token):
                self.labels[i] = spell(token)
                if len(token) == 1:
                    singles[i] = letters[token]
        # Tokens: the rank at which each came to be, and its halves. States: what they are a copy of, the arc they lack, their rank.
        self._rank = [-1] * size
        self._left = [-1] * size
        self._copy_of, self._lacks, self._born = [-1], [-1], [-1]
        self._to = [-1] * size
        for i in singles:
            self._to[i] = 0
        for k, merge in enumerate(model["merges"]):
            u, v = merge if isinstance(merge, list) else merge.split(" ")
            self._gadget(k, ids[u], ids[v], ids[u + v])
        self._has: dict[int, bool] = {}
        self._size = size
        # A trie over the labels: node * 256 + byte -> node, and the token that ends in a node.
        self._next: dict[int, int] = {}
        self._ends = [-1]
        for i, label in enumerate(self.labels):
            if self._to[i] < 0:
                continue  # no path of merges makes it
            node = 0
            for b in label:
                key = node << 8 | b
                if key not in self._next:
                    self._next[key] = len(self._ends)
                    self._ends.append(-1)
                node = self._next[key]
            self._ends[node] = i
        self._words = _Words(self.encode_word)
        self._split = regex.compile(PATTERN)

    def _gadget(self, k: int, u: int, v: int, w: int) -> None:
        if self._to[u] < 0 or self._to[v] < 0 or self._rank[w] >= 0:
            return
        self._rank[w], self._left[w] = k, u
        self._to[w] = self._to[v]
        self._copy_of.append(self._to[u])
        self._lacks.append(v)
        self._born.append(k)
        self._to[u] = len(self._born) - 1

    def has_arc(self, state: int, token: int) -> bool:
        """Whether ``state`` has an arc ``token``. A token's arc was added to every state that had its left half's."""
        key = state * self._size + token
        known = self._has.get(key)
        if known is None:
            s, t = state, token
            while True:
                if s == 0:
                    known = True
                    break
                if self._lacks[s] == t:
                    known = False
                    break
                if self._born[s] > self._rank[t]:
                    s = self._copy_of[s]
                else:
                    t = self._left[t]
            if len(self._has) >= ARCS:
                self._has.clear()
            self._has[key] = known
        return known

    def encode_word(self, word: bytes) -> list[int]:
        """The path of ``word``: for each position the one arc by which an accepted path gets there."""
        n = len(word)
        via, where = [-1] * (n + 1), [-1] * (n + 1)
        where[0] = 0
        follow, ends, to = self._next, self._ends, self._to
        for i in range(n):
            state = where[i]
            if state < 0:
                continue
            node = 0
            for j in range(i, n):
                node = follow.get(node << 8 | word[j])
                if node is None:
                    break
                t = ends[node]
                if t >= 0 and where[j + 1] < 0 and (i == 0 or self.has_arc(state, t)):
                    via[j + 1], where[j + 1] = t, to[t]
            if where[n] >= 0:  # the one path that gets there
                break
        out, at = [], n
        while at:
            out.append(via[at])
            at -= len(self.labels[via[at]])
        return out[::-1]

    def word_ids(self, word: str) -> list[int]:
        return self._words[word]

    def words(self, text: str) -> list[str]:
        return self._split.findall(text)

    def counts(self, words: list[str]) -> list[int]:
        """The number of ids of each word."""
        return [*map(len, map(self._words.__getitem__, words))]

    def word_at(self, text: str, at: int, end: int) -> str:
        """The word that begins at ``at``, in the text up to ``end``."""
        return self._split.match(text, at, end).group()

    def encode(self, text: str | None) -> list[int]:
        """Ids of ``text``; none for an empty or null one. Names of special tokens are ordinary text."""
        return list(chain.from_iterable(map(self._words.__getitem__, self._split.findall(text)))) if text else []

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join([self.labels[i] for i in ids])

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


_compiled: dict[str, TokenAutomaton] = {}


def automaton(name: str, vocabulary: bytes) -> TokenAutomaton:
    """Compiled once a process."""
    if name not in _compiled:
        _compiled[name] = TokenAutomaton(vocabulary)
    return _compiled[name]


class Vocabulary:
    """A vocabulary file, read on the driver (a few MB, whatever the data) and sent to each executor once."""

    def __init__(self, spark, path: str):
        with open(path, "rb") as f:
            self._bytes = spark.sparkContext.broadcast(f.read())
        self.name = path

    def compiled(self) -> TokenAutomaton:
        return automaton(self.name, self._bytes.value)


def _lists(rows: list, kind: pa.DataType) -> pa.ListArray:
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    values = np.fromiter(chain.from_iterable(rows), dtype=kind.to_pandas_dtype(), count=int(offsets[-1]))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def encode_corpus(docs: DataFrame, vocabulary: Vocabulary, key: str, text: str, out: str = "ids") -> DataFrame:
    """(key, out): the ids of each text as a list of integers, [] for a null or empty text.

    Row by row in Arrow batches, no shuffle. Texts are taken whole and as they are, however long and
    in whatever script; repeated keys give repeated rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = vocabulary.compiled().encode
        for b in batches:
            for at in range(0, b.num_rows, 256):  # the ids of at most so many texts are held at once
                part = b.slice(at, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), _lists([encode(t) for t in part.column(1).to_pylist()], pa.int32())], [key, out])

    rows = docs.select(F.col(key).alias(key), F.col(text).cast("string").alias("_text"))
    return rows.mapInArrow(run, f"`{key}` {dict(rows.dtypes)[key]}, `{out}` array<int>")


def decode_corpus(ids: DataFrame, vocabulary: Vocabulary, key: str, column: str = "ids", out: str = "text") -> DataFrame:
    """(key, out): the text of each list of ids, '' for an empty or null list; bytes that are no UTF-8 become U+FFFD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = vocabulary.compiled().decode
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([decode(x or []) for x in b.column(1).to_pylist()], pa.string())], [key, out])

    rows = ids.select(key, column)
    return rows.mapInArrow(run, f"`{key}` {dict(rows.dtypes)[key]}, `{out}` string")
