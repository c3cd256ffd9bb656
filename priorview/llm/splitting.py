"""Oversized texts cut where their vocabulary changes.

A text is taken as units (sentences, lines). At each gap between units the words of the units before
and after it, a block of a fixed number of words on either side, are compared by cosine; a gap whose
similarity lies deep below the peaks on both sides marks a change of topic. Each piece ends at the
deepest valley of the window of sizes allowed for it, and the next begins a given number of tokens
before that cut.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate
from math import sqrt

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priorview.llm.tokenizer import TokenAutomaton, Vocabulary

#: A unit ends after a paragraph or line break, or after the blanks that follow a sentence's end.
UNIT_END = regex.compile(r"(?:\r\n|\n|\r| | )+|[.!?…。！？؟]++[\"'”’»)\]]*+\s++|[。！？]++[\"'”’»)\]]*+(?=\S)")
@dataclass(frozen=True)
class Sizes:
    """limit: most tokens of a piece. overlap: tokens that a piece repeats of the one before. least: share of
    the limit that a piece fills before its cut is looked for. block: words on each side of a gap."""

    limit: int = 1024
    overlap: int = 64
    least: float = 0.5
    block: int = 60


def unit_gaps(text: str) -> list[int]:
    """Offsets inside ``text`` at which a unit begins, but the first."""
    return sorted({m.end() for m in UNIT_END.finditer(text)} - {0, len(text)})


class _Terms(dict):
    """Words without the blanks and case around them; '' for those that begin with no letter or digit. Kept per worker and
    emptied when full, which changes no result."""

    def __missing__(self, word: str) -> str:
        t = word.strip().casefold()
        if not t[:1].isalnum():
            t = ""
        if len(word) <= 64:
            if len(self) >= 300_000:
                self.clear()
            self[word] = t
        return t


_terms = _Terms()


def valley_depths(words: list[str], ends: list[int], gaps: list[int], block: int) -> list[float]:
    """For each gap how far its similarity lies below the nearest peaks on both sides; ends count as gaps of similarity 0.

    words: the pre-split words of the text, with the offsets at which they end. The blocks on both sides slide from
    gap to gap: a word that enters or leaves one changes the product and the norms by its own counts.
    """
    each = [*map(_terms.__getitem__, words)]
    before = [0, *accumulate(map(bool, each))]
    number: dict[str, int] = {}
    terms = [number.setdefault(t, len(number)) for t in each if t]
    left, right = [0] * len(number), [0] * len(number)
    dot = lsq = rsq = lo = mid = hi = 0
    sims = []
    for g in gaps:
        at = before[bisect_right(ends, g)]  # a gap may lie behind the blank that begins a word
        for t in terms[hi : at + block]:
            n = right[t]
            dot += left[t]
            rsq += 2 * n + 1
            right[t] = n + 1
        for t in terms[mid:at]:
            n, m = left[t], right[t]
            dot += m - 1 - n
            rsq -= 2 * m - 1
            lsq += 2 * n + 1
            left[t], right[t] = n + 1, m - 1
        for t in terms[lo : max(lo, at - block)]:
            n = left[t]
            dot -= right[t]
            lsq -= 2 * n - 1
            left[t] = n - 1
        hi, mid, lo = max(hi, at + block), at, max(lo, at - block)
        sims.append(dot / sqrt(lsq * rsq) if lsq and rsq else 0.0)
    n = len(sims)
    lpeak, rpeak = [0.0] * n, [0.0] * n
    for i in range(n):  # climbing away from a gap as long as similarity rises
        lpeak[i] = lpeak[i - 1] if i and sims[i - 1] >= sims[i] else sims[i]
    for i in reversed(range(n)):
        rpeak[i] = rpeak[i + 1] if i + 1 < n and sims[i + 1] >= sims[i] else sims[i]
    return [lpeak[i] + rpeak[i] - 2 * sims[i] for i in range(n)]


class Measure:
    """Token counts of parts of one text. Its words are counted once; a part is encoded anew only where its ends cut words."""

    def __init__(self, text: str, tokens: TokenAutomaton, words: list[str], counts: list[int]):
        self.text, self.tokens, self.words = text, tokens, words
        self.bounds = [0, *accumulate(map(len, words))]
        self.total = [0, *accumulate(counts)]

    def about(self, place: int) -> float:
        """Tokens before a place; inside a word in proportion."""
        k = bisect_right(self.bounds, place) - 1
        if self.bounds[k] == place:
            return self.total[k]
        return self.total[k] + (self.total[k + 1] - self.total[k]) * (place - self.bounds[k]) / (self.bounds[k + 1] - self.bounds[k])

    def place(self, tokens: float) -> int:
        """The last place with at most so many tokens before it."""
        k = bisect_right(self.total, tokens) - 1
        if k >= len(self.words):
            return self.bounds[-1]
        return self.bounds[k] + int((self.bounds[k + 1] - self.bounds[k]) * (tokens - self.total[k]) / (self.total[k + 1] - self.total[k]))

    def size(self, a: int, b: int) -> int:
        """Tokens of text[a:b] encoded by itself. Words are split from left to right by what follows, so from the first place
        where a word of the whole text begins the same words come, up to white space that the end cuts."""
        text, bounds = self.text, self.bounds
        last = b
        while last > a and text[last - 1].isspace():
            last -= 1
        safe = bisect_right(bounds, last) - 1
        n, at = 0, a
        while at < b:
            k = bisect_left(bounds, at)
            if bounds[k] == at and k < safe:
                n += self.total[safe] - self.total[k]
                at = bounds[safe]
                continue
            word = self.tokens.word_at(text, at, b)
            n += len(self.tokens.word_ids(word))
            at += len(word)
        return n


def _word_cuts(text: str, a: int, b: int) -> list[int]:
    return [m.end() for m in regex.finditer(r"\s+", text, pos=a, endpos=b)]


def split_text(text: str, tokens: TokenAutomaton, sizes: Sizes = Sizes()) -> list[tuple]:
    """Pieces (start, stop, n_tokens, overlap_tokens, cut) of a text, in code points; one piece if it fits.

    Every piece, encoded by itself, has at most ``limit`` tokens. All characters are in some piece, and
    without its overlap each begins where the one before ends. ``cut`` tells where a piece ends: topic
    (a valley), unit (a gap without depth), word, character or end.
    """
    words = tokens.words(text)
    counts = tokens.counts(words)
    if (n := sum(counts)) <= sizes.limit:
        return [(0, len(text), n, 0, "end")]
    whole = Measure(text, tokens, words, counts)
    at, size = whole.about, whole.size
    gaps = unit_gaps(text)
    depth = dict(zip(gaps, valley_depths(whole.words, whole.bounds[1:], gaps, sizes.block)))
    out, begin, fresh = [], 0, 0
    while True:
        if at(len(text)) - at(begin) <= sizes.limit * 1.02 and (n := size(begin, len(text))) <= sizes.limit:
            out.append((begin, len(text), n, size(begin, fresh) if fresh > begin else 0, "end"))
            return out
        room = at(begin) + sizes.limit
        far = min(whole.place(room) + 1, len(text))
        near = whole.place(at(begin) + sizes.limit * sizes.least)
        options = [(-depth[g], -g, g, "topic" if depth[g] > 0 else "unit") for g in gaps[bisect_left(gaps, max(near, fresh + 1)) : bisect_right(gaps, far)]]
        options.sort()
        cut = None
        for _, _, g, kind in options:
            if size(begin, g) <= sizes.limit:
                cut = g, kind
                break
        if cut is None:  # no unit ends there: the last unit end before, if it moves on enough, else a word's end, else any character
            for kind, places in (("unit", gaps[bisect_left(gaps, fresh + 1 + (near - fresh) // 2) : bisect_left(gaps, max(near, fresh + 1))]), ("word", _word_cuts(text, max(fresh + 1, near), far)), ("word", _word_cuts(text, fresh + 1, far))):
                for g in reversed(places):
                    if fresh < g < len(text) and size(begin, g) <= sizes.limit:
                        cut = g, kind
                        break
                if cut:
                    break
        if cut is None:
            low, high = fresh + 1, max(fresh + 1, min(far, len(text) - 1))
            while low < high:  # the furthest character that fits
                mid = (low + high + 1) // 2
                low, high = (mid, high) if size(begin, mid) <= sizes.limit else (low, mid - 1)
            cut = low, "character"
        stop, kind = cut
        out.append((begin, stop, size(begin, stop), size(begin, fresh) if fresh > begin else 0, kind))
        # The next piece starts at the word nearest to ``overlap`` tokens before the cut, and after this piece's start.
        back = whole.place(max(0, at(stop) - sizes.overlap))
        blanks = [p for p in _word_cuts(text, max(begin, back - 80), stop) if begin < p < stop]
        start = next((p for p in blanks if p >= back and size(p, stop) <= sizes.overlap), None)
        if start is None or size(start, stop) < sizes.overlap * 0.75:  # no word near: inside a long one
            start = max(begin + 1, back)
            while start < stop and size(start, stop) > sizes.overlap:
                start += 1
        begin, fresh = min(start, stop), stop


def split_corpus(docs: DataFrame, vocabulary: Vocabulary, key: str, text: str, sizes: Sizes = Sizes()) -> DataFrame:
    """(key, piece, start, stop, n_tokens, overlap_tokens, cut, text) of each document.

    A document that fits comes out as its one piece; a null text as one piece of null text, an empty one as
    one empty piece. Extra columns are left to the caller to join by the key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = vocabulary.compiled()
        for b in batches:
            for first in range(0, b.num_rows, 256):
                part = b.slice(first, 256)
                rows, out = [], []
                for i, t in enumerate(part.column(1).to_pylist()):
                    for k, p in enumerate(split_text(t, tokens, sizes) if t else [(0, 0, 0, 0, "end")]):
                        rows.append(i)
                        out.append((k, *p, None if t is None else t[p[0] : p[1]]))
                cols = list(zip(*out)) or [()] * 7
                kinds = [pa.int32()] * 5 + [pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows, pa.int64())), *[pa.array(c, k) for c, k in zip(cols, kinds)]], [key, "piece", "start", "stop", "n_tokens", "overlap_tokens", "cut", "text"])

    rows = docs.select(F.col(key), F.col(text).cast("string").alias("_text"))
    return rows.mapInArrow(run, f"`{key}` {dict(rows.dtypes)[key]}, piece int, start int, stop int, n_tokens int, overlap_tokens int, cut string, text string")
