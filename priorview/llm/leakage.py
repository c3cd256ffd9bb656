"""Test items whose passages appear in corpus texts.

Both sides are *squashed*: compatibility forms folded, case and accents dropped, and every character that is
no letter or digit left out, so that layout, invisible characters, hyphenation and spacing don't matter. Markup
and character references are read in up to three ways, each scanned, because no one of them is always right: tags
left out, tags taken as text (what stands in them, or between brackets that are no tags, is text as well), and tags
that only appear once references are undone left out. No reading loses text that another keeps.

One Aho-Corasick automaton holds, for each word of a passage, the squashed text of the words from there on
up to a length that chance seldom makes, and the questions and answers; each reading is scanned once. Hits
of one item that go on in step are chained; a chain that spans enough words of the passage is a leak, so
single changed, added or left-out words don't break it, whereas shuffled words make no chain.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Letters of other scripts and ligatures that look or stand for Latin ones and that folding leaves.
FOLDED = str.maketrans({"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "һ": "h", "ԁ": "d", "ɡ": "g", "ο": "o", "α": "a", "ν": "v", "ι": "i", "ł": "l", "ø": "o", "đ": "d", "ı": "i", "ß": "ss", "æ": "ae", "œ": "oe"})
#: Attributes of tags that have no value.
BARE = "allowfullscreen|async|autofocus|autoplay|checked|controls|default|defer|disabled|hidden|loop|multiple|muted|open|readonly|required|reversed|selected"
#: A tag: a name and attributes with values, of any length. What only stands between brackets is none.
TAG = re.compile(rf"""</?[A-Za-z][\w:.-]*+(?:\s++(?:[A-Za-z_:@][\w:.-]*+\s*+=\s*+(?:"[^"<]*+"|'[^'<]*+'|[^\s"'<>=`]++)|(?:{BARE})\b))*+\s*+/?>""")
REFERENCE = re.compile(r"&(?:#[0-9]{1,9}+;?|#[xX][0-9a-fA-F]{1,8}+;?|[A-Za-z][A-Za-z0-9]{1,31}+;)")
DROPPED = re.compile(r"[\W_]+")
#: Words; scripts written without blanks have one a character.
UNSPACED = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}"
WORD = regex.compile(rf"[{UNSPACED}]|(?:(?![{UNSPACED}])[^\W_])+")


@dataclass(frozen=True)
class Limits:
    """seed_words, seed_chars: least words and squashed characters of a pattern. span: least words of the
    passage from the first to the last hit of a chain. share: least share of them that hits cover. gap:
    most words between hits of a chain. drift: most squashed characters by which text and passage may
    get out of step over one gap. block: most characters of test material in one automaton, which holds some 140
    bytes for each in every Python worker; more material takes several automata, each in a pass of its own."""

    seed_words: int = 3
    seed_chars: int = 12
    span: int = 15
    share: float = 0.4
    gap: int = 7
    drift: int = 24
    block: int = 4_000_000


def squash(text: str) -> str:
    """Letters and digits only, folded; markup and references are no business of it."""
    text = DROPPED.sub("", unicodedata.normalize("NFKD", text).casefold())
    return text if text.isascii() else text.translate(FOLDED)


def _undone(m: re.Match) -> str:
    return html.unescape(m.group())


def readings(text: str) -> list[tuple[str, list[tuple]]]:
    """The ways to read ``text``: each with the steps (pattern, replacement) that lead to it, at most three."""
    undo = [(REFERENCE, _undone)] if "&" in text and REFERENCE.search(text) else []
    tags = len(TAG.findall(text)) if "<" in text else 0
    ways = [[(TAG, " "), *undo], undo] if tags else [undo]
    if undo and len(TAG.findall(REFERENCE.sub(_undone, text))) > tags:
        ways.append([*undo, (TAG, " ")])
    return [(reduce(lambda t, step: step[0].sub(step[1], t), own, text), own) for own in ways]


def squash_with_offsets(text: str, steps: list[tuple] = ()) -> tuple[str, list[int]]:
    """The squashed reading of ``text`` by ``steps``, and for each of its characters the offset of the original one it came from."""
    at = list(range(len(text)))
    for pattern, by in steps:
        out, places, last = [], [], 0
        for m in pattern.finditer(text):
            new = by(m) if callable(by) else by
            out += [text[last : m.start()], new]
            places += [*at[last : m.start()], *[at[m.start()]] * len(new)]
            last = m.end()
        text, at = "".join([*out, text[last:]]), [*places, *at[last:]]
    known: dict[str, str] = {}
    flat, origin = [], []
    for c, place in zip(text, at):
        piece = known.get(c)
        if piece is None:
            piece = known[c] = squash(c)
        if piece:
            flat.append(piece)
            origin += [place] * len(piece)
    return "".join(flat), origin


class Matcher:
    """Compiled test items: (item_id, passage, question, answer); null or empty parts have no patterns."""

    def __init__(self, items: list[tuple], limits: Limits = Limits()):
        self.limits = limits
        seeds: dict[str, list[tuple]] = defaultdict(list)
        self.starts: dict[int, list[int]] = {}
        for item, passage, question, answer in items:
            words = [w for w in (squash(x) for x in WORD.findall(unicodedata.normalize("NFKC", passage or ""))) if w]
            start = [0]
            for w in words:
                start.append(start[-1] + len(w))
            self.starts[item] = max(self.starts.get(item, []), start, key=len)
            flat = "".join(words)
            for p in range(len(words)):
                q = p + limits.seed_words
                while q <= len(words) and start[q] - start[p] < limits.seed_chars:
                    q += 1
                if q <= len(words):
                    seeds[flat[start[p] : start[q]]].append((item, "passage", p, q, start[p]))
            for kind, part in (("question", question), ("answer", answer)):
                flat_part = squash(part or "")
                if len(flat_part) >= limits.seed_chars:
                    seeds[flat_part].append((item, kind, 0, 0, 0))
        self.automaton = ahocorasick.Automaton()
        for pattern, where in seeds.items():
            self.automaton.add_word(pattern, (len(pattern), where))
        self.empty = not seeds
        if seeds:
            self.automaton.make_automaton()

    def scan(self, flat: str) -> tuple[list[tuple], list[tuple]]:
        """Chains (item, first word, word after the last, from, to, words covered) and hits of questions and answers
        (item, kind, from, to), in squashed offsets."""
        if self.empty:
            return [], []
        lim = self.limits
        hits: dict[int, list[tuple]] = defaultdict(list)
        other = []
        for end, (length, where) in self.automaton.iter(flat):
            for item, kind, p, q, at in where:
                if kind == "passage":
                    hits[item].append((end + 1 - length, p, q, at, end + 1))
                else:
                    other.append((item, kind, end + 1 - length, end + 1))
        chains = []
        for item, own in hits.items():
            # A chain needs span words, of which hits cover a share: fewer hits can't make one.
            if len(own) < 2:
                continue
            own.sort()
            live: list[list] = []  # first word, word after last, start, end, covered, step, word of the last hit
            starts, most = self.starts[item], 64
            for start, p, q, at, end in own:
                step, best = start - at, None
                for c in live:
                    ahead = p - c[1]
                    if p > c[6] and ahead <= lim.gap and abs(step - c[5]) <= (lim.drift if ahead > -2 else 2) and (best is None or abs(step - c[5]) < abs(step - best[5])):
                        best = c
                if best is None:
                    live.append([p, q, start, end, q - p, step, p])
                else:
                    best[4] += q - max(p, best[1])
                    best[1], best[3], best[5], best[6] = q, end, step, p
                if len(live) >= most:  # chains that no later hit can go on, as it would be out of step
                    chains += [(item, *c[:5]) for c in live if start > c[5] + lim.drift + starts[min(c[1] + lim.gap, len(starts) - 1)]]
                    live = [c for c in live if start <= c[5] + lim.drift + starts[min(c[1] + lim.gap, len(starts) - 1)]]
                    most = max(64, 2 * len(live))
            chains += [(item, *c[:5]) for c in live]
        return chains, other

    def leaks(self, text: str | None) -> set:
        """Items with a chain long enough in any reading of the text."""
        return {c[0] for flat in {squash(t): None for t, _ in readings(text)} for c in self.scan(flat)[0] if self.is_leak(c)} if text else set()

    def spans(self, text: str) -> list[tuple]:
        """(item, part, start, stop, words, covered) of each leak, in the original's offsets, with the questions and answers
        of leaked items; what several readings show at one place is there once."""
        out, seen = [], defaultdict(list)
        flats: dict[str, list] = {}
        for t, steps in readings(text):
            flats.setdefault(squash(t), steps)
        for flat, steps in flats.items():
            chains, other = self.scan(flat)
            chains = [c for c in chains if self.is_leak(c)]
            if not chains:
                continue
            _, at = squash_with_offsets(text, steps)
            ids = {c[0] for c in chains}
            found = [(c[0], "passage", at[c[3]], at[c[4] - 1] + 1, c[2] - c[1], c[5]) for c in chains]
            found += [(item, kind, at[x], at[y - 1] + 1, None, None) for item, kind, x, y in other if item in ids]
            new = [f for f in found if not any(f[2] < stop and start < f[3] for start, stop in seen[f[:2]])]
            out += new
            for f in new:
                seen[f[:2]].append(f[2:4])
        return out

    def is_leak(self, c: tuple) -> bool:
        span = c[2] - c[1]
        return span >= self.limits.span and c[5] >= self.limits.share * span


def item_blocks(items: DataFrame, item: str, passage: str, question: str, answer: str, limits: Limits = Limits()) -> Iterator[list[tuple]]:
    """The test items in blocks of about ``limits.block`` characters, one block at a time on the driver; repeated rows once,
    rows of one item together, null ids left out."""
    rows = items.select(F.col(item).alias("i"), F.col(passage).alias("p"), F.col(question).alias("q"), F.col(answer).alias("a")).filter("i is not null").distinct().orderBy("i", "p", "q", "a")
    block, used = [], 0
    for r in map(tuple, rows.toLocalIterator()):
        n = sum(len(x or "") for x in r[1:])
        if block and used + n > limits.block and r[0] != block[-1][0]:
            yield block
            block, used = [], 0
        block.append(r)
        used += n
    yield block


_held: list = []


def _compiled(block: list[tuple], limits: Limits) -> Matcher:
    """The automaton of a block, compiled once a process as long as no other block comes."""
    if not _held or _held[0] != (block, limits):
        _held[:] = [(block, limits), Matcher(block, limits)]
    return _held[1]


def _passes(docs: DataFrame, items: DataFrame, key: str, text: str, item: str, parts: tuple[str, str, str], limits: Limits, find, fields: list[tuple[str, pa.DataType, str]]) -> DataFrame:
    """(key, item, fields): a pass over the texts for each block of items; ``find(matcher, text)`` gives tuples of item and fields."""
    rows = docs.select(F.col(key), F.col(text).cast("string").alias("_text"))
    names = [key, item, *[f[0] for f in fields]]
    schema = ", ".join([f"`{key}` {dict(rows.dtypes)[key]}", f"`{item}` bigint", *[f"{n} {k}" for n, _, k in fields]])

    def one(block: list[tuple]) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = _compiled(shared.value, limits)
            for b in batches:
                found = [(i, hit) for i, t in enumerate(b.column(1).to_pylist()) if t for hit in find(matcher, t)]
                values = [pa.array([hit[k] for _, hit in found], kind) for k, kind in enumerate([pa.int64(), *[f[1] for f in fields]])]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([i for i, _ in found], pa.int64())), *values], names)

        return rows.mapInArrow(run, schema)

    out = reduce(DataFrame.unionAll, map(one, item_blocks(items, item, *parts, limits)))
    return out.withColumn(item, F.col(item).cast(items.schema[item].dataType))


def leaked_items(docs: DataFrame, items: DataFrame, key: str, text: str, item: str, passage: str = "passage", question: str = "question", answer: str = "answer", limits: Limits = Limits()) -> DataFrame:
    """(key, item): each document that holds a long enough part of an item's passage, once for each item.

    Questions and answers alone are no leak. Null and empty texts hold nothing; texts are scanned whole. Item ids are integers.
    """
    return _passes(docs, items, key, text, item, (passage, question, answer), limits, lambda m, t: [(i,) for i in sorted(m.leaks(t))], [])


def leak_spans(docs: DataFrame, items: DataFrame, key: str, text: str, item: str, passage: str = "passage", question: str = "question", answer: str = "answer", limits: Limits = Limits()) -> DataFrame:
    """(key, item, part, start, stop, words, covered): where in the original text each leak lies, in code points,
    with the questions and answers of leaked items that stand in the same text. Offsets are never null."""
    fields = [("part", pa.string(), "string"), *[(n, pa.int32(), "int") for n in ("start", "stop", "words", "covered")]]
    return _passes(docs, items, key, text, item, (passage, question, answer), limits, lambda m, t: m.spans(t), fields)
