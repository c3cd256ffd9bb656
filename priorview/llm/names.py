"""Variant spellings of one name.

Names are taken apart into tokens (titles, suffixes, nicknames, case and accents put aside). Candidates
share a band of MinHash values over the padded q-grams of their tokens; tokens that few names have weigh
more, so that a common given name alone makes no candidate. The number of bands follows from the collision
curve: 1 - (1 - s^rows)^bands is the chance that names of similarity s meet. Candidates are verified by
Monge-Elkan similarity (tokens matched one to one, each by edit distance), and by what else is known of the
two. Links become clusters by star clustering: the name with most links among its neighbours is a centre
and takes them, again until all are taken.

A band that very many names share is dealt to blocks of which each two meet, so that no task makes all pairs of a large
group and none of its pairs is left out. Profiles born on one day need no bands: all of a day are compared, and a test of
letters, which no two spellings of one name fail, leaves out most pairs before they are read.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priorview.session import materialise, shared_dir

#: Words around a name that are no part of it.
ASIDE = {"judge", "ref", "referee", "off", "official", "mr", "mrs", "ms", "dr", "sir", "prof", "jr", "junior", "sr", "senior", "ii", "iii", "iv"}
#: Short forms of English and some other given names, an optional aid (``Linking.short_forms``).
SHORT_FORMS = {
    "abby": "abigail", "al": "albert", "alex": "alexander", "sasha": "alexander", "andy": "andrew", "drew": "andrew", "tony": "anthony", "art": "arthur", "barb": "barbara", "ben": "benjamin", "bea": "beatriz",
    "bert": "albert", "bob": "robert", "bobby": "robert", "rob": "robert", "robbie": "robert", "bill": "william", "billy": "william", "will": "william", "cathy": "catherine", "charlie": "charles", "chuck": "charles",
    "chris": "christopher", "topher": "christopher", "cindy": "cynthia", "dan": "daniel", "danny": "daniel", "dave": "david", "deb": "deborah", "debbie": "deborah", "dima": "dmitri", "mitya": "dmitri", "don": "donald", "dick": "richard", "rick": "richard", "rich": "richard", "ed": "edward", "eddie": "edward", "ted": "edward",
    "liz": "elizabeth", "beth": "elizabeth", "lizzie": "elizabeth", "betty": "elizabeth", "fred": "frederick", "freddie": "frederick", "gabe": "gabriel", "greg": "gregory", "hank": "henry", "harry": "henry", "jack": "john", "johnny": "john",
    "jake": "jacob", "jim": "james", "jimmy": "james", "jamie": "james", "jen": "jennifer", "jenny": "jennifer", "jerry": "gerald", "joe": "joseph", "joey": "joseph", "pepe": "jose", "chepe": "jose", "josh": "joshua", "kate": "katherine",
    "kathy": "katherine", "katie": "katherine", "kasia": "katarzyna", "aga": "agnieszka", "ken": "kenneth", "larry": "lawrence", "leo": "leonard", "len": "leonard", "lenny": "leonard", "maggie": "margaret", "meg": "margaret", "peggy": "margaret", "marge": "margaret", "matt": "matthew", "max": "maximilian",
    "mike": "michael", "mick": "michael", "misha": "mikhail", "nate": "nathan", "nick": "nicholas", "nico": "nicholas", "kolya": "nikolai", "pat": "patricia", "patty": "patricia", "trish": "patricia", "paco": "francisco", "pancho": "francisco", "kiko": "francisco", "pete": "peter", "phil": "philip",
    "ray": "raymond", "rafa": "rafael", "ron": "ronald", "sam": "samuel", "sammy": "samuel", "sandy": "alexandra", "serge": "sergei", "seryozha": "sergei", "steve": "steven", "sue": "susanna", "susie": "susanna", "suzie": "susanna", "theo": "theodora", "tim": "timothy", "timmy": "timothy", "tom": "thomas",
    "tommy": "thomas", "trev": "trevor", "vic": "victor", "vicky": "victoria", "tori": "victoria", "vika": "victoria", "walt": "walter", "zach": "zachary", "zack": "zachary", "zak": "zachary", "lupe": "guadalupe", "nacho": "ignacio", "quique": "enrique", "lalo": "eduardo", "beto": "roberto", "chema": "josemaria",
}
NICKNAME = re.compile(r"[(\[{].*?[)\]}]|[\"“”„«»].*?[\"“”„«»]|(?<!\w)['‘’‚].*?['‘’](?!\w)")
GLUED = re.compile(r"(?<=[^\W\d_A-ZÀ-Þ])(?=[A-ZÀ-Þ][^\W\d_A-ZÀ-Þ])")
PARTS = re.compile(r"[^\W_]+")
#: Letters that stand for others once accents are gone.
PLAIN = str.maketrans({"ł": "l", "ø": "o", "đ": "d", "ı": "i", "ß": "ss", "æ": "ae", "œ": "oe"})


def name_tokens(name: str | None, short_forms: dict[str, str] | None = None) -> list[str]:
    """Tokens of a typed name, in its order, short forms as what they stand for. A name of nothing but asides and blanks has none."""
    if not name:
        return []
    text = GLUED.sub(" ", NICKNAME.sub(" ", unicodedata.normalize("NFKC", name)))
    text = re.sub(r"[​-‏­﻿]", "", text)
    text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).casefold().translate(PLAIN)
    text = re.sub(r"(?<=\w)['’`](?=\w)", "", text)
    found = [t for t in PARTS.findall(text) if t not in ASIDE]
    if sum(len(t) > 1 for t in found) > 1:  # an initial beside a whole given name says no more
        found = [t for t in found if len(t) > 1]
    return [short_forms.get(t, t) for t in found] if short_forms else found


@lru_cache(maxsize=200_000)
def token_similarity(a: str, b: str) -> float:
    """1 less edits (with swaps of neighbours) over length; an initial fits a token that begins with it."""
    if a == b:
        return 1.0
    if len(a) == 1 or len(b) == 1:
        return 0.95 if a[0] == b[0] else 0.0
    if abs(len(a) - len(b)) > max(len(a), len(b)) // 2:
        return 0.0
    two, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if two and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, two[j - 2] + 1)
            row.append(d)
        two, last = last, row
    return 1 - last[-1] / max(len(a), len(b))


def monge_elkan(a: list[str], b: list[str]) -> tuple[float, float, float]:
    """(mean, least, similarity of the longest token) of the tokens of the shorter name, matched one to one to the other's."""
    if len(a) > len(b) or (len(a) == len(b) and sum(map(len, a)) > sum(map(len, b))):
        a, b = b, a
    left, sims = list(b), []
    for t in sorted(a, key=len, reverse=True):
        # The longest token is a family name: an initial can't stand for it.
        best = max(left, key=lambda u: (bool(sims) or len(u) > 1, token_similarity(t, u), len(u)))
        sims.append(token_similarity(t, best))
        left.remove(best)
    return sum(sims) / len(sims), min(sims), sims[0]


@dataclass(frozen=True)
class Linking:
    """q: letters of a gram. similarity, recall: names of at least this Jaccard similarity of weighted grams shall meet
    with at least this chance. rows: MinHash values of a band. weight: grams of tokens with at most ``few`` partners count so often.
    mean, least, family: least Monge-Elkan mean, similarity of any matched token and of the longest.
    joined: least similarity of the letters run together, where one name has no blanks. alone: the
    same of a token that is all of a name. hot: names in a band from which on it is split. short_forms: given names
    that are taken as others; none unless given."""

    q: int = 2
    similarity: float = 0.35
    recall: float = 0.99
    rows: int = 2
    weight: int = 4
    few: int = 4
    mean: float = 0.8
    least: float = 0.69
    family: float = 0.66
    joined: float = 0.8
    alone: float = 0.9
    seed: int = 7
    hot: int = 1000
    short_forms: dict[str, str] = field(default_factory=dict, hash=False)

    @property
    def bands(self) -> int:
        """From the collision curve."""
        return math.ceil(math.log(1 - self.recall) / math.log(1 - self.similarity**self.rows))


def padded_grams(token: str, q: int) -> list[str]:
    t = "#" * (q - 1) + token + "$" * (q - 1)
    return [t[i : i + q] for i in range(len(t) - q + 1)]


def same_name(a: list[str], b: list[str], rare_a: str, rare_b: str, how: Linking) -> float:
    """Similarity if the names can be one person's, else 0. A single token has to be one of the other's rare ones."""
    if not a or not b:
        return 0.0
    if (len(a) == 1) != (len(b) == 1):
        one, many, rare = (a[0], b, rare_b) if len(a) == 1 else (b[0], a, rare_a)
        whole = [t for t in many if len(t) > 1]
        s = max(token_similarity(one, "".join(x)) for x in (whole, whole[::-1]))
        if s >= how.joined and len(one) > max(map(len, whole), default=0) + 2:
            return s
        s = max((token_similarity(one, t) for t in rare.split(" ") if len(t) > 1), default=0.0)
        return s * 0.9 if s >= how.alone and len(one) > 1 else 0.0
    mean, least, family = monge_elkan(a, b)
    return mean if mean >= how.mean and least >= how.least and family >= how.family else 0.0


def _minhash_bands(how: Linking):
    rng = np.random.default_rng(how.seed)
    n = how.bands * how.rows
    mul = rng.integers(1, 2**63, n, dtype=np.uint64) | np.uint64(1)
    add = rng.integers(0, 2**63, n, dtype=np.uint64)

    def bands(tokens: list[tuple[str, int]]) -> np.ndarray:
        grams = [xxhash.xxh64_intdigest(f"{g}\x00{k}") for t, w in tokens for g in set(padded_grams(t, how.q)) for k in range(w)]
        x = np.array(grams, dtype=np.uint64)
        with np.errstate(over="ignore"):
            h = x[:, None] * mul + add
            h ^= h >> np.uint64(29)
            h = h * np.uint64(0xBF58476D1CE4E5B9)
            m = (h ^ (h >> np.uint64(32))).min(axis=0).reshape(how.bands, how.rows)
            out = np.arange(how.bands, dtype=np.uint64)
            for c in range(how.rows):
                out = (out ^ m[:, c]) * np.uint64(0x9E3779B97F4A7C15)
                out ^= out >> np.uint64(31)
        return out.view(np.int64)

    return bands


def tokenised(names: DataFrame, name: str, short_forms: dict[str, str] | None = None) -> DataFrame:
    """Adds ``tokens`` (array of strings); rows of names without any are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.array([name_tokens(x, short_forms) for x in b.column(b.schema.get_field_index(name)).to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*b.columns, t], [*b.schema.names, "tokens"])

    schema = ", ".join(f"`{c}` {k}" for c, k in names.dtypes) + ", tokens array<string>"
    return names.mapInArrow(run, schema).filter(F.size("tokens") > 0)


def with_weights(nodes: DataFrame, how: Linking) -> DataFrame:
    """Adds ``weights``: for each token 1 (it stands beside many different ones, as a common given name) to ``weight``
    (beside at most ``few``, as a family name with a few spellings of the given name)."""
    each = nodes.select("node", F.posexplode("tokens").alias("at", "token"))
    beside = nodes.select(F.explode("tokens").alias("token"), "tokens").select("token", F.explode(F.array_remove("tokens", F.col("token"))).alias("other")).filter(F.length("other") > 1)
    counts = materialise(beside.groupBy("token", "other").agg(F.count(F.lit(1)).alias("n")).groupBy("token").agg(F.count(F.lit(1)).alias("c")), "partners")
    most = counts.agg(F.max("c")).first()[0] or 0
    spread = math.log(max(most / how.few, 2.0))
    rarity = 1 - F.log(F.greatest(F.coalesce("c", F.lit(0)) / F.lit(float(how.few)), F.lit(1.0))) / spread
    w = F.greatest(F.lit(1), F.round(F.lit(float(how.weight)) * rarity)).cast("int")
    weighed = each.join(counts, "token", "left").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("at", w.alias("w")))).alias("ws"))
    return nodes.join(weighed.select("node", F.col("ws.w").alias("weights")), "node")


def numbered(nodes: DataFrame, how: Linking, odd: Column | None = None) -> DataFrame:
    """Nodes (node, tokens and other columns) with a number ``id``, ``weights``, the ``name`` of all and of the ``rare`` tokens,
    written once, so that numbers stay: bands and pairs move numbers, not names. Where ``odd`` holds the number is odd."""
    rare = F.filter(F.arrays_zip("tokens", "weights"), lambda x: x["weights"] >= F.array_max("weights") - 1)
    made = with_weights(nodes, how).withColumn("id", F.monotonically_increasing_id() * 2 + (F.lit(0) if odd is None else odd.cast("int")))
    return materialise(made.withColumns({"name": F.array_join("tokens", " "), "rare": F.array_join(F.transform(rare, lambda x: x["tokens"]), " ")}), "names")


def banded(nodes: DataFrame, how: Linking, carried: list[str] = [], among: Broadcast[np.ndarray] | None = None) -> DataFrame:  # noqa: B006
    """(band, id, *carried): one row for each band of each of ``nodes`` (id, tokens, weights and what is named). among:
    bits of the bands that are asked for (``bits_of``); of others few rows come."""
    kinds = dict(nodes.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = _minhash_bands(how)
        for big in batches:
            for first in range(0, big.num_rows, 1000):
                b = big.slice(first, 1000)
                keys = np.concatenate([bands(list(zip(t, w))) for t, w in zip(b.column(1).to_pylist(), b.column(2).to_pylist())])
                rows = np.repeat(np.arange(b.num_rows), how.bands)
                if among is not None:
                    place = keys & (64 * len(among.value) - 1)
                    asked = (among.value[place >> 6] >> (place & 63)) & 1 == 1
                    keys, rows = keys[asked], rows[asked]
                yield pa.RecordBatch.from_arrays([pa.array(keys), b.column(0).take(pa.array(rows)), *[b.column(3 + k).take(pa.array(rows)) for k in range(len(carried))]], ["band", "id", *carried])

    return nodes.select("id", "tokens", "weights", *carried).mapInArrow(run, "band bigint, id bigint" + "".join(f", `{c}` {kinds[c]}" for c in carried))


def bits_of(bands: DataFrame) -> Broadcast[np.ndarray]:
    """A bit for each band (by its last 26 bits), in 8 MB however many there are: one that is set may be another's, none is missing."""
    words = 1 << 20
    place = bands.select(F.col("band").bitwiseAND(F.lit(64 * words - 1)).alias("p"))
    set_ = place.groupBy(F.shiftright("p", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("v")).toArrow()
    bits = np.zeros(words, dtype=np.int64)
    bits[set_.column("w").to_numpy()] = set_.column("v").to_numpy()
    return bands.sparkSession.sparkContext.broadcast(bits)


def shared_bands(bands: DataFrame, nodes: DataFrame, how: Linking) -> tuple[DataFrame, list[DataFrame]]:
    """The rows of ``bands`` (band, id, ...) that at least two names share, no band of more than about twice ``hot`` names.

    Names alone in a band make no candidates and go before the join. The names of a larger band are dealt to blocks, and
    each two blocks are a band of their own, so that any two names of the large band still meet: nothing is dropped, and
    no task makes all pairs of a large group. Also returns what was kept in memory, to be let go.
    """
    known = bands.persist(StorageLevel.MEMORY_AND_DISK)
    # Counts are combined before the shuffle, so that no task has to hold a hot band to count it.
    counts = known.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = known.join(counts, "band").persist(StorageLevel.MEMORY_AND_DISK)
    large = rows.filter(F.col("n") > how.hot).withColumn("blocks", F.ceil(F.col("n") / how.hot)).withColumn("i", F.pmod(F.xxhash64("id"), "blocks"))
    dealt = large.withColumn("j", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))).filter("i <> j")
    paired = dealt.withColumn("band", F.xxhash64("band", F.least("i", "j"), F.greatest("i", "j"))).drop("blocks", "i", "j")
    return rows.filter(F.col("n") <= how.hot).unionByName(paired).drop("n"), [rows, known]


def met_by(left: DataFrame, right: DataFrame, key: str, condition: Column, hot: int) -> DataFrame:
    """Each row l of ``left`` beside each r of ``right`` (both with an ``id``) of equal ``key`` where ``condition`` over l and r
    holds. Rows of a key that more than ``hot`` rows of ``right`` have are dealt to blocks, and those of ``left`` meet all of them."""
    crowded = materialise(right.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / hot).alias("blocks")).filter("blocks > 1"), "crowded")
    same = F.col(f"l.{key}") == F.col(f"r.{key}")
    if not crowded.isEmpty():
        blocks = F.coalesce("blocks", F.lit(1).cast("bigint"))
        right = right.join(crowded, key, "left").withColumn("block", F.pmod(F.xxhash64("id"), blocks)).drop("blocks")
        left = left.join(crowded, key, "left").withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1))).drop("blocks")
        same = same & (F.col("l.block") == F.col("r.block"))
    return left.alias("l").join(right.alias("r"), same & condition)


def _pairs(both: DataFrame) -> DataFrame:
    return both.select(F.least("l.id", "r.id").alias("a"), F.greatest("l.id", "r.id").alias("b")).distinct()


def candidates(left: DataFrame, right: DataFrame) -> DataFrame:
    """(a, b): numbers of names that share a band, each pair once, a smaller. Both frames: (band, id, ...)."""
    return _pairs(left.alias("l").join(right.alias("r"), (F.col("l.band") == F.col("r.band")) & (F.col("l.id") != F.col("r.id"))))


def lettered(nodes: DataFrame, how: Linking) -> DataFrame:
    """Adds what ``may_be_one`` reads: number of tokens, letters, bits of the letters of all and of the longest token, and
    how many of either a name that is the same may lack; ``initials``: a token is one letter."""
    long = F.element_at(F.array_sort("tokens", lambda x, y: F.length(y) - F.length(x)), 1)
    bits = lambda text: F.aggregate(F.split(text, ""), F.lit(0).cast("bigint"), lambda m, c: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.ascii(c) % 64)))
    token, name = 1 - min(how.least, how.joined, how.alone), 1 - min(how.mean, how.joined, how.alone)
    lacks = lambda letters, share: F.floor(F.col(letters) * share + 1e-9) if isinstance(letters, str) else F.floor(letters * share + 1e-9)
    each = F.aggregate("tokens", F.lit(0).cast("bigint"), lambda n, t: n + lacks(F.length(t), token))
    made = nodes.withColumns({"count": F.size("tokens"), "letters": F.length(F.array_join("tokens", "")), "initials": F.exists("tokens", lambda t: F.length(t) == 1), "all_bits": bits(F.array_join("tokens", "")), "long_bits": bits(long), "long_lacks": lacks(F.length(long), token)})
    return made.withColumn("all_lacks", F.least(each, lacks(F.size("tokens") * F.length(long), name)))


def may_be_one() -> Column:
    """Whether ``same_name`` can hold for l and r (``lettered``), cheaply told; never false where it holds.

    The tokens of the shorter name are matched to the other's. An edit takes at most one letter away and a token of L
    letters may be edited (1 - least) * L times, so no more of the letters of its longest token can be missing there; of
    all its letters neither, nor more than the mean allows, unless the other has an initial, which stands for any token.
    """

    def within(x: str, y: str) -> Column:
        lacking = lambda bits: F.bit_count(F.col(f"{x}.{bits}").bitwiseAND(F.bitwise_not(F.col(f"{y}.all_bits"))))
        return (lacking("long_bits") <= F.col(f"{x}.long_lacks")) & (F.col(f"{y}.initials") | (lacking("all_bits") <= F.col(f"{x}.all_lacks")))

    size = lambda n: F.struct(f"{n}.count", f"{n}.letters")
    l, r = size("l"), size("r")
    return ((l <= r) & within("l", "r")) | ((r <= l) & within("r", "l"))


def near(how: Linking) -> Column:
    """Whether ``same_name`` can hold for the names of l and r, by plain edit distances; never false where it holds.

    A swap of neighbours is two plain edits, so half the plain distance is the least that ``token_similarity`` counts. No
    token of the shorter name matches better than it does with the most alike of the other's. Single tokens are left to ``same_name``.
    """

    def within(x: str, y: str) -> Column:
        alike = "CASE WHEN length(t) = 1 OR length(u) = 1 THEN 1D ELSE 1 - ceil(levenshtein(t, u) / 2) / greatest(length(t), length(u)) END"
        best = f"array_max(transform({y}, u -> {alike}))"
        return F.expr(f"aggregate(transform({x}, t -> {best}), 0D, (n, b) -> n + IF(b >= {how.least - 1e-9}D, b, -1e6D)) >= {how.mean}D * size({x}) - 1e-9D")

    size = lambda n: F.struct(F.size(f"{n}.tokens"), F.length(f"{n}.name"))
    l, r, one = size("l"), size("r"), (F.size("l.tokens") == 1) != (F.size("r.tokens") == 1)
    return one | ((l <= r) & within("l.tokens", "r.tokens")) | ((r <= l) & within("r.tokens", "l.tokens"))


def compared(both: DataFrame, kind: str, how: Linking) -> DataFrame:
    """(a, b, s): nodes of the pairs l, r (node, tokens, name, rare) that can be one name."""
    both = both.filter(near(how))
    ordered = F.col("l.node") < F.col("r.node")
    side = lambda c, x, y: F.when(ordered, F.col(f"{x}.{c}")).otherwise(F.col(f"{y}.{c}"))
    cols = [side(c, x, y).alias(f"{c}_{n}") for x, y, n in (("l", "r", "a"), ("r", "l", "b")) for c in ("node", "name", "rare")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            read = lambda c: x.column(x.schema.get_field_index(c))  # noqa: B023, E731
            texts = [read(c).to_pylist() for c in ("name_a", "name_b", "rare_a", "rare_b")]
            s = np.array([same_name(a.split(" "), b.split(" "), ra, rb, how) for a, b, ra, rb in zip(*texts)], dtype=np.float64)
            keep = pa.array(np.flatnonzero(s > 0))
            yield pa.RecordBatch.from_arrays([read("node_a").take(keep), read("node_b").take(keep), pa.array(s[s > 0])], ["a", "b", "s"])

    return both.select(*cols).mapInArrow(run, f"a {kind}, b {kind}, s double")


def verified(pairs: DataFrame, nodes: DataFrame, how: Linking) -> DataFrame:
    """(a, b, s): nodes of candidates that can be one name."""
    l, r = (nodes.select("id", "node", "tokens", "name", "rare").alias(n) for n in "lr")
    return compared(pairs.join(l, F.col("a") == F.col("l.id")).join(r, F.col("b") == F.col("r.id")), dict(nodes.dtypes)["node"], how)


def star_clusters(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, centre) of every node. nodes: (node, tokens); links: (a, b, s), each pair once.

    A node is a centre if none of its neighbours that are still free comes before it: names with two whole tokens
    first (an initial or a family name alone may fit several people), then more links, then the larger sum of
    similarities, then the smaller node. Neighbours go to the most similar of the round's centres.
    Nodes without links are their own centres. The first of all free nodes is a centre in every round, so rounds end.
    """
    shared_dir(nodes.sparkSession)
    edges = links.select(F.inline(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y"), "s"), F.struct(F.col("b").alias("x"), F.col("a").alias("y"), "s"))))
    whole = nodes.select(F.col("node").alias("x"), (F.size(F.filter("tokens", lambda t: F.length(t) > 1)) < 2).alias("part"))
    degree = edges.groupBy("x").agg((-F.count(F.lit(1))).alias("n"), (-F.round(F.sum("s"), 6)).alias("s"))
    rank = degree.join(whole, "x").select("x", F.struct("part", "n", "s", F.col("x").alias("id")).alias("p"))
    free = edges.join(rank.withColumnRenamed("p", "px"), "x").join(rank.select(F.col("x").alias("y"), F.col("p").alias("py")), "y").checkpoint()
    done = None
    while True:
        first = free.groupBy("x").agg(F.first("px").alias("px"), F.min("py").alias("least"))
        centres = first.filter(F.col("px") < F.col("least")).select(F.col("x").alias("c"))
        taken = free.join(centres, F.col("y") == F.col("c")).groupBy("x").agg(F.max_by("y", F.struct("s", "y")).alias("centre")).select(F.col("x").alias("node"), "centre")
        now = taken.unionByName(centres.select(F.col("c").alias("node"), F.col("c").alias("centre"))).checkpoint()
        done = now if done is None else done.unionByName(now)
        gone = now.select(F.col("node").alias("g"))
        free = free.join(gone, F.col("x") == F.col("g"), "left_anti").join(gone, F.col("y") == F.col("g"), "left_anti").checkpoint()
        if free.isEmpty():
            break
    return nodes.select("node").join(done, "node", "left").select("node", F.coalesce("centre", "node").alias("centre"))


def cluster_pairs(members: DataFrame, key: str, cluster: str) -> DataFrame:
    """(key_a, key_b), key_a smaller: every two members of one cluster."""
    l, r = members.select(F.col(cluster).alias("c"), F.col(key).alias("key_a")), members.select(F.col(cluster).alias("c"), F.col(key).alias("key_b"))
    return l.join(r, "c").filter("key_a < key_b").select("key_a", "key_b")


def link_spellings(names: DataFrame, name: str, how: Linking = Linking()) -> DataFrame:
    """(name, cluster): every distinct spelling with the cluster of spellings of one name.

    Null, empty and blank names, and those of nothing but titles, are left out. Spellings with the same tokens are
    one node, so that many ways of writing the same letters make no pairs.
    """
    spellings = materialise(tokenised(names.select(F.col(name).alias("name")).filter("name is not null").distinct(), "name", how.short_forms).withColumn("node", F.array_join(F.array_sort("tokens"), " ")), "spellings")
    nodes = numbered(spellings.groupBy("node").agg(F.min("tokens").alias("tokens")), how)
    bands, kept = shared_bands(banded(nodes, how), nodes, how)
    links = materialise(verified(candidates(bands, bands), nodes, how), "links")
    for held in kept:
        held.unpersist()
    clusters = star_clusters(nodes, links)
    return spellings.join(clusters, "node").select("name", F.col("centre").alias("cluster"))


@dataclass(frozen=True)
class Physique:
    """Largest differences between two profiles of one person, where both have the measure."""

    tolerance: dict[str, float]


def link_profiles(profiles: DataFrame, key: str, name: str, born: str, physique: Physique, short_forms: dict[str, str] | None = None, how: Linking = Linking(rows=3, similarity=0.4, recall=0.97)) -> DataFrame:
    """(key, cluster): profiles of one person.

    Two profiles are linked if their names can be one, and they were born on one day; where a day of birth is
    unknown, if at least one measure is known of both and none differs by more than its tolerance. Profiles whose
    name tokens and all else are equal are one node. Profiles without a key or any name token are left out.
    """
    measures = list(physique.tolerance)
    rows = profiles.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(name).alias("name"), F.col(born).alias("born"), *measures)
    tokens = tokenised(rows, "name", short_forms)
    same = F.concat_ws("|", F.array_join(F.array_sort("tokens"), " "), *[F.coalesce(F.col(c).cast("string"), F.lit("?")) for c in ("born", *measures)])
    # A profile of which nothing but the name is known stays alone: the name can't tell two people apart.
    known = F.coalesce(*[F.col(c).cast("string") for c in ("born", *measures)]).isNotNull()
    spelled = materialise(tokens.withColumn("node", F.when(known, same).otherwise(F.concat(same, F.lit("|"), "key"))), "profiles")
    nodes = numbered(lettered(spelled.groupBy("node").agg(F.min("tokens").alias("tokens"), *[F.first(c).alias(c) for c in ("born", *measures)]), how), how, F.col("born").isNull())
    close = F.lit(True)
    for c, most in physique.tolerance.items():
        close = close & F.coalesce(F.abs(F.col(f"l.{c}").cast("double") - F.col(f"r.{c}").cast("double")) <= most, F.lit(True))
    close = close & F.coalesce(*[(F.col(f"l.{c}") - F.col(f"r.{c}")).cast("double") for c in measures]).isNotNull()
    kind, marks = dict(nodes.dtypes)["node"], ["count", "letters", "initials", "all_bits", "long_bits", "long_lacks", "all_lacks"]
    born_ = nodes.filter("born is not null").select("born", "id", "node", "tokens", "name", "rare", *marks)
    by_day = compared(met_by(born_, born_, "born", (F.col("l.id") < F.col("r.id")) & may_be_one(), how.hot), kind, how)
    # Of the bands of all only those are asked for that a profile without a day of birth has.
    unborn = materialise(banded(nodes.filter("id % 2 = 1"), how, [*measures, *marks]), "bands")
    asked = bits_of(unborn)
    anyone = materialise(banded(nodes, how, [*measures, *marks], asked), "bands")
    anyway = verified(_pairs(met_by(unborn, anyone, "band", (F.col("l.id") != F.col("r.id")) & close & may_be_one(), how.hot)), nodes, how)
    links = materialise(by_day.unionByName(anyway), "links")
    asked.destroy()
    clusters = star_clusters(nodes, links)
    return spelled.join(clusters, "node").select("key", F.col("centre").alias("cluster"))
