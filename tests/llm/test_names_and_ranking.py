import itertools
import math
import os
import random
from collections import Counter
from dataclasses import replace
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from priorview.functions.keys import current_rows
from priorview.llm.names import SHORT_FORMS, Linking, Physique, banded, bits_of, candidates, cluster_pairs, lettered, link_profiles, link_spellings, may_be_one, met_by, monge_elkan, name_tokens, near, numbered, same_name, shared_bands, star_clusters, token_similarity, tokenised, verified
from priorview.llm import ranking
from priorview.llm.queries import p6_ranking
from priorview.llm.ranking import Scaling, comparisons, met, rank_items
from priorview.session import table

VARIANTS = [
    ["Katherine Bardawyn", "Kate Bardawyn", "K Bardawyn", "Bardawyn K.", "Katherine L. Bardawyn", "Katheriine Bardawyn", "KATHERINE BARDAWYN", "Judge Bardawyn", 'Katherine "Rook" Bardawyn', "KatherineBardawyn", "Bardawyn, Katherine"],
    ["José Horsirook", "Jose Horsirook", "José Horsirook Jr", " José Horsirook", "Jaosé Horsirook"], ["Marco Calgakov", "MARCO CALGAKOV"], ["Ingrid Calkakov", "Judge Calkakov", "I. Calkakov"], ["Scott Calgakov"],
]


@pytest.mark.parametrize("name, tokens", [("Judge O'Brien, Pat", ["obrien", "patricia"]), (None, []), ("  ", []), ("Mr. Jr.", []), ("Zoë “Two Bells” Lortafelt", ["zoe", "lortafelt"]), ("TimothyNarpavane", ["timothy", "narpavane"]), ("Mtathew\tX. Long", ["mtathew", "long"])])
def test_tokens(name, tokens):
    assert name_tokens(name, SHORT_FORMS) == tokens
    assert name_tokens("Pat Long") == ["pat", "long"]


def test_similarities():
    assert token_similarity("naomi", "noami") == 0.8 and token_similarity("m", "milan") == 0.95 and token_similarity("m", "x") == 0.0
    assert monge_elkan(["m", "salgadian"], ["s", "malgithwaite"])[2] < 0.5
    assert same_name(["calkakov"], ["marco", "calgakov"], "calkakov", "calgakov", Linking()) == 0 and same_name([], ["a"], "", "a", Linking()) == 0


def test_spellings_of_one_person_are_linked(spark):
    names = [(n,) for own in VARIANTS for n in own] + [(None,), (" ",), ("",), ("Jr.",)]
    got = link_spellings(spark.createDataFrame(names * 2, "who string"), "who", Linking(short_forms=SHORT_FORMS))
    pairs = {(r.key_a, r.key_b) for r in cluster_pairs(got, "name", "cluster").collect()}
    assert pairs == {tuple(sorted(p)) for own in VARIANTS for p in itertools.combinations(own, 2)}
    assert link_spellings(spark.createDataFrame([], "who string"), "who").count() == 0


def test_bands_follow_the_collision_curve_and_meet_the_recall(spark):
    how = Linking()
    assert 1 - (1 - how.similarity**how.rows) ** how.bands >= how.recall > 1 - (1 - how.similarity**how.rows) ** (how.bands - 1)
    r = random.Random(1)
    base = ["".join(r.choice("abcdeghiklmnorstuv") for _ in range(8)) for _ in range(120)]
    typo = lambda w: w[:3] + r.choice("xyz") + w[4:]
    nodes = spark.createDataFrame([(f"{i:03d}{x}", [w if x == "a" else typo(w), f"first{i % 5}"]) for i, w in enumerate(base) for x in "ab"], "node string, tokens array<string>")
    named = numbered(nodes, how)
    ids = {r.id: r.node for r in named.collect()}
    for hot in (10**6, 30):  # whole bands, and large ones split
        bands, _ = shared_bands(banded(named, how), named, replace(how, hot=hot))
        pairs = [tuple(sorted((ids[c.a], ids[c.b]))) for c in candidates(bands, bands).collect()]
        assert len(pairs) == len(set(pairs)) and sum((f"{i:03d}a", f"{i:03d}b") in set(pairs) for i in range(120)) / 120 >= 0.9


def test_names_too_much_alike_to_be_split_keep_their_links(spark):
    how = Linking(hot=10)
    named = numbered(spark.createDataFrame([(f"n{i:02d}", ["maximilian", "oberhausen"]) for i in range(40)], "node string, tokens array<string>"), how)
    bands, _ = shared_bands(banded(named, how), named, how)
    assert candidates(bands, bands).count() == 40 * 39 // 2


def test_a_large_band_keeps_all_its_pairs(spark):
    """Names that share a band and nothing else are no less candidates because many share it."""
    how, r = Linking(hot=7), random.Random(5)
    names = numbered(spark.createDataFrame([(f"n{i:02d}", ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8))]) for i in range(60)], "node string, tokens array<string>"), how)
    bands = names.select(F.lit(5).cast("bigint").alias("band"), "id").unionByName(names.limit(3).select(F.lit(6).cast("bigint").alias("band"), "id"))
    shared, _ = shared_bands(bands, names, how)
    assert candidates(shared, shared).count() == 60 * 59 // 2
    assert shared.groupBy("band").count().agg(F.max("count")).first()[0] < 40
    met_ = met_by(names.select("id", F.lit(1).alias("k")), names.select("id", F.lit(1).alias("k")), "k", F.col("l.id") < F.col("r.id"), 7)
    assert met_.count() == met_.distinct().count() == 60 * 59 // 2


def test_the_test_of_letters_and_the_bits_of_bands_leave_out_nothing(spark):
    how, r = Linking(short_forms=SHORT_FORMS), random.Random(6)
    given, family = ["katherine", "jo", "lee", "sam", "maximilian", "anna", "k"], ["bardawyn", "horsirook", "ng", "calgakov", "li", "salgadian", "katz"]

    def typo(w):
        for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
            i = r.randrange(len(w))
            w = r.choice([w[:i] + r.choice("aeklnz") + w[i + 1 :], w[:i] + r.choice("aeklnz") + w[i:], w[:i] + w[i + 1 :] if len(w) > 1 else w, w[:i] + w[i : i + 2][::-1] + w[i + 2 :]])
        return w

    forms = [lambda g, f: [g, f], lambda g, f: [f, g], lambda g, f: [g[0], f], lambda g, f: [g + f], lambda g, f: [f], lambda g, f: [g, r.choice(family), f], lambda g, f: [g, f + g]]
    names = {" ".join(t): t for t in (r.choice(forms)(typo(r.choice(given)), typo(r.choice(family))) for _ in range(500))}
    nodes = numbered(lettered(spark.createDataFrame([(n, t) for n, t in names.items()], "node string, tokens array<string>"), how), how)
    both = nodes.alias("l").crossJoin(nodes.alias("r")).filter("l.node < r.node")
    kept = {(x.a, x.b) for x in both.filter(may_be_one()).select(F.col("l.node").alias("a"), F.col("r.node").alias("b")).collect()}
    kept &= {(x.a, x.b) for x in both.filter(near(how)).select(F.col("l.node").alias("a"), F.col("r.node").alias("b")).collect()}
    held = sorted(nodes.collect(), key=lambda x: x.node)
    one = {(a.node, b.node) for a, b in itertools.combinations(held, 2) if same_name(a.tokens, b.tokens, a.rare, b.rare, how)}
    assert len(one) > 500 and one <= kept and len(kept) < len(held) * (len(held) - 1) // 4
    few = banded(nodes.filter("id % 3 = 0"), how)
    asked = banded(nodes, how, [], bits_of(few)).distinct()
    assert banded(nodes, how).join(few.select("band").distinct(), "band", "left_semi").distinct().exceptAll(asked).isEmpty()


def test_crowded_days_and_bands_of_profiles_are_compared_whole(spark):
    """Brute force over profiles of one day and of unknown days, with hardly a gram in common and bands of any size."""
    r, how = random.Random(2), Linking(rows=3, similarity=0.4, recall=0.97, hot=4)
    names = ["Ana Bo", "Ama Bo", "Eva Kim", "Ewa Kim", "Lena Ostrandir", "Lema Ostrandir", "Samuel Kalovik", "Samual Kalowik"]
    rows = [(f"{i:03d}", r.choice(names), r.choice([date(1990, 1, 1), date(1990, 1, 1), None]), r.choice([170.0, 190.0]), None) for i in range(60)]
    frame = spark.createDataFrame(rows, "id string, name string, born date, h double, r double")
    got = [{tuple(x) for x in cluster_pairs(link_profiles(frame, "id", "name", "born", Physique({"h": 2.5, "r": 2.0}), how=h), "key", "cluster").collect()} for h in (how, replace(how, hot=10**6))]
    assert got[0] == got[1]
    born = [x for x in rows if x[2]]
    one = {(a[0], b[0]) for a, b in itertools.combinations(born, 2) if a[1][-3:] == b[1][-3:] and a[1].split()[0] == b[1].split()[0]}
    assert len(one) > 50 and one <= got[0]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no tables here")
def test_bands_find_the_links_of_brute_force(spark):
    """All pairs of the officials' names, verified one by one, against those that share a band."""
    how = Linking(short_forms=SHORT_FORMS)
    typed = table(spark, "/root/testdata/sf0.01", "fights").select(F.explode(F.array("referee", "judge_1", "judge_2", "judge_3")).alias("name")).filter("name <> ''").distinct()
    nodes = numbered(tokenised(typed, "name", SHORT_FORMS).withColumn("node", F.array_join(F.array_sort("tokens"), " ")).groupBy("node").agg(F.min("tokens").alias("tokens")), how)
    linked = {tuple(sorted((a.node, b.node))) for a, b in itertools.combinations(nodes.collect(), 2) if same_name(a.tokens, b.tokens, a.rare, b.rare, how)}
    bands, _ = shared_bands(banded(nodes, how), nodes, how)
    found = {(r.a, r.b) for r in verified(candidates(bands, bands), nodes, how).collect()}
    assert found <= linked and len(linked) > 100 and len(found) / len(linked) >= 0.9


def test_profiles(spark):
    rows = [
        ("1", "Aaron Lanurand", date(1990, 2, 8), 172.0, 177.0, "n"), ("2", "AARON LANURAND Jr", date(1990, 2, 8), None, None, "n"), ("3", "Aaron Lanurrand", None, 173.0, 177.0, "n"), ("4", "Aaron Lanurand", None, None, None, "n"),
        ("5", "Aaron Lanurand", date(1985, 2, 8), 172.0, 177.0, "n"), ("6", "Bjorn Tarstad", None, 190.0, 195.0, "n"), ("7", "Bjorn Tarstad", None, 170.0, 172.0, "n"), ("8", None, None, 170.0, 172.0, "n"), (None, "X Y", None, 1.0, 1.0, "n"), ("9", "Bjorn Tarstad", None, 190.0, 195.0, "n"),
    ]
    got = link_profiles(spark.createDataFrame(rows, "id string, name string, born date, h double, r double, node string"), "id", "name", "born", Physique({"h": 2.5, "r": 2.0}))
    assert {(r.key_a, r.key_b) for r in cluster_pairs(got, "key", "cluster").collect()} == {("1", "2"), ("1", "3"), ("2", "3"), ("6", "9")}


def test_star_clusters_by_brute_force(spark):
    r = random.Random(9)
    ids = [f"n{i:02d}" for i in range(40)]
    links = {tuple(sorted(r.sample(ids, 2))): round(r.random(), 3) for _ in range(60)}
    near = {i: {} for i in ids}
    for (a, b), s in links.items():
        near[a][b] = near[b][a] = s
    order = sorted((i for i in ids if near[i]), key=lambda i: (-len(near[i]), -round(sum(near[i].values()), 6), i))
    free, centres = set(order), []
    for i in order:  # one after the other finds the same centres as rounds do
        if i in free:
            centres.append(i)
            free -= {i, *near[i]}
    got = {x.node: x.centre for x in star_clusters(spark.createDataFrame([(i, [i]) for i in ids], "node string, tokens array<string>"), spark.createDataFrame([(a, b, s) for (a, b), s in links.items()], "a string, b string, s double")).collect()}
    assert set(got) == set(ids) and {c for n, c in got.items() if near[n]} == set(centres)
    assert all(got[i] == i if not near[i] or i in centres else got[i] in near[i] for i in ids)


@pytest.fixture(scope="module")
def uneven():
    """Wins in the model's proportions, met unevenly, one item in half of all pairs; a second group and a lone pair."""
    p = {f"i{k}": math.exp(k / 3) for k in range(12)} | {f"z{k}": math.exp(k / 4) for k in range(4)}
    r, pairs = random.Random(3), []
    for a, b in itertools.combinations(p, 2):
        if a[0] == b[0] and (a == "i0" or r.random() < 0.4 or int(b[1:]) - int(a[1:]) == 1):
            n = r.choice([3.0, 30.0])
            pairs += [(a, b, n * p[a] / (p[a] + p[b])), (b, a, n * p[b] / (p[a] + p[b]))]
    return p, pairs


@pytest.mark.parametrize("block", [10**6, 5, 0])
def test_scaling_finds_the_model_it_came_from(spark, uneven, block):
    """In one task, by groups, and in rounds over the cluster."""
    p, pairs = uneven
    extra = [(None, "i1", 1.0), ("i1", "i1", 5.0), ("i1", "i2", 0.0)]
    found = rank_items(spark.createDataFrame(pairs + extra, "winner string, loser string, n double"), spark.createDataFrame([("i3",), ("lone",), (None,), ("lone",)], "id string"), Scaling(tie=0.0, block=block)).collect()
    got = {x.item: x for x in found}
    assert len(found) == len(got) == 17 and (got["lone"].strength, got["lone"].wins, got["lone"].losses) == (1.0, 0.0, 0.0)
    for group in "iz":
        own = [k for k in p if k[0] == group]
        mean = sum(math.log(p[k]) for k in own) / len(own)
        assert all(abs(math.log(got[k].strength) - math.log(p[k]) + mean) < 1e-4 for k in own)
    assert all(abs(got[k].wins - sum(n for a, b, n in pairs if a == k)) < 1e-5 for k in p)


def test_all_ways_agree_on_sparse_comparisons(spark):
    r = random.Random(8)
    pairs = [(f"n{a}", f"n{b}", float(r.randint(1, 2))) for a, b in (r.sample(range(30), 2) for _ in range(45))]
    df, none = spark.createDataFrame(pairs, "winner string, loser string, n double"), spark.createDataFrame([], "id string")
    one, spread = ({x.item: math.log(x.strength) for x in rank_items(df, none, Scaling(block=block)).collect()} for block in (10**6, 0))
    assert one.keys() == spread.keys() and max(abs(one[k] - spread[k]) for k in one) < 1e-3


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no tables here")
def test_ranking_of_the_bouts_is_the_fixed_point_of_plain_rounds(spark):
    """Plain row and column scaling in numpy until nothing moves, over all bouts, against the query."""
    folder = "/root/testdata/sf0.01"
    bouts = current_rows(table(spark, folder, "fights"), "fight_id", ["fight_id", "fighter_1_id", "fighter_2_id", "winner_fighter_id", "result_type"]).collect()
    norm = lambda x: (x or "").strip().lower()
    wins = Counter()
    for x in bouts:
        a, b, w = norm(x.fighter_1_id), norm(x.fighter_2_id), norm(x.winner_fighter_id)
        if x.result_type == "win" and a and b and a != b and w in (a, b):
            wins[w, b if w == a else a] += 1
    names = sorted({n for pair in wins for n in pair})
    at = {n: i for i, n in enumerate(names)}
    m = {(at[a], at[b]): float(wins[a, b]) for a, b in wins}
    full = {k: m.get(k, 0.0) + 0.03 for a, b in m for k in ((a, b), (b, a))} | {(i, i): 0.5 for i in range(len(names))}
    row, col, n = np.array([a for a, _ in full]), np.array([b for _, b in full]), np.array(list(full.values()))
    d = np.ones(len(names))
    for _ in range(20_000):
        o = np.bincount(row, n / d[col])
        new = np.bincount(col, n / o[row])
        moved, d = np.abs(np.log(new / d)).max(), new
        if moved < 1e-13:
            break
    assert moved < 1e-12
    x = np.log(o / d)
    near = {i: set() for i in range(len(names))}
    for a, b in full:
        near[a].add(b)
    left = set(near)
    while left:
        group, todo = set(), [next(iter(left))]
        while todo:
            i = todo.pop()
            if i not in group:
                group.add(i)
                todo += near[i]
        left -= group
        own = list(group)
        x[own] -= x[own].mean()
    got = {r.fighter_id: math.log(r.strength) for r in p6_ranking(spark, folder).collect()}
    assert max(abs(got[k] - x[at[k]]) for k in names) < 1e-6 and all(got[k] == 0 for k in got if k not in at)


def test_an_unbeaten_item_and_a_long_chain(spark):
    chain = [(f"c{i:02d}", f"c{i + 1:02d}", 6.0) for i in range(9)] + [(f"c{i + 1:02d}", f"c{i:02d}", 2.0) for i in range(9)] + [("c09", f"w{i}", 1.0) for i in range(9)]
    got = rank_items(spark.createDataFrame(chain, "winner string, loser string, n double"), spark.createDataFrame([], "id string"))
    s = {r.item: r.strength for r in got.collect()}
    assert sorted((k for k in s if k[0] == "c"), key=lambda k: -s[k]) == [f"c{i:02d}" for i in range(10)] and max(s[f"w{i}"] for i in range(9)) < s["c09"]
    assert np.isfinite(list(s.values())).all()


def test_comparisons(spark, rows):
    df = spark.createDataFrame([("a", "a", "b"), ("b", "a", "b"), ("a", "b", "a"), ("x", "a", "b"), (None, "a", "b"), ("a", "a", None), ("a", "a", "a")], "w string, f string, s string")
    assert rows(comparisons(df, "w", "f", "s")) == [("a", "b", 1.0), ("a", "b", 1.0), ("b", "a", 1.0)]
    assert rows(met(comparisons(df, "w", "f", "s"))) == [("a", "b", 2.0, 1.0)]
    assert rank_items(comparisons(df.limit(0), "w", "f", "s"), spark.createDataFrame([], "id string")).count() == 0


@pytest.mark.parametrize("block, words", [(10, "row and column sums are off"), (0, "still move")])
def test_scaling_never_ends_unsettled(spark, block, words):
    pairs = spark.createDataFrame([("a", "b", 9.0), ("b", "c", 9.0), ("c", "d", 9.0)], "winner string, loser string, n double")
    with pytest.raises(Exception, match=words):
        rank_items(pairs, spark.createDataFrame([], "id string"), Scaling(guard=1, block=block)).collect()


def test_a_group_of_over_a_million_pairs_needs_no_rounds_over_the_cluster(spark, monkeypatch):
    """One task settles it; its logarithms average 0."""
    monkeypatch.setattr(ranking, "_over_cluster", lambda *_: pytest.fail("rounds over the cluster"))
    item = lambda k: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(100_000)).cast("string")
    pairs = spark.range(1_020_000).select(item(1).alias("winner"), item(2).alias("loser"), F.lit(1.0).alias("n")).filter("winner <> loser")
    got = rank_items(pairs, spark.createDataFrame([], "id string"))
    logs = np.array([r.x for r in got.select(F.log("strength").alias("x")).collect()])
    assert met(pairs).count() > 1_000_000 and len(logs) == 100_000 and abs(logs.mean()) < 1e-6 and np.isfinite(logs).all()
