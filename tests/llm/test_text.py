"""Tokenizer, leak search and splitting."""

import os
import random

import pytest

from priorview.llm.leakage import Limits, Matcher, leak_spans, leaked_items, readings, squash, squash_with_offsets
from priorview.llm.splitting import Sizes, split_corpus, split_text, unit_gaps
from priorview.llm.tokenizer import TokenAutomaton, Vocabulary, decode_corpus, encode_corpus

VOCABULARY = os.environ.get("PRIORVIEW_TOKENIZERS", "/opt/tokenizers") + "/byte_bpe_50k.json"
pytestmark = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary here")


@pytest.fixture(scope="module")
def automaton():
    with open(VOCABULARY, "rb") as f:
        return TokenAutomaton(f.read())


def strings():
    r = random.Random(2)
    some = lambda: chr(r.choice([r.randrange(32, 127), r.randrange(0xA0, 0x3000), r.randrange(0x3000, 0xD7FF), r.randrange(0xE000, 0x110000)]))
    for i in range(1500):
        k = i % 4
        if k == 0:
            yield "".join(some() for _ in range(25))
        elif k == 1:
            yield "".join(r.choice("aab e  \n\t\r\x1c\x85  　.,'s0²½") for _ in range(40))
        elif k == 2:
            yield "".join(r.choice("abcdehlst nro") for _ in range(60))
        else:
            yield "".join(r.choice(["the", "ing", "aaaa", "tion", " ", "  ", "\n", "'s", "<|endoftext|>", "12", "é", "日本"]) for _ in range(20))
    yield "a" * 5000
    yield " " * 3000 + "x"


def test_ids_are_those_of_the_public_library(automaton):
    tokenizers = pytest.importorskip("tokenizers")
    public = tokenizers.Tokenizer.from_file(VOCABULARY)
    public.encode_special_tokens = True
    for s in strings():
        assert automaton.encode(s) == public.encode(s, add_special_tokens=False).ids, s
        assert automaton.decode(automaton.encode(s)) == s
    assert automaton.encode("") == automaton.encode(None) == []


def test_the_automaton_accepts_only_encodings(automaton):
    """Of all ways to write a word as tokens, one path is accepted."""
    word = b"thethetheater"

    def paths(at, state):
        if at == len(word):
            return 1
        return sum(paths(at + len(label), automaton._to[t]) for t, label in enumerate(automaton.labels) if label and automaton._to[t] >= 0 and word.startswith(label, at) and (state == 0 or automaton.has_arc(state, t)))

    small = [i for i, x in enumerate(automaton.labels) if x and x in word]
    automaton_labels, automaton.labels = automaton.labels, [x if i in set(small) else b"" for i, x in enumerate(automaton.labels)]
    try:
        assert paths(0, 0) == 1
    finally:
        automaton.labels = automaton_labels


def test_encoding_a_table(spark, automaton):
    rows = [(1, "Hello <|endoftext|> world", "x"), (2, "", "x"), (3, None, None), (3, None, None), (4, "é" * 20000, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    ids = encode_corpus(docs, Vocabulary(spark, VOCABULARY), "doc_id", "text")
    got = sorted(((r.doc_id, r.ids) for r in ids.collect()), key=str)
    assert got == sorted(((i, automaton.encode(t)) for i, t, _ in rows), key=str)
    assert {r.doc_id: r.text for r in decode_corpus(ids, Vocabulary(spark, VOCABULARY), "doc_id").collect()} == {1: rows[0][1], 2: "", 3: "", 4: "é" * 20000}
    assert encode_corpus(docs.limit(0), Vocabulary(spark, VOCABULARY), "doc_id", "text").count() == 0


WORDS = "amber anchor balcony bandage bakery canvas chimney copper cousin crooked debt drummer famous ferry fiddle frozen garden glove harbour hidden inspector kettle ladder lantern marble medal mirror needle orchard parade petition promoter quarry receipt rumour saddle stool telegram tunnel turnstile velvet wager whistle widow winter".split()


def passage(seed, n=90):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def test_leaks_whatever_the_writing(spark):
    items = [(i, passage(i), f"Which word follows number {i} in the passage?", "yes") for i in range(8)] + [(8, None, None, None), (9, "", "", "")]
    p = {i: t.split() for i, t, *_ in items if t}
    part = lambda i, n, at=10: " ".join(p[i][at : at + n])
    change = lambda ws, every: " ".join("other" if k % every == every - 1 else w for k, w in enumerate(ws))
    texts = {
        1: ("start " + part(0, 20) + " end", {0}), 2: (part(1, 30).upper(), {1}), 3: ("<p>" + part(2, 25).replace(" ", "</p>\n<p>") + "</p>", {2}),
        4: ("​".join(part(3, 24)), {3}), 5: (change(p[4][5:50], 6), {4}), 6: (part(5, 11), set()), 7: (" ".join(sorted(p[5][10:40])), set()), 8: (items[6][2] + " yes", set()),
        9: (part(6, 22) + "\n\n" + part(7, 22), {6, 7}), 10: (None, set()), 11: ("", set()), 12: ("x " * 30000 + part(0, 20), {0}), 13: (part(3, 40).replace("a", "á").replace(" ", " - "), {3}),
    }
    docs = spark.createDataFrame([(k, t, "c") for k, (t, _) in texts.items()], "doc_id long, text string, item_id string")
    table = spark.createDataFrame(items + items[:2], "item_id int, passage string, question string, answer string")
    got = {(r.doc_id, r.item_id) for r in leaked_items(docs, table, "doc_id", "text", "item_id").collect()}
    assert got == {(k, i) for k, (_, own) in texts.items() for i in own}
    for block in (200, 10**9):  # several automata find the same
        assert {(r.doc_id, r.item_id) for r in leaked_items(docs, table, "doc_id", "text", "item_id", limits=Limits(block=block)).collect()} == got
    spans = {r.doc_id: r for r in leak_spans(docs, table, "doc_id", "text", "item_id").collect()}
    assert set(spans) == {k for k, (_, own) in texts.items() if own}
    assert texts[1][0][spans[1].start : spans[1].stop] == part(0, 20) and texts[2][0][spans[2].start : spans[2].stop] == part(1, 30).upper()
    assert leaked_items(docs, table.limit(0), "doc_id", "text", "item_id").count() == 0 and leaked_items(docs.limit(0), table, "doc_id", "text", "item_id").count() == 0


def test_offsets_follow_the_squashed_text():
    for t in ("Añb <b>c</b> &amp;&lt;d e&#769;f ﬁn Straße", "<", "&", "a<b", "é́x", "x &nbsp; y", "&lt;p class=&quot;x&quot;&gt;a <i>b</i>", "&amp;lt;b&gt; <a href='1'>x</a> ΣΑΣ"):
        ways = readings(t)
        assert 1 <= len(ways) <= 3
        for plain, steps in ways:
            flat, at = squash_with_offsets(t, steps)
            assert len(flat) == len(at) and flat == squash(plain) and at == sorted(at)
    assert Matcher([]).leaks("anything") == set() == Matcher([]).leaks(None)


@pytest.mark.parametrize(
    "wrap",
    [
        "see &lt;{}&gt; end", "x <{}> y", "x <a {}> y", '<img alt="{}">', "<!-- {} -->", "&amp;lt;{}", "<![CDATA[{}]]>", "<!{}>",
        lambda p: "".join(f'<span style="{"color: red; " * 40}" data-n=1>{w} </span>' for w in p.split()), lambda p: "".join(f"&lt;b&gt;{w} &lt;/b&gt;" for w in p.split()),
        lambda p: "".join(f"<b hidden>{w}</b> " for w in p.split()[:12]) + "<" + " ".join(p.split()[12:]) + ">", lambda p: p.replace(" ", " <!-- --> "),
    ],
)
def test_no_markup_hides_a_passage(wrap):
    m = Matcher([(1, passage(1, 60), "Which word comes first?", "no"), (2, passage(2, 60), None, None)])
    part = " ".join(passage(1, 60).split()[5:29])
    text = "é " + (wrap(part) if callable(wrap) else wrap.format(part)) + " the end of it. " + passage(9, 40)
    assert m.leaks(text) == {1}
    for item, kind, start, stop, words, covered in m.spans(text):
        assert item == 1 and kind == "passage" and 0 <= start < stop <= len(text) and words >= 15 and covered <= words


def test_spans_stand_where_they_say(automaton):
    """Over all given documents: offsets are there, and the text between them squashes to what was matched."""
    duckdb = pytest.importorskip("duckdb")
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("no tables here")
    read = lambda q: duckdb.sql(q.format(folder)).fetchall()
    m = Matcher(read("select item_id, passage, question, answer from '{}/eval_items.parquet'"))
    texts = [t for (t,) in read("select text from '{}/documents.parquet' where text <> ''")]
    n = 0
    for t in texts:
        found = m.spans(t)
        assert {f[0] for f in found} == m.leaks(t)
        for _, _, start, stop, words, _ in found:
            n += 1
            assert 0 <= start < stop <= len(t)
            if words:
                assert any(squash(plain) in flat for flat in [squash(x) for x, _ in readings(t)] for plain in [x for x, _ in readings(t[start:stop])])
    assert n > 50


def test_many_chains_and_unspaced_scripts():
    """A repeated passage keeps all its places; scripts without blanks count characters as words."""
    m = Matcher([(1, "alpha beta gamma delta " * 10, None, None), (2, "".join(chr(0x4E00 + 37 * i % 2000) for i in range(60)), None, None)])
    assert m.leaks("delta alpha beta gamma " * 400) == {1}
    han = "".join(chr(0x4E00 + 37 * i % 2000) for i in range(60))
    assert m.leaks("前" + han[5:40] + "后") == {2} and m.leaks(han[:9]) == set()


def sized(automaton, text, pieces, sizes):
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
    for k, (a, b, n, o, _) in enumerate(pieces):
        assert n == len(automaton.encode(text[a:b])) <= sizes.limit
        if k:
            assert pieces[k - 1][0] < a <= pieces[k - 1][1] < b and o <= sizes.overlap


@pytest.mark.parametrize("text", ["x" * 9000, "日本語" * 900, "word " * 2000, " " * 5000, "a\n" * 2000, "🔥" * 900, "日本語。" * 800, "Short. " * 900])
def test_pieces_of_awkward_texts(automaton, text):
    sizes = Sizes(limit=200, overlap=16)
    pieces = split_text(text, automaton, sizes)
    assert len(pieces) > 1
    sized(automaton, text, pieces, sizes)


def test_cuts_where_the_topic_changes(automaton):
    r = random.Random(4)
    topic = lambda ws, n: " ".join(" ".join(r.choice(ws) for _ in range(9)).capitalize() + "." for _ in range(n))
    a, b, c = topic(WORDS[:12], 20), topic(WORDS[15:27], 20), topic(WORDS[30:42], 20)
    text = f"{a} {b} {c}"
    pieces = split_text(text, automaton, Sizes(limit=400, overlap=20, least=0.4))
    sized(automaton, text, pieces, Sizes(limit=400, overlap=20))
    assert pieces[0][1] == len(a) + 1 and pieces[0][4] == "topic" and all(p[1] in unit_gaps(text) for p in pieces[:-1])


def test_splitting_a_table(spark, automaton):
    docs = spark.createDataFrame([(1, "short", 5), (2, "", 5), (3, None, 5), (4, "one two. " * 900, 5)], "doc_id long, text string, piece int")
    got = split_corpus(docs, Vocabulary(spark, VOCABULARY), "doc_id", "text").collect()
    assert [(r.doc_id, r.n_tokens, r.text) for r in got if r.doc_id < 4] == [(1, len(automaton.encode("short")), "short"), (2, 0, ""), (3, 0, None)]
    long = [r for r in got if r.doc_id == 4]
    assert len(long) > 1 and all(r.text == docs.filter("doc_id = 4").first().text[r.start : r.stop] and r.n_tokens <= 1024 for r in long) and all(48 <= r.overlap_tokens <= 64 for r in long[1:])
    assert split_corpus(docs.limit(0), Vocabulary(spark, VOCABULARY), "doc_id", "text").count() == 0
