"""Row-wise operators: brute force and the edges (nulls, empty, long, repeated, empty tables)."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tapewright.llm import bpe, decontaminate, htmltext, language, pii, tokencount, urlfilter

DOC = "doc_id long, text string, lang string"


def docs(spark, rows, schema=DOC):
    return spark.createDataFrame(rows, schema)


# --- decontamination --------------------------------------------------------------------------


def spelled(text, items, size=13):
    """Words, hit word numbers and items by comparing every window."""
    own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in text or ""
    ))
    hit, ids = set(), set()
    for item_id, item in items:
        for w in decontaminate.windows(decontaminate.words(item), size):
            w = [x.decode() for x in w.split(b" ")]
            for i in range(len(own) - len(w) + 1):
                if own[i : i + len(w)] == w:
                    hit.update(range(i, i + len(w)))
                    ids.add(item_id)
    return own, hit, ids


ITEMS = [
    (1, " ".join(f"w{i}" for i in range(20))),
    (2, "Short answer, one."),
    (3, "..."),
    (4, None),
    (None, "nameless passage here"),
    (2, "Short answer, one."),
    (10, "short ANSWER one"),
]
TEXTS = [
    None,
    "",
    "  ...  ",
    "short answer one",
    "x " + " ".join(f"W{i}" for i in range(3, 20)) + " y short answer one z nameless passage here",
    "short answers one w1 w2 w3",
    "é short-answer\none, short answer one answer one",
    " ".join(f"w{i}" for i in range(20)) * 50,
    "word " * 40_000 + "short answer one",
]


@pytest.mark.parametrize("automaton_bytes", [1 << 20, 500])
def test_windows_are_found(spark, automaton_bytes):
    """By one automaton, and by one after the other."""
    frame = docs(spark, [(i, t, "x") for i, t in enumerate(TEXTS)] * 2)
    frame = frame.withColumnRenamed("lang", "n_words")
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.judge(
        decontaminate.find(frame, benchmark, automaton_bytes=automaton_bytes, spans=True)
    ).collect()
    assert len(found) == 2 * len(TEXTS)
    for r in found:
        own, hit, ids = spelled(TEXTS[r.doc_id], ITEMS)
        assert (r.n_words, r.n_hit) == (len(own), len(hit))
        assert r.hit_items == sorted(str(i) for i in ids if i is not None)
        assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(own))
        for a, b in ((s["start"], s["end"]) for s in r.hit_spans):
            assert decontaminate.words(r.text[a:b])
            assert not r.text[a].isspace() and not r.text[b - 1].isspace()
    spans = next(r for r in found if r.doc_id == 6).hit_spans
    assert [TEXTS[6][s["start"] : s["end"]] for s in spans] == ["short-answer\none, short answer one"]


def test_shards_of_the_benchmark_are_bounded(spark):
    """Also where a third of all items are the same and one window has many items."""
    items = [(i, "the same words in every one of these items") for i in range(150)]
    items += [(1_000 + i, f"another item with words of its own {i}") for i in range(300)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    limit = 4_000
    made, n = decontaminate._patterns(benchmark, "item_id", "text", 13, limit)
    sizes = {}
    for r in made.collect():
        cost = len(r["window"]) + len(r["id"]) + decontaminate.PATTERN_BYTES
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + cost
    assert n == len(sizes) == -(-sum(sizes.values()) // limit) > 5
    assert max(sizes.values()) < 2 * limit
    assert made.count() == 450


def test_no_benchmark_and_no_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    found = decontaminate.judge(decontaminate.find(docs(spark, [(1, "a b", None)]), none)).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in found] == [(2, 0, False)]
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.find(docs(spark, []), benchmark).count() == 0


# --- url filter -------------------------------------------------------------------------------

URLS = [
    None,
    "",
    "no scheme",
    "http://",
    "http://Example.ORG/es/1",
    "http://a.b.example.org/es/",
    "http://a.example.org/es",
    "http://notexample.org/es/1",
    "http://example.org/en/12?x=/es/",
    "http://example.org/en/2",
    "http://example.org?/es/",
    "http://x.com/fr/1#/de/",
    "http://com/de/9",
    "http://x.net/de/9",
    "ftp://org/a://b/",
    "http://x.com#/fr/",
    "http://x.com/" + "a/" * 50_000,
]
RULES = [
    urlfilter.Rule("allow", "org", "/"),
    urlfilter.Rule("block", "example.org", "/es/"),
    urlfilter.Rule("block", "example.org", "/en/1"),
    urlfilter.Rule("allow", "com", "/fr/"),
    urlfilter.Rule("block", "com", "/de/"),
    urlfilter.Rule("block", "com", ""),
    urlfilter.Rule("allow", "com", ""),
    urlfilter.Rule("block", "", "/"),
]


def by_hand(url, rules):
    host, path = urlfilter.split_url(url)
    fits = [
        r
        for r in rules
        if r.host
        and (host == r.host or host.endswith("." + r.host))
        and path.startswith(r.path)
    ]
    best = max(fits, key=lambda r: (len(r.host + r.path), len(r.host), r.verdict == "block"), default=None)
    return host, path, best and best.host + best.path, best.verdict if best else "allow"


@pytest.mark.parametrize("trie_rules", [1_000, 2])
def test_longest_rule_wins(spark, trie_rules):
    rules = RULES if trie_rules > 2 else [r for r in RULES if r.path]
    frame = spark.createDataFrame(
        [(i, u, "own") for i, u in enumerate(URLS)], "page_id long, url string, rule string"
    )
    found = urlfilter.judge(frame, rules, trie_rules=trie_rules).collect()
    assert len(found) == len(URLS)
    for r in found:
        assert (r.host, r.path, r.rule, r.verdict) == by_hand(URLS[r.page_id], rules)


def test_url_rows(spark):
    frame = spark.createDataFrame([(1, "http://x.org/", "v")] * 3 + [(None, None, "v")], "page_id long, url string, verdict string")
    found = urlfilter.judge(frame, RULES).collect()
    assert sorted((r.page_id is None, r.host, r.verdict) for r in found) == [(False, "x.org", "allow")] * 3 + [(True, "", "allow")]
    assert urlfilter.judge(frame.limit(0), RULES).count() == 0
    assert urlfilter.judge(frame, []).count() == 4


def test_url_parts():
    assert urlfilter.split_url("HTTP://A.Bc:80/P/q?r#s") == ("a.bc:80", "/P/q")
    assert urlfilter.split_url("x://h#f/g") == ("h", "")
    assert urlfilter.split_url(None) == urlfilter.split_url("h/p") == ("", "")


def test_trie_with_many_rules():
    rules = [urlfilter.Rule("block", "h.x", f"/{'p' * i}") for i in range(40)]
    assert urlfilter.Trie(rules).match("a.h.x", "/" + "p" * 17 + "q/") == rules[17]


class FixedTagger:
    """Tags given places of one text in whatever window shows a part of them."""

    def __init__(self, text, spans):
        self.text, self.found = text, spans

    def spans(self, windows):
        out = []
        for w in windows:
            at = self.text.index(w)
            parts = [(k, max(0, a - at), min(len(w), b - at), s) for k, a, b, s in self.found]
            out.append([p for p in parts if p[1] < p[2]])
        return out


def test_long_spans_are_joined_over_windows(monkeypatch):
    monkeypatch.setattr(pii, "_plausible", lambda kind, text: True)
    monkeypatch.setattr(pii, "base_spans", lambda text: [])
    r = random.Random(4)
    text = "".join(r.choice("abcdefgh") for _ in range(900)) + "@"
    for a, b in [(30, 901), (840, 901), (500, 901), (700, 890)]:
        found = pii.find_spans([text], FixedTagger(text, [("email", a, b, 0.95)]))
        assert found == [[("email", a, b, False)]]


def test_bad_spans_do_not_displace_good_ones(monkeypatch):
    monkeypatch.setattr(pii, "_plausible", lambda kind, text: kind != "card")
    monkeypatch.setattr(pii, "base_spans", lambda text: [("ip", 40, 50)])
    text = "x1" * 40
    tagger = FixedTagger(
        text,
        [("card", 0, 30, 0.99), ("email", 5, 25, 0.95), ("phone", 30, 45, 0.99), ("email", 31, 39, 0.92)],
    )
    found = pii.find_spans([text], tagger)[0]
    assert found == [("email", 5, 25, False), ("email", 31, 39, False), ("ip", 40, 50, True)]


# --- html -------------------------------------------------------------------------------------


def test_layout():
    page = (
        "<!DOCTYPE html><title>no</title><style>p{}</style><h1>A &amp; B</h1>one\n two<p>three<p>four"
        "<br>five<ul><li>x<li>y<ol start=3><li>z<li>w</ol></ul>"
        "<table><tr><th>k<th>value<tr><td>long key<td>1<tr hidden><td>no</table>"
        "<div style='display: none'>no</div><pre>a\n  b</pre><!-- no --><script>'</p>'</script>end &lt;"
    )
    assert htmltext.visible_text(page) == (
        "A & B\n\none two\n\nthree\n\nfour\nfive\n\n- x\n- y\n  3. z\n  4. w\n\n"
        "k         value\nlong key  1\n\na\n  b\n\nend <"
    )


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("plain", "plain"),
        ("a < b > c", "a < b > c"),
        ("<p", "<p"),
        ("<b title='>'>x</b", "x"),
        ("<script>never closed", ""),
        ("</p></div>x</b>", "x"),
        ("<p>&lt;p&gt;&#33;&nbsp;x", "<p>!\xa0x"),
        ("<td>stray</td>cell", "stray\ncell"),
    ],
)
def test_broken_pages(page, text):
    assert htmltext.visible_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ("<html><head><title>x</title><body><p>text", "text"),
        ("<html><head><title>x</title><meta charset=utf-8><p>text", "text"),
        ("<head><title>x</title>\n text <b>more</b>", "text more"),
        ("<head><style>a{}</style><link rel=x></body>text", "text"),
        ("<head><script>a</script><template><p>no</p></template><html lang=en> <!-- --> <h1>a</h1>b", "a\n\nb"),
        ("<head><title>x</title></head><body>a<head><title>no</title>b</head>c", "abc"),
        ("<head></head><head><p>text", "text"),
        ("text<head>more", "textmore"),
        ("<head><title>x</title></head> <body>text", "text"),
    ],
)
def test_head_ends_where_the_body_begins(page, text):
    assert htmltext.visible_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ("a <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math> b", "a x=1 2 b"),
        ("<math><semantics><mi>y</mi><annotation>no</annotation></semantics></math>", "y"),
        ("<svg><title>no</title><desc>no<b>no</b></desc><path/><text>one</text><text>two</text></svg>", "one\ntwo"),
        ("<svg><title/><style/><text>one</text></svg><p>two", "one\n\ntwo"),
        ("<svg/><math/>x<text>y</text>", "xy"),
        ("<select><option>a<option selected>b &amp;lt;<option>c</select>d", "b &lt; d"),
        ("<select><option disabled>a<option>b</select>", "b"),
        ("<select><option hidden disabled selected>Choose<option>b</select>", "Choose"),
        ("<select multiple><optgroup label=G><option>a<option label='&lt;B'>b</select>c", "G\na\n<B\nc"),
        ("<select size=2><option>a<optgroup label=G><option>b<optgroup label=H></select>", "a\nG\nb\nH"),
        ("<select><option>a<input>b", "a b"),
        ("x<textarea>\none\n  two &lt;p&gt;<p></textarea>y", "x\none\n  two <p><p>\ny"),
        ("<pre>a <textarea>&amp;lt;</textarea><select><option>b<option>c</select></pre>", "a &lt; b"),
        ("<p>a <i aria-hidden='true'>b</i>", "a b"),
        ("<p>a <i hidden>b</i><datalist><option>no</datalist>", "a"),
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>", "a  b\n   c\nd  e"),
        ("<table><tr><td>a<td rowspan=2 colspan=2>b<td>c<tr><td>d<td>e</table>", "a  b    c\nd       e"),
        ("<table><tbody><tr><td rowspan=0>a<td>b<tr><td>c<tbody><tr><td>d<td>e</table>", "a  b\n   c\nd  e"),
    ],
)
def test_what_a_browser_shows(page, text):
    assert htmltext.visible_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        # visibility is inherited and can be taken back
        ("a<div style='visibility:hidden'>no<b style='visibility: visible'>b<i>c</i></b>no</div>d", "a\nbc\nd"),
        ("<p style='visibility:hidden'>no<span>no</span><p>a", "a"),
        ("<div style='visibility:hidden'><span style='display:none; visibility:visible'>no</span></div>a", "a"),
        ("<div style='display:none; display:block'>a</div>", "a"),
        ("<i style='visibility:visible; visibility:collapse'>no</i>a", "a"),
        ("<ol><li>a<li style='visibility:hidden'>no<li>b</ol>", "1. a\n3. b"),
        ("<ol><li>a<li style='display:none'>no<li>b</ol>", "1. a\n2. b"),
        ("<table><tr><td>a<td style='visibility:hidden'>no<td>b</table>", "a    b"),
        ("<div style='visibility:hidden'>x <textarea>no</textarea><input value=no></div>a", "a"),
        # what opens
        ("<details><summary>a</summary><p>no<ul><li>no</ul></details>b", "a\nb"),
        ("<details open><summary>a</summary>b</details>", "a\nb"),
        ("<details>no<summary>a</summary><summary>no</summary></details>", "a"),
        ("<dialog>no</dialog>a<dialog open>b</dialog>", "a\nb"),
        ("<pre>a<details>no<summary>b</summary></details></pre>", "ab"),
        # inputs and buttons
        ("a <input type=submit value='Send &amp; go'> b", "a Send & go b"),
        ("<input type='BUTTON' value=x><input type=reset value=y><button>z</button>", "x y z"),
        ("<input type=hidden value=no><input type=checkbox value=no><input type=password value=no>a", "a"),
        ("<input value='typed &lt;b&gt;'><input placeholder=hint><input type=submit placeholder=no>", "typed <b> hint"),
        # numbers of lists
        ("<ol><li>a<li value=7>b<li>c</ol>", "1. a\n7. b\n8. c"),
        ("<ol reversed><li>a<li>b<li value=9>c<li>d</ol>", "4. a\n3. b\n9. c\n8. d"),
        ("<ol reversed start=2><li>a<li hidden>no<li>b<li>c</ol>", "2. a\n1. b\n0. c"),
        ("<ol start=-1><li>a<li value=x>b</ol><ul><li value=3>c</ul>", "-1. a\n0. b\n\n- c"),
        # spans as HTML reads them
        ("<table><tr><td colspan=' 2x'>a<td>b<tr><td>c<td>d<td>e</table>", "a     b\nc  d  e"),
        ("<table><tr><td colspan=0 rowspan=-1>a<td>b<tr><td>c<td>d</table>", "a  b\nc  d"),
    ],
)
def test_what_a_browser_leaves_out(page, text):
    assert htmltext.visible_text(page) == text


@pytest.mark.parametrize("given, columns", [("999", 999), ("1000", 1_000), ("1001", 1_000), ("9" * 30, 1_000)])
def test_wide_cells(given, columns):
    row = f"<table><tr><td colspan={given}>a<td>b<tr>" + "<td>c" * 1_001 + "</table>"
    first = htmltext.visible_text(row).split("\n")[0]
    assert first == "a" + " " * (3 * columns - 1) + "b"


def test_deep_nesting_keeps_all_text():
    deep = "<ul><li>" * 3_000 + "x" + "<table><tr><td>" * 500 + "y" + "<div>" * 20_000 + "z"
    assert re.sub(r"[\s-]", "", htmltext.visible_text(deep)) == "xyz"


def test_pages_table(spark):
    frame = spark.createDataFrame([(1, None, "t"), (1, "<p>a", "t")], "page_id long, html string, text string")
    assert sorted(r.text for r in htmltext.extract(frame).collect()) == ["", "a"]
    assert htmltext.extract(frame.limit(0)).columns == ["page_id", "html", "text"]


# --- tokens -----------------------------------------------------------------------------------

POOL = "abcXYZéÀßÿ'_-.,!? \n\t½²0129stredlm¡ɎİıªÂ×\xa0\x85\x1ć日🎉"
SPECIAL = ["", "a  <|endoftext|> b", "<|startoftext|>x<|endoftext|>", "don't  'll", " \n\n x  ", "<|endo"]


def random_texts(n=3_000, seed=3):
    r = random.Random(seed)
    return ["".join(r.choice(POOL) for _ in range(r.randint(0, 50))) for _ in range(n)] + SPECIAL


def test_counts_of_odd_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok, count = Tokenizer.from_file(path), tokencount.counter(path, {"a": 1})
    for t in random_texts():
        assert count(t) == len(tok.encode(t, add_special_tokens=False).ids), t
    assert count(None) == 0
    small = tokencount.Lengths({" the": 1}, tok, limit=3)
    assert small.count("the the cat sat on the mat the") == 8


def test_token_counts_through_spark(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    texts = [None, "", "a b", "a b", "word " * 60_000, "x" * 20_000, "<|endoftext|> odd\ud7ff"]
    rows = [(i, t, "n") for i, t in enumerate(texts)] + [(None, "no id", "n"), (2, "a b", "n")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    found = tokencount.count_tokens(frame, path).collect()
    expected = Counter((i, len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows)
    assert Counter((r.doc_id, r.n_tokens) for r in found) == expected
    assert tokencount.count_tokens(frame.limit(0), path).count() == 0


def test_frequent_pieces_of_the_whole_corpus(spark):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    first = spark.range(2_500).selectExpr("'early' AS text")
    texts = ["x" * 5_000 + " far away", None, "", "late " * 50]
    rest = spark.createDataFrame([(t,) for t in texts], "text string")
    found = tokencount.frequent_lengths(first.union(rest), path)
    assert {"early", " far", " away", "late", " late"} <= found.keys()
    assert tokencount.frequent_lengths(first.limit(0), path) == {}
    many = spark.range(0, 3_000, 1, 6).selectExpr("concat('a b ', id) AS text")
    assert {"a", " b"} <= tokencount.frequent_lengths(many, path, room=16).keys()


@pytest.fixture(scope="module")
def words():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return path, bpe.tokenizer(path)


def test_ids_of_odd_texts(words):
    path, tok = words
    encoder = bpe.PieceEncoder(path)
    for t in random_texts():
        assert encoder.encode(t) == bpe.np.array(
            tok.encode(t, add_special_tokens=False).ids, "<u4"
        ).tobytes(), t


HARD = [
    "".join(random.Random(1).choice("abcdefghij") for _ in range(3_000)),
    "é日本語🎉é" * 200,
    "the" * 1_000,
    "a" * 2_000,
    "x<|endoftext|>y" * 100,
    " " * 1_500 + "abc",
    "!!!'s'sall" * 100,
    "ab" + " " * 900 + "cd" + "\u0301" * 200,
    "İΣσ" * 200,
]


@pytest.fixture(scope="module")
def byte_level():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return path, bpe.tokenizer(path)


def test_other_vocabularies_are_left_to_the_library(words, byte_level):
    assert bpe.splits_as_spelled_out(words[1]) and not bpe.splits_as_spelled_out(byte_level[1])


@pytest.mark.parametrize("vocabulary", ["words", "byte_level"])
@pytest.mark.parametrize("size", [37, 256, 1_000])
@pytest.mark.parametrize("text", HARD, ids=range(len(HARD)))
def test_joined_parts_are_the_whole(request, vocabulary, text, size):
    _, tok = request.getfixturevalue(vocabulary)
    parts = bpe.cut(text, size)
    assert "".join(parts) == text and max(map(len, parts)) <= size
    at = [sum(map(len, parts[:i])) for i in range(len(parts))]
    found = bpe.joined(tok, parts, [bpe.tokens_of(tok, p, n) for p, n in zip(parts, at, strict=True)])
    assert found.tolist() == tok.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("vocabulary", ["words", "byte_level"])
def test_long_texts_through_spark(spark, request, vocabulary):
    path, tok = request.getfixturevalue(vocabulary)
    texts = [None, "", *HARD, HARD[0], "The 3 Cats' hats,\tall of THEM!"]
    frame = docs(spark, [(i, t, "x") for i, t in enumerate(texts)]).withColumnRenamed("lang", "ids")
    ids = bpe.encode(frame, path, part_chars=500)
    found = bpe.decode(ids, path).collect()
    assert len(found) == len(texts)
    for r in found:
        expected = tok.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert bpe.np.frombuffer(bytes(r.ids), "<u4").tolist() == expected
        assert r.decoded == tok.decode(expected, skip_special_tokens=False)
    both = bpe.encode(frame.withColumnRenamed("text", "Decoded"), path, text="Decoded", part_chars=500, into="decoded")
    assert both.columns == ["doc_id", "ids", "decoded"]
    assert sorted(map(str, both.select("doc_id", "ids", "decoded").collect())) == sorted(
        str(r) for r in bpe.decode(ids, path).select("doc_id", "ids", "decoded").collect()
    )
    assert bpe.encode(frame.limit(0), path).count() == 0


# --- language ---------------------------------------------------------------------------------


def test_language_edges(spark):
    rows = [(i, f"the cat and the dog {i}", "en") for i in range(30)]
    rows += [(i, f"le chat et la souris {i}", "fr") for i in range(30, 60)]
    rows += [(60, None, "en"), (61, "", "fr"), (62, "123 !?", "en"), (63, "the dog", None), (63, "la souris " * 90_000, None)]
    frame = docs(spark, rows).withColumnRenamed("doc_id", "score")
    model = language.train(frame)
    assert model.languages == ("en", "fr")
    found = language.identify(frame, model).collect()
    assert len(found) == len(rows)
    for r in found:
        if not r.text or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred == (r.lang or ("en" if r.text == "the dog" else "fr"))
            assert 0.5 < r.score <= 1
    none = language.train(docs(spark, []))
    assert language.identify(docs(spark, rows[:1]), none).collect()[0].lang_pred == "und"


def test_features_do_not_depend_on_neighbours():
    texts = ["Der Hund", "", "a", "Ünïcode 12 texte!", "日本"]
    together, counts = language.features(texts)
    alone = [language.features([t])[0] for t in texts]
    assert [len(a) for a in alone] == counts.tolist()
    assert sorted(together.tolist()) == sorted(x for a in alone for x in a.tolist())


def plain_grams(text):
    """Buckets of the n-grams of a text, one at a time."""
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    if not words:
        return []
    shown, top = f" {' '.join(words)} ", (1 << 64) - 1
    out = []
    for i in range(len(shown)):
        h = 0
        for n in range(1, 4):
            if i + n > len(shown):
                break
            c = ord(shown[i + n - 1])
            h = (h * 0x9E3779B97F4A7C15 & top) ^ ((c + n) * 0xC2B2AE3D27D4EB4F & top)
            if n > 1 or c != 32:
                mixed = (h ^ (h >> 29)) * 0xBF58476D1CE4E5B9 & top
                out.append((mixed >> 40) % language.BUCKETS)
    return out


class PlainBayes:
    """Multinomial naive Bayes, by the book."""

    def __init__(self, pairs):
        self.counts, self.rows = {}, Counter()
        for text, lang in pairs:
            if text is not None and lang is not None:
                self.rows[lang] += 1
                self.counts.setdefault(lang, Counter()).update(plain_grams(text))

    def predict(self, text):
        grams = plain_grams(text)
        if not grams:
            return "und", 0.0
        logs = {}
        for lang, counts in self.counts.items():
            below = counts.total() + language.SMOOTHING * language.BUCKETS
            logs[lang] = math.log(self.rows[lang] / self.rows.total()) + sum(
                math.log((counts[g] + language.SMOOTHING) / below) for g in grams
            )
        best = max(sorted(logs), key=logs.get)
        return best, 1 / sum(math.exp(x - logs[best]) for x in logs.values())


def test_language_is_that_of_plain_naive_bayes(spark):
    import pyarrow.parquet as pq

    from tapewright.llm.queries import language_id

    sf_dir = "/root/testdata/sf0.001"
    table = pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()
    found = {r.doc_id: r for r in language_id(spark, sf_dir).collect()}
    plain = PlainBayes((d["text"], d["lang"]) for d in table if not found[d["doc_id"]].held_out)
    assert len(found) == len(table)
    for d in table:
        if len(d["text"] or "") < 20_000:
            lang, score = plain.predict(d["text"])
            got = found[d["doc_id"]]
            assert got.lang_pred == lang and got.score == pytest.approx(score, abs=1e-3)


def test_only_the_commonest_languages_are_learnt(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_LANGUAGES", 2)
    rows = [(i, f"text {i}", lang) for i, lang in enumerate(["c", "b", "a", "b", "c", "d", None])]
    assert language.train(docs(spark, rows)).languages == ("b", "c")
    rows.append((9, "more", "a"))
    assert language.train(docs(spark, rows)).languages == ("a", "b")


# --- personal data ----------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(6))
def test_decoding_finds_the_best_of_all_paths(seed):
    r = np.random.default_rng(seed)
    tagger = pii.Tagger.fresh(seed)
    tagger.p["trans"] = r.normal(size=tagger.p["trans"].shape)
    steps, n = 4, 3
    score, trans = r.normal(size=(steps, n, pii.TAGS)), tagger.transitions()
    found = tagger.decode(score)

    def worth(path, k):
        start = score[0, k, path[0]] + (-1e4 if path[0] and path[0] % 2 == 0 else 0)
        return start + sum(trans[a, b] + score[t, k, b] for t, (a, b) in enumerate(zip(path, path[1:]), 1))

    for k in range(n):
        best = max(itertools.product(range(pii.TAGS), repeat=steps), key=lambda p: worth(p, k))
        assert tuple(found[:, k]) == best


@pytest.mark.parametrize("seed", range(10))
def test_spans_of_windows_are_reconciled_best(seed):
    r = random.Random(seed)
    spans = []
    for _ in range(r.randint(0, 9)):
        a = r.randrange(20)
        spans.append((r.choice(["email", "ip"]), a, a + r.randint(1, 8), r.randint(1, 99) / 100))
    apart = [
        some
        for n in range(len(spans) + 1)
        for some in itertools.combinations(spans, n)
        if all(x[2] <= y[1] or y[2] <= x[1] for x, y in itertools.combinations(some, 2))
    ]
    chosen = pii._reconcile(spans)
    assert sum(s for *_, s in chosen) == pytest.approx(max(sum(s for *_, s in some) for some in apart))
    assert all(x[2] <= y[1] for x, y in zip(chosen, chosen[1:]))

PII = [
    "",
    "mail a.b+c@x-y.example.com, again a@b@c.de. x@y no @z.com",
    "ip 10.0.0.255 and 1.2.3.256 and 1.2.3.4.5.6.7.8 and 0001.02.3.4",
    "card 4539 1488 0343 6467, 4539-1488-0343-6468 and 4539148803436467",
    "phone +1 (269) 555-3296 or +12 345 and +123456789012345678",
    "é" * 100 + "+49 30 1234567 é a@b.c " + "7" * 40,
    "a" * 60_000 + " @ " + "1" * 60_000 + "b@c.d",
]


def plain_spans(text):
    luhn = lambda d: sum(
        sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))
    ) % 10 == 0
    out = []
    for kind, pattern in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            if (
                kind == "email"
                or kind == "ip" and all(int(x) <= 255 for x in m.group().split("."))
                or kind == "card" and 13 <= len(d) <= 19 and luhn(d)
                or kind == "phone" and 9 <= len(d) <= 15
            ):
                out.append((kind, m.start(), m.end()))
    return out


@pytest.mark.parametrize("text", PII[:-1])
def test_exact_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_long_runs_are_quick():
    assert pii.base_spans(PII[-1]) == [("email", 60_003, 120_008)]


def test_random_patterns():
    r = random.Random(5)
    for _ in range(4_000):
        t = "".join(r.choice("ab.@+-() 0123456789é") for _ in range(r.randint(0, 60)))
        assert pii.base_spans(t) == plain_spans(t), t


@pytest.fixture(scope="module")
def tagger():
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()
    windows = [w for t in texts for w in pii.labelled_windows(t)]
    return pii.fit(windows[: len(windows) // 2], epochs=5), texts


def test_tagger_finds_what_it_was_taught(tagger):
    model, texts = tagger
    right = wrong = missed = 0
    for text in texts[len(texts) // 2 :]:
        known = set(pii.base_spans(text))
        found = set()
        for at in pii._window_starts(text):
            for k, a, b, _ in model.spans([text[at : at + pii.WINDOW]])[0]:
                found.add((k, at + a, at + b))
        right += len(known & found)
        missed += len(known - found)
    assert right > 20 and right / (right + missed) > 0.8


def test_base_spans_stay_and_clean_texts_have_none(tagger):
    model, texts = tagger
    for text, spans in zip(texts, pii.find_spans(texts, model), strict=True):
        assert [x[:3] for x in spans if x[3]] == pii.base_spans(text)
        if not re.search("[0-9@]", text):
            assert not spans
    plain = ["", "Nothing here.", "Version 2.0 of 2024"]
    assert pii.find_spans(plain, model) == [[], [], []]


def test_gradients():
    import numpy as np

    texts = [("call +1 269 555 3296 now", [("phone", 5, 20)]), ("a@b.c", [("email", 0, 5)])]
    ids, mask = pii.encode([t for t, _ in texts])
    tags = np.stack([pii._labels(s) for _, s in texts], axis=1)
    model = pii.Tagger({k: v.astype(np.float64) for k, v in pii.Tagger.fresh().p.items()})

    def loss():
        score = model.emissions(ids, mask)
        log_sum = model.marginals(score)[2]
        gold = score[np.arange(len(ids))[:, None], np.arange(2), tags].sum(0)
        gold += model.transitions()[tags[:-1], tags[1:]].sum(0)
        return float((log_sum - gold).mean())

    grads = model.gradients(ids, mask, tags)
    for key in ("whf", "wxb", "emb", "wo", "trans"):
        i = np.unravel_index(np.abs(grads[key]).argmax(), grads[key].shape)
        old, h = model.p[key][i], 1e-3
        model.p[key][i] = old + h
        up = loss()
        model.p[key][i] = old - h
        down = loss()
        model.p[key][i] = old
        assert abs((up - down) / (2 * h) - grads[key][i]) < 1e-2 * max(1, abs(grads[key][i])), key


def test_reconciled_spans_are_apart():
    spans = [("a", 0, 5, 0.6), ("b", 4, 9, 0.7), ("c", 8, 12, 0.6), ("b", 4, 9, 0.9)]
    assert pii._reconcile(spans) == [("a", 0, 5, 0.6), ("c", 8, 12, 0.6)]
    assert pii._reconcile(spans[1:2]) == spans[1:2] and pii._reconcile([]) == []


def test_personal_data_table(spark):
    rows = [(1, None, "x"), (1, "", "x"), (2, PII[1], "x"), (2, PII[1], "x")]
    frame = docs(spark, rows).withColumnRenamed("lang", "pii")
    assert pii.train(frame.limit(0)) is None
    found = pii.find(frame, None, redact=True).collect()
    assert sorted(map(len, (r.pii for r in found))) == [0, 0, 2, 2]
    text = "mail [EMAIL], again a@[EMAIL]. x@y no @z.com"
    assert pii.redacted("a 1.2.3.4 b", [("ip", 2, 9, True), ("phone", 4, 9, False)]) == "a [IP] b"
    assert {r.text for r in found} == {None, "", text}
