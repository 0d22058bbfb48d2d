"""Licence scans against brute force: every place of every phrase, every match of every template."""

import random
import re
import string

import pytest

from tapewright.llm import licences
from tapewright.llm.licence_texts import MIT, PHRASES, TEMPLATES
from tapewright.llm.queries import license_scan

DOC = "doc_id long, text string, n_words string"
TINY = [("one", "a b c d e f g h"), ("two", "c d e f x y z a b"), ("one", "a b a b a b c"), ("three", "q r s")]
NAMES = [("one", "a b"), ("two", "e f x")]


def plain_words(text):
    lowered = "".join(c.lower() if c in string.ascii_uppercase else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_places(own, phrases):
    return sorted(
        (i, p)
        for p, (_, phrase) in enumerate(phrases)
        for i in range(len(own))
        if own[i : i + len(plain_words(phrase))] == plain_words(phrase)
    )


def plain_matches(own, template, least):
    """(start, end, place in the template) of all runs that neither side can be extended."""
    out = set()
    for i in range(len(own)):
        for j in range(len(template)):
            n = 0
            while i + n < len(own) and j + n < len(template) and own[i + n] == template[j + n]:
                n += 1
            if n >= least:
                out.add((i, i + n, j + n))
    return out


def longest_at(own, template):
    """For each end, the longest run ending there that the template holds."""
    runs = {tuple(template[a:b]) for a in range(len(template)) for b in range(a + 1, len(template) + 1)}
    return [
        next((n for n in range(e, 0, -1) if tuple(own[e - n : e]) in runs), 0)
        for e in range(1, len(own) + 1)
    ]


class Recorder(licences.Scan):
    def matched(self, template, end, n, state):
        super().matched(template, end, n, state)
        places = self.library.automaton.holders[state][template]
        self.seen = [*getattr(self, "seen", []), (template, end, n, tuple(places))]


def recorded(library, text, cut):
    found = Recorder(library)
    own = plain_words(text)
    ids = [library.vocabulary.get(w.encode(), -1) for w in own]
    for a in range(0, len(ids), cut):
        found.feed(licences.np.array(ids[a : a + cut], licences.np.int64))
    found.stop()
    return getattr(found, "seen", [])


@pytest.mark.parametrize("cut", [1, 3, 10**6])
@pytest.mark.parametrize("seed", range(12))
def test_matching_statistics(seed, cut):
    r = random.Random(seed)
    library = licences.Library(TINY, NAMES)
    text = " ".join(r.choice("abcdefxyzqrs!") for _ in range(r.choice([0, 5, 80])))
    own = plain_words(text)
    expected = set()
    for t, (_, body) in enumerate(TINY):
        template = plain_words(body)
        longest = longest_at(own, template)
        for e, n in enumerate(longest, 1):
            further = longest[e] if e < len(own) else 0
            if n >= library.needed[t] and further != n + 1:
                run = own[e - n : e]
                places = [j for j in range(n, len(template) + 1) if template[j - n : j] == run]
                expected.add((t, e, n, tuple(places)))
    seen = recorded(library, text, cut)
    assert set(seen) == expected and len(seen) == len(expected)


def plain_chains(matches):
    """The best score of a chain that ends with each match, all chains tried."""
    best = []
    for i, b in enumerate(matches):
        score = b.end - b.start
        for a, before in zip(matches[:i], best):
            if (
                a.start < b.start and a.end < b.end and a.place < b.place and a.first < b.first
                and b.start - a.end <= licences.GAP
            ):
                score = max(score, before + min(b.end - max(b.start, a.end), b.place - max(b.first, a.place)))
        best.append(score)
    return best


@pytest.mark.parametrize("seed", range(20))
def test_chains(seed):
    r = random.Random(seed)
    made = []
    for _ in range(40):
        start, n, first = r.randrange(150), r.randint(4, 9), r.randrange(40)
        made.append(licences.Match(start, start + n, first + n))
    made.sort(key=lambda m: m.end)
    spans = licences.spans_of(0, made)
    assert [m.score for m in made] == plain_chains(made)
    assert max(m.score for m in made) == spans[0].covered
    for i, s in enumerate(spans):
        assert all(s.end <= t.start or t.end <= s.start for t in spans[:i])


def test_whole_templates_are_found(spark):
    library = licences.Library()
    for t, (label, text) in enumerate(TEMPLATES):
        _, spans = library.scan(f"word {text} other words")
        whole = [s for s in spans if s.covered == library.sizes[t]]
        assert whole and label in {library.labels[s.template] for s in spans}


def test_changed_and_repeated_licences():
    library = licences.Library()
    own = MIT.split()
    changed = " ".join([*own[:40], "inserted", *own[40:90], *own[93:]])
    found, spans = library.scan(f"// {changed}\n" + "filler " * 100 + MIT * 3)
    assert [library.labels[s.template] for s in spans] == ["mit"] * 4
    assert spans[0].covered == len(plain_words(MIT)) - 3
    assert spans[1].start == len(plain_words(changed)) + 100
    _, half = library.scan(" ".join(own[: len(own) // 2]))
    assert half == []


def test_long_text_in_pieces(monkeypatch):
    library = licences.Library()
    text = ("é " * 50 + MIT + " MIT license " * 3) * 4
    whole, spans = library.scan(text)
    places = licences.offsets(text, spans)
    monkeypatch.setattr(licences, "SEGMENT", 61)
    cut, again = library.scan(text)
    assert (cut.n_words, cut.n_base, cut.first_word, cut.last_word) == (
        whole.n_words, whole.n_base, whole.first_word, whole.last_word
    )
    assert again == spans and licences.offsets(text, again) == places
    assert all(text[a:b].startswith("Permission") and text[a:b].endswith("SOFTWARE") for a, b in places)


def test_rows(spark):
    rows = [
        (1, "See the MIT License. mit-license", "x"),
        (2, None, None),
        (3, "", None),
        (None, "General  Public\nLICENSE", None),
        (4, "Licensed under CC BY-NC 4.0.", None),
        (4, "Licensed under CC BY-NC 4.0.", None),
        (5, "lone " + MIT, None),
    ]
    docs = spark.createDataFrame(rows, DOC)
    result = licences.scan(docs)
    assert result.columns[:2] == ["doc_id", "text"] and result.columns.count("n_words") == 1
    found = [tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")) for r in result.collect()]
    cc = (7, 0, None, None, [], ["cc-by-nc"], 1.0)
    assert found == [
        (6, 2, 2, 4, ["mit"], ["mit"], 0.5),
        (0, 0, None, None, [], [], 0.0),
        (0, 0, None, None, [], [], 0.0),
        (3, 1, 0, 0, ["gpl"], ["gpl"], 0.5),
        cc,
        cc,
        (1 + len(plain_words(MIT)), 0, None, None, [], ["mit"], 1.0),
    ]
    spans = result.collect()[-1]["licences"]
    assert [(s["label"], s["start"], s["share"]) for s in spans] == [("mit", rows[-1][1].index("Permission"), 1.0)]
    assert licences.scan(docs.limit(0)).count() == 0


def test_query_against_brute_force(spark):
    import pyarrow.parquet as pq

    sf_dir = "/root/testdata/sf0.001"
    library = licences.Library()
    table = {d["doc_id"]: d["text"] for d in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()}
    found = license_scan(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in found) == sorted(table)
    for r in found:
        own = plain_words(table[r.doc_id])
        places = plain_places(own, PHRASES)
        base = sorted({PHRASES[p][0] for _, p in places})
        assert (r.n_words, r.n_base, r.base_labels) == (len(own), len(places), ",".join(base))
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        # no template of the table's texts is broken up, so a span is one whole match
        whole = set()
        for t, (label, body) in enumerate(TEMPLATES):
            template = plain_words(body)
            if any(
                end - start >= licences.SHARE * len(template)
                for start, end, _ in plain_matches(own, template, library.needed[t])
            ):
                whole.add(label)
        assert set(base) <= set(filter(None, r.labels.split(",")))
        assert set(filter(None, r.labels.split(","))) - set(base) <= whole
        assert bool(whole) <= bool(r.labels) and 0 <= r.score <= 1
    assert any(r.n_base for r in found)
