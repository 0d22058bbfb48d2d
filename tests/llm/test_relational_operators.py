"""Operators that gather over the corpus, against brute force, with the edges."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tapewright.llm import components, jaccard, neighbours, ngrams

DOC = "doc_id long, text string, n_words string"


def sentences(n, seed, words=9):
    r = random.Random(seed)
    return [" ".join(r.choice(["a", "b", "c", "dd", "E", "é"]) for _ in range(r.randint(0, words))) for _ in range(n)]


# --- Jaccard join -----------------------------------------------------------------------------


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in text or ""
    )) if w]
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def classes(rows):
    sets = {}
    for i, t in rows:
        if i is not None:
            sets[i] = sets.get(i, set()) | shingles(t)
    label = {i: i for i in sets}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                label[y] = x
    return {i: (len(sets[i]), top(i)) for i in sets}


def near_copies(seed):
    """Chains of texts that each change a little, sharing a passage with unlike ones."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefg") for _ in range(4))
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(12):
        text = [word() for _ in range(r.choice([6, 30, 80]))]
        if r.random() < 0.5:
            text += passage
        for _ in range(r.randint(1, 9)):
            texts.append(" ".join(text))
            text = list(text)
            for _ in range(r.randint(0, 3)):
                text[r.randrange(len(text))] = word()
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize("frequent, broadcast", [(64, 10**6), (3, 0)])
def test_all_links_and_no_other(spark, monkeypatch, frequent, broadcast):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard, "BROADCAST_IDS", broadcast)
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 700)
    texts = near_copies(1) + ["one two", "One  two", "one", "", "  \n", None, "a b c d e", "a b c d e f"]
    texts += sentences(40, 4, 12) + ["word " * 30_000, "word " * 30_001, "x y z q w " * 5_000]
    rows = [(i * 7 % 1_009, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame([(i, t, "n") for i, t in rows] + [(None, "one two", "n")], DOC)
    found = jaccard.join(frame).collect()
    expected = classes(rows)
    assert len(found) == len(rows) + 1
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found if r.doc_id is not None} == expected
    assert [r.component_id for r in found if r.doc_id is None] == [None]
    assert len({c for _, c in expected.values()}) < len(expected) - 20


def test_repeated_rows_and_no_rows(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (3, "q r s t u v")]
    frame = spark.createDataFrame([(*x, "n") for x in rows], DOC)
    found = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join(frame).collect())
    assert found == [(1, 3, 1), (1, 3, 1), (2, 3, 1), (3, 2, 3)]
    assert jaccard.join(frame.limit(0)).count() == 0


def test_components_of_a_chain(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, 5), (None, 3), (9, 7), (9, 7), (3, 9)]
    found = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    expected = {i: 100 for i in range(100, 161)} | {3: 3, 7: 3, 9: 3}
    assert {r.node: r.component for r in found} == expected


# --- language model ---------------------------------------------------------------------------


def counted(texts):
    pair, word = Counter(), Counter()
    for ws in texts:
        pair.update(zip(["", *ws], ws, strict=False))
        word.update(ws)
        word[""] += bool(ws)
    return pair, word


def backoff(docs, corpus, without_own):
    """Mean logarithm by the written rule; texts as lists of words. Also how each place was scored."""
    pair, word = counted(corpus)
    total = sum(map(len, corpus))
    out, ways = {}, Counter()
    for key, texts in docs.items():
        logs = []
        for ws in texts:
            own_pair, own_word = counted([ws] if without_own else [])
            left = max(total - (len(ws) if without_own else 0), 1)
            for v, w in zip(["", *ws], ws, strict=False):
                others = pair[v, w] - own_pair[v, w]
                alone = word[w] - own_word[w]
                if others > 0:
                    logs.append(math.log(others / (word[v] - own_word[v])))
                else:
                    logs.append(math.log(ngrams.BACKOFF * (alone if alone > 0 else ngrams.UNKNOWN) / left))
                ways["pair" if others > 0 else "word" if alone > 0 else "never"] += 1
        out[key] = (len(logs), sum(logs) / len(logs) if logs else None)
    return out, ways


def split(text):
    return [w.decode() for w in ngrams.words(text)]


@pytest.mark.parametrize(
    "hot, block, known", [(4_000, 1 << 21, 1 << 20), (12, 40, 3), (1, 40, 0), (4_000, 40, 9), (30, 1 << 21, 4)]
)
def test_scores_follow_the_rule(spark, monkeypatch, hot, block, known):
    monkeypatch.setattr(ngrams, "BLOCK_WORDS", block)
    texts = sentences(120, 1) + [None, "", "...", "rare words only", "a " * 30_000]
    texts += ["words of their own twice", "words of their own twice", "x y x y x y", "only rare words"]
    other = sentences(60, 2) + ["unknown things", "a zz a", None, ""]
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    rows += [(3, texts[3], "x"), (None, "a b a b", "x"), (-5, "b c", "x")]
    frame = spark.createDataFrame(rows, DOC)
    corpus = [split(t) for _, t, _ in rows]

    options = {"hot": hot, "known": known}

    def check(found, docs, against, without_own):
        grouped = {}
        for i, t, _ in docs:
            if i is not None:
                grouped.setdefault(i, []).append(split(t))
        expected, ways = backoff(grouped, against, without_own)
        assert not against or min(ways[x] for x in ("pair", "word", "never")) > 0
        got = {r.doc_id: (r.n_words, r.score) for r in found.collect()}
        assert got.keys() == expected.keys()
        for k, (n, s) in expected.items():
            assert got[k][0] == n
            assert got[k][1] is None if s is None else got[k][1] == pytest.approx(s, abs=1e-5)

    check(ngrams.score(frame, **options), rows, corpus, True)
    asked = [(i, t, "x") for i, t in enumerate(other)]
    asked_frame = spark.createDataFrame(asked, DOC)
    check(ngrams.score(asked_frame, frame, **options), asked, corpus, False)
    check(ngrams.score(asked_frame, frame.limit(0), **options), asked, [], False)


def test_no_documents_no_scores(spark):
    assert ngrams.score(spark.createDataFrame([], DOC)).count() == 0


# --- nearest neighbours -----------------------------------------------------------------------

VECTOR = "vec_id long, embedding array<double>, score string"


def exact(rows, k, asks):
    usable = {
        (i, tuple(v))
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    usable = {(i, v) for i, v in usable if len(v) == 3}
    out = []
    for q, v in sorted(usable):
        if not asks(q):
            continue
        near = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in usable if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(near[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [16_384, 4])
def test_small_tables_are_searched_exactly(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", block)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", block)
    r = random.Random(2)
    rows = [(i, [float(r.randint(-3, 3)) for _ in range(3)]) for i in range(60)]
    rows += [(i, [1.0, 2.0, 3.0]) for i in range(100, 140)] + [rows[5], rows[5]]
    rows += [
        (200, None),
        (201, []),
        (202, [0.0, 0.0, 0.0]),
        (203, [1.0, None, 1.0]),
        (204, [float("nan"), 1.0, 1.0]),
        (205, [float("inf"), 1.0, 1.0]),
        (206, [1.0, 2.0]),
        (None, [9.0, 9.0, 9.0]),
    ]
    frame = spark.createDataFrame([(i, v, "s") for i, v in rows], VECTOR)
    found = neighbours.search(frame, is_query="vec_id % 4 = 0", k=7).collect()
    got = sorted((x.query_id, x["rank"], x.vec_id, x.score) for x in found)
    assert got == exact(rows, 7, lambda q: q % 4 == 0)


def test_fewer_candidates_than_asked_for(spark):
    frame = spark.createDataFrame([(1, [1.0], "s"), (2, [-2.0], "s")], VECTOR)
    found = sorted(tuple(x) for x in neighbours.search(frame).collect())
    assert found == [(1, 1, 2, -2.0), (2, 1, 1, -2.0)]
    assert neighbours.search(frame.limit(0)).count() == 0
    assert neighbours.search(frame.limit(1)).count() == 0


def test_recall_on_random_vectors():
    r = np.random.default_rng(4)
    x = r.normal(size=(4_000, 16))
    model = neighbours.centroids(x, float(np.linalg.norm(x, axis=1).max()), 4_000)
    lists = neighbours._chosen(model, model.lifted(x))
    assert all(len(own) == len(set(own)) >= 1 for own in lists)
    sizes = np.bincount([own[0] for own in lists], minlength=len(model.points))
    assert sizes.max() < 12 * sizes.mean()
    ids, far = model.search(model.aimed(x[:50]), 8)
    gap = np.sqrt(((model.aimed(x[:50])[:, None] - model.points) ** 2).sum(2))
    best = np.argsort(gap, axis=1)[:, :8]
    assert np.mean([len(set(a) & set(b)) / 8 for a, b in zip(ids.tolist(), best.tolist(), strict=True)]) > 0.9
