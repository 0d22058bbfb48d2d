"""The stages of the pipeline, each against a plain version, with the edges."""

import random
import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tapewright.llm import language, pii, queries

# A column that clashes with those of the operators, and others that stages must give back as they are.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, ids int, hit_words int"
STAGES = dict(corpus_pipeline.STAGES)
ALPHABETS = {"aa": "abcdefg", "bb": "uvwxyz"}


def row(doc_id, text, lang=None):
    return (doc_id, text, lang, "s", None if text is None else len(text), "x", 1, None)


def prose(r, lang, n):
    return " ".join("".join(r.choice(ALPHABETS[lang]) for _ in range(r.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    out = [row(i, prose(r, lang, 30), lang) for i, lang in enumerate(["aa", "bb"] * 12)]
    out += [row(100, out[0][1]), row(101, out[0][1] + " more"), row(4, out[4][1], "aa")]
    out += [row(200, None), row(201, ""), row(202, "123 456"), row(None, out[2][1], "aa"), row(None, None)]
    out += [row(300, prose(r, "aa", 60_000), "aa"), row(301, out[1][1] + " write to me@mail.org or +1 202 555 0170 99", "bb")]
    out += [row(302, "the quick brown fox " + out[3][1], "bb")]
    return out


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory, rows):
    """A folder with the two tables that the stages read."""
    path = str(tmp_path_factory.mktemp("tables"))
    item = rows[5][1]
    spark.createDataFrame([(7, item), (8, "the quick brown fox"), (9, None)], "item_id long, text string").write.parquet(
        f"{path}/benchmark.parquet"
    )
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    return path


def run(spark, name, rows, sf_dir):
    docs = spark.createDataFrame(rows, SCHEMA)
    result = STAGES[name](spark, docs, sf_dir)
    if name != "tokens":
        assert result.dtypes == docs.dtypes
    return sorted(map(tuple, result.collect()), key=str)


def shingles(text):
    words = [w for w in re.split("[\\x20\\x09-\\x0D]+", (text or "").lower()) if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_language_id(spark, rows, sf_dir):
    model = language.train(spark.createDataFrame(rows, SCHEMA))
    langs, scores = language.score(model, [r[1] for r in rows])
    kept = [
        r for r, lang, p in zip(rows, langs, scores) if lang != "und" and p >= corpus_pipeline.LEAST_SCORE
    ]
    found = run(spark, "language_id", rows, sf_dir)
    assert found == sorted(kept, key=str)
    assert {200, 201, 202}.isdisjoint(r[0] for r in found) and len(found) >= 24


def test_near_duplicates(spark, rows, sf_dir):
    first = {}
    for r in rows:
        if r[0] is not None:
            first.setdefault(r[0], set()).update(shingles(r[1]))
    gone = {
        b
        for a in first
        for b in first
        if a < b and first[a] and 100 * len(first[a] & first[b]) >= 75 * len(first[a] | first[b])
    }
    assert gone == {100, 101, 302}
    assert run(spark, "near_duplicates", rows, sf_dir) == sorted((r for r in rows if r[0] not in gone), key=str)


def test_decontamination(spark, rows, sf_dir):
    items = [rows[5][1].split(), "the quick brown fox".split()]
    windows = {tuple(i[k : k + 13]) for i in items for k in range(max(1, len(i) - 12))}

    def contaminated(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())
        hit = {
            j
            for k in range(len(words))
            for n in (4, 13)
            if tuple(words[k : k + n]) in windows
            for j in range(k, k + n)
        }
        return bool(hit) and 20 * len(hit) >= len(words)

    kept = [r for r in rows if not contaminated(r[1])]
    assert {r[0] for r in rows} - {r[0] for r in kept} == {5, 302}
    assert run(spark, "decontamination", rows, sf_dir) == sorted(kept, key=str)


def test_personal_data(spark, rows, sf_dir):
    found = run(spark, "personal_data", rows, sf_dir)
    assert len(found) == len(rows)
    clean = [r for r in rows if r[0] != 301]
    assert [r for r in found if r[0] != 301] == sorted(clean, key=str)
    (changed,) = (r for r in found if r[0] == 301)
    assert "me@mail.org" not in changed[1] and "555" not in changed[1] and "write to" in changed[1]
    assert changed[4] == len(changed[1])
    assert not pii.base_spans(changed[1])


def test_tokens(spark, rows, sf_dir):
    tok = Tokenizer.from_file(public_tokenizers.path(queries.WORD_BPE))
    expected = []
    for doc_id, text, *_ in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        expected.append((doc_id, raw, len(ids), tok.decode(ids, skip_special_tokens=False)))
    found = run(spark, "tokens", rows, sf_dir)
    assert sorted(((a, bytes(b), c, d) for a, b, c, d in found), key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("name", STAGES)
def test_empty_tables(spark, name, sf_dir):
    assert run(spark, name, [], sf_dir) == []


def test_whole_pipeline(spark, rows, sf_dir):
    """Each stage works on all that the one before kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), SCHEMA)
    expected = {r.doc_id for r in docs.collect()}
    found = corpus_pipeline.run(spark, sf_dir)
    assert found.columns == ["doc_id", "ids", "n_tokens", "decoded"]
    assert {r.doc_id for r in found.collect()} == expected
    assert {0, 1, 300, 301} <= expected and expected.isdisjoint({5, 100, 101, 200, 201, 202, 302})
