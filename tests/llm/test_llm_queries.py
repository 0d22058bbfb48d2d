"""Queries of the subpackage against their SQL, and against brute force where there is none."""

import hashlib
import zlib
from html.parser import HTMLParser

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from checks.compare import differences, duckdb_over
from tapewright.llm import oracles, queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES = queries.queries()
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def documents():
    return pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()


def rows(spark, name):
    return QUERIES[name](spark, SF_DIR).collect()


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), duckdb_over(SF_DIR), ORACLES[name]) == []


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{n}" for n in range(1, 14)]


def test_token_counts_are_the_library_s(spark, documents):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = {}
    for d in documents:
        n = len(tok.encode(d["text"], add_special_tokens=False).ids)
        expected[d["doc_id"]] = (len(d["text"].encode()), n, n > 512)
    found = rows(spark, "op7_token_counts")
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in found} == expected
    assert len(found) == len(documents)


def test_round_trip_is_the_library_s(spark, documents):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = {}
    for d in documents:
        ids = tok.encode(d["text"], add_special_tokens=False).ids
        text = tok.decode(ids, skip_special_tokens=False)
        expected[d["doc_id"]] = (
            len(ids),
            hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest(),
        )
    found = rows(spark, "op8_bpe_round_trip")
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found} == expected


def test_language_folds_and_accuracy(spark, documents):
    lang = {d["doc_id"]: d["lang"] for d in documents}
    found = rows(spark, "op9_language_id")
    assert sorted(r.doc_id for r in found) == sorted(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert all(0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.9


def test_neighbours_are_found(spark):
    table = pq.read_table(f"{SF_DIR}/embeddings.parquet").to_pandas()
    vectors, ids = np.stack(table["embedding"]).astype(float), table["vec_id"].to_numpy()
    found = QUERIES["op2_nearest_vectors"](spark, SF_DIR).toPandas()
    hits = []
    for query in ids[ids % 20 == 0]:
        score = vectors @ vectors[ids == query][0]
        own = found[found["query_id"] == query].sort_values("rank")
        assert list(own["rank"]) == list(range(1, 21)) and query not in set(own["vec_id"])
        place = {v: i for i, v in enumerate(ids)}
        assert np.allclose(own["score"], [score[place[v]] for v in own["vec_id"]], atol=1e-12)
        best = [v for v in ids[np.lexsort((ids, -score))] if v != query][:20]
        hits.append(len(set(best) & set(own["vec_id"])) / 20)
    assert np.mean(hits) >= 0.9


def test_personal_data_digests(spark, documents):
    from tapewright.llm import pii

    found = {r.doc_id: r for r in rows(spark, "op5_personal_data")}
    assert len(found) == len(documents)
    for d in documents:
        spans = pii.base_spans(d["text"])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        r = found[d["doc_id"]]
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        counts = tuple(sum(k == kind for k, _, _ in spans) for kind in pii.KINDS)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == counts
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))
    assert sum(r.n_email for r in found.values()) > 0


class PlainText(HTMLParser):
    """The words of a simple page, with the marks of its lists, by the standard library's parser."""

    def __init__(self):
        super().__init__()
        self.words, self.skipped, self.lists = [], [], []

    def handle_starttag(self, tag, attrs):
        style = (dict(attrs).get("style") or "").replace(" ", "")
        void = tag in ("br", "hr", "img", "input", "link", "meta")
        gone = tag in ("head", "script", "style", "title", "template", "noscript") or "hidden" in dict(attrs)
        if (gone or "display:none" in style or self.skipped) and not void:
            self.skipped.append(tag)
        if tag in ("ul", "ol"):
            self.lists.append(0 if tag == "ol" else None)
        if tag == "li" and self.lists and not self.skipped:
            if self.lists[-1] is None:
                self.words.append("-")
            else:
                self.lists[-1] += 1
                self.words.append(f"{self.lists[-1]}.")

    def handle_endtag(self, tag):
        if tag in self.skipped:
            del self.skipped[len(self.skipped) - 1 - self.skipped[::-1].index(tag) :]
        if tag in ("ul", "ol") and self.lists:
            self.lists.pop()

    def handle_data(self, data):
        if not self.skipped:
            self.words += data.split()


def test_pages_are_rendered(spark):
    pages = pq.read_table(f"{SF_DIR}/pages.parquet").to_pylist()
    found = {r.page_id: r.text for r in rows(spark, "op10_html_text")}
    assert len(found) == len(pages)
    for p in pages:
        plain = PlainText()
        plain.feed(p["html"])
        assert found[p["page_id"]].split() == plain.words
