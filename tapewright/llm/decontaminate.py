"""Benchmark passages in documents, by one Aho-Corasick automaton over word windows.

Both sides are normalised alike: A-Z lower-cased, words are runs of letters, digits and characters
beyond ASCII, joined by single spaces. A pattern is a window of WINDOW consecutive words of an item
(a shorter item is one window) between two spaces, so that it only matches whole words. Each
document is scanned once; offsets are carried back to its words and to the original text.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.llm.columns import add_columns, col
from tapewright.session import scratch_path

WINDOW = 13
SHARE = 20  # contaminated: at least one word in so many is hit
# Pattern text of one automaton; more benchmark text is scanned for in further passes.
AUTOMATON_BYTES = 32 << 20
PATTERN_BYTES = 48  # what a pattern takes besides its text, about

_WORD_BYTES = bytes(
    c + 32
    if 0x41 <= c <= 0x5A
    else c
    if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80
    else 0x20
    for c in range(256)
)

FIELDS = "n_words long, hit_words array<struct<start:int,end:int>>, hit_items array<string>"


def words(text: str | None) -> list[bytes]:
    """Normalised words of a text, as UTF-8; none for a null text."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def windows(item_words: list[bytes], size: int = WINDOW) -> list[bytes]:
    if not item_words:
        return []
    stops = range(min(size, len(item_words)), len(item_words) + 1)
    return [b" ".join(item_words[max(0, stop - size) : stop]) for stop in stops]


class Automaton:
    """Finds the words of a text inside windows, and whose windows they are."""

    def __init__(self, patterns: list[tuple[bytes, str | None]]):
        import ahocorasick

        owners: dict[bytes, set[str]] = {}
        for window, item_id in patterns:
            ids = owners.setdefault(window, set())
            if item_id is not None:
                ids.add(item_id)
        self.search = ahocorasick.Automaton()
        for window, ids in owners.items():
            n = window.count(b" ") + 1
            self.search.add_word(f" {window.decode('latin-1')} ", (n, len(window), tuple(ids)))
        self.empty = not owners
        if not self.empty:
            self.search.make_automaton()

    def scan(self, text_words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Ranges of hit words, in order and apart from each other, and the ids of their items."""
        if self.empty or not text_words:
            return [], set()
        joined = b" " + b" ".join(text_words) + b" "
        found = list(self.search.iter(joined.decode("latin-1")))
        if not found:
            return [], set()
        spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        ends = np.searchsorted(spaces, [end for end, _ in found]).tolist()
        ranges: list[tuple[int, int]] = []
        ids: set[str] = set()
        for end, (_, (n, _, own)) in zip(ends, found, strict=True):
            start = end - n
            ids.update(own)
            while ranges and ranges[-1][1] >= start:
                start = min(start, ranges.pop()[0])
            ranges.append((start, end))
        return ranges, ids


def original_spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code point offsets in the text of ranges of its words."""
    if not ranges:
        return []
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    is_word = np.frombuffer(raw.tobytes().translate(_WORD_BYTES), np.uint8) != 32
    edges = np.diff(np.concatenate(([0], is_word.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    return [(int(points[starts[a]]), int(points[ends[b - 1]])) for a, b in ranges]


def merged(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted([*a, *b]):
        if out and out[-1][1] >= start:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _patterns(benchmark: DataFrame, item_id: str, text: str, size: int, limit: int):
    """A written table of the distinct (``window``, ``id``), and its number of shards.

    Windows are made and told apart in tasks. A shard takes about ``limit`` bytes, as a hash deals
    windows and ids together: not even a window of very many items is larger.
    """
    spark = benchmark.sparkSession
    items = benchmark.select(col(item_id).cast("string").alias("id"), col(text).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own_id, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                made = sorted(set(windows(words(value), size)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made, pa.binary()), pa.array([own_id] * len(made), pa.string())],
                    ["window", "id"],
                )

    made = items.where("text IS NOT NULL").mapInArrow(cut, "window binary, id string").distinct()
    path = scratch_path(spark, "windows")
    made.write.parquet(path)
    made = spark.read.parquet(path)
    cost = F.octet_length("window") + F.coalesce(F.octet_length("id"), F.lit(0)) + PATTERN_BYTES
    total = made.agg(F.sum(cost)).collect()[0][0] or 0
    n = max(1, -(-total // limit))
    if n == 1:
        return made.withColumn("shard", F.lit(0)), 1
    path = scratch_path(spark, "shards")
    shard = F.pmod(F.xxhash64("window", "id"), F.lit(n)).cast("int")
    dealt = made.withColumn("shard", shard).repartition(min(n, 1_000), "shard")
    dealt.write.partitionBy("shard").parquet(path)
    return spark.read.parquet(path), n


_built: dict[str, Automaton] = {}


def _automaton(name: str, patterns: list[tuple[bytes, str | None]]) -> Automaton:
    """One for each worker at a time: that of the shard it worked on last."""
    if name not in _built:
        _built.clear()
        _built[name] = Automaton(patterns)
    return _built[name]


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    keep=None,
    size: int = WINDOW,
    automaton_bytes: int = AUTOMATON_BYTES,
    spans: bool = False,
) -> DataFrame:
    """The kept columns (default: all) with ``n_words``, ``hit_words`` and ``hit_items``.

    ``hit_words`` are ranges of word numbers inside any occurrence of a window, ``hit_items`` the
    sorted ids (as strings) of the items with such windows; with ``spans`` there are also
    ``hit_spans``, their code point offsets in the text. A null or empty text has no words. Items
    without words have no window; an item whose id is null hits words but is not listed. Rows of
    the benchmark that repeat count once; an empty one hits nothing. Documents that repeat stay, each
    with its own result, and texts of any length are scanned whole. Columns already named like the
    new ones are replaced.

    Patterns of more than ``automaton_bytes`` are dealt to several shards, and documents pass one
    automaton after the other, from one written table to the next. Only one shard at a time, of
    about that size, comes to the driver and is sent to the tasks.
    """
    kept = list(docs.columns if keep is None else keep)
    spark = docs.sparkSession
    patterns, n = _patterns(benchmark, item_id, item_text, size, automaton_bytes)
    fields = FIELDS + (", hit_spans array<struct<start:int,end:int>>" if spans else "")
    out = docs
    for i in range(n):
        last = i == n - 1
        shard = patterns.where(F.col("shard") == i).select("window", "id").toArrow()
        own = list(zip(*(c.to_pylist() for c in shard.columns), strict=True))
        shared = spark.sparkContext.broadcast(own)

        def start(shared=shared, name=uuid.uuid4().hex, first=i == 0, last=last):
            automaton = _automaton(name, shared.value)

            def compute(texts, ranges=None, ids=None):
                rows = texts.to_pylist()
                before = [([], ())] * len(rows)
                if not first:
                    before = [
                        ([(x["start"], x["end"]) for x in r], j)
                        for r, j in zip(ranges.to_pylist(), ids.to_pylist(), strict=True)
                    ]
                n_words, hits, items, where = [], [], [], []
                for value, (old, old_ids) in zip(rows, before, strict=True):
                    own = words(value)
                    found, found_ids = automaton.scan(own)
                    found = merged(found, old) if old else found
                    n_words.append(len(own))
                    hits.append([{"start": a, "end": b} for a, b in found])
                    items.append(sorted(found_ids.union(old_ids)))
                    if spans and last:
                        where.append(original_spans(value or "", found))
                made = [n_words, hits, items]
                if spans:
                    where = where or [[]] * len(rows)
                    made.append([[{"start": a, "end": b} for a, b in x] for x in where])
                return made

            return compute

        # the text goes on to the next pass even where the caller has no use for it
        passed = kept if last else [*dict.fromkeys([*kept, text])]
        inputs = [text] if i == 0 else [text, "hit_words", "hit_items"]
        out = add_columns(out, inputs, fields, start, passed)
        if not last:
            path = scratch_path(spark, "passed")
            out.write.parquet(path)
            out = spark.read.parquet(path)
            shared.destroy()
    return out


def judge(found: DataFrame) -> DataFrame:
    """Adds ``n_hit`` and ``contaminated`` to what :func:`find` returns."""
    hit = F.aggregate("hit_words", F.lit(0), lambda n, x: n + x["end"] - x["start"])
    n_hit = F.when(F.size("hit_words") > 0, hit).otherwise(0).cast("long")
    return found.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))
    )
