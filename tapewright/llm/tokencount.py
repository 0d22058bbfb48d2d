"""Token counts by a byte-level BPE vocabulary, without any shuffle of pre-tokens.

Two tiers: a broadcast table of frequent pre-token lengths, then a cache in each worker for what
the table misses, filled by the tokenizer itself. The table comes from the whole corpus: each task
keeps bounded counts of its pre-tokens, and these are merged in a tree of tasks.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from tapewright.llm.columns import add_columns, bounded_batches, col

TABLE_ENTRIES = 65_536
# Pre-tokens counted at once; what has more than one in so many of all places stays counted.
COUNTED = 2 * TABLE_ENTRIES
CACHE_ENTRIES = 500_000
CACHED_CHARS = 64

# White space and what follows it, as the vocabulary's own splitting pattern takes them; each of
# these pieces is split further, and only inside itself, by the tokenizer.
_PIECE = re.compile(r" ?\S+|\s+(?!\S)|\s+")
# Characters that Python, but not the tokenizer, takes as white space.
_ODD = re.compile(r"[\x1c-\x1f]")


class Lengths(dict):
    """Tokens of each pre-token: the broadcast table first, what it misses encoded and kept."""

    def __init__(self, table: dict[str, int], tokenizer, limit: int = CACHE_ENTRIES):
        super().__init__(table)
        self.table, self.tokenizer, self.limit = table, tokenizer, limit

    def __missing__(self, piece: str) -> int:
        n = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        if len(piece) <= CACHED_CHARS:
            if len(self) >= self.limit:
                self.clear()
                self.update(self.table)
            self[piece] = n
        return n

    def count(self, text: str) -> int:
        return sum(map(self.__getitem__, _PIECE.findall(text)))


def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def counter(path: str, table: dict[str, int]):
    """A function from a text (or null: 0) to the number of its tokens."""
    tokenizer = _tokenizer(path)
    special = sorted(
        (t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True
    )
    splitter = re.compile("|".join(map(re.escape, special))) if special else None
    lengths = Lengths(table, tokenizer)

    def count(text: str | None) -> int:
        if not text:
            return 0
        if _ODD.search(text):
            return len(tokenizer.encode(text, add_special_tokens=False).ids)
        if splitter is None or not any(s in text for s in special):
            return lengths.count(text)
        parts = splitter.split(text)
        return sum(lengths.count(p) for p in parts) + len(parts) - 1

    return count


def _bounded(seen: Counter, room: int) -> Counter:
    """At most ``room`` counts, each less what the largest one left out had (Misra-Gries)."""
    if len(seen) <= room:
        return seen
    least = sorted(seen.values(), reverse=True)[room]
    return Counter({p: n - least for p, n in seen.items() if n > least})


def frequent_lengths(
    docs: DataFrame, path: str, text: str = "text", room: int | None = None
) -> dict[str, int]:
    """Token counts of the most frequent pre-tokens of all rows and whole texts.

    Only a head start for the workers: any table gives the same counts. It has at most
    TABLE_ENTRIES entries of at most CACHED_CHARS characters. ``room`` (default: COUNTED) bounds
    the counts that a task holds and sends on.
    """
    bounded_batches(docs.sparkSession)
    room = room or COUNTED

    def count(batches):
        seen: Counter = Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                if value:
                    seen.update([p for p in _PIECE.findall(value) if len(p) <= CACHED_CHARS])
                    if len(seen) > 2 * room:
                        seen = _bounded(seen, room)
        made = pickle.dumps(dict(_bounded(seen, room)))
        yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], ["counts"])

    def merged(a: Counter, b: Counter) -> Counter:
        a.update(b)
        return _bounded(a, room)

    seen = (
        docs.select(col(text).alias("text"))
        .mapInArrow(count, "counts binary")
        .rdd.treeAggregate(Counter(), lambda a, row: merged(a, pickle.loads(row[0])), merged, depth=3)
    )
    pieces = sorted((p for p in seen if not _ODD.search(p)), key=lambda p: (-seen[p], p))
    pieces = pieces[:TABLE_ENTRIES]
    encoded = _tokenizer(path).encode_batch(pieces, add_special_tokens=False)
    return {p: len(e.ids) for p, e in zip(pieces, encoded, strict=True)}


def count_tokens(docs: DataFrame, path: str, text: str = "text", keep=None) -> DataFrame:
    """The kept columns (default: all) with ``n_tokens``, for each whole text.

    Counts are those of the tokenizers library with the vocabulary at ``path``, without special
    tokens added; strings of special tokens inside a text are one token each, as is its default.
    A null or empty text counts 0, and texts of any length are counted whole, each in the task that
    reads it. A column already called ``n_tokens`` is replaced. Equal rows each keep theirs, and an
    empty table gives no row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, text))

    def start():
        count = counter(path, shared.value)
        return lambda texts: [[count(t) for t in texts.to_pylist()]]

    kept = docs.columns if keep is None else keep
    return add_columns(docs, [text], "n_tokens long", start, kept)
