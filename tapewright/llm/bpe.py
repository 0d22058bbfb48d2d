"""BPE encoding and decoding of whole texts, long unsplit ones by tree concatenation.

A text of ordinary length is encoded in place, piece by piece between spaces, each distinct piece
once. A longer one is cut into parts that are encoded in parallel, wherever the cuts fall. Parts
are then joined two by two: the text around a cut is encoded again in a window that grows until
its tokens agree, with their places, with those of both sides. Two encodings that share a token
can be joined there, as every pair of neighbours in the result stands side by side in the encoding
of some text that holds both; if no window agrees, the last one is the two parts themselves.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.llm.columns import add_columns, bounded_batches, col, tidy

PART_CHARS = 1 << 15
WINDOW_CHARS = 64
AGREE = 4  # tokens in a row that must be the same
# Pieces remembered by a worker, half of them from before: what is met again stays.
CACHE_ENTRIES = 100_000
CACHED_CHARS = 64

# ids, start and end of each token, as code points of the text
Tokens = tuple[np.ndarray, np.ndarray, np.ndarray]


@lru_cache(4)
def tokenizer(path: str):
    """One for each worker; loading takes longer than most texts."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


# Latin text with ordinary white space, whose splitting is spelled out below.
_OTHER = re.compile("[^\\t\\n\\r\\x20-\\x7e\\xa1-\u012f\u0131-\u024f]")
_LETTERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u024f"  # of lower-cased text
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPLIT = re.compile(
    f"[{_LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d|[{_NUMBERS}]|[^\\t\\n\\r {_LETTERS}{_NUMBERS}]+"
)


# The normaliser and the splitting that PieceEncoder spells out, as the library names
# them. Vocabularies with any other are left to the library.
_SPELLED_OUT = [
    {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
]


def splits_as_spelled_out(tok) -> bool:
    parts = (tok.normalizer, tok.pre_tokenizer)
    return [json.loads(p.__getstate__()) if p is not None else None for p in parts] == _SPELLED_OUT


def whole_text_encoder(path: str):
    """Ids of whole texts by the library itself, for any vocabulary."""
    tok = tokenizer(path)
    return lambda text: np.array(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it is visible, else one beyond 255."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b if b in visible else next(hidden)) for b in range(256)]


class PieceEncoder:
    """Ids of whole texts from the ids of their pieces, each distinct piece encoded once.

    For vocabularies that :func:`splits_as_spelled_out`: tokens hold no white space, and the
    splitting never looks across it. Latin text is split into the vocabulary's own pre-tokens,
    any other text at space, tab, line feed and carriage return, and the library does the rest.
    """

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _pre_token(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = "".join([self.letters[b] for b in piece.encode()])
        return np.array([t.id for t in self.tokenizer.model.tokenize(piece)], "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        latin = not _OTHER.search(text) and not any(s in text for s in self.special)
        if latin:
            pieces = _SPLIT.findall(text.lower())
        else:
            for c in "\n\t\r":
                text = text.replace(c, " ")
            # marked, as a piece between spaces is not a pre-token
            pieces = [f" {p}" for p in text.split(" ")]
        known = self.known
        new = {p for p in pieces if p not in known}
        extra = {}
        if new:
            if len(known) + len(new) > CACHE_ENTRIES // 2:
                self.before, known = known, {}
                self.known, new = known, set(pieces)
            before, order = self.before, []
            for p in new:
                if p in before:
                    known[p] = before[p]
                else:
                    order.append(p)
            if latin:
                encoded = map(self._pre_token, order)
            else:
                found = self.tokenizer.encode_batch(
                    [p[1:] for p in order], add_special_tokens=False
                )
                encoded = (np.array(e.ids, "<u4").tobytes() for e in found)
            for p, ids in zip(order, encoded, strict=True):
                into = known if len(p) <= CACHED_CHARS else extra
                into[p] = ids
        if extra:
            return b"".join([extra[p] if p in extra else known[p] for p in pieces])
        return b"".join(map(known.__getitem__, pieces))


def tokens_of(tok, text: str, at: int = 0) -> Tokens:
    """Tokens of a text that begins at place ``at``."""
    e = tok.encode(text, add_special_tokens=False)
    places = np.array(e.offsets, np.int64).reshape(-1, 2) + at
    return np.array(e.ids, np.int64), places[:, 0], places[:, 1]


def _agreement(a: Tokens, b: Tokens, low: int, high: int, last: bool) -> tuple[int, int] | None:
    """Where AGREE tokens in a row, all inside (low, high), are the same in both.

    Gives the place of the first of them in ``a`` and in ``b``; ``last`` asks for the last such
    row instead of the first. Tokens that share their place with a neighbour (bytes of one
    character) do not count, as it does not tell them apart.
    """

    def usable(x: Tokens) -> dict[tuple[int, int, int], int]:
        ids, start, end = x
        near = np.flatnonzero((start > low) & (end < high))
        return {
            (int(ids[i]), int(start[i]), int(end[i])): int(i)
            for i in near
            if (i == 0 or start[i] >= end[i - 1]) and (i + 1 == len(ids) or end[i] <= start[i + 1])
        }

    in_a, in_b = usable(a), usable(b)
    pairs = sorted((i, in_b[k]) for k, i in in_a.items() if k in in_b)
    runs = [
        pairs[n]
        for n in range(len(pairs) - AGREE + 1)
        if pairs[n + AGREE - 1] == (pairs[n][0] + AGREE - 1, pairs[n][1] + AGREE - 1)
    ]
    return (runs[-1] if last else runs[0]) if runs else None


def join(tok, text: str, left: Tokens, right: Tokens, start: int, cut: int, end: int) -> Tokens:
    """Tokens of ``text[start:end]`` from those of its parts before and after ``cut``."""
    width = WINDOW_CHARS
    while True:
        a, b = max(start, cut - width), min(end, cut + width)
        middle = tokens_of(tok, text[a:b], a)
        before = (0, 0) if a == start else _agreement(left, middle, a, cut, last=False)
        after = (
            (len(right[0]), len(middle[0]))
            if b == end
            else _agreement(right, middle, cut, b, last=True)
        )
        if before is not None and after is not None:
            return tuple(
                np.concatenate((x[: before[0]], m[before[1] : after[1]], y[after[0] :]))
                for x, m, y in zip(left, middle, right, strict=True)
            )
        width *= 2


def joined(tok, parts: list[str], tokens: list[Tokens]) -> np.ndarray:
    """Ids of the text that the parts make up; parts next to each other are joined, level by level."""
    text = "".join(parts)
    edges = np.cumsum([0, *map(len, parts)]).tolist()
    nodes = [(edges[i], edges[i + 1], t) for i, t in enumerate(tokens)]
    while len(nodes) > 1:
        level = [
            (a, c, join(tok, text, x, y, a, b, c))
            for (a, b, x), (_, c, y) in zip(nodes[::2], nodes[1::2], strict=False)
        ]
        nodes = level + nodes[len(level) * 2 :]
    return nodes[0][2][0]


def cut(text: str, size: int = PART_CHARS) -> list[str]:
    """Halves of halves, until no part is longer than ``size``."""
    n = 1
    while len(text) > n * size:
        n *= 2
    edges = [len(text) * i // n for i in range(n + 1)]
    return [text[a:b] for a, b in zip(edges, edges[1:], strict=False)]


def _encode_long(docs: DataFrame, path: str, text: str, part_chars: int) -> DataFrame:
    """``digest`` and ``ids`` of each distinct text."""
    texts = docs.select(F.sha2(col(text), 256).alias("digest"), col(text).alias("text"))

    def cut_all(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            digests, values = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for digest, value in zip(digests, values, strict=True):
                parts = cut(value, part_chars)
                at = np.cumsum([0, *map(len, parts[:-1])])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([digest] * len(parts)),
                        pa.array(at.astype(np.int64)),
                        pa.array(parts, pa.string()),
                    ],
                    ["digest", "at", "part"],
                )

    parts = texts.mapInArrow(tidy(cut_all), "digest string, at long, part string").dropDuplicates(
        ["digest", "at"]
    )

    def start():
        tok = tokenizer(path)

        def compute(parts):
            made = [tokens_of(tok, p) for p in parts.to_pylist()]
            return [[x[k].astype("<i4").tobytes() for x in made] for k in range(3)]

        return compute

    encoded = add_columns(
        parts,
        ["part"],
        "ids binary, starts binary, ends binary",
        start,
        ["digest", "at", "part"],
    )

    def merge(group):
        # the rows of one text
        group = group.sort_values("at")
        tokens = [
            (
                np.frombuffer(ids, "<i4").astype(np.int64),
                np.frombuffer(starts, "<i4") + np.int64(at),
                np.frombuffer(ends, "<i4") + np.int64(at),
            )
            for at, ids, starts, ends in zip(
                group["at"], group["ids"], group["starts"], group["ends"], strict=True
            )
        ]
        ids = joined(tokenizer(path), group["part"].tolist(), tokens)
        out = group.iloc[:1][["digest"]].copy()
        out["ids"] = [ids.astype("<u4").tobytes()]
        return out

    return encoded.groupBy("digest").applyInPandas(merge, "digest string, ids binary")


def encode(
    docs: DataFrame,
    path: str,
    text: str = "text",
    keep=None,
    part_chars: int = PART_CHARS,
    into: str | None = None,
) -> DataFrame:
    """The kept columns (default: all) with ``ids``: token ids as little-endian 32-bit numbers.

    With ``into`` there is also that column, with what :func:`decode` makes of the ids, in the same
    pass over the texts.

    Ids are those of the tokenizers library with the vocabulary at ``path``, without special tokens
    added; special tokens written out in a text are taken as its default does. Texts over
    ``part_chars`` characters are encoded in parts, equal ones once. A null or empty text has no
    ids. Rows that repeat keep their own results. Columns already called like a new one are replaced.
    """
    added = {"ids", *([into.lower()] if into else [])}
    kept = list(docs.columns if keep is None else keep)
    bounded_batches(docs.sparkSession)
    size = F.coalesce(F.length(col(text)), F.lit(0))

    def start():
        spelled_out = splits_as_spelled_out(tokenizer(path))
        ids_of = PieceEncoder(path).encode if spelled_out else whole_text_encoder(path)
        text_of = decoder(path) if into else None

        def compute(texts):
            ids = [ids_of(t) if t else b"" for t in texts.to_pylist()]
            return [ids, [text_of(x) for x in ids]] if into else [ids]

        return compute

    fields = "ids binary" + (f", `{into}` string" if into else "")
    short = add_columns(docs.where(size <= part_chars), [text], fields, start, kept)
    long = docs.where(size > part_chars)
    kept = [c for c in kept if c.lower() not in added]
    mark = F.sha2(col(text), 256)
    rows = long.select(*(col(c).alias(f"keep_{i}") for i, c in enumerate(kept)), mark.alias("mark"))
    whole = rows.join(
        _encode_long(long, path, text, part_chars), F.col("mark") == F.col("digest")
    ).select(*(F.col(f"keep_{i}").alias(c) for i, c in enumerate(kept)), "ids")
    return short.unionByName(decode(whole, path, into=into) if into else whole)


def decoder(path: str):
    """From the bytes of ids to their text, as the library decodes them."""
    tok = tokenizer(path)
    plain = tok.decoder is None
    vocabulary = {i: s for s, i in tok.get_vocab(with_added_tokens=True).items()}
    names = [vocabulary.get(i) for i in range(max(vocabulary, default=-1) + 1)]
    whole = None not in names

    def text(raw: bytes | None) -> str:
        numbers = np.frombuffer(raw or b"", "<u4").tolist()
        if plain and whole:  # without a decoder the library puts a space between tokens
            return " ".join(map(names.__getitem__, numbers))
        return tok.decode(numbers, skip_special_tokens=False)

    return text


def decode(docs: DataFrame, path: str, ids: str = "ids", into: str = "decoded", keep=None):
    """The kept columns (default: all) with the text of each row's ids, as the library decodes it.

    Special tokens are kept. Null or empty ids give an empty text. An existing column of the new
    name is replaced.
    """

    def start():
        text = decoder(path)
        return lambda ids: [[text(x) for x in ids.to_pylist()]]

    kept = docs.columns if keep is None else keep
    return add_columns(docs, [ids], f"`{into}` string", start, kept)
