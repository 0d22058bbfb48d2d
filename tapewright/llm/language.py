"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewright.llm.columns import add_columns, bounded_batches, col, tidy

UNKNOWN = "und"
BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
MAX_TRAIN_ROWS = 50_000
MAX_LANGUAGES = 1_000
SMOOTHING = 0.5
# Log probabilities are whole numbers of this size, so that sums do not depend on their order.
UNIT = 1.0 / (1 << 20)
_PIECE = 1 << 18  # code points worked on at a time


@dataclass(frozen=True)
class Model:
    """Languages in order, log priors, and log probabilities by (bucket, language), in UNITs."""

    languages: tuple[str, ...]
    prior: np.ndarray
    weight: np.ndarray


@lru_cache(1)
def _letters() -> np.ndarray:
    """Each code point's own number if it is a letter, else that of a space."""
    points = np.full(0x110000, 32, np.uint32)
    for start, stop in ((0, 0xD800), (0xE000, 0x110000)):
        chars = map(chr, range(start, stop))
        is_letter = np.fromiter((c.isalpha() for c in chars), bool, stop - start)
        points[start:stop][is_letter] = np.arange(start, stop, dtype=np.uint32)[is_letter]
    return points


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the texts, text after text, and how many each text has.

    Letters are lower-cased, any run of other characters is one space, and each text stands
    between spaces. A text without letters has no n-grams.
    """
    lowered = [t.lower() for t in texts]
    points = np.frombuffer(
        "".join(f"\n{t}\n" for t in lowered).encode("utf-32-le", "surrogatepass"), np.uint32
    )
    lengths = np.array([len(t) + 2 for t in lowered])
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    points = _letters()[points]
    first = np.zeros(len(points), bool)
    first[np.cumsum(lengths) - lengths] = True
    space = points == 32
    kept = ~space | ~np.concatenate(([False], space[:-1])) | first
    points, owner = points[kept].astype(np.uint64), owner[kept]
    has_letter = np.bincount(owner[points != 32], minlength=len(texts)) > 0
    buckets, owners = [], []
    hashed = np.zeros(len(points), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        count = len(points) - n + 1
        if count <= 0:
            break
        hashed = (hashed[:count] * np.uint64(0x9E3779B97F4A7C15)) ^ (
            (points[n - 1 :] + np.uint64(n)) * np.uint64(0xC2B2AE3D27D4EB4F)
        )
        if n not in ORDERS:
            continue
        inside = (owner[:count] == owner[n - 1 :]) & has_letter[owner[:count]]
        if n == 1:
            inside &= points != 32
        mixed = hashed ^ (hashed >> np.uint64(29))
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        buckets.append((mixed[inside] >> np.uint64(40)).astype(np.int64) % BUCKETS)
        owners.append(owner[:count][inside])
    if not buckets:
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return np.concatenate(buckets)[order], np.bincount(owners, minlength=len(texts))


def _pieces(texts: list[str]):
    """Consecutive runs of texts of about _PIECE characters, or one longer text."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > _PIECE:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def train(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    sample_by: Column | None = None,
    max_rows: int = MAX_TRAIN_ROWS,
) -> Model:
    """Fit on rows whose text and language are known.

    If there are more than ``max_rows`` of them, the rows are sampled by a hash of ``sample_by``
    (default: the text) at the rate that gives about ``max_rows``; this bounds the cost of
    fitting. No labelled row gives a model without languages, which predicts ``und`` everywhere.
    Of more than MAX_LANGUAGES languages those with the most rows are learnt, ties going to the name
    that sorts first, as the model would not be small any more. Empty texts and texts without a
    letter count for their language's prior only; rows that repeat count each.
    """
    bounded_batches(docs.sparkSession)
    known = docs.where(col(lang).isNotNull() & col(text).isNotNull())
    sizes = known.groupBy(col(lang).alias("lang")).count().orderBy(F.desc("count"), "lang")
    names = [r["lang"] for r in sizes.limit(MAX_LANGUAGES + 1).collect()]
    if len(names) > MAX_LANGUAGES:
        known = known.where(col(lang).isin(names[:MAX_LANGUAGES]))
    total = known.count()
    if total > max_rows:
        hashed = F.xxhash64(sample_by if sample_by is not None else col(text))
        known = known.where(F.pmod(hashed, F.lit(1 << 32)) < int((1 << 32) * max_rows / total))
    pairs = known.select(col(lang).alias("lang"), col(text).alias("text"))

    def count(batches):
        counts, docs_of = {}, {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            by_lang: dict[str, list[str]] = {}
            for key, value in zip(langs, texts, strict=True):
                by_lang.setdefault(key, []).append(value)
            for key, values in by_lang.items():
                docs_of[key] = docs_of.get(key, 0) + len(values)
                total = counts.setdefault(key, np.zeros(BUCKETS, np.int64))
                for a, b in _pieces(values):
                    total += np.bincount(features(values[a:b])[0], minlength=BUCKETS)
        import pyarrow as pa

        for key, total in counts.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([key] * (len(used) + 1), pa.string()),
                    "bucket": pa.array(np.append(used, -1).astype(np.int32)),
                    "n": pa.array(np.append(total[used], docs_of[key])),
                }
            )

    # a row for each language and bucket at most, however many rows there are
    rows = (
        pairs.mapInArrow(tidy(count), "lang string, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    return _fitted(rows.toPandas())


def _fitted(rows: pd.DataFrame) -> Model:
    languages = sorted(rows["lang"].unique())
    counts = np.zeros((BUCKETS, len(languages)))
    docs_of = np.zeros(len(languages))
    at = rows["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(int)
    bucket, n = rows["bucket"].to_numpy(int), rows["n"].to_numpy(float)
    is_doc = bucket < 0
    docs_of[at[is_doc]] = n[is_doc]
    counts[bucket[~is_doc], at[~is_doc]] = n[~is_doc]
    if not languages:
        return Model((), np.zeros(0, np.int64), np.zeros((BUCKETS, 0), np.int32))
    weight = np.log((counts + SMOOTHING) / (counts.sum(0) + SMOOTHING * BUCKETS))
    prior = np.log(docs_of / docs_of.sum())
    return Model(
        tuple(languages),
        np.round(prior / UNIT).astype(np.int64),
        np.round(weight / UNIT).astype(np.int32),
    )


def score(model: Model, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and its probability for each text; ``und`` and 0 for null or letterless ones.

    Equal sums are settled for the language that sorts first.
    """
    plain = [t or "" for t in texts]
    langs, scores = [UNKNOWN] * len(plain), [0.0] * len(plain)
    if not model.languages:
        return langs, scores
    for a, b in _pieces(plain):
        bucket, counts = features(plain[a:b])
        some = np.flatnonzero(counts)
        if not len(some):
            continue
        starts = (np.cumsum(counts) - counts)[some]
        sums = np.stack(
            [
                np.add.reduceat(model.weight[bucket, k], starts, dtype=np.int64)
                for k in range(len(model.languages))
            ],
            axis=1,
        )
        sums += model.prior
        best = sums.argmax(1)
        gap = (sums - sums[np.arange(len(some)), best][:, None]) * UNIT
        sure = 1.0 / np.exp(gap).sum(1)
        for i, k, p in zip(some.tolist(), best.tolist(), sure.tolist(), strict=True):
            langs[a + i], scores[a + i] = model.languages[k], p
    return langs, scores


def identify(docs: DataFrame, model: Model, text: str = "text", keep=None) -> DataFrame:
    """The kept columns (default: all) with ``lang_pred`` and ``score``.

    The model, at most MAX_LANGUAGES x BUCKETS small numbers, is broadcast. A null or empty text,
    and one without a letter, is ``und`` with score 0. Columns that are already called
    ``lang_pred`` or ``score`` are replaced. Any number of equal rows keep their own results.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        fitted = shared.value
        return lambda texts: list(score(fitted, texts.to_pylist()))

    kept = docs.columns if keep is None else keep
    return add_columns(docs, [text], "lang_pred string, score double", start, kept)
