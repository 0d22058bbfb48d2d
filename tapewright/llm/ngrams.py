"""Stupid-backoff scores of documents from the word pairs of a whole corpus.

The model is that of word pairs: at each place of a text, the count of the pair (word before, word)
in the corpus over that of the word before; where the corpus lacks the pair, BACKOFF times the share
of the word among all words. A mark stands before the first word. The score of a document is the
mean logarithm over its words. Where the documents are the corpus themselves, every text is scored
by the counts of all others: its own places are taken off each count. A pair that no other text has
is thus backed off from, however often its own text repeats it.

Counts are tables spread by a hash. The distinct pairs of each text go to the bucket of their hash,
where the pair's count is known, together with what the score is if the pair is found and if it is
not. For that the words' own counts must be known: the most frequent KNOWN_WORDS are broadcast. A
pair with a rarer word goes to the bucket of that word, which is counted there too; where the word
before a found pair is rarer, it is joined to the table of word counts. What is found is summed for
each document.

A frequent pair would bring a row of each text to one bucket. Pairs with at least one in HOT of all
places are hot; there are no more than HOT of them. Their counts are broadcast too, and they are
scored where their text is read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.llm.columns import bounded_batches, col, give_back, tidy
from tapewright.llm.decontaminate import words
from tapewright.llm.hashing import mixed, word_hashes
from tapewright.session import scratch_path

BACKOFF = 0.4
UNKNOWN = 0.5  # what a word counts that the corpus does not have
HOT = 4_000
# Logarithms are whole numbers of this part, so that sums do not depend on their order.
UNITS = 1 << 20
BUCKET_BYTES = 32 << 20  # text whose pairs meet in one bucket, on average
SLICES = 8  # of a bucket's pairs, counted one after the other
KNOWN_WORDS = 1 << 20  # words whose counts are broadcast, at most
BLOCK_WORDS = 1 << 19
START = np.uint64(0x5157A27)


def units(counts: np.ndarray) -> np.ndarray:
    return np.round(np.log(counts) * UNITS).astype(np.int64)


def pair(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(mixed(before) + word)


class Counts:
    """A few hashes with their counts, for lookup of many at a time."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.counts = hashes[order], counts[order]

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """Counts; 0 for what is not here."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.counts[at], 0)


def _summed(hashes: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(hashes, return_inverse=True)
    return found, np.bincount(at, weights=n, minlength=len(found)).astype(np.int64)


def _text_blocks(batches):
    """Blocks of documents: ids (null: none), number of words of each, and all words' hashes."""
    ids, sizes, parts, held = [], [], [], 0
    for batch in batches:
        names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for a in range(0, len(names), 512):
            own = [words(t) for t in texts[a : a + 512]]
            ids += names[a : a + 512]
            sizes += map(len, own)
            parts.append(word_hashes(b" ".join(b" ".join(w) for w in own if w)))
            held += len(parts[-1])
            if held >= BLOCK_WORDS:
                yield ids, np.array(sizes, np.int64), np.concatenate(parts)
                ids, sizes, parts, held = [], [], [], 0
    if ids:
        yield ids, np.array(sizes, np.int64), np.concatenate(parts)


def _before(sizes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The word before each word, or the mark at the start of a text."""
    out = np.empty_like(hashes)
    out[1:] = hashes[:-1]
    firsts = (np.cumsum(sizes) - sizes)[sizes > 0]
    out[firsts] = START
    return out


def _count_rows(hashes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n)], ["h", "n"])


def word_counts(corpus: DataFrame) -> DataFrame:
    """``h`` (hash) and ``n`` of each word of ``id``, ``text`` rows; the mark counts texts."""

    def run(batches):
        for _, sizes, hashes in _text_blocks(batches):
            found, n = _summed(hashes)
            yield _count_rows(
                np.append(found, START), np.append(n, np.count_nonzero(sizes)).astype(np.int64)
            )

    return corpus.mapInArrow(tidy(run), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def _collected(rows: DataFrame) -> Counts:
    table = rows.toArrow()
    return Counts(
        table["h"].to_numpy().astype(np.int64).view(np.uint64), table["n"].to_numpy().astype(np.int64)
    )


def known_words(counted: DataFrame, most: int, always: int) -> tuple[Counts, bool]:
    """The most frequent words, ``most`` at most, and whether these are all.

    The mark and words that occur ``always`` times are among them in any case.
    """
    step = F.floor(F.log2(F.col("n").cast("double")) * 16).cast("int")
    # some hundred rows: how many words there are for each size of count
    sizes = counted.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()
    held, least = 0, None
    for row in sorted(sizes, key=lambda r: -r["step"]):
        if held + row["n"] > most:
            break
        held, least = held + row["n"], row["step"]
    mark = F.lit(int(START.view(np.int64)))
    enough = F.lit(False) if least is None else step >= least
    found = _collected(counted.where(enough | (F.col("n") >= always) | (F.col("h") == mark)))
    return found, held == sum(r["n"] for r in sizes)


def hot_pairs(corpus: DataFrame, counted: DataFrame, least: int) -> Counts:
    """Pairs that occur ``least`` times, with their counts."""
    mark = F.lit(int(START.view(np.int64)))
    often = _collected(counted.where((F.col("n") >= least) | (F.col("h") == mark)))
    shared = corpus.sparkSession.sparkContext.broadcast(often)

    def run(batches):
        known = shared.value
        for _, sizes, hashes in _text_blocks(batches):
            before = _before(sizes, hashes)
            both = (known.of(hashes) > 0) & (known.of(before) > 0)
            yield _count_rows(*_summed(pair(before[both], hashes[both])))

    # a pair is no more frequent than its words, so hot pairs are made of hot words
    pairs = corpus.mapInArrow(tidy(run), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    return _collected(pairs.where(F.col("n") >= least))


_ROWS = (
    "bucket int, kind int, ids binary, per binary, pairs binary, n binary, value binary, "
    "befores binary, lasts binary, more binary"
)
# kinds of rows: counts of the corpus; pairs of known words; pairs with a rare word; sums that need
# no bucket
_CORPUS, _EASY, _HARD, _DONE = 0, 1, 2, 3
_FOUND = "doc_id long, n_words long, units long, key long, own long, times long"
_BACK = int(np.round(np.log(BACKOFF) * UNITS))
_NEVER = int(np.round(np.log(UNKNOWN) * UNITS))


def _units_or_never(counts: np.ndarray) -> np.ndarray:
    return np.where(counts > 0, units(np.maximum(counts, 1)), _NEVER)


def _in_own_text(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """How often each hash occurs in its own text."""
    order = np.lexsort((hashes, owner))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    run = np.cumsum(new) - 1
    out = np.empty(len(order), np.int64)
    out[order] = np.bincount(run)[run] if len(order) else 0
    return out


def _dealt(docs: DataFrame, asks: bool, counts: bool, shared, total: int, buckets: int) -> DataFrame:
    """What each block of texts sends to each bucket.

    With ``asks`` the texts' pairs come to be scored, with ``counts`` they are counted; with both,
    each text's own places are taken off.
    """
    same = asks and counts
    fields = [x.split() for x in _ROWS.split(", ")]

    def run(batches):
        known, complete, hot = shared.value
        for ids, sizes, hashes in _text_blocks(batches):
            rows: list[dict] = []
            before = _before(sizes, hashes)
            owner = np.repeat(np.arange(len(ids)), sizes)
            grams = pair(before, hashes)
            named = np.array([i is not None for i in ids], bool)
            names = np.array([i if i is not None else 0 for i in ids], np.int64)
            # distinct pairs of each text, with their number
            order = np.lexsort((grams, owner))
            new = np.ones(len(order), bool)
            new[1:] = (grams[order][1:] != grams[order][:-1]) | (owner[order][1:] != owner[order][:-1])
            times = np.diff(np.append(np.flatnonzero(new), len(order)))
            order = order[new]
            g, who = grams[order], owner[order]
            of_word = known.of(hashes)
            w_known = (of_word[order] > 0) | complete
            rare = np.where(w_known, np.uint64(0), hashes[order])
            # all places of a rare word come to one bucket, where it is counted too
            route = np.where(w_known, g, mixed(rare))
            bucket = ((route >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            of_pair = hot.of(g)

            def deal(kind, some, columns, g=g, who=who, times=times, bucket=bucket, rows=rows, names=names):
                """The pairs ``some``, by bucket and then text, with ``columns`` beside them."""
                at = some[np.argsort(bucket[some], kind="stable")]
                edges = np.searchsorted(bucket[at], np.arange(buckets + 1))
                for b in np.flatnonzero(np.diff(edges)).tolist():
                    own = at[edges[b] : edges[b + 1]]
                    row = {"bucket": b, "kind": kind, "pairs": g[own], "n": times[own].astype(np.int32)}
                    if kind != _CORPUS:
                        per = np.bincount(who[own])
                        texts = np.flatnonzero(per)
                        row |= {"ids": names[texts], "per": per[texts].astype(np.int32)}
                    rows.append(row | {name: x[own] for name, x in columns.items()})

            if counts:
                silent = (of_pair == 0) & ~named[who] if same else of_pair == 0
                deal(_CORPUS, np.flatnonzero(silent), {"lasts": rare})
            if asks:
                own_word = _in_own_text(owner, hashes) if same else np.zeros(len(hashes), np.int64)
                firsts = (np.cumsum(sizes) - sizes)[sizes > 0]
                of_before, own_before = np.empty_like(of_word), np.empty_like(own_word)
                of_before[1:], own_before[1:] = of_word[:-1], own_word[:-1]
                of_before[firsts] = known.of(np.array([START]))[0]
                own_before[firsts] = int(same)
                rest = np.maximum(total - (sizes if same else np.zeros_like(sizes)), 1)
                # of the distinct pairs: the score if the pair is found, without its own count, and
                # if it is not; without the parts of words that are not known here
                v_known = (of_before[order] > 0) | complete
                left = of_before[order] - own_before[order]
                base = np.where(v_known & (left > 0), -units(np.maximum(left, 1)), 0)
                fall = _BACK - units(rest)[who]
                fall += np.where(w_known, _units_or_never(of_word[order] - own_word[order]), 0)
                sums = np.zeros(len(ids), np.int64)
                is_hot = of_pair > 0
                others = of_pair - (times if same else 0)
                settled = np.where(others > 0, base + units(np.maximum(others, 1)), fall)
                np.add.at(sums, who[is_hot], (times * settled)[is_hot])
                asked = ~is_hot & named[who]
                easy = asked & w_known & v_known
                # as if not found; the bucket adds the difference where it is
                np.add.at(sums, who[easy], (times * fall)[easy])
                deal(_EASY, np.flatnonzero(easy), {"value": (base - fall).astype(np.int32)})
                zero = np.uint64(0)
                deal(
                    _HARD,
                    np.flatnonzero(asked & ~easy),
                    {
                        "value": np.stack([base, fall], axis=1).astype(np.int32),
                        "befores": np.where(v_known, zero, before[order]),
                        "lasts": rare,
                        "more": np.stack([own_before[order], own_word[order]], axis=1).astype(np.int32),
                    },
                )
                texts = np.flatnonzero(named)
                if len(texts):
                    rows.append(
                        {
                            "bucket": int(names[texts[0]] % buckets),
                            "kind": _DONE,
                            "ids": names[texts],
                            "per": sizes[texts].astype(np.int32),
                            "pairs": sums[texts],
                        }
                    )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(
                        [r[name] if kind == "int" else r[name].tobytes() if name in r else b"" for r in rows],
                        pa.int32() if kind == "int" else pa.binary(),
                    )
                    for name, kind in fields
                ],
                [name for name, _ in fields],
            )

    return docs.mapInArrow(tidy(run), _ROWS)


def _scored(same: bool):
    """The work of one bucket: its count table, met by the texts' pairs."""

    def compute(table: pa.Table) -> pa.Table:
        kinds = table["kind"].to_numpy()

        def all_of(name: str, kind: str, which: int) -> np.ndarray:
            values = table[name]
            parts = [np.frombuffer(values[int(i)].as_py(), kind) for i in np.flatnonzero(kinds == which)]
            return np.concatenate(parts) if parts else np.zeros(0, kind)

        ids = [all_of("ids", "<i8", k) for k in (_EASY, _HARD)]
        per = [all_of("per", "<i4", k) for k in (_EASY, _HARD)]
        # texts of easy pairs, then those of hard ones
        owners = np.repeat(np.arange(sum(map(len, ids)), dtype=np.int32), np.concatenate(per))
        ids = np.concatenate(ids)
        sums = np.zeros(len(ids), np.int64)
        grams = [all_of("pairs", "<u8", k) for k in (_CORPUS, _EASY, _HARD)]
        n_easy, n_hard = len(grams[1]), len(grams[2])
        n = np.concatenate([all_of("n", "<i4", k) for k in (_CORPUS, _EASY, _HARD)])
        n_corpus = len(grams[0])
        grams = np.concatenate(grams)
        gain = all_of("value", "<i4", _EASY)
        found = np.zeros(n_hard, np.int64)
        part = (grams & np.uint64(SLICES - 1)).astype(np.uint8)
        for k in range(SLICES):
            own = np.flatnonzero(part == k)
            if not len(own):
                continue
            _, at = np.unique(grams[own], return_inverse=True)
            counted = n[own].astype(np.int64)
            if not same:
                counted = np.where(own < n_corpus, counted, 0)
            others = np.bincount(at, weights=counted).astype(np.int64)[at]
            if same:
                others -= n[own]
            hit = (others > 0) & (own >= n_corpus)
            own, others = own[hit], others[hit]
            easy = own < n_corpus + n_easy
            mine = own[easy] - n_corpus
            np.add.at(sums, owners[mine], n[own[easy]] * (units(others[easy]) + gain[mine]))
            found[own[~easy] - n_corpus - n_easy] = others[~easy]
        # pairs with rare words: a rare word is counted here, a rare word before is to be looked up
        own_before, own_word = all_of("more", "<i4", _HARD).reshape(-1, 2).T
        lasts = all_of("lasts", "<u8", _HARD)
        counted = np.concatenate([n[:n_corpus], n[n_corpus + n_easy :] if same else n[:0]])
        places = np.concatenate([all_of("lasts", "<u8", _CORPUS), lasts if same else lasts[:0]])
        of_last = Counts(*_summed(places, counted)).of(lasts)
        n, owner = n[n_corpus + n_easy :].astype(np.int64), owners[n_easy:]
        base, fall = all_of("value", "<i4", _HARD).reshape(-1, 2).T
        fall = fall + np.where(lasts != 0, _units_or_never(of_last - own_word), 0)
        hit = found > 0
        value = np.where(hit, base + units(np.maximum(found, 1)), fall)
        np.add.at(sums, owner, n * value)
        key = np.where(hit, all_of("befores", "<u8", _HARD), np.uint64(0))
        open_ = np.flatnonzero(key)
        done_ids, done = all_of("ids", "<i8", _DONE), all_of("pairs", "<i8", _DONE)
        names = np.concatenate([ids, done_ids, ids[owner[open_]]])
        zero = [np.zeros(len(x), np.int64) for x in (ids, done_ids, open_)]
        looked_up = np.arange(len(names)) >= len(ids) + len(done_ids)
        arrays = [
            pa.array(names),
            pa.array(np.concatenate([zero[0], all_of("per", "<i4", _DONE).astype(np.int64), zero[2]])),
            pa.array(np.concatenate([sums, done, zero[2]])),
            pa.array(np.concatenate([zero[0], zero[1], key[open_].view(np.int64)]), mask=~looked_up),
            pa.array(np.concatenate([zero[0], zero[1], own_before[open_].astype(np.int64)])),
            pa.array(np.concatenate([zero[0], zero[1], -n[open_]])),
        ]
        del grams, n, owner, owners, part, gain, found
        give_back()
        return pa.Table.from_arrays(arrays, [x.split()[0] for x in _FOUND.split(", ")])

    return compute


def score(
    docs: DataFrame,
    corpus: DataFrame | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    hot: int = HOT,
    bucket_bytes: int = BUCKET_BYTES,
    known: int = KNOWN_WORDS,
) -> DataFrame:
    """``doc_id``, ``n_words`` and ``score`` of each id, by the pairs of ``corpus``.

    Without a corpus the documents themselves are it, each text being scored by all others. Words
    are runs of ASCII letters (A-Z lower-cased), digits and characters beyond ASCII. ``score`` is
    the mean natural logarithm over the words, null for a document without words (null, empty or
    blank text). Rows that repeat an id are texts of their own, whose words count together in the
    id's mean. Rows without an id count in the corpus but have no score. An empty corpus knows no
    word. Other columns are left out; join them by id.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    fields = (col(doc_id).cast("long").alias("id"), col(text).alias("text"))
    same = corpus is None
    asked = docs.select(*fields)
    base = asked if same else corpus.select(*fields)
    path = scratch_path(spark, "words")
    word_counts(base).write.parquet(path)
    counted = spark.read.parquet(path)
    mark = F.lit(int(START.view(np.int64)))
    total = counted.where(F.col("h") != mark).agg(F.sum("n")).collect()[0][0] or 0
    size = base.agg(F.sum(F.octet_length("text"))).collect()[0][0] or 0
    buckets = int(max(16, min(60_000, -(-size // bucket_bytes))))
    least = max(1, -(-total // hot))
    tables = (*known_words(counted, known, least), hot_pairs(base, counted, least))
    shared = spark.sparkContext.broadcast(tables)
    if same:
        rows = _dealt(asked, True, True, shared, total, buckets)
    else:
        rows = _dealt(base, False, True, shared, total, buckets).unionByName(
            _dealt(asked, True, False, shared, total, buckets)
        )
    found = rows.groupBy("bucket").applyInArrow(_scored(same), _FOUND)
    # rare words before a found pair, which are still to be looked up; none of them is frequent
    word = counted.where(F.col("h") != mark).select(F.col("h").alias("key"), "n")
    others = F.coalesce(F.col("n"), F.lit(0)) - F.col("own")
    value = F.round(F.log(others.cast("double")) * UNITS).cast("long")
    found = found.join(word, "key", "left").withColumn(
        "units", F.when(F.col("key").isNull(), F.col("units")).otherwise(F.col("times") * value)
    )
    return (
        found.groupBy("doc_id")
        .agg(F.sum("n_words").alias("n_words"), F.sum("units").alias("units"))
        .select(
            "doc_id",
            "n_words",
            F.when(
                F.col("n_words") > 0, F.col("units") / (F.lit(float(UNITS)) * F.col("n_words"))
            ).alias("score"),
        )
    )
