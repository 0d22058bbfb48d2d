"""Exact Jaccard join of documents on word shingles, by vertical partitioning.

The global order of shingles is that of their 64-bit hashes, cut into fragments. Each fragment is
worked on by itself: its part of every document's set goes to buckets of the fragment, where the
number of documents of each shingle is known. A shingle of one document only cannot be shared, and
a document with more than a quarter of such shingles has no partner: most documents are ruled out by
the first fragment and do not take part in the second.

What is left are sets that are mostly shared. Their rarest shingles are their prefixes; documents
that meet in a prefix are candidates, and their overlaps are counted fragment by fragment and
summed for each pair. Copies of one set are one candidate, and within the documents that meet at a
shingle each is first compared with one leader; only those that did not end in one component are
compared with each other.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.llm.columns import add_columns, bounded_batches, col, give_back, tidy
from tapewright.llm.components import components
from tapewright.llm.hashing import mixed, word_hashes
from tapewright.session import scratch_path

WORDS = 5
LEAST = Fraction(3, 4)
# The first fragment has so many eighths of the order: enough to rule out an unrelated document.
FIRST_EIGHTHS = 3
BUCKET_BYTES = 12 << 20  # text of the documents whose shingles meet in one bucket, on average
BLOCK_SHINGLES = 1 << 18
# Documents of a block that share a shingle: from so many on, they are counted and not listed.
FREQUENT = 64
PARTS = 8  # fragments in which overlaps are counted
BROADCAST_IDS = 2_000_000

_LOWER_WORDS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else 0x20 if c == 0x20 or 9 <= c <= 13 else c for c in range(256)
)


def _combined(words: np.ndarray, n: int, size: int) -> np.ndarray:
    h = np.full(n, size, np.uint64)
    for k in range(size):
        h = mixed(h + words[k : k + n])
    return h


def shingle_sets(texts: list[str | None], size: int = WORDS) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, sorted. Fewer words than ``size`` are one shingle."""
    words = [(t or "").encode("utf-8", "surrogatepass").translate(_LOWER_WORDS).split() for t in texts]
    hashed = word_hashes(b" ".join(b" ".join(w) for w in words if w))
    out, at = [], 0
    for own in words:
        part = hashed[at : at + len(own)]
        at += len(own)
        if not own:
            out.append(part)
        elif len(own) < size:
            out.append(_combined(part, 1, len(own)))
        else:
            h = np.sort(_combined(part, len(own) - size + 1, size))
            out.append(h[np.concatenate(([True], h[1:] != h[:-1]))])
    return out


def _spare(n):
    """Shingles of a set of ``n`` that a partner may lack: ``n`` less LEAST of it, rounded down."""
    return n - (n * LEAST.numerator + LEAST.denominator - 1) // LEAST.denominator


def _binary(data: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Binary values that cut ``data`` into runs of ``counts`` items."""
    raw = np.ascontiguousarray(data)
    offsets = np.concatenate(([0], np.cumsum(counts))) * raw.itemsize
    return pa.Array.from_buffers(
        pa.large_binary(),
        len(counts),
        [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw)],
    ).cast(pa.binary())


_BLOCKS = "bucket int, ids binary, sizes binary, counts binary, hashes binary, common binary, often binary"
_FOUND = "doc_id long, n long, single long, hashes binary"


def _blocks(docs: DataFrame, eighths: tuple[int, int], buckets: int, size: int) -> DataFrame:
    """What each block of documents has for each bucket of a fragment.

    ``ids``, ``sizes`` (of whole sets) and ``counts`` are by document, ``hashes`` of document after
    document. Shingles of at least FREQUENT documents of the block come as ``common`` with
    ``often``, their numbers of documents, and with each document in a row of its own.
    """
    low, high = eighths
    width = np.uint64((((high - low) << 61) + buckets - 1) // buckets)

    def block(ids: list[int], sets: list[np.ndarray]):
        sizes = np.array([len(s) for s in sets], np.int64)
        hashes = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), sizes)
        part = (hashes >> np.uint64(61)).astype(np.int64)
        inside = (part >= low) & (part < high)
        hashes, owner = hashes[inside], owner[inside]
        names = np.array(ids, np.int64)
        ordered = np.sort(hashes)
        first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        times = np.diff(np.append(first, len(ordered))) if len(ordered) else first
        often = times >= FREQUENT
        common, often = ordered[first[often]] if len(ordered) else ordered, times[often]
        is_common = np.zeros(len(hashes), bool)
        if len(common):
            place = np.searchsorted(common, hashes)
            is_common = common[np.minimum(place, len(common) - 1)] == hashes
        bucket = ((hashes - np.uint64(low << 61)) // width).astype(np.int64)
        own = np.flatnonzero(~is_common)
        order = own[np.argsort(bucket[own].astype(np.uint16 if buckets < 65536 else np.int64), kind="stable")]
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        common_bucket = ((common - np.uint64(low << 61)) // width).astype(np.int64)
        with_common = np.bincount(owner[is_common], minlength=len(sets))
        rows: dict[str, list] = {f.split()[0]: [] for f in _BLOCKS.split(", ")}

        def put(b, who, counts, values, shared, n_shared):
            for key, x in zip(
                rows,
                (
                    b,
                    names[who].tobytes(),
                    sizes[who].tobytes(),
                    counts.astype(np.int32).tobytes(),
                    values.tobytes(),
                    shared.tobytes(),
                    n_shared.astype(np.int64).tobytes(),
                ),
                strict=True,
            ):
                rows[key].append(x)

        none = np.zeros(0, np.uint64)
        for b in range(buckets):
            mine = order[edges[b] : edges[b + 1]]
            shared = common_bucket == b
            if not len(mine) and not shared.any():
                continue
            per = np.bincount(owner[mine], minlength=len(sets))
            who = np.flatnonzero(per)
            put(b, who, per[who], hashes[mine], common[shared], often[shared])
        # every document at least once, with its size and its common shingles (bucket: any)
        who = np.arange(len(sets))
        put(
            int(names[0] % buckets), who, -1 - with_common, hashes[is_common], none, np.zeros(0)
        )
        return rows

    types = {"bucket": pa.int32()}

    def run(batches):
        ids, sets, held = [], [], 0
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a in range(0, len(names), 512):
                made = shingle_sets(texts[a : a + 512], size)
                for name, s in zip(names[a : a + 512], made, strict=True):
                    if len(s):
                        ids.append(name)
                        sets.append(s)
                        held += len(s)
                    if held >= BLOCK_SHINGLES:
                        rows = block(ids, sets)
                        ids, sets, held = [], [], 0
                        yield pa.RecordBatch.from_pydict(
                            {k: pa.array(v, types.get(k, pa.binary())) for k, v in rows.items()}
                        )
        if ids:
            rows = block(ids, sets)
            yield pa.RecordBatch.from_pydict(
                {k: pa.array(v, types.get(k, pa.binary())) for k, v in rows.items()}
            )

    return docs.mapInArrow(tidy(run), _BLOCKS)


def _counted(table: pa.Table) -> pa.Table:
    """For one bucket: how many shingles each document has alone, and which it shares."""

    def whole(name: str, kind: str, rows=None) -> list[np.ndarray]:
        values = table[name].to_pylist()
        return [np.frombuffer(values[i], kind) for i in (range(len(values)) if rows is None else rows)]

    counts = whole("counts", "<i4")
    listed = [i for i, c in enumerate(counts) if len(c) == 0 or c[0] >= 0]
    passed = [i for i, c in enumerate(counts) if len(c) and c[0] < 0]

    def joined(parts: list[np.ndarray], kind: str) -> np.ndarray:
        return np.concatenate(parts) if parts else np.zeros(0, kind)

    ids, sizes = joined(whole("ids", "<i8", listed), "<i8"), joined(whole("sizes", "<i8", listed), "<i8")
    per = joined([counts[i] for i in listed], "<i4").astype(np.int64)
    hashes = joined(whole("hashes", "<u8", listed), "<u8")
    owner = np.repeat(np.arange(len(ids)), per)
    if len(np.unique(ids)) < len(ids):  # rows that repeat an id: its shingles count once
        uniq, at = np.unique(ids, return_inverse=True)
        total = np.bincount(at, weights=sizes, minlength=len(uniq)).astype(np.int64)
        owner = at[owner]
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        hashes, owner = hashes[new], owner[new]
        ids, sizes, per = uniq, total, np.bincount(owner, minlength=len(uniq))
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    first = np.ones(len(ordered), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    group = np.cumsum(first) - 1
    df = np.bincount(group) if len(group) else np.zeros(0, np.int64)
    common = joined(whole("common", "<u8", listed), "<u8")
    if len(common) and len(ordered):
        distinct = ordered[first]
        place = np.minimum(np.searchsorted(distinct, common), len(distinct) - 1)
        hit = distinct[place] == common
        df = df.copy()
        np.add.at(df, place[hit], joined(whole("often", "<i8", listed), "<i8")[hit])
    shared = np.zeros(len(hashes), bool)
    shared[order] = df[group] > 1
    n_shared = np.bincount(owner[shared], minlength=len(ids))
    out = [
        pa.RecordBatch.from_arrays(
            [
                pa.array(ids),
                pa.array(np.zeros(len(ids), np.int64)),
                pa.array(per - n_shared),
                _binary(hashes[shared], n_shared),
            ],
            ["doc_id", "n", "single", "hashes"],
        )
    ]
    # what came with its documents goes on as it is
    for i in passed:
        own, n = whole("ids", "<i8", [i])[0], whole("sizes", "<i8", [i])[0]
        per, values = -1 - counts[i].astype(np.int64), whole("hashes", "<u8", [i])[0]
        out.append(
            pa.RecordBatch.from_arrays(
                [
                    pa.array(own),
                    pa.array(n),
                    pa.array(np.zeros(len(own), np.int64)),
                    _binary(values, per),
                ],
                ["doc_id", "n", "single", "hashes"],
            )
        )
    del hashes, owner, order, ordered, first, group, shared
    give_back()
    return pa.Table.from_batches(out)


def _fragment(docs: DataFrame, eighths: tuple[int, int], text_bytes: int, size: int) -> DataFrame:
    """``doc_id``, ``n``, ``largest``, ``single`` and ``hashes`` of each document over a fragment."""
    share = text_bytes * (eighths[1] - eighths[0]) / 8
    buckets = int(max(16, min(60_000, -(-share // BUCKET_BYTES))))
    found = (
        _blocks(docs, eighths, buckets, size).groupBy("bucket").applyInArrow(_counted, _FOUND)
    )
    return found.groupBy("doc_id").agg(
        F.sum("n").alias("n"),
        F.max("n").alias("largest"),
        F.sum("single").alias("single"),
        F.collect_list("hashes").alias("hashes"),
    )


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _merged():
    """Sets from what both fragments gave: shared shingles, sorted, and their number."""

    def compute(first, second):
        sets = [
            np.unique(np.concatenate([np.frombuffer(x, "<u8") for x in [*(a or []), *(b or []), b""]]))
            for a, b in zip(first.to_pylist(), second.to_pylist(), strict=True)
        ]
        return [[x.tobytes() for x in sets], [len(x) for x in sets]]

    return compute


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a``, ``b`` and ``both``, the size of the intersection, counted by fragment and summed."""
    spark = pairs.sparkSession
    bounded_batches(spark)

    def cut(batches):
        for batch in batches:
            names, values = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out = {"rep": [], "part": [], "tokens": []}
            for name, value in zip(names, values, strict=True):
                hashes = np.frombuffer(value, "<u8")
                edges = np.searchsorted(hashes >> np.uint64(61), np.arange(PARTS + 1))
                for f in range(PARTS):
                    if edges[f] < edges[f + 1]:
                        out["rep"].append(name)
                        out["part"].append(f)
                        out["tokens"].append(hashes[edges[f] : edges[f + 1]].tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out["rep"], pa.int64()),
                    pa.array(out["part"], pa.int32()),
                    pa.array(out["tokens"], pa.binary()),
                ],
                list(out),
            )

    parts = sets.select("rep", "tokens").mapInArrow(tidy(cut), "rep long, part int, tokens binary")
    ours = parts.select(F.col("rep").alias("b"), "part", F.col("tokens").alias("of_b"))
    theirs = parts.select(F.col("rep").alias("a"), "part", F.col("tokens").alias("of_a"))
    met = pairs.select("a", "b").join(ours, "b").join(theirs, ["a", "part"])

    def start():
        def compute(x, y):
            return [
                [
                    len(np.intersect1d(np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8"), True))
                    for a, b in zip(x.to_pylist(), y.to_pylist(), strict=True)
                ]
            ]

        return compute

    counted = add_columns(met, ["of_a", "of_b"], "both long", start, ["a", "b"])
    return counted.groupBy("a", "b").agg(F.sum("both").alias("both"))


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sets are similar enough. ``pairs`` have ``n_a`` and ``n_b``."""
    union = F.col("n_a") + F.col("n_b") - F.col("both")
    return (
        pairs.join(_overlaps(pairs, sets), ["a", "b"])
        .where(LEAST.denominator * F.col("both") >= LEAST.numerator * union)
        .select("a", "b")
    )


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WORDS):
    """``doc_id``, ``n_shingles`` and ``component_id`` of each row.

    Words are runs of other characters than white space, A-Z lower-cased; a document's set has its
    distinct shingles of ``size`` words, or all its words as one shingle if it has fewer. Documents
    link when their sets' Jaccard similarity is at least LEAST; ``component_id`` is the smallest id
    that links reach. Null, empty and blank texts have no shingles and no links. Ids are whole
    numbers; rows that repeat an id are one document with the shingles of all its texts (their
    ``n_shingles`` is that of the largest text where no partner is possible). A row without an id has a null ``component_id`` and null ``n_shingles``,
    and takes no part. All other columns are left out; join them by id.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).alias("text"))
    named = rows.where("doc_id IS NOT NULL AND text IS NOT NULL")
    text_bytes = named.agg(F.sum(F.octet_length("text"))).collect()[0][0] or 0

    first = _fragment(named, (0, FIRST_EIGHTHS), text_bytes, size)
    alive = F.col("single") <= _spare_of("n")
    kept = F.when(alive, F.col("hashes")).alias("hashes")
    first = _written(first.select("doc_id", "n", "largest", "single", kept), "fragment")
    alive_ids = first.where("hashes IS NOT NULL").select("doc_id")
    left = alive_ids.count()
    # few enough ids are sent to every task; else the texts are joined to them by id
    some = F.broadcast(alive_ids) if left <= BROADCAST_IDS else alive_ids
    second = _fragment(named.join(some, "doc_id", "left_semi"), (FIRST_EIGHTHS, 8), text_bytes, size)
    second = second.select(
        "doc_id",
        F.col("single").alias("single_2"),
        F.col("hashes").alias("hashes_2"),
    )
    both = first.where("hashes IS NOT NULL").join(second, "doc_id")
    both = both.withColumn("single", F.col("single") + F.col("single_2"))
    sets = add_columns(
        both.where(F.col("single") <= _spare_of("n")),
        ["hashes", "hashes_2"],
        "tokens binary, n_shared long",
        _merged,
        ["doc_id", "single"],
    )
    sets = sets.withColumn("size", F.col("single") + F.col("n_shared")).where(
        F.col("single") <= _spare_of("size")
    )
    # copies: equal sets, which have no shingle of their own
    same = F.when(F.col("single") == 0, F.sha2("tokens", 256)).otherwise(
        F.col("doc_id").cast("string")
    )
    sets = _written(sets.withColumn("same", same), "sets")
    rep_of = sets.groupBy("same").agg(F.min("doc_id").alias("rep"))
    members = _written(sets.select("doc_id", "same").join(rep_of, "same").select("doc_id", "rep"), "members")
    reps = (
        sets.join(rep_of.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
        .withColumnRenamed("doc_id", "rep")
        .select("rep", "size", "tokens")
    )
    # The smallest id of the copies of a set stands for them, so the components of these give every
    # document's, and no set is a hub of its copies.
    if members.limit(1).count():
        linked = components(_class_links(reps)).withColumnRenamed("node", "rep")
        found = members.join(linked, "rep", "left").select(
            "doc_id", F.coalesce("component", "rep").alias("component")
        )
    else:
        found = members.withColumnRenamed("rep", "component")
    sizes = first.select("doc_id", F.col("largest").alias("n_shingles"))
    exact = sets.select("doc_id", F.col("size").alias("exact"))
    return (
        rows.select("doc_id")
        .join(sizes, "doc_id", "left")
        .join(exact, "doc_id", "left")
        .join(found, "doc_id", "left")
        .select(
            "doc_id",
            F.when(
                F.col("doc_id").isNotNull(), F.coalesce("exact", "n_shingles", F.lit(0))
            ).cast("long").alias("n_shingles"),
            F.coalesce("component", "doc_id").alias("component_id"),
        )
    )


def _spare_of(n: str):
    p, q = LEAST.numerator, LEAST.denominator
    return F.col(n) - F.floor((F.col(n) * p + q - 1) / q)


def _prefixes(reps: DataFrame) -> DataFrame:
    """``rep``, ``size``, ``shingle``, ``left``: a set's rarest shingles, one of which a partner has.

    ``left`` is how many shingles of the set are no rarer than this one, itself among them.

    Rare is what few different sets hold, now that copies are one: the shingles of a large group
    come before those of a passage that more documents have, and a shingle of one set only is its
    own. Sets with too many of these have no prefix left and no partner.
    """
    spark = reps.sparkSession

    def listed():
        return lambda tokens: [[np.frombuffer(t, "<i8") for t in tokens.to_pylist()]]

    held = _written(
        add_columns(reps, ["tokens"], "shingles array<long>", listed, ["rep", "size"]).select(
            "rep", "size", F.explode("shingles").alias("shingle")
        ),
        "held",
    )
    # most shingles of a set that has partners are held by several sets
    counts = held.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    rare = F.array_sort(F.collect_list(F.struct("df", "shingle")))
    kept = F.floor((F.col("size") * LEAST.numerator + LEAST.denominator - 1) / LEAST.denominator)
    # of the spare ones and one more, those of this set alone come first
    least = (F.size("rare") - kept + 1).cast("int")
    ordered = held.join(counts, "shingle").groupBy("rep", "size").agg(rare.alias("rare"))
    prefix = F.slice("rare", F.lit(1), F.greatest(least, F.lit(0)))
    path = scratch_path(spark, "prefixes")
    own = F.col("size") - F.size("rare")
    ordered.select("rep", "size", own.alias("own"), F.posexplode(prefix).alias("at", "x")).select(
        "rep", "size", (F.col("size") - F.col("own") - F.col("at")).alias("left"), "x.shingle"
    ).write.parquet(path)
    return spark.read.parquet(path)


def _class_links(reps: DataFrame) -> DataFrame:
    """Links between different sets that give the same components as all links."""
    met = _prefixes(reps)
    sets = _written(reps.select("rep", "tokens"), "classes")
    p, q = LEAST.numerator, LEAST.denominator

    def close():
        """Whether sets that have this shingle as the rarest in common can be similar enough."""
        most = F.least("left_a", "left_b")
        return (p + q) * most >= p * (F.col("n_a") + F.col("n_b"))

    leader = met.groupBy("shingle").agg(
        F.min("rep").alias("a"),
        F.min_by("size", "rep").alias("n_a"),
        F.min_by("left", "rep").alias("left_a"),
        F.count("*").alias("m"),
    )
    pairs = (
        met.withColumnsRenamed({"rep": "b", "size": "n_b", "left": "left_b"})
        .join(leader.where("m > 1"), "shingle")
        .where((F.col("a") < F.col("b")) & close())
        .select("a", "b", "n_a", "n_b")
        .distinct()
    )
    pairs = _written(pairs, "pairs")
    if not pairs.limit(1).count():  # no two sets meet
        return pairs.select("a", "b")
    stars = _written(_linked(pairs, sets), "stars")
    group = components(stars).withColumnRenamed("node", "rep")
    met = met.join(group, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    mixed = (
        met.groupBy("shingle")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        .where("lo < hi")
        .select("shingle")
    )
    met = _written(met.join(mixed, "shingle", "left_semi"), "mixed")
    sides = [
        met.select(
            "shingle",
            F.col("rep").alias(side),
            F.col("size").alias(f"n_{side}"),
            F.col("left").alias(f"left_{side}"),
            F.col("component").alias(f"component_{side}"),
        )
        for side in "ab"
    ]
    rest = (
        sides[0]
        .join(sides[1], "shingle")
        .where((F.col("a") < F.col("b")) & (F.col("component_a") != F.col("component_b")) & close())
        .select("a", "b", "n_a", "n_b")
        .distinct()
        .join(pairs.select("a", "b"), ["a", "b"], "left_anti")
    )
    rest = _written(rest, "pairs")
    if not rest.limit(1).count():
        return stars
    return stars.unionByName(_linked(rest, sets))
