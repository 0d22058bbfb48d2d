"""Hard negatives by largest inner product, from cover trees over norm-augmented vectors.

One more coordinate brings every vector of a block to the length of its longest. All of them then
lie on one sphere, and an inner product with an anchor is the cosine of an angle on it. A node of a
cover tree holds a centre and the greatest angle from it to anything below, so that the angle to the
centre bounds the products of the whole node from both sides. Children of a node are picked farthest
first: they are at least as far from each other as their own covering radius, which shrinks from
level to level.

Blocks are bounded sets of rows with similar labels and places. The header of a block (its centre,
angle and labels) says which anchors can find anything in it; only those are sent there. In a block,
the node that promises most to any anchor is opened first, nodes outside all windows that are still
open for an anchor are skipped, and the vectors of a leaf are multiplied exactly, in whole numbers.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewright.llm.columns import bounded_batches, col
from tapewright.llm.integers import matrix, packed, products, scaled
from tapewright.session import scratch_path

# Squared lengths of scaled vectors are below this: 100 times a product fits a long.
LARGEST = 1 << 55
BLOCK_ROWS = 4_096  # rows of a block and its tree
BLOCK_ANCHORS = 2_048  # anchors that meet a block in one task
LABEL_BUCKETS = 64
SAMPLE_ROWS = 20_000  # rows that the pivots are picked from
PIVOTS = 256
HEADERS = 4_096  # block headers broadcast at once; more are sent in further passes
FANOUT = 48
LEAF = 24
SHRINK = 0.7  # of a node's covering radius: that of its children
SLACK = 1e-9
NOTHING = np.iinfo(np.int64).min


def lifted(x: np.ndarray) -> np.ndarray:
    """Rows with one more coordinate, scaled to length one; the longest row has 0 there."""
    x = x.astype(np.float64)
    size = (x**2).sum(1)
    longest = size.max()
    if longest == 0:
        return np.concatenate([x, np.ones((len(x), 1))], axis=1)
    rest = np.sqrt(np.maximum(longest - size, 0))
    return np.concatenate([x, rest[:, None]], axis=1) / np.sqrt(longest)


def angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Angles of the rows of ``a`` to the unit vector ``b``, well measured when small too."""
    return 2 * np.arcsin(np.minimum(np.sqrt(((a - b) ** 2).sum(1)) / 2, 1))


@dataclass
class Tree:
    """Rows in order of id, and nodes: centre, covering angle, and children or the rows of a leaf."""

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    longest: float
    centre: np.ndarray
    angle: np.ndarray
    below: list[np.ndarray]
    leaf: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> Tree:
        order = np.lexsort([*x.T[::-1], labels, ids])
        ids, labels, x = ids[order], labels[order], x[order]
        points = lifted(x)
        middle = points.mean(0)
        root = int(np.argmin(((points - middle) ** 2).sum(1)))
        centre, angle, below, leaf = [root], [0.0], [None], [False]
        todo = [(0, np.arange(len(x)), angles(points, points[root]))]
        while todo:
            node, rows, far = todo.pop()
            angle[node] = float(far.max())
            if len(rows) <= LEAF or angle[node] == 0:
                below[node], leaf[node] = rows, True
                continue
            # a net of the node's rows: the centre, and the farthest row again and again
            own = points[rows]
            nearest, gap = np.zeros(len(rows), np.int64), far.copy()
            picked = [centre[node]]
            while gap.max() > SHRINK * angle[node] and len(picked) < FANOUT:
                far_row = int(gap.argmax())
                other = angles(own, own[far_row])
                closer = other < gap
                nearest[closer], gap[closer] = len(picked), other[closer]
                picked.append(int(rows[far_row]))
            children = []
            for i, p in enumerate(picked):
                mine = nearest == i
                if mine.any():
                    children.append(len(centre))
                    centre.append(p)
                    angle.append(0.0)
                    below.append(None)
                    leaf.append(False)
                    todo.append((children[-1], rows[mine], gap[mine]))
            below[node] = np.array(children)
        longest = float(np.sqrt((x.astype(np.float64) ** 2).sum(1).max()))
        return cls(ids, labels, packed(x), longest, np.array(centre), np.array(angle), below, np.array(leaf))


def bounds(
    anchors: np.ndarray, centres: np.ndarray, longest: np.ndarray, angle: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest product of each anchor with anything below each centre.

    A centre's own length is at most ``longest``, the length of the sphere it lies on.
    """
    a = anchors.astype(np.float64)
    shape = (len(a), len(centres))
    sphere = np.broadcast_to(np.sqrt((a**2).sum(1))[:, None] * longest, shape)
    product = a @ centres.T.astype(np.float64)
    cosine = np.divide(product, sphere, out=np.zeros(shape), where=sphere > 0)
    turn = np.arccos(np.clip(cosine, -1, 1))
    # rounding is allowed for in the angle, as small angles are ill measured by their cosine
    wide = angle + 1e-7
    slack = SLACK * sphere + SLACK
    low = sphere * np.cos(np.minimum(turn + wide, np.pi)) - slack
    high = sphere * np.cos(np.maximum(turn - wide, 0)) + slack
    return low, high


class Search:
    """The best ``k`` products of each anchor in each of its windows, among the rows of one tree.

    ``low`` and ``high`` (anchors by windows) are the windows' ends, both included. ``same`` looks
    for rows with the anchor's label and otherwise for rows with another one; the anchor's own id is
    never found.
    """

    def __init__(self, tree: Tree, ids, labels, x, low, high, k: int, same: bool):
        self.tree, self.ids, self.labels, self.x = tree, ids, labels, x
        self.low, self.high, self.same = low, high, same
        self.score = np.full((*low.shape, k), NOTHING)
        self.found = np.full((*low.shape, k), np.iinfo(np.int64).max)
        self.opened = self.verified = 0

    def wanted(self, low: np.ndarray, high: np.ndarray, who) -> np.ndarray:
        """Of the anchors ``who``, whether products from ``low`` to ``high`` can matter."""
        least = np.maximum(self.low[who], self.score[who][:, :, -1])
        return ((high[:, None] >= least) & (low[:, None] <= self.high[who])).any(1)

    def run(self) -> Search:
        tree, everyone = self.tree, np.arange(len(self.x))
        low, high = bounds(self.x, tree.x[tree.centre[:1]], tree.longest, tree.angle[:1])
        heap = [(0.0, 0, everyone, low[:, 0], high[:, 0])]
        while heap:
            _, node, who, low, high = heapq.heappop(heap)
            still = self.wanted(low, high, who)
            who = who[still]
            if not len(who):
                continue
            self.opened += 1
            if tree.leaf[node]:
                self.verify(who, tree.below[node])
                continue
            children = tree.below[node]
            low, high = bounds(
                self.x[who], tree.x[tree.centre[children]], tree.longest, tree.angle[children]
            )
            for i, child in enumerate(children.tolist()):
                some = self.wanted(low[:, i], high[:, i], who)
                if some.any():
                    best = float(high[some, i].max())
                    heapq.heappush(heap, (-best, child, who[some], low[some, i], high[some, i]))
        return self

    def verify(self, who: np.ndarray, rows: np.ndarray) -> None:
        tree = self.tree
        score = products(self.x[who], tree.x[rows])
        self.verified += score.size
        fits = (tree.labels[rows] == self.labels[who, None]) == self.same
        fits &= tree.ids[rows] != self.ids[who, None]
        for w in range(self.low.shape[1]):
            least = np.maximum(self.low[who, w], self.score[who, w, -1])
            inside = fits & (score >= least[:, None]) & (score <= self.high[who, w][:, None])
            gain = np.flatnonzero(inside.any(1))
            if not len(gain):
                continue
            at = who[gain]
            new = np.where(inside[gain], score[gain], NOTHING)
            names = np.where(inside[gain], tree.ids[rows], np.iinfo(np.int64).max)
            score_all = np.concatenate([self.score[at, w], new], axis=1)
            found_all = np.concatenate([self.found[at, w], names], axis=1)
            # -score would overflow for the mark of an empty place
            order = np.lexsort((found_all, ~score_all), axis=-1)[:, : self.score.shape[2]]
            self.score[at, w] = np.take_along_axis(score_all, order, 1)
            self.found[at, w] = np.take_along_axis(found_all, order, 1)


_BLOCK = ["d", "bucket", "part", "split"]
_TREES = (
    "d int, bucket int, part int, split int, n long, least long, most long, longest double,"
    " angle double, centre array<long>, tree binary"
)


def _built(rows: pa.Table) -> pa.Table:
    d = rows["d"][0].as_py()
    tree = Tree.of(
        rows["vec_id"].to_numpy(),
        rows["label"].to_numpy(),
        matrix(rows["x"].combine_chunks(), d).copy(),
    )
    made = {name: [rows[name][0].as_py()] for name in _BLOCK}
    made |= {
        "n": [len(tree.ids)],
        "least": [int(tree.labels.min())],
        "most": [int(tree.labels.max())],
        "longest": [tree.longest],
        "angle": [float(tree.angle[0])],
        "centre": [tree.x[tree.centre[0]].tolist()],
        "tree": [pickle.dumps(tree)],
    }
    kinds = {"d": pa.int32(), "bucket": pa.int32(), "part": pa.int32(), "split": pa.int32()}
    kinds |= {"n": pa.int64(), "least": pa.int64(), "most": pa.int64(), "longest": pa.float64()}
    kinds |= {"angle": pa.float64(), "centre": pa.list_(pa.int64()), "tree": pa.binary()}
    return pa.table({name: pa.array(made[name], kind) for name, kind in kinds.items()})


def _pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` rows of a sample, each the farthest from those before it."""
    points = lifted(sample)
    picked = [int(np.argmin(((points - points.mean(0)) ** 2).sum(1)))]
    gap = angles(points, points[picked[0]])
    while len(picked) < n and gap.max() > 0:
        picked.append(int(gap.argmax()))
        gap = np.minimum(gap, angles(points, points[picked[-1]]))
    return sample[picked]


def _placed(rows: DataFrame, block_rows: int) -> DataFrame:
    """The rows in blocks: by length, label bucket, nearest pivot, and a hash where that is too many."""
    spark = rows.sparkSession
    per = rows.groupBy("d", "bucket").agg(F.count("*").alias("n"))
    parts = per.select("d", "bucket", F.least(F.lit(PIVOTS), F.ceil(F.col("n") / block_rows)).cast("int").alias("parts"))
    dims = rows.groupBy("d").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    main, total = dims[0]["d"], dims[0]["n"]
    rate = F.pmod(F.xxhash64("vec_id", "x"), F.lit(1 << 32)) < int((1 << 32) * min(1, SAMPLE_ROWS / total))
    sample = rows.where((F.col("d") == main) & rate).select("x").toArrow()["x"].combine_chunks()
    if not len(sample):
        sample = rows.where(F.col("d") == main).select("x").limit(1).toArrow()["x"].combine_chunks()
    drawn = matrix(sample, main)
    pivots = _pivots(drawn[np.lexsort(drawn.T[::-1])], PIVOTS)
    shared = spark.sparkContext.broadcast(pivots)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value.astype(np.float64)
        for batch in batches:
            d, most = batch.column("d").to_numpy(), batch.column("parts").to_numpy()
            part = np.zeros(len(d), np.int32)
            spread = np.flatnonzero((d == main) & (most > 1))
            if len(spread):
                x = matrix(batch.column("x").take(pa.array(spread)), main).astype(np.float64)
                size = np.maximum(np.sqrt((x**2).sum(1)), 1)[:, None]
                near = (x / size) @ (own / np.maximum(np.sqrt((own**2).sum(1)), 1)[:, None]).T
                near[np.arange(len(own)) >= most[spread, None]] = -np.inf
                part[spread] = near.argmax(1)
            columns = [batch.column(c) for c in ("vec_id", "label", "x", "d", "bucket")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(part)], ["vec_id", "label", "x", "d", "bucket", "part"]
            )

    path = scratch_path(spark, "placed")
    rows.join(parts, ["d", "bucket"]).mapInArrow(
        deal, "vec_id long, label long, x array<long>, d int, bucket int, part int"
    ).write.parquet(path)
    placed = spark.read.parquet(path)
    held = placed.groupBy("d", "bucket", "part").agg(
        F.ceil(F.count("*") / block_rows).cast("int").alias("splits")
    )
    own = F.pmod(F.xxhash64("vec_id", "x"), F.col("splits").cast("long")).cast("int")
    return placed.join(held, ["d", "bucket", "part"]).withColumn("split", own).drop("splits")


_ASKED = "d int, anchor long, vec_id long, label long, x array<long>, low array<long>, high array<long>"


def _routed(anchors: DataFrame, trees: DataFrame, n_blocks: int, same: bool, k: int) -> DataFrame:
    """Anchors, once for each block that can hold something for them.

    Headers are broadcast in shards of HEADERS, about; each anchor goes through all of them.
    """
    spark = anchors.sparkSession
    shards = -(-n_blocks // HEADERS)
    shard = F.pmod(F.xxhash64(*_BLOCK), F.lit(shards))
    heads = trees.drop("tree")

    def route(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            by_length: dict[int, list[dict]] = shared.value
            for batch in batches:
                d = batch.column("d").to_numpy()
                for length, blocks in by_length.items():
                    rows = np.flatnonzero(d == length)
                    for a in range(0, len(rows), 512):
                        some = batch.take(pa.array(rows[a : a + 512]))
                        yield from met(some, length, blocks)

        def met(batch: pa.RecordBatch, d: int, blocks: list[dict]) -> Iterator[pa.RecordBatch]:
            x, label = matrix(batch.column("x"), d), batch.column("label").to_numpy()
            low, high = (matrix(batch.column(c), len(batch.column(c)[0])) for c in ("low", "high"))
            column = {c: np.array([b[c] for b in blocks]) for c in ("n", "least", "most", "bucket")}
            least, most = bounds(
                x,
                np.array([b["centre"] for b in blocks], np.int64).reshape(len(blocks), d),
                np.array([b["longest"] for b in blocks]),
                np.array([b["angle"] for b in blocks]),
            )
            only = (column["least"] == label[:, None]) & (column["most"] == label[:, None])
            if same:
                go = (column["least"] <= label[:, None]) & (label[:, None] <= column["most"])
                go &= column["bucket"] == batch.column("bucket").to_numpy()[:, None]
                # a block of more than k rows of its own label holds k products of at least this
                sure = np.where(only & go & (column["n"] > k), least, -np.inf).max(1)
                go &= most >= sure[:, None]
            else:
                go = np.zeros(only.shape, bool)
                for w in range(low.shape[1]):
                    go |= (most >= low[:, w : w + 1]) & (least <= high[:, w : w + 1])
                go &= ~only
            r, b = np.nonzero(go)
            for at in range(0, len(r), 4_096):
                rr, bb = r[at : at + 4_096], b[at : at + 4_096]
                sent = batch.take(pa.array(rr))
                arrays = [sent.column(c) for c in ("d", "anchor", "vec_id", "label", "x", "low", "high")]
                for name in _BLOCK[1:]:
                    arrays.append(pa.array([blocks[i][name] for i in bb.tolist()], pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    arrays, ["d", "anchor", "vec_id", "label", "x", "low", "high", *_BLOCK[1:]]
                )

        return run

    sent = None
    for i in range(shards):
        mine = heads.where(shard == i) if shards > 1 else heads
        by_length: dict[int, list[dict]] = {}
        for block in mine.collect():
            by_length.setdefault(block["d"], []).append(block.asDict())
        shared = spark.sparkContext.broadcast(by_length)
        part = anchors.mapInArrow(route(shared), f"{_ASKED}, bucket int, part int, split int")
        sent = part if sent is None else sent.unionByName(part)
    path = scratch_path(spark, "routes")
    sent.write.parquet(path)
    return spark.read.parquet(path)


def _searched(anchors: DataFrame, trees: DataFrame, n_blocks: int, same: bool, k: int) -> DataFrame:
    """``anchor``, ``anchor_id``, ``w`` (number of the window), ``score``, ``vec_id``: of each block the best."""
    routes = _routed(anchors, trees, n_blocks, same, k)
    shifts = routes.groupBy(*_BLOCK).agg(
        F.ceil(F.count("*") / BLOCK_ANCHORS).cast("int").alias("shifts")
    )
    left = trees.select(*_BLOCK, "tree").join(shifts, _BLOCK)
    left = left.withColumn("shift", F.explode(F.sequence(F.lit(0), F.col("shifts") - 1))).drop("shifts")
    right = routes.join(shifts, _BLOCK).withColumn(
        "shift", F.pmod(F.xxhash64("anchor"), F.col("shifts").cast("long")).cast("int")
    )

    def best(own: pa.Table, asked: pa.Table) -> pa.Table:
        names = ["anchor", "anchor_id", "w", "score", "vec_id"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        if not own.num_rows or not asked.num_rows:
            return pa.table({n: pa.array([], t) for n, t in zip(names, kinds, strict=True)})
        tree: Tree = pickle.loads(own["tree"][0].as_py())
        low, high = (
            matrix(asked[c].combine_chunks(), len(asked[c][0])) for c in ("low", "high")
        )
        x = matrix(asked["x"].combine_chunks(), tree.x.shape[1])
        ids, labels = asked["vec_id"].to_numpy(), asked["label"].to_numpy()
        found = Search(tree, ids, labels, x, low, high, k, same).run()
        a, w, place = np.nonzero(found.score != NOTHING)
        made = [asked["anchor"].to_numpy()[a], ids[a], w, found.score[a, w, place], found.found[a, w, place]]
        return pa.table({n: pa.array(v, t) for n, v, t in zip(names, made, kinds, strict=True)})

    keys = [*_BLOCK, "shift"]
    return (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInArrow(best, "anchor long, anchor_id long, w int, score long, vec_id long")
    )


_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(
    vectors: DataFrame,
    is_anchor=None,
    positives: int = 5,
    negatives: int = 3,
    least: int = 50,
    most: int = 95,
    scale: int = 256,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    A score is the inner product with the anchor, of components taken as floor(scale * component).
    An anchor's positives are its ``positives`` highest rows of the same label, its negatives for
    each of them the ``negatives`` highest rows of another label whose score is from ``least`` to
    ``most`` percent of the positive's; ties go to the smaller id. Anchors are the rows for which
    ``is_anchor`` (a condition on ``vec_id``; default: all) holds.

    Rows with a null id, label or vector, with a null or non-finite component, without components,
    or too long for whole-number scores (``LARGEST``) take no part. Vectors of different lengths
    have no product and are not compared. Rows that repeat id, label and vector count once; rows of
    one id that differ otherwise are anchors and candidates of their own, but nothing to each other.
    A positive below zero has an empty window, one of zero only scores of zero. No usable row, no
    anchor, no positive or no negative gives no row. Other columns are not read.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    rows = scaled(
        vectors.withColumn("_label", col(label).cast("long")), scale, LARGEST, vec_id, vector, "_label"
    ).withColumnRenamed("_label", "label")
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND size(x) > 0").distinct()
    bucket = F.pmod(F.xxhash64("label"), F.lit(LABEL_BUCKETS)).cast("int")
    rows = written(rows.withColumns({"d": F.size("x"), "bucket": bucket}), "vectors")
    if not rows.limit(1).count():
        return spark.createDataFrame([], _RESULT)
    trees = written(
        _placed(rows, block_rows).groupBy(*_BLOCK).applyInArrow(_built, _TREES), "trees"
    )
    n_blocks = trees.count()

    anchors = rows if is_anchor is None else rows.where(is_anchor)
    whole = [F.array(F.lit(s * (1 << 62)).cast("long")).alias(n) for s, n in ((-1, "low"), (1, "high"))]
    anchors = anchors.select(
        "d", F.xxhash64("vec_id", "label", "x").alias("anchor"), "vec_id", "label", "x", "bucket"
    )
    near = _searched(anchors.select("*", *whole), trees, n_blocks, True, positives)
    by_score = Window.partitionBy("anchor_id", "anchor").orderBy(F.desc("score"), "vec_id")
    # the bounded list of an anchor's positives, best first
    near = written(
        near.withColumn("place", F.row_number().over(by_score))
        .where(F.col("place") <= positives)
        .groupBy(F.col("anchor_id").alias("vec_id"), "anchor")
        .agg(F.sort_array(F.collect_list(F.struct("place", "score", F.col("vec_id").alias("id")))).alias("near")),
        "positives",
    )

    def window(end: Callable[[Column], Column], empty: int) -> Column:
        """One end for each positive; a window that holds nothing, or is not there, is empty."""
        score = lambda i: F.get("near", i)["score"]
        return F.transform(
            F.sequence(F.lit(0), F.lit(positives - 1)),
            lambda i: F.when(score(i) >= 0, end(score(i))).otherwise(F.lit(empty).cast("long")),
        )

    # whole-number division, rounded up and down
    low = window(lambda s: F.call_function("div", s * least + 99, F.lit(100).cast("long")), 1 << 62)
    high = window(lambda s: F.call_function("div", s * most, F.lit(100).cast("long")), -(1 << 62))
    aimed = anchors.join(near, ["vec_id", "anchor"])
    far = _searched(
        aimed.select("d", "anchor", "vec_id", "label", "x", low.alias("low"), high.alias("high"), "bucket"),
        trees,
        n_blocks,
        False,
        negatives,
    )
    by_score = Window.partitionBy("anchor_id", "anchor", "w").orderBy(F.desc("score"), "vec_id")
    far = far.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= negatives)
    own = F.get("near", F.col("w"))
    return far.join(near.withColumnRenamed("vec_id", "anchor_id"), ["anchor_id", "anchor"]).select(
        "anchor_id",
        own["id"].alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        own["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
