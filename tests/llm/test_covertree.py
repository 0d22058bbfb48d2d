"""Hard negatives against scoring every row with every anchor."""

import math

import numpy as np
import pytest

from pyspark.sql import functions as F
from tapewright.llm import covertree

VEC = "vec_id long, embedding array<double>, label int, x string, tree string, score string"


def plain(rows, every, positives=5, negatives=3):
    kept = sorted(
        {
            (i, label, tuple(math.floor(256 * x) for x in v))
            for i, v, label, *_ in rows
            if None not in (i, v, label) and v and all(x is not None and math.isfinite(x) for x in v)
        }
    )
    out = []
    for i, label, x in kept:
        if i % every:
            continue
        scored = [
            (-sum(a * b for a, b in zip(x, other)), j, own == label)
            for j, own, other in kept
            if j != i and len(other) == len(x)
        ]
        scored.sort()
        for p, j, _ in [s for s in scored if s[2]][:positives]:
            p = -p
            fitting = [(-n, m) for n, m, same in scored if not same and 50 * p <= -100 * n <= 95 * p]
            for rank, (n, m) in enumerate(fitting[:negatives], 1):
                out.append((i, j, rank, m, p, n))
    return sorted(out)


def found(spark, rows, every, **options):
    vectors = spark.createDataFrame(rows, VEC).repartition(3)
    result = covertree.hard_negatives(vectors, is_anchor=F.col("vec_id") % every == 0, **options)
    return sorted(tuple(r) for r in result.collect())


def clustered(seed, n, dim, labels, spread=0.3):
    r = np.random.default_rng(seed)
    middles = r.normal(size=(8, dim))
    own = r.integers(0, 8, n)
    vectors = middles[own] + spread * r.normal(size=(n, dim))
    return [(i, vectors[i].tolist(), int((own[i] + r.integers(0, 2)) % labels), "x", "t", "s") for i in range(n)]


@pytest.mark.parametrize("block_rows", [17, 4_096])
@pytest.mark.parametrize("labels", [1, 3, 200])
def test_against_brute_force(spark, labels, block_rows):
    rows = clustered(labels, 400, 6, labels)
    assert found(spark, rows, 10, block_rows=block_rows) == plain(rows, 10)


def test_many_passes_and_shifts(spark, monkeypatch):
    monkeypatch.setattr(covertree, "HEADERS", 5)
    monkeypatch.setattr(covertree, "BLOCK_ANCHORS", 7)
    rows = clustered(4, 300, 4, 5)
    assert found(spark, rows, 3, block_rows=20) == plain(rows, 3)


def test_ties_repeats_and_unusable_rows(spark):
    same = [(i, [1.0, 0.0], i % 2, "x", "t", "s") for i in range(40)]
    rows = same + same[:10] + [(i, [0.75, 0.5], i % 2, "x", "t", "s") for i in range(40, 60)]
    rows += [
        (0, [0.5, 0.5], 0, "x", "t", "s"),  # an id twice, with different vectors
        (0, [0.5, 0.5], 1, "x", "t", "s"),
        (None, [1.0, 0.0], 0, "x", "t", "s"),
        (70, None, 0, "x", "t", "s"),
        (71, [], 0, "x", "t", "s"),
        (72, [1.0, None], 0, "x", "t", "s"),
        (73, [float("inf"), 0.0], 0, "x", "t", "s"),
        (74, [1.0, float("nan")], 0, "x", "t", "s"),
        (75, [1.0, 0.0], None, "x", "t", "s"),
        (80, [0.0, 0.0], 0, "x", "t", "s"),
        (90, [-1.0, -1.0], 0, "x", "t", "s"),
        (100, [1.0, 2.0, 3.0], 0, "x", "t", "s"),  # of another length: only compared with each other
        (101, [1.0, 2.0, 2.0], 0, "x", "t", "s"),
        (102, [1.0, 1.5, 2.0], 1, "x", "t", "s"),
    ]
    assert found(spark, rows, 10, block_rows=16) == plain(rows, 10)


def test_nothing_to_find(spark):
    rows = clustered(1, 20, 3, 2)
    assert found(spark, [], 10) == []
    assert found(spark, rows[1:9], 10) == []  # no anchor
    assert found(spark, [(*r[:2], i, *r[3:]) for i, r in enumerate(rows)], 10) == []  # no positive


def test_descent_skips_what_lies_outside():
    r = np.random.default_rng(3)
    middles = r.normal(size=(30, 8)) * 200
    x = np.floor(middles[r.integers(0, 30, 2_000)] + 10 * r.normal(size=(2_000, 8))).astype(np.int64)
    tree = covertree.Tree.of(np.arange(2_000), np.zeros(2_000, np.int64), x)
    anchors = x[:40]
    score = anchors @ x.T
    low, high = np.full((40, 1), -(1 << 62)), np.full((40, 1), 1 << 62)
    search = covertree.Search(tree, np.full(40, -1), np.zeros(40, np.int64), tree.x[:40].astype(np.int64), low, high, 5, True)
    search.run()
    own = tree.x.astype(np.int64)
    score = own[:40] @ own.T
    for a in range(40):
        best = sorted(zip(-score[a], tree.ids))[:5]
        assert [(-s, i) for s, i in zip(search.score[a, 0], search.found[a, 0])] == best
    assert search.verified < 0.5 * 40 * 2_000


@pytest.mark.parametrize("seed", range(5))
def test_bounds_and_levels(seed):
    r = np.random.default_rng(seed)
    x = r.integers(-100, 100, (500, 5)) * r.integers(1, 9, (500, 1))
    tree = covertree.Tree.of(np.arange(500), np.zeros(500, np.int64), x)
    own = tree.x.astype(np.int64)
    anchors = r.integers(-50, 50, (20, 5))

    def below(node):
        if tree.leaf[node]:
            return tree.below[node]
        return np.concatenate([below(c) for c in tree.below[node]])

    assert sorted(below(0)) == list(range(500))
    for node in range(len(tree.centre)):
        rows = below(node)
        low, high = covertree.bounds(anchors, own[tree.centre[node : node + 1]], tree.longest, tree.angle[node : node + 1])
        score = anchors @ own[rows].T
        assert (low <= score).all() and (score <= high).all()
        if not tree.leaf[node]:
            assert (tree.angle[tree.below[node]] <= tree.angle[node] + 1e-9).all()
