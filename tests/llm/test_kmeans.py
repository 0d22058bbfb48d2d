"""Centroid clustering against measuring every distance in every round."""

import hashlib
import math

import numpy as np
import pytest

from tapewright.llm import kmeans

VEC = "vec_id long, embedding array<double>, label int, x string, cluster string"


def rows_of(vectors, ids=None):
    return [(i, v, 0, "x", "c") for i, v in zip(ids or range(len(vectors)), vectors)]


def plain(rows, k, rounds, dim, scale=64):
    kept = [
        (i, [math.floor(scale * x) for x in v])
        for i, v, *_ in rows
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)
    ]
    seeds = sorted(
        ((hashlib.sha256(f"1:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None)
    )[:k]
    centroids = [x for _, x in seeds]
    if not centroids:
        return [], []

    def assign():
        out = []
        for i, x in kept:
            far = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in centroids]
            out.append((i, tuple(x), far.index(min(far)), min(far)))
        return out

    for _ in range(rounds):
        found = assign()
        for c in range(len(centroids)):
            own = [x for _, x, at, _ in found if at == c]
            if own:
                centroids[c] = [sum(column) // len(own) for column in zip(*own)]
    return assign(), centroids


def key(row):
    return tuple((x is None, x) for x in row)


def check(spark, rows, **options):
    found = kmeans.cluster(spark.createDataFrame(rows, VEC).repartition(3), **options)
    expected, centroids = plain(rows, options["k"], options["rounds"], options["dim"])
    got = [(r.vec_id, tuple(r.x), r.cluster, r.distance) for r in found.members.collect()]
    assert sorted(got, key=key) == sorted(expected, key=key)
    assert found.centroids.tolist() == centroids
    return found


@pytest.mark.parametrize("history_bytes", [1, kmeans.HISTORY_BYTES])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed, history_bytes):
    r = np.random.default_rng(seed)
    middles = r.normal(size=(6, 5)) * 3
    vectors = (middles[r.integers(0, 6, 300)] + r.normal(size=(300, 5))).tolist()
    found = check(spark, rows_of(vectors), k=6, rounds=6, dim=5, history_bytes=history_bytes)
    assert found.measured[0] == 6 * 300
    assert found.measured[-1] < 0.6 * 6 * 300  # bounds spare distances


def test_bounds_hold_over_many_moves():
    """Any order of rounds, with old rounds given up, finds what measuring all finds."""
    r = np.random.default_rng(5)
    x = r.integers(-50, 50, (400, 4))
    start = r.integers(-50, 50, (7, 4))
    for kept in (2, 3, 9):
        history = {0: start}
        state = kmeans.Bounds(history, 0, False).start(x)[:3]
        spared = 0
        for now in range(1, 9):
            # centroids move a little, forth and back
            history[now] = history[now - 1] + r.integers(-3, 4, (7, 4))
            oldest = now + 2 - kept
            bounds = kmeans.Bounds(history, now, False)
            cluster, seen, at, distance, measured = bounds.step(x, state[0], state[1].copy(), state[2].copy())
            far = kmeans.squared(x, history[now])
            assert (cluster == far.argmin(1)).all()
            known = distance >= 0
            assert (distance[known] == far.min(1)[known]).all()
            spared += (measured == 0).sum()
            seen, at = bounds.folded(cluster, seen, at, oldest)
            state = cluster, seen, at
            history = {i: c for i, c in history.items() if i >= oldest}
            assert at.min() >= min(history)
        assert spared > 0


def test_ties_repeats_and_unusable_rows(spark):
    same = [[1.0, 0.0], [1.0, 0.0], [-1.0, 0.0], [0.0, 0.0], [0.0, 0.0]]
    rows = rows_of(same, [1, 1, 2, 3, None])
    rows += rows_of(
        [None, [], [1.0], [1.0, None], [float("nan"), 0.0], [float("inf"), 0.0], [0.25, 0.51]],
        [11, 12, 13, 14, 15, 16, 17],
    )
    for k in (1, 2, 3, 50):
        check(spark, rows, k=k, rounds=2, dim=2)
    check(spark, rows, k=2, rounds=0, dim=2)


def test_empty_table_and_no_ids(spark):
    empty = spark.createDataFrame([], VEC)
    found = kmeans.cluster(empty, dim=2)
    assert found.members.count() == 0 and kmeans.described(found).count() == 0
    assert kmeans.cluster(spark.createDataFrame(rows_of([[1.0]], [None]), VEC), dim=1).members.count() == 0


def test_large_components_are_exact(spark):
    rows = rows_of([[2.0**22, 1.0], [2.0**22, 1.5], [-(2.0**22), 0.0], [2.0**22 + 1, 2.0]])
    check(spark, rows, k=2, rounds=2, dim=2)
