import hashlib
import math

import numpy as np
import pytest

from citylake.llm import shallot as S
from citylake.llm.centroids import cluster_report
from tests.llm.helpers import with_extra


def slow(rows, k=40, rounds=5, dims=64):
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows
            if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    points = [list(v) for _, v in first]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, p)), j) for j, p in enumerate(points)) for _, v in kept]

    for _ in range(rounds):
        got = assign()
        for j in range(len(points)):
            mine = [v for (_, v), g in zip(kept, got) if g[1] == j]
            if mine:
                points[j] = [sum(c) // len(mine) for c in zip(*mine)]
    got = assign()
    each = {j: sum(d for d, c in got if c == j) for j in range(len(points))}
    return sorted((-1 if i is None else i, j, d, each[j], sum(each.values()), hashlib.sha256(",".join(map(str, points[j])).encode()).hexdigest())
                  for (i, _), (d, j) in zip(kept, got))


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def got(df):
    return sorted((-1 if r.vec_id is None else r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def test_against_a_slow_form(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 0.2, (6, 64))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 6] + rng.normal(0, 0.1, 64)]) for i in range(300)]
    rows += [(1000, None), (1001, [0.5] * 63), (1002, [0.5] * 63 + [None]), (1003, [0.5] * 63 + [float("nan")]), (1004, [0.5] * 63 + [float("inf")]),
             (1005, []), (1006, [1000.0] * 64), (1007, [-1000.0] * 64), (None, [0.25] * 64)]
    rows += rows[:5] + [(2000 + i, [0.125] * 64) for i in range(40)]  # repeated rows, equal vectors (equal first centroids)
    assert got(cluster_report(with_extra(frame(spark, rows).repartition(3)))) == slow(rows)


def test_small_and_empty_tables(spark):
    assert cluster_report(frame(spark, [])).count() == 0
    assert cluster_report(frame(spark, [(1, None), (2, [1.0])])).count() == 0
    for n in (1, 2, 5):
        rows = [(i, [i / 4.0] * 64) for i in range(n)]
        assert got(cluster_report(frame(spark, rows))) == slow(rows)


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="too large"):
        cluster_report(frame(spark, [(1, [1e30] * 64)])).collect()


def test_search_by_bounds_equals_all_distances():
    rng = np.random.default_rng(1)
    for grid in (2, 40):  # a coarse grid gives many ties
        x = rng.integers(-grid, grid, (4000, 4))
        points = rng.integers(-grid, grid, (30, 4))
        state = S.begin(len(x))
        searched = []
        for _ in range(8):
            state, n = S.search(x, state, S.Centroids(points))
            searched.append(n)
            every = ((x[:, None] - points[None]) ** 2).sum(2)
            assert (state[0] == every.argmin(1)).all()
            assert (S.distances(x, state[0], S.Centroids(points)) == every.min(1)).all()
            two = np.sort(every, axis=1)[:, 1]
            assert (np.sqrt(two) >= state[3] - 1e-9).all() and (np.sqrt(every.min(1)) <= state[2] + 1e-6).all()
            new = np.array([x[state[0] == j].sum(0) // max((state[0] == j).sum(), 1) if (state[0] == j).any() else points[j] for j in range(30)])
            state = S.drift(state, S.moved(points, new))
            points = new
        assert searched[-1] < searched[0] or grid == 2
