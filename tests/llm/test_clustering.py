import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from modelvigil.llm import clustering
from tests.llm.test_vectors import odd_rows, vectors


def brute(rows, width, k, rounds, salt=2, scale=256):
    kept = [
        (i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows
        if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)
    ]
    name = lambda i: "~" if i is None else hashlib.sha256(f"{salt}:{i}".encode()).hexdigest()
    centroids = [t for _, t in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def assigned():
        out = []
        for _, t in kept:
            out.append(min((sum((a - b) ** 2 for a, b in zip(t, c)), n) for n, c in enumerate(centroids)))
        return out

    for _ in range(rounds):
        owners = [n for _, n in assigned()]
        for n in set(owners):
            own = [t for (_, t), o in zip(kept, owners) if o == n]
            centroids[n] = [sum(x) // len(own) for x in zip(*own)]
    found = assigned()
    by_cluster = {n: sum(d for d, m in found if m == n) for _, n in found}
    prints = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        ((i, n, d, by_cluster[n], sum(by_cluster.values()), prints[n]) for (i, _), (d, n) in zip(kept, found)), key=str
    )


def got(df, width, k, rounds, pivots=clustering.PIVOTS):
    found = clustering.cluster(clustering.scaled(df, width=width), k, rounds, pivots=pivots, width=width)
    return sorted(map(tuple, clustering.with_inertia(found).collect()), key=str), found


def test_odd_rows_ties_and_no_rows(spark):
    rows = odd_rows() + [(None, [1.0, 2.0]), (7, [0.25, 0.25]), (8, [0.75, 0.25]), (9, [0.5, 0.0]), (9, [0.5, 0.5])]
    df = vectors(spark, rows)
    for k in (1, 3, 50):  # 50: more centroids than vectors, and equal ones
        assert got(df, 2, k, 4, pivots=2)[0] == brute(rows, 2, k, 4)
    assert got(vectors(spark, []), 2, 3, 4)[0] == []
    assert got(vectors(spark, [(1, [1.0]), (2, None)]), 2, 3, 4)[0] == []


def test_clusters_are_pruned_and_exact(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 6)) * 4
    rows = [(i, (centres[i % 8] + rng.normal(size=6) / 8).tolist()) for i in range(400)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    mine, found = got(vectors(spark, rows), 6, 12, 5, pivots=12)
    assert mine == brute(rows, 6, 12, 5)
    assert found.computed < 0.5 * 400 * 12 * 5


def test_large_components(spark):
    rows = [(i, [float(np.float32(x)) for x in np.random.default_rng(i).normal(size=4) * 1e5]) for i in range(60)]
    assert got(vectors(spark, rows), 4, 5, 3)[0] == brute(rows, 4, 5, 3)
    far = got(vectors(spark, [(1, [3e38, 1.0]), (2, [-3e38, 1.0]), (3, [0.0, 0.0])]), 2, 2, 2)[0]
    assert [r[0] for r in far] == [1, 2, 3] and all(r[2] >= 0 for r in far)


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_bounds_never_exceed_distances(data):
    numbers = st.integers(-40, 40) | st.integers(-100_000, 100_000)
    width = data.draw(st.integers(1, 4))
    table = lambda least: np.array(
        data.draw(st.lists(st.lists(numbers, min_size=width, max_size=width), min_size=least, max_size=9)), dtype=np.int64
    )
    rows, points, pivots = table(1), table(1), clustering.Pivots(table(1))
    known, other = pivots.distances(rows), pivots.distances(points)
    exact = ((rows[:, None] - points[None]) ** 2).sum(2)
    assert (clustering.squared_distances(rows, points) == exact).all()
    assert (pivots.bounds(known, other) <= np.sqrt(exact.astype(float))).all()
    chosen, distance, _ = clustering.nearest(rows, known, points, other, pivots)
    assert (chosen == exact.argmin(1)).all() and (distance == exact.min(1)).all()


@pytest.mark.parametrize("pivots", [1, 40])
def test_pivots_change_no_result(spark, pivots):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").limit(200)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert got(df, 64, 40, 2, pivots)[0] == brute(rows, 64, 40, 2)
