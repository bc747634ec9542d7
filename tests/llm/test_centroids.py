import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from farebox.llm.centroids import _roots, _squares, clustered, nearest
from vector_cases import edge_rows, frame, vector


def plain(rows, k=8, rounds=10, dim=64, scale=1024, salt=3):
    """The contract, one vector at a time."""
    kept = []
    for i, v in rows:
        v = None if v is None else [np.float32(x) if x is not None else None for x in v]
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(scale * float(x)) for x in v]))
    named = [(hashlib.sha256(f"{salt}:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None]
    centroids = [x for _, x in sorted(named)[:k]]

    def assigned(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        where = [assigned(x)[1] for _, x in kept]
        for j in range(len(centroids)):
            mine = [x for (_, x), at in zip(kept, where) if at == j]
            if mine:
                centroids[j] = [sum(c) // len(mine) for c in zip(*mine)]
    found = [(i, *assigned(x)) for i, x in kept]
    inertia = Counter()
    for _, d, j in found:
        inertia[j] += d
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((str(i), j, d, inertia[j], sum(inertia.values()), digests[j]) for i, d, j in found)


def got(frame_, **options):
    return sorted((str(r[0]), *r[1:]) for r in clustered(frame_, **options).collect())


def test_edges_against_plain_code(spark):
    rows = edge_rows()
    assert got(frame(spark, rows).repartition(5)) == plain(rows)


def test_more_centroids_other_shapes(spark):
    rows = [(i, vector(i, 5, spread=3.0)) for i in range(300)] + [(i, [0.5] * 5) for i in range(300, 340)]
    assert got(frame(spark, rows), k=20, rounds=4, dim=5, scale=64, salt=9) == plain(rows, 20, 4, 5, 64, 9)


def test_fewer_vectors_than_centroids_and_equal_vectors(spark):
    rows = [(i, vector(i)) for i in range(3)]
    assert got(frame(spark, rows)) == plain(rows)
    rows = [(i, vector(1)) for i in range(30)]
    found = got(frame(spark, rows))
    assert found == plain(rows) and {r[1] for r in found} == {0}


def test_no_vectors(spark):
    assert got(frame(spark, [])) == [] and got(frame(spark, [(1, None), (2, [1.0])])) == []
    assert clustered(frame(spark, [])).columns == clustered(frame(spark, [(1, vector(1))])).columns


def test_entries_beyond_the_range_of_an_exact_double(spark):
    rows = [(i, [3e9 * x for x in vector(i)]) for i in range(20)] + [(50, [1e30] * 64), (51, vector(1))]
    found = {r.vec_id: r for r in clustered(frame(spark, rows)).collect()}
    assert len(found) == 22 and found[51].distance is None or found[51].distance >= 0


@pytest.mark.parametrize("spread", [1, 1000, 1 << 40])
def test_bounds_leave_out_no_nearest_centroid(spread):
    rng = np.random.default_rng(spread)
    at = rng.integers(-spread, spread + 1, (12, 6))
    x = np.concatenate([at[rng.integers(0, 12, 400)] + rng.integers(-2, 3, (400, 6)), at])
    pivots = rng.integers(-spread, spread + 1, (6, 6))
    far = np.stack([_roots(_squares(x, p)) for p in pivots], axis=1)
    cluster, best, checked = nearest(x, far, at, pivots)
    for row, j, d in zip(x.tolist(), cluster, best):
        assert (d, j) == min((sum((a - b) ** 2 for a, b in zip(row, c)), i) for i, c in enumerate(at.tolist()))
    assert spread == 1 or checked < len(x) * 12 / 2
