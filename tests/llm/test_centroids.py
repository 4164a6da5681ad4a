import hashlib
import math

import numpy as np
import pytest
from starforge.llm import centroids
from starforge.llm.centroids import Start


def brute(rows, dim, start):
    """All distances, in Python's integers."""
    fine = [(i, [int(math.floor(start.scale * float(x))) for x in v]) for i, v, *_ in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]

    def hashed(i):
        return hashlib.sha256(f"{start.seed}:{'' if i is None else i}".encode()).hexdigest()

    found = [v for _, v in sorted(((hashed(i), v) for i, v in fine))[: start.centroids]]

    def assigned():
        out = []
        for _, v in fine:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in found]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(start.rounds):
        of = assigned()
        for c in range(len(found)):
            own = [v for (_, v), (a, _) in zip(fine, of) if a == c]
            if own:
                found[c] = [sum(col) // len(own) for col in zip(*own)]
    return [(i, *a) for (i, _), a in zip(fine, assigned())], found


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, cluster int, distance string")


def some(n, dim, seed, step=None):
    rng = np.random.default_rng(seed)
    v = rng.standard_normal((n, dim))
    return [(k, (np.round(r * 2) / 2 if step else r).tolist()) for k, r in enumerate(v)]


ODD = [(900, None), (901, []), (902, [1.0]), (903, [float("nan")] * 6), (904, [None] * 6), (905, [float("-inf")] * 6), (None, [0.25] * 6), (3, [0.5] * 6), (3, [0.5] * 6)]


@pytest.mark.parametrize("rows, start", [
    (some(120, 6, 1) + ODD, Start()),
    (some(90, 6, 2, step=True) + ODD, Start(centroids=5, rounds=3, scale=2)),  # many ties
    ([(k, [0.5] * 6) for k in range(40)] + some(20, 6, 4), Start(rounds=2)),  # most vectors equal
    (some(4, 6, 3), Start()),  # fewer vectors than centroids
    ([(k, [1e300 if k % 3 else -3e14] * 6) for k in range(9)], Start(centroids=2, rounds=2)),  # beyond longs
])
def test_against_brute_force(spark, rows, start):
    got, found = centroids.clustered(table(spark, rows).repartition(3), dim=6, start=start)
    if any(math.isfinite(x) and abs(x) > 1e200 for _, v in rows if v for x in v if x is not None):
        # components stop at the largest long
        rows = [(i, [min(x, 2**63 / start.scale) for x in v]) for i, v in rows]
        want, centres = brute(rows, 6, start)
        limit = 2**63 - 1
        want = [(i, c, d if d <= limit else None) for i, c, d in want]
        assert sorted((r["vec_id"], r["cluster"]) for r in got.collect()) == sorted((i, c) for i, c, _ in want)
        return
    want, centres = brute(rows, 6, start)
    assert [list(map(int, c)) for c in found] == centres
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_zero_favours_the_smaller_number():
    centres = np.array([[4, 0], [0, 0], [0, 0], [0, 4], [-4, 0]])
    rows = np.array([[2, 0], [0, 0], [0, 2], [-2, 0], [4, 4], [-4, 4]])
    champion, distance = centroids.nearest(rows, centres)
    assert champion.tolist() == [0, 1, 1, 1, 0, 3] and distance.tolist() == [4, 0, 4, 4, 16, 16]


def test_large_numbers_stay_exact():
    big = 2**61
    champion, distance = centroids.nearest(np.array([[big, 1], [-big, 0]]), np.array([[big, 0], [big, 1], [-big, 5]]))
    assert champion.tolist() == [1, 2] and distance.tolist() == [0, 25]
    champion, distance = centroids.nearest(np.array([[big, 0]]), np.array([[-big, 0]]))
    assert distance.tolist() == [4 * big**2]


def test_inertia(spark):
    rows = some(50, 6, 5)
    got, found = centroids.clustered(table(spark, rows), dim=6, start=Start(centroids=3))
    out = centroids.with_inertia(got, found).collect()
    want, centres = brute(rows, 6, Start(centroids=3))
    for r in out:
        assert r["inertia"] == sum(d for *_, d in want)
        assert r["cluster_inertia"] == sum(d for _, c, d in want if c == r["cluster"])
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centres[r["cluster"]])).encode()).hexdigest()


def test_empty(spark):
    got, found = centroids.clustered(table(spark, ODD[:6]), dim=6)
    assert centroids.with_inertia(got, found).collect() == [] and not len(found)
