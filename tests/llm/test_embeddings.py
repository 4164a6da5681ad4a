import numpy as np
from starforge.llm import embeddings


def brute(rows, least):
    n = len(rows)
    links = {k: set() for k in range(n)}
    vectors = [None if v is None or any(x is None for x in v) else np.array(v, dtype=np.float32).astype(np.float64) for _, v, _ in rows]
    fine = [v is not None and np.isfinite(v).all() and v.any() and r[2] is not None and r[0] is not None for v, r in zip(vectors, rows)]
    for a in range(n):
        for b in range(a):
            if fine[a] and fine[b] and rows[a][2] == rows[b][2] and len(vectors[a]) == len(vectors[b]):
                u, v = vectors[a], vectors[b]
                if u @ v / (np.linalg.norm(u) * np.linalg.norm(v)) >= least:
                    links[a].add(b)
                    links[b].add(a)
    out = []
    for k in range(n):
        seen, todo = {k}, [k]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo.extend(new)
        ids = [rows[s][0] for s in seen if rows[s][0] is not None]
        root = min(ids) if ids else None
        out.append((rows[k][0], len(links[k]), root, rows[k][0] == root))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, cid string")


def test_hadamard_keeps_lengths():
    rows = np.random.default_rng(1).standard_normal((5, 32))
    out = embeddings.hadamard(rows.copy()) / np.sqrt(32)
    assert np.allclose(np.linalg.norm(out, axis=1), np.linalg.norm(rows, axis=1))
    assert np.allclose(embeddings.hadamard(out) / np.sqrt(32), rows)


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for c in range(25):
        centre = rng.standard_normal(48)
        for k in range(8):
            v = centre + rng.standard_normal(48) * rng.choice([0.05, 0.2, 0.4])
            rows.append((len(rows), v.tolist(), int(c % 3)))
    rows += [(900, rows[5][1], rows[5][2]), (901, rows[5][1], 7), (902, rows[5][1], None), (903, None, 1), (904, [0.0] * 48, 1)]
    rows += [(905, [float("nan")] * 48, 1), (906, [float("inf")] + [0.0] * 47, 1), (907, [None] * 48, 1), (908, [1.0], 1), (909, [2.0], 1)]
    rows += [(910, [], 1), (5, rows[5][1], rows[5][2]), (None, rows[5][1], 1), (911, (np.array(rows[9][1]) * 2).tolist(), rows[9][2])]
    for block in (512, 4):
        got = embeddings.near_duplicates(table(spark, rows), least=0.93, block=block).collect()
        assert sorted(map(tuple, got), key=str) == [(a, b, c, d) for a, b, c, d in brute(rows, 0.93)]


def test_empty(spark):
    assert embeddings.near_duplicates(table(spark, [])).collect() == []
