import random

import numpy as np
import pytest
from starforge.llm import substrings
from starforge.llm.fmindex import FmIndex, WaveletMatrix

from corpus_texts import docs_of, sentence  # noqa: F401


def brute(pairs, window):
    """Kept words per row, by comparing all windows."""
    first = {}
    for i, t in pairs:
        w = (t or "").split() if i is not None else []
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, t in pairs:
        w = (t or "").split()
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            f = first.get(tuple(w[k : k + window]))
            if i is not None and f is not None and f < i:
                gone[k : k + window] = [True] * window
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=str)


def result(docs, window):
    return sorted(map(tuple, substrings.without_repeats(docs, window=window).collect()), key=str)


def test_wavelet_rank_is_a_count():
    symbols = np.random.default_rng(1).integers(0, 37, 500)
    matrix = WaveletMatrix(symbols, 37)
    at = np.arange(501)
    for s in range(37):
        assert matrix.rank(np.full(501, s), at).tolist() == [int((symbols[:i] == s).sum()) for i in at]


def test_index_finds_all_repeated_windows():
    rng = random.Random(4)
    sequences = [np.array([rng.randint(1, 3) for _ in range(rng.randint(4, 40))]) for _ in range(30)]
    index = FmIndex(np.concatenate(sequences), np.array([len(s) for s in sequences]), 4)
    at = np.concatenate([index.starts[i] + np.arange(len(s) - 3) for i, s in enumerate(sequences)])
    counts = {}
    for p in at:
        counts.setdefault(tuple(index.text[p : p + 4]), []).append(p)
    lane, low, high = index.matches(at, 4)
    got = {int(at[k]): sorted(index.order[a:b].tolist()) for k, a, b in zip(lane, low, high)}
    assert got == {p: sorted(ps) for ps in counts.values() if len(ps) > 1 for p in ps}


@pytest.mark.parametrize("crowd, shard", [(1 << 24, 1 << 21), (100, 1), (1 << 24, 300)])
def test_same_as_brute_force(docs_of, monkeypatch, crowd, shard):
    monkeypatch.setattr(substrings, "CROWD_BYTES", crowd)
    monkeypatch.setattr(substrings, "SHARD_BYTES", shard)
    shared = sentence(1, 30)
    pairs = [(i, f"{sentence(i + 10, 9)} {shared if i % 3 else shared[:60]} {sentence(i + 50, 7 + i)}") for i in range(12)]
    pairs += [(40, pairs[3][1]), (41, pairs[3][1] + " x"), (42, "a " * 40), (43, "b a a " + "a " * 30)]
    pairs += [(5, shared), (44, None), (45, ""), (46, " \t\n"), (None, shared), (40, pairs[3][1]), (47, shared.replace(" ", " \n"))]
    assert result(docs_of(pairs), 5) == brute(pairs, 5)


def test_long_text_and_empty_table(docs_of):
    long = sentence(3, 30_000)
    pairs = [(1, long), (2, long[5000:] + " end"), (3, "short")]
    assert result(docs_of(pairs), 13) == brute(pairs, 13)
    assert result(docs_of([]), 13) == []


def test_shards_hold_whole_routes():
    import pyarrow as pa

    routes = [1, 1, 2, 3, 3, 3, 3, 4, 5, 5]
    for step in (1, 3, 10):
        parts = [routes[k : k + step] for k in range(0, 10, step)]
        batches = [pa.RecordBatch.from_arrays([pa.array(p), pa.array([b"x" * 9] * len(p))], ["route", "words"]) for p in parts]
        for size in (1, 40, 1000):
            substrings.SHARD_BYTES, before = size, substrings.SHARD_BYTES
            try:
                shards = [t.column("route").to_pylist() for t in substrings._shards(iter(batches))]
            finally:
                substrings.SHARD_BYTES = before
            assert sum(shards, []) == routes
            assert all(a[-1] != b[0] for a, b in zip(shards, shards[1:]))
