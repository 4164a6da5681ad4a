import random

import pytest
from corpus_texts import docs_of, sentence  # noqa: F401
from pyspark.sql import functions as F
from starforge.llm import fingerprints as fp


def sketches(spark, texts, **k):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return {r["i"]: r["s"] for r in rows.select("i", fp.sketch(F.col("t"), **k).alias("s")).collect()}


def shingles(text, n=5):
    w = (text or "").split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def test_sketch_keeps_the_hashes_below_the_fraction(spark):
    text = sentence(1, 400)
    all_, part = (sketches(spark, [text], one_in=k)[0] for k in (1, 8))
    assert len(all_) == len(shingles(text))
    limit = -(1 << 63) + (1 << 61)
    assert part == sorted(h for h in all_ if h < limit) and part


def test_small_and_empty_texts(spark):
    got = sketches(spark, ["one two", "one two ", " one\ttwo", "", None, " \n", "a b c d e f"])
    assert got[0] == got[1] == got[2] and len(got[0]) == 1
    assert got[3] == got[4] == got[5] == [] and len(got[6]) >= 1


def test_union_is_the_fingerprint_of_both(spark):
    a, b = sentence(1, 300), sentence(2, 7)
    rows = spark.createDataFrame([(a, b)], "a string, b string")
    both = rows.select(fp.merged(fp.sketch(F.col("a")), fp.sketch(F.col("b"))).alias("m")).first()["m"]
    limit = -(1 << 63) + (1 << 61)
    parts = sketches(spark, [a, b])
    assert set(both) == {h for s in parts.values() for h in s if h < limit}


def test_likeness_estimates_the_shingles(spark):
    rng = random.Random(5)
    pairs = []
    for k in range(30):
        w = sentence(k, 1500).split()
        cut = rng.randint(1, 1400)
        pairs.append((k, " ".join(w), " ".join(w[:cut] + sentence(k + 99, 1500 - cut).split())))
    rows = spark.createDataFrame(pairs, "k int, a string, b string").select(
        "k", fp.resemblance(fp.sketch(F.col("a")), fp.sketch(F.col("b"))).alias("r"),
        fp.containment(fp.sketch(F.col("a")), fp.sketch(F.col("b"))).alias("c"),
    )
    for r in rows.collect():
        a, b = (shingles(t) for t in pairs[r["k"]][1:])
        assert r["r"] == pytest.approx(len(a & b) / len(a | b), abs=0.15)
        assert r["c"] == pytest.approx(len(a & b) / len(a), abs=0.15)


def brute(pairs):
    """Edited texts: last half from the next document by descending id, null ids last."""
    rows = sorted(((i is not None, i or 0, t or "") for i, t in pairs), key=lambda r: (r[0], r[1]), reverse=True)
    out = []
    for k, (known, i, t) in enumerate(rows):
        other = rows[(k + 1) % len(rows)][2]
        n = len(t)
        out.append((i if known else None, n, t[: n - n // 2] + other[: n // 2]))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [256, 2, 1])
def test_edited_texts(docs_of, monkeypatch, block):
    monkeypatch.setattr(fp, "BLOCK", block)
    pairs = [(i * 7 % 23, f"é日{i} " + sentence(i, i % 6 * 9)) for i in range(23)]
    pairs += [(50, None), (51, ""), (52, sentence(1, 20_000)), (None, "without an id")]
    rows = fp.compared_with_edits(docs_of(pairs)).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited"]) for r in rows), key=str) == brute(pairs)


def test_repeated_rows_follow_each_other(docs_of):
    rows = fp.compared_with_edits(docs_of([(1, "abcd"), (2, "wxyz"), (2, "wxyz"), (2, "wxyz")])).collect()
    assert sorted((r["doc_id"], r["edited"]) for r in rows) == [(1, "abwx"), (2, "wxab"), (2, "wxwx"), (2, "wxwx")]
    assert [r["edited"] for r in fp.compared_with_edits(docs_of([(1, "abcd")])).collect()] == ["abab"]
    assert fp.compared_with_edits(docs_of([])).count() == 0
