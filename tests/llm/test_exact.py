import hashlib
from collections import defaultdict

import pytest
from corpus_texts import docs_of, sentence  # noqa: F401
from starforge.llm import exact

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute(pairs, best=max):
    groups = defaultdict(list)
    for i, t in pairs:
        groups[(t or "").translate(UPPER)].append(i)
    out = []
    for i, t in pairs:
        text = (t or "").translate(UPPER)
        keep = best(groups[text])
        out.append((i, keep, len(groups[text]), i == keep, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out)


PAIRS = (
    [(k, sentence(k % 40, 1 + k % 7)) for k in range(200)]
    + [(1000 + k, "Copied by a third of all ROWS" if k % 2 else "copied by a third of all rows") for k in range(150)]
    + [(2000, None), (2001, ""), (2002, " "), (2003, "ÄPFEL"), (2004, "äpfel"), (2005, "Äpfel"), (2006, "İ"), (2007, "i̇")]
    + [(3000, "Lang " * 300_000), (3001, "lang " * 300_000)]
)


@pytest.mark.parametrize("partitions, fan", [(1, 8), (7, 2), (30, 4)])
def test_against_brute_force(spark, docs_of, partitions, fan):
    docs = docs_of(PAIRS).repartition(partitions)
    assert sorted(map(tuple, exact.duplicates(docs, fan=fan).collect())) == brute(PAIRS)


def test_the_smallest_id_may_stay(spark, docs_of):
    got = exact.duplicates(docs_of(PAIRS).repartition(5), keep="smallest").collect()
    assert sorted(map(tuple, got)) == brute(PAIRS, min)
    with pytest.raises(ValueError):
        exact.duplicates(docs_of(PAIRS), keep="newest")


def test_repeated_rows_and_null_ids_keep_one_row(spark, docs_of):
    got = exact.duplicates(docs_of([(5, "a"), (5, "A"), (None, "a"), (None, "b"), (None, "b")]).repartition(3)).collect()
    of_a = [r for r in got if r["text_sha256"] == hashlib.sha256(b"a").hexdigest()]
    of_b = [r for r in got if r not in of_a]
    assert [(r["keep_id"], r["group_size"]) for r in of_a] == [(5, 3)] * 3 and sum(r["kept"] for r in of_a) == 1
    assert [(r["keep_id"], r["group_size"]) for r in of_b] == [(None, 2)] * 2 and sum(r["kept"] for r in of_b) == 1


def test_equal_short_digests_are_verified(spark):
    """Entries of one short digest are one only if the other digest and the length agree."""
    from pyspark.sql import functions as F

    rows = [(0, 7, b"x", 1, 10, 1), (1, 7, b"x", 1, 12, 2), (2, 7, b"y", 1, 11, 1), (3, 7, b"x", 2, 13, 1)]
    runs = spark.createDataFrame(rows, "cell int, digest long, proof binary, size int, best int, n long")
    got = exact.tree_merged(runs, 2, 2, F.max).collect()
    assert sorted((bytes(r["proof"]), r["size"], r["best"], r["n"]) for r in got) == [(b"x", 1, 12, 3), (b"x", 2, 13, 1), (b"y", 1, 11, 1)]


def test_a_round_takes_few_entries_of_a_hot_text(spark, docs_of):
    """After every round a text is in as many cells as there are runs left, divided by the width."""
    from pyspark.sql import functions as F

    rows = spark.range(0, 4000, 1, 16).select((F.col("id") % 16).cast("int").alias("cell"), F.lit(5).cast("long").alias("digest"))
    rows = rows.select("cell", "digest", F.lit(b"p").alias("proof"), F.lit(1).alias("size"), F.lit(1).alias("best"), F.lit(1).cast("long").alias("n"))
    runs = exact._merged(rows, 16, F.max)
    assert runs.count() == 16
    for rounds, left in ((1, 4), (2, 1)):
        merged = exact.tree_merged(runs, rounds, 4, F.max) if rounds == 2 else exact._merged(
            runs.withColumn("cell", F.pmod("digest", F.lit(4)) + F.col("cell") - F.col("cell") % 4), 16, F.max
        )
        assert (merged.count(), merged.agg(F.sum("n")).first()[0]) == (left, 4000)


def test_rounds():
    assert [exact.rounds_of(n) for n in (1, 8, 12, 64, 211, 20_000)] == [(1, 2), (1, 8), (2, 4), (2, 8), (3, 6), (5, 8)]


def test_one_exchange_a_round_and_no_python(spark, docs_of):
    plan = exact.duplicates(docs_of(PAIRS), fan=2)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("shufflepartitionidpassthrough") >= 3


def test_empty(spark, docs_of):
    assert exact.duplicates(docs_of([])).collect() == []
