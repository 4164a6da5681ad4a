import numpy as np
import pytest
from corpus_texts import docs_of, sentence  # noqa: F401
from starforge.llm import quality


def test_pairs_in_linear_time():
    rng = np.random.default_rng(2)
    m = quality.Machine(0.3, rng.normal(size=40), rng.normal(size=(40, 5)))
    numbers, values = np.array([3, 7, 20, 39]), rng.normal(size=4)
    pairs = sum(
        m.v[a] @ m.v[b] * x * y
        for i, (a, x) in enumerate(zip(numbers, values))
        for b, y in list(zip(numbers, values))[i + 1 :]
    )
    margin, _ = m.margin(numbers, values, np.array([0]))
    assert margin[0] == pytest.approx(0.3 + m.w[numbers] @ values + pairs)
    assert m.score(numbers, values) == pytest.approx(1 / (1 + np.exp(-margin[0])))


def test_gradient_descends_on_an_interaction():
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for _ in range(600):
        a, b = rng.integers(0, 2, 2)
        on = np.array([k for k, x in enumerate((a, b)) if x] + [2])
        rows.append((on, np.ones(len(on), dtype=np.float32)))
        labels.append(float(a != b))
    s = quality.Settings(buckets=3, epochs=60, batch=64)
    m = quality.fit(rows, np.array(labels), s)
    assert np.mean([(m.score(*r) > 0.5) == y for r, y in zip(rows, labels)]) == 1.0


@pytest.fixture(scope="module")
def machine(spark):
    docs = [(i, (sentence(i, 60) + ". ") if i % 3 else "x x x x " * 30) for i in range(240)]
    rows = [(i, t, len(t), 1, 2.0) for i, t in docs]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint, _y int, _n double")
    labels = [(i, int(i % 3 > 0)) for i, _ in docs] + [(None, 1), (500, None), (501, 1)]
    # what is held out is labelled wrongly, and must not matter
    held = {r[0] for r in table.where(quality.held_out()).select("doc_id").collect()}
    labels = [(i, 1 - q) if i in held else (i, q) for i, q in labels]
    return quality.train(table, spark.createDataFrame(labels, "doc_id bigint, quality int"))


def test_scores(docs_of, machine):
    pairs = [(1, sentence(900, 80) + "."), (2, "x x x x " * 40), (3, None), (4, ""), (None, " "), (1, sentence(900, 80) + ".")]
    pairs += [(6, sentence(901, 20_000))]
    rows = quality.scored(docs_of(pairs), machine).collect()
    by = {}
    for r in rows:
        assert 0 <= r["score"] <= 1
        by.setdefault(r["doc_id"], set()).add(r["score"])
    assert len(by[1]) == 1 and min(by[1]) > 0.7 and max(by[2]) < 0.3
    assert quality.scored(docs_of([]), machine).count() == 0


def test_held_out_is_a_crc(spark):
    from zlib import crc32

    rows = spark.range(300).withColumnRenamed("id", "doc_id").withColumn("h", quality.held_out()).collect()
    assert all(r["h"] == (crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)


def test_without_labels_of_both_kinds(spark, docs_of):
    docs = docs_of([(1, "a b"), (4, "c d")])
    for labels, want in (([], 1.0), ([(1, 1), (4, 1)], 1.0)):
        m = quality.train(docs, spark.createDataFrame(labels, "doc_id bigint, quality int"))
        assert [round(r["score"], 3) for r in quality.scored(docs, m).collect()] == [want] * 2
