import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from starforge.functions.batches import text_parts
from starforge.operators import search
from starforge.operators import vectors as v

col = F.col


@pytest.fixture(scope="module")
def index(spark):
    rng = np.random.default_rng(1)
    data = rng.standard_normal((400, 16)).astype(np.float32)
    data[7] = data[3]  # equal vectors: the lower id wins
    return spark.createDataFrame(
        [(i, x.tolist(), i % 3) for i, x in enumerate(data)], "vec_id long, embedding array<float>, label int"
    ).repartition(6)


@pytest.fixture(scope="module")
def queries(spark):
    rng = np.random.default_rng(2)
    data = [(f"q{i}", rng.standard_normal(16).tolist()) for i in range(9)]
    return spark.createDataFrame(data, "query_id string, embedding array<double>")


def brute_force(index, queries, k, keep=lambda r: True):
    out = []
    candidates = [r for r in index.collect() if keep(r)]
    for q in queries.collect():
        b = np.array(q[1]) / np.linalg.norm(q[1])
        scored = []
        for r in candidates:
            a = np.array(r["embedding"], dtype=float)
            scored.append((-round(float(a @ b / np.linalg.norm(a)), 9), r["vec_id"]))
        out += [(q[0], i, n) for n, (_, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def test_golden_rows(spark):
    index = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.6, 0.8]), (4, [0.0, 0.0])], "vec_id long, embedding array<float>"
    )
    queries = spark.createDataFrame([(1, [2.0, 0.0])], "query_id int, embedding array<float>")
    hits = search.top_k_cosine(index, queries, 2).withColumn("score", F.round("score", 6))
    assert rows(hits, "query_id", "vec_id", "score", "rank") == [(1, 1, 1.0, 1), (1, 3, 0.6, 2)]
    assert search.top_k_cosine(index, queries, 9).count() == 3  # zeros have no direction
    assert search.top_k_cosine(index, queries.limit(0), 2).count() == 0


@pytest.mark.parametrize("broadcast, block, piece", [(1 << 20, 1 << 20, 1 << 20), (0, 1000, 3000), (1 << 20, 300, 1), (0, 1, 1 << 20)])
def test_exact_search_in_blocks(index, queries, monkeypatch, broadcast, block, piece):
    """Queries that are broadcast, and queries dealt to slices of the index; blocks down to one vector."""
    monkeypatch.setattr(search, "BROADCAST_BYTES", broadcast)
    monkeypatch.setattr(search, "BLOCK_BYTES", block)
    monkeypatch.setattr(search, "SLICE_BYTES", piece)
    monkeypatch.setattr(search, "HELD", 20 if block == 300 else 1 << 21)
    found = search.top_k_cosine(index, queries.repartition(3), 5)
    assert sorted(map(tuple, found.select("query_id", "vec_id", "rank").collect()), key=str) == brute_force(index, queries, 5)


def test_filter_comes_before_ranking(index, queries):
    found = search.top_k_cosine(index, queries, 5, where=col("label") == 2)
    want = brute_force(index, queries, 5, lambda r: r["label"] == 2)
    assert sorted(map(tuple, found.select("query_id", "vec_id", "rank").collect()), key=str) == want


def test_ties_go_to_the_lower_id(spark, index):
    same = index.where("vec_id = 3").select(F.lit(1).alias("query_id"), "embedding")
    assert [r["vec_id"] for r in search.top_k_cosine(index, same, 2).orderBy("rank").collect()] == [3, 7]


def test_queries_never_visit_the_driver(index, queries, monkeypatch):
    """Beyond the broadcast, the plan is a join of blocks by cell and slice, and no path collects vectors."""
    monkeypatch.setattr(search, "BROADCAST_BYTES", 0)
    plan = search.top_k_cosine(index, queries, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "slice" in plan and "broadcast" not in plan.lower()


def grouped(n, dim, groups, seed):
    """Vectors in groups, the shape of embeddings of real text."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, dim))
    return (centres[rng.integers(0, groups, n)] + 0.6 * rng.standard_normal((n, dim))).astype(np.float32)


@pytest.mark.parametrize("shape", ["groups", "noise"])
def test_trained_cells(spark, tmp_path, shape):
    """Nine of ten true hits while every query meets less than 30 % of the vectors; in clear groups, 5 %."""
    data = grouped(2000, 32, 40, 5) if shape == "groups" else np.random.default_rng(6).standard_normal((2000, 32)).astype(np.float32)
    index = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(data)], "vec_id long, embedding array<float>").repartition(5)
    queries = index.where("vec_id % 40 = 0").select((col("vec_id") + 0.5).alias("query_id"), "embedding")
    cells = search.CellIndex.build(index, str(tmp_path / "cells"))
    share = 0.05 if shape == "groups" else 0.28
    probes = cells.probes(queries, 5, share)
    found, exact = cells.search(probes, 5), search.top_k_cosine(index, queries, 5)
    assert search.recall(found, exact).first()[0] >= 0.9
    read = [r["share"] for r in cells.compared(probes).collect()]
    assert len(read) == 50 and max(read) < 0.3 and max(read) <= share
    both = found.join(exact, ["query_id", "vec_id"]).select((found["score"] - exact["score"]).alias("d"))
    assert all(abs(r["d"]) < 1e-12 for r in both.collect())


def test_a_search_opens_the_probed_cells_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(search, "PER_FOLDER", 1)
    data = grouped(600, 16, 12, 7)
    index = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(data)], "vec_id long, embedding array<float>")
    cells = search.CellIndex.build(index, str(tmp_path / "cells"), cells=30)
    one = index.where("vec_id = 0").select(F.lit(1).alias("query_id"), "embedding")
    probes = cells.probes(one, 5, 0.1)
    probed = probes.first()["cells"]
    read = cells.vectors().where(col("cell").isin(probed))
    scan = cells.search(probes, 5)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*folder", scan)
    folders = [f for f in (tmp_path / "cells" / "vectors").iterdir() if f.name.startswith("folder=")]
    assert len(folders) == cells.vectors().select("cell").distinct().count() > 20
    assert cells.compared(probes).first()["compared"] == read.count() <= 60


@pytest.mark.parametrize("broadcast", [0, 1 << 20])
def test_all_cells_give_the_exact_hits(spark, index, queries, tmp_path, monkeypatch, broadcast):
    monkeypatch.setattr(search, "BROADCAST_BYTES", broadcast)
    monkeypatch.setattr(search, "SLICE_BYTES", 2000)
    cells = search.CellIndex.build(index, str(tmp_path / "cells"), cells=9)
    full = cells.top_k(queries, 5, share=1.0)
    assert rows(full, "query_id", "vec_id", "rank") == rows(search.top_k_cosine(index, queries, 5), "query_id", "vec_id", "rank")


def test_cells_of_equal_zero_and_null_vectors(spark, tmp_path):
    """A third of the rows share a vector; zeros and nulls are no hits; a query gets k vectors at least."""
    same = [(i, [1.0, 0.0]) for i in range(40)] + [(100 + i, [float(i), 1.0]) for i in range(60)] + [(300, [0.0, 0.0]), (301, None)]
    index = spark.createDataFrame(same, "vec_id long, embedding array<float>")
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "query_id int, embedding array<float>")
    cells = search.CellIndex.build(index, str(tmp_path / "cells"))
    hits = cells.top_k(queries, 45, share=0.01).orderBy("rank").collect()
    assert [r["vec_id"] for r in hits[:40]] == list(range(40)) and len(hits) == 45 and {r["query_id"] for r in hits} == {1}


def test_cells_of_an_empty_index(spark, tmp_path):
    index = spark.createDataFrame([], "vec_id long, embedding array<float>")
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, embedding array<float>")
    assert search.CellIndex.build(index, str(tmp_path / "cells")).top_k(queries, 3).collect() == []
    assert search.top_k_cosine(index, queries, 3).collect() == []


def test_training_holds_small_products_and_passes_on_few_cells(spark):
    """The memory of a task does not follow its vectors times the cells."""
    rng = np.random.default_rng(4)
    known = search.unit_rows(rng.standard_normal((4096, 8)))
    data = rng.standard_normal((6000, 8))
    tracemalloc.start()
    cell = search.nearest(data, known)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 << 20
    assert cell.tolist() == np.argmax(search.unit_rows(data) @ known.T, axis=1).tolist()

    class Shared:
        value = known

    lists = pa.ListArray.from_arrays(np.arange(6001, dtype=np.int32) * 8, pa.array(data.ravel()))
    parts = list(search._cell_sums(Shared, "embedding")(iter([pa.RecordBatch.from_arrays([lists], ["embedding"])])))
    assert max(p.num_rows for p in parts) <= search.SUMS < sum(p.num_rows for p in parts)
    sums = {c: (n, t) for p in parts for c, n, t in zip(*(p.column(k).to_pylist() for k in ("cell", "n", "total")))}
    assert sorted(sums) == np.unique(cell).tolist()
    for c, (n, total) in sums.items():
        own = search.unit_rows(data[cell == c])
        assert n == len(own) and total == pytest.approx(own.sum(axis=0).tolist())


def test_vectors_of_another_length_are_an_error(spark, queries):
    odd = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [1.0])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="numbers, not"):
        search.top_k_cosine(odd, queries, 2).collect()


def test_embedding_and_index_update(spark):
    df = spark.createDataFrame([("a-0", "payment failed"), ("a-1", "Payment FAILED"), ("b-0", "other words")], "chunk_id string, text string")
    embedded = v.embed(df, "text")
    e = {r["chunk_id"]: np.array(r["embedding"]) for r in embedded.collect()}
    assert e["a-0"].shape == (384,) and abs(np.linalg.norm(e["a-0"]) - 1) < 1e-6
    assert np.allclose(e["a-0"], e["a-1"]) and not np.allclose(e["a-0"], e["b-0"])
    old = embedded.where("chunk_id = 'a-0'").withColumn("text", F.lit("old"))
    merged = v.update_index(old, embedded)
    assert rows(merged, "chunk_id", "text") == [("a-0", "payment failed"), ("a-1", "Payment FAILED"), ("b-0", "other words")]


def test_encoders_and_chunks_work_in_bounded_parts(spark):
    """A batch of many or long texts is not encoded at once."""

    def encoder():
        def encode(texts):
            if len(texts) > 512 or sum(len(t) for t in texts) > 1 << 20 and len(texts) > 1:
                raise ValueError(f"{len(texts)} texts at once")
            return np.array([[len(t), 1.0] for t in texts])

        return encode

    texts = ["a" * (n % 7) for n in range(3000)] + ["b" * 700_000, None, "c" * 700_000, "d" * 1_500_000]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string").coalesce(1)
    found = {r["n"]: r["embedding"] for r in v.embed(df, "text", encoder).select("n", "embedding").collect()}
    assert len(found) == len(texts)
    for n, t in enumerate(texts):
        assert found[n] == pytest.approx(search.unit_rows(np.array([[len(t or ""), 1.0]]))[0], rel=1e-6)


def test_parts_of_batches():
    parts = list(text_parts([pa.array(["aa", None, "b", "cccccc", "d"]), pa.array([], pa.string()), pa.array(["e"])], rows=2, size=4))
    assert parts == [["aa", None], ["b"], ["cccccc"], ["d"], ["e"]]


def test_context(spark):
    queries = spark.createDataFrame([(1,), (2,)], "query_id int")
    hits = spark.createDataFrame(
        [(1, 2, "9", "billing", "second", None, 0.51239), (1, 1, "8", "login", "first", "reset it", 0.9)],
        "query_id int, rank int, ticket_id string, category string, text string, response string, score double",
    )
    got = dict(v.build_context(queries, hits).collect())
    assert got[1] == (
        "[Ticket #8 | category=login]\nQ: first\nResolution: reset it\n\n[Ticket #9 | category=billing]\nQ: second"
    )
    assert got[2] == "No related tickets were found."
    assert rows(v.sources(hits), "score", "response") == [(0.5124, ""), (0.9, "reset it")]


def test_questions_find_their_ticket(spark):
    from starforge.operators import text

    tickets = spark.createDataFrame(
        [
            ("1", "Login", "I cannot log in with my password.", "account", "Reset the password."),
            ("2", "Invoice", "The invoice shows the wrong amount.", "billing", None),
            ("3", "Export", "The export of the report never ends.", "reports", None),
        ],
        "ticket_id string, subject string, body string, category string, response string",
    )
    chunks = text.ticket_chunks(tickets)
    index = v.build_index(chunks)
    asked = spark.createDataFrame([(1, "wrong invoice amount"), (2, "password for log in")], "query_id int, text string")
    queries = v.embed(asked, "text")
    hits = v.with_text(search.top_k_cosine(index, queries, 1, id_="chunk_id"), chunks)
    assert rows(hits, "query_id", "ticket_id") == [(1, "2"), (2, "1")]
    assert "Resolution: Reset the password." in dict(v.build_context(queries, hits).collect())[2]
    billing = search.top_k_cosine(index, queries, 3, id_="chunk_id", where=col("category") == "billing")
    assert rows(billing, "query_id", "chunk_id") == [(1, "2-0"), (2, "2-0")]


def test_an_edit_embeds_only_new_texts(spark):
    from starforge.session import scratch_path
    from starforge.sources.tables import Table

    def picky():
        """An encoder that must not see a text the index knows."""
        encode = v.hashing_encoder(32)

        def only_new(texts):
            if any("old" in t for t in texts):
                raise ValueError(texts)
            return encode(texts)

        return only_new

    schema = "chunk_id string, ticket_id int, text string"
    before = [("1-0", 1, "old a"), ("1-1", 1, "old b"), ("1-2", 1, "old c"), ("2-0", 2, "old a"), ("3-0", 3, "old d"), ("4-0", 4, None)]
    # a chunk is inserted into ticket 1, ticket 3 loses its text, ticket 5 is new and ticket 2 is not part of the edit
    edit = [("1-0", 1, "old a"), ("1-1", 1, "fresh x"), ("1-2", 1, "old b"), ("1-3", 1, "old c"), ("5-0", 5, "fresh x"), ("4-0", 4, "fresh y")]
    table = Table(spark, scratch_path(spark, "index"), rewrite_share=9.0)
    table.overwrite(v.build_index(spark.createDataFrame(before, schema), lambda: v.hashing_encoder(32)))
    parents = spark.createDataFrame([(1,), (3,), (4,), (5,)], "ticket_id int")
    changed, gone = v.index_changes(table.read(), spark.createDataFrame(edit, schema), parents, picky)
    assert rows(changed, "chunk_id") == [("1-1",), ("1-2",), ("1-3",), ("4-0",), ("5-0",)] and rows(gone) == [("3-0",)]
    changed = spark.createDataFrame(changed.collect(), changed.schema)
    gone = spark.createDataFrame(gone.collect(), gone.schema)
    table.upsert(changed, ["chunk_id"], ["ticket_id", "content", "embedding"], ["ticket_id"])
    table.delete(gone, ["chunk_id"])
    whole = [r for r in before if r[1] == 2] + edit
    want = v.build_index(spark.createDataFrame(whole, schema), lambda: v.hashing_encoder(32))
    assert rows(table.read().select(*want.columns)) == rows(want)
