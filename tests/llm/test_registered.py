"""Every registered query runs over the smallest tables and gives a row per input row."""

import pytest
from conftest import SF
from starforge.llm import queries

TABLES = {"op4_urls": "pages", "op9_embeddings": "embeddings", "op11_whitening": "embeddings", "op12_centroids": "embeddings"}
# rows of the result for a row of the table
TIMES = {"op11_whitening": 4}


def test_all_and_the_pipeline_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert set(queries.CHECK_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("key", list(queries.QUERIES))
def test_a_row_per_row(spark, key):
    n = queries.table(spark, SF, TABLES.get(key, "documents")).count()
    out = queries.QUERIES[key](spark, SF)
    assert out.count() == n * TIMES.get(key, 1) and len(set(out.columns)) == len(out.columns)


def test_the_rest_never_imports_this_subpackage():
    from pathlib import Path

    from conftest import ROOT

    for path in (Path(ROOT) / "starforge").rglob("*.py"):
        if "llm" not in path.parts:
            assert "starforge.llm" not in path.read_text(), path
