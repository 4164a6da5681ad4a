"""The pipeline on small tables, stage by stage against what each must have done."""

import re
from collections import Counter

import corpus_pipeline as pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from starforge.llm import mixing, queries, secrets
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.01"
DOCS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before the first stage and after each."""
    docs = queries.table(spark, SF, "documents")
    out = [docs.collect()]
    schema = docs.schema
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
        out.append(docs.collect())
        docs = spark.createDataFrame(out[-1], docs.schema if docs.columns != DOCS else schema)
    return out


def test_order_and_columns(stages):
    assert [name for name, _ in pipeline.STAGES] == ["quality", "near_duplicates", "secrets", "mixing", "tokens"]
    assert all(list(rows[0].asDict()) == DOCS for rows in stages[:-1])


def test_quality_keeps_good_documents_unchanged(spark, stages):
    labels = {r["doc_id"]: r["quality"] for r in queries.table(spark, SF, "labels").collect()}
    before, kept = set(stages[0]), set(stages[1])
    assert kept <= before and len(kept) < len(before)
    wrong = [r for r in before if labels.get(r["doc_id"]) == int(r not in kept)]
    assert len(wrong) <= 0.03 * len(labels)


def test_one_of_each_component_stays(spark, stages):
    from starforge.llm import simhash

    docs = spark.createDataFrame(stages[1], queries.table(spark, SF, "documents").schema)
    found = simhash.near_duplicates(docs).collect()
    assert Counter(r["doc_id"] for r in stages[2]) == Counter({r["component_id"] for r in found})
    assert set(stages[2]) <= set(stages[1])


def test_secrets_are_gone_and_the_rest_of_the_text_stays(stages):
    before = {r["doc_id"]: r for r in stages[2]}
    changed = 0
    for r in stages[3]:
        old = before[r["doc_id"]]
        assert not re.search(secrets.HEX, r["text"]) and not re.search("AKIA[A-Z0-9]{16,}", r["text"])
        if r["text"] != old["text"]:
            changed += 1
            rest = [re.escape(p) for p in r["text"].split("[SECRET]")]
            assert re.fullmatch("(.+)".join(rest), old["text"], re.DOTALL) and r["n_chars"] == len(r["text"])
        else:
            assert r == old
    assert len(stages[3]) == len(stages[2]) and changed


def test_mixing_takes_documents_to_their_epochs(spark, stages):
    docs = spark.createDataFrame(stages[3], queries.table(spark, SF, "documents").schema)
    mix = queries.production_mix()
    taken = mixing.mixed(docs.withColumn("domain", queries.domain_of(F.col("source"))), mix).collect()
    want = Counter()
    for r in taken:
        if r["tokens_taken"]:
            want[r["doc_id"]] = -(-r["tokens_taken"] // r["n_tokens"])
    assert Counter(r["doc_id"] for r in stages[4]) == want
    assert set(stages[4]) <= set(stages[3])


def test_tokens_are_those_of_the_library(stages):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r["doc_id"]: r["text"] for r in stages[4]}
    assert len(stages[5]) == len(stages[4])
    for r in stages[5]:
        assert r["ids"] == library.encode(texts[r["doc_id"]], add_special_tokens=False).ids and r["n_tokens"] == len(r["ids"])


def test_run_is_the_stages_in_turn(spark, stages):
    got = Counter((r["doc_id"], r["n_tokens"]) for r in pipeline.run(spark, SF).collect())
    assert got == Counter((r["doc_id"], r["n_tokens"]) for r in stages[5])


def test_odd_rows_pass(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "password=abcdef12", None, "a", 17)]
    schema = queries.table(spark, SF, "documents").schema
    for some in (rows, []):
        docs = spark.createDataFrame(some, schema)
        for _, stage in pipeline.STAGES[1:]:
            docs = spark.createDataFrame((out := stage(spark, docs, SF)).collect(), out.schema)
        assert docs.count() <= len(some)
