"""Quoted CSV in splits, against Python's own reader."""

import csv
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starforge.sources import readers, records

SMALL = {"spark.sql.files.maxPartitionBytes": "128b", "spark.sql.files.openCostInBytes": "1b", "spark.sql.files.minPartitionNum": "64"}


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def texts(seed, n):
    rng = random.Random(seed)
    pieces = ["a", "b,", '"', '""', "\n", "\r\n", "ä", " ", "x" * 40, "\n\n", '",', ',"', "\n\"", "tail\n"]
    return ["".join(rng.choices(pieces, k=rng.randrange(9))) for _ in range(n)]


def wanted(path, width):
    with open(path, newline="", encoding="utf-8") as f:
        found = [r for r in csv.reader(f) if r][1:]
    return sorted(tuple(r) + ("",) * (width - len(r)) for r in found)


@pytest.mark.parametrize("seed, ending", [(1, "\n"), (2, "\r\n"), (3, "\n")])
def test_like_pythons_reader(spark, tmp_path, small_splits, seed, ending):
    path = tmp_path / "many lines+1.csv"
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=ending)
        w.writerow(["id", "a", "head\nline" if seed == 3 else "b"])
        some = texts(seed, 240)
        w.writerows([f"r{k}", some[2 * k], some[2 * k + 1]] for k in range(120))
    landed = readers.land_csv(spark, str(path), ["id", "a", "b"], F.lit(1), optional=())
    assert landed.rdd.getNumPartitions() > 8
    assert sorted(tuple(r) for r in landed.select("id", "a", "b").collect()) == wanted(path, 3)
    assert {r["source"] for r in landed.select("source").collect()} == {path.name}


def test_quotes_within_bare_fields_are_text(spark, tmp_path, small_splits):
    path = tmp_path / "bare.csv"
    lines = ["id,a,b"] + [f'{k},5" pipe{k},"x\n{k}, ""y"" 7"' for k in range(30)] + ['z,,6" end']
    path.write_text("\n".join(lines))
    landed = readers.land_csv(spark, str(path), ["id", "a", "b"], F.lit(1), optional=())
    assert sorted(tuple(r) for r in landed.select("id", "a", "b").collect()) == wanted(path, 3)


def test_a_record_over_many_splits(spark, tmp_path, small_splits):
    path = tmp_path / "long.csv"
    long = "\n".join(f"line {k}, with a ""comma" for k in range(200))
    path.write_text('id,a\n1,x\n2,"' + long + '"\n3,"' + long + '"\n4,y\n')
    got = readers.land_csv(spark, str(path), ["id", "a"], F.lit(1)).select("id", "a").collect()
    assert sorted(map(tuple, got)) == [("1", "x"), ("2", long), ("3", long), ("4", "y")]


def test_typed_and_null_fields(spark, tmp_path, small_splits):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("at", T.DateType()), T.StructField("t", T.StringType())])
    for part in range(3):
        (tmp_path / f"p{part}.csv").write_text(f'id,at,t\n{part},2024-01-0{part + 1},"a\nb"\n\n{part + 10},,\n')
    got = rows(readers.read_csv(spark, str(tmp_path), schema, line_breaks=True))
    assert [r[0] for r in got] == [0, 1, 10, 11, 12, 2] and {r[2] for r in got} == {"a\nb", None}
    (tmp_path / "bad.csv").write_text("id,at,t\nx,,\n")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        readers.read_csv(spark, str(tmp_path / "bad.csv"), schema, line_breaks=True).collect()


def test_files_without_records(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("id,a\n")
    assert records.csv_records(spark, str(tmp_path)).count() == 0


def test_steps_compose():
    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(50):
        steps, start = rng.integers(0, 4, 30), int(rng.integers(0, 2))
        state, want = start, []
        for s in steps:
            state = [state, 1 - state, 0, 1][s]
            want.append(state)
        assert records._after(steps, start).tolist() == want
