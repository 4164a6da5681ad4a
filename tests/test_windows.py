"""The spread form of every window function must equal Spark's own window."""

import random
import re

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from starforge.operators import windows as w
from starforge.operators.relational import order_by


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, many ties in the order column, and NULLs everywhere."""
    rnd = random.Random(5)
    data = []
    for i in range(3000):
        group = 0 if i % 3 == 0 else (None if i % 50 == 1 else rnd.randrange(20))
        order = None if rnd.random() < 0.02 else (7 if rnd.random() < 0.3 else rnd.randrange(60))
        value = None if rnd.random() < 0.1 else rnd.randrange(100)
        data.append((i, group, order, value))
    rnd.shuffle(data)
    return spark.createDataFrame(data, "id int, g int, o int, v int").repartition(5).cache()


def test_fixture_golden_rows(spark):
    fares = spark.createDataFrame(
        [("Ramesh", 1, 450), ("Ramesh", 2, 320), ("Ramesh", 3, 320), ("Anita", 1, 500), ("Anita", 2, 275)],
        "driver string, day int, fare int",
    )
    df = w.number_rows(fares, ["driver"], ["day"], "nr")
    df = w.running_sum(df, ["driver"], ["day"], "fare", "total")
    df = w.running_avg(df, ["driver"], ["day"], "fare", "avg")
    df = w.with_prev(df, ["driver"], ["day"], "fare", "prev")
    df = w.ranked(df, "-fare")
    got = rows(df, "driver", "day", "fare", "nr", "rnk", "dense_rnk", "total", "prev", "avg")
    assert got == [
        ("Anita", 1, 500, 1, 1, 1, 500, None, 500.0),
        ("Anita", 2, 275, 2, 5, 4, 775, 500, 387.5),
        ("Ramesh", 1, 450, 1, 2, 2, 450, None, 450.0),
        ("Ramesh", 2, 320, 2, 3, 3, 770, 450, 385.0),
        ("Ramesh", 3, 320, 3, 3, 3, 1090, 320, 1090 / 3),
    ]


@pytest.mark.parametrize("order", [["o", "id"], ["-o", "-id"]])
def test_number_rows(skewed, order):
    plain = skewed.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy(*order_by(*order))))
    assert rows(w.number_rows(skewed, ["g"], order, "n")) == rows(plain)


@pytest.mark.parametrize("order", [["o"], ["-o"]])
def test_running_shares_ties(skewed, order):
    win = Window.partitionBy("g").orderBy(*order_by(*order))
    plain = skewed.select("id", F.sum("v").over(win).alias("s"), F.count("v").over(win).alias("c"))
    spread = w.running(skewed, ["g"], order, {"s": F.sum("v"), "c": F.count("v")})
    assert rows(spread, "id", "s", "c") == rows(plain)


@pytest.mark.parametrize("step", [1, 3, -1, -2])
def test_neighbours(skewed, step):
    win = Window.partitionBy("g").orderBy(*order_by("o", "id"))
    f = F.lag("v", step) if step > 0 else F.lead("v", -step)
    plain = skewed.select("id", f.over(win).alias("p"))
    spread = w.with_neighbour(skewed, ["g"], ["o", "id"], "v", "p", step)
    assert rows(spread, "id", "p") == rows(plain)


@pytest.mark.parametrize("order", ["v", "-v"])
def test_ranks(skewed, order):
    win = Window.orderBy(*order_by(order))
    plain = skewed.select("id", F.rank().over(win).alias("r"), F.dense_rank().over(win).alias("d"))
    assert rows(w.ranked(skewed, order, "r", "d"), "id", "r", "d") == rows(plain)


def test_dense_key_is_gap_free(skewed):
    win = Window.orderBy(*order_by("-o", "id"))
    plain = skewed.select("id", F.row_number().over(win).alias("k"))
    assert rows(w.dense_key(skewed, ["-o", "id"], "k"), "id", "k") == rows(plain)
    assert {k - 7 for _, k in rows(w.dense_key(skewed, ["id"], "k", start=7), "id", "k")} == set(range(1, 3001))


def test_a_third_of_the_rows_spreads_over_tasks(skewed):
    placed = w.spread(skewed, ["g"], ["o", "id"])
    per_task = {r["_task"]: r["count"] for r in placed.where("g = 0").groupBy("_task").count().collect()}
    assert len(per_task) > 1 and sum(per_task.values()) >= 1000


@pytest.mark.parametrize(
    "call",
    [
        lambda df: w.number_rows(df, ["g"], ["o", "id"], "n"),
        lambda df: w.dense_key(df, ["o", "id"], "n"),
        lambda df: w.ranked(df, "v"),
        lambda df: w.running_sum(df, ["g"], ["o"], "v", "n"),
        lambda df: w.with_prev(df, ["g"], ["o", "id"], "v", "n"),
    ],
)
def test_no_window_over_a_whole_group_of_rows(skewed, call):
    """Windows that are not cut by task work on one row, or a few, per task."""
    plan = call(skewed)._jdf.queryExecution().optimizedPlan().toString()
    for line in re.findall(r"Window \[[^\n]*", plan):
        if "_task" not in line.split("windowspecdefinition(", 1)[1].split("specifiedwindowframe")[0]:
            assert "_before" in line or "_across" in line or "_n" in line, line


def test_share_and_first_per(skewed):
    known = skewed.where("g IS NOT NULL")
    win = Window.partitionBy("g")
    plain = known.select("id", F.sum("v").over(win).alias("t"), F.count("*").over(win).alias("n"))
    assert rows(w.share_of_group(known, ["g"], "v"), "id", "group_total", "group_rows") == rows(plain)
    nr = F.row_number().over(Window.partitionBy("g").orderBy("id"))
    first = skewed.withColumn("n", nr).where("n = 1").drop("n")
    assert rows(w.first_per(skewed, "g", "id"), "id", "g") == rows(first, "id", "g")


def test_top_n_is_cut_before_the_shuffle(skewed):
    plan = w.top_n_per(skewed, ["g"], ["o", "id"], 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_deep_pages_cover_every_row_once(spark, monkeypatch):
    """Ties, a value that a third of the rows share, and rows repeated as a whole."""
    monkeypatch.setattr(w, "SHALLOW", 0)
    data = [(7 if i % 3 == 0 else i % 11, None if i % 17 == 0 else i % 5, i if i % 4 else 0) for i in range(600)]
    df = spark.createDataFrame(data, "a int, b int, c int").repartition(5)
    pages = [[tuple(r) for r in w.page(df, ["-a", "b"], offset, 97).collect()] for offset in range(0, 600, 97)]
    flat = [r for p in pages for r in p]
    key = lambda r: (-r[0], r[1] is None, r[1] or 0)
    assert [key(r) for r in flat] == sorted(map(key, data))
    none_last = lambda r: tuple((v is None, v) for v in r)
    assert sorted(flat, key=none_last) == sorted(data, key=none_last)
    assert w.page(df, ["a"], 600, 5).collect() == [] and len(w.page(df, ["a"], 598, 50).collect()) == 2


def test_wide_rows_are_numbered_by_their_keys(spark):
    df = spark.range(300).select("id", (F.col("id") % 3).alias("g"), F.lit("x").alias("p"), F.lit("y").alias("q"), F.lit("z").alias("r"), F.lit(1).alias("s"))
    df = df.unionByName(spark.createDataFrame([(None, 0, "x", "y", "z", 1)], "id long, g long, p string, q string, r string, s int"))
    got = w.number_rows(df, ["g"], ["-id"], "n")
    assert got.columns == [*df.columns, "n"] and got.where("id is null").first()["n"] == 1
    assert rows(got.where("id is not null and g = 1"), "id", "n") == sorted(((i, (300 - i + 1) // 3) for i in range(1, 300, 3)), key=lambda t: tuple((False, str(v)) for v in t))
    keyed = w.dense_key(df, ["id"], "k", start=10)
    assert {r["k"] for r in keyed.collect()} == set(range(11, 312)) and keyed.where("k != id + 11").count() == 0


def test_many_rows_per_group(spark):
    """Beyond Spark's group limit no plan has a window over whole groups; the rows are the same."""
    rng = random.Random(12)
    data = [(1 if i % 3 else rng.randrange(5), rng.choice([None, 1, 2, 3, rng.randrange(999)]), i) for i in range(900)]
    df = spark.createDataFrame([*data, (None, 4, 1000), (None, 4, 1000)], "g int, o int, i int").repartition(4)
    before = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")
    want = {n: rows(w.top_n_per(df, ["g"], ["-o", "i"], n, "nr")) for n in (5, 100, 2000)}
    try:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "1")
        for n, expected in want.items():
            found = w.top_n_per(df, ["g"], ["-o", "i"], n, "nr")
            assert rows(found) == expected
            plan = found._jdf.queryExecution().optimizedPlan().toString()
            assert all("_pos" in line or "_tie" in line or "_task" in line for line in plan.splitlines() if "windowspecdefinition" in line)
    finally:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", before)
