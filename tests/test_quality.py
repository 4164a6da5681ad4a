import pytest
from conftest import rows
from pyspark.sql import functions as F

from starforge.operators import quality as q

col = F.col


def ride(spark):
    return spark.createDataFrame(
        [(1, 5, "completed", 10), (2, -1, "completed", None), (2, None, "paid", None)],
        "id int, fare int, status string, minutes int",
    )


def test_rules_in_one_pass(spark):
    rules = [
        q.min_rows(5),
        q.non_negative("fare"),
        q.not_null("fare"),
        q.required_when("minutes", col("status") == "completed", "completed_have_duration"),
        q.accepted("status", ["completed", "cancelled"]),
        q.no_rows("fare_small", "fare > 4"),
    ]
    assert [tuple(r) for r in q.run_rules(ride(spark), rules).collect()] == [
        ("row_count", False, 2), ("non_negative_fare", False, 1), ("not_null_fare", False, 1),
        ("completed_have_duration", False, 1), ("accepted_values_status", False, 1), ("fare_small", False, 1),
    ]
    plan = q.run_rules(ride(spark), rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange SinglePartition") == 1


def test_keys_and_references(spark):
    df = spark.createDataFrame([(1, True), (1, False), (2, True), (None, True), (None, True)], "k int, open boolean")
    assert q.unique(df, ["k"]).first()["n_bad"] == 1
    assert q.unique(df, ["k"], col("open")).first()["n_bad"] == 0
    parent = spark.createDataFrame([(1,)], "id int")
    assert tuple(q.relationship(df, "k", parent, "id").first()) == ("relationships_k", False, 1)


def test_gate(spark):
    with pytest.raises(q.DataQualityError, match="non_negative_fare: 1 of 3"):
        q.gate(ride(spark), [q.min_rows(1), q.non_negative("fare"), q.not_null("fare")])
    summary = q.gate(ride(spark), [q.min_rows(1), q.not_null("id")])
    assert summary["row_count"] == 3 and summary["passed"]
    with pytest.raises(q.DataQualityError, match="row_count"):
        q.gate(ride(spark).limit(0), [q.min_rows(1)])


def test_split_keeps_the_record(spark):
    valid, rejected = q.split_valid(ride(spark), [("no_fare", col("fare").isNull()), ("paid", col("status") == "paid")])
    assert rows(valid, "fare") == [(-1,), (5,)]
    assert rows(rejected) == [("no_fare", '{"id":2,"fare":null,"status":"paid","minutes":null}')]


def test_the_suite_has_all_tests(spark):
    from starforge.plans.quality_checks import SUITE

    n = sum(len(t) for c in SUITE.tests.values() for t in c.values()) + sum(len(c) for c in SUITE.conditions.values())
    assert n == 147


def test_audit_of_bad_rows(spark):
    rides = spark.createDataFrame(
        [(5000, "A", 10, "cash"), (5000, "B", -100, "paypal"), (5001, None, 1, None)],
        "ride_id int, driver string, fare int, payment string",
    )
    rules = [q.non_negative("fare"), q.not_null("driver"), q.accepted("payment", ["cash", "esewa"])]
    got = rows(q.audit(rides, rules, [("ride_id", ["ride_id"], None)]), "check", "n_bad")
    assert got == [("accepted_values_payment", 1), ("non_negative_fare", 1), ("not_null_driver", 1), ("ride_id", 1)]


def test_keys_and_references_in_one_pass(spark):
    df = spark.createDataFrame(
        [(1, "a", 7), (1, "b", 8), (None, "a", 7), (None, None, 7), (3, None, None)], "id int, code string, ref int"
    )
    parent = spark.createDataFrame([(7,), (7,), (None,)], "id int")
    checks = [
        q.unique_key(["id"]),
        q.unique_key(["id", "code"]),
        q.unique_key(["id"], F.col("code") == "a", "one_a"),
        q.reference("ref", parent, "id"),
        q.reference("id", parent, "id"),
    ]
    got = rows(q.run_keys(df, checks), "check", "passed", "n_bad")
    assert got == [
        ("one_a", True, 0), ("relationships_id", False, 3), ("relationships_ref", False, 1),
        ("unique_id", False, 1), ("unique_id_code", True, 0),
    ]
    assert all(passed for _, passed, _ in rows(q.run_keys(df.limit(0), checks), "check", "passed", "n_bad"))


def test_a_suite_scans_a_table_twice(spark, tmp_path):
    for name in ("child", "parent"):
        spark.range(20).select("id", (F.col("id") % 5).alias("ref"), "id").toDF("id", "ref", "other").write.parquet(f"{tmp_path}/{name}")
    tables = {name: spark.read.parquet(f"{tmp_path}/{name}") for name in ("child", "parent")}
    refers = ("refers", "parent", "id")
    suite = q.Suite({"child": {"id": ["unique", "not_null"], "ref": [refers, "not_null"], "other": ["unique", refers]}}, {})
    found = q.run_suite(tables, suite)
    assert all(passed for _, passed in rows(found, "check", "passed")) and found.count() == 6
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 3  # the child for rows and for keys, the parent once


def test_states_of_partitions_add_up(spark, tmp_path):
    import random

    from starforge.sources.checkstate import CheckState

    rng = random.Random(6)
    parts = {
        p: spark.createDataFrame(
            [(rng.choice([None, *range(30)]), rng.choice(["a", "b", None]), rng.choice([None, 1, 2, 3]), rng.randrange(-2, 9)) for _ in range(n)],
            "id int, code string, ref int, fare int",
        )
        for p, n in (("p1", 25), ("p2", 40), ("p/3", 0))
    }
    parents = CheckState(spark, str(tmp_path / "parents"), keys=[q.unique_key(["id"])])
    parents.add(spark.createDataFrame([(1,), (2,), (2,), (None,)], "id int"), "x")
    keys = [q.unique_key(["id"]), q.unique_key(["id", "code"]), q.reference("ref", parents.values("unique_id"), "value")]
    rules = [q.min_rows(100), q.non_negative("fare"), q.not_null("code")]
    state = CheckState(spark, str(tmp_path / "state"), rules, keys)

    def same(tables):
        whole = q.union_all(tables)
        want = rows(q.run_rules(whole, rules).unionByName(q.run_keys(whole, keys)), "check", "passed", "n_bad")
        assert rows(state.results(), "check", "passed", "n_bad") == want

    same([parts["p1"].limit(0)])  # nothing yet
    state.add(parts["p2"], "p1")
    state.add(parts["p1"], "p1")  # replaces
    state.add(parts["p2"], "p2")
    state.add(parts["p/3"], "p/3")
    same(list(parts.values()))
    state.drop("p2")
    same([parts["p1"]])
    assert rows(parents.results(), "check", "n_bad") == [("unique_id", 1)]


def test_keys_are_counted_beside_those_of_their_parents(spark):
    """Parents are counted along, not joined; whole numbers are compared as numbers, all else as text."""
    df = spark.createDataFrame([(1, 1, "1"), (1, 2, "02"), (2, 2, None), (3, None, "2"), (None, 7, "x"), (None, 7, "x")], "a long, b int, c string")
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "p long")
    whole = [q.unique_key(["a"]), q.unique_key(["b"]), q.reference("b", parent, "p")]
    mixed = [*whole, q.unique_key(["a", "b"]), q.reference("c", parent, "p")]
    expected = [("unique_a", False, 1), ("unique_b", False, 2), ("relationships_b", False, 2), ("unique_a_b", True, 0), ("relationships_c", False, 3)]
    for checks in (whole, mixed):
        found = q.run_keys(df, checks)
        assert [tuple(r) for r in found.collect()] == expected[: len(checks)]
        assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert "as string" not in q.run_keys(df, whole)._jdf.queryExecution().optimizedPlan().toString()
