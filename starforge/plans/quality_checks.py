"""Data-quality queries."""

import datetime as dt

from pyspark.sql import functions as F

from starforge.functions import columns as c
from starforge.operators import quality as q
from starforge.operators import star
from starforge.plans.registry import query
from starforge.plans.star_schema import (
    AS_OF,
    DIM_DRIVER_SQL,
    DIM_LOCATION_SQL,
    DIM_PASSENGER_SQL,
    DIM_PAYMENT_SQL,
    DIM_PROMO_SQL,
    FACT_MARTS_SQL,
    LISTED_SQL,
    RESOLVED_SQL,
    covered,
)
from starforge.session import scratch_path
from starforge.sources import readers
from starforge.sources.checkstate import CheckState

col = F.col

# The states and kinds that the tables allow.
TRIP_STATUS = ["completed", "cancelled", "no_show"]
DRIVER_STATUS = ["active", "inactive", "suspended"]
PASSENGER_STATUS = ["active", "inactive", "banned"]
PAYMENT_TYPES = ["card", "cash", "wallet", "voucher"]
DISCOUNT_TYPES = ["percent", "flat"]
CANCELLED_BY = ["driver", "passenger", "system"]
TENURES = ["0-6 months", "6-12 months", "1-2 years", "2+ years"]
REGIONS = ["Northeast", "Midwest", "South", "West", "International"]
RIDE_PAYMENTS = ["cash", "esewa", "khalti", "card", "wallet"]

_FARE = "base_fare * surge_multiplier + tip_amount - discount_amount"


def _check_sql(name: str, table: str, condition: str) -> str:
    return (
        f"SELECT '{name}' AS check, count(*) FILTER (WHERE {condition}) = 0 AS passed,"
        f" count(*) FILTER (WHERE {condition}) AS n_bad FROM {table}"
    )


@query(
    "dq_1",
    """SELECT 'row_count' AS check, count(*) >= 20000 AS passed, greatest(20000 - count(*), 0) AS n_bad FROM trips""",
)
def dq_1(t):
    return q.run_rules(t.trips, [q.min_rows(20000)])


@query("dq_2", _check_sql("non_negative_fare_amount", f"(SELECT {_FARE} AS f FROM trips)", "f < 0"))
def dq_2(t):
    return q.run_rules(t.trips.select(F.expr(_FARE).alias("fare_amount")), [q.non_negative("fare_amount")])


@query("dq_3", _check_sql("not_null_payment_method_id", "trips", "payment_method_id IS NULL"))
def dq_3(t):
    return q.run_rules(t.trips, [q.not_null("payment_method_id")])


@query("dq_4", _check_sql("completed_have_end", "trips", "status = 'completed' AND completed_at IS NULL"))
def dq_4(t):
    rule = q.required_when("completed_at", col("status") == "completed", "completed_have_end")
    return q.run_rules(t.trips, [rule])


@query("dq_5", _check_sql("accepted_values_payment_method", "rides", f"payment_method NOT IN {tuple(RIDE_PAYMENTS)}"))
def dq_5(t):
    return q.run_rules(t.rides, [q.accepted("payment_method", RIDE_PAYMENTS)])


@query(
    "dq_6",
    """SELECT 'unique_l_orderkey_l_linenumber' AS check, count(*) = 0 AS passed, count(*) AS n_bad FROM
       (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)""",
)
def dq_6(t):
    return q.unique(t.raw("lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dq_7",
    """SELECT 'relationships_driver_id' AS check, count(*) = 0 AS passed, count(*) AS n_bad
       FROM trips WHERE driver_id IS NOT NULL AND driver_id NOT IN (SELECT driver_id FROM drivers)""",
)
def dq_7(t):
    return q.relationship(t.trips, "driver_id", t.drivers, "driver_id")


_ROWS = {
    "duration_non_negative": "l_shipdate < o_orderdate",
    "discount_not_exceeding_base": "l_discount * l_extendedprice > o_totalprice",
    "multiplier_valid": "1 + l_tax < 1.0",
}
_LINES_SQL = "(SELECT * FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"


@query("dq_8", " UNION ALL ".join(_check_sql(n, _LINES_SQL, sql) for n, sql in _ROWS.items()))
def dq_8(t):
    lines = t.raw("lineitem").join(t.orders, col("o_orderkey") == col("l_orderkey"))
    return q.run_rules(lines, [q.no_rows(n, bad) for n, bad in _ROWS.items()])


_AUDIT = {
    "fare_not_negative": "base_fare < 0",
    "surge_at_least_one": "surge_multiplier < 1",
    "rating_in_range": "driver_rating NOT BETWEEN 1.0 AND 5.0",
    "known_status": f"status NOT IN {tuple(TRIP_STATUS)}",
    "completed_has_end": "status = 'completed' AND completed_at IS NULL",
    "discount_within_fare": "discount_amount > base_fare",
    "ends_after_start": "completed_at <= requested_at",
}


@query(
    "dq_9",
    " UNION ALL ".join(_check_sql(n, "trips", sql) for n, sql in _AUDIT.items())
    + """ UNION ALL SELECT 'one_open_trip_per_driver', count(*) = 0, count(*) FROM
          (SELECT driver_id FROM trips WHERE completed_at IS NULL GROUP BY driver_id HAVING count(*) > 1)
          UNION ALL SELECT 'trip_id_unique', count(*) = 0, count(*) FROM
          (SELECT trip_id FROM trips GROUP BY trip_id HAVING count(*) > 1)""",
)
def dq_9(t):
    rules = [q.no_rows(n, bad) for n, bad in _AUDIT.items()]
    keys = [
        ("one_open_trip_per_driver", ["driver_id"], col("completed_at").isNull()),
        ("trip_id_unique", ["trip_id"], None),
    ]
    return q.audit(t.trips, rules, keys)


@query(
    "dq_10",
    f"""{RESOLVED_SQL}
    SELECT count(*) AS row_count, CASE WHEN count(*) FILTER (WHERE status = 'completed' AND completed_at IS NULL) > 0
           THEN 'completed_have_duration' ELSE 'passed' END AS stopped_by FROM resolved WHERE skip_reason IS NULL""",
)
def dq_10(t):
    good, _ = star.fact_trips_etl(t.trips, star.etl_lookups(t, covered(t)))
    rules = [
        q.min_rows(1),
        q.not_null("driver_key"),
        q.accepted("status", TRIP_STATUS),
    ]
    summary = q.gate(good, rules)
    broken = [*rules, q.required_when("duration_minutes", col("status") == "completed", "completed_have_duration")]
    try:
        q.gate(good, broken)
        stopped = "passed"
    except q.DataQualityError as error:
        stopped = str(error).split(":")[0]
    return t.spark.range(1).select(F.lit(summary["row_count"]).alias("row_count"), F.lit(stopped).alias("stopped_by"))


# --------------------------------------------------------------------------- the suite

KEY = ["unique", "not_null"]
MART_CONDITIONS = {
    "discount_not_exceeding_base_fare": "discount_amount > base_fare",
    "duration_non_negative": "duration_minutes < 0",
    "fare_amount_non_negative": "fare_amount < 0",
    "surge_multiplier_valid": "surge_multiplier < 1",
}
# The published tests of the tables, column by column.
SUITE = q.Suite(
    tests={
        # raw tables
        "raw_drivers": {"driver_id": KEY, "name": ["not_null"], "status": ["not_null"], "joined_at": ["not_null"]},
        "raw_passengers": {"passenger_id": KEY, "name": ["not_null"], "status": ["not_null"], "created_at": ["not_null"]},
        "raw_locations": {"location_id": KEY, "city_name": ["not_null"]},
        "raw_payment_methods": {"payment_method_id": KEY, "name": ["not_null"], "is_active": ["not_null"]},
        "raw_promo_codes": {
            "promo_code_id": KEY,
            "code": ["not_null"],
            "discount_type": ["not_null"],
            "discount_value": ["not_null"],
            "is_active": ["not_null"],
        },
        "raw_trips": {
            "trip_id": KEY,
            **{
                n: ["not_null"]
                for n in (
                    "driver_id passenger_id pickup_location_id dropoff_location_id base_fare tip_amount "
                    "discount_amount surge_multiplier distance_km"
                ).split()
            },
            "status": ["not_null", ("accepted", TRIP_STATUS)],
            "requested_at": ["not_null"],
        },
        "raw_trip_cancellations": {
            "trip_id": KEY,
            "cancelled_at": ["not_null"],
            "cancelled_by": ["not_null", ("accepted", CANCELLED_BY)],
        },
        # staging
        "stg_drivers": {
            "driver_id": KEY,
            "name": ["not_null"],
            "status": ["not_null", ("accepted", DRIVER_STATUS)],
            "joined_at": ["not_null"],
        },
        "stg_passengers": {
            "passenger_id": KEY,
            "name": ["not_null"],
            "status": ["not_null", ("accepted", PASSENGER_STATUS)],
            "created_at": ["not_null"],
        },
        "stg_locations": {"location_id": KEY, "city_name": ["not_null"]},
        "stg_payment_methods": {
            "payment_method_id": KEY,
            "name": ["not_null"],
            "type": [("accepted", PAYMENT_TYPES)],
            "is_active": ["not_null"],
        },
        "stg_promo_codes": {
            "promo_code_id": KEY,
            "code": ["not_null"],
            "discount_type": ["not_null", ("accepted", DISCOUNT_TYPES)],
            "discount_value": ["not_null"],
            "is_active": ["not_null"],
        },
        "stg_trips": {
            "trip_id": KEY,
            "status": ["not_null", ("accepted", TRIP_STATUS)],
            **{
                n: ["not_null"]
                for n in "base_fare tip_amount discount_amount surge_multiplier distance_km requested_at".split()
            },
            "driver_id": ["not_null", ("refers", "stg_drivers", "driver_id")],
            "passenger_id": ["not_null", ("refers", "stg_passengers", "passenger_id")],
            "pickup_location_id": ["not_null", ("refers", "stg_locations", "location_id")],
            "dropoff_location_id": ["not_null", ("refers", "stg_locations", "location_id")],
            "payment_method_id": [("refers", "stg_payment_methods", "payment_method_id")],
            "promo_code_id": [("refers", "stg_promo_codes", "promo_code_id")],
        },
        # marts
        "dim_driver": {
            "driver_key": KEY,
            "driver_id": KEY,
            "name": ["not_null"],
            "status": ["not_null", ("accepted", DRIVER_STATUS)],
            "joined_at": ["not_null"],
            "tenure_bucket": [("accepted", TENURES)],
        },
        "dim_passenger": {
            "passenger_key": KEY,
            "passenger_id": KEY,
            "name": ["not_null"],
            "status": ["not_null", ("accepted", PASSENGER_STATUS)],
            "created_at": ["not_null"],
        },
        "dim_location": {
            "location_key": KEY,
            "location_id": KEY,
            "city_name": ["not_null"],
            "region": ["not_null", ("accepted", REGIONS)],
        },
        "dim_payment_method": {
            "payment_method_key": KEY,
            "name": ["not_null"],
            "type": [("accepted", PAYMENT_TYPES)],
        },
        "dim_promo_code": {
            "promo_code_key": KEY,
            "code": ["not_null"],
            "discount_type": [("accepted", DISCOUNT_TYPES)],
        },
        "fact_trips": {
            "trip_key": KEY,
            "source_trip_id": KEY,
            **{
                n: ["not_null"]
                for n in (
                    "date_key base_fare tip_amount discount_amount fare_amount distance_km surge_multiplier requested_at"
                ).split()
            },
            "driver_key": ["not_null", ("refers", "dim_driver", "driver_key")],
            "passenger_key": ["not_null", ("refers", "dim_passenger", "passenger_key")],
            "pickup_location_key": ["not_null", ("refers", "dim_location", "location_key")],
            "dropoff_location_key": ["not_null", ("refers", "dim_location", "location_key")],
            "payment_method_key": [("refers", "dim_payment_method", "payment_method_key")],
            "promo_code_key": [("refers", "dim_promo_code", "promo_code_key")],
        },
    },
    conditions={"fact_trips": MART_CONDITIONS},
)

_SUITE_TABLES = {
    **{f"raw_{n}": f"SELECT * FROM {n}" for n in (
        "drivers passengers locations payment_methods promo_codes trips trip_cancellations"
    ).split()},
    **{f"stg_{n}": f"SELECT * FROM {n}" for n in "drivers passengers locations payment_methods promo_codes trips".split()},
    "dim_driver": DIM_DRIVER_SQL,
    "dim_passenger": DIM_PASSENGER_SQL,
    "dim_location": DIM_LOCATION_SQL.format(region=LISTED_SQL),
    "dim_payment_method": DIM_PAYMENT_SQL,
    "dim_promo_code": DIM_PROMO_SQL,
    "fact_trips": FACT_MARTS_SQL,
}


def _suite_sql() -> str:
    """The suite as one statement, a SELECT per test."""
    ctes = ", ".join(f"t_{n} AS MATERIALIZED ({sql})" for n, sql in _SUITE_TABLES.items())
    rows = []

    def add(table, check, condition):
        rows.append(f"SELECT '{table}' AS table_name, '{check}' AS check, count(*) AS n_bad FROM t_{table} WHERE {condition}")

    for table, columns in SUITE.tests.items():
        for column, tests in columns.items():
            for test in tests:
                if test == "not_null":
                    add(table, f"not_null_{column}", f"{column} IS NULL")
                elif test == "unique":
                    rows.append(
                        f"SELECT '{table}' AS table_name, 'unique_{column}' AS check, count(*) AS n_bad FROM (SELECT {column} FROM t_{table}"
                        f" WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"
                    )
                elif test[0] == "accepted":
                    add(table, f"accepted_values_{column}", f"{column} NOT IN {tuple(test[1])}")
                else:
                    add(
                        table, f"relationships_{column}",
                        f"{column} IS NOT NULL AND {column} NOT IN (SELECT {test[2]} FROM t_{test[1]}"
                        f" WHERE {test[2]} IS NOT NULL)",
                    )
    for name, condition in MART_CONDITIONS.items():
        add("fact_trips", name, condition)
    body = " UNION ALL ".join(rows)
    return f'WITH {ctes} SELECT table_name, "check", n_bad = 0 AS passed, n_bad FROM ({body})'


@query("dq_11", _suite_sql())
def dq_11(t):
    raw = {f"raw_{n}": getattr(t, n) for n in (
        "drivers passengers locations payment_methods promo_codes trips trip_cancellations"
    ).split()}
    built = star.marts(t, c.now(AS_OF), covered(t))
    # marts are stored before they are tested, so that each is built once
    stored = readers.land_raw({n: df for n, df in built.items() if not n.startswith("stg_")}, scratch_path(t.spark, "marts"))
    return q.run_suite({**raw, **built, **stored}, SUITE)


@query(
    "dq_11_parts",
    """SELECT "check", n_bad = 0 AS passed, n_bad FROM (
           SELECT 'row_count' AS "check", greatest(20000 - count(*), 0) AS n_bad FROM trips
           UNION ALL SELECT 'not_null_tip_amount', count(*) FILTER (WHERE tip_amount IS NULL) FROM trips
           UNION ALL SELECT 'accepted_values_status', count(*) FILTER (WHERE status NOT IN ('completed', 'cancelled')) FROM trips
           UNION ALL SELECT 'unique_trip_id', (SELECT count(*) FROM (SELECT trip_id FROM trips GROUP BY 1 HAVING count(*) > 1))
           UNION ALL SELECT 'unique_driver_id_requested_at', (SELECT count(*) FROM (SELECT driver_id, requested_at FROM trips
               WHERE driver_id IS NOT NULL AND requested_at IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1))
           UNION ALL SELECT 'relationships_driver_id', count(*) FROM trips WHERE driver_id NOT IN (SELECT driver_id FROM drivers))""",
)
def dq_11_parts(t):
    """The checks of a table that came in parts, one of them twice, from the counts of each part."""
    root = scratch_path(t.spark, "check-state")
    drivers = CheckState(t.spark, f"{root}/drivers", keys=[q.unique_key(["driver_id"])])
    drivers.add(t.drivers, "all")
    keys = [q.unique_key(["trip_id"]), q.unique_key(["driver_id", "requested_at"]), q.reference("driver_id", drivers.values("unique_driver_id"), "value")]
    rules = [q.min_rows(20_000), q.not_null("tip_amount"), q.accepted("status", ["completed", "cancelled"])]
    state = CheckState(t.spark, f"{root}/trips", rules, keys)
    late = col("requested_at") >= c.now(dt.datetime(1996, 1, 1))
    for part, rows in (("early", t.trips.where(~late)), ("late", t.trips.where(late & (col("status") == "completed"))), ("late", t.trips.where(late))):
        state.add(rows, part)
    return state.results()


@query(
    "dq_12",
    """SELECT CASE WHEN payment_method IS NULL THEN 'missing_payment' WHEN rating < 2 THEN 'low_rating'
              ELSE 'valid' END AS outcome, count(*) AS n_rows FROM rides GROUP BY 1""",
)
def dq_12(t):
    rules = [("missing_payment", col("payment_method").isNull()), ("low_rating", col("rating") < 2)]
    valid, rejected = q.split_valid(t.rides, rules)
    outcome = valid.select(F.lit("valid").alias("outcome")).unionByName(rejected.select(col("reason").alias("outcome")))
    return outcome.groupBy("outcome").agg(F.count(F.lit(1)).alias("n_rows"))
