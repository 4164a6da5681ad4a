import datetime as dt
from decimal import Decimal as D

from conftest import rows
from pyspark.sql import functions as F

from starforge.functions import columns as c
from starforge.operators import star
from starforge.operators.star import Lookups

col = F.col


def test_calendar(spark):
    dim = star.dim_date(star.calendar(spark, dt.date(2023, 1, 1), dt.date(2026, 12, 31)))
    assert dim.count() == 1461
    row = dim.where("date_key = 20240310").first()
    assert tuple(row) == (20240310, dt.date(2024, 3, 10), 2024, 1, 3, "March", 10, 0, "Sunday", True)


def test_time_of_day(spark):
    dim = star.dim_time(spark)
    assert dim.count() == 96
    got = rows(dim.where("time_key in (0, 700, 1430)"))
    assert got == [
        (0, 0, 0, "00:00", "Night", False),
        (1430, 14, 30, "14:30", "Afternoon", False),
        (700, 7, 0, "07:00", "Morning", True),
    ]


def test_release_dates(spark):
    dim = star.dim_release_date(star.calendar(spark, dt.date(1900, 1, 1), dt.date(2000, 1, 1)))
    assert dim.where("date_key = 19940923").first()["decade"] == 1990


def test_tenure_buckets(spark):
    days = ["2025-07-01", "2025-06-30", "2025-01-01", "2024-12-31", "2024-01-01", "2023-12-31", None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, d string")
    bucket = c.tenure_bucket(col("d").cast("timestamp_ntz"), c.now(dt.datetime(2026, 1, 1)))
    assert [b for _, b in rows(df.select("i", bucket))] == [
        "0-6 months", "6-12 months", "6-12 months", "1-2 years", "1-2 years", "2+ years", "2+ years",
    ]


def test_region_mappings(spark):
    df = spark.createDataFrame(
        [("Maine", "USA"), ("Texas", "Canada"), ("Texas", None), ("Ohio", "USA"), ("Ontario", "USA"), (None, "USA")],
        "state string, country string",
    )
    full = star.region(col("state"), star.US_REGIONS, col("country"))
    short = star.region(col("state"), star.LISTED_REGIONS)
    assert [tuple(r) for r in df.select(full, short).collect()] == [
        ("Northeast", "International"), ("International", "South"), ("South", "South"), ("Midwest", "Midwest"),
        ("International", "International"), ("International", "International"),
    ]
    assert sum(len(s) for s in star.US_REGIONS.values()) == 50


def test_sentinel_rows_come_last(spark):
    stg = spark.createDataFrame(
        [(2, "card", "card", True), (1, "cash", "cash", True)],
        "payment_method_id int, name string, type string, is_active boolean",
    )
    got = rows(star.dim_payment_method(stg), "payment_method_key", "payment_method_id", "name")
    assert got == [(1, 1, "cash"), (2, 2, "card"), (3, None, "Unknown")]


def test_assign_keys_keeps_old_ones(spark):
    old = spark.createDataFrame([("b", 1), ("a", 2)], "name string, key long")
    new = spark.createDataFrame([("a",), ("d",), ("c",), ("c",)], "name string")
    expected = [("a", 2), ("b", 1), ("c", 3), ("d", 4)]
    once = star.assign_keys(old, new, ["name"], "key")
    assert rows(once) == expected
    assert rows(star.assign_keys(once, new, ["name"], "key")) == expected


TRIP = (
    "trip_id int, driver_id int, passenger_id int, pickup_location_id int, dropoff_location_id int, "
    "payment_method_id int, promo_code_id int, base_fare decimal(10,2), tip_amount decimal(8,2), "
    "discount_amount decimal(8,2), surge_multiplier decimal(4,2), distance_km decimal(6,2), status string, "
    "requested_at timestamp_ntz, completed_at timestamp_ntz, driver_rating decimal(2,1), passenger_rating decimal(2,1)"
)
T0 = dt.datetime(2024, 3, 4, 8)


def trip(i, base="10.00", surge="1.00", tip="0.00", disc="0.00", status="cancelled", end=None, at=T0, d=1, p=1, f=1, g=1, m=None, c=None):
    return (
        i, d, p, f, g, m, c, D(base), D(tip), D(disc), None if surge is None else D(surge), D("1.00"), status, at, end,
        None, None,
    )


def lookups(spark):
    def one(name, ids):
        return spark.createDataFrame([(i, k) for i, k in ids], f"{name}_id int, {name}_key int")

    return Lookups(
        star.dim_date(star.calendar(spark, dt.date(2024, 1, 1), dt.date(2024, 12, 31))).select("date_key"),
        one("driver", [(1, 11)]), one("passenger", [(1, 21)]), one("location", [(1, 31), (2, 32)]),
        one("payment_method", [(5, 51), (None, 99)]), one("promo_code", [(7, 71), (None, 98)]),
    )


def test_fact_measures_in_both_variants(spark):
    trips = spark.createDataFrame(
        [
            trip(1, "10.00", "1.50", "2.00", "1.00", "completed", T0 + dt.timedelta(minutes=20)),
            trip(2, "10.01", "1.25", status="completed", end=T0 + dt.timedelta(seconds=45)),
            trip(3, "10.10", "1.25"),
            trip(4, "10.00", None, "2.00", "1.00", "no_show"),
        ],
        TRIP,
    )
    good, skipped = star.fact_trips_etl(trips, lookups(spark))
    assert skipped.count() == 0
    assert rows(good, "source_trip_id", "fare_amount", "duration_minutes") == [
        (1, D("16.00"), D("20.0")), (2, D("12.51"), D("0.8")), (3, D("12.62"), None), (4, D("1.00"), None),
    ]
    mart = star.fact_trips_marts(star.stg_trips(trips), lookups(spark))
    got = [(a, b, None if x is None else round(float(x), 6), y) for a, b, x, y in rows(
        mart, "source_trip_id", "fare_amount", "duration_minutes", "payment_method_key")]
    assert got == [
        (1, D("16.0000"), 20.0, 99), (2, D("12.5125"), 0.75, 99), (3, D("12.6250"), None, 99), (4, None, None, 99),
    ]


def test_skip_reasons_in_order(spark):
    trips = spark.createDataFrame(
        [
            trip(1, at=dt.datetime(2030, 1, 1), d=9),
            trip(2, d=9, p=9),
            trip(3, p=9, f=9),
            trip(4, f=9, g=9),
            trip(5, g=9, m=9),
            trip(6, m=9, c=9),
            trip(7, c=9),
            trip(8, m=5, c=7),
        ],
        TRIP,
    )
    good, skipped = star.fact_trips_etl(trips, lookups(spark))
    assert rows(skipped) == [
        (1, "date outside dim_date"), (2, "unknown driver"), (3, "unknown passenger"), (4, "unknown pickup_location"),
        (5, "unknown dropoff_location"), (6, "unknown payment_method"), (7, "unknown promo_code"),
    ]
    assert rows(good, "source_trip_id", "payment_method_key", "promo_code_key") == [(8, 51, 71)]
    # the other variant keeps unknown optional ids, with no key
    mart = rows(star.fact_trips_marts(star.stg_trips(trips), lookups(spark)), "source_trip_id", "payment_method_key", "promo_code_key")
    assert mart == [(6, None, None), (7, 99, None), (8, 51, 71)]


def test_normalise(spark):
    rides = spark.createDataFrame(
        [(" hari  BAHADUR ", "mary-jane", "A", "B", D("5.00"), D("1.00"), "completed", T0, None, None, "cash"),
         ("Hari Bahadur", "MARY-jane", "B", "C", D("6.00"), D("1.00"), "completed", T0, None, None, None)],
        "driver_name string, passenger_name string, pickup_city string, dropoff_city string, fare_amount decimal(10,2),"
        "ride_distance_km decimal(6,2), ride_status string, requested_at timestamp_ntz, completed_at timestamp_ntz,"
        "rating decimal(2,1), payment_method string",
    )
    e = star.entities(rides)
    assert rows(e.drivers, "name") == [("Hari Bahadur",)]
    assert rows(e.passengers, "name") == [("Mary-Jane",)]
    assert rows(e.locations) == [(1, "A"), (2, "B"), (3, "C")]
    got = rows(star.normalise_trips(rides, e), "driver_id", "pickup_location_id", "dropoff_location_id", "payment_method_id")
    assert got == [(1, 1, 2, 1), (1, 2, 3, None)]


def test_view_of_trips_needs_an_end_only(spark):
    trips = spark.createDataFrame([trip(1, "10.10", "1.25", end=T0 + dt.timedelta(minutes=3))], TRIP)
    none = spark.createDataFrame([], "trip_id int, cancelled_at timestamp_ntz, cancelled_by string, cancellation_reason string")
    row = star.v_trips(trips, none).first()
    assert row["fare_amount"] == D("12.63") and float(row["duration_minutes"]) == 3.0
