import datetime as dt
from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_star import T0, TRIP, trip

from starforge.operators import quality, star
from starforge.session import scratch_path
from starforge.warehouse import Warehouse

col = F.col
AS_OF = dt.datetime(2026, 1, 1)


def source(spark, trips, names=("Ann", "Ben"), methods=((5, "cash"),)):
    def df(data, schema):
        return spark.createDataFrame(data, schema)

    return SimpleNamespace(
        drivers=df([(i, n, "active", T0) for i, n in enumerate(names, 1)],
                   "driver_id int, name string, status string, joined_at timestamp_ntz"),
        passengers=df([(1, "P", "active", T0)], "passenger_id int, name string, status string, created_at timestamp_ntz"),
        locations=df([(1, "A", "Ohio", "USA", None, None)],
                     "location_id int, city_name string, state_province string, country string,"
                     "latitude decimal(9,6), longitude decimal(9,6)"),
        payment_methods=df([(i, n, "cash", True) for i, n in methods],
                           "payment_method_id int, name string, type string, is_active boolean"),
        promo_codes=df([(7, "X", "flat", 1, True)],
                       "promo_code_id int, code string, discount_type string, discount_value int, is_active boolean"),
        trips=df(trips, TRIP),
        trip_cancellations=df([], "trip_id int, cancelled_at timestamp_ntz, cancelled_by string, cancellation_reason string"),
    )


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


@pytest.fixture
def warehouse(spark):
    days = star.calendar(spark, dt.date(2024, 1, 1), dt.date(2024, 12, 31))
    return Warehouse(spark, scratch_path(spark, "warehouse"), days)


def facts(w):
    return rows(w.fact.read(), "source_trip_id", "fare_amount", "driver_key")


def test_incremental_runs(spark, warehouse):
    first = [trip(1, "10.00", at=at(0)), trip(2, "20.00", at=at(5), d=2), trip(3, at=at(9), d=99)]
    summary = warehouse.run(source(spark, first), AS_OF)
    assert summary["row_count"] == 2
    assert [(i, int(f), k) for i, f, k in facts(warehouse)] == [(1, 10, 1), (2, 20, 2)]
    # trip 1 changed, trip 4 is new, trip 5 came too late to be seen
    second = [trip(1, "99.00", at=at(0)), trip(4, "40.00", at=at(7)), trip(5, at=at(3))]
    warehouse.run(source(spark, second, names=("Anna", "Ben", "Cleo")), AS_OF)
    assert [(i, int(f)) for i, f, _ in facts(warehouse)] == [(1, 10), (2, 20), (4, 40)]
    assert rows(warehouse.dimension("driver").read(), "driver_key", "name") == [(1, "Anna"), (2, "Ben"), (3, "Cleo")]
    # nothing is new: the gate stops a run without rows unless told otherwise
    with pytest.raises(quality.DataQualityError, match="row_count"):
        warehouse.run(source(spark, second), AS_OF)
    warehouse.run(source(spark, second), AS_OF, min_rows=0)
    assert len(facts(warehouse)) == 3


def test_full_reloads(spark, warehouse):
    warehouse.run(source(spark, [trip(1, "10.00", at=at(0)), trip(2, "20.00", at=at(5))]), AS_OF)
    changed = source(spark, [trip(1, "11.00", at=at(0)), trip(3, "30.00", at=at(1))])
    warehouse.run(changed, AS_OF, full_reload=True)
    assert [(i, int(f)) for i, f, _ in facts(warehouse)] == [(1, 11), (2, 20), (3, 30)]
    warehouse.run(changed, AS_OF, full_reload=True, truncate=True)
    assert [(i, int(f)) for i, f, _ in facts(warehouse)] == [(1, 11), (3, 30)]


def test_a_bad_row_stops_the_run(spark, warehouse):
    warehouse.run(source(spark, [trip(1, at=at(0))]), AS_OF)
    bad = [trip(2, at=at(5)), trip(3, "1.00", disc="5.00", at=at(6))]
    with pytest.raises(quality.DataQualityError, match="non_negative_fare_amount"):
        warehouse.run(source(spark, bad), AS_OF)
    assert len(facts(warehouse)) == 1


def test_dimension_attributes_may_stay_as_first_loaded(spark, warehouse):
    warehouse.load_dimensions(source(spark, []), F.lit(AS_OF))
    warehouse.load_dimensions(source(spark, [], names=("Other", "Ben", "New")), F.lit(AS_OF), update=False)
    assert rows(warehouse.dimension("driver").read(), "driver_key", "name") == [(1, "Ann"), (2, "Ben"), (3, "New")]


def test_repeated_ids_lookback_and_rows_set_aside(spark, warehouse):
    first = source(spark, [trip(1, at=at(0)), trip(2, at=at(9), d=99)])
    first.drivers = first.drivers.unionByName(first.drivers)
    warehouse.run(first, AS_OF)
    assert rows(warehouse.dimension("driver").read(), "driver_key", "name") == [(1, "Ann"), (2, "Ben")]
    assert len(facts(warehouse)) == 1 and warehouse.dimension("time").read().count() == 96
    # trip 3 came late, trip 4 breaks a rule, trip 1 is cancelled twice
    second = source(spark, [trip(1, at=at(0)), trip(3, at=at(-5)), trip(4, "1.00", disc="5.00", at=at(6)), trip(5, at=at(7))])
    second.trip_cancellations = spark.createDataFrame([(1, None, "x", "y")] * 2, second.trip_cancellations.schema)
    warehouse.run(second, AS_OF, set_aside=True, lookback=dt.timedelta(hours=1))
    got = rows(warehouse.fact.read(), "source_trip_id", "month")
    assert got == [(1, "202403"), (3, "202403"), (5, "202403")]
    keys = rows(warehouse.fact.read(), "source_trip_id", "trip_key")
    assert keys[0] == (1, 1) and len({k for _, k in keys}) == 3
    assert rows(warehouse.skipped.read()) == [(2, "unknown driver"), (4, "negative fare")]
