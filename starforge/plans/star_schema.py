"""Dimensions, normalisation and the trip fact."""

import datetime as dt
from types import SimpleNamespace

from pyspark.sql import functions as F

from starforge.functions import columns as c
from starforge.operators import star
from starforge.operators import windows as w
from starforge.plans.joins import clean_name_sql
from starforge.plans.registry import query
from starforge.session import scratch_path
from starforge.warehouse import Warehouse

col = F.col
AS_OF = dt.datetime(2000, 8, 31)


def covered(t):
    """The calendar of the trip fact; trips of 2001 lie outside."""
    return star.calendar(t.spark, dt.date(1995, 1, 1), dt.date(2000, 12, 31))


@query(
    "dim_1",
    """SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_key FROM orders""",
)
def dim_1(t):
    return w.dense_key(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], "order_key")


_EARLY = "created_at < TIMESTAMP '1997-06-01 00:00:00'"


@query(
    "dim_2",
    f"""WITH old AS (SELECT passenger_id, row_number() OVER (ORDER BY passenger_id DESC) AS passenger_key
                     FROM passengers WHERE {_EARLY})
        SELECT passenger_id, passenger_key FROM old
        UNION ALL
        SELECT passenger_id, (SELECT max(passenger_key) FROM old) + row_number() OVER (ORDER BY passenger_id)
        FROM passengers WHERE passenger_id NOT IN (SELECT passenger_id FROM old)""",
)
def dim_2(t):
    # passengers of an earlier load keep the keys they were given then
    early = t.passengers.where(col("created_at") < c.now(dt.datetime(1997, 6, 1))).select("passenger_id")
    existing = w.dense_key(early, ["-passenger_id"], "passenger_key")
    return star.assign_keys(existing, t.passengers.select("passenger_id"), ["passenger_id"], "passenger_key")


@query(
    "dim_3",
    """WITH days AS (SELECT unnest(generate_series(
               date_trunc('year', (SELECT min(o_orderdate) FROM orders)),
               date_trunc('year', (SELECT max(o_orderdate) FROM orders)) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
               INTERVAL 1 DAY)) AS d)
       SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, CAST(CAST(d AS DATE) AS VARCHAR) AS full_date,
              year(d) AS year, quarter(d) AS quarter, month(d) AS month, strftime(d, '%B') AS month_name,
              weekofyear(d) AS week_of_year, dayofweek(d) AS day_of_week, strftime(d, '%A') AS day_name,
              dayofweek(d) IN (0, 6) AS is_weekend, count(o_orderkey) AS trips
       FROM days LEFT JOIN orders ON o_orderdate >= d AND o_orderdate < d + INTERVAL 1 DAY GROUP BY d""",
)
def dim_3(t):
    per_day = t.orders.groupBy(c.date_key(col("o_orderdate")).alias("date_key")).agg(F.count(F.lit(1)).alias("trips"))
    dim = star.dim_date(star.calendar_over(t.orders, "o_orderdate"))
    return (
        dim.join(per_day, "date_key", "left")
        .withColumn("trips", c.or_zero(col("trips")))
        .withColumn("full_date", col("full_date").cast("string"))
    )


@query(
    "dim_4",
    """SELECT h * 100 + m AS time_key, h AS hour, m AS minute_bucket,
              lpad(CAST(h AS VARCHAR), 2, '0') || ':' || lpad(CAST(m AS VARCHAR), 2, '0') AS time_label,
              CASE WHEN h BETWEEN 6 AND 11 THEN 'Morning' WHEN h BETWEEN 12 AND 16 THEN 'Afternoon'
                   WHEN h BETWEEN 17 AND 20 THEN 'Evening' ELSE 'Night' END AS time_of_day,
              h BETWEEN 7 AND 8 OR h BETWEEN 17 AND 19 AS is_rush_hour, count(event_id) AS events
       FROM (SELECT unnest(generate_series(0, 23)) AS h) CROSS JOIN (SELECT unnest(generate_series(0, 45, 15)) AS m)
       LEFT JOIN events ON hour(ts) = h AND minute(ts) // 15 * 15 = m GROUP BY h, m""",
)
def dim_4(t):
    used = t.events.groupBy(c.quarter_hour_key(col("ts")).alias("time_key")).agg(F.count(F.lit(1)).alias("events"))
    return star.dim_time(t.spark).join(used, "time_key", "left").withColumn("events", c.or_zero(col("events")))


DIM_DRIVER_SQL = """
    SELECT row_number() OVER (ORDER BY driver_id) AS driver_key, driver_id, name, status, joined_at,
           CASE WHEN joined_at >= TIMESTAMP '2000-08-31' - INTERVAL 6 MONTH THEN '0-6 months'
                WHEN joined_at >= TIMESTAMP '2000-08-31' - INTERVAL 1 YEAR THEN '6-12 months'
                WHEN joined_at >= TIMESTAMP '2000-08-31' - INTERVAL 2 YEAR THEN '1-2 years'
                ELSE '2+ years' END AS tenure_bucket FROM drivers"""
DIM_PASSENGER_SQL = """
    SELECT row_number() OVER (ORDER BY passenger_id) AS passenger_key, passenger_id, name, status, created_at,
           strftime(created_at, '%Y-%m') AS cohort_month FROM passengers"""
DIM_LOCATION_SQL = """
    SELECT row_number() OVER (ORDER BY location_id) AS location_key, location_id, city_name, state_province, country,
           latitude, longitude, {region} AS region FROM locations"""
LISTED_SQL = """CASE WHEN state_province IN ('New York', 'Pennsylvania') THEN 'Northeast'
    WHEN state_province IN ('Illinois', 'Ohio') THEN 'Midwest'
    WHEN state_province IN ('Texas', 'Florida', 'Tennessee') THEN 'South'
    WHEN state_province IN ('California', 'Arizona', 'Colorado', 'Nevada', 'Oregon', 'Washington') THEN 'West'
    ELSE 'International' END"""
ALL_STATES_SQL = """CASE WHEN country <> 'USA' THEN 'International'
    WHEN state_province IN ('New York', 'Maine') THEN 'Northeast' WHEN state_province = 'Ohio' THEN 'Midwest'
    WHEN state_province = 'Texas' THEN 'South' WHEN state_province = 'California' THEN 'West'
    ELSE 'International' END"""
DIM_PAYMENT_SQL = """
    SELECT row_number() OVER (ORDER BY payment_method_id NULLS LAST) AS payment_method_key, * FROM (
        SELECT payment_method_id, name, type, is_active FROM payment_methods
        UNION ALL SELECT NULL, 'Unknown', NULL, NULL)"""
DIM_PROMO_SQL = """
    SELECT row_number() OVER (ORDER BY promo_code_id NULLS LAST) AS promo_code_key, * FROM (
        SELECT promo_code_id, code, discount_type, discount_value, is_active FROM promo_codes
        UNION ALL SELECT NULL, 'No Promo', NULL, NULL, NULL)"""


@query("dim_5", DIM_DRIVER_SQL)
def dim_5(t):
    return star.dim_driver(star.stg_drivers(t.drivers), c.now(AS_OF))


@query("dim_6", DIM_PASSENGER_SQL)
def dim_6(t):
    return star.dim_passenger(star.stg_passengers(t.passengers))


@query(
    "dim_7",
    f"""SELECT a.*, b.region AS listed_region FROM ({DIM_LOCATION_SQL.format(region=ALL_STATES_SQL)}) a
        JOIN ({DIM_LOCATION_SQL.format(region=LISTED_SQL)}) b USING (location_key)""",
    doubles="latitude longitude",
)
def dim_7(t):
    stg = star.stg_locations(t.locations)
    listed = star.dim_location(stg, "listed").select("location_key", col("region").alias("listed_region"))
    return star.dim_location(stg).join(listed, "location_key")


@query(
    "dim_8",
    f"SELECT * REPLACE (coalesce(CAST(is_active AS VARCHAR), 'none') AS is_active) FROM ({DIM_PAYMENT_SQL})",
    doubles="payment_method_id",
)
def dim_8(t):
    dim = star.dim_payment_method(star.stg_payment_methods(t.payment_methods))
    return dim.withColumn("is_active", F.coalesce(col("is_active").cast("string"), F.lit("none")))


@query(
    "dim_9",
    f"SELECT * REPLACE (coalesce(CAST(is_active AS VARCHAR), 'none') AS is_active) FROM ({DIM_PROMO_SQL})",
    doubles="promo_code_id discount_value",
)
def dim_9(t):
    dim = star.dim_promo_code(star.stg_promo_codes(t.promo_codes))
    return dim.withColumn("is_active", F.coalesce(col("is_active").cast("string"), F.lit("none")))


# --------------------------------------------------------------------------- normalisation

_NAMES = {
    "driver": f"SELECT DISTINCT {clean_name_sql('driver_name')} AS name FROM rides",
    "passenger": f"SELECT DISTINCT {clean_name_sql('passenger_name')} AS name FROM rides",
    "location": "SELECT pickup_city AS name FROM rides UNION SELECT dropoff_city FROM rides",
    "payment_method": "SELECT DISTINCT payment_method AS name FROM rides WHERE payment_method IS NOT NULL",
}
_ENTITIES_SQL = " UNION ALL ".join(
    f"SELECT '{kind}' AS kind, name, row_number() OVER (ORDER BY name) AS id FROM ({sql})" for kind, sql in _NAMES.items()
)


@query("nrm_1", _ENTITIES_SQL)
def nrm_1(t):
    e = star.entities(t.rides)
    parts = [
        df.select(F.lit(kind).alias("kind"), col(label).alias("name"), col(key).alias("id"))
        for kind, df, key, label in [
            ("driver", e.drivers, "driver_id", "name"),
            ("passenger", e.passengers, "passenger_id", "name"),
            ("location", e.locations, "location_id", "city_name"),
            ("payment_method", e.payment_methods, "payment_method_id", "name"),
        ]
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(
    "nrm_2",
    f"""WITH e AS ({_ENTITIES_SQL})
        SELECT d.id AS driver_id, p.id AS passenger_id, f.id AS pickup_location_id, g.id AS dropoff_location_id,
               fare_amount, ride_distance_km AS distance_km, ride_status AS status, requested_at, completed_at, rating,
               m.id AS payment_method_id
        FROM rides r
        JOIN e d ON d.kind = 'driver' AND d.name = {clean_name_sql('r.driver_name')}
        JOIN e p ON p.kind = 'passenger' AND p.name = {clean_name_sql('r.passenger_name')}
        JOIN e f ON f.kind = 'location' AND f.name = r.pickup_city
        JOIN e g ON g.kind = 'location' AND g.name = r.dropoff_city
        LEFT JOIN e m ON m.kind = 'payment_method' AND m.name = r.payment_method""",
    doubles="fare_amount distance_km rating payment_method_id",
)
def nrm_2(t):
    return star.normalise_trips(t.rides, star.entities(t.rides))


# --------------------------------------------------------------------------- fact


@query(
    "fct_1",
    """SELECT t.trip_id, t.driver_id, t.status, t.requested_at, x.cancelled_by FROM trips t
       LEFT JOIN trip_cancellations x ON x.trip_id = t.trip_id""",
)
def fct_1(t):
    return star.trips_with_cancellation(t.trips, t.trip_cancellations).select(
        "trip_id", "driver_id", "status", "requested_at", "cancelled_by"
    )


_KEYS = """
    dd AS (SELECT driver_id, row_number() OVER (ORDER BY driver_id) AS driver_key FROM drivers),
    dp AS (SELECT passenger_id, row_number() OVER (ORDER BY passenger_id) AS passenger_key FROM passengers),
    dl AS (SELECT location_id, row_number() OVER (ORDER BY location_id) AS location_key FROM locations),
    dm AS (SELECT payment_method_id, row_number() OVER (ORDER BY payment_method_id) AS payment_method_key
           FROM payment_methods),
    dc AS (SELECT promo_code_id, row_number() OVER (ORDER BY promo_code_id) AS promo_code_key FROM promo_codes)"""
RESOLVED_SQL = f"""WITH {_KEYS}, resolved AS (
    SELECT t.*, driver_key, passenger_key, f.location_key AS pickup_location_key, g.location_key AS dropoff_location_key,
           payment_method_key, promo_code_key,
           CASE WHEN requested_at < TIMESTAMP '1995-01-01' OR requested_at >= TIMESTAMP '2001-01-01'
                    THEN 'date outside dim_date'
                WHEN driver_key IS NULL THEN 'unknown driver' WHEN passenger_key IS NULL THEN 'unknown passenger'
                WHEN f.location_key IS NULL THEN 'unknown pickup_location'
                WHEN g.location_key IS NULL THEN 'unknown dropoff_location'
                WHEN t.payment_method_id IS NOT NULL AND payment_method_key IS NULL THEN 'unknown payment_method'
                WHEN t.promo_code_id IS NOT NULL AND promo_code_key IS NULL THEN 'unknown promo_code' END AS skip_reason
    FROM trips t LEFT JOIN dd USING (driver_id) LEFT JOIN dp USING (passenger_id)
    LEFT JOIN dl f ON f.location_id = t.pickup_location_id LEFT JOIN dl g ON g.location_id = t.dropoff_location_id
    LEFT JOIN dm ON dm.payment_method_id = t.payment_method_id LEFT JOIN dc ON dc.promo_code_id = t.promo_code_id)"""


@query(
    "fct_2",
    f"""{RESOLVED_SQL}
    SELECT trip_id AS source_trip_id, CAST(strftime(requested_at, '%Y%m%d') AS BIGINT) AS date_key, driver_key,
           passenger_key, pickup_location_key, dropoff_location_key, payment_method_key, promo_code_key, base_fare,
           tip_amount, discount_amount, coalesce(surge_multiplier, 0) AS surge_multiplier,
           round_even(CAST((base_fare * coalesce(surge_multiplier, 0) + tip_amount - discount_amount) * 100 AS DOUBLE), 0)
             / 100 AS fare_amount, distance_km, status,
           round_even(date_diff('second', requested_at, completed_at) / 6.0::DOUBLE, 0) / 10 AS duration_minutes,
           1 AS trip_count, driver_rating, passenger_rating, requested_at
    FROM resolved WHERE skip_reason IS NULL""",
    doubles="payment_method_key promo_code_key base_fare tip_amount discount_amount surge_multiplier fare_amount "
    "distance_km duration_minutes driver_rating passenger_rating",
    bigints="trip_count",
)
def fct_2(t):
    good, _ = star.fact_trips_etl(t.trips, star.etl_lookups(t, covered(t)))
    return good


@query(
    "fct_2_skipped",
    f"{RESOLVED_SQL} SELECT trip_id, skip_reason FROM resolved WHERE skip_reason IS NOT NULL",
)
def fct_2_skipped(t):
    _, skipped = star.fact_trips_etl(t.trips, star.etl_lookups(t, covered(t)))
    return skipped


@query(
    "warehouse_runs",
    f"""{RESOLVED_SQL}
    SELECT trip_id AS source_trip_id, CASE WHEN why IS NULL THEN driver_key END AS driver_key,
           CASE WHEN why IS NULL THEN passenger_key END AS passenger_key,
           CASE WHEN why IS NULL THEN promo_code_key END AS promo_code_key,
           CASE WHEN why IS NULL THEN fare END AS fare_amount, why AS skip_reason
    FROM (SELECT *, CASE WHEN skip_reason IS NOT NULL THEN skip_reason WHEN fare < 0 THEN 'negative fare'
                         WHEN status = 'completed' AND completed_at IS NULL THEN 'completed without duration' END AS why
          FROM (SELECT *, round_even(CAST((base_fare * coalesce(surge_multiplier, 0) + tip_amount - discount_amount)
                                          * 100 AS DOUBLE), 0) / 100 AS fare FROM resolved))""",
    doubles="driver_key passenger_key promo_code_key",
)
def warehouse_runs(t):
    """A full load of the earlier trips, an incremental run over all of them, and one that looks back."""
    early = t.trips.where(col("requested_at") < c.now(dt.datetime(1999, 1, 1)))
    tables = {n: getattr(t, n) for n in "drivers passengers locations payment_methods promo_codes trip_cancellations".split()}
    warehouse = Warehouse(t.spark, scratch_path(t.spark, "warehouse"), covered(t))
    first, every = SimpleNamespace(**tables, trips=early), SimpleNamespace(**tables, trips=t.trips)
    warehouse.run(first, AS_OF, "first", full_reload=True, set_aside=True)
    warehouse.run(every, AS_OF, "second", set_aside=True)
    warehouse.run(every, AS_OF, "third", min_rows=0, set_aside=True, lookback=dt.timedelta(days=40))
    facts = warehouse.fact.read().select("source_trip_id", "driver_key", "passenger_key", "promo_code_key", "fare_amount")
    skipped = warehouse.skipped.read().select(col("trip_id").alias("source_trip_id"), "skip_reason")
    return facts.unionByName(skipped, allowMissingColumns=True)


FACT_MARTS_SQL = f"""
    SELECT row_number() OVER (ORDER BY t.trip_id) AS trip_key, t.trip_id AS source_trip_id,
           CAST(strftime(requested_at, '%Y%m%d') AS BIGINT) AS date_key, driver_key, passenger_key,
           f.location_key AS pickup_location_key, g.location_key AS dropoff_location_key, payment_method_key,
           promo_code_key, base_fare, tip_amount, discount_amount,
           base_fare * surge_multiplier + tip_amount - discount_amount AS fare_amount, distance_km,
           CASE WHEN t.status = 'completed'
                THEN round(date_diff('second', requested_at, completed_at) / 60.0::DOUBLE, 6) END AS duration_minutes,
           CAST(1 AS BIGINT) AS trip_count, driver_rating, passenger_rating, surge_multiplier, requested_at
    FROM trips t JOIN ({DIM_DRIVER_SQL}) USING (driver_id) JOIN ({DIM_PASSENGER_SQL}) USING (passenger_id)
    JOIN ({DIM_LOCATION_SQL.format(region=LISTED_SQL)}) f ON f.location_id = t.pickup_location_id
    JOIN ({DIM_LOCATION_SQL.format(region=LISTED_SQL)}) g ON g.location_id = t.dropoff_location_id
    LEFT JOIN ({DIM_PAYMENT_SQL}) m ON m.payment_method_id IS NOT DISTINCT FROM t.payment_method_id
    LEFT JOIN ({DIM_PROMO_SQL}) p ON p.promo_code_id IS NOT DISTINCT FROM t.promo_code_id"""


@query(
    "fct_3",
    FACT_MARTS_SQL,
    doubles="payment_method_key promo_code_key base_fare tip_amount discount_amount fare_amount distance_km "
    "duration_minutes driver_rating passenger_rating surge_multiplier",
)
def fct_3(t):
    fact = star.marts(t, c.now(AS_OF), covered(t))["fact_trips"]
    return fact.withColumn("duration_minutes", F.round(col("duration_minutes"), 6))


@query(
    "fct_4",
    """SELECT t.trip_id, round(base_fare * surge_multiplier + tip_amount - discount_amount, 2) AS fare_amount,
              round(date_diff('second', requested_at, completed_at) / 60.0::DOUBLE, 6) AS duration_minutes,
              x.cancelled_at, x.cancelled_by, x.cancellation_reason
       FROM trips t LEFT JOIN trip_cancellations x USING (trip_id)""",
    doubles="fare_amount duration_minutes",
)
def fct_4(t):
    view = star.v_trips(t.trips, t.trip_cancellations)
    return view.select(
        "trip_id", "fare_amount", F.round("duration_minutes", 6).alias("duration_minutes"), "cancelled_at",
        "cancelled_by", "cancellation_reason",
    )


@query(
    "stg_1",
    """SELECT trip_id, driver_id, passenger_id, pickup_location_id, dropoff_location_id, payment_method_id, promo_code_id,
              base_fare, tip_amount, discount_amount, surge_multiplier, distance_km, status, requested_at, completed_at,
              driver_rating, passenger_rating, CAST(strftime(requested_at, '%Y%m%d') AS BIGINT) AS date_key FROM trips""",
    doubles="payment_method_id promo_code_id base_fare tip_amount discount_amount surge_multiplier distance_km "
    "driver_rating passenger_rating",
)
def stg_1(t):
    return star.stg_trips(t.trips)
