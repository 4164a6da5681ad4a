"""Aggregation queries."""

import datetime as dt

from pyspark.sql import functions as F

from starforge.functions import columns as c
from starforge.operators import relational as r
from starforge.operators import star
from starforge.plans.registry import query

col = F.col

SCORECARD_SQL = """
    SELECT d.driver_id, d.name AS driver_name,
           count(t.trip_id) AS total_trips,
           count(*) FILTER (WHERE t.status = 'completed') AS completed_trips,
           count(*) FILTER (WHERE t.status = 'cancelled') AS cancelled_trips,
           CAST(sum(t.driver_rating) * 1.0 / nullif(count(t.driver_rating), 0) AS DECIMAL(3,2)) AS avg_rating,
           CAST(round(count(*) FILTER (WHERE t.status = 'cancelled') * 100.0
                / nullif(count(t.trip_id), 0), 2) AS DECIMAL(5,2)) AS cancellation_rate
    FROM drivers d LEFT JOIN trips t ON t.driver_id = d.driver_id {on}
    GROUP BY d.driver_id, d.name"""


@query(
    "agg_1",
    """SELECT count(*) AS n_rows, count(rating) AS n_values, CAST(sum(rating) AS DECIMAL(18,2)) AS total,
              round(CAST(avg(rating) AS DOUBLE), 6) AS average,
              min(ride_distance_km) AS shortest, max(ride_distance_km) AS longest FROM rides""",
    doubles="total shortest longest",
)
def agg_1(t):
    return (
        r.totals(t.rides, "rating", "ride_distance_km")
        .withColumn("total", col("total").cast("decimal(18,2)"))
        .withColumn("average", F.round(col("average").cast("double"), 6))
    )


@query(
    "agg_2",
    """SELECT driver_name, ride_status, count(*) AS n_rows, CAST(sum(fare_amount) AS DECIMAL(18,2)) AS total
       FROM rides GROUP BY driver_name, ride_status""",
    doubles="total",
)
def agg_2(t):
    return r.group_totals(t.rides, ["driver_name", "ride_status"], "fare_amount").withColumn(
        "total", col("total").cast("decimal(18,2)")
    )


@query(
    "agg_3",
    """SELECT pickup_city, count(*) AS total_rides, CAST(sum(fare_amount) AS DECIMAL(18,2)) AS total_revenue,
              CAST(round(sum(fare_amount) / count(*), 2) AS DECIMAL(18,2)) AS avg_fare
       FROM rides GROUP BY pickup_city""",
    doubles="total_revenue avg_fare",
)
def agg_3(t):
    return r.revenue_by(t.rides, "pickup_city", "fare_amount").select(
        "pickup_city",
        "total_rides",
        col("total_revenue").cast("decimal(18,2)").alias("total_revenue"),
        col("avg_fare").cast("decimal(18,2)").alias("avg_fare"),
    )


@query(
    "agg_4",
    """SELECT driver_name, count(*) AS completed_rides FROM rides WHERE ride_status = 'completed'
       GROUP BY driver_name HAVING count(*) > 15""",
)
def agg_4(t):
    return r.having_count(t.rides.where(col("ride_status") == "completed"), ["driver_name"], 15, "completed_rides")


@query(
    "agg_5",
    """SELECT ride_status, count(*) AS ride_count,
              CAST(round(sum(ride_distance_km) / count(*), 2) AS DECIMAL(10,2)) AS avg_distance_km
       FROM rides GROUP BY ride_status""",
    doubles="avg_distance_km",
)
def agg_5(t):
    return r.status_profile(t.rides, "ride_status", "ride_distance_km").withColumn(
        "avg_distance_km", col("avg_distance_km").cast("decimal(10,2)")
    )


@query(
    "agg_6",
    """SELECT count(*) AS total_rides, count(rating) AS rated_rides,
              count(*) FILTER (WHERE rating IS NULL) AS unrated_rides FROM rides""",
)
def agg_6(t):
    return r.rated_counts(t.rides, "rating")


def _outcomes():
    return dict(completed=col("status") == "completed", cancelled=col("status") == "cancelled")


@query(
    "agg_7",
    """SELECT driver_id, count(trip_id) FILTER (WHERE status = 'completed') AS completed,
              count(trip_id) FILTER (WHERE status = 'cancelled') AS cancelled FROM trips GROUP BY driver_id""",
)
def agg_7(t):
    return r.count_where(t.trips, "driver_id", **_outcomes())


@query(
    "agg_8",
    """SELECT driver_id, count(CASE WHEN status = 'completed' THEN 1 END) AS completed,
              count(CASE WHEN status = 'cancelled' THEN 1 END) AS cancelled FROM trips GROUP BY driver_id""",
)
def agg_8(t):
    return r.count_case(t.trips, "driver_id", **_outcomes())


@query("agg_9", SCORECARD_SQL.format(on=""), doubles="avg_rating cancellation_rate")
def agg_9(t):
    return r.scorecard(t.drivers, t.trips)


@query("agg_10", f"SELECT * FROM ({SCORECARD_SQL.format(on='')}) WHERE cancellation_rate > 35", doubles="avg_rating cancellation_rate")
def agg_10(t):
    return r.cancellation_above(t.drivers, t.trips, 35)


@query(
    "agg_11",
    """SELECT count(DISTINCT replace(driver_name, '  ', ' ')) AS names,
              count(DISTINCT lower(trim(driver_name))) AS folded FROM rides""",
)
def agg_11(t):
    d = col("driver_name")
    return r.count_distinct(t.rides, names=F.replace(d, F.lit("  "), F.lit(" ")), folded=F.lower(F.trim(d)))


@query(
    "agg_12",
    """SELECT ride_distance_km, min(fare_amount) AS lowest, max(fare_amount) AS highest
       FROM rides GROUP BY ride_distance_km""",
    doubles="ride_distance_km lowest highest",
)
def agg_12(t):
    return r.min_max_by(t.rides, "ride_distance_km", "fare_amount")


@query(
    "agg_13",
    """SELECT pc.promo_code_id, pc.code, pc.discount_type, pc.discount_value, pc.is_active,
              count(t.trip_id) AS times_used
       FROM promo_codes pc LEFT JOIN trips t USING (promo_code_id) GROUP BY ALL""",
    doubles="discount_value",
)
def agg_13(t):
    return r.usage_count(t.promo_codes, t.trips, "promo_code_id", "times_used")


@query(
    "agg_14",
    """SELECT coalesce(max(requested_at), TIMESTAMP '2000-01-01 00:00:00') AS mark,
              coalesce(max(requested_at) FILTER (WHERE status = 'unheard of'), TIMESTAMP '2000-01-01 00:00:00')
                AS empty_mark FROM trips""",
)
def agg_14(t):
    default = c.now(dt.datetime(2000, 1, 1))
    mark = r.max_or(t.trips, "requested_at", default, "mark")
    empty = r.max_or(t.trips.where(col("status") == "unheard of"), "requested_at", default, "empty_mark")
    return mark.select("mark", empty.scalar().alias("empty_mark"))


@query(
    "agg_15",
    """SELECT year(requested_at) AS yr, status, count(*) AS trips,
              round(CAST(sum(surge_multiplier) AS DOUBLE) / count(surge_multiplier), 6) AS avg_surge
       FROM trips GROUP BY year(requested_at), status""",
)
def agg_15(t):
    fact = t.trips.withColumn("trip_count", F.lit(1)).withColumn("yr", F.year("requested_at").cast("bigint"))
    return r.ratio_profile(fact, ["yr", "status"]).withColumn(
        "avg_surge", F.round(col("avg_surge").cast("double"), 6)
    )


@query(
    "agg_18",
    "SELECT date_trunc('day', ts) AS bucket, count(*) AS n_rows FROM events GROUP BY date_trunc('day', ts)",
)
def agg_18(t):
    return r.count_per(t.events, "day", "ts")


@query(
    "flagship",
    f"""SELECT * FROM (
        SELECT d.driver_id, d.name AS driver_name, count(t.trip_id) AS total_trips,
               count(*) FILTER (WHERE t.status = 'completed') AS completed_trips,
               count(*) FILTER (WHERE t.status = 'cancelled') AS cancelled_trips,
               CAST(sum(t.driver_rating) * 1.0 / nullif(count(t.driver_rating), 0) AS DECIMAL(3,2)) AS avg_rating,
               CAST(round(count(*) FILTER (WHERE t.status = 'cancelled') * 100.0
                    / nullif(count(t.trip_id), 0), 2) AS DECIMAL(5,2)) AS cancellation_rate
        FROM drivers d LEFT JOIN (
            SELECT t.* FROM trips t
            JOIN drivers USING (driver_id) JOIN passengers USING (passenger_id)
            JOIN locations p ON p.location_id = t.pickup_location_id
            JOIN locations f ON f.location_id = t.dropoff_location_id
            LEFT JOIN payment_methods m ON m.payment_method_id = t.payment_method_id
            LEFT JOIN promo_codes c ON c.promo_code_id = t.promo_code_id
            WHERE t.requested_at >= TIMESTAMP '1995-01-01' AND t.requested_at < TIMESTAMP '2001-01-01'
              AND (t.payment_method_id IS NULL OR m.payment_method_id IS NOT NULL)
              AND (t.promo_code_id IS NULL OR c.promo_code_id IS NOT NULL)
        ) t ON t.driver_id = d.driver_id
        GROUP BY d.driver_id, d.name)""",
    doubles="avg_rating cancellation_rate",
)
def flagship(t):
    """Resolve every trip against the dimensions, then score the drivers over the trips that resolve."""
    days = star.calendar(t.spark, dt.date(1995, 1, 1), dt.date(2000, 12, 31))
    dims = star.etl_lookups(t, days)
    resolved = star.resolve_trips(t.trips, dims)
    good = resolved.where(col("skip_reason").isNull())
    return r.scorecard(t.drivers, good)
