"""Join queries."""

from pyspark.sql import functions as F

from starforge.functions import columns as c
from starforge.operators import relational as r
from starforge.operators import star
from starforge.plans.registry import query

col = F.col


@query(
    "joi_1",
    """SELECT d.name AS driver_name, v.type_name, v.base_fare
       FROM drivers d JOIN vehicle_types v ON d.vehicle_type_id = v.vehicle_type_id""",
    doubles="base_fare",
)
def joi_1(t):
    return t.drivers.join(t.vehicle_types, "vehicle_type_id").select(
        col("name").alias("driver_name"), "type_name", "base_fare"
    )


@query(
    "joi_2",
    """SELECT 'inner' AS form, t.trip_id, d.name AS driver_name, p.name AS passenger_name, f.city_name AS pickup_city,
              g.city_name AS dropoff_city, t.base_fare, t.requested_at
       FROM trips t JOIN drivers d USING (driver_id) JOIN passengers p USING (passenger_id)
       JOIN locations f ON f.location_id = t.pickup_location_id
       JOIN locations g ON g.location_id = t.dropoff_location_id
       UNION ALL
       SELECT 'left', t.trip_id, d.name, p.name, f.city_name, g.city_name, t.base_fare, t.requested_at
       FROM trips t LEFT JOIN drivers d USING (driver_id) LEFT JOIN passengers p USING (passenger_id)
       LEFT JOIN locations f ON f.location_id = t.pickup_location_id
       LEFT JOIN locations g ON g.location_id = t.dropoff_location_id""",
    doubles="base_fare",
)
def joi_2(t):
    def log(how):
        return r.trip_log(t.trips, t.drivers, t.passengers, t.locations, how).select(
            F.lit(how).alias("form"), "trip_id", "driver_name", "passenger_name", "pickup_city", "dropoff_city",
            "base_fare", "requested_at",
        )

    return log("inner").unionByName(log("left"))


@query(
    "joi_3",
    """SELECT d.name AS driver_name, v.type_name FROM drivers d LEFT JOIN vehicle_types v USING (vehicle_type_id)""",
)
def joi_3(t):
    return t.drivers.join(t.vehicle_types, "vehicle_type_id", "left").select(
        col("name").alias("driver_name"), "type_name"
    )


@query(
    "joi_4",
    """SELECT d.name AS driver_name, v.type_name FROM drivers d RIGHT JOIN vehicle_types v USING (vehicle_type_id)""",
)
def joi_4(t):
    return t.drivers.join(t.vehicle_types, "vehicle_type_id", "right").select(
        col("name").alias("driver_name"), "type_name"
    )


@query(
    "joi_5",
    """SELECT d.name AS driver_name, v.type_name FROM drivers d
       FULL OUTER JOIN vehicle_types v ON d.vehicle_type_id = v.vehicle_type_id""",
)
def joi_5(t):
    return r.full_join(t.drivers, t.vehicle_types, "vehicle_type_id").select(
        col("name").alias("driver_name"), "type_name"
    )


@query(
    "joi_6",
    """SELECT d.name AS driver_name, v.type_name, v.base_fare FROM drivers d
       LEFT JOIN vehicle_types v ON d.vehicle_type_id = v.vehicle_type_id AND v.base_fare > 100""",
    doubles="base_fare",
)
def joi_6(t):
    # the condition belongs to the join: on the result it would drop drivers without a type
    dear = t.vehicle_types.where(col("base_fare") > 100)
    return t.drivers.join(dear, "vehicle_type_id", "left").select(
        col("name").alias("driver_name"), "type_name", "base_fare"
    )


@query(
    "joi_7",
    """SELECT o.o_orderkey, o.o_custkey FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
       WHERE l.l_orderkey IS NULL""",
)
def joi_7(t):
    return r.anti(t.orders.select("o_orderkey", "o_custkey"), t.raw("lineitem"), "o_orderkey", "l_orderkey")


@query("joi_8", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def joi_8(t):
    return r.not_in(t.orders.select("o_orderkey"), t.raw("lineitem"), "o_orderkey", "l_orderkey")


@query(
    "joi_9",
    """SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 50)""",
)
def joi_9(t):
    big = t.raw("lineitem").where(col("l_quantity") >= 50)
    return r.semi(t.raw("part").select("p_partkey", "p_name"), big, "p_partkey", "l_partkey")


@query(
    "joi_10",
    """SELECT t.trip_id, t.payment_method_id, m.name AS method FROM trips t
       JOIN (SELECT payment_method_id, name FROM payment_methods UNION ALL SELECT NULL, 'Unknown') m
         ON t.payment_method_id IS NOT DISTINCT FROM m.payment_method_id""",
    doubles="payment_method_id",
)
def joi_10(t):
    methods = star.dim_payment_method(t.payment_methods).select("payment_method_id", col("name").alias("method"))
    trips = t.trips.select("trip_id", "payment_method_id")
    return r.join_null_safe(trips, methods, ["payment_method_id"])


_CLEAN = "array_to_string(list_transform(string_split(lower(trim(regexp_replace({c}, '\\s+', ' ', 'g'))), ' '), lambda w: {w}), ' ')"
_WORD = (
    "array_to_string(list_transform(string_split(w, '-'), lambda x: array_to_string(list_transform(string_split(x, ''''),"
    " lambda y: upper(substr(y, 1, 1)) || substr(y, 2)), '''')), '-')"
)


def clean_name_sql(column: str) -> str:
    """Check side of the canonical name: spaces, hyphens and apostrophes separate words."""
    return _CLEAN.format(c=column, w=_WORD)


@query(
    "joi_11",
    f"""SELECT r.ride_id, d.driver_id FROM
        (SELECT ride_id, {clean_name_sql('driver_name')} AS clean FROM rides) r
        JOIN (SELECT 'Driver O''Neil-' || CAST(driver_id AS VARCHAR) AS clean, driver_id FROM drivers) d
        ON r.clean = d.clean""",
)
def joi_11(t):
    names = t.drivers.select(F.concat(F.lit("Driver O'Neil-"), col("driver_id")).alias("clean"), "driver_id")
    rides = t.rides.select("ride_id", "driver_name")
    return r.join_clean_key(rides, names, c.clean_name(col("driver_name")), "clean").select("ride_id", "driver_id")


@query("joi_12", "SELECT trip_id, driver_id, cancelled_by FROM trips JOIN trip_cancellations USING (trip_id)")
def joi_12(t):
    return t.trips.join(t.trip_cancellations, "trip_id").select("trip_id", "driver_id", "cancelled_by")


@query(
    "joi_13",
    """SELECT h.n AS hour, m.n AS minute_bucket, count(trip_id) AS trips
       FROM (SELECT unnest(generate_series(0, 23)) AS n) h
       CROSS JOIN (SELECT unnest(generate_series(0, 45, 15)) AS n) m
       LEFT JOIN trips t ON hour(t.requested_at) = h.n AND minute(t.requested_at) // 15 * 15 = m.n
       GROUP BY h.n, m.n""",
)
def joi_13(t):
    buckets = r.cross_series(t.spark, hour=(0, 23, 1), minute_bucket=(0, 45, 15))
    buckets = buckets.withColumn("time_key", col("hour") * 100 + col("minute_bucket"))
    used = t.trips.groupBy(c.quarter_hour_key(col("requested_at")).alias("time_key")).agg(
        F.count(F.lit(1)).alias("trips")
    )
    return buckets.join(used, "time_key", "left").select(
        "hour", "minute_bucket", c.or_zero(col("trips")).alias("trips")
    )


@query(
    "joi_14",
    """SELECT CASE WHEN payment_method_id IS NOT NULL AND m.k IS NULL THEN 'unknown payment_method' END AS reason,
              count(*) AS n_rows FROM trips t
       LEFT JOIN (SELECT payment_method_id AS k FROM payment_methods) m ON m.k = t.payment_method_id
       GROUP BY 1""",
)
def joi_14(t):
    found = r.look_up(
        t.trips, t.payment_methods, {"payment_method_id": "payment_method_id"}, {"method": "name"}
    )
    unknown = col("payment_method_id").isNotNull() & col("method").isNull()
    return found.groupBy(F.when(unknown, "unknown payment_method").alias("reason")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query(
    "joi_15",
    """SELECT p_partkey, n_lines, quantity, n_trips FROM part
       LEFT JOIN (SELECT l_partkey AS p_partkey, count(*) AS n_lines, sum(l_quantity) AS quantity
                  FROM lineitem GROUP BY l_partkey) USING (p_partkey)
       LEFT JOIN (SELECT promo_code_id AS p_partkey, count(*) AS n_trips FROM trips GROUP BY promo_code_id)
         USING (p_partkey)""",
)
def joi_15(t):
    lines = t.raw("lineitem").groupBy(col("l_partkey").alias("p_partkey")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("quantity")
    )
    trips = t.trips.groupBy(col("promo_code_id").alias("p_partkey")).agg(F.count(F.lit(1)).alias("n_trips"))
    return r.aggregate_then_join(t.raw("part").select("p_partkey"), "p_partkey", lines, trips)
