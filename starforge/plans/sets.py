"""Sorting, set operations and subqueries."""

from pyspark.sql import functions as F

from starforge.operators import relational as r
from starforge.operators import windows as w
from starforge.plans.registry import query

col = F.col


@query(
    "srt_1",
    """SELECT driver_id, status, count(*) AS n_rows FROM trips GROUP BY driver_id, status
       ORDER BY driver_id DESC, status""",
)
def srt_1(t):
    grouped = t.trips.groupBy("driver_id", "status").agg(F.count(F.lit(1)).alias("n_rows"))
    return grouped.orderBy(*r.order_by("-driver_id", "status"))


@query(
    "srt_2",
    """SELECT driver_name, passenger_name, fare_amount FROM rides
       ORDER BY fare_amount DESC NULLS FIRST, ride_id LIMIT 5""",
    doubles="fare_amount",
)
def srt_2(t):
    rides = t.rides.select("ride_id", "driver_name", "passenger_name", "fare_amount")
    return r.top_k(rides, ["-fare_amount", "ride_id"], 5).drop("ride_id")


@query("srt_3", "SELECT driver_id, name FROM drivers ORDER BY driver_id LIMIT 4 OFFSET 2")
def srt_3(t):
    return w.page(t.drivers.select("driver_id", "name"), ["driver_id"], 2, 4)


@query(
    "srt_3_deep",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
       ORDER BY l_quantity DESC, l_orderkey, l_linenumber, l_partkey LIMIT 500 OFFSET 20000""",
    bigints="l_linenumber",
)
def srt_3_deep(t):
    lines = t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return w.page(lines, ["-l_quantity", "l_orderkey", "l_linenumber", "l_partkey"], 20_000, 500).drop("l_partkey")


@query("set_1", "SELECT pickup_city AS city FROM rides UNION SELECT dropoff_city FROM rides")
def set_1(t):
    return t.rides.select(col("pickup_city").alias("city")).union(t.rides.select("dropoff_city")).distinct()


@query("set_2", "SELECT code FROM promo_codes UNION ALL SELECT 'No Promo' UNION ALL SELECT name FROM drivers")
def set_2(t):
    sentinel = t.spark.range(1).select(F.lit("No Promo").alias("code"))
    return (
        t.promo_codes.select("code").unionByName(sentinel).unionByName(t.drivers.select(col("name").alias("code")))
    )


@query("set_3", "SELECT l_partkey AS k FROM lineitem INTERSECT SELECT o_orderkey FROM orders")
def set_3(t):
    return t.raw("lineitem").select(col("l_partkey").alias("k")).intersect(t.orders.select("o_orderkey"))


@query("set_4", "SELECT pickup_city AS city FROM rides EXCEPT SELECT dropoff_city FROM rides")
def set_4(t):
    return t.rides.select(col("pickup_city").alias("city")).subtract(t.rides.select("dropoff_city"))


@query("set_5", "SELECT DISTINCT driver_name, payment_method FROM rides")
def set_5(t):
    return t.rides.select("driver_name", "payment_method").distinct()


@query(
    "sub_1",
    """SELECT ride_id, driver_name, fare_amount FROM rides
       WHERE fare_amount > (SELECT sum(fare_amount) / count(fare_amount) FROM rides)""",
    doubles="fare_amount",
)
def sub_1(t):
    return r.above_average(t.rides.select("ride_id", "driver_name", "fare_amount"), "fare_amount")


@query(
    "sub_2",
    """SELECT driver_id, trip_id, distance_km FROM trips t
       WHERE distance_km = (SELECT max(u.distance_km) FROM trips u WHERE u.driver_id = t.driver_id)""",
    doubles="distance_km",
)
def sub_2(t):
    return r.rows_at_group_max(t.trips.select("driver_id", "trip_id", "distance_km"), "driver_id", "distance_km")


@query(
    "sub_3",
    """SELECT ride_id, (SELECT l.location_id FROM locations l
                        WHERE 'City ' || CAST(l.location_id AS VARCHAR) = r.pickup_city) AS pickup_location_id
       FROM rides r""",
    doubles="pickup_location_id",
)
def sub_3(t):
    cities = t.locations.select("location_id", F.concat(F.lit("City "), col("location_id")).alias("city"))
    rides = t.rides.select("ride_id", "pickup_city")
    return r.scalar_lookup(rides, cities, ("pickup_city", "city"), "location_id", "pickup_location_id").drop(
        "pickup_city"
    )


@query(
    "sub_4",
    """SELECT trip_id, driver_id, status FROM trips
       UNION ALL
       SELECT (SELECT max(o_orderkey) FROM orders) + 1 + s_suppkey,
              (SELECT d.driver_id FROM drivers d WHERE d.name = s.s_name), 'no_show' FROM supplier s""",
)
def sub_4(t):
    # new rows know their driver only by name; the id is looked up before they are appended
    last = t.orders.agg(F.max("o_orderkey")).scalar()
    new = t.raw("supplier").select(
        (last + 1 + col("s_suppkey")).alias("trip_id"), "s_name", F.lit("no_show").alias("status")
    )
    resolved = r.scalar_lookup(new, t.drivers, ("s_name", "name"), "driver_id", "driver_id").drop("s_name")
    return t.trips.select("trip_id", "driver_id", "status").unionByName(resolved)


@query(
    "sub_5",
    """WITH per_driver AS (SELECT driver_id, count(*) AS n, sum(base_fare) AS total FROM trips GROUP BY driver_id),
            busy AS (SELECT * FROM per_driver WHERE n > 100)
       SELECT d.name, busy.n, busy.total FROM busy JOIN drivers d USING (driver_id)""",
    doubles="total",
)
def sub_5(t):
    per_driver = t.trips.groupBy("driver_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("base_fare").alias("total")
    )
    busy = per_driver.where(col("n") > 100)
    return busy.join(t.drivers, "driver_id").select("name", "n", "total")
