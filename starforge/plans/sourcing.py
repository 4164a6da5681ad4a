"""Readers and sinks."""

import datetime as dt

from pyspark.sql import functions as F

from starforge.functions import columns as c
from starforge.operators import relational as r
from starforge.plans.registry import query
from starforge.session import scratch_path
from starforge.sources import readers, tables

col = F.col

_SPACES = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


@query(
    "src_1",
    "SELECT * FROM rides",
    doubles="fare_amount ride_distance_km rating",
)
def src_1(t):
    path = scratch_path(t.spark, "rides-csv")
    t.rides.write.options(header=True, **_SPACES).csv(path)
    return readers.read_csv(t.spark, path, t.rides.schema)


@query(
    "src_2",
    """SELECT trim(ticket_id) AS ticket_id, coalesce(subject, '') AS subject, coalesce(body, '') AS body,
              nullif(response, '') AS response, true AS named_after_a_file,
              TIMESTAMP '2026-01-02 03:04:05' AS ingested_at FROM tickets""",
)
def src_2(t):
    path = scratch_path(t.spark, "tickets-csv")
    fields = ["ticket_id", "subject", "body", "response"]
    rows = t.tickets.select(F.trim("ticket_id").alias("ticket_id"), *fields[1:])
    rows.write.options(header=True, escape='"', quoteAll=True, **_SPACES).csv(path)
    landed = readers.land_csv(t.spark, path, fields, c.now(dt.datetime(2026, 1, 2, 3, 4, 5)))
    return landed.select(*fields, F.col("source").rlike("^part-.*[.]csv$").alias("named_after_a_file"), "ingested_at")


@query("src_3", "SELECT c_custkey, c_mktsegment FROM customer")
def src_3(t):
    return readers.scan(t.spark, f"{t.dir}/customer.parquet", ["c_custkey", "c_mktsegment"])


@query(
    "src_4",
    """SELECT 'drivers' AS table_name, driver_id AS id, name AS label FROM drivers UNION ALL
       SELECT 'passengers', passenger_id, name FROM passengers UNION ALL
       SELECT 'locations', location_id, city_name FROM locations UNION ALL
       SELECT 'payment_methods', payment_method_id, name FROM payment_methods UNION ALL
       SELECT 'promo_codes', promo_code_id, code FROM promo_codes UNION ALL
       SELECT 'trips', trip_id, status FROM trips UNION ALL
       SELECT 'trip_cancellations', trip_id, cancelled_by FROM trip_cancellations""",
)
def src_4(t):
    labels = {
        "drivers": ("driver_id", "name"),
        "passengers": ("passenger_id", "name"),
        "locations": ("location_id", "city_name"),
        "payment_methods": ("payment_method_id", "name"),
        "promo_codes": ("promo_code_id", "code"),
        "trips": ("trip_id", "status"),
        "trip_cancellations": ("trip_id", "cancelled_by"),
    }
    landed = readers.land_raw({n: getattr(t, n) for n in labels}, scratch_path(t.spark, "raw"))
    out = None
    for name, (key, label) in labels.items():
        part = landed[name].select(F.lit(name).alias("table_name"), col(key).alias("id"), col(label).alias("label"))
        out = part if out is None else out.unionByName(part)
    return out


@query("src_5", "SELECT imdb_id, title, genre, rotten FROM movies")
def src_5(t):
    path = scratch_path(t.spark, "movies")
    t.movies.write.json(path)
    raw = readers.read_movies(t.spark, path, "part-*.json", whole_files=False)
    rotten = c.pick(col("Ratings"), "Source", "Rotten Tomatoes")["Value"]
    return raw.select(
        col("imdbID").alias("imdb_id"), col("Title").alias("title"), col("Genre").alias("genre"), rotten.alias("rotten")
    )


@query("src_6", "SELECT trip_id, status FROM trips WHERE requested_at >= TIMESTAMP '1999-01-01'")
def src_6(t):
    trips = t.trips.select("trip_id", "status", "requested_at")
    later = col("requested_at") >= F.lit("1999-01-01").cast("timestamp_ntz")
    staging = tables.Staging(t.spark, scratch_path(t.spark, "staging"), trips.schema)
    staging.replace_batch(trips.where(later), "late")
    staging.replace_batch(trips.where(~later), "early")
    return staging.read_batch("late").select("trip_id", "status")


@query("snk_1", "SELECT n_nationkey AS id, n_name AS name FROM nation UNION ALL SELECT r_regionkey, r_name FROM region", bigints="id")
def snk_1(t):
    path = scratch_path(t.spark, "append")
    tables.append(t.raw("nation").select(col("n_nationkey").alias("id"), col("n_name").alias("name")), path)
    tables.append(t.raw("region").select(col("r_regionkey").alias("id"), col("r_name").alias("name")), path)
    return t.spark.read.parquet(path)


@query("snk_2", "SELECT o_orderkey, o_orderpriority FROM orders")
def snk_2(t):
    path = scratch_path(t.spark, "overwrite")
    tables.overwrite(t.raw("nation"), path)
    tables.overwrite(t.orders.select("o_orderkey", "o_orderpriority"), path)
    return t.spark.read.parquet(path)


@query("snk_3", "SELECT ride_id, driver_name FROM rides")
def snk_3(t):
    return tables.create_table_as(t.rides.select("ride_id", "driver_name"), scratch_path(t.spark, "ctas"))


@query(
    "snk_4",
    """SELECT d.name AS driver_name, p.name AS passenger_name, f.city_name AS pickup_city, g.city_name AS dropoff_city,
              t.requested_at
       FROM trips t JOIN drivers d USING (driver_id) JOIN passengers p USING (passenger_id)
       JOIN locations f ON f.location_id = t.pickup_location_id
       JOIN locations g ON g.location_id = t.dropoff_location_id WHERE t.status = 'completed'""",
)
def snk_4(t):
    done = t.trips.where(col("status") == "completed")
    detail = r.trip_log(done, t.drivers, t.passengers, t.locations)
    tables.as_view(detail, "completed_trips_detail")
    return t.spark.sql(
        "SELECT driver_name, passenger_name, pickup_city, dropoff_city, requested_at FROM completed_trips_detail"
    )


def report(rows, template: str, *cols):
    """One formatted line per row."""
    return rows.select(F.format_string(template, *cols).alias("line"))


@query(
    "snk_5",
    """SELECT rpad(pickup_city, 15, ' ') || ' | rides: ' || lpad(CAST(count(*) AS VARCHAR), 4, ' ')
              || ' | revenue: NPR ' || format('{:,.2f}', CAST(sum(fare_amount) AS DOUBLE))
              || ' | avg fare: NPR ' || format('{:,.2f}', round(sum(fare_amount) / count(*), 2)) AS line
       FROM rides GROUP BY pickup_city""",
)
def snk_5(t):
    # Fixed value: the layout of a report line.
    layout = "%-15s | rides: %4d | revenue: NPR %s | avg fare: NPR %s"
    rows = r.revenue_by(t.rides, "pickup_city", "fare_amount")
    return report(
        rows, layout, "pickup_city", "total_rides", F.format_number("total_revenue", 2), F.format_number("avg_fare", 2)
    )
