"""Load modes and incremental runs."""

import datetime as dt

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starforge.functions import columns as c
from starforge.operators import loads, quality
from starforge.plans.registry import query
from starforge.session import scratch_path
from starforge.sources import tables
from starforge.streaming import incremental
from starforge.streaming.files import DailyLoad, pending_files

col = F.col
CUT = dt.datetime(1999, 6, 1)
_CUT = "TIMESTAMP '1999-06-01 00:00:00'"


def _earlier(df, ts):
    return df.where(col(ts) < c.now(CUT))


def _later(df, ts):
    return df.where(col(ts) >= c.now(CUT))


# the target holds one row per passenger: the fare of the first trip before the cut
_FIRST = f"""SELECT passenger_id, trip_id, base_fare FROM (SELECT *, row_number() OVER (PARTITION BY passenger_id
             ORDER BY requested_at, trip_id) AS nr FROM trips WHERE requested_at < {_CUT}) WHERE nr = 1"""


def _first_trips(t):
    rows = _earlier(t.trips, "requested_at").select("passenger_id", "trip_id", "base_fare", "requested_at")
    empty = rows.limit(0).drop("requested_at")
    return loads.insert_new(empty, rows, ["passenger_id"], ["requested_at", "trip_id"])


def _later_trips(t):
    return _later(t.trips, "requested_at").select("passenger_id", "trip_id", "base_fare", "requested_at")


@query(
    "lod_1",
    f"""WITH target AS ({_FIRST}), src AS (SELECT passenger_id, trip_id, base_fare FROM (
            SELECT *, row_number() OVER (PARTITION BY passenger_id ORDER BY requested_at, trip_id) AS nr
            FROM trips WHERE requested_at >= {_CUT}) WHERE nr = 1)
        SELECT * FROM target UNION ALL
        SELECT * FROM src WHERE passenger_id NOT IN (SELECT passenger_id FROM target)""",
    doubles="base_fare",
)
def lod_1(t):
    return loads.insert_new(_first_trips(t), _later_trips(t), ["passenger_id"], ["requested_at", "trip_id"])


_UPSERT = f"""WITH target AS ({_FIRST}), src AS (SELECT passenger_id, trip_id, base_fare FROM (
            SELECT *, row_number() OVER (PARTITION BY passenger_id ORDER BY requested_at DESC, trip_id DESC) AS nr
            FROM trips WHERE requested_at >= {_CUT}) WHERE nr = 1)
        SELECT coalesce(s.passenger_id, o.passenger_id) AS passenger_id, {{kept}} AS trip_id,
               coalesce(s.base_fare, o.base_fare) AS base_fare
        FROM target o FULL JOIN src s ON o.passenger_id = s.passenger_id"""


def _changed(t, update):
    """The first trips stored as a table, the later ones written as changes beside it, year by year."""
    table = tables.Table(t.spark, scratch_path(t.spark, "changed"), keys=("passenger_id",), rewrite_share=1.0)
    table.overwrite(_first_trips(t))
    later = _later_trips(t)
    for some in (F.year("requested_at") < 2000, F.year("requested_at") >= 2000):
        table.upsert(later.where(some), ["passenger_id"], update, ["requested_at", "trip_id"])
    return table.read()


@query("lod_2", _UPSERT.format(kept="coalesce(o.trip_id, s.trip_id)"), doubles="base_fare")
def lod_2(t):
    # trip_id plays the surrogate key: it stays with a row that exists already
    return loads.upsert(
        _first_trips(t), _later_trips(t), ["passenger_id"], ["base_fare"], ["requested_at", "trip_id"]
    )


@query("lod_3", _UPSERT.format(kept="coalesce(s.trip_id, o.trip_id)"), doubles="base_fare")
def lod_3(t):
    return loads.load_fact(
        _first_trips(t), _later_trips(t), ["passenger_id"], ["requested_at", "trip_id"], full_reload=True
    )


@query("lod_3_changes", _UPSERT.format(kept="coalesce(s.trip_id, o.trip_id)"), doubles="base_fare")
def lod_3_changes(t):
    """As lod_3, merged when the table is read."""
    return _changed(t, ["trip_id", "base_fare"])


@query("lod_4", "SELECT vehicle_type_id, type_name FROM vehicle_types UNION ALL SELECT driver_id, name FROM drivers")
def lod_4(t):
    table = tables.Table(t.spark, scratch_path(t.spark, "refresh"))
    table.full_refresh(t.passengers.select(col("passenger_id").alias("vehicle_type_id"), col("name").alias("type_name")))
    kinds = t.vehicle_types.select("vehicle_type_id", "type_name")
    people = t.drivers.select(col("driver_id").alias("vehicle_type_id"), col("name").alias("type_name"))
    table.full_refresh(kinds.unionByName(people))
    return table.read()


def _staged(t):
    staging = tables.Staging(
        t.spark, scratch_path(t.spark, "staging"), t.trips.select("trip_id", "driver_id", "status").schema
    )
    rows = t.trips.select("trip_id", "driver_id", "status")
    staging.replace_batch(rows, "run:1")
    staging.replace_batch(rows.where(col("status") == "no_show"), "run:2")
    staging.replace_batch(rows.where(col("status") == "completed"), "run:1")  # a retry replaces its batch
    return staging


@query(
    "lod_5",
    """SELECT 'run:1' AS batch_id, trip_id, driver_id, status FROM trips WHERE status = 'completed'
       UNION ALL SELECT 'run:2', trip_id, driver_id, status FROM trips WHERE status = 'no_show'""",
)
def lod_5(t):
    return _staged(t).read().select("batch_id", "trip_id", "driver_id", "status")


@query("lod_6", "SELECT 'run:2' AS batch_id, trip_id FROM trips WHERE status = 'no_show'")
def lod_6(t):
    staging = _staged(t)
    tables.clean_up([staging], "run:1")
    return staging.read().select("batch_id", "trip_id")


@query(
    "lod_7",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
       WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')
       UNION ALL
       SELECT l_orderkey, l_linenumber, l_partkey, l_quantity * 2 FROM lineitem
       WHERE l_returnflag = 'R' AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""",
    bigints="l_linenumber",
)
def lod_7(t):
    lines = t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")
    changed = t.orders.where(col("o_orderstatus") == "P").select(col("o_orderkey").alias("l_orderkey"))
    fresh = loads.drop_orphans(lines.where(col("l_returnflag") == "R"), changed, "l_orderkey").withColumn(
        "l_quantity", col("l_quantity") * 2
    )
    keep = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
    return loads.replace_children(lines.select(*keep), fresh.select(*keep), changed, "l_orderkey")


@query(
    "lod_8",
    """SELECT ride_id, CASE WHEN driver_name LIKE '%neil-7 %' AND ride_id > 1000 THEN 4.8 ELSE rating END AS rating,
              CASE WHEN driver_name LIKE '%neil-7 %' AND ride_id > 1000 THEN 'checked' ELSE ride_status END AS ride_status
       FROM rides""",
    doubles="rating",
)
def lod_8(t):
    rides = t.rides.select("ride_id", "driver_name", "rating", "ride_status")
    hit = col("driver_name").like("%neil-7 %") & (col("ride_id") > 1000)
    return loads.update_where(rides, hit, rating=F.lit(4.8), ride_status=F.lit("checked")).drop("driver_name")


@query("lod_9", "SELECT ride_id, rating FROM rides WHERE NOT coalesce(rating < 3, false)", doubles="rating")
def lod_9(t):
    return loads.delete_where(t.rides.select("ride_id", "rating"), col("rating") < 3)


@query("lod_10", "SELECT s_suppkey, s_name, coalesce(CAST(NULL AS VARCHAR), 'none') AS phone FROM supplier")
def lod_10(t):
    once = loads.add_column(t.raw("supplier").select("s_suppkey", "s_name"), "phone", "string")
    again = loads.add_column(once, "phone", "string")
    return again.withColumn("phone", F.coalesce("phone", F.lit("none")))


@query(
    "lod_11",
    """SELECT 'fares' AS part, trip_id, base_fare FROM trips WHERE status IN ('completed', 'cancelled')
       UNION ALL SELECT 'tips', trip_id, tip_amount FROM trips WHERE status = 'cancelled'""",
    doubles="base_fare",
)
def lod_11(t):
    fares, tips = (tables.Table(t.spark, scratch_path(t.spark, n)) for n in ("atomic-fares", "atomic-tips"))
    trips = t.trips.select("trip_id", "base_fare", "tip_amount", "status")
    fare = lambda status: trips.where(col("status") == status).select("trip_id", "base_fare")
    tip = lambda status: trips.where(col("status") == status).select("trip_id", col("tip_amount").alias("base_fare"))
    rules = [quality.min_rows(1), quality.no_rows("not_negative", col("base_fare") < 0)]
    fares.overwrite(fare("completed"))
    loads.load_atomic((fares, fare("cancelled"), rules), (tips, tip("cancelled"), rules))
    # the second batch has a bad row, then fails while it is written: of the first nothing may stay either
    negative = F.when(col("trip_id") > 100, col("base_fare")).otherwise(-1 - col("base_fare"))
    fails = F.when(col("trip_id") > 100, col("base_fare")).otherwise(F.raise_error(F.lit("no such fare")))
    for broken in (negative, fails):
        try:
            bad = tip("no_show").withColumn("base_fare", broken.cast("decimal(8,2)"))
            loads.load_atomic((fares, fare("no_show"), rules), (tips, bad, rules))
        except (quality.DataQualityError, PySparkException):
            pass
    return fares.read().select(F.lit("fares").alias("part"), "*").unionByName(
        tips.read().select(F.lit("tips").alias("part"), "*")
    )


# --------------------------------------------------------------------------- incremental


@query(
    "inc_1",
    f"""SELECT CAST(coalesce(max(requested_at), TIMESTAMP '2000-01-01 00:00:00') AS TIMESTAMP) AS mark
        FROM trips WHERE requested_at < {_CUT}""",
)
def inc_1(t):
    mark = incremental.high_water(_earlier(t.trips, "requested_at"), "requested_at")
    return t.spark.range(1).select(c.instant(mark).alias("mark"))


@query(
    "inc_2",
    """SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20')""",
)
def inc_2(t):
    loaded = t.events.where(col("ts") < c.now(dt.datetime(2024, 1, 20)))
    return incremental.newer_than(t.events, "ts", incremental.high_water(loaded, "ts")).select("event_id", "ts")


@query("inc_3", "SELECT event_id, ts, CASE WHEN ts < TIMESTAMP '2024-01-20' THEN 'first' ELSE 'second' END AS run FROM events")
def inc_3(t):
    table = tables.Table(t.spark, scratch_path(t.spark, "runs"))
    events = t.events.select("event_id", "ts")
    first = events.where(col("ts") < c.now(dt.datetime(2024, 1, 20)))
    table.overwrite(first.limit(0).withColumn("run", F.lit("none")))
    for run in ("first", "second", "third"):  # the third run finds nothing new
        source = first if run == "first" else events
        incremental.run_load(table, source.withColumn("run", F.lit(run)), "ts", ["event_id"])
    return table.read()


def _daily_files(t):
    """The rides as CSV files named like the daily ones: part k of a month is its day k."""
    path, parts = scratch_path(t.spark, "daily"), scratch_path(t.spark, "daily-parts")
    rides = t.rides.select("ride_id", "driver_name", "fare_amount", "requested_at")
    # rebalancing splits a month that is too large for one file
    rides.withColumn("month", F.date_format("requested_at", "yyyyMM")).hint("rebalance", "month").write.partitionBy(
        "month"
    ).csv(parts, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    hadoop = t.spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(parts).getFileSystem(t.spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop(path))
    for folder in sorted(s.getPath().toString() for s in fs.listStatus(hadoop(parts)) if "month=" in s.getPath().getName()):
        files = sorted(s.getPath().toString() for s in fs.listStatus(hadoop(folder)) if s.getPath().getName()[:5] == "part-")
        for k, file in enumerate(files, 1):
            fs.rename(hadoop(file), hadoop(f"{path}/rides_{folder[-6:]}{k:02d}.csv"))
    header = "ride_id,driver_name,fare_amount,requested_at\n"
    tables.write_text(t.spark, f"{path}/rides_19700101.csv", header)
    tables.write_text(t.spark, f"{path}/rides_19700102.csv", header + "x,A,1.00,1970-01-02 00:00:00\n-5,B,much,1970-01-02 00:00:00\n")
    tables.write_text(t.spark, f"{path}/rides_19700103.csv.bak", header + "-7,C,1.00,1970-01-03 00:00:00\n")
    return path, rides.schema


@query(
    "src_7",
    """SELECT DISTINCT strftime(requested_at, 'rides_%Y%m01.csv') AS file, strftime(requested_at, '%Y-%m-01') AS day FROM rides
       UNION ALL SELECT 'rides_19700101.csv', '1970-01-01' UNION ALL SELECT 'rides_19700102.csv', '1970-01-02'""",
)
def src_7(t):
    path, _ = _daily_files(t)
    ledger = t.spark.createDataFrame([], "filename string")
    found = pending_files(t.spark, path, ledger)
    first = F.regexp_extract("filename", "_1970|01[.]csv$", 0) != ""  # a split month has more than one file
    return found.where(first).select(col("filename").alias("file"), col("day").cast("string"))


@query(
    "inc_4",
    """SELECT 'row' AS kind, ride_id, driver_name, fare_amount, requested_at FROM rides
       UNION ALL SELECT 'rejected', 2, 'rides_19700102.csv', NULL, NULL
       UNION ALL SELECT 'ledger ' || CAST(strftime(requested_at, '%Y%m') AS VARCHAR), count(*), NULL, NULL, NULL FROM rides GROUP BY 1
       UNION ALL SELECT 'ledger 197001', 0, NULL, NULL, NULL""",
    doubles="fare_amount",
)
def inc_4(t):
    path, schema = _daily_files(t)
    load = DailyLoad(t.spark, path, scratch_path(t.spark, "load"), schema, "ride_id")
    load.run()
    load.run()  # nothing is new
    names = ["kind", "ride_id", "driver_name", "fare_amount", "requested_at"]
    parts = [load.rows().withColumn("kind", F.lit("row"))]
    counted = F.count(F.lit(1)).alias("ride_id")
    parts.append(load.rejected().groupBy(col("filename").alias("driver_name")).agg(counted).withColumn("kind", F.lit("rejected")))
    month = F.concat(F.lit("ledger "), F.substring("filename", 7, 6)).alias("kind")
    parts.append(load.ledger().groupBy(month).agg(F.sum("row_count").alias("ride_id")))
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part, allowMissingColumns=True)
    return first.select(*names)


@query("inc_5", "SELECT event_id, event_type FROM events")
def inc_5(t):
    schema = t.events.select("event_id", "event_type").schema
    staging = tables.Staging(t.spark, scratch_path(t.spark, "stream"), schema)
    copy = scratch_path(t.spark, "events")
    t.events.write.parquet(copy)
    stream = t.spark.readStream.schema(t.events.schema).parquet(copy).select("event_id", "event_type")
    incremental.stage_stream(stream, staging, scratch_path(t.spark, "checkpoint")).awaitTermination()
    return staging.read().select("event_id", "event_type")
