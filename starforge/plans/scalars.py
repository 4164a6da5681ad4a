"""Scalar functions, each over a whole table."""

import datetime as dt

from pyspark.sql import functions as F

from starforge.functions import columns as c
from starforge.operators import star
from starforge.plans.joins import clean_name_sql
from starforge.plans.registry import query

col = F.col


@query("str_1", "SELECT DISTINCT lower(payment_method) AS payment_method FROM rides WHERE payment_method IS NOT NULL")
def str_1(t):
    method = F.lower("payment_method").alias("payment_method")
    return t.rides.where(col("payment_method").isNotNull()).select(method).distinct()


@query("str_2", "SELECT DISTINCT trim(driver_name) AS name FROM rides")
def str_2(t):
    return t.rides.select(F.trim("driver_name").alias("name")).distinct()


@query("str_3", "SELECT ride_id, replace(driver_name, '  ', ' ') AS name FROM rides")
def str_3(t):
    return t.rides.select("ride_id", F.replace("driver_name", F.lit("  "), F.lit(" ")).alias("name"))


@query(
    "str_4",
    """SELECT doc_id, array_to_string(list_transform(
           regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+'),
           lambda w: CASE WHEN w LIKE 'ß%' THEN w ELSE upper(substr(w, 1, 1)) || substr(w, 2) END), '') AS title FROM documents""",
)
def str_4(t):
    return t.documents.select("doc_id", c.title_words(col("text")).alias("title"))


@query("str_5", "SELECT doc_id, regexp_replace(text, '\\s+', ' ', 'g') AS text FROM documents")
def str_5(t):
    return t.documents.select("doc_id", c.collapse_spaces(col("text")).alias("text"))


@query("str_6", f"SELECT DISTINCT {clean_name_sql('driver_name')} AS clean_driver_name FROM rides")
def str_6(t):
    return star.cleaned_names(t.rides, "driver_name").select(col("name").alias("clean_driver_name")).distinct()


@query(
    "str_7",
    """SELECT event_id, lpad(CAST(hour(ts) AS VARCHAR), 2, '0') || ':' || lpad(CAST(minute(ts) AS VARCHAR), 2, '0')
              AS label FROM events""",
)
def str_7(t):
    return t.events.select("event_id", c.clock_label(F.hour("ts"), F.minute("ts")).alias("label"))


@query("str_8", "SELECT doc_id, substr(text, 1, 300) AS head FROM documents")
def str_8(t):
    # cutting is the function itself here: a source list shows the first 300 characters
    return t.documents.select("doc_id", c.first_chars(col("text"), 300).alias("head"))


@query(
    "dat_1",
    """SELECT event_id, date_trunc('hour', ts) AS hour_start, CAST(date_trunc('month', ts) AS TIMESTAMP) AS month_start
       FROM events""",
)
def dat_1(t):
    def cut(unit):
        return F.date_trunc(unit, "ts").cast("timestamp_ntz")

    return t.events.select("event_id", cut("hour").alias("hour_start"), cut("month").alias("month_start"))


@query(
    "dat_2",
    """SELECT o_orderkey, year(o_orderdate) AS yr, quarter(o_orderdate) AS qtr, month(o_orderdate) AS mon,
              day(o_orderdate) AS dom, dayofweek(o_orderdate) AS dow, weekofyear(o_orderdate) AS wk FROM orders""",
)
def dat_2(t):
    d = col("o_orderdate")
    return t.orders.select(
        "o_orderkey", F.year(d).alias("yr"), F.quarter(d).alias("qtr"), F.month(d).alias("mon"),
        F.dayofmonth(d).alias("dom"), c.day_of_week(d).alias("dow"), F.weekofyear(d).alias("wk"),
    )


@query(
    "dat_3",
    """SELECT trip_id, strftime(requested_at, '%Y-%m-%d') AS day, strftime(requested_at, '%b %d, %Y %I:%M %p') AS pretty,
              strftime(requested_at, '%Y-%m') AS month, strftime(requested_at, '%B') AS month_name,
              strftime(requested_at, '%A') AS day_name FROM trips""",
)
def dat_3(t):
    def label(pattern):
        return F.date_format("requested_at", pattern)

    return t.trips.select(
        "trip_id", label("yyyy-MM-dd").alias("day"), label("MMM dd, yyyy hh:mm a").alias("pretty"),
        label("yyyy-MM").alias("month"), label("MMMM").alias("month_name"), label("EEEE").alias("day_name"),
    )


@query("dat_4", "SELECT trip_id, CAST(strftime(requested_at, '%Y%m%d') AS BIGINT) AS date_key FROM trips")
def dat_4(t):
    return t.trips.select("trip_id", c.date_key(col("requested_at")).alias("date_key"))


@query(
    "dat_5",
    """SELECT trip_id, round(CAST(date_diff('second', requested_at, completed_at) AS DECIMAL(18,0)) / 60, 1) AS minutes
       FROM trips""",
)
def dat_5(t):
    return t.trips.select(
        "trip_id", c.minutes_between(col("requested_at"), col("completed_at"), 1).alias("minutes")
    )


@query(
    "dat_6",
    """SELECT driver_id, CASE WHEN joined_at >= TIMESTAMP '2000-08-31' - INTERVAL 6 MONTH THEN '0-6 months'
              WHEN joined_at >= TIMESTAMP '2000-08-31' - INTERVAL 1 YEAR THEN '6-12 months'
              WHEN joined_at >= TIMESTAMP '2000-08-31' - INTERVAL 2 YEAR THEN '1-2 years' ELSE '2+ years' END AS tenure
       FROM drivers""",
)
def dat_6(t):
    return t.drivers.select(
        "driver_id", c.tenure_bucket(col("joined_at"), c.now(dt.datetime(2000, 8, 31))).alias("tenure")
    )


@query(
    "dat_7",
    """SELECT count(*) FILTER (WHERE o_orderdate <= current_localtimestamp()) AS up_to_now,
              count(*) FILTER (WHERE o_orderdate <= TIMESTAMP '1998-01-01') AS up_to_1998 FROM orders""",
)
def dat_7(t):
    return t.orders.agg(
        F.count_if(col("o_orderdate") <= c.now()).alias("up_to_now"),
        F.count_if(col("o_orderdate") <= c.now(dt.datetime(1998, 1, 1))).alias("up_to_1998"),
    )


@query(
    "dat_8",
    "SELECT event_id, CAST(hour(ts) * 100 + minute(ts) // 15 * 15 AS BIGINT) AS time_key FROM events",
)
def dat_8(t):
    return t.events.select("event_id", c.quarter_hour_key(col("ts")).alias("time_key"))


@query("dat_9", "SELECT o_orderkey, CAST(year(o_orderdate) // 10 * 10 AS BIGINT) AS decade FROM orders")
def dat_9(t):
    return t.orders.select("o_orderkey", c.decade(F.year("o_orderdate")).alias("decade"))


@query(
    "mth_1",
    """SELECT trip_id, round(base_fare * surge_multiplier, 1) AS tenths,
              CAST(base_fare * surge_multiplier AS DECIMAL(14,2)) AS cents FROM trips""",
    doubles="tenths cents",
)
def mth_1(t):
    product = col("base_fare") * col("surge_multiplier")
    return t.trips.select(
        "trip_id", F.round(product, 1).alias("tenths"), product.cast("decimal(14,2)").alias("cents")
    )


@query(
    "mth_2",
    """SELECT trip_id, round_even(CAST(base_fare * 100 * surge_multiplier AS DOUBLE), 0) / 100 AS fare FROM trips""",
)
def mth_2(t):
    return t.trips.select("trip_id", F.bround(col("base_fare") * col("surge_multiplier"), 2).alias("fare"))


@query(
    "mth_3",
    """SELECT passenger_id, round(count(*) FILTER (WHERE status = 'cancelled') * 100.0
              / nullif(count(*) FILTER (WHERE status <> 'no_show'), 0), 2) AS pct FROM trips GROUP BY passenger_id""",
    doubles="pct",
)
def mth_3(t):
    counted = t.trips.groupBy("passenger_id").agg(
        F.count_if(col("status") == "cancelled").alias("cancelled"),
        F.count_if(col("status") != "no_show").alias("shown"),
    )
    return counted.select("passenger_id", c.percent_of(col("cancelled"), col("shown")).alias("pct"))


@query(
    "cnd_1",
    """SELECT event_id, CASE WHEN hour(ts) BETWEEN 6 AND 11 THEN 'Morning' WHEN hour(ts) BETWEEN 12 AND 16 THEN 'Afternoon'
              WHEN hour(ts) BETWEEN 17 AND 20 THEN 'Evening' ELSE 'Night' END AS part,
              CASE WHEN value > 80 THEN 'high' WHEN value > 40 THEN 'middle' ELSE 'low' END AS size FROM events""",
)
def cnd_1(t):
    v = col("value")
    size = c.bucket([(v > 80, "high"), (v > 40, "middle")], "low")
    return t.events.select("event_id", c.time_of_day(F.hour("ts")).alias("part"), size.alias("size"))


@query("cnd_2", "SELECT trip_id, coalesce(surge_multiplier, 0) AS surge FROM trips", doubles="surge")
def cnd_2(t):
    return t.trips.select("trip_id", c.or_zero(col("surge_multiplier")).alias("surge"))


@query("cnd_3", "SELECT trip_id, nullif(tip_amount, 0) AS tip FROM trips", doubles="tip")
def cnd_3(t):
    return t.trips.select("trip_id", F.nullif("tip_amount", F.lit(0)).alias("tip"))


@query(
    "cnd_4",
    """SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS quantity, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_day,
              CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS price FROM lineitem""",
)
def cnd_4(t):
    return t.raw("lineitem").select(
        "l_orderkey", col("l_quantity").cast("bigint").alias("quantity"),
        col("l_shipdate").cast("date").cast("string").alias("ship_day"),
        col("l_extendedprice").cast("decimal(12,2)").cast("string").alias("price"),
    )


@query(
    "jsn_1",
    """SELECT load_id, CAST(to_json({'ticket_id': ticket_id, 'subject': subject, 'body': body, 'category': category})
              AS VARCHAR) AS record FROM tickets""",
)
def jsn_1(t):
    return t.tickets.select("load_id", c.record_json("ticket_id", "subject", "body", "category").alias("record"))


@query("jsn_2", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def jsn_2(t):
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


@query("arr_1", "SELECT imdb_id, string_split(nullif(director, 'N/A'), ', ')[1] AS director FROM movies")
def arr_1(t):
    return t.movies.select(col("imdbID").alias("imdb_id"), c.first_listed(c.known(col("Director"))).alias("director"))


@query("arr_2", "SELECT imdb_id, unnest(string_split(genre, ', ')) AS genre FROM movies")
def arr_2(t):
    return t.movies.select(col("imdbID").alias("imdb_id"), F.explode(F.split("Genre", ", ")).alias("genre"))


@query("arr_3", "SELECT imdb_id, rotten FROM movies")
def arr_3(t):
    return t.movies.select(
        col("imdbID").alias("imdb_id"), c.pick(col("Ratings"), "Source", "Rotten Tomatoes")["Value"].alias("rotten")
    )


@query(
    "prs_1",
    """SELECT imdb_id, CAST(replace(nullif(runtime, 'N/A'), ' min', '') AS BIGINT) AS minutes,
              CAST(replace(imdb_votes, ',', '') AS BIGINT) AS votes,
              CAST(replace(replace(nullif(box_office, 'N/A'), ',', ''), '$', '') AS DOUBLE) AS usd,
              CAST(replace(rotten, '%', '') AS BIGINT) AS pct FROM movies""",
    doubles="minutes pct",
)
def prs_1(t):
    rotten = c.pick(col("Ratings"), "Source", "Rotten Tomatoes")["Value"]
    return t.movies.select(
        col("imdbID").alias("imdb_id"), c.minutes_text(col("Runtime")).alias("minutes"),
        c.comma_number(col("imdbVotes")).alias("votes"), c.dollars(col("BoxOffice")).alias("usd"),
        c.percent_text(rotten).alias("pct"),
    )
