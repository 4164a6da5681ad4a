"""Window queries."""

from pyspark.sql import functions as F

from starforge.operators import movies
from starforge.operators import windows as w
from starforge.plans.registry import query

col = F.col


@query(
    "win_1",
    """SELECT driver_id, trip_id, requested_at,
              row_number() OVER (PARTITION BY driver_id ORDER BY requested_at, trip_id) AS trip_number FROM trips""",
)
def win_1(t):
    trips = t.trips.select("driver_id", "trip_id", "requested_at")
    return w.number_rows(trips, ["driver_id"], ["requested_at", "trip_id"], "trip_number")


@query(
    "win_2",
    """SELECT trip_id, distance_km, rank() OVER (ORDER BY distance_km DESC) AS rnk,
              dense_rank() OVER (ORDER BY distance_km DESC) AS dense_rnk FROM trips""",
    doubles="distance_km",
)
def win_2(t):
    return w.ranked(t.trips.select("trip_id", "distance_km"), "-distance_km")


@query(
    "win_3",
    """SELECT passenger_id, trip_id, requested_at,
              sum(base_fare) OVER (PARTITION BY passenger_id ORDER BY requested_at) AS running_total
       FROM trips""",
    doubles="running_total",
)
def win_3(t):
    trips = t.trips.select("passenger_id", "trip_id", "requested_at", "base_fare")
    out = w.running_sum(trips, ["passenger_id"], ["requested_at"], "base_fare", "running_total")
    return out.drop("base_fare")


@query(
    "win_4",
    """SELECT driver_id, trip_id, base_fare,
              lag(base_fare) OVER (PARTITION BY driver_id ORDER BY requested_at, trip_id) AS prev_fare,
              base_fare - lag(base_fare) OVER (PARTITION BY driver_id ORDER BY requested_at, trip_id) AS change
       FROM trips""",
    doubles="base_fare prev_fare change",
)
def win_4(t):
    trips = t.trips.select("driver_id", "trip_id", "requested_at", "base_fare")
    out = w.with_prev(trips, ["driver_id"], ["requested_at", "trip_id"], "base_fare", "prev_fare")
    return out.withColumn("change", col("base_fare") - col("prev_fare")).drop("requested_at")


@query(
    "win_5",
    """SELECT driver_id, trip_id,
              lead(requested_at, 2) OVER (PARTITION BY driver_id ORDER BY requested_at, trip_id) AS next_but_one
       FROM trips""",
)
def win_5(t):
    trips = t.trips.select("driver_id", "trip_id", "requested_at")
    out = w.with_next(trips, ["driver_id"], ["requested_at", "trip_id"], "requested_at", "next_but_one", 2)
    return out.drop("requested_at")


@query(
    "win_6",
    """SELECT trip_id, status, sum(base_fare) OVER g AS group_total, count(*) OVER g AS group_rows,
              round(CAST(base_fare AS DOUBLE) * 100 / CAST(sum(base_fare) OVER g AS DOUBLE), 4) AS share,
              count(*) OVER (PARTITION BY status ORDER BY requested_at) AS seen,
              sum(base_fare) OVER (PARTITION BY status ORDER BY requested_at) AS earned,
              round(avg(base_fare::DOUBLE) OVER g + 1e-7, 4) AS group_avg,
              round((sum(base_fare) OVER (PARTITION BY status ORDER BY requested_at))::DOUBLE
                    / count(base_fare) OVER (PARTITION BY status ORDER BY requested_at) + 1e-7, 4) AS running_avg
       FROM trips WINDOW g AS (PARTITION BY status)""",
    doubles="group_total earned",
)
def win_6(t):
    trips = t.trips.select("trip_id", "status", "requested_at", "base_fare")
    shared = w.share_of_group(trips, ["status"], "base_fare")
    totals = {"seen": F.count("trip_id"), "earned": F.sum("base_fare"), "fares": F.count("base_fare")}
    both = w.running(shared, ["status"], ["requested_at"], totals, of=trips)
    both = both.withColumn("running_avg", F.try_divide(col("earned").cast("double"), col("fares").cast("double")))
    return both.select(
        "trip_id", "status", "group_total", "group_rows", F.round(col("share").cast("double"), 4).alias("share"),
        "seen", "earned", F.round(col("group_avg").cast("double") + 1e-7, 4).alias("group_avg"),
        F.round(col("running_avg") + 1e-7, 4).alias("running_avg"),
    )


@query(
    "win_7",
    """SELECT driver_id, trip_id, base_fare FROM (
           SELECT *, row_number() OVER (PARTITION BY driver_id ORDER BY base_fare DESC, trip_id) AS nr FROM trips)
       WHERE nr = 1""",
    doubles="base_fare",
)
def win_7(t):
    trips = t.trips.select("driver_id", "trip_id", "base_fare")
    return w.top_n_per(trips, ["driver_id"], ["-base_fare", "trip_id"], 1)


@query(
    "win_7_large",
    """SELECT l_returnflag, l_orderkey, l_linenumber, nr FROM (
           SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS nr
           FROM lineitem) WHERE nr <= 5000""",
    bigints="l_linenumber",
)
def win_7_large(t):
    """More rows of a group than Spark limits before the shuffle."""
    lines = t.raw("lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice")
    return w.top_n_per(lines, ["l_returnflag"], ["-l_extendedprice", "l_orderkey", "l_linenumber"], 5000, "nr").drop("l_extendedprice")


@query(
    "win_8",
    """SELECT genre_name, title, imdb_rating FROM (
           SELECT genre_name, title, CAST(nullif(imdb_rating, 'N/A') AS DOUBLE) AS imdb_rating,
                  row_number() OVER (PARTITION BY genre_name
                      ORDER BY CAST(nullif(imdb_rating, 'N/A') AS DOUBLE) DESC NULLS LAST, imdb_id) AS nr
           FROM movies, unnest(list_distinct(string_split(genre, ', '))) AS g(genre_name)) WHERE nr = 1""",
)
def win_8(t):
    return movies.best_per_genre(movies.build(t.movies))


@query(
    "win_9",
    """SELECT load_id, ticket_id, category FROM (
           SELECT *, row_number() OVER (PARTITION BY ticket_id ORDER BY load_id) AS nr FROM tickets) WHERE nr = 1""",
)
def win_9(t):
    return w.first_per(t.tickets, "ticket_id", "load_id").select("load_id", "ticket_id", "category")
