"""The ride-sharing tables, as views over the supplied tables.

Each view exists twice: as a Spark projection and as the SQL the check runs.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# ---------------------------------------------------------------------------
# check side
# ---------------------------------------------------------------------------

CHECK_VIEWS: dict[str, str] = {
    "trips": """
        SELECT o_orderkey AS trip_id,
               o_orderkey // 140 AS driver_id,
               o_custkey AS passenger_id,
               o_custkey % 26 AS pickup_location_id,
               (o_orderkey + o_custkey) % 25 AS dropoff_location_id,
               CASE WHEN o_orderstatus = 'P' THEN NULL
                    WHEN o_orderkey % 50 = 7 THEN 9
                    ELSE CAST(substr(o_orderpriority, 1, 1) AS BIGINT) END AS payment_method_id,
               CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey // 7 END AS promo_code_id,
               CAST(o_totalprice AS DECIMAL(12,2)) AS base_fare,
               CAST(o_orderkey % 13 AS DECIMAL(8,2)) AS tip_amount,
               CAST(CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey % 11 ELSE 0 END AS DECIMAL(8,2)) AS discount_amount,
               CASE WHEN o_orderkey % 97 <> 0
                    THEN CAST(1 + (o_orderkey % 5) * 0.25 AS DECIMAL(4,2)) END AS surge_multiplier,
               CAST((o_orderkey % 4000) * 0.01 AS DECIMAL(6,2)) AS distance_km,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'cancelled' ELSE 'no_show' END AS status,
               o_orderdate + to_minutes(CAST(o_orderkey * 37 % 1440 AS BIGINT)) AS requested_at,
               CASE WHEN o_orderstatus = 'F' AND o_orderkey % 211 <> 0
                    THEN o_orderdate + to_minutes(CAST(o_orderkey * 37 % 1440 AS BIGINT))
                         + to_seconds(CAST(300 + o_orderkey * 13 % 5400 AS BIGINT)) END AS completed_at,
               CASE WHEN o_orderstatus = 'F' AND o_orderkey % 7 <> 0
                    THEN CAST(1 + o_orderkey % 5 AS DECIMAL(2,1)) END AS driver_rating,
               CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 <> 0
                    THEN CAST(1 + o_custkey % 5 AS DECIMAL(2,1)) END AS passenger_rating
        FROM orders""",
    "drivers": """
        SELECT s_suppkey AS driver_id, s_name AS name,
               CASE s_suppkey % 10 WHEN 0 THEN 'suspended' WHEN 1 THEN 'inactive' ELSE 'active' END AS status,
               TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST(s_suppkey % 2000 AS INTEGER)) AS joined_at,
               CASE WHEN s_suppkey % 4 <> 3 THEN CAST(s_nationkey % 4 AS BIGINT) END AS vehicle_type_id
        FROM supplier""",
    "vehicle_types": """
        SELECT CAST(r_regionkey AS BIGINT) AS vehicle_type_id, r_name AS type_name,
               CAST(50 + r_regionkey * 45 AS DECIMAL(6,2)) AS base_fare
        FROM region""",
    "passengers": """
        SELECT c_custkey AS passenger_id, c_name AS name,
               CASE c_custkey % 8 WHEN 0 THEN 'banned' WHEN 1 THEN 'inactive' ELSE 'active' END AS status,
               TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST(c_custkey % 2000 AS INTEGER)) AS created_at
        FROM customer""",
    "locations": """
        SELECT CAST(n_nationkey AS BIGINT) AS location_id, n_name AS city_name,
               CASE n_nationkey % 6 WHEN 0 THEN 'New York' WHEN 1 THEN 'Ohio' WHEN 2 THEN 'Texas'
                    WHEN 3 THEN 'California' WHEN 4 THEN 'Maine' END AS state_province,
               CASE WHEN n_nationkey = 24 THEN NULL WHEN n_regionkey < 4 THEN 'USA' ELSE 'Canada' END AS country,
               CAST(n_nationkey * 1.5 AS DECIMAL(9,6)) AS latitude,
               CAST(n_nationkey * -2.5 AS DECIMAL(9,6)) AS longitude
        FROM nation""",
    "payment_methods": """
        SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS payment_method_id,
               lower(substr(o_orderpriority, 3)) AS name,
               CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'cash' WHEN '2' THEN 'card'
                    WHEN '3' THEN 'wallet' ELSE 'voucher' END AS type,
               substr(o_orderpriority, 1, 1) <> '5' AS is_active
        FROM orders""",
    "promo_codes": """
        SELECT p_partkey AS promo_code_id, 'PROMO' || CAST(p_partkey AS VARCHAR) AS code,
               CASE WHEN p_partkey % 2 = 0 THEN 'percent' ELSE 'flat' END AS discount_type,
               CAST(p_size AS DECIMAL(8,2)) AS discount_value, p_size > 10 AS is_active
        FROM part""",
    "trip_cancellations": """
        SELECT trip_id, requested_at + to_minutes(5) AS cancelled_at,
               CASE trip_id % 3 WHEN 0 THEN 'driver' WHEN 1 THEN 'passenger' ELSE 'system' END AS cancelled_by,
               CASE trip_id % 2 WHEN 0 THEN 'late' END AS cancellation_reason
        FROM trips WHERE status = 'cancelled'""",
    "rides": """
        SELECT trip_id AS ride_id,
               CASE trip_id % 3 WHEN 0 THEN '  driver  ' WHEN 1 THEN 'DRIVER ' ELSE 'Driver   ' END
                 || 'o''neil-' || CAST(driver_id AS VARCHAR) || ' ' AS driver_name,
               CASE trip_id % 2 WHEN 0 THEN 'PASSENGER   no ' ELSE ' passenger no ' END
                 || CAST(passenger_id AS VARCHAR) AS passenger_name,
               'City ' || CAST(pickup_location_id AS VARCHAR) AS pickup_city,
               'City ' || CAST(dropoff_location_id AS VARCHAR) AS dropoff_city,
               base_fare AS fare_amount, distance_km AS ride_distance_km, status AS ride_status,
               requested_at, completed_at, driver_rating AS rating,
               CASE payment_method_id WHEN 1 THEN 'cash' WHEN 2 THEN 'esewa' WHEN 3 THEN 'khalti'
                    WHEN 4 THEN 'card' WHEN 5 THEN 'wallet' WHEN 9 THEN 'PayPal' END AS payment_method
        FROM trips""",
    "tickets": """
        SELECT doc_id AS load_id,
               CASE WHEN doc_id % 41 = 5 THEN '  ' WHEN doc_id % 10 = 9 THEN CAST(doc_id - 1 AS VARCHAR)
                    ELSE CAST(doc_id AS VARCHAR) END AS ticket_id,
               CASE WHEN doc_id % 3 = 0 THEN '' ELSE lang || ' request' END AS subject,
               CASE WHEN doc_id % 53 = 11 THEN NULL ELSE text END AS body,
               CASE WHEN doc_id % 59 = 17 THEN NULL ELSE source END AS category,
               CASE WHEN doc_id % 4 = 1 THEN '' ELSE lang || ' answer' END AS response
        FROM documents""",
    "vectors": """
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS embedding, label FROM embeddings""",
    "movies": """
        SELECT 'tt' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS imdb_id,
               p_name || ' ' || CAST(p_partkey AS VARCHAR) AS title,
               CASE WHEN p_size % 7 = 0 THEN 'N/A' ELSE p_brand END AS rated,
               CASE WHEN p_size % 11 = 0 THEN NULL
                    ELSE DATE '1950-01-01' + CAST(p_partkey * 131 % 25000 AS INTEGER) END AS released,
               CASE WHEN p_size % 13 = 0 THEN 'N/A' ELSE CAST(80 + p_size AS VARCHAR) || ' min' END AS runtime,
               CASE WHEN p_size % 5 = 0 THEN p_type ELSE p_type || ', ' || upper(substr(p_name, 1, 3)) || ', Drama' END AS genre,
               CASE WHEN p_size % 17 = 0 THEN 'N/A'
                    ELSE 'Director ' || CAST(p_partkey // 3 AS VARCHAR) || ', Second Unit' END AS director,
               CASE p_size % 3 WHEN 0 THEN 'USA, UK' WHEN 1 THEN 'Nepal' ELSE 'N/A' END AS country,
               CASE p_size % 4 WHEN 0 THEN 'English, French' WHEN 1 THEN 'Nepali' ELSE 'English' END AS language,
               CASE WHEN p_size % 19 = 0 THEN 'N/A'
                    ELSE CAST(1 + p_partkey % 9 AS VARCHAR) || '.' || CAST(p_size % 10 AS VARCHAR) END AS imdb_rating,
               CAST(1 + p_partkey % 9 AS VARCHAR) || ',' || lpad(CAST(p_partkey * 7 % 1000 AS VARCHAR), 3, '0')
                 || ',' || lpad(CAST(p_size AS VARCHAR), 3, '0') AS imdb_votes,
               CASE WHEN p_size % 6 = 0 THEN 'N/A'
                    ELSE '$' || CAST(1 + p_size AS VARCHAR) || ',' || lpad(CAST(p_partkey * 11 % 1000 AS VARCHAR), 3, '0')
                         || ',000' END AS box_office,
               CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(p_size + 40 AS VARCHAR) || '%' END AS rotten
        FROM part""",
}

# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

_REQUESTED = "o_orderdate + make_dt_interval(0, 0, CAST(o_orderkey * 37 % 1440 AS INT), 0)"

_TRIPS = [
    "o_orderkey AS trip_id",
    "o_orderkey div 140 AS driver_id",
    "o_custkey AS passenger_id",
    "o_custkey % 26 AS pickup_location_id",
    "(o_orderkey + o_custkey) % 25 AS dropoff_location_id",
    "CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderkey % 50 = 7 THEN 9"
    " ELSE CAST(substr(o_orderpriority, 1, 1) AS BIGINT) END AS payment_method_id",
    "CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey div 7 END AS promo_code_id",
    "CAST(o_totalprice AS DECIMAL(12,2)) AS base_fare",
    "CAST(o_orderkey % 13 AS DECIMAL(8,2)) AS tip_amount",
    "CAST(CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey % 11 ELSE 0 END AS DECIMAL(8,2)) AS discount_amount",
    "CASE WHEN o_orderkey % 97 <> 0 THEN CAST(1 + (o_orderkey % 5) * 0.25 AS DECIMAL(4,2)) END AS surge_multiplier",
    "CAST((o_orderkey % 4000) * 0.01 AS DECIMAL(6,2)) AS distance_km",
    "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'cancelled' ELSE 'no_show' END AS status",
    f"{_REQUESTED} AS requested_at",
    f"CASE WHEN o_orderstatus = 'F' AND o_orderkey % 211 <> 0 THEN {_REQUESTED}"
    " + make_dt_interval(0, 0, 0, 300 + o_orderkey * 13 % 5400) END AS completed_at",
    "CASE WHEN o_orderstatus = 'F' AND o_orderkey % 7 <> 0"
    " THEN CAST(1 + o_orderkey % 5 AS DECIMAL(2,1)) END AS driver_rating",
    "CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 <> 0"
    " THEN CAST(1 + o_custkey % 5 AS DECIMAL(2,1)) END AS passenger_rating",
]

_DAYS = "TIMESTAMP_NTZ '1995-01-01 00:00:00' + make_dt_interval(CAST({} % 2000 AS INT))"


class Tables:
    """Lazy access to the supplied tables and to the views over them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        return self.raw("orders")

    @cached_property
    def events(self) -> DataFrame:
        return self.raw("events")

    @cached_property
    def documents(self) -> DataFrame:
        return self.raw("documents")

    @cached_property
    def pages(self) -> DataFrame:
        return self.raw("pages")

    @cached_property
    def trips(self) -> DataFrame:
        return self.orders.selectExpr(*_TRIPS)

    @cached_property
    def drivers(self) -> DataFrame:
        return self.raw("supplier").selectExpr(
            "s_suppkey AS driver_id",
            "s_name AS name",
            "CASE s_suppkey % 10 WHEN 0 THEN 'suspended' WHEN 1 THEN 'inactive' ELSE 'active' END AS status",
            _DAYS.format("s_suppkey") + " AS joined_at",
            "CASE WHEN s_suppkey % 4 <> 3 THEN CAST(s_nationkey % 4 AS BIGINT) END AS vehicle_type_id",
        )

    @cached_property
    def vehicle_types(self) -> DataFrame:
        return self.raw("region").selectExpr(
            "CAST(r_regionkey AS BIGINT) AS vehicle_type_id",
            "r_name AS type_name",
            "CAST(50 + r_regionkey * 45 AS DECIMAL(6,2)) AS base_fare",
        )

    @cached_property
    def passengers(self) -> DataFrame:
        return self.raw("customer").selectExpr(
            "c_custkey AS passenger_id",
            "c_name AS name",
            "CASE c_custkey % 8 WHEN 0 THEN 'banned' WHEN 1 THEN 'inactive' ELSE 'active' END AS status",
            _DAYS.format("c_custkey") + " AS created_at",
        )

    @cached_property
    def locations(self) -> DataFrame:
        return self.raw("nation").selectExpr(
            "CAST(n_nationkey AS BIGINT) AS location_id",
            "n_name AS city_name",
            "CASE n_nationkey % 6 WHEN 0 THEN 'New York' WHEN 1 THEN 'Ohio' WHEN 2 THEN 'Texas'"
            " WHEN 3 THEN 'California' WHEN 4 THEN 'Maine' END AS state_province",
            "CASE WHEN n_nationkey = 24 THEN NULL WHEN n_regionkey < 4 THEN 'USA' ELSE 'Canada' END AS country",
            "CAST(n_nationkey * 1.5 AS DECIMAL(9,6)) AS latitude",
            "CAST(n_nationkey * -2.5 AS DECIMAL(9,6)) AS longitude",
        )

    @cached_property
    def payment_methods(self) -> DataFrame:
        return (
            self.orders.select("o_orderpriority")
            .distinct()
            .selectExpr(
                "CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS payment_method_id",
                "lower(substr(o_orderpriority, 3)) AS name",
                "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'cash' WHEN '2' THEN 'card'"
                " WHEN '3' THEN 'wallet' ELSE 'voucher' END AS type",
                "substr(o_orderpriority, 1, 1) <> '5' AS is_active",
            )
        )

    @cached_property
    def promo_codes(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "p_partkey AS promo_code_id",
            "concat('PROMO', p_partkey) AS code",
            "CASE WHEN p_partkey % 2 = 0 THEN 'percent' ELSE 'flat' END AS discount_type",
            "CAST(p_size AS DECIMAL(8,2)) AS discount_value",
            "p_size > 10 AS is_active",
        )

    @cached_property
    def trip_cancellations(self) -> DataFrame:
        return self.trips.where(F.col("status") == "cancelled").selectExpr(
            "trip_id",
            "requested_at + INTERVAL '5' MINUTE AS cancelled_at",
            "CASE trip_id % 3 WHEN 0 THEN 'driver' WHEN 1 THEN 'passenger' ELSE 'system' END AS cancelled_by",
            "CASE trip_id % 2 WHEN 0 THEN 'late' END AS cancellation_reason",
        )

    @cached_property
    def rides(self) -> DataFrame:
        return self.trips.selectExpr(
            "trip_id AS ride_id",
            "concat(CASE trip_id % 3 WHEN 0 THEN '  driver  ' WHEN 1 THEN 'DRIVER ' ELSE 'Driver   ' END,"
            " 'o\\'neil-', driver_id, ' ') AS driver_name",
            "concat(CASE trip_id % 2 WHEN 0 THEN 'PASSENGER   no ' ELSE ' passenger no ' END, passenger_id)"
            " AS passenger_name",
            "concat('City ', pickup_location_id) AS pickup_city",
            "concat('City ', dropoff_location_id) AS dropoff_city",
            "base_fare AS fare_amount",
            "distance_km AS ride_distance_km",
            "status AS ride_status",
            "requested_at",
            "completed_at",
            "driver_rating AS rating",
            "CASE payment_method_id WHEN 1 THEN 'cash' WHEN 2 THEN 'esewa' WHEN 3 THEN 'khalti'"
            " WHEN 4 THEN 'card' WHEN 5 THEN 'wallet' WHEN 9 THEN 'PayPal' END AS payment_method",
        )

    @cached_property
    def tickets(self) -> DataFrame:
        return self.documents.selectExpr(
            "doc_id AS load_id",
            "CASE WHEN doc_id % 41 = 5 THEN '  ' WHEN doc_id % 10 = 9 THEN CAST(doc_id - 1 AS STRING)"
            " ELSE CAST(doc_id AS STRING) END AS ticket_id",
            "CASE WHEN doc_id % 3 = 0 THEN '' ELSE concat(lang, ' request') END AS subject",
            "CASE WHEN doc_id % 53 = 11 THEN NULL ELSE text END AS body",
            "CASE WHEN doc_id % 59 = 17 THEN NULL ELSE source END AS category",
            "CASE WHEN doc_id % 4 = 1 THEN '' ELSE concat(lang, ' answer') END AS response",
        )

    @cached_property
    def vectors(self) -> DataFrame:
        return self.raw("embeddings").select("vec_id", "embedding", "label")

    @cached_property
    def movies(self) -> DataFrame:
        """Raw movie records, with the field names the JSON documents use."""
        return self.raw("part").selectExpr(
            "concat('tt', lpad(CAST(p_partkey AS STRING), 7, '0')) AS imdbID",
            "concat(p_name, ' ', p_partkey) AS Title",
            "CASE WHEN p_size % 7 = 0 THEN 'N/A' ELSE p_brand END AS Rated",
            "CASE WHEN p_size % 11 = 0 THEN 'N/A' ELSE date_format("
            "date_add(DATE '1950-01-01', CAST(p_partkey * 131 % 25000 AS INT)), 'dd MMM yyyy') END AS Released",
            "CASE WHEN p_size % 13 = 0 THEN 'N/A' ELSE concat(80 + p_size, ' min') END AS Runtime",
            "CASE WHEN p_size % 5 = 0 THEN p_type"
            " ELSE concat(p_type, ', ', upper(substr(p_name, 1, 3)), ', Drama') END AS Genre",
            "CASE WHEN p_size % 17 = 0 THEN 'N/A' ELSE concat('Director ', p_partkey div 3, ', Second Unit') END"
            " AS Director",
            "CASE p_size % 3 WHEN 0 THEN 'USA, UK' WHEN 1 THEN 'Nepal' ELSE 'N/A' END AS Country",
            "CASE p_size % 4 WHEN 0 THEN 'English, French' WHEN 1 THEN 'Nepali' ELSE 'English' END AS Language",
            "CASE WHEN p_size % 19 = 0 THEN 'N/A' ELSE concat(1 + p_partkey % 9, '.', p_size % 10) END AS imdbRating",
            "concat(1 + p_partkey % 9, ',', lpad(CAST(p_partkey * 7 % 1000 AS STRING), 3, '0'), ',',"
            " lpad(CAST(p_size AS STRING), 3, '0')) AS imdbVotes",
            "CASE WHEN p_size % 6 = 0 THEN 'N/A' ELSE concat('$', 1 + p_size, ',',"
            " lpad(CAST(p_partkey * 11 % 1000 AS STRING), 3, '0'), ',000') END AS BoxOffice",
            "concat('Plot of ', p_name) AS Plot",
            "'N/A' AS Poster",
            "CAST(p_size AS STRING) AS Metascore",
            "CASE WHEN p_partkey % 3 = 0 THEN array(named_struct('Source', 'Internet Movie Database', 'Value', '5/10'))"
            " ELSE array(named_struct('Source', 'Internet Movie Database', 'Value', '5/10'),"
            " named_struct('Source', 'Rotten Tomatoes', 'Value', concat(p_size + 40, '%'))) END AS Ratings",
        )
