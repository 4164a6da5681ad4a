"""Dimensions, normalised entities, and the trip fact in its two variants."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge.functions import columns as c
from starforge.operators.relational import cross_series, join_null_safe, join_optional, keys_of, look_up
from starforge.operators.windows import dense_key
from starforge.session import cut_lineage, side_by_side

col = F.col

# --------------------------------------------------------------------------- generated dimensions


# The days of the warehouse calendar.
FIRST_DAY, LAST_DAY = dt.date(2023, 1, 1), dt.date(2026, 12, 31)


def calendar(spark: SparkSession, start: dt.date = FIRST_DAY, end: dt.date | None = LAST_DAY) -> DataFrame:
    """All days from ``start`` to ``end``, or to today if that is None."""
    last = F.current_date() if end is None else F.lit(end)
    days = F.sequence(F.lit(start), last, F.expr("INTERVAL 1 DAY"))
    return spark.range(1).select(F.explode(days).alias("full_date"))


def calendar_over(df: DataFrame, ts: str) -> DataFrame:
    """All days of the years that ``ts`` touches."""
    first = F.make_date(F.year(F.min(ts)), F.lit(1), F.lit(1))
    last = F.make_date(F.year(F.max(ts)), F.lit(12), F.lit(31))
    return df.agg(first.alias("a"), last.alias("b")).select(
        F.explode(F.expr("sequence(a, b, INTERVAL 1 DAY)")).alias("full_date")
    )


def dim_date(days: DataFrame) -> DataFrame:
    """Calendar dimension over a table of days."""
    d = col("full_date")
    return days.select(
        c.date_key(d).alias("date_key"),
        "full_date",
        F.year(d).cast("smallint").alias("year"),
        F.quarter(d).cast("smallint").alias("quarter"),
        F.month(d).cast("smallint").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).cast("smallint").alias("week_of_year"),
        c.day_of_week(d).cast("smallint").alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        c.day_of_week(d).isin(0, 6).alias("is_weekend"),
    )


def dim_release_date(days: DataFrame) -> DataFrame:
    """Calendar dimension with decades."""
    d = col("full_date")
    return days.select(
        c.date_key(d).alias("date_key"),
        "full_date",
        F.year(d).alias("year"),
        c.decade(F.year(d)).alias("decade"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
    )


def dim_time(spark: SparkSession) -> DataFrame:
    """The 96 quarters of an hour of a day."""
    h, m = col("hour"), col("minute_bucket")
    return cross_series(spark, hour=(0, 23, 1), minute_bucket=(0, 45, 15)).select(
        (h * 100 + m).alias("time_key"),
        h.cast("smallint").alias("hour"),
        m.cast("smallint").alias("minute_bucket"),
        c.clock_label(h, m).alias("time_label"),
        c.time_of_day(h).alias("time_of_day"),
        c.is_rush_hour(h).alias("is_rush_hour"),
    )


# --------------------------------------------------------------------------- staging projections


def stg_drivers(raw: DataFrame) -> DataFrame:
    return raw.select("driver_id", "name", "status", "joined_at")


def stg_passengers(raw: DataFrame) -> DataFrame:
    return raw.select("passenger_id", "name", "status", "created_at")


def stg_locations(raw: DataFrame) -> DataFrame:
    return raw.select("location_id", "city_name", "state_province", "country", "latitude", "longitude")


def stg_payment_methods(raw: DataFrame) -> DataFrame:
    return raw.select("payment_method_id", "name", "type", "is_active")


def stg_promo_codes(raw: DataFrame) -> DataFrame:
    return raw.select("promo_code_id", "code", "discount_type", "discount_value", "is_active")


TRIP_COLUMNS = (
    "trip_id driver_id passenger_id pickup_location_id dropoff_location_id payment_method_id promo_code_id "
    "base_fare tip_amount discount_amount surge_multiplier distance_km status requested_at completed_at "
    "driver_rating passenger_rating"
).split()


def stg_trips(raw: DataFrame) -> DataFrame:
    return raw.select(*TRIP_COLUMNS, c.date_key(col("requested_at")).alias("date_key"))


# --------------------------------------------------------------------------- entity dimensions

# The regions of the US states, full list.
US_REGIONS = {
    "Northeast": [
        "Connecticut", "Maine", "Massachusetts", "New Hampshire", "New Jersey", "New York", "Pennsylvania",
        "Rhode Island", "Vermont",
    ],
    "Midwest": [
        "Illinois", "Indiana", "Iowa", "Kansas", "Michigan", "Minnesota", "Missouri", "Nebraska", "North Dakota",
        "Ohio", "South Dakota", "Wisconsin",
    ],
    "South": [
        "Alabama", "Arkansas", "Delaware", "Florida", "Georgia", "Kentucky", "Louisiana", "Maryland", "Mississippi",
        "North Carolina", "Oklahoma", "South Carolina", "Tennessee", "Texas", "Virginia", "West Virginia",
    ],
    "West": [
        "Alaska", "Arizona", "California", "Colorado", "Hawaii", "Idaho", "Montana", "Nevada", "New Mexico",
        "Oregon", "Utah", "Washington", "Wyoming",
    ],
}

# The short list, used without a look at the country.
LISTED_REGIONS = {
    "Northeast": ["New York", "Pennsylvania"],
    "Midwest": ["Illinois", "Ohio"],
    "South": ["Texas", "Florida", "Tennessee"],
    "West": ["California", "Arizona", "Colorado", "Nevada", "Oregon", "Washington"],
}


def region(state: Column, mapping: dict[str, list[str]], country: Column | None = None) -> Column:
    """Region of a state; with ``country``, anything known to lie outside the USA is International."""
    rules = [(state.isin(states), name) for name, states in mapping.items()]
    if country is not None:
        rules.insert(0, (country != "USA", "International"))
    return c.bucket(rules, "International")


def dim_driver(stg: DataFrame, as_of: Column) -> DataFrame:
    return dense_key(driver_attributes(stg, as_of), ["driver_id"], "driver_key")


def dim_passenger(stg: DataFrame) -> DataFrame:
    return dense_key(passenger_attributes(stg), ["passenger_id"], "passenger_key")


def dim_location(stg: DataFrame, mapping: str = "all_states") -> DataFrame:
    return dense_key(location_attributes(stg, mapping), ["location_id"], "location_key")


def driver_attributes(stg: DataFrame, as_of: Column) -> DataFrame:
    return stg.withColumn("tenure_bucket", c.tenure_bucket(col("joined_at"), as_of))


def passenger_attributes(stg: DataFrame) -> DataFrame:
    return stg.withColumn("cohort_month", F.date_format("created_at", "yyyy-MM"))


def location_attributes(stg: DataFrame, mapping: str = "all_states") -> DataFrame:
    """``mapping`` is ``all_states``, which looks at the country first, or ``listed``."""
    if mapping == "all_states":
        name = region(col("state_province"), US_REGIONS, col("country"))
    else:
        name = region(col("state_province"), LISTED_REGIONS)
    return stg.withColumn("region", name)


def _with_sentinel(stg: DataFrame, label: str, text: str) -> DataFrame:
    """Add one row that stands for a missing id."""
    sentinel = stg.sparkSession.range(1).select(
        *[F.lit(text if f.name == label else None).cast(f.dataType).alias(f.name) for f in stg.schema.fields]
    )
    return stg.unionByName(sentinel)


def dim_payment_method(stg: DataFrame) -> DataFrame:
    return dense_key(_with_sentinel(stg, "name", "Unknown"), ["payment_method_id"], "payment_method_key")


def dim_promo_code(stg: DataFrame) -> DataFrame:
    return dense_key(_with_sentinel(stg, "code", "No Promo"), ["promo_code_id"], "promo_code_key")


def assign_keys(existing: DataFrame, new: DataFrame, natural: list[str], name: str) -> DataFrame:
    """Old rows keep their key; natural keys not seen before continue after the highest."""
    # of several rows with one natural key any may stay: they should agree on the rest
    unseen = new.join(keys_of(existing, *natural), natural, "left_anti").dropDuplicates(natural)
    start = existing.agg(F.coalesce(F.max(name), F.lit(0))).first()[0]
    keyed = dense_key(unseen, natural, name, start=start)
    return existing.unionByName(keyed, allowMissingColumns=True)


# --------------------------------------------------------------------------- normalising a flat table


@dataclass
class Entities:
    drivers: DataFrame
    passengers: DataFrame
    locations: DataFrame
    payment_methods: DataFrame


def _entity(names: DataFrame, key: str, label: str) -> DataFrame:
    return dense_key(names.distinct(), [label], key).select(key, label)


def cleaned_names(rides: DataFrame, source: str) -> DataFrame:
    """(spelling, name): each spelling is cleaned once, however many rides it has.

    The spellings are stored: otherwise a condition on the name, such as a join on it, would
    be moved below the DISTINCT and clean the name of every ride.
    """
    spellings = rides.select(col(source).alias("spelling")).where(col("spelling").isNotNull()).distinct()
    return cut_lineage(spellings).withColumn("name", c.clean_name(col("spelling")))


def entities(rides: DataFrame) -> Entities:
    """Distinct drivers, passengers, cities and payment methods of a flat ride table."""
    methods = rides.select(col("payment_method").alias("name")).where(col("name").isNotNull())
    cities = rides.select(col("pickup_city").alias("city_name")).distinct().union(rides.select("dropoff_city").distinct())
    cities = cities.where(col("city_name").isNotNull())
    return Entities(
        _entity(cleaned_names(rides, "driver_name").select("name"), "driver_id", "name"),
        _entity(cleaned_names(rides, "passenger_name").select("name"), "passenger_id", "name"),
        _entity(cities, "location_id", "city_name"),
        _entity(methods, "payment_method_id", "name"),
    )


def normalise_trips(rides: DataFrame, e: Entities) -> DataFrame:
    """The flat rides with ids in place of names; the payment method may be missing."""
    # the id of every spelling, so that rides join on the name they carry
    drivers = cleaned_names(rides, "driver_name").join(e.drivers, "name")
    passengers = cleaned_names(rides, "passenger_name").join(e.passengers, "name")
    keyed = rides
    for table, key, label, source, how, out in [
        # the spellings of a name may be many: no hint on these two
        (drivers, "driver_id", "spelling", "driver_name", "inner", "driver_id"),
        (passengers, "passenger_id", "spelling", "passenger_name", "inner", "passenger_id"),
        (e.locations, "location_id", "city_name", "pickup_city", "inner", "pickup_location_id"),
        (e.locations, "location_id", "city_name", "dropoff_city", "inner", "dropoff_location_id"),
        (e.payment_methods, "payment_method_id", "name", "payment_method", "left", "payment_method_id"),
    ]:
        side = table.select(col(key).alias(out), col(label).alias(f"_n_{out}"))
        keyed = keyed.join(side, col(source) == col(f"_n_{out}"), how)
    return keyed.select(
        "driver_id", "passenger_id", "pickup_location_id", "dropoff_location_id", "fare_amount",
        col("ride_distance_km").alias("distance_km"), col("ride_status").alias("status"),
        "requested_at", "completed_at", "rating", "payment_method_id",
    )


# --------------------------------------------------------------------------- trip fact


def trips_with_cancellation(trips: DataFrame, cancellations: DataFrame) -> DataFrame:
    return trips.join(cancellations.select("trip_id", "cancelled_by"), "trip_id", "left")


DIMENSIONS = ("driver", "passenger", "location", "payment_method", "promo_code")


@dataclass
class Lookups:
    """Natural id -> surrogate key, one table per dimension, and the known date keys."""

    date: DataFrame
    driver: DataFrame
    passenger: DataFrame
    location: DataFrame
    payment_method: DataFrame
    promo_code: DataFrame


def etl_lookups(raw, days: DataFrame) -> Lookups:
    """Dimensions over the raw tables, reduced to id and key."""

    def keyed(name: str) -> DataFrame:
        return dense_key(getattr(raw, f"{name}s").select(f"{name}_id"), [f"{name}_id"], f"{name}_key")

    return Lookups(dim_date(days).select("date_key"), *side_by_side(keyed, DIMENSIONS))


def marts(raw, as_of: Column, days: DataFrame) -> dict[str, DataFrame]:
    """Staging projections and the marts built on them, by table name."""
    stg = {
        "stg_drivers": stg_drivers(raw.drivers),
        "stg_passengers": stg_passengers(raw.passengers),
        "stg_locations": stg_locations(raw.locations),
        "stg_payment_methods": stg_payment_methods(raw.payment_methods),
        "stg_promo_codes": stg_promo_codes(raw.promo_codes),
        "stg_trips": stg_trips(raw.trips),
    }
    builders = {
        "dim_driver": lambda: dim_driver(stg["stg_drivers"], as_of),
        "dim_passenger": lambda: dim_passenger(stg["stg_passengers"]),
        "dim_location": lambda: dim_location(stg["stg_locations"], "listed"),
        "dim_payment_method": lambda: dim_payment_method(stg["stg_payment_methods"]),
        "dim_promo_code": lambda: dim_promo_code(stg["stg_promo_codes"]),
    }
    dims = dict(zip(builders, side_by_side(lambda build: build(), builders.values())))
    keys = [dims[f"dim_{d}"].select(f"{d}_id", f"{d}_key") for d in DIMENSIONS]
    fact = fact_trips_marts(stg["stg_trips"], Lookups(days, *keys))
    return {**stg, **dims, "fact_trips": fact}


def resolve_trips(trips: DataFrame, dims: Lookups) -> DataFrame:
    """Trips with their dimension keys and measures; ``skip_reason`` names the first key that is missing.

    A missing payment method or promo code id is allowed, an unknown one is not.  Every join
    is a left join on a dimension's unique id, so it adds no rows.
    """
    df = trips.withColumn("date_key", c.date_key(col("requested_at")))
    df = look_up(df, dims.date, {"date_key": "date_key"}, {"_known_date": "date_key"})
    for role, table, name in [
        ("driver", dims.driver, "driver"),
        ("passenger", dims.passenger, "passenger"),
        ("pickup_location", dims.location, "location"),
        ("dropoff_location", dims.location, "location"),
        ("payment_method", dims.payment_method, "payment_method"),
        ("promo_code", dims.promo_code, "promo_code"),
    ]:
        df = look_up(df, table, {f"{role}_id": f"{name}_id"}, {f"{role}_key": f"{name}_key"})
    reason = F.when(col("_known_date").isNull(), "date outside dim_date")
    for role in ("driver", "passenger", "pickup_location", "dropoff_location"):
        reason = reason.when(col(f"{role}_key").isNull(), f"unknown {role}")
    for role in ("payment_method", "promo_code"):
        reason = reason.when(col(f"{role}_id").isNotNull() & col(f"{role}_key").isNull(), f"unknown {role}")
    return df.withColumn("skip_reason", reason).drop("_known_date")


def fact_trips_etl(trips: DataFrame, dims: Lookups) -> tuple[DataFrame, DataFrame]:
    """Loadable fact rows and the skipped trips with the reason.

    Missing money counts as zero, a missing surge too.  Fares and minutes round half to even.
    """
    resolved = resolve_trips(trips, dims)
    money = {n: c.or_zero(col(n)).cast(t) for n, t in [
        ("base_fare", "decimal(12,2)"), ("tip_amount", "decimal(8,2)"), ("discount_amount", "decimal(8,2)"),
        ("surge_multiplier", "decimal(4,2)"),
    ]}
    fare = money["base_fare"] * money["surge_multiplier"] + money["tip_amount"] - money["discount_amount"]
    minutes = c.minutes_between(col("requested_at"), col("completed_at"), 1, half_even=True)
    good = resolved.where(col("skip_reason").isNull()).select(
        col("trip_id").alias("source_trip_id"), "date_key", "driver_key", "passenger_key", "pickup_location_key",
        "dropoff_location_key", "payment_method_key", "promo_code_key",
        *[m.alias(n) for n, m in money.items()],
        F.bround(fare, 2).cast("decimal(14,2)").alias("fare_amount"),
        "distance_km", "status",
        F.when(col("status") == "completed", minutes).cast("decimal(12,1)").alias("duration_minutes"),
        F.lit(1).cast("smallint").alias("trip_count"),
        "driver_rating", "passenger_rating", "requested_at",
    )
    skipped = resolved.where(col("skip_reason").isNotNull()).select("trip_id", "skip_reason")
    return good, skipped


def fact_trips_marts(stg: DataFrame, dims: Lookups) -> DataFrame:
    """Fact for the marts layer: unknown mandatory ids drop the trip, missing optional ids
    map to the sentinel row, unknown optional ids give a NULL key.  Nothing is rounded."""
    df = stg.join(dims.driver, "driver_id").join(dims.passenger, "passenger_id")
    for role in ("pickup", "dropoff"):
        df = df.join(
            dims.location.select(
                col("location_id").alias(f"{role}_location_id"), col("location_key").alias(f"{role}_location_key")
            ),
            f"{role}_location_id",
        )
    df = join_null_safe(df, dims.payment_method, ["payment_method_id"], "left")
    # most trips have no promo code
    df = join_optional(df, dims.promo_code, "promo_code_id", "trip_id", "left")
    fare = col("base_fare") * col("surge_multiplier") + col("tip_amount") - col("discount_amount")
    fact = df.select(
        col("trip_id").alias("source_trip_id"), "date_key", "driver_key", "passenger_key", "pickup_location_key",
        "dropoff_location_key", "payment_method_key", "promo_code_key", "base_fare", "tip_amount", "discount_amount",
        fare.alias("fare_amount"), "distance_km",
        F.when(col("status") == "completed", c.minutes_between(col("requested_at"), col("completed_at")))
        .alias("duration_minutes"),
        F.lit(1).alias("trip_count"), "driver_rating", "passenger_rating", "surge_multiplier", "requested_at",
    )
    return dense_key(fact, ["source_trip_id"], "trip_key")


def v_trips(trips: DataFrame, cancellations: DataFrame) -> DataFrame:
    """Trips with fare and minutes computed, and what is known about a cancellation."""
    fare = col("base_fare") * col("surge_multiplier") + col("tip_amount") - col("discount_amount")
    return (
        trips.withColumn("fare_amount", F.round(fare, 2))
        .withColumn("duration_minutes", c.minutes_between(col("requested_at"), col("completed_at")))
        .join(cancellations, "trip_id", "left")
    )
