"""Grouping, joining, sorting and set operations."""

from __future__ import annotations

from functools import reduce
from itertools import zip_longest

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge.functions.columns import percent_of

# --------------------------------------------------------------------------- aggregates


def mean(column: str | Column) -> Column:
    """Average of a decimal column without the early rounding of ``avg``."""
    return F.try_divide(F.sum(column), F.count(column))


def totals(df: DataFrame, value: str, distance: str) -> DataFrame:
    """One row of overall figures."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(value).alias("n_values"),
        F.sum(value).alias("total"),
        mean(value).alias("average"),
        F.min(distance).alias("shortest"),
        F.max(distance).alias("longest"),
    )


def group_totals(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(value).alias("total"))


def revenue_by(df: DataFrame, key: str, fare: str) -> DataFrame:
    return (
        df.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("total_rides"),
            F.sum(fare).alias("total_revenue"),
            F.round(mean(fare), 2).alias("avg_fare"),
        )
        .orderBy(F.desc_nulls_first("total_revenue"), F.asc_nulls_last(key))
    )


def having_count(df: DataFrame, keys: list[str], more_than: int, name: str = "n_rows") -> DataFrame:
    """Groups with more than ``more_than`` rows."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(name))
        .where(F.col(name) > more_than)
        .orderBy(F.desc(name), *[F.asc_nulls_last(k) for k in keys])
    )


def status_profile(df: DataFrame, status: str, distance: str) -> DataFrame:
    return (
        df.groupBy(status)
        .agg(F.count(F.lit(1)).alias("ride_count"), F.round(mean(distance), 2).alias("avg_distance_km"))
        .orderBy(F.desc("ride_count"), F.asc_nulls_last(status))
    )


def rated_counts(df: DataFrame, rating: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_rides"),
        F.count(rating).alias("rated_rides"),
        F.count_if(F.col(rating).isNull()).alias("unrated_rides"),
    )


def count_where(df: DataFrame, key: str, **conditions: Column) -> DataFrame:
    """Per group, how many rows meet each named condition."""
    return df.groupBy(key).agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])


def count_case(df: DataFrame, key: str, **conditions: Column) -> DataFrame:
    """As :func:`count_where`, by counting a CASE."""
    return df.groupBy(key).agg(*[F.count(F.when(c, 1)).alias(name) for name, c in conditions.items()])


def scorecard(drivers: DataFrame, trips: DataFrame) -> DataFrame:
    """Trips, outcomes and rating of every driver, those without trips included.

    Trips are reduced to a row per driver before the join, so a busy driver never
    becomes a heavy join key.
    """
    per_driver = trips.groupBy("driver_id").agg(
        F.count("trip_id").alias("total_trips"),
        F.count_if(F.col("status") == "completed").alias("completed_trips"),
        F.count_if(F.col("status") == "cancelled").alias("cancelled_trips"),
        mean("driver_rating").cast("decimal(3,2)").alias("avg_rating"),
    )
    counted = ["total_trips", "completed_trips", "cancelled_trips"]
    joined = drivers.join(per_driver, "driver_id", "left").select(
        "driver_id",
        F.col("name").alias("driver_name"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counted],
        "avg_rating",
    )
    rate = percent_of(F.col("cancelled_trips"), F.col("total_trips"))
    return joined.withColumn("cancellation_rate", rate.cast("decimal(5,2)"))


def cancellation_above(drivers: DataFrame, trips: DataFrame, percent: float) -> DataFrame:
    return scorecard(drivers, trips).where(F.col("cancellation_rate") > percent)


def count_distinct(df: DataFrame, **expressions: Column) -> DataFrame:
    return df.agg(*[F.countDistinct(e).alias(name) for name, e in expressions.items()])


def min_max_by(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(F.min(value).alias("lowest"), F.max(value).alias("highest"))


def usage_count(parents: DataFrame, children: DataFrame, key: str, name: str) -> DataFrame:
    """Every parent with the number of children that refer to it, zero included."""
    used = children.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return parents.join(used, key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(0)))


def max_or(df: DataFrame, column: str, default: Column, name: str) -> DataFrame:
    return df.agg(F.coalesce(F.max(column), default).alias(name))


def ratio_profile(fact: DataFrame, keys: list[str]) -> DataFrame:
    """Additive measures are summed, the surge ratio is only averaged."""
    return fact.groupBy(*keys).agg(
        F.sum("trip_count").alias("trips"), mean("surge_multiplier").alias("avg_surge")
    )


def count_per(df: DataFrame, unit: str, ts: str) -> DataFrame:
    return df.groupBy(F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


# --------------------------------------------------------------------------- joins


def trip_log(
    trips: DataFrame, drivers: DataFrame, passengers: DataFrame, locations: DataFrame, how: str = "inner"
) -> DataFrame:
    """Trips with the names behind their ids; locations are joined once per role.

    With ``how="left"`` trips stay whose ids are missing or unknown, with NULL names.

    No join hints: Spark broadcasts a side whose measured size allows it and otherwise
    shuffles, splitting heavy keys at run time.
    """
    pickup = locations.select(F.col("location_id").alias("pickup_location_id"), F.col("city_name").alias("pickup_city"))
    dropoff = locations.select(
        F.col("location_id").alias("dropoff_location_id"), F.col("city_name").alias("dropoff_city")
    )
    return (
        trips.join(drivers.select("driver_id", F.col("name").alias("driver_name")), "driver_id", how)
        .join(passengers.select("passenger_id", F.col("name").alias("passenger_name")), "passenger_id", how)
        .join(pickup, "pickup_location_id", how)
        .join(dropoff, "dropoff_location_id", how)
    )


def all_known(columns: list[str] | tuple[str, ...]) -> Column:
    """Whether none of the columns is NULL."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def keys_of(df: DataFrame, *columns: str | Column) -> DataFrame:
    """Distinct keys for a semi or anti join.

    Repeats vanish before the shuffle, so a key that fills the table arrives as one row; the
    join then reuses the partitioning of the DISTINCT.
    """
    return df.select(*columns).distinct()


def semi(a: DataFrame, b: DataFrame, column: str, other: str | None = None) -> DataFrame:
    """``column IN (SELECT other FROM b)``"""
    return a.join(keys_of(b, F.col(other or column).alias(column)), column, "left_semi").select(*a.columns)


def anti(a: DataFrame, b: DataFrame, column: str, other: str | None = None) -> DataFrame:
    """Rows of ``a`` without a partner in ``b``."""
    return a.join(keys_of(b, F.col(other or column).alias(column)), column, "left_anti").select(*a.columns)


def full_join(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Full outer join on one key, as a left join plus the rows of ``b`` without a partner.

    Spark can split a heavy key in both parts, which it cannot in a full join.
    """
    right_only = anti(b, a, key)
    return a.join(b, key, "left").unionByName(right_only, allowMissingColumns=True)


def not_in(a: DataFrame, b: DataFrame, column: str, other: str | None = None) -> DataFrame:
    """``column NOT IN (SELECT other FROM b)``: empty as soon as ``b`` holds a NULL.

    The NULL test is a scalar subquery over one column; what remains is an ordinary anti join,
    which needs no copy of ``b`` on every executor.
    """
    other = other or column
    n_rows = b.agg(F.count(F.lit(1))).scalar()
    n_null = b.agg(F.count_if(F.col(other).isNull())).scalar()
    kept = anti(a, b, column, other)
    return kept.where((n_null == 0) & (F.col(column).isNotNull() | (n_rows == 0)))


def join_null_safe(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi join in which NULL matches NULL; the keys come from ``a``."""
    right = b.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in b.columns])
    condition = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        condition = same if condition is None else condition & same
    return a.join(right, condition, how).drop(*[f"_r_{k}" for k in keys])


# Tasks that rows without a key are dealt over.
KEYLESS_PARTS = 64


def join_optional(a: DataFrame, b: DataFrame, key: str, by: str, how: str = "inner") -> DataFrame:
    """As :func:`join_null_safe`, where very many rows of ``a`` have no key.

    They are dealt over tasks by ``by``, and the few rows of ``b`` without a key are copied to each.
    """
    part = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(by), F.lit(KEYLESS_PARTS)).cast("int")).otherwise(0)
    parts = F.when(F.col(key).isNull(), F.sequence(F.lit(0), F.lit(KEYLESS_PARTS - 1))).otherwise(F.array(F.lit(0)))
    return join_null_safe(a.withColumn("_part", part), b.withColumn("_part", F.explode(parts)), [key, "_part"], how).drop("_part")


def join_clean_key(a: DataFrame, b: DataFrame, cleaned: Column, key: str, how: str = "inner") -> DataFrame:
    """Join on a key computed from ``a``; computed once per row, before the shuffle."""
    return a.withColumn(key, cleaned).join(b, key, how)


def cross_series(spark: SparkSession, **series: tuple[int, int, int]) -> DataFrame:
    """All combinations of generated integer series, given as (first, last, step).

    Each series is unfolded in place, so no join is needed.
    """
    df = spark.range(1)
    for name, (first, last, step) in series.items():
        df = df.withColumn(name, F.explode(F.sequence(F.lit(first), F.lit(last), F.lit(step))))
    return df.drop("id")


def count_all(tables: list[DataFrame]) -> list[int]:
    """Row counts of several tables, from one job."""
    counts = [df.agg(F.lit(i).alias("i"), F.count(F.lit(1)).alias("n")) for i, df in enumerate(tables)]
    return [n for _, n in sorted((r["i"], r["n"]) for r in union_all(counts).collect())]


def look_up(df: DataFrame, dim: DataFrame, on: dict[str, str], out: dict[str, str]) -> DataFrame:
    """Fetch ``out`` columns of ``dim`` by id; rows without a match get NULL."""
    right = dim.select(
        *[F.col(d).alias(f"_k_{c}") for c, d in on.items()], *[F.col(d).alias(c) for c, d in out.items()]
    )
    condition = None
    for c in on:
        same = F.col(c) == F.col(f"_k_{c}")
        condition = same if condition is None else condition & same
    return df.join(right, condition, "left").drop(*[f"_k_{c}" for c in on])


def aggregate_then_join(parents: DataFrame, key: str, *branches: DataFrame) -> DataFrame:
    """Join several branches that are already reduced to one row per ``key``."""
    out = parents
    for branch in branches:
        out = out.join(branch, key, "left")
    return out


def union_all(parts: list[DataFrame]) -> DataFrame:
    """UNION ALL of many parts, built pairwise, so that analysing it stays quick."""
    while len(parts) > 1:
        parts = [a if b is None else a.unionByName(b) for a, b in zip_longest(parts[::2], parts[1::2])]
    return parts[0]


# --------------------------------------------------------------------------- order and limits


def order_by(*specs: str) -> list[Column]:
    """``"name"`` sorts upwards with NULLs last, ``"-name"`` downwards with NULLs first."""
    return [F.desc_nulls_first(s[1:]) if s.startswith("-") else F.asc_nulls_last(s) for s in specs]


def top_k(df: DataFrame, order: list[str], k: int) -> DataFrame:
    return df.orderBy(*order_by(*order)).limit(k)


# --------------------------------------------------------------------------- subqueries


def above_average(df: DataFrame, column: str) -> DataFrame:
    """Rows above the overall average, which is computed once as a scalar subquery."""
    return df.where(F.col(column) > df.agg(mean(column)).scalar())


def rows_at_group_max(df: DataFrame, key: str, column: str) -> DataFrame:
    """All rows that reach the maximum of their group; the maxima are reduced before the join."""
    best = df.groupBy(key).agg(F.max(column).alias("_best"))
    return df.join(best.select(key, F.col("_best").alias(column)), [key, column], "left_semi")


def scalar_lookup(df: DataFrame, dim: DataFrame, on: tuple[str, str], value: str, out: str) -> DataFrame:
    """Value of the single ``dim`` row with a matching key: NULL if none, an error if several."""
    left, right = on
    single = (
        dim.where(F.col(right).isNotNull())
        .groupBy(F.col(right).alias("_k"))
        .agg(F.count(F.lit(1)).alias("_n"), F.first(value).alias(out))
    )
    joined = df.join(single, F.col(left) == F.col("_k"), "left")
    checked = F.when(F.col("_n") > 1, F.raise_error(F.lit(f"more than one {value} for a {right}"))).otherwise(F.col(out))
    return joined.withColumn(out, checked).drop("_k", "_n")
