"""One run of the trip warehouse: dimensions, then new facts, behind a quality gate."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge.functions.columns import now
from starforge.operators import loads, quality, star
from starforge.operators.windows import dense_key
from starforge.session import cut_lineage, side_by_side
from starforge.sources.tables import Staging, Table, clean_up
from starforge.streaming.incremental import high_water, newer_than

col = F.col

# The outcomes of a trip.
TRIP_STATUS = ("completed", "cancelled", "no_show")


def row_rules() -> list[tuple[str, Column]]:
    """What sets a row aside if a run is told to, instead of stopping it."""
    return [
        ("negative fare", col("fare_amount") < 0),
        ("completed without duration", (col("status") == "completed") & col("duration_minutes").isNull()),
        ("unknown status", ~col("status").isin(*TRIP_STATUS)),
    ]


def fact_rules(min_rows: int = 1) -> list[quality.Rule]:
    """What must hold for the rows of a run before any of them is loaded."""
    return [
        quality.min_rows(min_rows),
        quality.non_negative("fare_amount"),
        quality.not_null("driver_key"),
        quality.required_when("duration_minutes", col("status") == "completed", "completed_have_duration"),
        quality.accepted("status", TRIP_STATUS),
    ]


def sync_dimension(table: Table, rows: DataFrame, natural: str, key: str, update: bool = True) -> None:
    """Bring a dimension up to date; known rows keep their surrogate key.

    With ``update`` their attributes follow the source, else they stay as first loaded.
    """
    if not table.exists():
        single = loads.insert_new(rows.limit(0), rows, [natural], [natural, *[c for c in rows.columns if c != natural]])
        table.overwrite(dense_key(single, [natural], key))
        return
    existing = table.read()
    if update:
        merged = loads.upsert(existing, rows, [natural], [c for c in rows.columns if c != natural], [natural])
    else:
        merged = loads.insert_new(existing, rows, [natural], [natural])
    merged = cut_lineage(merged)
    highest = merged.agg(F.max(key)).first()[0]
    fresh = dense_key(merged.where(col(key).isNull()).drop(key), [natural], key, start=highest or 0)
    table.overwrite(merged.where(col(key).isNotNull()).unionByName(fresh))


class Warehouse:
    """Tables below ``root``: five dimensions and two of time, the fact, skipped trips, staging.

    The fact is partitioned by month, so that a run reads and writes the months of its batch.
    """

    def __init__(self, spark: SparkSession, root: str, days: DataFrame):
        self.spark, self.root, self.days = spark, root, days
        self.fact = Table(spark, f"{root}/fact_trips", partition_by=("month",))
        self.skipped = Table(spark, f"{root}/skipped_trips")

    def dimension(self, name: str) -> Table:
        return Table(self.spark, f"{self.root}/dim_{name}")

    def load_dimensions(self, raw, as_of: Column, update: bool = True) -> None:
        """``raw`` has the source tables as attributes: ``drivers``, ``passengers``, ..."""
        rows = {
            "driver": star.driver_attributes(star.stg_drivers(raw.drivers), as_of),
            "passenger": star.passenger_attributes(star.stg_passengers(raw.passengers)),
            "location": star.location_attributes(star.stg_locations(raw.locations)),
            "payment_method": star.stg_payment_methods(raw.payment_methods),
            "promo_code": star.stg_promo_codes(raw.promo_codes),
        }

        def sync(name: str) -> None:
            sync_dimension(self.dimension(name), rows[name], f"{name}_id", f"{name}_key", update)

        for name, build in (("date", lambda: star.dim_date(self.days)), ("time", lambda: star.dim_time(self.spark))):
            if not self.dimension(name).exists():
                self.dimension(name).overwrite(build())
        # the dimensions do not depend on each other, and small ones do not fill a cluster
        side_by_side(sync, rows)

    def lookups(self) -> star.Lookups:
        keys = [self.dimension(n).read().select(f"{n}_id", f"{n}_key") for n in star.DIMENSIONS]
        return star.Lookups(star.dim_date(self.days).select("date_key"), *keys)

    def load_facts(
        self,
        raw,
        batch_id: str,
        full_reload: bool = False,
        truncate: bool = False,
        min_rows: int = 1,
        lookback: dt.timedelta = dt.timedelta(0),
        set_aside: bool = False,
    ) -> dict:
        """Stage, check and load the trips of one run.

        Incremental: trips later than the last one loaded, less ``lookback``; existing ones stay.
        Full reload: all trips, over the existing rows or, with ``truncate``, in their place.
        Trips that are skipped are stored with the reason; with ``set_aside`` so are those that
        break a rule for rows, which otherwise stop the run.
        """
        trips = raw.trips
        if not full_reload:
            loaded = self.fact.read() if self.fact.exists() else raw.trips.limit(0)
            trips = newer_than(trips, "requested_at", high_water(loaded, "requested_at"), lookback)
        good, skipped = star.fact_trips_etl(trips, self.lookups())
        good = quality.with_reason(good, row_rules() if set_aside else [], "skip_reason")
        broken = good.where(col("skip_reason").isNotNull()).select(col("source_trip_id").alias("trip_id"), "skip_reason")
        skipped = skipped.unionByName(broken)
        good = good.where(col("skip_reason").isNull()).drop("skip_reason")
        good = good.withColumn("month", F.date_format("requested_at", "yyyyMM"))
        staging = Staging(self.spark, f"{self.root}/stg_fact_trips", good.schema)
        try:
            staging.replace_batch(good, batch_id)
            staged = staging.read_batch(batch_id)
            summary = quality.gate(staged, fact_rules(min_rows))
            rows, key = staged.drop("status", "staged_at", "batch_id"), ["source_trip_id"]
            rows = self._keyed(rows, truncate=full_reload and truncate)
            if full_reload and truncate:
                self.fact.overwrite(rows)
            elif full_reload and self.fact.exists():
                update = [c for c in rows.columns if c not in (*key, "trip_key")]
                self.fact.upsert(rows, key, update, ["requested_at", "trip_key"])
            else:
                self.fact.insert_new(rows, key, ["requested_at", "trip_key"])
            if full_reload and truncate or not self.skipped.exists():
                self.skipped.overwrite(skipped)
            else:
                self.skipped.insert_new(skipped, ["trip_id", "skip_reason"], ["trip_id"])
        finally:
            clean_up([staging], batch_id)
        return summary

    def _keyed(self, rows: DataFrame, truncate: bool) -> DataFrame:
        """Rows with a surrogate key after the highest one in use."""
        start = 0
        if self.fact.exists() and not truncate:
            start = self.fact.read().agg(F.max("trip_key")).first()[0] or 0
        return dense_key(rows, ["source_trip_id"], "trip_key", start=start)

    def run(self, raw, as_of: dt.datetime | None = None, batch_id: str = "run", **options) -> dict:
        self.load_dimensions(raw, now(as_of))
        return self.load_facts(raw, batch_id, **options)
