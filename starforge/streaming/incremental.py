"""Incremental runs: high-water marks, run modes, and batch staging from a stream."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.functions.columns import instant
from starforge.operators import loads
from starforge.sources.tables import Staging, Table

DEFAULT_MARK = dt.datetime(2000, 1, 1)


def high_water(target: DataFrame, ts: str, default: dt.datetime = DEFAULT_MARK) -> dt.datetime:
    """Latest event time in the target; the default on an empty one."""
    mark = F.coalesce(F.max(ts), instant(default))
    return target.agg(mark.alias("mark")).first()["mark"]


def newer_than(src: DataFrame, ts: str, mark: dt.datetime, lookback: dt.timedelta = dt.timedelta(0)) -> DataFrame:
    """Rows strictly later than the mark, a literal that reaches the file scan.

    Rows that arrive late, or share the time of the mark, are not seen again; ``lookback``
    re-reads a period before it, which insert-if-absent makes harmless.
    """
    return src.where(F.col(ts) > instant(mark - lookback))


def run_load(
    table: Table,
    src: DataFrame,
    ts: str,
    keys: list[str],
    full_reload: bool = False,
    truncate: bool = False,
    lookback: dt.timedelta = dt.timedelta(0),
) -> None:
    """One load run.

    Incremental: only rows newer than the mark less ``lookback``, existing ones untouched.  Full reload: all rows, either
    into an emptied table or over the existing rows.
    """
    target = table.read()
    order = [ts, *[c for c in src.columns if c not in (ts, *keys)]]  # so that ties are decided alike
    if full_reload and truncate:
        table.overwrite(loads.insert_new(target.limit(0), src, keys, order))
    elif full_reload:
        table.upsert(src, keys, [c for c in src.columns if c not in keys], order)
    else:
        newer = newer_than(src, ts, high_water(target, ts), lookback)
        table.insert_new(newer, keys, order)


def stage_stream(stream: DataFrame, staging: Staging, checkpoint: str):
    """Stage each micro-batch under its number; a replayed one replaces itself."""

    def stage(batch: DataFrame, epoch: int) -> None:
        staging.replace_batch(batch, f"epoch-{epoch}")

    return (
        stream.writeStream.foreachBatch(stage)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
