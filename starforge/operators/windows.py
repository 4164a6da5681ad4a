"""Ordered and grouped row functions that hold up when one group has most of the rows.

A plain window puts a whole group into one task.  Here rows are range partitioned by (group,
order), so that a large group spreads over many tasks; each task works on its own rows, and what
earlier tasks of the same group hold is added from a table with at most a few rows per task.
There is one form for tables and groups of every size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starforge.operators.relational import join_null_safe, order_by
from starforge.session import cut_lineage

_TASK, _POS = "_task", "_pos"


def spread(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Rows sorted by (group, order) over all tasks, with ``_task`` and ``_pos`` columns.

    The result is stored, because task numbers may differ if a range partitioning is repeated.
    """
    keys = [*order_by(*group), *order_by(*order)]
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.repartitionByRange(tasks, *keys)
        .sortWithinPartitions(*keys)
        .withColumn(_POS, F.monotonically_increasing_id())
        .withColumn(_TASK, F.shiftright(F.col(_POS), 33))
    )
    return cut_lineage(placed)


def carried(placed: DataFrame, group: list[str], **aggregates: Column) -> DataFrame:
    """Per task and group, ``aggregates`` summed over the earlier tasks of that group.

    Only the first group of a task can continue an earlier one, so there is at most one row
    per task, which bounds the broadcast.
    """
    per_task = placed.groupBy(_TASK, *group).agg(*[a.alias(n) for n, a in aggregates.items()])
    earlier = Window.partitionBy(*group).orderBy(_TASK).rowsBetween(Window.unboundedPreceding, -1)
    first = next(iter(aggregates))
    return (
        per_task.select(_TASK, *group, *[F.sum(n).over(earlier).alias(n) for n in aggregates])
        .where(F.col(first).isNotNull())
    )


def _add_carry(placed: DataFrame, carry: DataFrame, group: list[str]) -> DataFrame:
    return join_null_safe(placed, F.broadcast(carry), [_TASK, *group], "left")


def _names(order: list[str]) -> list[str]:
    return [o.lstrip("-") for o in order]


def _is_wide(df: DataFrame, keys: list[str]) -> bool:
    """Rows that are little more than their keys are placed themselves; of others only the keys are."""
    return len(df.columns) > len(keys) + 2


def number_rows(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """1, 2, 3 .. per group.  ``order`` must end in a unique column."""
    keys = [*group, *_names(order)]
    if _is_wide(df, keys):
        numbers = number_rows(df.select(*keys), group, order, name)
        return join_null_safe(df, numbers.select(keys[-1], name), [keys[-1]])
    placed = spread(df, group, order)
    local = Window.partitionBy(_TASK, *group).orderBy(_POS)
    numbered = placed.withColumn("_local", F.row_number().over(local).cast("bigint"))
    carry = carried(placed, group, _before=F.count(F.lit(1)))
    return (
        _add_carry(numbered, carry, group)
        .withColumn(name, F.col("_local") + F.coalesce(F.col("_before"), F.lit(0)))
        .select(*df.columns, name)
    )


def dense_key(df: DataFrame, order: list[str], name: str, start: int = 0) -> DataFrame:
    """A gap-free key ``start + 1, start + 2, ..`` in the given order, which must be unique."""
    if _is_wide(df, _names(order)):
        return join_null_safe(df, dense_key(df.select(*_names(order)), order, name, start), _names(order))
    placed = spread(df, [], order)
    in_task = placed.groupBy(_TASK).agg(F.count(F.lit(1)).alias("_n"), F.min(_POS).alias("_first"))
    # one row per task
    earlier = Window.orderBy(_TASK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = in_task.select(_TASK, "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return (
        placed.join(F.broadcast(offsets), _TASK)
        .withColumn(name, F.col(_POS) - F.col("_first") + F.col("_before") + 1 + F.lit(start))
        .select(*df.columns, name)
    )


def ranked(df: DataFrame, order: str, rank: str = "rnk", dense: str = "dense_rnk") -> DataFrame:
    """RANK and DENSE_RANK over the whole table by one column.

    Equal values are first reduced to one row with its count; ranks are computed on those
    and joined back.
    """
    column = order.lstrip("-")
    values = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    placed = spread(values, [], [order])
    local = Window.partitionBy(_TASK).orderBy(_POS).rowsBetween(Window.unboundedPreceding, 0)
    upto = placed.select(column, _TASK, "_n", F.count(F.lit(1)).over(local).alias("_d"), F.sum("_n").over(local).alias("_r"))
    carry = carried(placed, [], _before=F.count(F.lit(1)), _rows=F.sum("_n"))
    before, rows_before = F.coalesce("_before", F.lit(0)), F.coalesce("_rows", F.lit(0))
    ranks = _add_carry(upto, carry, []).select(
        column,
        (F.col("_d") + before).alias(dense),
        (F.col("_r") - F.col("_n") + rows_before + 1).alias(rank),
    )
    return join_null_safe(df, ranks, [column])


def running(df: DataFrame, group: list[str], order: list[str], aggregates: dict[str, Column], of: DataFrame | None = None) -> DataFrame:
    """Running aggregates per group; rows with equal order values share the total.

    ``aggregates`` maps names to ``F.sum`` or ``F.count`` columns.  They are taken of the rows of
    ``of`` if given: what ``df`` was made from, where that has fewer joins behind it.
    """
    columns = _names(order)
    parts = {f"_p{i}": s for i, s in enumerate(aggregates.values())}
    # one row per distinct order value
    steps = (df if of is None else of).groupBy(*group, *columns).agg(*[s.alias(n) for n, s in parts.items()])
    placed = spread(steps, group, order)
    local = Window.partitionBy(_TASK, *group).orderBy(_POS).rowsBetween(Window.unboundedPreceding, 0)
    totals = placed.select(*placed.columns, *[F.sum(p).over(local).alias(f"{p}_l") for p in parts])
    # rows are counted first, as the sum of a task may be NULL
    carry = carried(placed, group, _before=F.count(F.lit(1)), **{f"{p}_c": F.sum(p) for p in parts})
    totals = _add_carry(totals, carry, group)
    out = [
        F.when(F.col(f"{p}_c").isNull(), F.col(f"{p}_l"))
        .when(F.col(f"{p}_l").isNull(), F.col(f"{p}_c"))
        .otherwise(F.col(f"{p}_l") + F.col(f"{p}_c"))
        .alias(n)
        for n, p in zip(aggregates, parts)
    ]
    totals = totals.select(*group, *columns, *out)
    return join_null_safe(df, totals, [*group, *columns])


def running_sum(df: DataFrame, group: list[str], order: list[str], value: str, name: str) -> DataFrame:
    return running(df, group, order, {name: F.sum(value)})


def running_avg(df: DataFrame, group: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Average of the values so far; NULL until there is one."""
    both = running(df, group, order, {"_sum": F.sum(value), "_values": F.count(value)})
    average = F.try_divide(F.col("_sum").cast("double"), F.col("_values").cast("double"))
    return both.withColumn(name, average.cast("double")).drop("_sum", "_values")


def with_neighbour(df: DataFrame, group: list[str], order: list[str], value: str, name: str, step: int) -> DataFrame:
    """``value`` of the row ``step`` places earlier (or later, if negative) in the group.

    Only the first and last ``step`` rows of a task can be neighbours across tasks, so only
    those leave it.
    """
    placed, far = spread(df, group, order), abs(step)
    shifted = F.lag(value, step) if step > 0 else F.lead(value, far)
    ends = placed.groupBy(_TASK).agg(F.min(_POS).alias("_lo"), F.max(_POS).alias("_hi"))
    edge = placed.join(F.broadcast(ends), _TASK)
    head, tail = F.col(_POS) - F.col("_lo") < far, F.col("_hi") - F.col(_POS) < far
    across = Window.partitionBy(*group).orderBy(_POS)
    # all rows between two neighbours in different tasks are among these
    edge = edge.where(head | tail).withColumn("_across", shifted.over(across)).where(head if step > 0 else tail)
    local = Window.partitionBy(_TASK, *group).orderBy(_POS)
    out = placed.withColumn("_near", shifted.over(local)).join(F.broadcast(edge.select(_POS, "_across")), _POS, "left")
    return out.withColumn(name, F.coalesce("_near", "_across")).select(*df.columns, name)


def with_prev(df: DataFrame, group: list[str], order: list[str], value: str, name: str, n: int = 1) -> DataFrame:
    return with_neighbour(df, group, order, value, name, n)


def with_next(df: DataFrame, group: list[str], order: list[str], value: str, name: str, n: int = 1) -> DataFrame:
    return with_neighbour(df, group, order, value, name, -n)


def share_of_group(df: DataFrame, group: list[str], value: str, share: str = "share") -> DataFrame:
    """Each row with the total, the row count, the average of its group and its share of the total.

    The groups are reduced before the join, so no task receives a whole group.
    """
    per_group = df.groupBy(*group).agg(
        F.sum(value).alias("group_total"), F.count(F.lit(1)).alias("group_rows"), F.avg(value).alias("group_avg")
    )
    joined = join_null_safe(df, per_group, group)
    return joined.withColumn(share, F.try_divide(F.col(value) * 100, F.col("group_total")))


# The end of a page up to which its rows are taken by one task.
SHALLOW = 10_000


def sliced(df: DataFrame, group: list[str], order: list[str], offset: int, limit: int, name: str) -> DataFrame:
    """Rows ``offset + 1`` to ``offset + limit`` of every group, numbered by ``name``, however large groups are.

    Order values are counted and placed over all tasks, and their numbers found from the counts of
    the tasks; only rows with a value of the slice leave where they are.  Rows with equal order
    values follow a hash of all their columns, so that slices neither overlap nor miss a row, and
    rows that are equal in every column are counted, not moved.  Maps cannot be hashed.
    """
    end = offset + limit
    keyed = df.withColumn("_tie", F.xxhash64(*df.columns))
    keys = list(dict.fromkeys([*group, *_names(order), "_tie"]))
    placed = spread(keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), group, [*order, "_tie"])
    local = Window.partitionBy(_TASK, *group).orderBy(_POS).rowsBetween(Window.unboundedPreceding, 0)
    counted = placed.withColumn("_upto", F.sum("_n").over(local))
    values = _add_carry(counted, carried(placed, group, _rows=F.sum("_n")), group)
    values = values.withColumn("_first", F.coalesce("_rows", F.lit(0)) + F.col("_upto") - F.col("_n"))
    values = values.where((F.col("_first") < end) & (F.col("_first") + F.col("_n") > offset)).select(*keys, "_first")
    rows = join_null_safe(keyed, values, keys).groupBy(*df.columns, "_tie", "_first").agg(F.count(F.lit(1)).alias("_n"))
    # different rows with one hash, if there are any
    same = Window.partitionBy(*keys).orderBy(F.xxhash64(F.lit(1), *df.columns), *df.columns).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_first") + F.coalesce(F.sum("_n").over(same), F.lit(0))
    rows = rows.withColumn("_from", F.greatest(start, F.lit(offset))).withColumn("_to", F.least(start + F.col("_n"), F.lit(end)))
    rows = rows.where(F.col("_to") > F.col("_from"))
    return rows.withColumn(name, F.explode(F.sequence(F.col("_from") + 1, F.col("_to")))).select(*df.columns, name)


def page(df: DataFrame, order: list[str], offset: int, limit: int) -> DataFrame:
    """Rows ``offset + 1`` to ``offset + limit`` in the given order.

    A shallow page is the best ``offset + limit`` rows of every task, merged by one; a deep one is a slice.
    """
    if offset + limit <= SHALLOW:
        return df.orderBy(*order_by(*order)).offset(offset).limit(limit)
    return sliced(df, [], order, offset, limit, "_nr").orderBy("_nr").select(*df.columns)


def top_n_per(df: DataFrame, group: list[str], order: list[str], n: int = 1, name: str = "_nr") -> DataFrame:
    """First ``n`` rows per group.

    Spark keeps only ``n`` rows of a group per task before the shuffle, for ``n`` up to its
    ``spark.sql.optimizer.windowGroupLimitThreshold`` (1,000 unless set).  Beyond it the n-th order
    value of each group is found from counts, and no task gets a whole group.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > limit:
        out = sliced(df, group, order, 0, n, name)
    else:
        w = Window.partitionBy(*group).orderBy(*order_by(*order))
        out = df.withColumn(name, F.row_number().over(w).cast("bigint")).where(F.col(name) <= n)
    return out.drop(name) if name == "_nr" else out


def first_per(df: DataFrame, key: str, row_id: str) -> DataFrame:
    """The row with the lowest ``row_id`` of each key.  ``row_id`` must be unique.

    Winners are found by a reduction and joined back on the unique id, so copies of one key
    never meet in one task.
    """
    winners = df.groupBy(key).agg(F.min(row_id).alias(row_id)).select(row_id)
    return df.join(winners, row_id, "left_semi")
