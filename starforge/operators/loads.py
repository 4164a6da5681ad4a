"""Load modes, as functions from (target, source) to the new target.

Nothing is written here; :mod:`starforge.sources.tables` stores the result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starforge.operators.quality import gate
from starforge.operators.relational import all_known, anti, keys_of, semi
from starforge.operators.windows import top_n_per

col = F.col


def _any_null(keys: list[str]) -> Column:
    return ~all_known(keys)


def _one_per_key(src: DataFrame, keys: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """First row per key in ``order``, and the rows without a full key, which never conflict."""
    keyless = src.where(_any_null(keys))
    return top_n_per(src.where(~_any_null(keys)), keys, order, 1), keyless


def new_rows(target: DataFrame, src: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Source rows whose key the target lacks; of several with one key, the first.

    The target is first reduced to the keys the source holds.  For a small source that is a
    scan of its key column, without a shuffle of the target.
    """
    first, keyless = _one_per_key(src, keys, order)
    known = target.select(*keys).join(keys_of(src, *keys), keys, "left_semi")
    return first.join(known, keys, "left_anti").select(*src.columns).unionByName(keyless)


def insert_new(target: DataFrame, src: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Insert-if-absent: existing rows stay as they are."""
    fresh = new_rows(target, src, keys, order).select(*[c for c in src.columns if c in target.columns])
    return target.unionByName(fresh, allowMissingColumns=True)


def _reversed(order: list[str]) -> list[str]:
    return [o[1:] if o.startswith("-") else f"-{o}" for o in order]


def upsert(target: DataFrame, src: DataFrame, keys: list[str], update: list[str], order: list[str]) -> DataFrame:
    """Insert or update: of several source rows with one key the last wins.

    Only ``update`` columns of an existing row change; other columns, such as its surrogate
    key, stay.  After the reduction both sides hold a key once, so no key is heavy.
    """
    last, keyless = _one_per_key(src, keys, _reversed(order))
    names = [c for c in src.columns if c in target.columns and c not in keys]
    side = last.select(*keys, *[col(c).alias(f"_s_{c}") for c in names], F.lit(True).alias("_s"))
    # rows of the target without a full key match nothing, and would all meet in one task of the join
    joined = target.where(~_any_null(keys)).withColumn("_t", F.lit(True)).join(side, keys, "full")

    def merged(name: str) -> Column:
        if name in keys or name not in names:
            return col(name)
        from_source = col("_s") if name in update else col("_t").isNull()
        return F.when(from_source, col(f"_s_{name}")).otherwise(col(name)).alias(name)

    result = joined.select(*[merged(c) for c in target.columns]).unionByName(target.where(_any_null(keys)))
    return result.unionByName(keyless.select(*[c for c in src.columns if c in target.columns]), allowMissingColumns=True)


def load_fact(target: DataFrame, src: DataFrame, keys: list[str], order: list[str], full_reload: bool = False) -> DataFrame:
    """A full reload overwrites rows that exist already, an incremental one leaves them."""
    if full_reload:
        return upsert(target, src, keys, [c for c in src.columns if c not in keys], order)
    return insert_new(target, src, keys, order)


def replace_children(target: DataFrame, src: DataFrame, parents: DataFrame, parent_key: str) -> DataFrame:
    """Drop all children of the changed ``parents`` and add the fresh set."""
    return anti(target, parents, parent_key).unionByName(src)


def drop_orphans(dependents: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose parent still exists."""
    return semi(dependents, parents, key)


def update_where(df: DataFrame, condition: Column, **values: Column) -> DataFrame:
    return df.withColumns({n: F.when(condition, v).otherwise(col(n)) for n, v in values.items()})


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is unknown stay."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def add_column(df: DataFrame, name: str, type_: str | T.DataType) -> DataFrame:
    """Add a column of NULLs unless it is there already."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(type_))


def load_atomic(*batches: tuple) -> list[dict]:
    """Append several batches, each (table, rows, rules), or none of them.

    Every batch is staged first, and the rules are checked on what was staged.  All staged rows
    count at the moment a common marker is written; if anything fails before, none ever does.
    """
    first = batches[0][0]
    marker = f"{first.path}/commits/{uuid.uuid4().hex}"
    staged, summaries = [], []
    try:
        for table, rows, rules in batches:
            staged.append((table, table.stage(rows, marker)))
            summaries.append(gate(table.staged(staged[-1][1], rows.schema), rules))
        first.publish(marker)
    except BaseException:
        for table, folder in staged:
            table.discard(folder)
        raise
    return summaries
