"""Registry of the named queries and of the SQL that each is checked against."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starforge.plans.bindings import CHECK_VIEWS, Tables
from starforge.session import ship_package

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
CHECK_SQL: dict[str, str] = {}


def query(key: str, sql: str | None = None, doubles: str = "", bigints: str = ""):
    """Register a function ``Tables -> DataFrame`` under ``key``; ``sql`` is its check.

    Results are reported as doubles and bigints.  ``doubles`` names further columns to report
    as double on both sides (integers that may be NULL), ``bigints`` columns of the check only.
    """

    def register(fn):
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = lambda t: presented(fn(t), doubles.split())
        if sql is not None:
            CHECK_SQL[key] = _cast_columns(with_views(sql), doubles.split(), bigints.split())
        return fn

    return register


def _cast_columns(sql: str, doubles: list[str], bigints: list[str]) -> str:
    casts = [f"CAST({c} AS DOUBLE) AS {c}" for c in doubles] + [f"CAST({c} AS BIGINT) AS {c}" for c in bigints]
    return f"SELECT * REPLACE ({', '.join(casts)}) FROM ({sql})" if casts else sql


def presented(df: DataFrame, doubles: list[str]) -> DataFrame:
    """Decimals and floats as double, small integers as bigint."""
    widths = {"decimal": "double", "float": "double", "tinyint": "bigint", "smallint": "bigint", "int": "bigint"}
    target = {n: "double" if n in doubles else widths.get(t.split("(")[0]) for n, t in df.dtypes}
    if not any(target.values()):
        return df
    return df.select(*[df[n].cast(w).alias(n) if w else df[n] for n, w in target.items()])


def _needed(sql: str) -> list[str]:
    return [v for v in CHECK_VIEWS if re.search(rf"\b{v}\b", sql)]


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the definitions of the views it uses, in dependency order."""
    used: set[str] = set()
    todo = _needed(sql)
    while todo:
        view = todo.pop()
        if view not in used:
            used.add(view)
            todo.extend(v for v in _needed(CHECK_VIEWS[view]) if v != view)
    if not used:
        return sql
    ctes = ",\n".join(f"{v} AS ({CHECK_VIEWS[v]})" for v in CHECK_VIEWS if v in used)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def bound(fn: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(Tables(spark, sf_dir))

    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load_catalog()
    return {key: bound(fn) for key, fn in QUERIES.items()}


def all_checks() -> dict[str, str]:
    load_catalog()
    return dict(CHECK_SQL)


def load_catalog() -> None:
    import importlib

    for module in CATALOG:
        importlib.import_module(f"starforge.plans.{module}")


CATALOG = (
    "filters",
    "aggregates",
    "joins",
    "window_queries",
    "sets",
    "scalars",
    "star_schema",
    "movie_star",
    "loading",
    "sourcing",
    "quality_checks",
    "texts",
    "retrieval",
)
