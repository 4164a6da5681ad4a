"""Data quality: row rules in one aggregate pass, key and reference checks, and a blocking gate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge.operators.relational import union_all

col = F.col


class DataQualityError(Exception):
    """A check failed; nothing may be loaded."""


@dataclass(frozen=True)
class Rule:
    """``bad`` holds for the rows that break the rule; an unknown result does not break it.

    It may be a column or a SQL condition.
    """

    name: str
    bad: Column | str | None = None
    at_least: int | None = None  # minimum number of rows, instead of a row condition

    def failures(self) -> Column:
        if self.at_least is not None:
            return F.greatest(F.lit(self.at_least) - F.count(F.lit(1)), F.lit(0))
        bad = F.expr(self.bad) if isinstance(self.bad, str) else self.bad
        return F.count_if(F.coalesce(bad, F.lit(False)))


def min_rows(n: int = 1) -> Rule:
    return Rule("row_count", at_least=n)


def non_negative(column: str) -> Rule:
    return Rule(f"non_negative_{column}", col(column) < 0)


def not_null(column: str) -> Rule:
    return Rule(f"not_null_{column}", col(column).isNull())


def required_when(column: str, condition: Column, name: str) -> Rule:
    return Rule(name, condition & col(column).isNull())


def accepted(column: str, values: Sequence) -> Rule:
    return Rule(f"accepted_values_{column}", ~col(column).isin(*values))


def no_rows(name: str, bad: Column | str) -> Rule:
    return Rule(name, bad)


def run_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(check, passed, n_bad), one row per rule, from a single pass over ``df``."""
    counts = df.agg(*[r.failures().cast("bigint").alias(f"_{i}") for i, r in enumerate(rules)])
    results = F.array(
        *[
            F.struct(F.lit(r.name).alias("check"), (col(f"_{i}") == 0).alias("passed"), col(f"_{i}").alias("n_bad"))
            for i, r in enumerate(rules)
        ]
    )
    return counts.select(F.inline(results))


def _counted(name: str, bad: DataFrame, n: Column) -> DataFrame:
    return bad.agg(F.lit(name).alias("check"), (n == 0).alias("passed"), n.alias("n_bad"))


def repeated_keys(df: DataFrame, columns: Sequence[str], where: Column | None = None) -> DataFrame:
    """Key values that occur more than once; keys with a NULL never repeat."""
    repeated = col("n_rows") > 1
    for c in columns:
        repeated = repeated & col(c).isNotNull()
    rows = df if where is None else df.where(where)
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).where(repeated)


def unique(df: DataFrame, columns: Sequence[str], where: Column | None = None, name: str | None = None) -> DataFrame:
    """``n_bad`` counts repeated key values; ``where`` makes it a partial unique rule."""
    return _counted(name or f"unique_{'_'.join(columns)}", repeated_keys(df, columns, where), F.count(F.lit(1)))


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose non-NULL reference has no parent.

    References are counted per value first, so a value that fills the table is one row in the join.
    """
    used = df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows")).where(col(column).isNotNull())
    return used.join(parent.select(col(parent_column).alias(column)), column, "left_anti")


def relationship(df: DataFrame, column: str, parent: DataFrame, parent_column: str, name: str | None = None) -> DataFrame:
    n = F.coalesce(F.sum("n_rows"), F.lit(0))
    return _counted(name or f"relationships_{column}", orphans(df, column, parent, parent_column), n)


@dataclass(frozen=True)
class KeyCheck:
    """``value`` must not repeat, or, with a parent table and column, must be among its values.

    A NULL value passes.
    """

    name: str
    value: Column
    parent: DataFrame | None = None
    parent_column: str | None = None


def unique_key(columns: Sequence[str], where: Column | None = None, name: str | None = None) -> KeyCheck:
    known = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    for c in columns:
        known = known & col(c).isNotNull()
    value = col(columns[0]) if len(columns) == 1 else F.to_json(F.struct(*columns))
    return KeyCheck(name or f"unique_{'_'.join(columns)}", F.when(known, value))


def reference(column: str, parent: DataFrame, parent_column: str) -> KeyCheck:
    return KeyCheck(f"relationships_{column}", col(column), parent, parent_column)


def _unfolded(df: DataFrame, values: dict[int, Column], kind: str = "string") -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), v.cast(kind).alias("value")) for i, v in values.items()])
    return df.select(F.inline(pairs)).where(col("value").isNotNull())


def _parents(checks: Sequence[KeyCheck]) -> list[tuple[DataFrame, dict[int, Column]]]:
    """Each parent once, with the column that a check refers to."""
    parents: dict[int, tuple[DataFrame, dict[int, Column]]] = {}
    for i, c in enumerate(checks):
        if c.parent is not None:
            parents.setdefault(id(c.parent), (c.parent, {}))[1][i] = col(c.parent_column)
    return list(parents.values())


def _kind(tables: Sequence[tuple[DataFrame, dict[int, Column]]]) -> str:
    """The type that values are compared in: whole numbers stay numbers, all else is text."""
    whole = {"tinyint", "smallint", "int", "bigint"}
    types = {t for df, values in tables for _, t in df.select(*[v.alias(f"_{i}") for i, v in values.items()]).dtypes}
    return "bigint" if types <= whole else "string"


def run_keys(df: DataFrame, checks: Sequence[KeyCheck]) -> DataFrame:
    """(check, passed, n_bad) of all key and reference checks of a table, from one pass over it.

    Rows are unfolded to (check, value) and counted before the shuffle, so a value that fills
    the table is one row; each parent is read once for all checks that refer to it.
    """
    values = {i: c.value for i, c in enumerate(checks)}
    kind = _kind([(df, values), *_parents(checks)])
    return judged_keys(_unfolded(df, values, kind).withColumn("n", F.lit(1).cast("bigint")), checks, kind)


def counted_keys(df: DataFrame, checks: Sequence[KeyCheck]) -> DataFrame:
    """(i, value, n): how often each check's values occur, as text.  Counts of parts of a table add up."""
    return _unfolded(df, {i: c.value for i, c in enumerate(checks)}).groupBy("i", "value").agg(F.count(F.lit(1)).alias("n"))


def judged_keys(used: DataFrame, checks: Sequence[KeyCheck], kind: str = "string") -> DataFrame:
    """(check, passed, n_bad) from (i, value, n); counts of one value are added up.

    The values of parents are counted along with those that refer to them, instead of a join.
    """
    met = used.select("i", "value", "n", F.lit(0).cast("bigint").alias("known"))
    known = [
        _unfolded(parent, values, kind).select("i", "value", F.lit(0).cast("bigint").alias("n"), F.lit(1).cast("bigint").alias("known"))
        for parent, values in _parents(checks)
    ]
    used = union_all([met, *known]).groupBy("i", "value").agg(F.sum("n").alias("n"), F.sum("known").alias("known"))
    counts = []
    for i, c in enumerate(checks):
        own = col("i") == i
        if c.parent is None:
            bad = F.count_if(own & (col("n") > 1))
        else:
            bad = F.coalesce(F.sum(F.when(own & (col("known") == 0), col("n"))), F.lit(0))
        counts.append(bad.cast("bigint").alias(f"_{i}"))
    results = F.array(
        *[
            F.struct(F.lit(c.name).alias("check"), (col(f"_{i}") == 0).alias("passed"), col(f"_{i}").alias("n_bad"))
            for i, c in enumerate(checks)
        ]
    )
    return used.agg(*counts).select(F.inline(results))


def audit(df: DataFrame, rules: Sequence[Rule], keys: Sequence[tuple[str, Sequence[str], Column | None]] = ()) -> DataFrame:
    """Row rules and (partial) unique rules of one table, in one pass each."""
    parts = [run_rules(df, rules)]
    if keys:
        parts.append(run_keys(df, [unique_key(columns, where, name) for name, columns, where in keys]))
    return union_all(parts)


def gate(df: DataFrame, rules: Sequence[Rule]) -> dict:
    """Run all rules in one pass; raise for the first that fails, else return a summary."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_n"), *[r.failures().alias(f"_{i}") for i, r in enumerate(rules)]
    ).first()
    results = [{"check": r.name, "passed": counts[f"_{i}"] == 0, "n_bad": counts[f"_{i}"]} for i, r in enumerate(rules)]
    for result in results:
        if not result["passed"]:
            raise DataQualityError(f"{result['check']}: {result['n_bad']} of {counts['_n']} rows")
    return {"passed": True, "row_count": counts["_n"], "checks": results}


# --------------------------------------------------------------------------- suites


@dataclass(frozen=True)
class Suite:
    """Checks of many tables.

    ``tests`` maps a table to its columns and each column to test names or tuples:
    ``unique``, ``not_null``, ``("accepted", values)``, ``("refers", table, column)``.
    ``conditions`` maps a table to named conditions that no row may meet.
    """

    tests: dict[str, dict[str, list]]
    conditions: dict[str, dict[str, Column | str]]


def run_suite(tables: dict[str, DataFrame], suite: Suite) -> DataFrame:
    """(table_name, check, passed, n_bad): per table one pass for the row rules and one for all
    key and reference checks."""
    parts: list[DataFrame] = []
    for table, columns in suite.tests.items():
        df, rules, keys = tables[table], [], []
        for column, tests in columns.items():
            for test in tests:
                match test:
                    case "not_null":
                        rules.append(not_null(column))
                    case ("accepted", values):
                        rules.append(accepted(column, values))
                    case "unique":
                        keys.append(unique_key([column]))
                    case ("refers", parent, parent_column):
                        keys.append(reference(column, tables[parent], parent_column))
        rules += [no_rows(name, bad) for name, bad in suite.conditions.get(table, {}).items()]
        results = ([run_rules(df, rules)] if rules else []) + ([run_keys(df, keys)] if keys else [])
        parts += [r.select(F.lit(table).alias("table_name"), "check", "passed", "n_bad") for r in results]
    return union_all(parts)


# --------------------------------------------------------------------------- valid / rejected


def with_reason(df: DataFrame, rules: Sequence[tuple[str, Column]], name: str = "reason") -> DataFrame:
    """The first rule a row breaks, or NULL."""
    reason = F.lit(None).cast("string")
    for label, bad in reversed(rules):
        reason = F.when(F.coalesce(bad, F.lit(False)), F.lit(label)).otherwise(reason)
    return df.withColumn(name, reason)


def split_valid(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows as (reason, record) with the whole record as JSON."""
    checked = with_reason(df, rules, "_reason")
    valid = checked.where(col("_reason").isNull()).drop("_reason")
    record = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    rejected = checked.where(col("_reason").isNotNull()).select(col("_reason").alias("reason"), record.alias("record"))
    return valid, rejected
