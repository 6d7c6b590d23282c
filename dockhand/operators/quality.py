"""Constraint checks as data: every check returns its violations.

Violations are rows ``rule, table_name, column_name, key_value, n_rows``:
one row per offending value with the number of rows that hold it. Values are
counted on the map side first, so an offending value that fills a large share
of a table is one row per task in every shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class NotNull:
    table: str
    column: str


@dataclass(frozen=True)
class Unique:
    table: str
    column: str


@dataclass(frozen=True)
class ForeignKey:
    table: str
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Positive:
    table: str
    column: str


Rule = NotNull | Unique | ForeignKey | Positive


def _report(violations: DataFrame, rule: str, table: str, column: str, value: Column) -> DataFrame:
    return violations.select(
        F.lit(rule).alias("rule"),
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        value.cast("string").alias("key_value"),
        F.col("n_rows"),
    )


def _count_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


def not_null(df: DataFrame, table: str, column: str) -> DataFrame:
    """Rows without a value, as one row per table (none when all are filled)."""
    missing = df.filter(F.col(column).isNull()).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 0")
    return _report(missing, "not_null", table, column, F.lit(None))


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Values held by more than one row; NULL is not a value."""
    repeated = _count_by(df.filter(F.col(column).isNotNull()), column).filter("n_rows > 1")
    return _report(repeated, "unique", table, column, F.col(column))


def orphans(child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Foreign-key values without a parent; a NULL key is allowed.

    The child is reduced to its distinct keys before the anti join, so a hot
    key cannot overload a join task.
    """
    keys = _count_by(child.filter(F.col(column).isNotNull()), column)
    known = parent.select(F.col(parent_column).alias("__known"))
    lost = keys.join(known, keys[column] == known["__known"], "left_anti")
    return _report(lost, "foreign_key", table, column, F.col(column))


def positive(df: DataFrame, table: str, column: str) -> DataFrame:
    """Values that are not above zero; NULL passes."""
    return _report(_count_by(df.filter(~(F.col(column) > 0)), column), "check", table, column, F.col(column))


def check(rule: Rule, tables: dict[str, DataFrame]) -> DataFrame:
    """Violations of one rule."""
    df = tables[rule.table]
    match rule:
        case NotNull():
            return not_null(df, rule.table, rule.column)
        case Unique():
            return unique(df, rule.table, rule.column)
        case ForeignKey():
            return orphans(df, rule.table, rule.column, tables[rule.parent], rule.parent_column)
        case Positive():
            return positive(df, rule.table, rule.column)


def report(rules: list[Rule], tables: dict[str, DataFrame]) -> DataFrame:
    """Violations of all rules, one below the other."""
    return reduce(DataFrame.unionByName, [check(rule, tables) for rule in rules])
