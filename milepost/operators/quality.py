"""Table checks: not null, ranges, uniqueness, foreign keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.operators.profile import union_all


def check_rows(df: DataFrame, table: str, rules: Mapping[str, Column]) -> DataFrame:
    """Rows (table, rule, violations); each rule is the condition a row must meet, all in one pass.

    As in a CHECK clause, a condition that comes out null is not a violation.
    """
    counted = df.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()])
    return counted.unpivot([], list(rules), "rule", "violations").select(
        F.lit(table).alias("table"), "rule", "violations"
    )


def check_not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    return check_rows(df, table, {f"{c} not null": F.col(c).isNotNull() for c in columns})


def check_unique(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Number of key values that occur more than once."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.count_if(F.col("n") > 1).alias("violations")).select(
        F.lit(table).alias("table"), F.lit(f"{', '.join(keys)} unique").alias("rule"), "violations"
    )


def check_reference(
    df: DataFrame, table: str, key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Number of rows whose non-null key is absent from the parent.

    Rows are counted per key before the join, so a frequent key costs one row.
    """
    used = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(
        F.count(F.lit(1)).alias("n")
    )
    known = parent.select(F.col(parent_key).alias("k")).distinct()
    lost = used.join(known, "k", "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(
        F.lit(table).alias("table"), F.lit(f"{key} references parent").alias("rule"), "violations"
    )


def check_table(df: DataFrame, table: str, *, not_null: Sequence[str] = (),
                rules: Mapping[str, Column] | None = None,
                unique: Sequence[Sequence[str]] = (),
                references: Sequence[tuple[str, DataFrame, str]] = ()) -> DataFrame:
    """All checks of one table as rows (table, rule, violations)."""
    conditions = {f"{c} not null": F.col(c).isNotNull() for c in not_null} | dict(rules or {})
    reports = [check_rows(df, table, conditions)] if conditions else []
    reports += [check_unique(df, table, keys) for keys in unique]
    reports += [check_reference(df, table, key, parent, pk) for key, parent, pk in references]
    return union_all(reports)
