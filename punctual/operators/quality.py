"""Integrity checks. Each returns one row per check with a count, so a clean table still gives a result."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _labelled(counts: DataFrame, check: str) -> DataFrame:
    return counts.select(F.lit(check).alias("check_name"), F.col("violations"))


def pk_violations(tables: Mapping[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Keys that occur more than once (or are NULL) per table; `tables` maps a label to rows and key."""
    checks = []
    for label, (rows, key) in tables.items():
        known = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in key))
        repeated = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | ~known)
        checks.append(_labelled(repeated.agg(F.count(F.lit(1)).alias("violations")), label))
    return reduce(DataFrame.union, checks)


def fk_violations(
    references: Mapping[str, tuple[DataFrame, str, DataFrame, str]],
) -> DataFrame:
    """Rows whose reference leads nowhere; a NULL reference passes. `references` maps a label to
    (rows, column, referenced rows, referenced column)."""
    checks = []
    for label, (rows, column, parent, parent_column) in references.items():
        # Counted per value first: a value that occurs in a third of all rows still travels as one row.
        values = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_ref")).agg(
            F.count(F.lit(1)).alias("_n")
        )
        lost = values.join(parent.select(F.col(parent_column).alias("_ref")), "_ref", "left_anti")
        checks.append(_labelled(lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violations")), label))
    return reduce(DataFrame.union, checks)


def null_violations(tables: Mapping[str, tuple[DataFrame, Iterable[str]]]) -> DataFrame:
    """NULLs in columns that must not have any, one pass per table."""
    checks = []
    for label, (rows, columns) in tables.items():
        columns = list(columns)
        counted = rows.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
        cells = F.array(
            *(F.struct(F.lit(f"{label}.{c}").alias("check_name"), F.col(c).alias("violations")) for c in columns)
        )
        checks.append(counted.select(F.inline(cells)))
    return reduce(DataFrame.union, checks)


def bound_query(spark: SparkSession, text: str, args: Mapping[str, object], **tables: DataFrame) -> DataFrame:
    """SQL over the given tables with named parameters (`:name`), which Spark binds as literals.

    A value is never part of the text, so whatever it contains it can only be compared with.
    """
    return spark.sql(text, args=dict(args), **tables)


def require_none(counts: Mapping[str, int]) -> None:
    """Raises if any count of violations is not zero."""
    bad = [f"{check}={n}" for check, n in counts.items() if n]
    if bad:
        raise ValueError("integrity: " + ", ".join(bad))


def require_clean(violations: DataFrame) -> None:
    """Raises if any check counted a violation (a handful of rows reach the driver)."""
    bad = violations.where(F.col("violations") > 0).collect()
    require_none({r.check_name: r.violations for r in bad})
