"""Whole-table statistics as scalar subqueries, and z-scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``withColumns`` whose results are not copied into the steps above.

    The optimizer substitutes a projected expression into every later filter
    and projection that uses it; for long expressions the copies multiply. A
    one-element inline generator yields plain attributes instead.
    """
    fields = F.struct(*[expr.alias(name) for name, expr in columns.items()])
    return df.select("*", F.inline(F.array(fields)))


def with_statistics(df: DataFrame, stats: dict[str, Column], source: DataFrame, name: str) -> DataFrame:
    """Add one struct column ``name`` holding aggregates of ``source``.

    The aggregates are one uncorrelated scalar subquery: a single pass with
    map-side partials, and one row passed on as a literal. There is no join
    and no round trip through Python.
    """
    row = source.agg(F.struct(*[expr.alias(key) for key, expr in stats.items()]).alias(name))
    return computed_once(df, {name: row.scalar()})


def abs_zscore(value: Column, mean: Column, std: Column) -> Column:
    """|x - mean| / std; 0 where the deviation is zero or undefined."""
    return F.when(std > 0, F.abs(value - mean) / std).otherwise(F.lit(0.0))


def zscore(value: Column, mean: Column, std: Column) -> Column:
    return F.when(std > 0, (value - mean) / std).otherwise(F.lit(0.0))


def over(value: Column, limit) -> Column:
    """``value > limit`` with NULL counted as false."""
    return F.coalesce(value > F.lit(limit) if not isinstance(limit, Column) else value > limit, F.lit(False))


def any_of(flags: list[Column]) -> Column:
    """OR of the flags."""
    result = flags[0]
    for flag in flags[1:]:
        result = result | flag
    return result
