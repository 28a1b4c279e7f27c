"""Per-series windows: a series is one key, a row is one day of it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

ROLLING_ROWS = 7
HORIZON_DAYS = 7


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[str], tie_breakers: Sequence[str] | None = None
) -> DataFrame:
    """The newest row of each key, under a total order: all remaining columns break ties.

    Spark keeps only the best row per key on the map side before it shuffles, so a key that holds
    much of the table adds one row per map task.
    """
    rest = tie_breakers
    if rest is None:
        rest = [c for c in df.columns if c not in keys and c not in newest_first]
    order = [F.col(c).desc_nulls_last() for c in newest_first] + [F.col(c).asc_nulls_last() for c in rest]
    if not order:  # rows of one key are all alike
        return df.dropDuplicates(list(keys))
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def day_number(day: str) -> Column:
    return F.unix_date(F.col(day))


def series_window(keys: Sequence[str], day_no: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(day_no)


def rolling_frame(window: WindowSpec, rows: int = ROLLING_ROWS) -> WindowSpec:
    """The last ``rows`` rows, not days: gaps in a series widen the span."""
    return window.rowsBetween(-(rows - 1), 0)


def horizon_frame(window: WindowSpec, days: int = HORIZON_DAYS) -> WindowSpec:
    """The next ``days`` calendar days, the current day excluded; needs an integer day order."""
    return window.rangeBetween(1, days)


def change_over(column: str, window: WindowSpec, rows: int = ROLLING_ROWS) -> Column:
    return F.col(column) - F.lag(column, rows).over(window)


def stockout_ahead(oos: Column, horizon: WindowSpec, censor_empty: bool = False) -> Column:
    """Any out-of-stock row in the horizon, where NULL counts as in stock.

    An empty horizon is TRUE by default; with ``censor_empty`` it is NULL, so that it can be dropped.
    """
    ahead = F.max(F.when(oos, 1).otherwise(0)).over(horizon)
    return (ahead if censor_empty else F.coalesce(ahead, F.lit(1))) == 1


def with_windows(df: DataFrame, keys: Sequence[str], day: str, columns) -> DataFrame:
    """Add window columns that share one shuffle and one sort.

    ``columns`` is called with the series window and returns {name: column}.
    """
    numbered = df.withColumn("_day_no", day_number(day))
    added: Mapping[str, Column] = columns(series_window(keys, "_day_no"))
    return numbered.select("*", *[c.alias(n) for n, c in added.items()]).drop("_day_no")
