"""Rows drawn from a tree of dependent columns, so that values which never meet stay apart.

A copula joins columns by rank; it cannot hold that a service comes with one status only. Here each
column depends on one other: the tree of all columns that holds most of their mutual information
(Chow and Liu). Numbers and times take part by ranges of equal share and are drawn within their range.
Counting is one aggregate over the rows and a few over their distinct combinations; what comes to the
driver is a number for each pair of columns. Conditional shares stay in a table, one row for each value
of the column depended on, and rows find theirs by joins.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.draws import uniform
from ..operators.bounds import broadcast_if_small
from ..session import fresh_path
from .copula import QUANTILES, Marginal, as_number, from_number, numeric_marginals

RANGES = 20
#: Stands for a missing value, which depends on other columns like any value does.
_MISSING = "\x00"


@dataclass(frozen=True)
class Tree:
    """``parent``: the column that each one depends on, in an order that has parents first (None: the
    first column). ``shares`` is the folder of the conditional shares."""

    parent: Mapping[str, str | None]
    numbers: Mapping[str, Marginal]
    types: Mapping[str, T.DataType]
    columns: Sequence[str]
    shares: str


def _edges(m: Marginal, ranges: int) -> list[float]:
    """Inner borders of the ranges, each value once. A value that fills a range has one of its own."""
    step = (len(m.quantiles) - 1) / ranges
    picked = [m.quantiles[round(i * step)] for i in range(ranges + 1)]
    full = {math.nextafter(a, math.inf) for a, b in zip(picked, picked[1:]) if a == b and a < m.quantiles[-1]}
    return sorted((set(picked[1:-1]) | full | {b for a, b in zip(picked, picked[1:]) if a == b}) - {m.quantiles[0]})


def _range_of(value: Column, edges: Sequence[float]) -> Column:
    """How many borders a value has reached."""
    return F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges]), lambda e: e <= value)) if edges else F.lit(0)


def _coded(df: DataFrame, numbers: Mapping[str, Marginal], names: Sequence[str], ranges: int) -> DataFrame:
    """All columns as text: categories as they are, numbers as the index of their range."""
    columns = []
    for name in names:
        if name in numbers:
            value = as_number(name, df.schema[name].dataType)
            known = value.isNotNull() & ~F.isnan(value)
            code = F.when(known, _range_of(value, _edges(numbers[name], ranges)).cast("string"))
        else:
            code = F.col(f"`{name}`").cast("string")
        columns.append(F.coalesce(code, F.lit(_MISSING)).alias(name))
    return df.select(*columns)


def pair_counts(coded: DataFrame, names: Sequence[str]) -> DataFrame:
    """a, b (columns), u, v (their values), n: how often two values meet, for all pairs of columns.

    Rows are folded to their distinct combinations first; only those are repeated for every pair.
    """
    folded = coded.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    pairs = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).alias("u"), F.col(b).alias("v"))
        for a, b in itertools.combinations(names, 2)
    ]
    stacked = folded.select("_n", F.explode(F.array(*pairs)).alias("p")).select("p.*", "_n")
    return stacked.groupBy("a", "b", "u", "v").agg(F.sum("_n").alias("n"))


def mutual_information(counts: DataFrame) -> dict[tuple[str, str], float]:
    """In nats, for each pair of columns."""
    total = F.sum("n").over(Window.partitionBy("a", "b"))
    own_u = F.sum("n").over(Window.partitionBy("a", "b", "u"))
    own_v = F.sum("n").over(Window.partitionBy("a", "b", "v"))
    parts = counts.select("a", "b", "n", total.alias("t"), own_u.alias("nu"), own_v.alias("nv"))
    share = F.col("n") / F.col("t")
    gain = share * F.log(F.col("n") * F.col("t") / (F.col("nu") * F.col("nv")))
    return {(r.a, r.b): r.i for r in parts.groupBy("a", "b").agg(F.sum(gain).alias("i")).collect()}


def strongest_tree(names: Sequence[str], information: Mapping[tuple[str, str], float]) -> dict[str, str | None]:
    """Each column's parent in the tree of most information, parents first; ties go to earlier columns."""
    order = {name: i for i, name in enumerate(names)}
    weight = lambda a, b: information[(a, b) if order[a] < order[b] else (b, a)]
    parent: dict[str, str | None] = {names[0]: None}
    while len(parent) < len(names):
        _, child, best = max(
            ((weight(a, b), -order[b], -order[a]), b, a) for a in parent for b in names if b not in parent
        )
        parent[child] = best
    return parent


def _conditional_shares(counts: DataFrame, parent: Mapping[str, str | None]) -> DataFrame:
    """child, u (the parent's value, NULL for the first column), values, reached (cumulative shares)."""
    both = counts.unionByName(
        counts.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("v").alias("u"), F.col("u").alias("v"), "n")
    )
    on_edge = F.lit(False)
    for child, of in parent.items():
        if of is not None:
            on_edge = on_edge | ((F.col("a") == of) & (F.col("b") == child))
    first = next(iter(parent))
    some = next(c for c, p in parent.items() if p is not None)
    alone = both.where((F.col("a") == some) & (F.col("b") == first)).groupBy("v").agg(F.sum("n").alias("n"))
    rows = both.where(on_edge).select(F.col("b").alias("child"), "u", "v", "n").unionByName(
        alone.select(F.lit(first).alias("child"), F.lit(None).cast("string").alias("u"), "v", "n")
    )
    own = Window.partitionBy("child", "u")
    upto = F.sum("n").over(own.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    shares = rows.select("child", "u", "v", (upto / F.sum("n").over(own)).alias("r"))
    listed = shares.groupBy("child", "u").agg(F.sort_array(F.collect_list(F.struct("v", "r"))).alias("own"))
    return listed.select("child", "u", F.col("own.v").alias("values"), F.col("own.r").alias("reached"))


def fit_tree(
    df: DataFrame,
    categorical: Sequence[str],
    numeric: Sequence[str] = (),
    datetimes: Sequence[str] = (),
    ranges: int = RANGES,
    points: int = QUANTILES,
) -> Tree:
    """The tree of the given columns (two or more). Missing values are values of their own.

    A category's conditional shares are kept for each value of its parent: columns of very many
    different values (keys, texts) belong into ``copula.fit_copula``. A number without any known value
    is always missing.
    """
    spark, names = df.sparkSession, [*categorical, *numeric, *datetimes]
    if len(names) < 2:
        raise ValueError("a tree needs two columns or more")
    some = [c for c in (*numeric, *datetimes) if df.where(F.col(c).isNotNull()).limit(1).count()]
    numbers = {m.name: m for m in numeric_marginals(df, some, points)} if some else {}
    empty = [c for c in (*numeric, *datetimes) if c not in numbers]
    path = fresh_path(spark, "pair-counts")
    pair_counts(_coded(df, numbers, names, ranges), names).write.parquet(path)
    counts = spark.read.parquet(path)
    information = mutual_information(counts)
    if not information:
        raise ValueError("no rows to fit")
    parent = strongest_tree(names, information)
    shares = fresh_path(spark, "conditional-shares")
    _conditional_shares(counts, parent).write.partitionBy("child").parquet(shares)
    types = {c: df.schema[c].dataType for c in names if c not in empty}
    return Tree(parent, numbers, {**types, **{c: df.schema[c].dataType for c in empty}}, names, shares)


def _within(m: Marginal, code: Column, share: Column, ranges: int) -> Column:
    """A value of the range with that index: the quantiles of its part of the rows, interpolated."""
    grid, edges = list(m.quantiles), _edges(m, ranges)
    starts = [0, *[next(i for i, q in enumerate(grid) if q >= e) for e in edges]]
    stops = [*[max(s - 1, 0) for s in starts[1:]], len(grid) - 1]
    listed = lambda values: F.array(*[F.lit(float(v)) for v in values])
    # element_at of a list of literals gives its last item for a NULL position; get gives NULL.
    begin, end = F.get(listed(starts), code), F.get(listed(stops), code)
    at = begin + share * (end - begin)
    low = F.floor(at).cast("int")
    q, high = listed(grid), F.least(low + 1, F.lit(len(grid) - 1))
    return F.get(q, low) + (at - low) * (F.get(q, high) - F.get(q, low))


def sample_tree(spark: SparkSession, model: Tree, n: int, seed: int = 42, ranges: int = RANGES) -> DataFrame:
    """``n`` rows with a ``row_id``. A row depends on its id and the seed only, so retries repeat it.

    One join a column, on the value of the column it depends on; tables of shares are broadcast where
    measured to be small. A category value that was never seen with its parent's is never drawn with it.
    """
    rows = spark.range(n).select(F.col("id").alias("row_id"))
    table = spark.read.schema("u string, values array<string>, reached array<double>, child string").parquet(model.shares)
    code = {name: f"c{i}" for i, name in enumerate(model.columns)}
    for name, of in model.parent.items():
        own = table.where(F.col("child") == name).select("u", "values", "reached")
        if of is None:
            first = own.first()
            values, reached = (F.array(*[F.lit(x) for x in first[c]]) for c in ("values", "reached"))
            rows = rows.withColumns({"values": values, "reached": reached})
        else:
            rows = rows.join(broadcast_if_small(own.withColumnRenamed("u", code[of])), code[of], "left")
        draw = uniform(f"tree-{seed}-{name}", "row_id")
        below = F.size(F.filter("reached", lambda r: r <= draw))
        at = F.least(below + 1, F.size("values"))
        rows = rows.withColumn(code[name], F.element_at("values", at)).drop("values", "reached")

    def value(name: str) -> Column:
        own = F.when(F.col(code[name]) != _MISSING, F.col(code[name]))
        kind = model.types[name]
        if name not in model.numbers:
            return own.cast(kind)
        share = uniform(f"within-{seed}-{name}", "row_id")
        return from_number(_within(model.numbers[name], own.cast("int"), share, ranges), kind)

    return rows.select("row_id", *[value(name).alias(name) for name in model.columns])
