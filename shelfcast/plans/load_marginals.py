"""Marginals kept for each load, so that a refit of all loads doesn't read old ones again.

Numbers and times keep a KLL quantile sketch, categories their counts. Both merge: the marginals of any set
of loads are those of their rows, quantiles within the sketches' error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .copula import LISTED, QUANTILES, Marginal, as_number, categorical_marginals

#: About 0.1 % of rank error, some 60 KB a sketch.
SKETCH_K = 2000


def load_sketches(
    df: DataFrame, load: str, numeric: Sequence[str], datetimes: Sequence[str] = (), k: int = SKETCH_K
) -> DataFrame:
    """load, name, rows, known, sketch: a row a load and column, from one pass; partial sketches are shuffled."""
    names = [*numeric, *datetimes]
    values = {c: as_number(c, df.schema[c].dataType) for c in names}
    known = {c: F.when(~F.isnan(v), v) for c, v in values.items()}
    sketches = df.groupBy(F.col(load).cast("string").alias("load")).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.kll_sketch_agg_double(known[c], F.lit(k)).alias(f"s{i}") for i, c in enumerate(names)],
        *[F.count(known[c]).alias(f"n{i}") for i, c in enumerate(names)],
    )
    cells = [
        F.struct(F.lit(c).alias("name"), "rows", F.col(f"n{i}").alias("known"), F.col(f"s{i}").alias("sketch"))
        for i, c in enumerate(names)
    ]
    return sketches.select("load", F.explode(F.array(*cells)).alias("cell")).select("load", "cell.*")


def load_counts(df: DataFrame, load: str, categorical: Sequence[str]) -> DataFrame:
    """load, c (column), v (value, may be NULL), n."""
    cells = F.array(*[F.struct(F.lit(n).alias("c"), F.col(n).cast("string").alias("v")) for n in categorical])
    stacked = df.select(F.col(load).cast("string").alias("load"), F.explode(cells).alias("cell"))
    return stacked.select("load", "cell.*").groupBy("load", "c", "v").agg(F.count(F.lit(1)).alias("n"))


def merged_marginals(
    like: DataFrame,
    sketches: DataFrame | None = None,
    counts: DataFrame | None = None,
    numeric: Sequence[str] = (),
    categorical: Sequence[str] = (),
    points: int = QUANTILES,
    listed: int = LISTED,
) -> list[Marginal]:
    """The marginals of all loads given, for ``copula.fit_copula``; ``like`` gives the columns' types.

    ``numeric`` names numbers and times. A column without any known value raises an error.
    """
    found = []
    if numeric:
        shares = F.array(*[F.lit(i / points) for i in range(points + 1)])
        merged = sketches.where(F.col("known") > 0).groupBy("name").agg(F.kll_merge_agg_double("sketch").alias("s"))
        rows = sketches.groupBy("name").agg(F.sum("rows").alias("rows"), F.sum("known").alias("known"))
        wanted = merged.join(rows, "name").select(
            "name", "rows", "known", F.kll_sketch_get_quantile_double("s", shares).alias("q")
        )
        row_of = {r.name: r for r in wanted.collect()}  # a row a column
        for name in numeric:
            if name not in row_of:
                raise ValueError(f"column {name!r} has no known value to fit")
            r = row_of[name]
            found.append(Marginal(name, like.schema[name].dataType, 1.0 - r.known / r.rows, quantiles=list(r.q)))
    if categorical:
        whole = counts.where(F.col("c").isin(list(categorical))).groupBy("c", "v").agg(F.sum("n").alias("n"))
        found += categorical_marginals(like, categorical, listed, whole)
    return found
