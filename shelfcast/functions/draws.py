"""Repeatable random draws.

A draw is a function of the row's key and a salt, not of the task that computes it: a retried or
re-planned task gives the same values, and any engine with MD5 can reproduce them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .casting import ColumnOrName, as_column


def uniform(salt: str, *keys: ColumnOrName) -> Column:
    """Uniform in [0, 1): the first 8 hex digits of md5(key|key|...|salt) over 2**32."""
    parts = [as_column(k).cast("string") for k in keys]
    digest = F.md5(F.concat_ws("|", *parts, F.lit(salt)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def joined_key(*keys: ColumnOrName) -> Column:
    """The keys as one text that stands for them as the first key of ``uniform``; NULL if all of them are.

    Many draws of one key join its texts once.
    """
    parts = [as_column(k).cast("string") for k in keys]
    return F.when(F.coalesce(*parts).isNotNull(), F.concat_ws("|", *parts))


def between(draw: Column, low: float, high: float) -> Column:
    return F.lit(float(low)) + draw * F.lit(float(high - low))


def integer(draw: Column, low: int, high: int) -> Column:
    """Integer in [low, high)."""
    return F.lit(low) + F.floor(draw * (high - low))


def bernoulli(draw: Column, probability: float) -> Column:
    return draw < probability


def choice(draw: Column, values: Sequence) -> Column:
    """One of a fixed list, equally likely."""
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, (F.floor(draw * len(values)) + 1).cast("int"))


def weighted_choice(draw: Column, weights: Sequence[tuple[object, float]]) -> Column:
    """One of (value, probability) pairs; the last value takes the rest."""
    reached = weights[0][1]
    column = F.when(draw < reached, F.lit(weights[0][0]))
    for value, probability in weights[1:-1]:
        reached += probability
        column = column.when(draw < reached, F.lit(value))
    return column.otherwise(F.lit(weights[-1][0]))


def standard_normal(first: Column, second: Column) -> Column:
    """Box-Muller from two uniforms."""
    return F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - first)) * F.cos(F.lit(2.0 * math.pi) * second)


def vary(value: ColumnOrName, draw: Column, share: float) -> Column:
    """Value times 1 +/- share; NULL stays NULL."""
    return as_column(value) * (F.lit(1.0) + between(draw, -share, share))
