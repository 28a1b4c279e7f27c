"""Boolean flags held as text, and the flags derived from them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .casting import ColumnOrName, as_column

# The spellings of yes and no. Anything else is unknown.
TRUE_TEXTS = ["true", "1", "t", "yes"]
FALSE_TEXTS = ["false", "0", "f", "no", ""]


def parse_flag(value: ColumnOrName) -> Column:
    """Text (or boolean) to a three-valued boolean."""
    spelled = F.lower(as_column(value).cast("string"))
    return F.when(spelled.isin(TRUE_TEXTS), F.lit(True)).when(
        spelled.isin(FALSE_TEXTS), F.lit(False)
    )


def out_of_stock(qty: ColumnOrName, *flags: ColumnOrName) -> Column:
    """No stock to promise, or any flag set. Three-valued: FALSE OR NULL is NULL."""
    condition = F.coalesce(as_column(qty), F.lit(0.0)) <= 0
    for flag in flags:
        condition = condition | as_column(flag)
    return condition


def flag_to_int(value: ColumnOrName) -> Column:
    return as_column(value).cast("int")
