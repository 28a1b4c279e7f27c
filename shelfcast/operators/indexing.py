"""Dense row numbers and running sums over a whole table without a one-task window.

Both work in two levels: rows go to buckets of about equal size, each bucket is numbered (or summed)
on its own, and the bucket totals, a few thousand rows at most, are added up to give each bucket's
starting value.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def _starts(totals: DataFrame, bucket: str, sums: Sequence[str]) -> DataFrame:
    """Running totals of the buckets before each bucket. The input has one row per bucket."""
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        bucket, *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"_start_{s}") for s in sums]
    )


def key_digest(keys: Sequence[str]) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))


def digest_digits(rows: int, bucket_rows: int = 1_000_000) -> int:
    """Hex digits that make buckets of about ``bucket_rows``; 3 to 5, so at most a million starts."""
    return min(max(3, math.ceil(math.log(max(rows / bucket_rows, 1), 16))), 5)


def dense_index(
    df: DataFrame,
    keys: Sequence[str],
    index: str = "row_index",
    hex_digits: int | None = None,
    rows: int = 0,
) -> DataFrame:
    """Number rows 0..n-1 in the order of the MD5 of their key.

    Keys must be unique. The digest's first digits are the bucket, so buckets are even whatever the
    keys look like; their number follows ``rows``, where the count is known, and does not change the
    numbers given. It also bounds the broadcast of the buckets' starts.
    """
    hex_digits = hex_digits or digest_digits(rows)
    marked = df.withColumn("_digest", key_digest(keys)).withColumn(
        "_bucket", F.substring("_digest", 1, hex_digits)
    )
    totals = marked.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"))
    inside = Window.partitionBy("_bucket").orderBy("_digest", *keys)
    return (
        marked.withColumn("_position", F.row_number().over(inside) - 1)
        .join(F.broadcast(_starts(totals, "_bucket", ["n"])), "_bucket")
        .withColumn(index, (F.col("_start_n") + F.col("_position")).cast("long"))
        .drop("_digest", "_bucket", "_position", "_start_n")
    )


def bucket_count(spark: SparkSession, least: int = 64, most: int = 10_000) -> int:
    """A few buckets per shuffle partition, within what a list of borders may hold."""
    return min(max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), least), most)


def sums_below(
    df: DataFrame, order: str, sums: Sequence[str], buckets: int | None = None
) -> DataFrame:
    """Add ``below_<c>``: the sum of c over all rows with a smaller ``order``.

    ``order`` must be unique per row (group first: that also folds hot values). Bucket borders are
    approximate quantiles of the data, but the sums are exact for any borders. Runs one aggregate.
    """
    buckets = buckets or bucket_count(df.sparkSession)
    shares = [i / buckets for i in range(1, buckets)]
    value = F.col(order).cast("double")
    borders = df.agg(F.percentile_approx(value, shares, 10 * buckets)).first()[0] if shares else None
    splits = [float("-inf"), *sorted(set(borders or [0.0])), float("inf")]
    bucketed = Bucketizer(
        splits=splits, inputCol="_order", outputCol="_bucket", handleInvalid="keep"
    ).transform(df.withColumn("_order", value))
    totals = bucketed.groupBy("_bucket").agg(*[F.sum(s).alias(s) for s in sums])
    before = (
        Window.partitionBy("_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    joined = bucketed.select(
        *df.columns,
        "_bucket",
        *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"_inside_{s}") for s in sums],
    ).join(F.broadcast(_starts(totals, "_bucket", sums)), "_bucket")
    return joined.select(
        *df.columns,
        *[(F.col(f"_start_{s}") + F.col(f"_inside_{s}")).alias(f"below_{s}") for s in sums],
    )
