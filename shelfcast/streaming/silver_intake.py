"""Incremental silver by file stream: each landed fulfillment file is joined once.

A triggered batch job, not a running service: it takes what has landed since its last run and stops.
The stream's checkpoint remembers the files, so facts that arrive late for an old day are taken too,
which a day watermark would miss.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession

from ..plans.silver import silver
from ..schemas import PRODUCT_FULFILLMENT


def take_new_facts(
    spark: SparkSession,
    landing: str,
    bronze: Mapping[str, DataFrame],
    target: str,
    checkpoint: str,
    load_ts: Column,
    max_files: int | None = None,
) -> None:
    """Join newly landed Parquet files and add them to ``target``.

    A batch writes its own partition and overwrites it when it is repeated, so a batch that failed
    halfway leaves no duplicates. Batch numbers start anew with a new checkpoint, so each checkpoint
    has a partition of its own, by the id that Spark keeps in it.
    """
    reader = spark.readStream.schema(PRODUCT_FULFILLMENT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = silver(fulfillment=batch, load_ts=load_ts, latest_product_only=True, **bronze)
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        rows.write.mode("overwrite").parquet(f"{target}/stream={stream}/batch={batch_id}")

    (
        reader.parquet(landing)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
