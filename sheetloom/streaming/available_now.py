"""Incremental loads driven by newly landed files."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from sheetloom.operators.lookup import DEFAULT_LIMITS, LookupLimits
from sheetloom.plans.loads import load_batch
from sheetloom.sources.landed import landing_schema
from sheetloom.spec import RAW_SCHEMA, DatasetSpec


def load_available(
    spark: SparkSession,
    landing: str,
    target: str,
    spec: DatasetSpec,
    stream_checkpoint: str,
    ingested_at: datetime.datetime | str | None = None,
    limits: LookupLimits = DEFAULT_LIMITS,
    typed: bool = False,
) -> None:
    """Load everything landed since the last call, then stop.

    The stream reports files it has not seen; a call with none does nothing. Each batch is merged from its own rows. What
    has to be known of earlier ones, the header of each tab, the rows read and the blocks where rows wait for a header, is
    published with every version of the target, so it changes together with the data: a batch that is repeated after a
    failure finds its rows read and changes nothing. ``typed``: the landing's cells are variants.
    """

    def one_batch(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            load_batch(batch, landing, spec, target, ingested_at, limits)

    landed = F.unix_micros("_metadata.file_modification_time").alias("landed_seq")
    stream = (
        spark.readStream.schema(landing_schema(typed))
        .parquet(landing)
        .select(*RAW_SCHEMA.fieldNames(), landed)
        .where(F.lower("source_sheet").contains(spec.tab_token))
    )
    query = (
        stream.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", stream_checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
