"""Incremental landing of source envelopes with Structured Streaming.

New envelope files arriving under ``<landing>/<entity>/`` are picked up once
each (the file source tracks them in its checkpoint), checked, exploded to
records and written as JSON Lines into the raw layer of their day.  Each
micro-batch writes to its own ``batch=<id>`` directory with overwrite, so a
batch replayed after a failure replaces its own output: the landing is
idempotent and the raw layer sees every file exactly once.

Run with ``trigger(availableNow=True)`` from the daily job to process what has
arrived and stop, or with a processing-time trigger to land continuously.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline import config
from shelfline.sinks import lake as L
from shelfline.sources import envelope as env

_DAY_IN_PATH = r"dt=(\d{4}-\d{2}-\d{2})"


def _land_batch(entity: str, raw_root: str, default_ds: str):
    key = config.ENVELOPE_KEYS[entity]

    def run(docs: DataFrame, batch_id: int) -> None:
        env.assert_envelopes(env.envelope_check(docs, key), entity)
        recs = env.envelope_records(docs, key)
        if entity == "customers":
            recs = env.privacy_projection(recs, config.CUSTOMER_SOURCE_FIELDS)
        day = F.coalesce(F.nullif(F.regexp_extract("source_file", _DAY_IN_PATH, 1), F.lit("")),
                         F.lit(default_ds))
        out = env.in_source_order(recs).select(day.alias("dt"), F.lit(batch_id).alias("batch"), "record")
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("dt", "batch").text(raw_root))
    return run


def land_stream(spark: SparkSession, landing_dir: str, lake_root: str, entity: str,
                checkpoint: str, default_ds: str, available_now: bool = True):
    """Start (and, with ``available_now``, finish) the landing stream of one entity."""
    docs = (spark.readStream.format("text").option("wholetext", "true")
            .load(landing_dir)
            .select(F.col("_metadata.file_path").alias("source_file"), "value"))
    raw_root = L.Lake(lake_root).raw(entity)
    writer = (docs.writeStream.foreachBatch(_land_batch(entity, raw_root, default_ds))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query
