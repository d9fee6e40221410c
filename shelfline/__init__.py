"""shelfline — a Spark-native daily retail lakehouse pipeline.

Landed JSON documents are flattened, conformed to typed tables, exploded,
de-duplicated, validated behind a reject-rate gate, loaded into day-partitioned
history, consolidated into a sales fact and upserted into dimensions, with an
audit record per run.  Every operator is a function over DataFrames built from
``pyspark.sql.functions`` so that Catalyst and AQE plan the work.
"""

__version__ = "0.1.0"
