"""An inbox folder as a stream: span files that arrive are appended to the span table. An extension, not a parity claim."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def follow_inbox(spark: SparkSession, inbox: str, table: str, checkpoint: str, schema: StructType | str) -> StreamingQuery:
    """Take in what is there, each file once, then stop."""
    return spark.readStream.schema(schema).json(inbox).writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
