"""Incremental indexing: item documents that have come since the last run, once each (J3, S17 as a stream)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..sources.catalog import ITEM


def index_new_items(spark: SparkSession, root: str, index: str, checkpoint: str):
    """Appends items under root that no earlier run has indexed, then ends; the checkpoint knows which."""
    d = spark.readStream.schema(ITEM).option("multiLine", "true").option("recursiveFileLookup", "true").json(root)
    d = d.withColumns({n: F.try_element_at("bbox", F.lit(i + 1)) for i, n in enumerate(("west", "south", "east", "north"))})
    return d.writeStream.format("parquet").option("path", index).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
