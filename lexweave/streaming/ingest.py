"""Arriving act records as a stream: parsed, shredded and upserted batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.shred import ActGraph, act_items, graph_of
from ..sources.documents import usable_documents
from ..sources.schema import document_schema


def document_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Act records from JSON-lines files as they arrive in a folder."""
    stream = spark.readStream.schema(document_schema()).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", True)
    return usable_documents(stream.json(path))


def load_batch(batch: DataFrame, batch_id: int, out: str) -> None:
    """Writes the nodes and edges of one batch below ``out``, in a folder of the batch and one for each kind, in one pass over the batch.
    A batch that is run again replaces its own folder, so each record counts once however often it is tried. Edges that hang on nodes
    of other batches, such as citations, are written open; ``current_graph`` resolves them."""
    act_items(batch).drop("version").write.mode("overwrite").partitionBy("what").parquet(f"{out}/items/batch={batch_id}")


def start_loading(documents: DataFrame, out: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Starts the load; ``trigger`` as for a stream writer (``availableNow=True`` takes what is there and ends)."""
    return documents.writeStream.option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "1 minute"})).foreachBatch(lambda df, n: load_batch(df, n, out)).start()


def current_graph(spark: SparkSession, out: str) -> ActGraph:
    """The graph over all batches: of each node the last written, and the edges whose ends are there; an act may be cited before or after
    the batch that brings it."""
    items = spark.read.parquet(f"{out}/items")
    return graph_of(items.withColumn("version", F.lpad(F.col("batch").cast("string"), 20, "0")).drop("batch"))


def current_nodes(spark: SparkSession, out: str, label: str) -> DataFrame:
    return current_graph(spark, out).nodes[label]


def current_edges(spark: SparkSession, out: str) -> DataFrame:
    return current_graph(spark, out).edges


def arrivals(events: DataFrame, at: str, key: str, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Distinct keys per time window of a stream: rows later than ``late`` are left out, a window is final when the watermark passes it."""
    return events.withWatermark(at, late).groupBy(F.window(at, width).alias("window"), key).agg(F.count(F.lit(1)).alias("n_rows")).select(F.col("window.start").alias("window_start"), key, "n_rows")
