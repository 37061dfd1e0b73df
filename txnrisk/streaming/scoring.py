"""Score arriving request files with Structured Streaming.

readStream (JSON request files) -> calendar flags -> stream-static left joins
with the frozen snapshots -> fitted pipeline -> writeStream (append, with a
checkpoint).  Each micro-batch is an ordinary batch plan, so a restarted or
failed query resumes from its checkpoint and the sink receives each file once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.serving import score_requests
from ..sources.requests import CHECKED_SCHEMA, CORRUPT, sort_out_records


def request_stream(spark: SparkSession, request_dir: str, max_files_per_trigger: int | None = None,
                   multi_line: bool = False) -> DataFrame:
    """Request files as a stream: JSON lines, or (``multi_line``) one JSON
    array of records per file, like an API body.  Records that may not be scored are
    left out (:func:`sort_out_records` over the same files gives them)."""
    r = spark.readStream.schema(CHECKED_SCHEMA).option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", multi_line)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return sort_out_records(r.json(request_dir)).requests


def start_scoring(spark: SparkSession, request_dir: str, model, customer_snap: DataFrame,
                  terminal_snap: DataFrame, sink_dir: str, checkpoint: str, available_now: bool = True,
                  processing_time: str | None = None, multi_line: bool = False) -> StreamingQuery:
    """``model`` is any fitted configuration; it scores inside the stream's plan."""
    requests = request_stream(spark, request_dir, multi_line=multi_line)
    w = (score_requests(requests, customer_snap, terminal_snap, model).writeStream.format("parquet")
         .outputMode("append").option("path", sink_dir).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")
    return w.start()
