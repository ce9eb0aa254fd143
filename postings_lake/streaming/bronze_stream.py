"""Landed page files -> bronze, incrementally.

Each run of the search fetch lands its pages as files
``(country, page, body, ingested_at)`` under one directory. A file-source
stream picks up only the files it has not seen (tracked in the checkpoint),
and every micro-batch goes through the same batch operators as
:func:`postings_lake.plans.flow.bronze_step`: cut-off, flatten, append.

Each micro-batch is one bronze batch, named after the query (its id lives in the
checkpoint) and the batch's number. A batch that is retried after a failure is found
in the bronze log and appended once.

The cut-off looks at one run at a time, within a micro-batch; a batch takes every
file that has landed, so the files of one run should be moved in together.
"""
from __future__ import annotations

import hashlib

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from postings_lake.sources import landing, tables
from postings_lake.sources.tables import Layout

LANDED_PAGE_SCHEMA = landing.LANDED_PAGE_SCHEMA


def stream_id(landing_dir: str, layout: Layout) -> str:
    """The same name for the same folder and lake in every process."""
    return "bronze_" + hashlib.sha256(f"{landing_dir}\n{layout.root}".encode()).hexdigest()[:16]


def default_checkpoint(spark: SparkSession, landing_dir: str, layout: Layout) -> str:
    """``<spark.checkpoint.dir>/streams/<stream_id>``: a folder of its own for
    each landing folder and lake, on the cluster's shared storage."""
    from postings_lake.plans.flow import shared_checkpoint_dir

    return f"{shared_checkpoint_dir(spark).rstrip('/')}/streams/{stream_id(landing_dir, layout)}"


def query_id(batch: DataFrame) -> str:
    """The running query's id: the same for all runs on one checkpoint, new with a new one."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def start_bronze_stream(
    spark: SparkSession,
    landing_dir: str,
    layout: Layout,
    *,
    checkpoint: str | None = None,
    file_format: str = "json",
    max_pages: int | None = None,
    mode: str = "FAILFAST",
    source: str = landing.DEFAULT_SOURCE,
    fmt: str = tables.DEFAULT_FORMAT,
    available_now: bool = True,
    interval: str = "10 minutes",
) -> StreamingQuery:
    """Start the stream; returns the running query.

    ``available_now=True`` processes every new file and stops (a scheduled
    batch run with exactly-once file tracking); otherwise it polls every
    ``interval``.
    """
    pages = spark.readStream.schema(LANDED_PAGE_SCHEMA).format(file_format).load(landing_dir)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # The emptiness check and the write read the batch; hold it so its
        # files are read once (they are read again if a block is lost).
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = landing.pages_to_bronze(held, max_pages=max_pages, source=source, mode=mode)
            tables.append_bronze(rows, layout, f"{stream_id(landing_dir, layout)}/{query_id(batch)}/{batch_id}", fmt)
        finally:
            held.unpersist()

    writer = (
        pages.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint or default_checkpoint(spark, landing_dir, layout))
        .queryName(stream_id(landing_dir, layout))
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
