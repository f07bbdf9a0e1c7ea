"""Exported posts to the monthly index."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from postlake.operators.filters import MIN_YEAR, from_year
from postlake.schemas import EXPORT
from postlake.sinks.bulk import BULK_BYTES, register
from postlake.sinks.index import PREFIX, index_rows
from postlake.sources.exports import stream_export
from postlake.sources.topics import finish

SLICE = {"availableNow": True}


def publish_index_stream(
    spark: SparkSession,
    export: str,
    deliver: Callable[[DataFrame], None],
    checkpoint: str,
    prefix: str = PREFIX,
    min_year: int = MIN_YEAR,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Start the query that filters, routes and delivers an export's posts.

    `deliver` gets the index rows of a micro-batch; it must bear a repeated one,
    as a keyed table or an index by document id does.
    """
    posts = from_year(stream_export(spark, export, EXPORT), min_year)
    rows = index_rows(posts, prefix)
    return (
        rows.writeStream.foreachBatch(lambda batch, _: deliver(batch))
        .queryName("publish index")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or SLICE))
        .start()
    )


def publish_index(
    spark: SparkSession,
    export: str,
    deliver: Callable[[DataFrame], None],
    checkpoint: str,
    prefix: str = PREFIX,
    min_year: int = MIN_YEAR,
) -> None:
    """Index what the export holds now, then return."""
    finish([publish_index_stream(spark, export, deliver, checkpoint, prefix, min_year)])


def publish_bulks(
    spark: SparkSession,
    export: str,
    path: str,
    checkpoint: str,
    prefix: str = PREFIX,
    min_year: int = MIN_YEAR,
    bulk_bytes: int = BULK_BYTES,
    max_files: int | None = None,
    max_bytes: int | None = None,
    archive: str | None = None,
) -> None:
    """Deliver what the export holds now to a folder of bulks, in micro-batches of bounded size, then return. Files that
    are delivered go to `archive`."""
    register(spark)
    posts = stream_export(spark, export, EXPORT, max_files=max_files, max_bytes=max_bytes, archive=archive)
    rows = index_rows(from_year(posts, min_year), prefix)
    sink = rows.writeStream.format("bulk_index").option("path", path).option("bulk_bytes", bulk_bytes)
    finish([sink.queryName("publish bulks").option("checkpointLocation", checkpoint).trigger(**SLICE).start()])
