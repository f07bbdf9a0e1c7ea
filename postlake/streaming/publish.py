"""Extracted records to topics, one JSON message per record."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from postlake.functions.payload import message_json
from postlake.schemas import BY_KIND
from postlake.sinks.extracted import folder
from postlake.sources.exports import stream_export
from postlake.sources.segments import batches
from postlake.sources.topics import Topics, finish

SLICE = {"availableNow": True}
CONTINUOUS = {"processingTime": "3 seconds"}
SEGMENTS_AT_ONCE = 4


def publish_streams(
    spark: SparkSession,
    extracted: str,
    segments: Sequence[str],
    topics: Topics,
    names: Mapping[str, str],
    checkpoint: str,
    trigger: Mapping | None = None,
) -> list[StreamingQuery]:
    """Start a query per kind and segment.

    Each has a folder as its source that stays the same, and a checkpoint of its own under the given one, so whatever lists of
    segments the calls name, a record is sent once. A kind that a segment lacks is skipped.
    """
    queries = []
    for kind, topic in names.items():
        for segment in segments:
            rows = stream_export(spark, folder(extracted, segment, kind), BY_KIND[kind], missing="skip")
            if rows is None:
                continue
            sink = topics.sink(rows.select(message_json().alias("value")), topic)
            queries.append(
                sink.queryName(f"publish {topic} {segment}")
                .option("checkpointLocation", f"{checkpoint}/{kind}/{topic}/{segment}")
                .trigger(**(trigger or SLICE))
                .start()
            )
    return queries


def publish_topics(
    spark: SparkSession,
    extracted: str,
    segments: Sequence[str],
    topics: Topics,
    names: Mapping[str, str],
    checkpoint: str,
) -> None:
    """Send what the segments hold now, a few of them at a time, then return."""
    for few in batches(segments, SEGMENTS_AT_ONCE):
        finish(publish_streams(spark, extracted, few, topics, names, checkpoint))
