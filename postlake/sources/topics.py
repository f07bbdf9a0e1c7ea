"""Topics of JSON messages: Kafka, or a folder per topic with the same interface.

Both give and take rows of one text column `value`.
"""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from postlake import files
from postlake.schemas import record
from postlake.session import empty
from postlake.sources.exports import read_export

LOGGER = logging.getLogger(__name__)


@dataclass
class KafkaTopics:
    """Kafka topics. `options` go to the reader and writer as they are, so they
    hold the servers, and for a reader `startingOffsets` and the group."""

    spark: SparkSession
    options: dict[str, str]

    def stream(self, topic: str) -> DataFrame:
        reader = self.spark.readStream.format("kafka").options(**self.options)
        return reader.option("subscribe", topic).load().selectExpr("CAST(value AS STRING) AS value")

    def write(self, messages: DataFrame, topic: str) -> None:
        writer = messages.write.format("kafka").options(**self.options)
        writer.option("topic", topic).save()

    def sink(self, messages: DataFrame, topic: str) -> DataStreamWriter:
        writer = messages.writeStream.format("kafka").options(**self.options)
        return writer.option("topic", topic)


@dataclass
class FileTopics:
    """Topics as folders, with one of Parquet files for each write, so several writers can send at once."""

    spark: SparkSession
    root: str
    options: dict[str, str] = field(default_factory=dict)

    def _path(self, topic: str) -> str:
        return f"{self.root}/{topic}"

    def stream(self, topic: str) -> DataFrame:
        # A reader may be there before the first message, as with a broker.
        if not files.exists(self.spark, self._path(topic)):
            self.write(empty(self.spark, record("value")), topic)
        reader = self.spark.readStream.schema("value string").options(**self.options)
        return reader.parquet(f"{self._path(topic)}/*")

    def read(self, topic: str) -> DataFrame:
        """All messages so far; none for a topic nobody has written to."""
        return read_export(self.spark, f"{self._path(topic)}/*", record("value"), missing="skip")

    def write(self, messages: DataFrame, topic: str) -> None:
        messages.select("value").write.parquet(f"{self._path(topic)}/sent-{uuid.uuid4().hex}")

    def sink(self, messages: DataFrame, topic: str) -> DataStreamWriter:
        def deliver(batch: DataFrame, _: int) -> None:
            self.write(batch, topic)

        return messages.writeStream.foreachBatch(deliver)


Topics = KafkaTopics | FileTopics


def finish(queries: list[StreamingQuery]) -> None:
    """Wait until all queries have ended. The first failure of any of them stops the others and is raised, also where those run on."""
    if not queries:
        return
    streams = SparkSession.active().streams
    try:
        while True:
            # Ended ones are forgotten before they are looked at, so none is missed.
            streams.resetTerminated()
            for query in queries:
                if query.exception() is not None:
                    query.awaitTermination()
            if not any(query.isActive for query in queries):
                return
            try:
                streams.awaitAnyTermination()
            except StreamingQueryException as failed:
                LOGGER.info("a stream failed: %s", failed)
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
