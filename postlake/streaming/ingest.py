"""Topics into the queue tables.

Each topic is a query of its own with its own checkpoint. A micro-batch becomes
one keyed append; delivery is at least once and the keys make a repeated batch
harmless. Messages that hold no record go to the `bad_messages` table. With a
replay window, messages that a topic repeats within it are dropped before they
are written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postlake.functions.payload import CORRUPT, decode_message
from postlake.schemas import BY_KIND
from postlake.sources.topics import Topics, finish
from postlake.tables import Lake, Queue, append_apart

# A slice reads what is there when it starts, then ends.
SLICE = {"availableNow": True}
# The checkpoint interval of a query that runs on.
CONTINUOUS = {"processingTime": "30 seconds"}


def decode_stream(messages: DataFrame, kind: str, strict: bool = False) -> DataFrame:
    """Record columns, plus `_corrupt`, the message and `ingest_ts`."""
    decoded = messages.select("value", decode_message("value", BY_KIND[kind], strict).alias("_record"))
    rows = decoded.select("value", "_record.*", F.current_timestamp().alias("ingest_ts"))
    if strict:
        return rows.withColumn(CORRUPT, F.lit(None).cast("string"))
    # A message without a url has no key to be stored under.
    unkeyed = F.when(F.col("url").isNull(), F.coalesce("value", F.lit("")))
    return rows.withColumn(CORRUPT, F.coalesce(CORRUPT, unkeyed))


def without_replays(rows: DataFrame, window: str) -> DataFrame:
    """Decoded messages but those that came before, byte for byte, up to `window` earlier. The clock is the time they came in, which
    never runs behind, so no message is too late; the state holds a digest of each message of one window."""
    timed = rows.withColumn("_digest", F.sha2(F.coalesce("value", F.lit("")), 256)).withWatermark("ingest_ts", window)
    return timed.dropDuplicatesWithinWatermark(["_digest"]).drop("_digest")


def _deliver(batch: DataFrame, topic: str, table: Queue, bad: Queue) -> None:
    """One job writes both queues, so the batch is read and decoded once, and is held nowhere."""
    is_bad = F.col(CORRUPT).isNotNull()
    message = {
        "topic": F.lit(topic),
        "message": F.col("value"),
        "reason": F.lit("no record"),
    }
    columns = [F.when(is_bad, value).alias(name) for name, value in message.items()]
    have = [f.name for f in (*table.schema, *table.beside) if f.name in batch.columns]  # the others read as null
    rows = batch.select(*have, *columns, is_bad.alias("is_bad"))
    append_apart(rows, "is_bad", table, bad)


def ingest_topic(
    topics: Topics,
    topic: str,
    kind: str,
    table: Queue,
    bad: Queue,
    checkpoint: str,
    trigger: Mapping | None = None,
    strict: bool = False,
    replay_window: str | None = None,
) -> StreamingQuery:
    """Start the query that feeds one topic into one table."""
    rows = decode_stream(topics.stream(topic), kind, strict)
    if replay_window:
        rows = without_replays(rows, replay_window)
    counted = rows.observe(f"{kind}_rows", F.count(F.lit(1)).alias("rows"))

    def deliver(batch: DataFrame, _: int) -> None:
        _deliver(batch, topic, table, bad)

    return (
        counted.writeStream.foreachBatch(deliver)
        .queryName(f"ingest {topic}")
        .option("checkpointLocation", f"{checkpoint}/{kind}/{topic}")
        .trigger(**(trigger or SLICE))
        .start()
    )


def ingest(
    lake: Lake,
    topics: Topics,
    names: Mapping[str, Sequence[str]],
    checkpoint: str,
    trigger: Mapping | None = None,
    strict: bool = False,
    replay_window: str | None = None,
) -> list[StreamingQuery]:
    """Start one query per topic; `names` lists the topics of each kind.

    Several sources share the tables by listing several topics. A kind without
    topics is left out.
    """
    tables = {
        "profile": lake.profile_to_process,
        "post": lake.post_to_process,
        "detailed": lake.post_to_es,
    }
    jobs = [(kind, topic) for kind in tables for topic in names.get(kind, ())]
    return [
        ingest_topic(topics, topic, kind, tables[kind], lake.bad_messages, checkpoint, trigger, strict, replay_window)
        for kind, topic in jobs
    ]


def ingest_slice(
    lake: Lake,
    topics: Topics,
    names: Mapping[str, Sequence[str]],
    checkpoint: str,
    strict: bool = False,
    replay_window: str | None = None,
) -> list[StreamingQuery]:
    """Take in what the topics hold now, then return the queries that did."""
    queries = ingest(lake, topics, names, checkpoint, SLICE, strict, replay_window)
    finish(queries)
    return queries
