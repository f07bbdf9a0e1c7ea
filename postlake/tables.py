"""Tables of one deployment: queues that writes add to, and keyed tables that upserts change.

Both are plain Parquet that Spark writes and reads by itself. A queue gets a folder for each write and is read down to one row per
key, so whatever comes twice counts once. A keyed table holds one row per key in a folder for each hash bucket of its keys;
an upsert rewrites the buckets its keys fall into, by dynamic partition overwrite, and no others. The buckets are those of Spark's
own bucketed tables, so a join on the keys, an upsert above all, shuffles the other side only. They double in number, by an
upsert that writes the whole table, as often as it takes for one of them to stay small enough for a task.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from postlake import files, schemas
from postlake.operators.latest import top_per_key
from postlake.operators.upsert import merge_into
from postlake.session import EXPANSION, co_located, empty, setting

BUCKETS = 8
# Bytes of rows that a bucket is to hold, or an upsert to bring to it; a task holds them several times, to sort and to write.
BUCKET_BYTES = 64 << 20


@dataclass
class Queue:
    """Rows by the write they came with. `date` orders the rows of a key, newest first; rows of one date go to the later write,
    further ties by the other columns. Without a date the later write wins."""

    spark: SparkSession
    path: str
    schema: StructType
    keys: tuple[str, ...]
    date: str | None = "crawl_date"
    # Columns stored beside the record, null where a write lacks them.
    beside: StructType = field(default_factory=StructType)
    # A subfolder of each write, where one job writes two queues.
    side: str = ""

    def batches(self) -> list[str]:
        return files.matching(self.spark, f"{self.path}/batch=*{self.side}")

    def append(self, df: DataFrame) -> None:
        beside = [F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in self.beside]
        df.select(*self.schema.names, *beside).write.parquet(f"{self.path}/batch={time.time_ns()}{self.side}")

    def replace(self, df: DataFrame) -> None:
        """Make the rows of `df` the whole queue. Until the old ones are gone both are there, which the keys absorb."""
        old = self.batches()
        self.append(df)
        self._delete(old)

    def truncate(self) -> None:
        self._delete(self.batches())

    def _delete(self, paths: Sequence[str]) -> None:
        for path in paths:
            files.delete(self.spark, path)

    def rows_beside(self) -> DataFrame:
        """All rows as written, several per key, with the columns beside them and `batch`, which orders the writes."""
        schema = StructType([*self.schema.fields, *self.beside.fields, StructField("batch", LongType())])
        found = self.batches()
        if not found:
            return empty(self.spark, schema)
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*found)

    def rows(self) -> DataFrame:
        return self.rows_beside().select(*self.schema.names)

    def newest(self, *keys: str) -> DataFrame:
        """One row for each value of some of the keys, in one pass: dates, then writes decide."""
        first = [F.col(self.date).desc_nulls_last()] if self.date else []
        rest = [F.col(c).desc_nulls_last() for c in self.schema.names if c not in (*keys, self.date)]
        return top_per_key(self.rows_beside(), keys, [*first, F.col("batch").desc(), *rest]).select(*self.schema.names)

    def read(self) -> DataFrame:
        return self.newest(*self.keys)


@dataclass
class KeyedTable:
    """One row per `keys`, none of which may be null. An upsert replaces a saved row unless the saved `date` is newer, or the same
    with `ties_keep_saved`; without a date the last upsert wins. One writer at a time."""

    spark: SparkSession
    path: str
    schema: StructType
    keys: tuple[str, ...]
    date: str | None = "crawl_date"
    ties_keep_saved: bool = False
    # How many it starts with.
    buckets: int = BUCKETS

    def count(self) -> int:
        """How many buckets it has. A grown table lies in a folder of its own, which counts from when all of it is there."""
        whole = files.matching(self.spark, f"{self.path}/grown-*/_WHOLE")
        return max([int(path.split("/")[-2].removeprefix("grown-")) for path in whole], default=self.buckets)

    def _folder(self, count: int) -> str:
        return self.path if count == self.buckets else f"{self.path}/grown-{count}"

    def _name(self, count: int) -> str:
        return f"postlake_{hashlib.md5(f'{self.path} {count}'.encode()).hexdigest()}"

    def table(self, count: int | None = None) -> str:
        """Its name in the session's catalog, where the buckets are declared."""
        count = count or self.count()
        name = self._name(count)
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
            keys = ", ".join(f"`{k}`" for k in self.keys)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}, bucket INT) USING parquet PARTITIONED BY (bucket) "
                f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {count} BUCKETS LOCATION '{self._folder(count)}'"
            )
            if files.exists(self.spark, self._folder(count)):
                self.spark.catalog.recoverPartitions(name)
        return name

    def bucket(self, count: int | None = None) -> Column:
        """The hash by which Spark deals rows to partitions and buckets."""
        return F.pmod(F.hash(*self.keys), F.lit(count or self.count())).cast("int")

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        count = self.count()
        rows = self.spark.table(self.table(count))
        if buckets is not None and len(buckets) < count:
            rows = rows.where(F.col("bucket").isin(list(buckets)))
        return rows.select(*self.schema.names)

    def _bytes(self, rows: DataFrame) -> dict[int, int]:
        """Bytes of the values of rows, by the buckets they fall into."""
        width = F.lit(8 * len(self.schema))
        for column in self.schema:
            if column.name in rows.columns and isinstance(column.dataType, StringType):
                width = width + F.coalesce(F.octet_length(column.name), F.lit(0))
        sums = rows.groupBy(self.bucket().alias("bucket")).agg(F.sum(width.cast("bigint")).alias("bytes"))
        return {r["bucket"]: r["bytes"] for r in sums.collect()}

    def _merged(self, new: DataFrame, buckets: Sequence[int] | None, count: int) -> DataFrame:
        rows = merge_into(self.read(buckets), new, self.keys, self.date, self.ties_keep_saved)
        return rows.select(*self.schema.names, self.bucket(count).alias("bucket"))

    def merged(self, new: DataFrame, touching: DataFrame | None = None) -> DataFrame:
        """The buckets that an upsert writes, as they are after it."""
        return self._merged(new, list(self._bytes(new if touching is None else touching)), self.count())

    def upsert(self, new: DataFrame, touching: DataFrame | None = None) -> None:
        """Put rows, unique by key. `touching` has the keys of all of them where that is cheaper to read, and their other columns
        as far as these take room."""
        new, count = new.select(*self.schema.names), self.count()
        found = self._bytes(new if touching is None else touching)
        folder = self._folder(count)
        saved = files.size(self.spark, folder) * EXPANSION if files.exists(self.spark, folder) else 0
        wanted = count
        while wanted * BUCKET_BYTES < max(saved, sum(found.values())):
            wanted *= 2
        with co_located(self.spark, wanted):
            if wanted == count:
                self._merged(new, list(found), count).write.mode("overwrite").insertInto(self.table(count))
            else:
                self._grow(new, count, wanted)

    def _grow(self, new: DataFrame, count: int, wanted: int) -> None:
        """An upsert that writes the whole table to more buckets. What a failed one left is no part of the table."""
        self._drop(wanted)
        self._merged(new, None, wanted).write.mode("overwrite").insertInto(self.table(wanted))
        files.touch(self.spark, f"{self._folder(wanted)}/_WHOLE")
        self._drop(count)

    def _drop(self, count: int) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._name(count)}")
        start = files.matching(self.spark, f"{self.path}/bucket=*") if count == self.buckets else [self._folder(count)]
        for folder in start:
            files.delete(self.spark, folder)

    def put(self, rows: DataFrame) -> None:
        """Put rows that may repeat a key; the newest of each counts, ties by the other columns."""
        first = [F.col(self.date).desc_nulls_last()] if self.date else []
        rest = [F.col(c).desc_nulls_last() for c in self.schema.names if c not in (*self.keys, self.date)]
        self.upsert(top_per_key(rows, self.keys, [*first, *rest]), touching=rows)

    def truncate(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._name(self.count())}")
        files.delete(self.spark, self.path)


def append_split(rows: DataFrame, flag: str, root: str) -> None:
    """Append rows to the two queues of a root by a boolean column; one job writes both, so what made the rows runs once."""
    rows.write.partitionBy(flag).parquet(f"{root}/batch={time.time_ns()}")


def append_apart(rows: DataFrame, flag: str, others: Queue, flagged: Queue) -> None:
    """Append rows to two queues with folders of their own by a boolean column; one job writes both, to a folder that no reader
    sees, from which each gets its part."""
    batch, staged = f"batch={time.time_ns()}", f"{others.path}/_staged-{uuid.uuid4().hex}"
    spark = rows.sparkSession
    # Two files open at once, so no task need sort its rows by the flag.
    with setting(spark, maxConcurrentOutputFileWriters="2"):
        rows.write.partitionBy(flag).parquet(staged)
    for value, queue in (("true", flagged), ("false", others)):
        if files.exists(spark, f"{staged}/{flag}={value}"):
            files.move(spark, f"{staged}/{flag}={value}", f"{queue.path}/{batch}{queue.side}")
    files.delete(spark, staged)


def rotate(source: Queue, target: Queue, keep: Column | None = None) -> None:
    """Move the rows of one queue into another of the same keys, replacing its rows. The target is written before the source is
    emptied, so a failure in between leaves the rows in both, never in neither."""
    rows = source.read()
    target.replace(rows if keep is None else rows.where(keep))
    source.truncate()


@dataclass
class Lake:
    """The tables of one deployment, as folders under `root`. `buckets`, what its keyed tables start with, stays the same for good."""

    spark: SparkSession
    root: str
    buckets: int = BUCKETS

    def _queue(self, name: str, schema: StructType, *keys: str, **options) -> Queue:
        return Queue(self.spark, f"{self.root}/{name}", schema, keys, **options)

    def _keyed(self, name: str, schema: StructType, *keys: str, **options) -> KeyedTable:
        return KeyedTable(self.spark, f"{self.root}/{name}", schema, keys, buckets=self.buckets, **options)

    @property
    def profile_to_process(self) -> Queue:
        return self._queue("profile_to_process", schemas.PROFILE, "url", "crawl_date", beside=schemas.INGESTED)

    @property
    def post_to_process(self) -> Queue:
        return self._queue("post_to_process", schemas.POST, "url", "crawl_date", beside=schemas.INGESTED)

    @property
    def post_to_es(self) -> Queue:
        return self._queue("joined", schemas.DETAILED, "url", beside=schemas.INGESTED, side="/author_matched=true")

    @property
    def post_without_profile(self) -> Queue:
        return self._queue("joined", schemas.POST, "url", "crawl_date", side="/author_matched=false")

    @property
    def undated(self) -> Queue:
        return self._queue("undated", schemas.DETAILED, "url")

    @property
    def unrepaired(self) -> Queue:
        return self._queue("unrepaired", schemas.POST, "url")

    @property
    def bad_messages(self) -> Queue:
        return self._queue("bad_messages", schemas.BAD_MESSAGE, "topic", "message", date=None)

    @property
    def profile(self) -> KeyedTable:
        return self._keyed("profile", schemas.PROFILE, "url", ties_keep_saved=True)

    @property
    def profile_tmp(self) -> KeyedTable:
        return self._keyed("profile_tmp", schemas.PROFILE, "url")

    @property
    def post(self) -> KeyedTable:
        return self._keyed("post", schemas.POST, "url")

    @property
    def index(self) -> KeyedTable:
        return self._keyed("index", schemas.INDEX_ROW, "index_name", "_id", date=None)
