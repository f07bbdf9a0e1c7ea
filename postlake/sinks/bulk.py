"""A data source that delivers index rows in bulks: `df.write.format("bulk_index")`, or the same for a stream.

A bulk is what a search index takes in one request: for each document a line that names its index and id, and a line with the
document. A task starts a new bulk before one would pass `bulk_bytes`; a document larger than that has a bulk of its own. Tasks
write under `_staged`; what a task wrote counts when the job commits, and a job that fails leaves nothing. A micro-batch has a
folder by its number, so a batch that Spark repeats replaces what it delivered before. `path` may be on any file system that Arrow
opens.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

# The writers travel with the jobs that use them, so workers need not have the library on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: bytes up to which documents go in one request.
BULK_BYTES = 5 << 20


def bulks(rows: Iterator[tuple[str, str, str]], most: int) -> Iterator[bytes]:
    """Requests of up to `most` bytes of (index, id, document) rows."""
    held, size = [], 0
    for index, key, source in rows:
        action = json.dumps({"index": {"_index": index, "_id": key}}, ensure_ascii=False, separators=(",", ":"))
        entry = f"{action}\n{source}\n".encode()
        if held and size + len(entry) > most:
            yield b"".join(held)
            held, size = [], 0
        held.append(entry)
        size += len(entry)
    if held:
        yield b"".join(held)


@dataclass
class Delivered(WriterCommitMessage):
    """Bulks of one task, staged under a job's folder."""

    job: str
    names: list[str]


class _Folder:
    """What the batch and the stream writer share."""

    def __init__(self, options: dict[str, str]):
        self.path, self.most = options["path"], int(options.get("bulk_bytes", BULK_BYTES))
        self.job = uuid.uuid4().hex

    def _at(self, *names: str):
        system, root = fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path.removeprefix("file:"))
        return system, "/".join((root.rstrip("/"), *names))

    def write(self, batches: Iterator[pa.RecordBatch]) -> Delivered:
        task, names = uuid.uuid4().hex, []
        rows = (row for b in batches for row in zip(*(b.column(c).to_pylist() for c in ("index_name", "_id", "source"))))
        for body in bulks(rows, self.most):
            names.append(f"bulk-{task}-{len(names):06}")
            system, path = self._at("_staged", self.job)
            system.create_dir(path, recursive=True)
            with system.open_output_stream(f"{path}/{names[-1]}") as out:
                out.write(body)
        return Delivered(self.job, names)

    def _publish(self, messages: list[Delivered | None], folder: str) -> None:
        system, target = self._at(folder)
        if system.get_file_info(target).type == fs.FileType.Directory:
            system.delete_dir(target)
        system.create_dir(target, recursive=True)
        for message in messages:
            for name in message.names if message else ():
                system.move(self._at("_staged", message.job, name)[1], f"{target}/{name}")

    def _clear(self, *names: str) -> None:
        system, staged = self._at("_staged", *names)
        if system.get_file_info(staged).type == fs.FileType.Directory:
            system.delete_dir(staged)


class _BatchWriter(_Folder, DataSourceArrowWriter):
    def commit(self, messages) -> None:
        self._publish(messages, f"job={self.job}")
        self._clear(self.job)

    def abort(self, messages) -> None:
        self._clear(self.job)


class _StreamWriter(_Folder, DataSourceStreamArrowWriter):
    """A stream is the only writer of its path, so what a micro-batch leaves staged is of no use."""

    def commit(self, messages, batchId: int) -> None:
        self._publish(messages, f"batch={batchId}")
        self._clear()

    def abort(self, messages, batchId: int) -> None:
        self._clear()


class BulkIndex(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bulk_index"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _BatchWriter(self.options)

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return _StreamWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BulkIndex)


def read_bulks(spark: SparkSession, path: str) -> DataFrame:
    """index_name, _id, source and `bulk` (its file) of what was delivered."""
    files = spark.read.text(f"{path}/*=*/bulk-*", wholetext=True).select(F.input_file_name().alias("bulk"), "value")
    lines = files.select("bulk", F.posexplode(F.split("value", "\n")).alias("at", "line"))
    # Each document follows its action in the same file.
    pairs = lines.where("line <> ''").groupBy("bulk", F.expr("at div 2").alias("nth")).agg(
        F.max(F.when(F.col("at") % 2 == 0, F.col("line"))).alias("action"), F.max(F.when(F.col("at") % 2 == 1, F.col("line"))).alias("source")
    )
    action = F.from_json("action", "index struct<_index: string, _id: string>").alias("a")
    return pairs.select("bulk", action, "source").select(F.col("a.index._index").alias("index_name"), F.col("a.index._id").alias("_id"), "source", "bulk")
