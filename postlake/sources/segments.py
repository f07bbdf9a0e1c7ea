"""Crawl landing tables: `{root}/{part}/segment={name}/`.

Which segments to read is settled from folder names before any data is touched,
and only those folders are listed and scanned.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from postlake import files
from postlake.operators.segments import union_parts
from postlake.schemas import SEGMENT_PARTS
from postlake.session import empty

LOGGER = logging.getLogger(__name__)


def pick(names: Sequence[str], start: str | None = None, stop: str | None = None) -> list[str]:
    """Names from `start` on, up to and including the first one at or past `stop`."""
    past = [n for n in names if stop is not None and n >= stop]
    last = min(past) if past else None
    return sorted(
        n for n in names if (start is None or n >= start) and (last is None or n <= last)
    )


def batches(names: Sequence[str], size: int = 1) -> Iterator[list[str]]:
    """Groups of `size` names, the last one maybe smaller."""
    for at in range(0, len(names), size):
        yield list(names[at : at + size])


@dataclass
class SegmentStore:
    """The segments under `root`, listed once, when first asked for."""

    spark: SparkSession
    root: str
    fmt: str = "parquet"
    _listed: dict[str, dict[str, str]] = field(default_factory=dict, repr=False)

    def folders(self, part: str) -> dict[str, str]:
        if part not in self._listed:
            paths = files.matching(self.spark, f"{self.root}/{part}/segment=*")
            self._listed[part] = {path.rsplit("segment=", 1)[1]: path for path in paths}
        return self._listed[part]

    def segments(self) -> list[str]:
        """All segment names, complete or not."""
        return sorted(set().union(*(self.folders(part) for part in SEGMENT_PARTS)))

    def complete(self) -> list[str]:
        """Names of the segments that have every part."""
        return sorted(set.intersection(*(set(self.folders(part)) for part in SEGMENT_PARTS)))

    def select(
        self, start: str | None = None, stop: str | None = None, segment: str | None = None
    ) -> list[str]:
        """Complete segments of a range, or the one named. The range is taken
        over all names, so an incomplete segment can end it."""
        chosen = [segment] if segment is not None else pick(self.segments(), start, stop)
        complete = set(self.complete())
        for name in chosen:
            if name not in complete:
                LOGGER.info("skip segment %s: a part is missing", name)
        return [name for name in chosen if name in complete]

    def part(self, part: str, segments: Sequence[str]) -> DataFrame:
        schema = StructType([*SEGMENT_PARTS[part].fields, StructField("segment", StringType())])
        folders = self.folders(part)
        paths = [folders[name] for name in segments if name in folders]
        if not paths:
            return empty(self.spark, schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/{part}")
        return reader.format(self.fmt).load(paths)

    def bytes(self, segments: Sequence[str]) -> int:
        """Size of all parts of the segments."""
        paths = [self.folders(part).get(name) for part in SEGMENT_PARTS for name in segments]
        return sum(files.size(self.spark, path) for path in paths if path)

    def records(self, segments: Sequence[str]) -> DataFrame:
        """All parts of the segments as one dataset with a `part` column."""
        return union_parts({part: self.part(part, segments) for part in SEGMENT_PARTS})

    def fetched(self, segments: Sequence[str]) -> DataFrame:
        """Fetch records; the parse part holds records of the same class."""
        return self.part("fetch", segments).unionByName(self.part("parse", segments))
