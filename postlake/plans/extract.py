"""Crawl segments to extracted records."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from postlake.operators.documents import SURE_BYTES, keep_recent, project, raise_on_quarantine, unnest
from postlake.operators.segments import assemble, count_usable
from postlake.session import fitted_shuffles
from postlake.sinks.extracted import write_extracted
from postlake.sources.segments import SegmentStore, batches


def extracted_records(
    fetch: DataFrame,
    parse_data: DataFrame,
    parse_text: DataFrame,
    as_of: Column | dt.date | str | None = None,
    strict: bool = False,
    large_bytes: int = SURE_BYTES,
) -> DataFrame:
    """Tagged records of all kinds, too old posts dropped. Duplicates are kept;
    the tables they go to are keyed."""
    records = keep_recent(project(unnest(assemble(fetch, parse_data, parse_text), large_bytes)), as_of)
    return raise_on_quarantine(records) if strict else records


def extract_segments(
    store: SegmentStore,
    out: str,
    start: str | None = None,
    stop: str | None = None,
    segment: str | None = None,
    batch_size: int = 1,
    as_of: Column | dt.date | str | None = None,
    strict: bool = False,
) -> list[str]:
    """Extract a range of segments, or one, a batch at a time. Returns their names."""
    chosen = store.select(start, stop, segment)
    for names in batches(chosen, batch_size):
        records = extracted_records(
            store.fetched(names), store.part("parse_data", names), store.part("parse_text", names),
            as_of, strict,
        )
        with fitted_shuffles(store.spark, store.bytes(names)):
            write_extracted(records, out, names)
    return chosen


def segment_counts(store: SegmentStore, segments: Sequence[str] | None = None) -> DataFrame:
    """Number of usable records in each complete segment."""
    return count_usable(store.records(store.complete() if segments is None else segments))
