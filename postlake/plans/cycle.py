"""The full cycle: ingest, build views, join, export, index, rotate."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from postlake import files
from postlake.operators.filters import MIN_YEAR
from postlake.plans.export import export_for_index
from postlake.plans.maintain import rotate_queues
from postlake.plans.views import build_post_join, build_post_view, build_profile_view
from postlake.sinks.index import PREFIX
from postlake.sources.topics import Topics
from postlake.streaming.index import publish_index
from postlake.streaming.ingest import ingest_slice
from postlake.tables import Lake


@dataclass
class CycleConfig:
    topics: Topics
    names: Mapping[str, Sequence[str]]
    checkpoint: str
    exports: str
    prefix: str = PREFIX
    min_year: int = MIN_YEAR
    deliver: Callable[[DataFrame], None] | None = None
    max_age_ms: int | None = None
    strict: bool = False


def run_cycle(lake: Lake, config: CycleConfig) -> None:
    """One cycle. Tables are emptied only after every step has succeeded; after a
    failure the next cycle takes up all that is left."""
    ingest_slice(lake, config.topics, config.names, config.checkpoint, config.strict)
    build_profile_view(lake)
    build_post_view(lake)
    build_post_join(lake)

    # Every export is a folder of its own with a checkpoint of its own, so a
    # retry never reads from files that are gone.
    export = f"{config.exports}/{uuid.uuid4().hex}"
    export_for_index(lake, f"{export}/rows", config.strict)
    publish_index(
        lake.spark, f"{export}/rows", config.deliver or lake.index.put,
        f"{export}/checkpoint", config.prefix, config.min_year,
    )

    rotate_queues(lake, config.max_age_ms)
    files.delete(lake.spark, export)
