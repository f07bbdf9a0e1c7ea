"""Maintenance jobs on the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlake.operators.filters import repair_href, unrepairable, without_prefix
from postlake.tables import Lake, rotate


def clean_profiles(lake: Lake, prefix: str = "fb") -> None:
    """Copy the profiles whose url does not start with a prefix to a table of their own."""
    lake.profile_tmp.upsert(without_prefix(lake.profile.read(), prefix))


def repair_hrefs(lake: Lake, strict: bool = False) -> None:
    """Rebuild the links of posts from their ids. Posts whose link is right already
    are not written again; those whose id gives none keep the link they have and
    are set aside in `unrepaired`."""
    posts = lake.post.read()
    repaired = repair_href(posts.withColumn("_old", F.col("href")), strict)
    if not strict:
        lake.unrepaired.append(unrepairable(posts))
    lake.post.upsert(repaired.where("href IS NOT NULL AND NOT href <=> _old"))


def rotate_queues(lake: Lake, max_age_ms: int | None = None, now_ms: int | None = None) -> None:
    """End a cycle: posts without an author become the next work queue, and the
    tables of this cycle are emptied.

    The new queue is written first. Should the job die later, the next cycle
    meets rows it has seen before, and the keys make that harmless.
    """
    keep = None
    if max_age_ms is not None:
        now = F.lit(now_ms) if now_ms is not None else F.unix_millis(F.current_timestamp())
        keep = F.col("crawl_date") >= now - max_age_ms
    rotate(lake.post_without_profile, lake.post_to_process, keep)
    for table in (lake.profile_to_process, lake.post_to_es, lake.post):
        table.truncate()
