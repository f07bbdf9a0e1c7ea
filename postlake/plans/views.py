"""View building: latest profiles, latest posts, posts joined to authors.

The profile table outgrows what a cycle brings by far. Both jobs that meet it join on its buckets, so its rows stay where they are,
unless the posts of a cycle need more tasks than it has buckets.
"""

from __future__ import annotations

from postlake.operators.enrich import enrich_unevenly
from postlake.session import co_located
from postlake.tables import Lake, append_split


def build_profile_view(lake: Lake) -> None:
    """Add the queued profiles that are new or strictly newer than the saved ones."""
    queued = lake.profile_to_process
    lake.profile.upsert(queued.newest("url"), touching=queued.rows())


def build_post_view(lake: Lake) -> None:
    """Add the newest queued version of each post, in one pass over the queue as written."""
    queued = lake.post_to_process
    lake.post.upsert(queued.newest("url"), touching=queued.rows())


def build_post_join(lake: Lake) -> None:
    """Queue posts with an author for the index, and set the others aside. Posts go to the buckets of the profiles, those of
    authors with very many to several tasks."""
    tasks = max(lake.profile.count(), lake.post.count())
    with co_located(lake.spark, tasks):
        joined = enrich_unevenly(lake.post.read(), lake.profile.read(), tasks)
        append_split(joined, "author_matched", lake.post_to_es.path)
