"""Web links of posts and comments, derived from their ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlake.functions.text import _col

# Id patterns per network and form, and the link each one gives.
# The network is told by the first two characters; the rest of the scheme is
# skipped unread.
FB_COMMENT = r"^.{5}([^/]*)/posts/[^/_]*_([^/_]+)(?:_[^/]*)?/comments/(?=[^/])(?:[^/]*_)?([^/_]*)/*$"
FB_COMMENT_HREF = "https://www.facebook.com/$1/posts/$2?comment_id=$3"
FB_POST = r"^(?:.*/)?([^/_]*)_([^/_]+)_*$"
FB_POST_HREF = "https://www.facebook.com/$1/posts/$2"
VK_COMMENT = r"^.{7}([^/]*)/posts/([^/]*)/comments/([^/]+)/*$"
VK_COMMENT_HREF = "http://vk.com/wall$1_$2?reply=$3"
VK_POST = r"^.{7}([^/]*)/posts/([^/]+)/*$"
VK_POST_HREF = "http://vk.com/wall$1_$2"


def _link(id_: Column, pattern: str, replacement: str) -> Column:
    # regexp_replace returns an id that does not fit unchanged, hence the guard.
    return F.when(id_.rlike(pattern), F.regexp_replace(id_, pattern, replacement))


def fb_comment(id_: Column | str) -> Column:
    return _link(_col(id_), FB_COMMENT, FB_COMMENT_HREF)


def fb_post(id_: Column | str) -> Column:
    return _link(_col(id_), FB_POST, FB_POST_HREF)


def vk_comment(id_: Column | str) -> Column:
    return _link(_col(id_), VK_COMMENT, VK_COMMENT_HREF)


def vk_post(id_: Column | str) -> Column:
    return _link(_col(id_), VK_POST, VK_POST_HREF)


def href(id_: Column | str, strict: bool = False) -> Column:
    """Link of a post or comment; null for an id of no known form, or an error
    if strict."""
    id_ = _col(id_)
    is_comment = id_.contains("comments")
    link = (
        F.when(id_.startswith("fb") & is_comment, fb_comment(id_))
        .when(id_.startswith("fb"), fb_post(id_))
        .when(id_.startswith("vk") & is_comment, vk_comment(id_))
        .when(id_.startswith("vk"), vk_post(id_))
    )
    if strict:
        message = F.concat(F.lit("no link for id: "), F.coalesce(id_, F.lit("null")))
        link = F.coalesce(link, F.raise_error(message).cast("string"))
    return link
