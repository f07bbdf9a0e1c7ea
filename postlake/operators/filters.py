"""Row filters of the post and profile tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.functions.dates import year_start
from postlake.functions.hrefs import href
from postlake.functions.text import not_empty

# Age limits in days at extraction, and the first year indexed.
POST_DAYS = 90
DETAILED_DAYS = 7
MIN_YEAR = 2014


def nonempty_body(df: DataFrame, body: str = "body") -> DataFrame:
    return df.where(not_empty(body))


def from_year(df: DataFrame, year: int = MIN_YEAR, local_day: str = "post_local_date") -> DataFrame:
    """Posts whose local date falls in `year` or later."""
    return df.where(F.col(local_day) >= year_start(year))


def without_prefix(df: DataFrame, prefix: str = "fb", column: str = "url") -> DataFrame:
    return df.where(~F.col(column).startswith(prefix))


def repair_href(posts: DataFrame, strict: bool = False) -> DataFrame:
    """Posts with their link rebuilt from the id."""
    return posts.withColumn("href", href("id", strict))


def unrepairable(posts: DataFrame) -> DataFrame:
    """Posts whose id gives no link."""
    return posts.where(href("id").isNull())
