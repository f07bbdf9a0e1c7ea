"""Record schemas, JSON key names and crawl metadata names."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES: dict[str, DataType] = {
    "crawl_date": LongType(),
    "fetch_time": LongType(),
    "is_comment": BooleanType(),
    "post_local_date": DateType(),
    "content_meta": MapType(StringType(), StringType()),
    "parse_meta": MapType(StringType(), StringType()),
}


def record(*names: str) -> StructType:
    """A struct of the named columns; text unless the name says otherwise."""
    return StructType([StructField(n, _TYPES.get(n, StringType())) for n in names])


PROFILE = record(
    "url", "crawl_date", "id", "segment", "href", "source",
    "sm_profile_id", "name", "city", "reach", "friend_count", "follower_count", "gender",
)
POST = record(
    "url", "crawl_date", "id", "segment", "href", "source",
    "profile_id", "sm_post_id", "parent_post_id", "body", "date", "engagement", "is_comment",
)
AUTHOR_COLUMNS = (
    "profile_city", "profile_gender", "profile_href", "profile_name", "reach", "sm_profile_id",
)
DETAILED = record(*POST.names, *AUTHOR_COLUMNS)
EXPORT = record(*DETAILED.names, "post_local_date")
INDEX_ROW = record("index_name", "_id", "source")
# When a record came in from a topic, stored beside it in the queues.
INGESTED = StructType([StructField("ingest_ts", TimestampType())])
BAD_MESSAGE = record("topic", "message", "reason")

BY_KIND = {"profile": PROFILE, "post": POST, "detailed": DETAILED}

# Every column an extracted record can have; a row fills the ones of its kind.
EXTRACTED = record(
    *DETAILED.names, "name", "city", "friend_count", "follower_count", "gender",
    "kind", "reason",
)

# Crawl landing tables, one folder per part, partitioned by `segment`.
SEGMENT_PARTS = {
    "fetch": record("url", "status", "fetch_time"),
    "parse": record("url", "status", "fetch_time"),
    "parse_data": record("url", "status", "content_meta", "parse_meta"),
    "parse_text": record("url", "text"),
}

# Statuses and metadata keys of the landing tables.
FETCHED = "fetch_success"
PARSED = "success"
META_TYPE = "type"
META_SKIP = "skip"
META_MULTIPLE = "multiple"
META_SEGMENT = "segment"
TYPE_PROFILE = "profile"
TYPE_POST = "post"
TYPE_DETAILED = "detailed_post"

# Plain JSON keys of each record, in the order they are written.
PLAIN_KEYS = {
    "profile": {
        "smProfileId": "sm_profile_id",
        "name": "name",
        "city": "city",
        "reach": "reach",
        "friendCount": "friend_count",
        "followerCount": "follower_count",
        "gender": "gender",
        "id": "id",
        "segment": "segment",
        "crawlDate": "crawl_date",
        "href": "href",
        "source": "source",
    },
    "post": {
        "profileId": "profile_id",
        "smPostId": "sm_post_id",
        "parentPostId": "parent_post_id",
        "body": "body",
        "date": "date",
        "engagement": "engagement",
        "isComment": "is_comment",
        "id": "id",
        "segment": "segment",
        "crawlDate": "crawl_date",
        "href": "href",
        "source": "source",
    },
    "detailed": {
        "profileCity": "profile_city",
        "profileGender": "profile_gender",
        "profileHref": "profile_href",
        "profileName": "profile_name",
        "reach": "reach",
        "smProfileId": "sm_profile_id",
        "profileId": "profile_id",
        "smPostId": "sm_post_id",
        "parentPostId": "parent_post_id",
        "body": "body",
        "date": "date",
        "engagement": "engagement",
        "isComment": "is_comment",
        "id": "id",
        "segment": "segment",
        "crawlDate": "crawl_date",
        "href": "href",
        "source": "source",
    },
}

# Keys a detailed post is indexed under, in the order they are written.
INDEX_KEYS = {
    "profile_city": "profile_city",
    "profile_gender": "profile_gender",
    "profile_href": "profile_href",
    "profile_name": "profile_name",
    "reach": "reach",
    "sm_profile_id": "sm_profile_id",
    "profile_id": "profile_id",
    "sm_post_id": "sm_post_id",
    "parent_post_id": "parent_post_id",
    "post_body": "body",
    "post_date": "date",
    "engagement": "engagement",
    "is_comment": "is_comment",
    "id": "id",
    "segment": "segment",
    "fetch_time": "crawl_date",
    "post_href": "href",
    "source": "source",
}
