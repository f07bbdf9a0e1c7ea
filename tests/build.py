"""Small records for the tests."""

from __future__ import annotations

from postlake.schemas import DETAILED, POST, PROFILE, SEGMENT_PARTS


def _row(schema, defaults, values):
    row = {name: None for name in schema.names} | defaults | values
    return tuple(row[name] for name in schema.names)


def profiles(spark, *rows):
    made = [_row(PROFILE, {"crawl_date": 1, "id": r["url"], "source": "vk"}, r) for r in rows]
    return spark.createDataFrame(made, PROFILE)


def posts(spark, *rows):
    base = {"crawl_date": 1, "body": "text", "date": "2016-04-11T15:19:22.000+0300", "is_comment": False}
    return spark.createDataFrame([_row(POST, base | {"id": r["url"]}, r) for r in rows], POST)


def detailed(spark, *rows):
    base = {"crawl_date": 1, "body": "text", "date": "2016-04-11T15:19:22.000+0300", "is_comment": False}
    return spark.createDataFrame([_row(DETAILED, base | {"id": r["url"]}, r) for r in rows], DETAILED)


def part(spark, name, *rows):
    """A landing part; `segment` defaults to s1."""
    schema = SEGMENT_PARTS[name]
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields) + ", segment string"
    made = [{n: None for n in schema.names} | {"segment": "s1"} | r for r in rows]
    names = [*schema.names, "segment"]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in made], ddl)


def values(df, *columns):
    """Rows as sorted tuples."""
    columns = columns or df.columns
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
