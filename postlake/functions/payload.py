"""Records as JSON text and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from postlake.functions.text import _col, millis_text
from postlake.schemas import BY_KIND, INDEX_KEYS, PLAIN_KEYS

CORRUPT = "_corrupt"


def _encode(keys: dict[str, str]) -> Column:
    fields = [
        (millis_text(column) if column == "crawl_date" else F.col(column)).alias(key)
        for key, column in keys.items()
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def plain_json(kind: str) -> Column:
    """JSON of a profile, post or detailed post under its plain keys, nulls included."""
    return _encode(PLAIN_KEYS[kind])


def index_json() -> Column:
    """JSON of a detailed post under its index keys, nulls included."""
    return _encode(INDEX_KEYS)


def _json_keys(kind: str) -> dict[str, list[str]]:
    """Accepted JSON keys per column: the index key first, then the plain one."""
    accepted: dict[str, list[str]] = {}
    for keys in ([INDEX_KEYS] if kind == "detailed" else []) + [PLAIN_KEYS[kind]]:
        for key, column in keys.items():
            if key not in accepted.setdefault(column, []):
                accepted[column].append(key)
    return accepted


def _json_schema(kind: str) -> StructType:
    schema = StructType()
    for column, keys in _json_keys(kind).items():
        dtype = BooleanType() if column == "is_comment" else StringType()
        for key in keys:
            schema.add(StructField(key, dtype))
    return schema


def decode_cells(cells: DataFrame, kind: str, strict: bool = False) -> DataFrame:
    """Typed records from table cells `id, crawl_date, json`.

    Detailed posts may use either set of keys. A cell that is no JSON object
    keeps its text in `_corrupt` with all other record columns null; with
    `strict` it is an error.
    """
    schema = _json_schema(kind)
    if strict:
        parsed = F.from_json("json", schema, {"mode": "FAILFAST"})
    else:
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        schema.add(StructField(CORRUPT, StringType()))
        parsed = F.from_json("json", schema, options)
    accepted = _json_keys(kind)
    columns = [F.col("id").alias("url"), F.col("crawl_date").cast("bigint").alias("crawl_date")]
    for name in BY_KIND[kind].names[2:]:
        value = F.coalesce(*[F.col("_record").getField(key) for key in accepted[name]])
        if name == "is_comment":
            value = F.coalesce(value, F.lit(False))
        columns.append(value.alias(name))
    if not strict:
        columns.append(F.col("_record").getField(CORRUPT).alias(CORRUPT))
    return cells.select("id", "crawl_date", parsed.alias("_record")).select(*columns)


def message_json() -> Column:
    """A whole row as one topic message, nulls left out."""
    return F.to_json(F.struct("*"))


def decode_message(message: Column | str, schema: StructType, strict: bool = False) -> Column:
    """Struct of a topic message, with its text in `_corrupt` if it is no JSON
    object; an error instead if strict."""
    message = _col(message)
    if strict:
        return F.from_json(message, schema, {"mode": "FAILFAST"})
    wanted = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return F.from_json(message, wanted, options)
