"""Small text, map and variant expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TRAILING_ZERO = r"\.0$"
# Bytes that no value of Spark's variant type passes, and what stands for the rest of a string that does. It begins
# and ends with a character that Unicode keeps out of interchange.
VARIANT_BYTES = 128 << 20
OVERLONG = "\ufdd0overlong\ufdd0"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def lookup(meta: Column | str, key: str) -> Column:
    """Map value under `key`, null when the map or the key is missing."""
    return F.try_element_at(_col(meta), F.lit(key))


def not_empty(value: Column | str) -> Column:
    """Neither null nor the empty string; blanks count as text."""
    return F.coalesce(_col(value), F.lit("")) != ""


def field(value: Column | str, path: str) -> Column:
    """Text of a variant field; a missing or null field is null. Numbers keep
    every digit and lose only a trailing `.0`."""
    return F.try_variant_get(_col(value), path, "string")


def number(value: Column | str) -> Column:
    """Text of a number without a trailing `.0`, for one that came as a string."""
    return F.regexp_replace(_col(value), TRAILING_ZERO, "")


def flag(value: Column | str, path: str) -> Column:
    """Boolean of a variant field, false when it is missing or null."""
    return F.coalesce(F.try_variant_get(_col(value), path, "boolean"), F.lit(False))


def number_text(json: Column | str, path: str) -> Column:
    """Text of a number inside a JSON string, see `field` and `number`."""
    return number(field(F.try_parse_json(_col(json)), path))


def millis_text(value: Column | str) -> Column:
    return _col(value).cast("string")


def row_key(url: Column | str, crawl_date: Column | str) -> Column:
    """Single-string key `url|crawl_date` of a history table."""
    return F.concat_ws("|", _col(url), millis_text(crawl_date))


def url_hash(url: Column | str) -> Column:
    return F.hash(_col(url))


def words(text: Column | str) -> Column:
    """Lower-case words of a text, split on non-word characters."""
    return F.array_remove(F.split(F.lower(_col(text)), r"\W+"), "")


# Characters of a JSON string, by how they are written: of a byte at least, and of two. Halves of a pair alone are neither.
_HEX = "[0-9a-fA-F]"
# One by one, as Java looks such a class up in a table and tries ranges in turn.
_PLAIN = "[" + "".join(rf"\x{c:02x}" for c in range(0x20, 0x80) if chr(c) not in '"\\') + "]"
_NARROW = rf'{_PLAIN}|\\["\\/bfnrt]|\\u(?![dD][89a-fA-F]){_HEX}{{4}}'
_WIDE = rf"[^\x00-\x7f]|\\u[dD][89abAB]{_HEX}{{2}}\\u[dD][c-fC-F]{_HEX}{{2}}"
_CHAR = f"(?:{_NARROW}|{_WIDE})"
# 64 bytes at least: so many plain ones, or 32 times a wide one or two of which the first is narrow.
_BLOCK = rf"(?:{_PLAIN}{{64}}+|(?:{_WIDE}|(?:{_NARROW}){_CHAR}){{32}}+)"


def _overlong(limit: int) -> str:
    """A pattern of JSON text up to the next string that is a member's value and surely has more than `limit` bytes. Groups: what
    comes before, the string's beginning. All repeats are possessive, so the pattern neither goes back nor recurses."""
    blocks, kept = limit // 64 + 1, limit // 128 // 64
    plain = r"""[^"']++|'(?:[^'\\]|\\.)*+'"""
    short = rf'"(?:[^"\\\x00-\x1f]{{1,32}}+|\\.){{0,{max(limit // 2048, 1)}}}+"'
    below = f'"{_BLOCK}{{0,{blocks - 1}}}+{_CHAR}{{0,63}}+"'
    above = f'"({_BLOCK}{{0,{kept}}}+){_BLOCK}{{{blocks - kept},}}+{_CHAR}*+"'
    return rf"(?s)\G((?:{plain}|{short}|{below})*+)(?<=:\s{{0,8}}){above}"


def without_overlong(text: Column | str, limit: int = VARIANT_BYTES) -> Column:
    """JSON text whose strings of surely more than `limit` bytes end early, with the mark `OVERLONG`. The text is well formed, or not,
    as it was. Strings of which that is not sure, because of escapes or of how they stand, are left."""
    text, pattern = _col(text), F.lit(_overlong(limit))
    # Looked for first, as a replacement copies the text even if there is none.
    found = (F.octet_length(text) > limit) & F.regexp_like(text, pattern)
    return F.when(found, F.regexp_replace(text, pattern, F.lit(f'$1"$2{OVERLONG}"'))).otherwise(text)
