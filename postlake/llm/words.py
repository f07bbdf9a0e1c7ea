"""What the text operators share: words as 64-bit ids, ordering keys, written tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlake.session import run_folder

# ASCII letters in lower case, every other ASCII byte but digits a blank; bytes of other characters stay.
PLAIN = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
# A task forgets the words it knows beyond this many, so its memory does not grow with the vocabulary.
KNOWN_WORDS = 500_000
KNOWN_IDS = 250_000  # likewise for ids, which are cheaper to work out again
SALTS = 64
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class WordIds(dict):
    """bytes -> 64-bit id, worked out once for each word a task meets."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_IDS:
            self.clear()
        made = self[word] = xxhash.xxh64_intdigest(word)
        return made

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def texts(column: pa.Array | pa.ChunkedArray) -> Iterator[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    for value in column.cast(kind):
        yield value.as_py() or b""


def blank_words(text: bytes) -> list[bytes]:
    """A-Z lower-cased, words `[^\\x20\\x09-\\x0D]+`."""
    return text.lower().split()


def plain_words(text: bytes) -> list[bytes]:
    """A-Z lower-cased, words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`."""
    return text.translate(PLAIN).split()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fold(column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit(""))), F.lit(modulus))


def smallest(rows: DataFrame, group: str, order: list[str], n: int) -> DataFrame:
    """The first `n` rows of each group by `order`, whose first column is a hash. They are the first of the first of each salt, so
    no task sees more of a group than `n` rows of each task before it, for one salt in `SALTS`."""
    salted = rows.withColumn("_salt", F.pmod(F.col(order[0]), F.lit(SALTS)))
    for by in ([group, "_salt"], [group]):
        salted = salted.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_rank") <= n)
    return salted.drop("_salt", "_rank")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder, which outlives lost executors."""
    path = run_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
