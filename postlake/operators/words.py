"""Word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.functions.text import words


def word_count(df: DataFrame, text: str = "text") -> DataFrame:
    tokens = df.select(F.explode(words(text)).alias("word"))
    return tokens.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
