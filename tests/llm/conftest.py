from __future__ import annotations

import pytest
from pyspark.sql import DataFrame, SparkSession

from odd_rows import CLASHING, ITEMS, LABELS, ODD, PAGES


def clashing(rows: DataFrame) -> DataFrame:
    free = [c for c in CLASHING if c not in rows.columns]
    return rows.selectExpr("*", *[f"CAST(NULL AS STRING) AS `{c}`" for c in free])


@pytest.fixture(scope="session")
def tables(spark: SparkSession, tmp_path_factory):
    """Folders of tables: odd rows with clashing columns, and the same without any row."""
    made = {
        "documents": spark.createDataFrame([(*r, len(r[1] or "")) for r in ODD], "doc_id long, text string, lang string, source string, n_chars long"),
        "benchmark": spark.createDataFrame(ITEMS, "item_id long, text string"),
        "labels": spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int"),
        "pages": spark.createDataFrame(PAGES, "page_id long, url string, html string"),
    }
    folders = {}
    for kind in ("odd", "empty"):
        folders[kind] = str(tmp_path_factory.mktemp(kind))
        for name, rows in made.items():
            rows = clashing(rows) if name in ("documents", "pages") else rows
            (rows if kind == "odd" else rows.limit(0)).write.parquet(f"{folders[kind]}/{name}.parquet")
    return folders
