"""Session settings and the shared folder jobs write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Runtime settings the jobs rely on. Every one is a Spark default or a choice
# AQE makes from sizes it has measured, so none has to grow with the data.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A sort-merge join becomes a hash join only when every build partition
    # was measured below this size.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME.items():
        spark.conf.set(name, value)
    return spark


def local_session(app: str = "postlake", cores: str = "*", **config: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        # Recording call sites for error messages takes longer than building a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in config.items():
        builder = builder.config(name, value)
    spark = tune(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared scratch folder, `spark.checkpoint.dir`.

    Only a local master without the setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="postlake-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared one for a single run."""
    return f"{shared_folder(spark)}/postlake/{name}-{uuid.uuid4().hex}"


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows of a schema, known as such to the optimizer."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


# Bytes of a shuffle partition that a task sorts without spilling much, and how
# much larger rows are in a shuffle than in Parquet.
PARTITION_BYTES = 128 << 20
EXPANSION = 3


@contextmanager
def setting(spark: SparkSession, **values: str) -> Iterator[None]:
    """Options of `spark.sql` for the jobs inside, two underscores for a dot; the session is as before afterwards."""
    names = {f"spark.sql.{name.replace('__', '.')}": value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def co_located(spark: SparkSession, buckets: int):
    """Jobs that meet a table of so many buckets: shuffles deal rows as the buckets do, a bucket's one sorted file needs no sort,
    and a write replaces the folders it has rows for. A bucketed side of fewer partitions than shuffles have would be shuffled."""
    return setting(
        spark, shuffle__partitions=str(buckets), adaptive__coalescePartitions__initialPartitionNum=str(buckets),
        sources__bucketing__enabled="true", legacy__bucketedTableScan__outputOrdering="true",
        sources__partitionOverwriteMode="dynamic",
    )


@contextmanager
def fitted_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[int]:
    """Start the shuffles of the jobs inside with as many partitions as their input
    needs, and no fewer than configured. AQE merges those that turn out small; the
    session is as before afterwards."""
    needed = -(-input_bytes * EXPANSION // PARTITION_BYTES)
    count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), needed)
    with setting(spark, adaptive__coalescePartitions__initialPartitionNum=str(count)):
        yield count
