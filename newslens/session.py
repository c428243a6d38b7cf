"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Settings that hold on a laptop and on a cluster alike; sizes (memory, cores,
# initial shuffle partitions) belong to whoever submits the job.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # state of streams outside the Java heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # unread pages can be large: keep Arrow batches small enough for Python workers
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def build_session(app: str = "newslens", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="newslens-")


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Only a local session (tests, laptops) may fall back to a temporary folder:
    on a cluster such a folder would be lost with its machine.
    """
    named = spark.sparkContext.getConf().get(CHECKPOINT_KEY) or spark.conf.get(CHECKPOINT_KEY, None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
    return _local_folder()


_JOB: ContextVar[str] = ContextVar("job", default="")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/newslens/{_JOB.get()}{label}-{uuid.uuid4().hex}"


@contextmanager
def job_tables(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables of the job inside are removed when it ends, whether well or not.

    For jobs that write their results: a frame that leaves the block may still
    need the tables.
    """
    folder = f"job-{uuid.uuid4().hex}/"
    token = _JOB.set(folder)
    try:
        yield
    finally:
        _JOB.reset(token)
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark).rstrip('/')}/newslens/{folder}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result survives lost executors and fixes values that a second
    computation could assign differently (sampled range boundaries, row slots).
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give a scan with fewer tasks than cores one task per core.

    Texts cost far more to process than to move, so a table that arrives in a
    single row group is hashed out by its key. A table that already fills the
    cores, as any large one does, is left alone and nothing is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)
