"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from skymetrics.session import checkpoint_dir

_written: list[tuple[SparkSession, str]] = []


#: whole texts travel to Python workers in Arrow batches of at most so many rows: both sides hold a batch or two per task
TEXT_ROWS = 1000
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def _batches_of(spark: SparkSession, rows: int | None) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows, or of fewer if the session asks for that, while a step is planned and run."""
    asked = spark.conf.get(_BATCH_ROWS)
    if rows is None or 0 < int(asked) <= rows:
        yield
        return
    spark.conf.set(_BATCH_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_ROWS, asked)


def stage(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it again.

    Cuts the lineage at committed files that every executor can read, so a lost
    executor repeats only the tasks of the step that runs.  ``batch_rows`` bounds
    the Arrow batches of the Python functions in ``df``.  The tables are
    deleted when the driver ends, or before by ``drop_staged``.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/staged/{name}-{uuid.uuid4().hex}"
    with _batches_of(spark, batch_rows):
        df.write.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def drop_staged() -> None:
    """Delete every table that ``stage`` wrote in this driver."""
    while _written:
        spark, path = _written.pop()
        try:
            sc = spark.sparkContext
            target = sc._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session has ended: its folder goes with it
            return


atexit.register(drop_staged)


def partitions(spark: SparkSession) -> int:
    """How many tasks an exchange of this session has."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
