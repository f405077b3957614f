"""Writers (S6, S8) and export renames."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..schema import CSV_COLUMNS
from ..session import checkpoint_dir

# The saved report's Spanish headers for the wide monthly table.
SPANISH_HEADERS = {
    "Year": "Año",
    "Month": "Mes",
    "AvgTemperature": "Temp Prom",
    "MinTemperature": "Temp Min",
    "MaxTemperature": "Temp Max",
    "AvgHumidity": "Humedad Prom",
    "MinHumidity": "Humedad Min",
    "MaxHumidity": "Humedad Max",
    "TotalPrecipitation": "Precip Total",
    "AvgPressure": "Presión Prom",
    "MinPressure": "Presión Min",
    "MaxPressure": "Presión Max",
}


def with_spanish_headers(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in SPANISH_HEADERS.items() if k in df.columns})


# seconds are written only where a time has some, fractions likewise
NO_SECONDS = r"(:00)?\.000000$"


def time_text(time: Column | str = "Time") -> Column:
    """A time as landed files hold it: ``2024-01-01T13:00``, with the seconds and
    microseconds of a time that has them."""
    return F.regexp_replace(F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), NO_SECONDS, "")


def write_daily_csv(obs: DataFrame, path: str, mode: str = "overwrite", tasks: int | None = None) -> None:
    """Headered CSVs under ``Station=../Date=..``, a station-day in one file.

    Rows are rebalanced by (Station, Date): AQE sizes the tasks by the data and
    divides only a partition that is skewed, so a day of a third of all rows is
    written by several tasks, as several files.  ``tasks`` asks for that many
    tasks instead, where the cost is files and not bytes.  ``overwrite``
    replaces the station-days that ``obs`` holds and leaves all others.  Rows
    without a Time land in the day ``__HIVE_DEFAULT_PARTITION__``.
    """
    out = obs.withColumn("Date", F.date_format(F.to_date("Time"), "yyyy-MM-dd")).withColumn("Time", time_text())
    out = out.repartition(tasks, "Station", "Date") if tasks else out.hint("rebalance", "Station", "Date")
    (
        out.sortWithinPartitions("Station", "Date", "Time")
        .select("Station", "Date", *CSV_COLUMNS)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("Station", "Date")
        .option("header", True)
        .csv(path)
    )


def write_report_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A result table as one headered CSV file (no index column).

    One task writes the file, row by row; ``coalesce(1)`` narrows only the
    stage after the last shuffle (for an aggregate: its final sort).
    """
    df.coalesce(1).write.mode(mode).option("header", True).csv(path)


def write_station_reports(df: DataFrame, path: str, mode: str = "overwrite",
                          order: tuple[str, ...] = ("Año", "Mes")) -> None:
    """S8 per station: one headered CSV per ``Station=`` folder, rows in
    ``order`` - the saved report's layout, one file per island."""
    (df.repartition("Station").sortWithinPartitions("Station", *order)
     .write.mode(mode).partitionBy("Station").option("header", True).csv(path))


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ("Station",), mode: str = "overwrite") -> None:
    """Compact landed rows into a partitioned Parquet table."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def persist_table(df: DataFrame, name: str, partition_by: tuple[str, ...] = (),
                  schema: T.StructType | None = None, sort_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once as Parquet in the cluster's shared checkpoint folder and
    return a reader of it: later plans start from columnar files (pruned,
    pushed-down scans) and a lost executor re-reads instead of recomputing.

    No repartition before the write: each task writes its own files, so a hot
    partition value never funnels into one task.  ``sort_by`` orders each
    task's rows (after the partition columns, the order the writer needs
    anyway) with a local sort, so Parquet row-group statistics on those
    columns let later range filters skip row groups.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/skymetrics-{name}-{uuid.uuid4().hex}"
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    schema = schema or df.schema
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def collect_pandas(df: DataFrame):
    """A result on the driver as pandas (by Arrow); ``spark.driver.maxResultSize`` bounds it."""
    return df.toPandas()


def collect_batches(df: DataFrame, rows: int = 10_000) -> Iterator[pa.Table]:
    """S9 without a bound on the whole: a result as Arrow tables of at most ``rows`` rows, one after another.

    The driver holds one partition of the result, and the next, which is fetched
    meanwhile; only these count against ``spark.driver.maxResultSize``.  Order is kept.
    """
    schema = to_arrow_schema(df.schema)
    found = df.toLocalIterator(prefetchPartitions=True)
    while batch := [r.asDict(recursive=True) for r in islice(found, rows)]:
        yield pa.Table.from_pylist(batch, schema)


def collect_into(df: DataFrame, sink: Callable[[pa.Table], object], rows: int = 10_000) -> int:
    """Give a result to ``sink`` (a Parquet writer's ``write_table``, say) in the tables of ``collect_batches``; its row count."""
    n = 0
    for table in collect_batches(df, rows):
        sink(table)
        n += table.num_rows
    return n
