"""Landing folder -> validated observations, incrementally.

The downloader lands one CSV per station-day and skips what is already
there.  A file-source stream gives the same guarantee on Spark: the source
log in the query checkpoint records which files were processed, so a restart
(or a lost executor) resumes with only new files, and each micro-batch is
validated exactly like the batch reader (``sources.csv_files.validate``).

* ``landed_stream``   - typed observation rows (plus rejects) from new files.
* ``start_ingest`` - appends each micro-batch to a Station-partitioned
  Parquet table; rejects go to a side table.  Writes are keyed by batch id
  (dynamic partition overwrite), so a replayed batch overwrites rather than
  duplicates.
* ``start_daily_summary`` - per micro-batch the parts of daily statistics, which
  ``daily_summary_so_far`` adds up whatever the order files landed in.  Parts of
  older batches are merged, so that reading does not get dearer with every batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import masks
from ..functions.stats import exact_parts, mean_of, merged, total_of
from ..operators import coverage
from ..sources import csv_files as C


# files of a micro-batch, unless the caller asks for other batches
FILES_PER_BATCH = 10_000
# batches whose parts of daily statistics are merged at once
BATCHES_PER_MERGE = 50
# folder of merged parts below the table's; Spark's readers leave out names with a leading underscore
MERGED = "_merged"


def landed_text_stream(spark: SparkSession, path: str, na_token: str = "NA",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """New landed CSV files under ``path`` as text columns plus ``SourceFile``, bound by each file's header.

    A file is taken whole by one task (a station-day is a few kilobytes), so its size is bounded by a text's, 2 GB.
    """
    reader = spark.readStream.options(recursiveFileLookup=True, pathGlobFilter="*.csv")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return C.bind(C.file_lines(reader.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("SourceFile"), "value")), na_token)


def landed_stream(spark: SparkSession, path: str, na_token: str = "NA", max_files_per_trigger: int | None = None,
                  on_bad: str = "reject") -> tuple[DataFrame, DataFrame]:
    """(observations, rejects) streaming DataFrames over ``path``."""
    good, rejects = C.validate(landed_text_stream(spark, path, na_token, max_files_per_trigger), on_bad)
    return C.observations(good), rejects


def batch_writer(table_path: str, partition_by: tuple[str, ...] = ("Station",),
                 sort_by: tuple[str, ...] = ()):
    """``foreachBatch`` function: write a micro-batch into its own
    (partition_by..., BatchId) partitions with dynamic partition overwrite.  A
    batch replayed after a failure between its write and its commit rewrites
    the same partitions instead of appending its rows a second time.
    ``sort_by`` orders each task's rows (a local sort) so row-group statistics
    on those columns can skip data in later range filters."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if sort_by:
            batch = batch.sortWithinPartitions(*partition_by, *sort_by)
        (batch.withColumn("BatchId", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_by, "BatchId").parquet(table_path))

    return write


def _trigger(writer, available_now: bool):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")


def start_ingest(spark: SparkSession, landing_path: str, table_path: str, checkpoint_location: str,
                 rejects_path: str | None = None, na_token: str = "NA", max_files_per_trigger: int = FILES_PER_BATCH,
                 available_now: bool = True, on_bad: str = "reject") -> StreamingQuery:
    """One stream over the landing folder feeding both outputs.

    Typed rows of each micro-batch go to ``table_path`` (Station/BatchId
    partitions) and its rejects to ``rejects_path`` (BatchId partitions).  With
    both, a batch's files are read and parsed once: the checked rows are written
    below ``checkpoint_location``, where the next batch replaces them, and both
    outputs come from there.  A backlog is taken in batches of
    ``max_files_per_trigger`` files; ``on_bad`` is that of ``csv_files.validate``.
    """
    text = landed_text_stream(spark, landing_path, na_token, max_files_per_trigger)
    write_rows = batch_writer(table_path, sort_by=("Time",))
    write_rejects = batch_writer(rejects_path, partition_by=()) if rejects_path else None
    once = f"{checkpoint_location.rstrip('/')}/checked"

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = C.checked(batch, on_bad)
        if write_rejects is not None:
            rows.write.mode("overwrite").parquet(once)
            rows = batch.sparkSession.read.schema(rows.schema).parquet(once)
            write_rejects(C.rejected(rows), batch_id)
        write_rows(C.observations(C.accepted(rows)), batch_id)

    w = text.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint_location)
    return _trigger(w, available_now).start()


def daily_parts(rows: DataFrame) -> DataFrame:
    """Per (Station, Date) what daily statistics can be added up from; ``rows`` as ``csv_files.checked`` gives them.

    A reject counts on the day of its Time, or without one on the day its file is named for.
    """
    kept = F.col(C.KEPT)

    def of_kept(name: str) -> Column:
        return F.when(kept, F.col(name))

    rows = rows.withColumn("Station", C.station_of_file("SourceFile"))
    date = F.when(kept, F.to_date("Time")).otherwise(F.coalesce(F.to_date("Time"), C.date_of_file("SourceFile")))
    return rows.groupBy("Station", date.alias("Date")).agg(
        F.max(of_kept("Temperature")).alias("MaxTemperature"),
        exact_parts(of_kept("Temperature")).alias("SumTemperature"),
        F.count(of_kept("Temperature")).alias("Temperatures"),
        F.min(of_kept("Temperature")).alias("MinTemperature"),
        exact_parts(of_kept("Precipitation")).alias("SumPrecipitation"),
        F.count_if(of_kept("Precipitation") > 0).alias("PrecipitationHours"),
        F.max(of_kept("WindSpeed")).alias("MaxWindSpeed"),
        masks.hours(of_kept("Time")).alias("HourMask"),
        F.count_if(kept).alias("Rows"),
        F.count(C.BAD_COLUMNS).alias("Rejects"),
    )


def merge_parts(parts: DataFrame) -> DataFrame:
    """One row of ``daily_parts`` per (Station, Date) out of any number of them."""
    added = ("SumTemperature", "Temperatures", "SumPrecipitation", "PrecipitationHours", "Rows", "Rejects")
    how = dict.fromkeys(added, F.sum) | {"SumTemperature": merged, "SumPrecipitation": merged, "MinTemperature": F.min, "HourMask": F.bit_or}
    names = [c for c in parts.columns if c not in ("Station", "Date", "BatchId")]
    return parts.groupBy("Station", "Date").agg(*(how.get(c, F.max)(c).alias(c) for c in names))


def _folder(spark: SparkSession, path: str):
    """(file system, path) of a folder in whatever store it is."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _numbers(spark: SparkSession, path: str, prefix: str, committed: bool = False) -> list[int]:
    """The numbers of the folders ``prefix``<number> in ``path``; ``committed`` leaves out those whose write did not end."""
    fs, folder = _folder(spark, path)
    if not fs.exists(folder):
        return []
    named = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith(prefix)]
    if committed:
        named = [p for p in named if fs.exists(_folder(spark, f"{p.toString()}/_SUCCESS")[1])]
    return sorted(int(p.getName()[len(prefix):]) for p in named)


def parts_so_far(spark: SparkSession, table_path: str) -> DataFrame:
    """The table of ``start_daily_summary``: the newest merged parts and those of the batches after them.

    How many rows are read depends on the station-days and on the batches since
    the last merge, not on how many batches there were.
    """
    table_path = table_path.rstrip("/")
    merged = _numbers(spark, f"{table_path}/{MERGED}", "upto-", committed=True)
    if not merged:
        return spark.read.parquet(table_path).drop("BatchId")
    old = spark.read.parquet(f"{table_path}/{MERGED}/upto-{merged[-1]}")
    new = spark.read.schema(f"{old._jdf.schema().toDDL()}, BatchId long").parquet(table_path)
    return old.unionByName(new.filter(F.col("BatchId") > merged[-1]).drop("BatchId"))


def parts_writer(table_path: str, every: int = BATCHES_PER_MERGE):
    """``foreachBatch`` function: write a batch of ``daily_parts`` under its BatchId; each ``every``-th merges what there is.

    A merge is a folder of its own, named by the last batch in it, and counts
    once its write is committed, so a failure on the way loses and doubles
    nothing; a batch replayed after its merge has nothing left to do.  What a
    merge replaces stays until the next one, for readers that have begun.
    """
    table_path = table_path.rstrip("/")
    if every < 1:
        raise ValueError(f"every has to be 1 or more, not {every}")
    write = batch_writer(table_path, partition_by=())

    def run(parts: DataFrame, batch_id: int) -> None:
        spark = parts.sparkSession
        merged = _numbers(spark, f"{table_path}/{MERGED}", "upto-", committed=True)
        if merged and batch_id <= merged[-1]:
            return
        write(parts, batch_id)
        if (batch_id + 1) % every or not _numbers(spark, table_path, "BatchId="):
            return
        merge_parts(parts_so_far(spark, table_path)).write.mode("overwrite").parquet(f"{table_path}/{MERGED}/upto-{batch_id}")
        if merged:
            gone = [f"{table_path}/BatchId={n}" for n in _numbers(spark, table_path, "BatchId=") if n <= merged[-1]]
            for path in [*gone, *(f"{table_path}/{MERGED}/upto-{n}" for n in merged[:-1])]:
                fs, folder = _folder(spark, path)
                fs.delete(folder, True)

    return run


def start_daily_summary(spark: SparkSession, landing_path: str, table_path: str, checkpoint_location: str,
                        na_token: str = "NA", max_files_per_trigger: int = FILES_PER_BATCH,
                        available_now: bool = True, on_bad: str = "reject", merge_every: int = BATCHES_PER_MERGE) -> StreamingQuery:
    """D1 kept up to date: each micro-batch adds its ``daily_parts`` to
    ``table_path`` under its BatchId, and each ``merge_every``-th merges them;
    ``parts_so_far`` reads the table.

    No watermark: a row that lands late, in whatever batch, counts in
    ``daily_summary_so_far``, and a replayed batch replaces its parts.  The rows
    that did not pass validation are counted in the same pass
    (``rejects_so_far``).
    """
    text = landed_text_stream(spark, landing_path, na_token, max_files_per_trigger)
    write = parts_writer(table_path, merge_every)
    w = text.writeStream.foreachBatch(lambda batch, batch_id: write(daily_parts(C.checked(batch, on_bad)), batch_id))
    return _trigger(w.option("checkpointLocation", checkpoint_location), available_now).start()


def rejects_so_far(parts: DataFrame) -> DataFrame:
    """(Station, Date, Rejects) of the station-days that lost rows, from ``parts_so_far``."""
    return parts.groupBy("Station", "Date").agg(F.sum("Rejects").alias("Rejects")).filter("Rejects > 0")


def daily_summary_so_far(parts: DataFrame) -> DataFrame:
    """D1 from ``parts_so_far``: all days landed so far, open ones too."""
    return parts.filter("Rows > 0").groupBy("Station", "Date").agg(
        F.max("MaxTemperature").alias("MaxTemperature"),
        mean_of(merged("SumTemperature"), F.sum("Temperatures")).alias("AvgTemperature"),
        F.min("MinTemperature").alias("MinTemperature"),
        total_of(merged("SumPrecipitation")).alias("TotalPrecipitation"),
        F.sum("PrecipitationHours").alias("PrecipitationHours"),
        F.max("MaxWindSpeed").alias("MaxWindSpeed"),
    )


def monthly_precipitation_so_far(parts: DataFrame) -> DataFrame:
    """A3 + A4 from ``parts_so_far``: monthly totals and rainy days."""
    month = F.year("Date").alias("Year"), F.month("Date").alias("Month")
    return parts.filter("Rows > 0").groupBy("Station", *month).agg(
        total_of(merged("SumPrecipitation")).alias("TotalPrecipitation"),
        masks.size(masks.days_of_month(F.when(F.col("PrecipitationHours") > 0, F.col("Date")))).cast("long").alias("RainyDays"))


def hour_coverage_so_far(parts: DataFrame) -> DataFrame:
    """S7 by the hour from ``parts_so_far``: which hours of each day have landed."""
    landed = parts.filter(F.col("HourMask").isNotNull() & F.col("Date").isNotNull())
    return coverage.hour_coverage(landed.groupBy("Station", "Date").agg(F.bit_or("HourMask").alias("HourMask")))
