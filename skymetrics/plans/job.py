"""The processor as one batch job: landing folder -> dashboard tables + report.

The reference processes one island per run: it loads the landed daily CSVs,
computes ten result tables with ten actions and saves the monthly table as
CSV.  ``process_landing`` does it for every station at once: one validated
read of the landing folder, one grouping-sets aggregate written to the shared
checkpoint folder, every table written out by the executors (nothing is
collected), and the monthly summary saved per station under the report's
headers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.calendar import with_calendar
from ..operators.prepare import apply_null_policy
from ..sources import csv_files, sinks
from . import dashboard as D

REPORT = "monthly_report"


def dashboard_aggregate(obs: DataFrame) -> DataFrame:
    """The one-scan aggregate of typed observations, written once."""
    return D.materialize(D.aggregate(with_calendar(obs)))


REJECTS = "rejects"


def process_landing(spark: SparkSession, landing_path: str, out_dir: str,
                    fill_zero: bool = False, na_token: str = "NA", on_bad: str = "reject") -> dict[str, str]:
    """Run the whole dashboard over ``landing_path`` and write it to ``out_dir``.

    Returns the output path of each table: ``<out_dir>/<table>`` as Parquet
    partitioned by Station, ``<out_dir>/monthly_report`` with one headered CSV
    per ``Station=`` folder, and ``<out_dir>/rejects`` with the rows that failed
    validation.  The landing folder is scanned once for all of them.
    ``fill_zero`` applies the reference processors' zero-fill policy to the
    measures first; ``on_bad`` is that of ``csv_files.validate``.
    """
    rows, bad = csv_files.load_once(spark, landing_path, na_token, on_bad)
    obs = apply_null_policy(rows, fill_zero)
    agg = dashboard_aggregate(obs)
    out = out_dir.rstrip("/")
    paths: dict[str, str] = {REJECTS: f"{out}/{REJECTS}"}
    bad.write.mode("overwrite").parquet(paths[REJECTS])
    for name, table in {**D.tables(agg), **D.daily_tables(agg)}.items():
        paths[name] = f"{out}/{name}"
        sinks.write_parquet(table, paths[name], partition_by=("Station",))
    paths[REPORT] = f"{out}/{REPORT}"
    sinks.write_station_reports(sinks.with_spanish_headers(D.monthly_summary(agg)), paths[REPORT])
    return paths


def main(argv: list[str] | None = None) -> None:
    """``spark-submit scripts/process_landing.py <landing> <out> [--fill-zero] [--on-bad null]``:
    the session (master, memory, ``spark.checkpoint.dir``) comes from the submit."""
    import argparse

    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("landing")
    ap.add_argument("out")
    ap.add_argument("--fill-zero", action="store_true", help="zero-fill missing measures (reference policy)")
    ap.add_argument("--na-token", default="NA")
    ap.add_argument("--on-bad", choices=("reject", "null"), default="reject", help="what happens to rows with bad cells")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("skymetrics-process-landing").getOrCreate()
    paths = process_landing(spark, args.landing, args.out, args.fill_zero, args.na_token, args.on_bad)
    for name, path in paths.items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
