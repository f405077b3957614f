"""Landed daily CSV files -> observations (S1-S4, F7, S10 path parsing).

The files are read in one scan (never one reader per file chained by unions)
with every column as text, bound by the names in each file's own header: a
file's first line and its other lines stay in one task, so no line is moved to
meet its header.  A row is rejected when any non-empty cell fails ``try_cast`` to
its target type; accepted rows are cast.  This gives the same rows whatever
columns a later query selects, unlike a DROPMALFORMED reader whose result
depends on column pruning, and keeps the rejects as a table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CSV_COLUMNS, TARGET_TYPES
from ..functions.calendar import parse_time

# a line whose number of cells is not that of the header's is kept here and rejected
CORRUPT = "_corrupt_record"
# true for the lines of a file whose header names no Time
NO_TIME_COLUMN = "_no_time_column"

# A file up to this size is read whole by one task; larger ones are split.  The
# names of larger files, one per so many bytes of input, reach the driver.
WHOLE_FILE_BYTES = 16 << 20

# Cell texts that mean "no value", those that pandas reads so by default.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Fixed value: the landing directory pattern weather_data_hourly_{station}_{lat}_{lon}.
STATION_DIR = r"weather_data_hourly_(.+)_(-?[0-9.]+)_(-?[0-9.]+)/[^/]*$"


class NoInputFiles(FileNotFoundError):
    """The input path is missing or holds no CSV file."""


def check_input(spark: SparkSession, paths: list[str]) -> None:
    """Raise ``NoInputFiles`` when a path is missing or no ``.csv`` file
    lies under the paths.  One listing with the ``binaryFile`` source (file
    paths only, no content read) and a one-row ``isEmpty`` job."""
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.csv")
            .load(paths)
            .select("path")
        )
    except AnalysisException as e:
        raise NoInputFiles(f"input path not found: {paths}") from e
    if files.isEmpty():
        raise NoInputFiles(f"no .csv file under {paths}")


def cells(line: Column) -> Column:
    """The cells of a CSV line, quotes taken off."""
    def unquoted(cell: Column) -> Column:
        cell = F.trim(cell)
        inner = F.replace(F.substring(cell, F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"'))
        quoted = (F.length(cell) >= 2) & cell.startswith('"') & cell.endswith('"')
        return F.when(quoted, F.replace(inner, F.lit(_COMMA), F.lit(","))).otherwise(F.replace(cell, F.lit(_COMMA), F.lit(",")))

    # every second piece between quotes is inside them: its commas are hidden while the line is cut
    pieces = F.transform(F.split(line, '"', -1), lambda x, i: F.when(i % 2 == 1, F.replace(x, F.lit(","), F.lit(_COMMA))).otherwise(x))
    plain = F.transform(F.split(line, ",", -1), lambda x: F.trim(x))
    return F.when(line.contains('"'), F.transform(F.split(F.array_join(pieces, '"'), ",", -1), unquoted)).otherwise(plain)


# stands for a comma inside quotes while a line is cut
_COMMA = "\u0001"
_LINE_BREAK = "\r\n|\r|\n"


def file_lines(files: DataFrame) -> DataFrame:
    """(SourceFile, Names, Cells, Line) of every line below the header of whole files (SourceFile, value).

    Names are the header's cells.  Blank lines are left out, and blank ones and a
    byte order mark before the header; a file without lines gives one row
    without a Line.  A cell cannot hold a line break.
    """
    text = files.select("SourceFile", F.regexp_replace("value", r"^[\s\x{FEFF}]+", "").alias("_text"))
    lines = F.split("_text", _LINE_BREAK, -1)
    # once a file and below the generator: an expression on the text beside it would be worked out, and the text carried, for every line
    whole = text.select("SourceFile", cells(F.regexp_extract("_text", r"^[^\r\n]*", 0)).alias("Names"),
                        lines.alias("_lines"), (F.size(lines) == 1).alias("_bare"))
    # a generator over a higher-order function hands on line by line; generated code would first collect a file's rows
    below = F.filter(F.slice("_lines", 2, F.size("_lines") - 1), lambda x: F.trim(x) != "")
    split = whole.select("SourceFile", "Names", "_bare", F.explode_outer(below).alias("Line"))
    return _with_cells(split.filter(F.col("Line").isNotNull() | F.col("_bare")))


def _once(df: DataFrame, kept: list[str], columns: list[Column]) -> DataFrame:
    """``kept`` of ``df`` and ``columns``, worked out once a row.

    They come out of a generator: what follows runs on their values, where Catalyst
    would push a filter below a projection and put the expressions in place of
    their names, once for every use.
    """
    return df.select(*kept, F.inline(F.array(F.struct(*columns))))


def _with_cells(lines: DataFrame) -> DataFrame:
    return _once(lines, ["SourceFile", "Names"], [cells(F.col("Line")).alias("Cells"), F.col("Line")])


def _reader(source, recursive: bool):
    return source.options(recursiveFileLookup=True, pathGlobFilter="*.csv") if recursive else source


def _large_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``file_lines`` of large files: one pass finds their headers, then one scan for each distinct header."""
    by_header: dict[str, list[str]] = {}
    first = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("SourceFile"), F.col("_metadata.file_block_start").alias("Start"),
        F.monotonically_increasing_id().alias("Pos"), "value")
    headers = first.filter((F.col("Start") == 0) & (F.trim("value") != "")).groupBy("SourceFile").agg(F.min_by("value", "Pos").alias("Header"))
    for r in headers.select(F.url_decode("SourceFile").alias("path"), "Header").collect():
        by_header.setdefault(r.Header, []).append(r.path)
    scans = []
    for header, files in sorted(by_header.items()):
        names = cells(F.regexp_replace(F.lit(header), r"^[\s\x{FEFF}]+", ""))
        lines = spark.read.text(files).filter(
            (F.trim("value") != "") & ~((F.col("_metadata.file_block_start") == 0) & (F.col("value") == F.lit(header))))
        scans.append(_with_cells(lines.select(F.col("_metadata.file_path").alias("SourceFile"), names.alias("Names"), F.col("value").alias("Line"))))
    return reduce(DataFrame.unionByName, scans)


def read_lines(spark: SparkSession, path: str | list[str], recursive: bool = True) -> DataFrame:
    """``file_lines`` of all CSVs under ``path`` (a directory, glob or list).

    One listing tells whether there are files at all (``NoInputFiles`` if not) and
    which are larger than WHOLE_FILE_BYTES, and is that of the scan, too; larger
    files are read by ``_large_files``.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if not paths:
        raise NoInputFiles("no input paths given")
    try:
        files = _reader(spark.read.format("binaryFile"), recursive).load(paths)
        large = F.collect_list(F.when(F.col("length") > WHOLE_FILE_BYTES, F.col("path")))
        n, large = files.agg(F.count(F.lit(1)), large).first()
    except AnalysisException as e:
        raise NoInputFiles(f"input path not found: {paths}") from e
    if not n:
        raise NoInputFiles(f"no .csv file under {paths}")
    small = files.filter(F.col("length") <= WHOLE_FILE_BYTES) if large else files
    lines = file_lines(small.select(F.col("_metadata.file_path").alias("SourceFile"), F.col("content").cast("string").alias("value")))
    return lines.unionByName(_large_files(spark, large)) if large else lines


def _bound(lines: DataFrame, names: tuple[str, ...], na_token: str, *more: Column) -> DataFrame:
    """The cells under ``names`` of the lines that ``file_lines`` found, beside SourceFile, CORRUPT and ``more``; NULL if one is empty or the file lacks the column."""
    found = [F.get("Cells", F.array_position("Names", name).cast("int") - 1).alias(name) for name in names]
    rows = _once(lines.filter(F.col("Line").isNotNull()), ["SourceFile"], [*found, _corrupt(), *more])
    texts = {name: F.when((F.col(f"`{name}`") != na_token) & (F.col(f"`{name}`") != ""), F.col(f"`{name}`")) for name in names}
    return rows.withColumns(texts)


def _corrupt() -> Column:
    return F.when(F.size("Cells") != F.size("Names"), F.col("Line")).alias(CORRUPT)


def bind(lines: DataFrame, na_token: str = "NA") -> DataFrame:
    """``file_lines`` as the text columns of observations plus ``SourceFile``."""
    no_time = (~F.array_contains("Names", "Time")).alias(NO_TIME_COLUMN)
    return _bound(lines, CSV_COLUMNS, na_token, no_time).select(*CSV_COLUMNS, CORRUPT, NO_TIME_COLUMN, "SourceFile")


def read_text(spark: SparkSession, path: str | list[str], na_token: str = "NA", recursive: bool = True) -> DataFrame:
    """All CSVs under ``path`` (a directory, glob or list) as text
    columns plus ``SourceFile``.  Raises ``NoInputFiles`` when nothing matches.

    Columns are bound by each file's header, in whatever order it names them:
    one that a file lacks is NULL, one that is no observation's is left out."""
    return bind(read_lines(spark, path, recursive), na_token)


def _text(name: str) -> Column:
    """A cell's text; NULL where it stands for a missing value."""
    text = F.trim(F.col(name))
    return F.when(~text.isin(*MISSING_TOKENS), text)


def _parsed(text: Column, name: str) -> Column:
    """A cell's ``_text`` under its type; NULL if it is missing, does not parse, is no finite
    number, or is a code that is no whole number (3.0 is a valid code 3)."""
    if name == "Time":
        return parse_time(text)
    target = TARGET_TYPES[name]
    number = text.try_cast("double")
    number = F.when(F.abs(number) < float("inf"), number)
    if isinstance(target, T.IntegerType):
        return F.when(number == F.floor(number), number.try_cast("int"))
    return number


# what ``_typed`` adds for each column: its text without what means "no value", and its value
_TEXT, _VALUE = "_text_of_", "_value_of_"


def _typed(text: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``text`` with the values of ``columns``, each cell trimmed and parsed once."""
    trimmed = _once(text, ["*"], [_text(c).alias(_TEXT + c) for c in columns]) if columns else text
    return _once(trimmed, ["*"], [_parsed(F.col(_TEXT + c), c).alias(_VALUE + c) for c in columns]) if columns else text


def _bad(name: str) -> Column:
    return F.col(_TEXT + name).isNotNull() & F.col(_VALUE + name).isNull()


def _cast(name: str) -> Column:
    return F.col(_VALUE + name).alias(name)


def _findings(text: DataFrame, columns: tuple[str, ...]) -> tuple[dict[str, Column], Column]:
    """(what can be wrong with a row of ``_typed``, whether its line is whole)."""
    bad = {c: _bad(c) for c in columns}
    whole = F.lit(True)
    if CORRUPT in text.columns:
        bad["cell count"] = F.col(CORRUPT).isNotNull()
        whole = F.col(CORRUPT).isNull()
    if NO_TIME_COLUMN in text.columns:
        bad["header"] = F.col(NO_TIME_COLUMN)
        whole &= ~F.col(NO_TIME_COLUMN)
    return bad, whole


def _check_on_bad(on_bad: str) -> None:
    if on_bad not in ("reject", "null"):
        raise ValueError(f"on_bad is 'reject' or 'null', not {on_bad!r}")


def validate(text: DataFrame, on_bad: str = "reject", columns: tuple[str, ...] = CSV_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejected text rows with ``BadColumns``).

    Accepted rows pass a plain boolean test (no cell is bad), which stays in
    whole-stage generated code; the list of bad column names is built for
    rejected rows only.  A line with too few or too many cells is rejected, too
    (``cell count``), and every line of a file whose header names no Time
    (``header``).  With ``on_bad="null"`` a row with bad cells is kept, those
    cells NULL, and listed among the rejects as well.

    Each of the two is a plan of its own; ``checked`` gives both in one.
    """
    _check_on_bad(on_bad)
    bad, whole = _findings(text, columns)
    any_bad = reduce(lambda a, b: a | b, bad.values(), F.lit(False))
    extra = [c for c in text.columns if c not in (*columns, CORRUPT, NO_TIME_COLUMN)]
    typed = _typed(text, columns)
    good = typed.filter(whole if on_bad == "null" else ~any_bad).select(*(F.col(f"`{c}`") for c in extra), *[_cast(c) for c in columns])
    names = [F.col(f"`{c}`") for c in text.columns if c != NO_TIME_COLUMN]
    rejects = typed.filter(any_bad).select(*names, _names(bad).alias("BadColumns"))
    return good, rejects


def _names(bad: dict[str, Column]) -> Column:
    return F.filter(F.array(*[F.when(b, F.lit(c)) for c, b in bad.items()]), lambda x: x.isNotNull())


# what ``checked`` adds to typed rows
BAD_COLUMNS, REJECTED, KEPT = "BadColumns", "Rejected", "Kept"


def checked(text: DataFrame, on_bad: str = "reject", columns: tuple[str, ...] = CSV_COLUMNS) -> DataFrame:
    """F7 in one pass: every row typed, with ``BadColumns`` and its text as ``Rejected`` where
    something is wrong with it, and whether it is ``Kept``; bad cells are NULL.

    Written once, it gives rows (``accepted``) and rejects (``rejected``) without
    reading or parsing the files a second time.
    """
    _check_on_bad(on_bad)
    bad, whole = _findings(text, columns)
    any_bad = reduce(lambda a, b: a | b, bad.values(), F.lit(False))
    extra = [c for c in text.columns if c not in (*columns, CORRUPT, NO_TIME_COLUMN)]
    shown = F.struct(*[F.col(c) for c in (*columns, CORRUPT) if c in text.columns])
    return _typed(text, columns).select(*extra, *[_cast(c) for c in columns], F.when(any_bad, _names(bad)).alias(BAD_COLUMNS),
                       F.when(any_bad, shown).alias(REJECTED), (whole if on_bad == "null" else ~any_bad).alias(KEPT))


def accepted(rows: DataFrame) -> DataFrame:
    """The typed rows of ``checked`` that are kept."""
    return rows.filter(KEPT).drop(BAD_COLUMNS, REJECTED, KEPT)


def rejected(rows: DataFrame) -> DataFrame:
    """The rejects of ``checked``: SourceFile, the row's text and BadColumns."""
    return rows.filter(F.col(BAD_COLUMNS).isNotNull()).select("SourceFile", f"{REJECTED}.*", BAD_COLUMNS)


def station_from_path(path: Column | str = "SourceFile") -> Column:
    """The station name encoded in the landing directory (file paths
    arrive URI-encoded, so ``Gran%20Canaria`` reads back as ``Gran Canaria``)."""
    path = F.col(path) if isinstance(path, str) else path
    return F.url_decode(F.regexp_extract(path, STATION_DIR, 1))


def station_from_partition(path: Column | str = "SourceFile") -> Column:
    """Station from a ``Station=`` directory written by ``sinks.write_daily_csv``:
    one decode for the URI, one for Spark's partition-value escaping."""
    path = F.col(path) if isinstance(path, str) else path
    return F.url_decode(F.url_decode(F.regexp_extract(path, r"/Station=([^/]+)/", 1)))


def station_of_file(path: Column | str = "SourceFile") -> Column:
    """Station from a ``Station=`` partition directory, else from the
    landing directory name; NULL when the path names neither."""
    from_dir = station_from_path(path)
    part = station_from_partition(path)
    return F.when(part != "", part).when(from_dir != "", from_dir)


# Fixed value: the day of a landed file, from a ``Date=`` partition directory
# or from the daily file name weather_{yyyy-MM-dd}.csv.
FILE_DATE = r"(?:/Date=|/weather_)([0-9]{4}-[0-9]{2}-[0-9]{2})(?:/[^/]*|\.csv)$"


def date_of_file(path: Column | str = "SourceFile") -> Column:
    """The calendar day a landed file holds (NULL if the path names none)."""
    path = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(path, FILE_DATE, 1).try_cast("date")


def observations(rows: DataFrame) -> DataFrame:
    """Validated rows -> observations with Station from the file's folder."""
    return rows.select(station_of_file("SourceFile").alias("Station"), *CSV_COLUMNS)


def load_with_rejects(spark: SparkSession, path: str | list[str], na_token: str = "NA",
                      on_bad: str = "reject") -> tuple[DataFrame, DataFrame]:
    """S1 + S2 + F7 + S10: (typed observations, rejected text rows with
    ``SourceFile`` and ``BadColumns``); Station comes from a ``Station=``
    partition directory or else from the landing directory name.  ``on_bad`` is
    that of ``validate``.  Each of the two scans the files when it is used;
    ``load_once`` scans them once for both."""
    good, rejects = validate(read_text(spark, path, na_token), on_bad)
    return observations(good), rejects


def load_once(spark: SparkSession, path: str | list[str], na_token: str = "NA",
              on_bad: str = "reject") -> tuple[DataFrame, DataFrame]:
    """``load_with_rejects`` in one scan: the checked rows are written to the shared
    checkpoint folder, and observations and rejects read from there."""
    from .sinks import persist_table

    rows = persist_table(checked(read_text(spark, path, na_token), on_bad), "checked")
    return observations(accepted(rows)), rejected(rows)


def load_observations(spark: SparkSession, path: str | list[str], na_token: str = "NA", on_bad: str = "reject") -> DataFrame:
    """S1 + F7 + S10: typed observations (rejected rows left out, or with ``on_bad="null"`` their bad cells NULL)."""
    return load_with_rejects(spark, path, na_token, on_bad)[0]


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """(SourceFile, Station, Date) of every CSV under ``path``.

    Listed with the ``binaryFile`` source selecting only the path, so the
    listing is distributed and no file content is read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .load(path)
        .select(F.col("path").alias("SourceFile"))
    )
    return files.select("SourceFile", station_of_file("SourceFile").alias("Station"),
                        date_of_file("SourceFile").alias("Date"))


def read_by_layout_with_rejects(spark: SparkSession, path: str | list[str], na_token: str = "NA",
                                on_bad: str = "null") -> tuple[DataFrame, DataFrame]:
    """S3 + U2 at scale: (rows, rejects) of CSV files whose columns differ, bound
    by the names in each file's header and stacked.

    The files are read once, however many layouts there are: lines are cut next
    to their header, in the same task, and written to the shared checkpoint
    folder with its names.  What names there are is then known from that table
    (they reach the driver), and cells are picked by name: a column that a file
    lacks is NULL, known columns have their observation types, others stay text.
    ``on_bad`` is that of ``validate``; a line whose cells are not as many as its
    header's is always rejected.  A cell cannot hold a line break.
    """
    from .sinks import persist_table

    lines = persist_table(read_lines(spark, path), "layouts")
    found = {r.name for r in lines.select("Names").distinct().select(F.explode("Names").alias("name")).distinct().collect()}
    known = [c for c in CSV_COLUMNS if c in found]
    others = sorted(found - set(known))
    text = _bound(lines, (*known, *others), na_token)
    return validate(text, on_bad, tuple(known))


def read_by_layout(spark: SparkSession, path: str | list[str], na_token: str = "NA") -> DataFrame:
    """The rows of ``read_by_layout_with_rejects``, bad cells NULL."""
    return read_by_layout_with_rejects(spark, path, na_token)[0]


# Landing directory and daily file name formats.
LANDING_DIR_FORMAT = "weather_data_hourly_{station}_{latitude}_{longitude}"
DAILY_FILE_FORMAT = "weather_{date}.csv"


def landing_dir(station: str, latitude: float, longitude: float) -> str:
    """The directory a station's daily files are landed in."""
    return LANDING_DIR_FORMAT.format(station=station, latitude=latitude, longitude=longitude)


def daily_file_name(date) -> str:
    """File name of one landed day (``date`` as date or ``yyyy-MM-dd`` text)."""
    return DAILY_FILE_FORMAT.format(date=date.isoformat() if hasattr(date, "isoformat") else date)


def landing_path_column(station: Column | str = "Station", latitude: Column | str = "Latitude",
                        longitude: Column | str = "Longitude", date: Column | str = "Date") -> Column:
    """X4 as a Column: ``<landing dir>/weather_<yyyy-MM-dd>.csv`` for each row."""
    c = [F.col(x) if isinstance(x, str) else x for x in (station, latitude, longitude, date)]
    return F.concat(
        F.lit("weather_data_hourly_"), c[0], F.lit("_"), c[1].cast("string"), F.lit("_"), c[2].cast("string"),
        F.lit("/weather_"), F.date_format(c[3], "yyyy-MM-dd"), F.lit(".csv"),
    )
