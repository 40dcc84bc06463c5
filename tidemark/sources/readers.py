"""Scans of reference-shaped inputs (comma-separated, no header, epoch
seconds) and of Apache-style access-log text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.sources.schemas import BY_KIND

# Fixed value: access-log time format (day/month/year:hour:minute:second).
ACCESS_LOG_TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss"


def _csv_reader(reader, kind: str, strict: bool):
    r = reader.schema(BY_KIND[kind]).option("header", "false").option("sep", ",")
    return r.option("mode", "FAILFAST" if strict else "PERMISSIVE")


def _finish(df: DataFrame, kind: str) -> DataFrame:
    if kind == "order":
        # An empty transaction id means "no transaction"; CSV reads it as NULL.
        df = df.withColumn("tx_id", F.coalesce(F.col("tx_id"), F.lit("")))
    return df


def read_records(spark: SparkSession, kind: str, path: str, strict: bool = True, seq: str | None = None) -> DataFrame:
    """Batch scan of a reference-shaped CSV file/folder with a fixed schema.

    ``strict`` fails the job on a malformed line (as the reference's
    ``parseLong`` does); otherwise malformed fields become NULL
    (:func:`split_malformed` keeps such lines apart).  ``seq`` names a column
    to add with each row's place in the files, see :func:`file_order`.
    """
    df = _csv_reader(spark.read, kind, strict).csv(path)
    return _finish(file_order(df, seq) if seq else df, kind)


# ``file_order``: bits for a place within a file (files below 4 TiB, 2 million files).
PLACE_BITS = 42


def file_order(df: DataFrame, out: str = "seq") -> DataFrame:
    """``df``, just read from files, with a number that follows the order of file names and, within
    a file, of rows, however files are split and listed.

    A row's place is where its file block starts plus its number within the task.
    A block that doesn't end its file is the first of its task, and has at least one
    byte a row, so places of one file's blocks don't meet.  File numbers come from the
    sorted listing, joined by path (few rows; the planner broadcasts them if they are small)."""
    def path(c) -> F.Column:
        return F.regexp_replace(c, "^file:/+", "file:/")
    files = df.sparkSession.createDataFrame(list(enumerate(sorted(df.inputFiles()))), "_file_no bigint, _file string")
    numbered = (df.withColumn("_path", path(F.col("_metadata.file_path")))
                .withColumn("_place", F.col("_metadata.file_block_start")
                            + F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    return (numbered.join(files.withColumn("_path", path(F.col("_file"))), "_path")
            .withColumn(out, F.shiftleft("_file_no", PLACE_BITS) + F.col("_place"))
            .drop("_path", "_place", "_file", "_file_no"))


def split_malformed(lines: DataFrame, kind: str, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(records, malformed) of text lines, batch or stream: lines that give a whole record of ``kind``
    (the right number of fields, every number there and readable), and the others untouched.

    Other columns of ``lines`` are kept in both.  Blank lines are malformed, null ones too."""
    schema = BY_KIND[kind]
    corrupt = T.StructType([*schema, T.StructField("_corrupt", T.StringType())])
    parsed = lines.withColumn("_r", F.from_csv(F.col(value_col), corrupt.simpleString()[7:-1].replace(":", " "), {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "sep": ","}))
    numbers = [f.name for f in schema if isinstance(f.dataType, (T.LongType, T.IntegerType))]
    whole = F.col("_r").isNotNull() & F.col("_r._corrupt").isNull()
    for c in numbers:
        whole = whole & F.col(f"_r.{c}").isNotNull()
    others = [c for c in lines.columns if c != value_col]
    records = parsed.where(whole).select(*others, *(F.col(f"_r.{f.name}").alias(f.name) for f in schema))
    return _finish(records, kind), parsed.where(~whole).drop("_r")


def read_stream_records(spark: SparkSession, kind: str, path: str, strict: bool = True,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    r = _csv_reader(spark.readStream, kind, strict)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return _finish(r.csv(path), kind)


def with_event_time(df: DataFrame, seconds_col: str = "ts_s", seq_col: str | None = "seq",
                    ntz: bool = False) -> DataFrame:
    """Add ``ts`` (event time from epoch seconds) and, for batch input, a
    ``seq`` tie-break in file order when none exists."""
    ts = F.timestamp_seconds(F.col(seconds_col))
    df = df.withColumn("ts", ts.cast("timestamp_ntz") if ntz else ts)
    if seq_col and seq_col not in df.columns and not df.isStreaming:
        # Partition, then row order: right for one file.  For several, have
        # ``read_records(seq=...)`` number the rows in file order.
        df = df.withColumn(seq_col, F.monotonically_increasing_id())
    return df


def parse_access_log(lines: DataFrame, value_col: str = "value", keep=(), ntz: bool = False) -> DataFrame:
    """Space-separated access-log line -> (ip, user, event_time, method, url).

    Fields 0, 1, 3, 5 and 6 are used; field 4 (the zone token) is ignored,
    so the time is read as wall-clock time in the session zone (UTC).
    ``keep`` columns are carried through in front.
    """
    parts = F.split(F.col(value_col), " ")
    t = F.to_timestamp(parts.getItem(3), ACCESS_LOG_TIME_FORMAT)
    return lines.select(
        *keep,
        parts.getItem(0).alias("ip"),
        parts.getItem(1).alias("user"),
        (t.cast("timestamp_ntz") if ntz else t).alias("event_time"),
        parts.getItem(5).alias("method"),
        parts.getItem(6).alias("url"),
    )
