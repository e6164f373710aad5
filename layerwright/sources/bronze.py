"""Append-only JSON landings: `<root>/<source>/ingest_date=YYYY-MM-DD/*.json[l]`."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.sources import files

INGEST_DATE = "ingest_date"
CORRUPT = "_corrupt_record"

# Source registry.  Only the fields staging reads are declared, at every
# nesting level: nested JSON fields are not pruned by the reader, so an
# undeclared field is the only one that costs nothing.  One declared schema
# over all files is also the merge by name: a field a file lacks reads as NULL.
# (fixed values: source and field names)
SOURCES: dict[str, str] = {
    "nyc_311": """
        unique_key string, created_date string, closed_date string, agency string,
        agency_name string, complaint_type string, descriptor string, borough string,
        incident_zip string, status string, latitude string, longitude string
    """,
    "github_commits": """
        sha string,
        commit struct<message: string, author: struct<name: string, email: string, date: string>>,
        author struct<login: string>
    """,
    "sec_edgar_10k": """
        _id string,
        _source struct<adsh: string, form: string, file_date: string, period_ending: string,
                       sequence: string, display_names: array<string>, ciks: array<string>,
                       biz_states: array<string>, sics: array<string>, file_type: string>
    """,
}


# JSON lines as written here and elsewhere, plain or compressed; anything else (a half-written .tmp) is no landing.
ENDINGS = "*.{json,jsonl,json.gz,jsonl.gz,json.bz2,jsonl.bz2,json.zst,jsonl.zst,json.lz4,jsonl.lz4}"


def bronze_schema(source: str) -> str:
    return f"{SOURCES[source].strip()}, {CORRUPT} string, {INGEST_DATE} date"


def _reader(reader, source: str, root: str):
    return (
        reader.schema(bronze_schema(source))
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", ENDINGS)
        .json(f"{root}/{source}")
    )


def read_bronze(spark: SparkSession, root: str, source: str) -> DataFrame:
    """All landed rows of one source.  `ingest_date` is a partition column, so filters on it prune."""
    return _reader(spark.read, source, root)


def stream_bronze(spark: SparkSession, root: str, source: str, max_files: int | None = None) -> DataFrame:
    """The same landing as a stream; `max_files` bounds one micro-batch."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _reader(reader, source, root)


def write_bronze(
    df: DataFrame,
    root: str,
    source: str,
    ingest_date: str = INGEST_DATE,
    keep_nulls: bool = False,
    rebalance: bool = True,
    compression: str = "gzip",
) -> None:
    """Land rows as compressed JSON lines by ingest date.

    keep_nulls=False drops NULL fields from the record, True writes explicit
    nulls.  The rebalance gives files of even size: a hot date is split over
    several tasks, small dates do not scatter over all of them.
    rebalance=False saves that shuffle of whole records where tasks times dates
    are few: each task then writes a file per date it holds.
    """
    rows = df.hint("rebalance", ingest_date) if rebalance else df
    (
        rows.write.mode("append")
        .option("ignoreNullFields", str(not keep_nulls).lower())
        .option("compression", compression)
        .partitionBy(ingest_date)
        .json(f"{root}/{source}")
    )


def check_bronze(spark: SparkSession, root: str, sources: Iterable[str] = tuple(SOURCES), ingest_date: str = "*") -> DataFrame:
    """Preflight violations: a source without any file, and every zero-byte file.

    Listing only, no data is read; zero-byte files are invisible to the data
    readers.  `ingest_date` may name one landing so that a daily run does not
    list all of history.
    """
    problems = []
    for source in sources:
        found = 0
        for path, length in files.list_files(spark, f"{root}/{source}/{INGEST_DATE}={ingest_date}/[!_.]{ENDINGS}"):
            found += 1
            if length == 0:
                problems.append((source, path, 0, "empty_file"))
        if not found:
            problems.append((source, f"{root}/{source}", None, "no_files"))
    return spark.createDataFrame(problems, "source string, path string, length bigint, problem string")


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """Merge differently shaped frames by column name; a missing column is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_parquet(spark: SparkSession, path: str, drop: Iterable[str] = ()) -> DataFrame:
    """Parquet from a staging location, without the columns named in `drop`."""
    return spark.read.parquet(path).drop(*drop)


def with_ingest_date(df: DataFrame, date) -> DataFrame:
    return df.withColumn(INGEST_DATE, F.lit(date).cast("date"))
