"""Metadata-only file listings on whatever file system a path names."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession


CODEC = "zstd"  # of the Parquet files of stored layers: much smaller than Spark's default where rows hold text
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: folder of the rows without a partition value


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def list_files(spark: SparkSession, pattern: str) -> Iterator[tuple[str, int]]:
    """Path and length of everything that matches a glob, zero-byte files included: one listing, made in the JVM."""
    fs, path = _fs(spark, pattern)
    return ((s.getPath().toString(), s.getLen()) for s in fs.globStatus(path) or [])


def partition_files(spark: SparkSession, root: str, column: str, values: list[str]) -> set[tuple[str, str]]:
    """(value, name) of the data files in these partition folders, by one listing of them all."""
    out: set[tuple[str, str]] = set()
    for i in range(0, len(values), 500):
        some = ",".join(v.replace("\\", "\\\\").replace("{", "\\{").replace(",", "\\,") for v in values[i : i + 500])
        for path, _ in list_files(spark, f"{root}/{column}={{{some}}}/[!_.]*"):
            folder, name = path.rsplit("/", 2)[-2:]
            out.add((folder.split("=", 1)[1], name))
    return out


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the data files directly in a folder."""
    return [path.rsplit("/", 1)[1] for path, _ in list_files(spark, f"{folder}/[!_.]*")]


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.delete(p, True)


def create_empty(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.create(p, False).close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file, None where there is none."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    source = fs.open(p)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def partition_values(spark: SparkSession, root: str, column: str, marker: str = "") -> list[str]:
    """Values of the `column=value` folders under root (optionally only those holding `marker`)."""
    suffix = f"/{marker}" if marker else ""
    found = [path for path, _ in list_files(spark, f"{root}/{column}=*{suffix}")]
    tag = f"/{column}="
    return sorted(n.rsplit(tag, 1)[1].split("/")[0] for n in found)
