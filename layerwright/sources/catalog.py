"""Layer databases, replaced tables and their documentation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from layerwright.sources import files
from layerwright.sources.bronze import union_by_name
from layerwright.sources.snapshots import expire, next_version, snapshot_read

LAYERS = ("staging", "silver", "gold")  # fixed values: a layer's database is its bare name


def create_layers(spark: SparkSession, root: str, layers: Sequence[str] = LAYERS) -> None:
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}` LOCATION '{root}/{layer}.db'")


def as_view(df: DataFrame, name: str) -> DataFrame:
    """View materialization: nothing is computed until it is read."""
    df.createOrReplaceTempView(name)
    return df


def write_layer(df: DataFrame, path: str, partition_by: str | None = None, keep: int = 2) -> DataFrame:
    """Full rebuild of a layer table as its next version; answers the stored frame.

    The table switches over when the new version is complete, so a lost job
    leaves the old one whole; the newest `keep` versions stay for readers that
    have just begun.  A partitioned write is rebalanced first: a hot date is
    split over tasks, small ones share one, and the table does not end up with
    a file per task and date.  An unpartitioned write stays where its rows
    are; it needs no shuffle.
    """
    spark = df.sparkSession
    target = next_version(spark, path)
    if partition_by:
        df.hint("rebalance", partition_by).write.option("compression", files.CODEC).partitionBy(partition_by).parquet(target)
    else:
        df.write.option("compression", files.CODEC).parquet(target)
    expire(spark, path, keep)
    return spark.read.schema(df.schema).parquet(target)


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a layer table."""
    return snapshot_read(spark, path)


def register_view(spark: SparkSession, name: str, path: str, columns: Sequence[str], comment: str = "") -> None:
    """A catalog view over the Parquet files of one folder; files are listed anew by each query."""
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} COMMENT {_quote(comment)} AS SELECT {', '.join(columns)} FROM parquet.`{path}`"
    )


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def publish(
    df: DataFrame,
    name: str,
    path: str,
    comment: str = "",
    column_comments: Mapping[str, str] | None = None,
    keep: int = 2,
) -> DataFrame:
    """Create or replace the table `name` as these rows, with its documentation.

    The rows are complete under a new folder before the catalog entry is
    touched; an existing table of the same shape is then switched over by its
    location alone, one of another shape is dropped and created.  The newest
    `keep` versions stay on storage.  Answers (table_name, rows).
    """
    spark = df.sparkSession
    target = next_version(spark, path)
    df.write.parquet(target)
    _switch(spark, name, df, target)
    expire(spark, path, keep=keep)
    document(spark, name, comment, column_comments or {})
    return spark.sql(f"SELECT {_quote(name)} AS table_name, count(*) AS rows FROM {name}")


def _switch(spark: SparkSession, name: str, df: DataFrame, target: str) -> None:
    if spark.catalog.tableExists(name):
        if _shape(spark.table(name)) == _shape(df):
            spark.sql(f"ALTER TABLE {name} SET LOCATION {_quote(target)}")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, path=target, source="parquet", schema=df.schema)


def _shape(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def document(spark: SparkSession, name: str, comment: str, column_comments: Mapping[str, str]) -> None:
    spark.sql(f"COMMENT ON TABLE {name} IS {_quote(comment)}")
    for column, text in column_comments.items():
        spark.sql(f"ALTER TABLE {name} ALTER COLUMN `{column}` COMMENT {_quote(text)}")


def described_columns(spark: SparkSession, name: str) -> DataFrame:
    """Column documentation as the catalog holds it."""
    return spark.sql(f"DESCRIBE TABLE {name}")


def publish_all(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    database: str,
    path: str,
    docs: Mapping[str, tuple[str, Mapping[str, str]]] | None = None,
) -> DataFrame:
    """Publish several tables into one database; answers (table_name, rows) for each."""
    docs = docs or {}
    audits = []
    for name, df in frames.items():
        comment, columns = docs.get(name, ("", {}))
        audits.append(publish(df, f"{database}.{name}", f"{path}/{name}", comment, columns))
    return union_by_name(audits)
