"""Exports whose content is verified: column digests taken while writing, derived again from what was stored.

`snapshot_write` compares row counts.  Here every column's NULLs, smallest and largest
value and an order-free hash are observed by the job that writes the version (no second
pass over the source), stored beside it, and can be derived again at any later time.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwright.sources import files
from layerwright.sources.snapshots import next_version, version_path

DIGEST = "_digest.json"  # readers skip names with an underscore
METRICS = ("nulls", "smallest", "largest", "hash_sum", "hash_xor")


def _ordered(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.MapType, T.ArrayType, T.StructType, T.BinaryType, T.VariantType))


def _metrics(df: DataFrame) -> list[Column]:
    """One aggregate per column and metric, named by place, since names may hold anything."""
    out = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        shown = F.to_json(F.struct(c.alias("v"))) if not _ordered(f.dataType) else c
        h = F.xxhash64(shown)
        none = F.lit(None).cast("string")
        out += [
            F.count_if(c.isNull()).alias(f"nulls_{i}"),
            (F.min(c).cast("string") if _ordered(f.dataType) else F.first(none)).alias(f"smallest_{i}"),
            (F.max(c).cast("string") if _ordered(f.dataType) else F.first(none)).alias(f"largest_{i}"),
            F.sum(h.cast("decimal(20,0)")).cast("string").alias(f"hash_sum_{i}"),
            F.bit_xor(h).cast("string").alias(f"hash_xor_{i}"),
        ]
    return out


def _listed(values: dict, columns: list[str]) -> dict:
    return {"rows": values.get("rows", 0), "columns": {c: {m: _text(values.get(f"{m}_{i}")) for m in METRICS} for i, c in enumerate(columns)}}


def _text(value) -> str | None:
    return None if value is None else str(value)


def verified_write(df: DataFrame, path: str, table_name: str) -> DataFrame:
    """Write the next version with its digests, and verify it; answer column_name, nulls, smallest, largest, hash_sum, hash_xor.

    Raises if what was stored is not what was written.
    """
    spark = df.sparkSession
    target = next_version(spark, path)
    seen = Observation()
    df.observe(seen, *_metrics(df)).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(target)
    files.write_text(spark, f"{target}/{DIGEST}", json.dumps(_listed(seen.get, df.columns)))
    version = int(target.rsplit("=", 1)[1])
    found = verify_snapshot(spark, path, version)
    if not found.isEmpty():
        raise RuntimeError(f"{table_name} version {version} differs from what was written: {found.limit(5).collect()}")
    return stored_digests(spark, path, version)


def _stored(spark: SparkSession, path: str, version: int | None) -> tuple[str, dict]:
    folder = version_path(spark, path, version)
    text = files.read_text(spark, f"{folder}/{DIGEST}")
    if text is None:
        raise FileNotFoundError(f"{folder} has no digests")
    return folder, json.loads(text)


def stored_digests(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The digests written with a version (the latest): a row per column."""
    _, told = _stored(spark, path, version)
    rows = [(c, int(m["nulls"] or 0), m["smallest"], m["largest"], m["hash_sum"], m["hash_xor"]) for c, m in told["columns"].items()]
    return spark.createDataFrame(rows, "column_name string, nulls bigint, smallest string, largest string, hash_sum string, hash_xor string")


def verify_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Violations: column_name (NULL for the row count), metric, written, found. One pass over the stored version."""
    folder, told = _stored(spark, path, version)
    rows = spark.read.parquet(folder)
    found = _listed(rows.agg(*_metrics(rows)).first().asDict(), rows.columns)
    problems = [] if found["rows"] == told["rows"] else [(None, "rows", str(told["rows"]), str(found["rows"]))]
    for c in sorted(told["columns"].keys() | found["columns"].keys()):
        a, b = told["columns"].get(c, {}), found["columns"].get(c, {})
        problems += [(c, m, a.get(m), b.get(m)) for m in METRICS if a.get(m) != b.get(m)]
    return spark.createDataFrame(problems, "column_name string, metric string, written string, found string")
