"""Which fields landed JSON really holds, per landing, whatever the declared schema reads.

Lines are parsed as VARIANT and taken apart level by level within their row, so fields
nobody declared are seen too and one pass over the lines does.  Landings are then told by
which records hold which set of paths, a table that is stored; one more pass compares values.  From the census: fields that are new, fields that went
missing, and fields that were probably renamed, i.e. new ones whose records all lack one
and the same known field and whose values look like that field's.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwright.session import run_dir
from layerwright.sources.bronze import ENDINGS, INGEST_DATE, SOURCES

DEPTH = 6
LOOKS_ALIKE = 0.5


def raw_lines(spark: SparkSession, root: str, source: str) -> DataFrame:
    """value (a JSON line), ingest_date of all landed lines."""
    schema = f"value string, {INGEST_DATE} date"
    return spark.read.schema(schema).option("pathGlobFilter", ENDINGS).text(f"{root}/{source}")


def declared_paths(source: str) -> list[str]:
    """The fields the registry declares, nested ones by their dotted path."""

    def walk(kind: T.DataType, path: str) -> Iterable[str]:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                yield from walk(f.dataType, f"{path}.{f.name}" if path else f.name)
        elif isinstance(kind, T.ArrayType):
            yield from walk(kind.elementType, f"{path}[]")
        else:
            yield path

    return sorted(walk(T.StructType.fromDDL(SOURCES[source]), ""))


def _children(x: Column) -> Column:
    """The members of an object or the elements of an array with their paths; NULL for a scalar."""

    def member(e: Column) -> Column:
        return F.struct(F.when(x.path == "", e.key).otherwise(F.concat_ws(".", x.path, e.key)).alias("path"), e.value.alias("v"))

    members = F.transform(F.map_entries(F.try_variant_get(x.v, "$", "map<string, variant>")), member)
    elements = F.transform(F.try_variant_get(x.v, "$", "array<variant>"), lambda e: F.struct(F.concat(x.path, F.lit("[]")).alias("path"), e.alias("v")))
    return F.coalesce(members, elements)


def records(lines: DataFrame, depth: int = DEPTH) -> DataFrame:
    """ingest_date, record (a hash of the line), leaves (array of path and value as VARIANT) of every line.

    NULLs of JSON are left out; lines that are no JSON have no array.  Row-local: nothing is shuffled.
    """
    root = F.array(F.struct(F.lit("").alias("path"), F.col("v")))
    rows = lines.select(INGEST_DATE, F.xxhash64("value").alias("record"), F.try_parse_json("value").alias("v")).select(
        INGEST_DATE, "record", F.when(F.col("v").isNotNull(), root).alias("level"))
    rows = rows.withColumn("leaves", F.when(F.col("level").isNotNull(), F.slice("level", 1, 0)))
    for n in range(depth):
        rows = rows.withColumn("level", F.transform("level", lambda x: F.struct(x.path.alias("path"), x.v.alias("v"), _children(x).alias("inner"))))
        if n:
            scalars = F.filter("level", lambda x: x.inner.isNull() & ~F.is_variant_null(x.v))
            rows = rows.withColumn("leaves", F.concat("leaves", F.transform(scalars, lambda x: F.struct(x.path.alias("path"), x.v.alias("v")))))
        rows = rows.withColumn("level", F.flatten(F.transform(F.filter("level", lambda x: x.inner.isNotNull()), lambda x: x.inner)))
    return rows.select(INGEST_DATE, "record", F.concat("leaves", F.filter("level", lambda x: ~F.is_variant_null(x.v))).alias("leaves"))


def _each(found: DataFrame) -> DataFrame:
    """One row per leaf.  Outer, since Spark would otherwise work the array out a second time to see whether it is empty."""
    return found.select(INGEST_DATE, "record", F.inline_outer("leaves")).where("path is not null")


def leaves(lines: DataFrame, depth: int = DEPTH) -> DataFrame:
    """ingest_date, record (a hash of the line), path, type, value (text) of every scalar in every record; NULLs of JSON are left out.

    Lines that are no JSON give nothing; what lies deeper than `depth` is one value.
    """
    return _each(records(lines, depth)).select(INGEST_DATE, "record", "path", F.schema_of_variant("v").alias("type"), F.variant_get("v", "$", "string").alias("value"))


def path_sets(lines: DataFrame, depth: int = DEPTH) -> DataFrame:
    """ingest_date, paths (the set of paths a record holds; none where it is no JSON), records of the landing that hold just these; equal lines are one record."""
    paths = F.array_sort(F.array_distinct(F.transform("leaves", lambda x: x.path)))
    each = records(lines, depth).select(INGEST_DATE, "record", F.coalesce(paths, F.array().cast("array<string>")).alias("paths")).distinct()
    return each.groupBy(INGEST_DATE, "paths").agg(F.count("*").alias("records"))


def shape(value: Column) -> Column:
    """A value's look: runs of digits and of letters as one sign each."""
    return F.regexp_replace(F.regexp_replace(F.substring(value, 1, 64), r"[A-Za-z]+", "a"), r"[0-9]+", "9")


def field_census(lines: DataFrame, depth: int = DEPTH) -> DataFrame:
    """ingest_date, path, type, records that hold it, records of the landing."""
    total = lines.groupBy(F.col(INGEST_DATE).alias("_day")).agg(F.count("*").alias("landed"))
    found = leaves(lines, depth).groupBy(INGEST_DATE, "path", "type").agg(F.count_distinct("record").alias("records"))
    return found.join(total, F.col(INGEST_DATE).eqNullSafe(F.col("_day"))).drop("_day")


def _similar(a: Column, b: Column) -> Column:
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))


def schema_drift(lines: DataFrame, declared: Iterable[str], depth: int = DEPTH) -> DataFrame:
    """ingest_date, path, change (new, missing, renamed), renamed_from, records, score.

    new: an undeclared field that no earlier landing holds.  missing: a declared field that
    half the earlier records hold and this landing nowhere.  renamed: a new field whose
    records all lack the declared field `renamed_from`; score is the mean of the likeness
    of their values' shapes and of their names, and at least LOOKS_ALIKE.
    """
    known = sorted(declared)
    # Looked at from three sides, so stored: a few rows per landing where records are alike.
    folder = f"{run_dir(lines.sparkSession, 'census')}/sets"
    path_sets(lines, depth).write.parquet(folder)
    sets = lines.sparkSession.read.parquet(folder)
    per_landing = sets.select(INGEST_DATE, "records", F.explode_outer("paths").alias("path")).where("path is not null").groupBy(INGEST_DATE, "path").agg(F.sum("records").alias("records"))
    is_known = F.col("path").isin(known)
    first = Window.partitionBy("path").orderBy(F.col(INGEST_DATE).asc_nulls_first())
    oldest = lines.agg(F.min(INGEST_DATE).alias("oldest"))
    new = per_landing.where(~is_known).withColumn("_n", F.row_number().over(first)).where("_n = 1").crossJoin(F.broadcast(oldest)).where(
        F.col(INGEST_DATE) > F.col("oldest")).select(INGEST_DATE, "path", "records")  # the other side is one row

    # Missing: landings and declared fields are both few, and every pair is looked at.
    total = lines.groupBy(INGEST_DATE).agg(F.count("*").alias("landed"))
    grid = total.withColumn("path", F.explode(F.array(*[F.lit(p) for p in known]))) if known else total.withColumn("path", F.lit(None).cast("string")).limit(0)
    held = per_landing.where(is_known).select(F.col(INGEST_DATE).alias("_d"), F.col("path").alias("_p"), "records")
    grid = grid.join(held, F.col(INGEST_DATE).eqNullSafe(F.col("_d")) & (F.col("path") == F.col("_p")), "left").na.fill(0, ["records"])
    earlier = first.rowsBetween(Window.unboundedPreceding, -1)
    grid = grid.withColumn("before", F.sum("records").over(earlier)).withColumn("landed_before", F.sum("landed").over(earlier))
    missing = grid.where("records = 0 and before * 2 >= landed_before").select(INGEST_DATE, "path", F.col("landed").alias("records"))

    # Renamed: what the records with a new field lack, and how the values look.
    carriers = sets.join(F.broadcast(new.select(F.col(INGEST_DATE).alias("_d"), F.col("path").alias("new_path"))), (F.col(INGEST_DATE) == F.col("_d")) & F.array_contains("paths", F.col("new_path")))
    lacking = carriers.select(INGEST_DATE, "new_path", F.explode(F.array_except(F.array(*[F.lit(p) for p in known]), "paths")).alias("old_path"), F.col("records").alias("n"))
    lacking = lacking.groupBy(INGEST_DATE, "new_path", "old_path").agg(F.sum("n").alias("n"))
    whole = lacking.join(new.withColumnsRenamed({"path": "_p", INGEST_DATE: "_d"}), (F.col("new_path") == F.col("_p")) & (F.col(INGEST_DATE) == F.col("_d")) & (F.col("n") == F.col("records")))
    # Only the looks of fields that may have been renamed count.
    sides = F.array(F.struct(F.col("new_path").alias("_q"), F.lit(True).alias("_new")), F.struct(F.col("old_path").alias("_q"), F.lit(False).alias("_new")))
    asked = whole.select(INGEST_DATE, "new_path", "old_path", "records", F.inline(sides))
    facts = _each(records(lines, depth)).join(F.broadcast(asked.select(F.col("_q").alias("_w")).distinct()), F.col("path") == F.col("_w"), "left_semi")
    shapes = facts.groupBy("path", shape(F.variant_get("v", "$", "string")).alias("shape")).agg(F.count("*").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy("path"))
    shapes = shapes.select("path", "shape", share.alias("share"))
    pair = [INGEST_DATE, "new_path", "old_path", "records"]
    both = shapes.join(asked, F.col("path") == F.col("_q")).groupBy(*pair, "shape").agg(F.sum(F.when(F.col("_new"), F.col("share"))).alias("sa"), F.sum(F.when(~F.col("_new"), F.col("share"))).alias("sb"))
    alike = both.where("sa is not null and sb is not null").groupBy(*pair).agg(F.sum(F.least("sa", "sb")).alias("overlap"))
    scored = alike.withColumn("score", (F.col("overlap") + _similar(F.col("new_path"), F.col("old_path"))) / 2).where(F.col("score") >= LOOKS_ALIKE)
    best = Window.partitionBy(INGEST_DATE, "new_path").orderBy(F.desc("score"), "old_path")
    renamed = scored.withColumn("_n", F.row_number().over(best)).where("_n = 1")

    none = F.lit(None)
    return (
        new.select(INGEST_DATE, "path", F.lit("new").alias("change"), none.cast("string").alias("renamed_from"), "records", none.cast("double").alias("score"))
        .unionAll(missing.select(INGEST_DATE, "path", F.lit("missing"), none.cast("string"), "records", none.cast("double")))
        .unionAll(renamed.select(INGEST_DATE, F.col("new_path"), F.lit("renamed"), F.col("old_path"), "records", "score"))
    )
