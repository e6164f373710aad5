"""Silver kept up to date by the keys that changed, instead of rebuilt from all of history.

A key index says in which landings a key has rows and on which grain dates they
lie: (key_hash, grain_date) per landing, a table bucketed by key_hash and partitioned
by landing.  When landings change (new, rewritten, withdrawn):

1. the changed landings' index rows, before and after, give the touched keys;
2. one join of the index with them, on its buckets and so without moving it, gives the
   other landings that hold rows of those keys and the grain dates these lie on;
3. only those landings' staged rows of touched keys compete again for silver;
4. only those grain dates of silver are rewritten: their untouched rows stay, the
   winners are put beside them;
5. gold is re-aggregated for exactly those dates, so nothing is late here and no
   window or watermark is needed.

Keys meet by a 64-bit hash.  Two keys with one hash are touched together, which costs
a few rows and changes nothing, and NULL is a key like others.  Landing and grain dates
reach the driver (at most a calendar); keys and rows never do.  A marker names a run in
progress: whatever broke off under it, the next run rebuilds index and silver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.operators.grain import PART, aggregate
from layerwright.operators.incremental import has_gold, incremental_run, read_or_empty, repair_grains, replace_partitions
from layerwright.operators.quality import accepted, rejected
from layerwright.plans.domains import Domain
from layerwright.sources import files
from layerwright.sources.bronze import INGEST_DATE

BUCKETS = 64
HASH = "key_hash"
LANDING = "landing"
DATABASE = "layerwright_index"
INTENT = "_updating"
UNDATED = "none"  # landing of the rows without a landing date; as a NULL it could not be dropped by value


def _folder(landing: str) -> str:
    return UNDATED if landing == files.NO_VALUE else landing


def key_hash(key: str) -> Column:
    return F.xxhash64(F.col(key))


@dataclass(frozen=True)
class KeyIndex:
    """The index of one domain: a bucketed table over a folder of the warehouse."""

    spark: SparkSession
    path: str
    name: str
    buckets: int = BUCKETS

    @property
    def table(self) -> str:
        # A session's catalog may be new while the folder is not, and two warehouses may share a catalog.
        return f"{DATABASE}.{self.name}_{hashlib.md5(self.path.encode()).hexdigest()[:16]}"

    def ensure(self) -> str:
        """The table over the folder, declared if this catalog does not know it; its partitions are those on storage."""
        table = self.table
        if not self.spark.catalog.tableExists(table):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE}")
            self.spark.sql(
                f"CREATE TABLE {table} ({HASH} BIGINT, {PART} STRING, {LANDING} STRING) USING parquet "
                f"PARTITIONED BY ({LANDING}) CLUSTERED BY ({HASH}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        if files.partition_values(self.spark, self.path, LANDING):
            self.spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
        return table

    def read(self, landings: Sequence[str] | None = None) -> DataFrame:
        rows = self.spark.table(self.ensure())
        return rows if landings is None else rows.where(F.col(LANDING).isin([_folder(d) for d in landings]))

    def replace(self, entries: DataFrame, landings: Sequence[str]) -> None:
        """Make the entries of these landings equal to `entries` (HASH, PART, LANDING): one file per bucket and landing."""
        table = self.ensure()
        for value in {_folder(d) for d in landings} & set(files.partition_values(self.spark, self.path, LANDING)):
            self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({LANDING} = '{value}')")
            files.delete(self.spark, f"{self.path}/{LANDING}={value}")
        dealt = entries.distinct().repartition(self.buckets, HASH).select(HASH, PART, LANDING)
        dealt.write.mode("append").insertInto(table)

    def clear(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        files.delete(self.spark, self.path)


def entries_of(classified: DataFrame, domain: Domain) -> DataFrame:
    """Index rows of staged rows: only accepted ones compete for silver."""
    good = domain.dated(accepted(classified))
    landing = F.coalesce(F.col(INGEST_DATE).cast("string"), F.lit(UNDATED))
    day = F.coalesce(F.col(PART).cast("string"), F.lit(files.NO_VALUE))
    return good.select(key_hash(domain.key).alias(HASH), day.alias(PART), landing.alias(LANDING))


def touched_entries(index: DataFrame, touched: DataFrame, buckets: int) -> DataFrame:
    """Landings and grain dates of the touched keys' rows.

    The keys are dealt as the index's buckets are, so it is the index that stays where it lies.
    """
    dealt = touched.select(HASH).repartition(buckets, HASH).distinct()
    return index.join(dealt, HASH, "left_semi").select(LANDING, PART).distinct()


def landed_grains(index: KeyIndex, landings: Sequence[str]) -> DataFrame:
    """grain_date (NULL for rows without one), keys: what these landings brought, from their index entries alone."""
    day = F.when(F.col(PART) != files.NO_VALUE, F.col(PART)).cast("date")
    return index.read(landings).groupBy(day.alias(PART)).agg(F.count("*").alias("keys"))


def late_grains_indexed(index: KeyIndex, landings: Sequence[str], start) -> DataFrame:
    """Grain dates of these landings that a run whose window begins at `start` does not reach; no history is read."""
    return landed_grains(index, landings).where(F.col(PART) < F.lit(str(start)[:10]).cast("date"))


@dataclass(frozen=True)
class KeyedPaths:
    index: str
    silver: str
    quarantine: str
    touched: str
    gold: str
    ledger: str

    @classmethod
    def of(cls, cfg, domain: Domain) -> KeyedPaths:
        base = f"{cfg.warehouse_root}/by_key"
        return cls(f"{base}/index/{domain.silver}", f"{base}/silver/{domain.silver}", f"{base}/silver/{domain.quarantine}",
                   f"{base}/touched/{domain.silver}", cfg.path("gold", domain.gold), f"{base}/ledger/{domain.staging}")


def _dates(landings: Sequence[str]) -> Column:
    return F.coalesce(F.col(INGEST_DATE).cast("string"), F.lit(files.NO_VALUE)).isin(list(landings))


def _days(rows: Sequence[str]) -> list[str | None]:
    return [None if d == files.NO_VALUE else d for d in rows]


def update_silver(classified: DataFrame, domain: Domain, paths: KeyedPaths, landings: Sequence[str], whole: bool, buckets: int = BUCKETS) -> list[str | None] | None:
    """Bring stored silver and the index up to date with these landings' staged rows; the grain dates rewritten (None: all).

    `classified` are all staged rows.  A rebuild is done where nothing is stored yet, where a
    run broke off, or on demand.  The marker stays until `finish`, which gold waits for too.
    """
    spark = classified.sparkSession
    index = KeyIndex(spark, paths.index, domain.silver, buckets)
    broken = files.read_text(spark, f"{paths.index}{INTENT}") is not None
    if not (whole or broken) and files.partition_values(spark, paths.silver, PART):
        if not landings:
            return []
        files.write_text(spark, f"{paths.index}{INTENT}", "")
        return _update(classified, domain, paths, index, landings)
    files.write_text(spark, f"{paths.index}{INTENT}", "")
    index.clear()
    index.replace(entries_of(classified, domain), ())
    replace_partitions(domain.dated(domain.to_silver(accepted(classified))), paths.silver, PART)
    return None


def finish(spark: SparkSession, paths: KeyedPaths) -> None:
    """All layers are up to date: the marker goes."""
    files.delete(spark, f"{paths.index}{INTENT}")


def _update(classified: DataFrame, domain: Domain, paths: KeyedPaths, index: KeyIndex, landings: Sequence[str]) -> list[str | None]:
    spark = classified.sparkSession
    arrived = classified.where(_dates(landings))
    both = index.read(landings).select(HASH, PART).unionByName(entries_of(arrived, domain).select(HASH, PART))
    # Written down, since the entries they come from are about to be replaced.
    both.distinct().write.mode("overwrite").parquet(paths.touched)
    entries = spark.read.schema(f"{HASH} bigint, {PART} string").parquet(paths.touched)
    touched = entries.select(HASH).distinct()
    index.replace(entries_of(arrived, domain), landings)

    met = touched_entries(index.read(), touched, index.buckets).collect()  # pairs of two calendars
    sources = sorted({files.NO_VALUE if r[LANDING] == UNDATED else r[LANDING] for r in met})
    days = sorted({r[PART] for r in met} | {r[0] for r in entries.select(PART).distinct().collect()})
    rivals = accepted(classified.where(_dates(sources))).join(touched, key_hash(domain.key) == F.col(HASH), "left_semi")
    winners = domain.dated(domain.to_silver(rivals))
    # A winner lies on one of the days its key's rows lie on.
    silver = read_silver(spark, paths, winners)
    staying = silver.where(F.coalesce(F.col(PART).cast("string"), F.lit(files.NO_VALUE)).isin(days))
    staying = staying.join(touched, key_hash(domain.key) == F.col(HASH), "left_anti")
    replace_partitions(staying.unionByName(winners), paths.silver, PART, only=_days(days))
    return _days(days)


def read_silver(spark: SparkSession, paths: KeyedPaths, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(paths.silver)


def update_quarantine(classified: DataFrame, domain: Domain, paths: KeyedPaths, landings: Sequence[str], whole: bool) -> DataFrame:
    """Rejected rows, stored by landing: only changed landings are written again."""
    spark = classified.sparkSession
    columns = [*domain.quarantine_columns, INGEST_DATE]
    some = classified if whole else classified.where(_dates(landings))
    if whole or landings:
        replace_partitions(rejected(some, columns), paths.quarantine, INGEST_DATE, only=None if whole else _days(landings), rebalance=False)
    schema = rejected(classified, columns).schema
    if not files.partition_values(spark, paths.quarantine, INGEST_DATE):
        return spark.createDataFrame([], schema).drop(INGEST_DATE)
    return spark.read.schema(schema).parquet(paths.quarantine).drop(INGEST_DATE)


def update_gold(silver: DataFrame, domain: Domain, paths: KeyedPaths, days: list[str | None] | None) -> DataFrame:
    """Gold of exactly the rewritten dates (None: of all)."""
    spark = silver.sparkSession
    if days is None or not has_gold(spark, paths.gold):
        return incremental_run(silver, paths.gold, domain.spec, full_refresh=True)
    if not days:
        return read_or_empty(spark, paths.gold, domain.spec, aggregate(silver, domain.spec))
    return repair_grains(silver, paths.gold, domain.spec, days)
