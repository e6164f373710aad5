"""A whole run in hard-gated stages: preflight, build, check, export, publish.

A failing stage stops every later one; nothing is exported or published from
a run whose checks failed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.operators.checks import run_checks, unexpected_failures
from layerwright.operators.diff import recompute_diff
from layerwright.operators.grain import PART, aggregate
from layerwright.operators.history import record_verdicts
from layerwright.operators.incremental import (
    LOOKBACK_DAYS,
    has_gold,
    incremental_run,
    missed_grains,
    read_or_empty,
    repair_grains,
    replace_partitions,
)
from layerwright.operators.ledger import ledger_rate, read_ledger, update_ledger
from layerwright.operators.quality import REASON, THRESHOLD, accepted, over_threshold, rejected, rejection_rate
from layerwright.plans.changed_keys import BUCKETS, KeyedPaths, finish, read_silver, update_gold, update_quarantine, update_silver
from layerwright.plans.domains import DOMAINS, Domain
from layerwright.sources import files
from layerwright.sources.bronze import CORRUPT, INGEST_DATE, check_bronze, read_bronze, with_ingest_date
from layerwright.sources.catalog import create_layers, publish_all, read_layer, register_view, write_layer
from layerwright.sources.landings import changed, landed, remember, remembered
from layerwright.sources.snapshots import snapshot_all, version_path

VERDICTS = "_verdicts"  # folder of every run's verdicts under the warehouse
STAGES = ("preflight", "build", "check", "export", "publish")


class GateFailed(Exception):
    """A stage found violations; the stages after it did not start."""

    def __init__(self, stage: str, violations: DataFrame, report: DataFrame):
        super().__init__(f"stage {stage} failed")
        self.stage = stage
        self.violations = violations
        self.report = report


@dataclass(frozen=True)
class RunConfig:
    bronze_root: str
    warehouse_root: str
    database: str = "layerwright_published"
    domains: Mapping[str, Domain] | None = None
    lookback_days: int = LOOKBACK_DAYS
    full_refresh: bool = False
    threshold: float = THRESHOLD
    known_failures: Iterable[str] = ()
    cap: dt.date | str | None = None  # no watermark may lie beyond this date
    gate_per_batch: bool = False  # judge each landing date by itself, undiluted by history
    by_key: bool = False  # update silver, quarantine and gold by the keys that changed, instead of rebuilding them
    index_buckets: int = BUCKETS  # of the key index; fixed once the index is made

    def path(self, layer: str, table: str) -> str:
        return f"{self.warehouse_root}/{layer}/{table}"

    def chosen(self) -> list[Domain]:
        return list((self.domains or DOMAINS).values())


@dataclass(frozen=True)
class Built:
    """One domain's stored layers."""

    domain: Domain
    classified: DataFrame
    rejected: DataFrame
    silver: DataFrame
    gold: DataFrame
    ledger: DataFrame | None = None  # rejection counts per landing and reason, where they are kept

    def tables(self) -> dict[str, DataFrame]:
        d = self.domain
        return {d.staging: self.classified.drop(REASON, INGEST_DATE, CORRUPT), d.silver: self.silver, d.quarantine: self.rejected, d.gold: self.gold}


def side_by_side(fn: Callable, items: Sequence) -> list:
    """Submit independent jobs from a few threads, so that they fill each other's gaps on the cluster."""
    with ThreadPoolExecutor(max(len(items), 1)) as pool:
        return list(pool.map(fn, items))


def build(spark: SparkSession, domain: Domain, cfg: RunConfig) -> Built:
    """Bronze to gold for one domain.

    JSON is parsed once per landing, not once per run: classified rows are
    stored as Parquet by landing date, and only dates that changed are staged
    again.  Both sides of the split, the counts and silver read from there, and
    only the columns they need.
    """
    notes = f"{cfg.warehouse_root}/staging/_landings/{domain.staging}"
    now = landed(spark, cfg.bronze_root, domain.source, domain.staging_rules())
    before = remembered(spark, notes)
    # A refresh stages every date anew, and drops those that were withdrawn since.
    dates = sorted(now.keys() | before.keys()) if cfg.full_refresh else changed(now, before)
    bronze = read_bronze(spark, cfg.bronze_root, domain.source)
    if not now.keys() <= set(dates):
        # As text, so that any year and the folder of rows without a date are dates like others.
        bronze = bronze.where(F.coalesce(F.col(INGEST_DATE).cast("string"), F.lit(files.NO_VALUE)).isin(dates))
    classified = _store_classified(domain.stage(bronze, lineage=[INGEST_DATE, CORRUPT]), domain, cfg, dates)
    if cfg.by_key:
        built = _build_by_key(classified, domain, cfg, dates, whole=cfg.full_refresh or set(now) <= set(dates))
    else:
        built = _build_on(classified, domain, cfg)
    # Remembered last: landings whose layers were not brought up to date count as changed again.
    if dates:
        remember(spark, notes, now)
    return built


def _build_by_key(classified: DataFrame, domain: Domain, cfg: RunConfig, dates: Sequence[str], whole: bool) -> Built:
    """Silver, quarantine and gold of the landings that changed only (see plans/changed_keys.py)."""
    spark, paths = classified.sparkSession, KeyedPaths.of(cfg, domain)
    days = update_silver(classified, domain, paths, dates, whole, cfg.index_buckets)
    bad = update_quarantine(classified, domain, paths, dates, whole or days is None)
    silver = read_silver(spark, paths, domain.dated(domain.to_silver(accepted(classified))))
    update_ledger(classified, paths.ledger, None if whole or days is None else dates)
    gold = update_gold(silver, domain, paths, days)
    finish(spark, paths)
    return Built(domain, classified, bad, silver, gold, read_ledger(spark, paths.ledger))


def build_from(staged: DataFrame, domain: Domain, cfg: RunConfig) -> Built:
    """The same from rows already staged; without a landing date they count as one landing."""
    if INGEST_DATE not in staged.columns:
        staged = with_ingest_date(staged, "1970-01-01")
    return _build_on(_store_classified(staged, domain, cfg), domain, cfg)


def _store_classified(staged: DataFrame, domain: Domain, cfg: RunConfig, only: Sequence[str] | None = None) -> DataFrame:
    """Classify and store by landing date (all dates, or `only` some)."""
    path = cfg.path("staging", domain.staging)
    rows = domain.classify(staged)
    if only is None or only:
        # A landing file belongs to one date, so no task writes to many.
        replace_partitions(rows, path, INGEST_DATE, only=only, rebalance=False)
    return staged.sparkSession.read.schema(rows.schema).parquet(path)


def _build_on(classified: DataFrame, domain: Domain, cfg: RunConfig) -> Built:
    bad = write_layer(rejected(classified, domain.quarantine_columns), cfg.path("silver", domain.quarantine))
    silver = domain.dated(domain.to_silver(accepted(classified), stored=True))
    silver = write_layer(silver, cfg.path("silver", domain.silver), partition_by=PART)
    gold = incremental_run(silver, cfg.path("gold", domain.gold), domain.spec, cfg.lookback_days, cfg.full_refresh, cfg.cap)
    return Built(domain, classified, bad, silver, gold)


def load(spark: SparkSession, domain: Domain, cfg: RunConfig) -> Built:
    """The stored layers of an earlier build."""
    classified = spark.read.parquet(cfg.path("staging", domain.staging))
    if cfg.by_key:
        paths = KeyedPaths.of(cfg, domain)
        silver = read_silver(spark, paths, domain.dated(domain.to_silver(accepted(classified))))
        bad = update_quarantine(classified, domain, paths, (), whole=False)
        ledger = read_ledger(spark, paths.ledger)
    else:
        silver = read_layer(spark, cfg.path("silver", domain.silver))
        bad, ledger = read_layer(spark, cfg.path("silver", domain.quarantine)), None
    gold = read_or_empty(spark, cfg.path("gold", domain.gold), domain.spec, aggregate(silver, domain.spec))
    return Built(domain, classified, bad, silver, gold, ledger)


def repair(spark: SparkSession, domain: Domain, cfg: RunConfig) -> DataFrame:
    """Re-aggregate the stored grains older than the window that no longer match stored silver; answers gold."""
    stored, spec = load(spark, domain, cfg), domain.spec
    missed = missed_grains(stored.silver, stored.gold, spec, cfg.lookback_days, cfg.cap)
    dates = missed.select(F.col(spec.date_name).cast("date").cast("string")).distinct()
    # At most one value per stored partition.
    return repair_grains(stored.silver, cfg.path("gold", domain.gold), spec, [r[0] for r in dates.collect()])


def register_layers(spark: SparkSession, cfg: RunConfig) -> None:
    """Make the stored layers queryable by name: staging.*, silver.* and gold.*."""
    create_layers(spark, cfg.warehouse_root)
    for d in cfg.chosen():
        register_view(spark, f"staging.{d.staging}", cfg.path("staging", d.staging), list(d.mapping()))
        relations = {
            ("silver", d.silver): list(d.conform()),
            ("silver", d.quarantine): [*d.quarantine_columns, REASON],
        }
        keyed = KeyedPaths.of(cfg, d)
        for (layer, table), columns in relations.items():
            if cfg.by_key:
                folder = keyed.silver if table == d.silver else keyed.quarantine
            else:
                folder = version_path(spark, cfg.path(layer, table))
            register_view(spark, f"{layer}.{table}", folder, columns, d.comments.get(table, ""))
        if has_gold(spark, cfg.path("gold", d.gold)):
            date = f"CAST({PART} AS TIMESTAMP_NTZ) AS {d.spec.date_name}"
            columns = [date, *d.spec.dims, *d.spec.measures]
            register_view(spark, f"gold.{d.gold}", cfg.path("gold", d.gold), columns, d.comments[d.gold])


def check(built: Iterable[Built], threshold: float = THRESHOLD, per_batch: bool = False) -> DataFrame:
    """Verdicts of all declared checks: columns, rejection rate, recomputation.

    per_batch=True applies the rate to every landing date by itself.  Where a ledger is kept
    the rate comes from it, a row per landing and reason, instead of from all staged rows.
    """
    by = [INGEST_DATE] if per_batch else []
    tables, columns, relations = {}, [], []
    for b in built:
        d = b.domain
        tables.update(b.tables())
        columns += d.checks
        rates = rejection_rate(b.classified, by) if b.ledger is None else ledger_rate(b.ledger, by)
        relations.append((d.rate_check, d.staging, over_threshold(rates, threshold)))
        drift = recompute_diff(aggregate(b.silver, d.spec), b.gold, d.spec.keys, list(d.spec.measures))
        relations.append((d.recompute_check, d.gold, drift))
    return run_checks(tables, columns, relations)


def _materialized(verdicts: DataFrame) -> DataFrame:
    """The verdict rows as values: one per declared check, computed once."""
    return verdicts.sparkSession.createDataFrame(verdicts.collect(), verdicts.schema)


def _report(spark: SparkSession, done: list[tuple[str, str, int]]) -> DataFrame:
    rest = [(s, "not_started", 0) for s in STAGES[len(done):]]
    return spark.createDataFrame(done + rest, "stage string, status string, rows bigint")


def gated_run(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """stage, status, rows of a run that went through; GateFailed otherwise.

    rows: gold rows for build, exported and published rows for the last two
    stages, and the number of violations for the gates.
    """
    done: list[tuple[str, str, int]] = []

    def gate(stage: str, violations: DataFrame) -> None:
        n = violations.count()
        done.append((stage, "failed" if n else "success", n))
        if n:
            raise GateFailed(stage, violations, _report(spark, done))

    gate("preflight", check_bronze(spark, cfg.bronze_root, [d.source for d in cfg.chosen()]))

    built = side_by_side(lambda d: build(spark, d, cfg), cfg.chosen())
    gold = {b.domain.gold: b.gold for b in built}
    done.append(("build", "success", sum(df.count() for df in gold.values())))

    verdicts = _materialized(check(built, cfg.threshold, cfg.gate_per_batch))
    record_verdicts(verdicts, f"{cfg.warehouse_root}/{VERDICTS}")
    gate("check", unexpected_failures(verdicts, cfg.known_failures))

    exported = snapshot_all(spark, gold, f"{cfg.warehouse_root}/export")
    done.append(("export", "success", _sum_rows(exported)))

    create_layers(spark, cfg.warehouse_root, [cfg.database])
    docs = {b.domain.gold: (b.domain.comments[b.domain.gold], b.domain.gold_columns) for b in built}
    published = publish_all(spark, gold, cfg.database, f"{cfg.warehouse_root}/published", docs)
    done.append(("publish", "success", _sum_rows(published)))
    return _report(spark, done)


def run_report(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """The stage report either way, for callers who want it as data."""
    try:
        return gated_run(spark, cfg)
    except GateFailed as failure:
        return failure.report


def _sum_rows(audit: DataFrame) -> int:
    return audit.agg(F.sum("rows")).first()[0] or 0
