"""Silver by changed keys: equal to the rebuild after every kind of change, and only the days concerned are written."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from layerwright.operators.grain import PART
from layerwright.operators.ledger import ledger_rate
from layerwright.operators.quality import rejection_rate
from layerwright.plans.changed_keys import HASH, INTENT, KeyedPaths, KeyIndex, touched_entries
from layerwright.plans.domains import DOMAINS, REQUESTS
from layerwright.plans.gated import RunConfig, build, gated_run, load, register_layers
from layerwright.session import run_dir
from layerwright.sources import files
from layerwright.sources.bronze import INGEST_DATE, write_bronze
from tests.conftest import SMALL
from workload.standins import RAW, STANDINS


def ordered(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def config(spark, domain, label, **options):
    root = run_dir(spark, label)
    return RunConfig(f"{root}/bronze", f"{root}/warehouse", domains={domain.source: domain}, index_buckets=2, **options)


def files_by_day(spark, path):
    return {d: sorted(files.names(spark, f"{path}/{PART}={d}")) for d in files.partition_values(spark, path, PART)}


def layers(built):
    rates = rejection_rate(built.classified, [INGEST_DATE])
    assert built.ledger is None or ordered(ledger_rate(built.ledger, [INGEST_DATE])) == ordered(rates)
    return [*(ordered(x) for x in (built.silver, built.rejected, built.gold)), ordered(rates)]


def land_few_dates(spark, domain, cfg, dates=("2024-01-01", "2024-01-02", None)):
    """The stand-in's rows over a few landings, one of them without a date."""
    raw = RAW[domain.source](STANDINS[domain.source](spark, SMALL)).drop(INGEST_DATE)
    part = F.pmod(F.xxhash64(*[c for c in raw.columns if raw.schema[c].dataType.simpleString() == "string"] or ["commit"]), F.lit(len(dates)))
    landing = F.element_at(F.array(*[F.lit(d).cast("date") for d in dates]), (part + 1).cast("int"))
    rows = raw.withColumn(INGEST_DATE, landing)
    write_bronze(rows, cfg.bronze_root, domain.source)
    return rows


@pytest.mark.parametrize("source", list(DOMAINS))
def test_equals_the_rebuild_after_each_change(spark, source):
    domain = DOMAINS[source]
    cfg = config(spark, domain, "keyed", by_key=True)

    def same():
        keyed = layers(build(spark, domain, cfg))
        other = replace(cfg, warehouse_root=run_dir(spark, "rebuilt"), by_key=False)
        assert keyed == layers(build(spark, domain, replace(other, full_refresh=True)))

    rows = land_few_dates(spark, domain, cfg)
    same()
    # A landing is withdrawn, another is written again with half its rows, the undated one gets a copy of other rows.
    folder = f"{cfg.bronze_root}/{source}"
    again = run_dir(spark, "kept")
    half = F.pmod(F.hash(F.to_json(F.struct(*rows.columns))), F.lit(2)) == 0
    rows.where((F.col(INGEST_DATE) == "2024-01-02") & half).drop(INGEST_DATE).write.json(again)
    files.delete(spark, f"{folder}/{INGEST_DATE}=2024-01-01")
    files.delete(spark, f"{folder}/{INGEST_DATE}=2024-01-02")
    write_bronze(spark.read.schema(rows.drop(INGEST_DATE).schema).json(again).withColumn(INGEST_DATE, F.lit("2024-01-02").cast("date")), cfg.bronze_root, source)
    same()
    write_bronze(rows.where(F.col(INGEST_DATE) == "2024-01-01").withColumn(INGEST_DATE, F.lit(None).cast("date")), cfg.bronze_root, source)
    same()


def test_only_days_concerned_are_written(spark):
    cfg = config(spark, REQUESTS, "few-days", by_key=True)
    land_few_dates(spark, REQUESTS, cfg)
    before = build(spark, REQUESTS, cfg)
    paths = KeyedPaths.of(cfg, REQUESTS)
    silver, gold = files_by_day(spark, paths.silver), files_by_day(spark, paths.gold)
    one = before.silver.where("request_id is not null").orderBy("request_id").first()
    new = spark.createDataFrame(
        [(str(one["request_id"]), "2031-05-05T01:02:03", "moved"), ("999999999", one["created_at"].isoformat(), "new")], "unique_key string, created_date string, agency string")
    write_bronze(new.withColumn(INGEST_DATE, F.lit("2024-02-01").cast("date")), cfg.bronze_root, REQUESTS.source)
    after = build(spark, REQUESTS, cfg)
    changed = {str(one["created_at"].date()), "2031-05-05"}
    for was, path in ((silver, paths.silver), (gold, paths.gold)):
        now = files_by_day(spark, path)
        assert {d for d in now if now[d] != was.get(d)} <= changed and "2031-05-05" in now
    moved = after.silver.where(F.col("request_id") == one["request_id"]).collect()
    assert [(r["agency"], str(r["created_at"])) for r in moved] == [("moved", "2031-05-05 01:02:03")]
    # Nothing landed: nothing is written.
    was = files_by_day(spark, paths.silver)
    build(spark, REQUESTS, cfg)
    assert files_by_day(spark, paths.silver) == was


def test_index_is_joined_where_its_buckets_lie(spark):
    cfg = config(spark, REQUESTS, "plan", by_key=True)
    land_few_dates(spark, REQUESTS, cfg)
    build(spark, REQUESTS, cfg)
    index = KeyIndex(spark, KeyedPaths.of(cfg, REQUESTS).index, REQUESTS.silver, 2)
    touched = spark.range(1000).select(F.xxhash64("id").alias(HASH))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = touched_entries(index.read(), touched, 2)
        assert joined.count() > 0
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # The first child of the join is the index: read by bucket, sorted, and not moved.
    side = plan[plan.index("SortMergeJoin") : plan.index("FileScan parquet")]
    assert "Exchange" not in side and "Range" not in side


def test_a_run_that_broke_off_is_made_good(spark):
    cfg = config(spark, REQUESTS, "broken", by_key=True)
    land_few_dates(spark, REQUESTS, cfg)
    want = layers(build(spark, REQUESTS, cfg))
    paths = KeyedPaths.of(cfg, REQUESTS)
    files.write_text(spark, f"{paths.index}{INTENT}", "")
    some = files.partition_values(spark, paths.silver, PART)[0]
    files.delete(spark, f"{paths.silver}/{PART}={some}")
    assert layers(build(spark, REQUESTS, cfg)) == want
    assert files.read_text(spark, f"{paths.index}{INTENT}") is None


def test_index_of_another_session_is_found_again(spark):
    cfg = config(spark, REQUESTS, "session", by_key=True)
    land_few_dates(spark, REQUESTS, cfg)
    build(spark, REQUESTS, cfg)
    index = KeyIndex(spark, KeyedPaths.of(cfg, REQUESTS).index, REQUESTS.silver, 2)
    n = index.read().count()
    spark.sql(f"DROP TABLE {index.table}")
    assert index.read().count() == n > 0


def test_gated_run_and_views(spark):
    cfg = config(spark, REQUESTS, "gated", by_key=True, threshold=0.5, database="keyed_published")
    land_few_dates(spark, REQUESTS, cfg)
    report = {r["stage"]: r["status"] for r in gated_run(spark, cfg).collect()}
    assert set(report.values()) == {"success"}
    stored = load(spark, REQUESTS, cfg)
    register_layers(spark, cfg)
    assert spark.table(f"silver.{REQUESTS.silver}").count() == stored.silver.count() > 0
    assert spark.table(f"silver.{REQUESTS.quarantine}").count() == stored.rejected.count() > 0
