"""The command line over a bronze folder of its own, from landing to publication."""

import pytest

from layerwright.__main__ import arguments, execute
from layerwright.plans.domains import KNOWN_INTENTIONAL_FAILURES, REQUESTS
from layerwright.operators.incremental import read_gold
from layerwright.session import run_dir
from layerwright.sources import files
from layerwright.sources.bronze import read_bronze, write_bronze
from layerwright.sources.catalog import read_layer
from tests.conftest import SMALL
from workload.standins import RAW, STANDINS


@pytest.fixture
def run(spark):
    root = run_dir(spark, "cli")
    for source in RAW:
        domain_rows = STANDINS[source](spark, SMALL)
        write_bronze(RAW[source](domain_rows), f"{root}/bronze", source)

    def call(command, *more):
        args = [command, "--bronze", f"{root}/bronze", "--warehouse", f"{root}/warehouse", "--database", "cli_test", *more]
        return execute(spark, arguments(args))

    call.root = root
    return call


def test_build_check_and_run(spark, run):
    allow = [word for name in KNOWN_INTENTIONAL_FAILURES for word in ("--allow", name)]
    assert run("preflight") == 0
    assert run("build") == 0
    assert run("sql", "--query", "SELECT rejection_reason, count(*) FROM silver.rejected_311_requests GROUP BY 1") == 0
    assert spark.table("gold.gold_311_daily_agency_summary").dtypes[0] == ("request_date", "timestamp_ntz")
    assert spark.table("staging.stg_nyc_311").columns == list(REQUESTS.mapping())
    assert run("check", "--threshold", "0.03") == 1
    assert run("check", "--threshold", "0.03", *allow) == 0
    assert run("run", "--threshold", "0.03") == 1
    assert not spark.catalog.databaseExists("cli_test")
    assert run("run", "--threshold", "0.03", *allow) == 0
    assert spark.table(f"cli_test.{REQUESTS.gold}").count() > 0


def test_messy_and_late_batches(spark, run):
    only = ("--source", "nyc_311")
    assert run("build", *only) == 0
    quarantine = f"{run.root}/warehouse/silver/{REQUESTS.quarantine}"
    before = read_layer(spark, quarantine).count()
    assert run("messy", "--ingest-date", "2024-02-01") == 0
    assert run("late", "--ingest-date", "2024-02-02") == 0
    landed = read_bronze(spark, f"{run.root}/bronze", "nyc_311").where("ingest_date = date'2024-02-02'").collect()
    assert [(r["unique_key"], r["agency"]) for r in landed] == [("99999001", "NYPD")]
    assert run("build", "--full-refresh", *only) == 0
    reasons = read_layer(spark, quarantine).groupBy("rejection_reason").count().collect()
    # The sample may pick rows that were already defective; each of the 45 defects adds a rejection.
    assert read_layer(spark, quarantine).count() >= before + 45
    assert {r["rejection_reason"] for r in reasons} == {"missing_agency", "missing_created_at", "missing_request_id"}
    gold = read_gold(spark, f"{run.root}/warehouse/gold/{REQUESTS.gold}", REQUESTS.spec)
    assert gold.where("agency = 'NYPD'").count() == 1


def test_answers_are_not_cut(spark, run, capsys):
    assert run("build", "--source", "nyc_311") == 0
    folder = f"{run.root}/answer"
    query = "SELECT explode(sequence(1, 250)) AS n, CAST(NULL AS STRING) AS nothing"
    assert run("sql", "--source", "nyc_311", "--query", query, "--out", folder, "--limit", "5") == 0
    assert "250 rows" in capsys.readouterr().out
    assert spark.read.schema("n int, nothing string").json(folder).distinct().count() == 250


def test_violations_are_counted_in_full(spark, run, capsys):
    for day in range(1, 121):
        files.create_empty(spark, f"{run.root}/bronze/nyc_311/ingest_date=2023-{1 + day // 28:02d}-{1 + day % 28:02d}/empty.jsonl")
    folder = f"{run.root}/violations"
    assert run("preflight", "--out", folder) == 1
    assert "120 rows" in capsys.readouterr().out
    assert spark.read.json(folder).select("path").distinct().count() == 120
