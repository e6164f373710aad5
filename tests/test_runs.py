import datetime as dt
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from layerwright.operators.grain import aggregate
from layerwright.operators.incremental import read_gold
from layerwright.operators.synthesis import Nulled, Renamed, in_blocks, in_turn, inject_defects, late_record, sample_rows, template_row
from layerwright.plans.domains import COMMITS, DOMAINS, FILINGS, KNOWN_INTENTIONAL_FAILURES, REQUESTS
from layerwright.plans.gated import GateFailed, RunConfig, build, gated_run
from layerwright.session import run_dir
from layerwright.sources import files
from layerwright.sources.bronze import read_bronze, write_bronze
from layerwright.sources.snapshots import versions
from layerwright.streaming import available
from layerwright.streaming.available import StreamTables, apply_batch, ingest_available
from tests.conftest import SMALL
from workload.standins import RAW, STANDINS


def ordered(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ---- synthesis -----------------------------------------------------------------


def people(spark, n=200):
    return spark.range(n).selectExpr("cast(id AS string) AS id", "concat('p', id) AS name", "named_struct('a', named_struct('d', id)) AS deep")


def test_sample_is_repeatable_and_numbered(spark):
    a, b = (sample_rows(people(spark).repartition(p), 60, ["id"], 7).collect() for p in (1, 5))
    assert [r["id"] for r in a] == [r["id"] for r in b]
    assert sorted(r["position"] for r in a) == list(range(60))
    other = sample_rows(people(spark), 60, ["id"], 8).collect()
    assert {r["id"] for r in other} != {r["id"] for r in a}
    assert sample_rows(people(spark, 5), 60, ["id"]).count() == 5


def test_defects_in_blocks(spark):
    numbered = sample_rows(people(spark), 60, ["id"])
    messy = inject_defects(numbered, [Nulled("name"), Renamed("id", "other_id")], in_blocks(15, 2)).collect()
    by = {k: [r for r in messy if r["defect"] == k] for k in (0, 1, 2)}
    assert [len(by[k]) for k in (0, 1, 2)] == [15, 15, 30]
    assert all(r["name"] is None and r["id"] for r in by[0])
    assert all(r["id"] is None and r["other_id"] for r in by[1])
    assert all(r["id"] and r["name"] and r["other_id"] is None for r in by[2])


def test_nested_defects_by_turns(spark):
    messy = inject_defects(sample_rows(people(spark), 6, ["id"]), [Nulled("deep.a.d"), Nulled("deep.a.d")], in_turn(2)).collect()
    assert [r["deep"]["a"]["d"] is None for r in sorted(messy, key=lambda r: r["position"])] == [True, True, False] * 2


def test_late_record(spark):
    assert template_row(people(spark).repartition(4), ["name"]).first()["id"] == "0"
    late = late_record(people(spark), ["name"], {"id": F.lit("99")}, F.lit("2026-08-01").cast("date")).first()
    assert (late["id"], late["name"], late["ingest_date"]) == ("99", "p0", dt.date(2026, 8, 1))


# ---- streams -------------------------------------------------------------------


def request(key, created, agency="A", status="Open", landed="2024-01-01"):
    return (key, created, agency, status, dt.date.fromisoformat(landed))


RAW_REQUEST = "unique_key string, created_date string, agency string, status string, ingest_date date"


def test_stream_corrects_moves_and_quarantines(spark):
    root = run_dir(spark, "stream")
    tables = StreamTables(f"{root}/tables")

    def land(*data):
        write_bronze(spark.createDataFrame(list(data), RAW_REQUEST), f"{root}/bronze", "nyc_311")
        # Read at once: the next run replaces these files.
        gold = ingest_available(spark, f"{root}/bronze", REQUESTS, tables)
        return ordered(gold.select(F.col("request_date").cast("date").cast("string"), "agency", "request_count"))

    first = land(request("1", "2024-01-01T10:00:00"), request("2", "2024-01-01T11:00:00"), request(None, "2024-01-01T11:00:00"))
    assert first == [("2024-01-01", "A", 2)]
    # A correction moves request 1 to a later day; a long-late request appears.
    second = land(request("1", "2024-01-03T10:00:00", "B"), request("3", "2023-12-01T10:00:00"), request("4", "junk"))
    assert second == [("2023-12-01", "A", 1), ("2024-01-01", "A", 1), ("2024-01-03", "B", 1)]
    # An older copy of request 1 arrives last and must not win its day back.
    third = land(request("1", "2024-01-01T09:00:00"))
    assert third == second
    # The last row of a day moves away: the day's partition goes.
    fourth = land(request("2", "2024-01-05T09:00:00"))
    assert fourth == [("2023-12-01", "A", 1), ("2024-01-03", "B", 1), ("2024-01-05", "A", 1)]
    bad = spark.read.parquet(tables.quarantine)
    assert ordered(bad.select("rejection_reason")) == [("missing_created_at",), ("missing_request_id",)]
    whole = REQUESTS.silver_of(REQUESTS.stage(read_bronze(spark, f"{root}/bronze", "nyc_311")))
    assert ordered(aggregate(whole, REQUESTS.spec)) == ordered(read_gold(spark, tables.gold, REQUESTS.spec))


def test_replayed_batch_changes_nothing(spark):
    root = run_dir(spark, "replay")
    tables = StreamTables(f"{root}/tables")
    for source, domain in (("nyc_311", REQUESTS),):
        write_bronze(RAW[source](STANDINS[source](spark, SMALL)), f"{root}/bronze", source)
        gold = ordered(ingest_available(spark, f"{root}/bronze", domain, tables))
        bad = spark.read.parquet(tables.quarantine).count()
        apply_batch(read_bronze(spark, f"{root}/bronze", source), 0, domain, tables)
        assert spark.read.parquet(tables.quarantine).count() == bad
        again = ingest_available(spark, f"{root}/bronze", domain, tables)
        assert ordered(again) == gold


def test_batches_that_touch_every_date_need_no_search_for_competitors(spark, monkeypatch):
    root, tables = (r := run_dir(spark, "touched")), StreamTables(f"{r}/tables")
    rows = STANDINS["sec_edgar_10k"](spark, SMALL)
    raw, part = RAW["sec_edgar_10k"](rows), F.pmod(F.crc32("_id"), F.lit(3))
    searched, search = [], available._competitors
    monkeypatch.setattr(available, "_competitors", lambda *a: searched.append(1) or search(*a))
    for n in (0, 1):
        write_bronze(raw.where(part == n), f"{root}/bronze", "sec_edgar_10k", rebalance=False)
        ingest_available(spark, f"{root}/bronze", FILINGS, tables)
    assert not searched
    one = raw.where(part == 2).orderBy("_id").limit(1)
    write_bronze(one, f"{root}/bronze", "sec_edgar_10k")
    gold = ingest_available(spark, f"{root}/bronze", FILINGS, tables)
    assert searched  # a record of one month leaves the others alone
    assert ordered(gold) == ordered(FILINGS.gold_of(FILINGS.stage(read_bronze(spark, f"{root}/bronze", "sec_edgar_10k"))))


def test_stream_in_small_batches_equals_one_batch(spark):
    root = run_dir(spark, "small")
    raw = RAW["sec_edgar_10k"](STANDINS["sec_edgar_10k"](spark, SMALL))
    write_bronze(raw, f"{root}/bronze", "sec_edgar_10k")
    gold = ingest_available(spark, f"{root}/bronze", FILINGS, StreamTables(f"{root}/tables"), max_files=3)
    assert ordered(gold) == ordered(FILINGS.gold_of(STANDINS["sec_edgar_10k"](spark, SMALL)))


# ---- gated runs ----------------------------------------------------------------


@pytest.fixture
def landed(spark):
    root = run_dir(spark, "gated")
    for source in DOMAINS:
        write_bronze(RAW[source](STANDINS[source](spark, SMALL)), f"{root}/bronze", source)
    return root


def test_failing_gate_stops_export_and_publication(spark, landed):
    cfg = RunConfig(f"{landed}/bronze", f"{landed}/warehouse", database="gate_test", threshold=0.03)
    with pytest.raises(GateFailed) as failure:
        gated_run(spark, cfg)
    names = {r["check_name"] for r in failure.value.violations.collect()}
    assert failure.value.stage == "check" and names == set(KNOWN_INTENTIONAL_FAILURES)
    assert [r["status"] for r in failure.value.report.collect()] == ["success", "success", "failed", "not_started", "not_started"]
    assert versions(spark, f"{landed}/warehouse/export/{REQUESTS.gold}") == []
    assert not spark.catalog.databaseExists("gate_test")

    # The same warehouse, the known failures allowed: goes through, twice, with a new version each time.
    allowed = RunConfig(f"{landed}/bronze", f"{landed}/warehouse", database="gate_test", threshold=0.03, known_failures=KNOWN_INTENTIONAL_FAILURES)
    report = ordered(gated_run(spark, allowed))
    assert {status for _, status, _ in report} == {"success"}
    assert ordered(gated_run(spark, allowed)) == report
    assert versions(spark, f"{landed}/warehouse/export/{COMMITS.gold}") == [0, 1]
    for d in DOMAINS.values():
        assert ordered(spark.table(f"gate_test.{d.gold}")) == ordered(d.gold_of(STANDINS[d.source](spark, SMALL)))


def test_missing_source_fails_preflight(spark):
    root = run_dir(spark, "gated")
    write_bronze(RAW["nyc_311"](STANDINS["nyc_311"](spark, SMALL)), f"{root}/bronze", "nyc_311")
    with pytest.raises(GateFailed) as failure:
        gated_run(spark, RunConfig(f"{root}/bronze", f"{root}/warehouse"))
    assert failure.value.stage == "preflight"
    assert [r["source"] for r in failure.value.violations.collect()] == ["github_commits", "sec_edgar_10k"]


def test_there_are_27_declared_checks():
    columns = sum(len(c.not_null) + len(c.unique) for d in DOMAINS.values() for c in d.checks)
    assert columns + 2 * len(DOMAINS) == 27


def test_gate_per_batch_sees_what_history_dilutes(spark):
    root = run_dir(spark, "gated")
    good = [(str(i), f"2024-01-{i % 28 + 1:02d}T10:00:00", "A", "Open", dt.date(2024, 2, 1)) for i in range(200)]
    bad = [(str(900 + i), None if i == 0 else "2024-01-09T10:00:00", "A", "Open", dt.date(2024, 2, 2)) for i in range(3)]
    write_bronze(spark.createDataFrame(good + bad, RAW_REQUEST), f"{root}/bronze", "nyc_311")
    only = {"nyc_311": REQUESTS}
    cfg = RunConfig(f"{root}/bronze", f"{root}/warehouse", database="batch_test", domains=only, gate_per_batch=True)
    with pytest.raises(GateFailed) as failure:
        gated_run(spark, cfg)
    assert [(r["check_name"], r["failures"]) for r in failure.value.violations.collect()] == [(REQUESTS.rate_check, 1)]
    whole = RunConfig(f"{root}/bronze", f"{root}/warehouse", database="batch_test", domains=only)
    assert ordered(gated_run(spark, whole).where("stage = 'build'"))[0][1] == "success"


def test_run_with_a_cap(spark):
    root = run_dir(spark, "gated")
    rows = [request("1", "2024-01-01T10:00:00"), request("2", "2990-01-01T10:00:00")]
    write_bronze(spark.createDataFrame(rows, RAW_REQUEST), f"{root}/bronze", "nyc_311")
    cfg = RunConfig(f"{root}/bronze", f"{root}/warehouse", database="cap_test", domains={"nyc_311": REQUESTS}, cap=dt.date(2024, 1, 2))
    gated_run(spark, cfg)
    write_bronze(spark.createDataFrame([request("3", "2024-01-02T10:00:00")], RAW_REQUEST), f"{root}/bronze", "nyc_311")
    gated_run(spark, cfg)
    assert spark.table(f"cap_test.{REQUESTS.gold}").count() == 3


def test_only_changed_landings_are_parsed_again(spark):
    root = run_dir(spark, "landings")
    cfg = RunConfig(f"{root}/bronze", f"{root}/warehouse", domains={"nyc_311": REQUESTS})
    staging = cfg.path("staging", REQUESTS.staging)

    def land(*data):
        write_bronze(spark.createDataFrame(list(data), RAW_REQUEST), cfg.bronze_root, "nyc_311")

    def built(**changes):
        result = build(spark, REQUESTS, replace(cfg, **changes))
        folders = files.partition_values(spark, staging, "ingest_date")
        return {d: files.names(spark, f"{staging}/ingest_date={d}") for d in folders}, result

    land(request("1", "2024-01-01T10:00:00"), request("2", "2024-01-02T10:00:00", landed="2024-01-02"))
    first, _ = built()
    again, _ = built()
    assert again == first and sorted(first) == ["2024-01-01", "2024-01-02"]
    # A new date is added; a file is added to an old one.
    land(request("3", "2024-01-03T10:00:00", landed="2024-01-03"), request(None, "2024-01-02T10:00:00", landed="2024-01-02"))
    grown, result = built()
    assert grown["2024-01-01"] == first["2024-01-01"] and grown["2024-01-02"] != first["2024-01-02"]
    assert (result.classified.count(), result.rejected.count(), result.silver.count()) == (4, 1, 3)
    # A withdrawn landing goes; a full refresh stages everything anew.
    files.delete(spark, f"{cfg.bronze_root}/nyc_311/ingest_date=2024-01-03")
    shrunk, result = built()
    assert "2024-01-03" not in shrunk and shrunk["2024-01-02"] == grown["2024-01-02"] and result.silver.count() == 2
    anew, _ = built(full_refresh=True)
    assert not set(anew["2024-01-01"]) & set(first["2024-01-01"])
    # Other rules, other rows.
    stricter = replace(REQUESTS, not_null=("request_id", "agency", "created_at", "status"))
    result = build(spark, stricter, cfg)
    assert not set(files.names(spark, f"{staging}/ingest_date=2024-01-01")) & set(anew["2024-01-01"])


def test_same_length_rewrite_of_a_landing_is_seen(spark):
    """One file, overwritten under its own name by as many bytes."""
    root = run_dir(spark, "rewrite")
    cfg = RunConfig(f"{root}/bronze", f"{root}/warehouse")
    path = f"{cfg.bronze_root}/nyc_311/ingest_date=2024-01-01/part.jsonl"
    line = '{"unique_key": "1", "created_date": "2024-01-01T10:00:00", "agency": "AAA"}\n'
    files.write_text(spark, path, line)
    assert [r["agency"] for r in build(spark, REQUESTS, cfg).gold.collect()] == ["AAA"]
    files.write_text(spark, f"{path}.tmp", line.replace("AAA", "CCC").replace('"1"', '"2"'))
    assert [r["agency"] for r in build(spark, REQUESTS, cfg).gold.collect()] == ["AAA"]
    time.sleep(0.01)
    files.write_text(spark, path, line.replace("AAA", "BBB"))
    assert [r["agency"] for r in build(spark, REQUESTS, cfg).gold.collect()] == ["BBB"]
