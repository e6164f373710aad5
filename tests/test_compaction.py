"""Compaction of a stream's log: same gold, few folders, and every point it can break off at."""

import json

import pytest
from pyspark.sql import functions as F

from layerwright.operators.grain import PART
from layerwright.plans.domains import REQUESTS
from layerwright.session import run_dir
from layerwright.sources import files
from layerwright.sources.bronze import write_bronze
from layerwright.streaming import compaction
from layerwright.streaming.available import StreamTables, ingest_available
from layerwright.streaming.compaction import BATCH, NOTE, compact_log, finish_compaction, folders
from tests.conftest import SMALL
from workload.standins import raw_requests, requests


def ordered(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def raw(spark):
    days = F.dayofmonth(F.coalesce("ingest_date", F.lit("2024-01-01").cast("date"))) <= 4
    return raw_requests(requests(spark, SMALL)).where(days)


def run(spark, raw, root, **options):
    tables = StreamTables(f"{root}/stream", **options)
    part = F.pmod(F.crc32(F.coalesce("unique_key", F.lit(""))), F.lit(4))
    for n in range(4):
        write_bronze(raw.where(part == n), f"{root}/bronze", REQUESTS.source)
        gold = ingest_available(spark, f"{root}/bronze", REQUESTS, tables)
    return tables, ordered(gold)


def test_same_gold_in_few_folders(spark, raw):
    plain, want = run(spark, raw, run_dir(spark, "plain"))
    assert want == ordered(REQUESTS.gold_of(REQUESTS.stage(spark.read.json(f"{plain.root}/../bronze/{REQUESTS.source}"))))
    tables, got = run(spark, raw, run_dir(spark, "folded"), index_buckets=2, max_folders=1)
    assert got == want
    assert max(map(len, folders(spark, plain.log).values())) > 2
    assert max(map(len, folders(spark, tables.log).values())) == 1
    assert files.read_text(spark, f"{tables.log}/{NOTE}") is None
    # Late corrections of compacted rows are still chosen or passed over rightly.
    late = raw.withColumn("agency", F.lit("late")).withColumn("ingest_date", F.lit("2030-01-01").cast("date"))
    for root, options in ((plain.root, {}), (tables.root, {"index_buckets": 2, "max_folders": 1})):
        write_bronze(late.where(F.col("unique_key").cast("bigint") % 3 == 0), f"{root}/../bronze", REQUESTS.source)
    a, b = (ordered(ingest_available(spark, f"{t.root}/../bronze", REQUESTS, t)) for t in (plain, tables))
    assert a == b


@pytest.mark.parametrize("after", ["note", "write", "written"])
def test_broken_off_compactions(spark, raw, monkeypatch, after):
    """The driver is lost after the note, after the new folders, and after the note that they are whole."""
    tables, want = run(spark, raw, run_dir(spark, "broken"))
    schema = spark.read.parquet(tables.log).schema
    rows = spark.read.schema(schema).parquet(tables.log)
    best = ordered(compaction.folded(rows, REQUESTS, files.partition_values(spark, tables.log, PART)))

    class Lost(Exception):
        pass

    calls = []
    real = files.write_text

    def write(session, path, text):
        calls.append(json.loads(text))
        if after == "write" and len(calls) == 2:
            raise Lost
        real(session, path, text)
        if after == "note" or after == "written" and len(calls) == 2:
            raise Lost

    monkeypatch.setattr(files, "write_text", write)
    with pytest.raises(Lost):
        compact_log(spark, REQUESTS, tables.log, schema, 1)
    monkeypatch.setattr(files, "write_text", real)
    before = folders(spark, tables.log)
    assert any(b < 0 for v in before.values() for b in v) == (after != "note")
    finish_compaction(spark, tables.log)
    left = folders(spark, tables.log)
    assert all((min(v) < 0) == (after == "written") for v in left.values() if len(before) and (len(v) > 1 or min(v) < 0))
    assert compact_log(spark, REQUESTS, tables.log, schema, 1) == (0 if after == "written" else sum(len(v) > 1 for v in left.values()))
    now = spark.read.schema(schema).parquet(tables.log)
    assert ordered(compaction.folded(now, REQUESTS, files.partition_values(spark, tables.log, PART))) == best
    assert ordered(ingest_available(spark, f"{tables.root}/../bronze", REQUESTS, tables)) == want
    assert now.where(F.col(BATCH) < 0).count() > 0
