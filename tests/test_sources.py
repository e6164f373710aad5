import datetime as dt
import os

import pytest

from layerwright.plans.domains import COMMITS, FILINGS, REQUESTS
from layerwright.session import run_dir, shared_root
from layerwright.sources import files
from layerwright.sources.bronze import check_bronze, read_bronze, union_by_name, with_ingest_date, write_bronze
from layerwright.sources.catalog import as_view, create_layers, described_columns, publish, publish_all, write_layer
from layerwright.sources.snapshots import (
    published_versions,
    read_published,
    snapshot_all,
    snapshot_read,
    snapshot_write,
    total_rows,
    versions,
)


def land_text(root, source, date, lines, name="part.jsonl"):
    folder = os.path.join(root, source, f"ingest_date={date}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("".join(line + "\n" for line in lines))


# ---- bronze --------------------------------------------------------------------


def test_files_with_different_fields_merge_by_name(spark, tmp_path, rows):
    root = str(tmp_path)
    land_text(root, "nyc_311", "2026-07-28", ['{"unique_key": "1", "agency": "NYPD", "created_date": "2026-07-26T23:50:00.000"}'])
    land_text(root, "nyc_311", "2026-07-29", ['{"unique_id": "2", "agency": "DOT", "latitude": "40.5"}'])
    staged = REQUESTS.stage(read_bronze(spark, root, "nyc_311"))
    assert rows(staged.select("request_id", "created_at", "agency", "latitude")) == [
        (1, dt.datetime(2026, 7, 26, 23, 50), "NYPD", None),
        (None, None, "DOT", 40.5),
    ]


def test_null_absent_and_malformed_all_reach_quarantine(spark, tmp_path, rows):
    root = str(tmp_path)
    author = '"author": {"name": "n", "email": "e"%s}'
    land_text(root, "github_commits", "2026-07-29", [
        '{"sha": "a", "commit": {"message": "m\\nbody", %s}, "author": null}' % (author % ', "date": null'),
        '{"sha": "b", "commit": {"message": "m", %s}}' % (author % ""),
        '{"sha": "c", "commit": {"message": "m\\nbody", %s}, "author": {"login": "l"}}' % (author % ', "date": "2026-07-27T17:11:28Z"'),
        '{"sha": "broken',
    ])
    staged = COMMITS.stage(read_bronze(spark, root, "github_commits"))
    assert rows(COMMITS.rejected_of(staged)) == rows(
        spark.createDataFrame(
            [("a", "n", "e", "missing_authored_at"), ("b", "n", "e", "missing_authored_at"), (None, None, None, "missing_commit_sha")],
            "s string, n string, e string, r string",
        )
    )
    good = COMMITS.silver_of(staged).first()
    assert (good["message_headline"], good["github_login"], good["authored_date"]) == ("m", "l", dt.datetime(2026, 7, 27))


def test_filings_with_empty_arrays(spark, tmp_path):
    root = str(tmp_path)
    body = '"adsh": "0001", "form": "10-K", "file_date": "2026-07-01", "sequence": %s, "ciks": ["77"], "biz_states": [], "display_names": %s'
    land_text(root, "sec_edgar_10k", "2026-07-28", [
        '{"_id": "0001:exhibit", "_source": {%s}}' % (body % ("10", "null")),
        '{"_id": "0001:main", "_source": {%s}}' % (body % ('"9"', '["Main"]')),
    ])
    row = FILINGS.silver_of(FILINGS.stage(read_bronze(spark, root, "sec_edgar_10k"))).collect()
    assert [(r["display_name"], r["cik"], r["biz_state"], r["file_date"]) for r in row] == [("Main", "77", None, dt.date(2026, 7, 1))]


def test_ingest_date_prunes(spark, tmp_path):
    root = str(tmp_path)
    for day in ("2026-07-28", "2026-07-29"):
        land_text(root, "nyc_311", day, ['{"unique_key": "1"}'])
    df = read_bronze(spark, root, "nyc_311").where("ingest_date = date'2026-07-29'").select("unique_key")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan and "ReadSchema: struct<unique_key:string>" in plan
    assert df.count() == 1


def test_write_keeps_or_drops_nulls(spark, tmp_path):
    df = with_ingest_date(spark.createDataFrame([("1", None)], "unique_key string, agency string"), "2026-07-29")
    for keep in (True, False):
        root = str(tmp_path / str(keep))
        write_bronze(df, root, "nyc_311", keep_nulls=keep)
        text = spark.read.text(f"{root}/nyc_311").first()["value"]
        assert ('"agency":null' in text) is keep
        assert read_bronze(spark, root, "nyc_311").first()["ingest_date"] == dt.date(2026, 7, 29)


def test_landings_and_layers_are_compressed(spark, tmp_path):
    df = spark.range(4000).selectExpr("cast(id AS string) AS unique_key", "'Department of Long Names' AS agency_name", "date_add(DATE'2026-01-01', cast(id % 3 AS int)) AS ingest_date").repartition(2)
    for rebalance in (True, False):
        root = f"{tmp_path}/{rebalance}"
        write_bronze(df, root, "nyc_311", rebalance=rebalance)
        landed = list(files.list_files(spark, f"{root}/nyc_311/*/part-*"))
        assert all(path.endswith(".json.gz") for path, _ in landed) and len(landed) <= 6
        assert sum(size for _, size in landed) < 4000 * 20  # 67 bytes a record as plain text
        back = read_bronze(spark, root, "nyc_311").select(*df.columns)
        assert back.exceptAll(df).count() == 0 and back.count() == 4000
    stored = write_layer(df, f"{tmp_path}/layer", partition_by="ingest_date")
    assert stored.count() == 4000 and all(f.endswith(".zstd.parquet") for f in stored.inputFiles())


def test_preflight(spark, tmp_path, rows):
    root = str(tmp_path)
    land_text(root, "nyc_311", "2026-07-28", ['{"unique_key": "1"}'])
    land_text(root, "nyc_311", "2026-07-29", [], "empty.jsonl")
    found = check_bronze(spark, root, ["nyc_311", "github_commits"]).collect()
    assert [(r["source"], r["length"], r["problem"]) for r in found] == [("nyc_311", 0, "empty_file"), ("github_commits", None, "no_files")]
    assert found[0]["path"].endswith("ingest_date=2026-07-29/empty.jsonl")
    assert check_bronze(spark, root, ["nyc_311"], ingest_date="2026-07-28").isEmpty()


def test_union_by_name(spark, rows):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2.0)], "b string, c double")
    assert rows(union_by_name([a, b])) == rows(spark.createDataFrame([(1, "x", None), (None, "y", 2.0)], "a int, b string, c double"))


def test_shared_root_is_the_sessions_own(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert run_dir(spark, "x") != run_dir(spark, "x")


# ---- snapshots -----------------------------------------------------------------


def numbers(spark, n):
    return spark.range(n).selectExpr("id", "cast(id AS string) AS s")


def test_versions_accumulate_and_time_travel(spark, rows):
    path = run_dir(spark, "snap")
    assert rows(snapshot_write(numbers(spark, 3), path, "t")) == [("t", 0, 3)]
    assert rows(snapshot_write(numbers(spark, 5), path, "t")) == [("t", 1, 5)]
    assert versions(spark, path) == [0, 1]
    assert snapshot_read(spark, path).count() == 5
    assert snapshot_read(spark, path, 0).count() == 3


def test_half_written_version_is_invisible_and_not_reused(spark, rows):
    path = run_dir(spark, "snap")
    snapshot_write(numbers(spark, 3), path, "t")
    numbers(spark, 9).write.parquet(f"{path}/version=1")
    files.delete(spark, f"{path}/version=1/_SUCCESS")
    assert snapshot_read(spark, path).count() == 3
    assert rows(snapshot_write(numbers(spark, 4), path, "t")) == [("t", 2, 4)]
    with pytest.raises(FileNotFoundError):
        snapshot_read(spark, path, 1)


def test_empty_table_is_a_version_too(spark, rows):
    path = run_dir(spark, "snap")
    assert rows(snapshot_write(numbers(spark, 3).where("id > 9"), path, "t")) == [("t", 0, 0)]
    assert snapshot_read(spark, path).columns == ["id", "s"]
    with pytest.raises(FileNotFoundError):
        snapshot_read(spark, run_dir(spark, "nothing"))


def test_group_is_published_by_its_manifest(spark, rows):
    root = run_dir(spark, "group")
    audit = snapshot_all(spark, {"a": numbers(spark, 2), "b": numbers(spark, 3)}, root)
    assert rows(total_rows(audit)) == [(2, 5)]
    # A later run that dies between its tables changes nothing for readers.
    snapshot_write(numbers(spark, 50), f"{root}/a", "a")
    assert rows(published_versions(spark, root)) == [("a", 0, 2), ("b", 0, 3)]
    assert read_published(spark, root, "a").count() == 2


# ---- catalog -------------------------------------------------------------------


def test_publish_creates_replaces_and_documents(spark, rows):
    root = run_dir(spark, "cat")
    create_layers(spark, root, ["gold_test"])
    name = "gold_test.numbers"
    assert rows(publish(numbers(spark, 3), name, f"{root}/n", "it's numbers", {"s": "as 'text'"})) == [(name, 3)]
    assert rows(publish(numbers(spark, 5), name, f"{root}/n", "more numbers", {"id": "a \\ number"})) == [(name, 5)]
    assert spark.table(name).count() == 5
    comments = {r["col_name"]: r["comment"] for r in described_columns(spark, name).collect()}
    assert comments == {"id": "a \\ number", "s": "as 'text'"}
    detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert detail["Comment"] == "more numbers"


def test_publish_with_another_shape(spark):
    root = run_dir(spark, "cat")
    create_layers(spark, root, ["gold_test"])
    publish(numbers(spark, 3), "gold_test.shape", f"{root}/n")
    publish(numbers(spark, 2).selectExpr("id AS other"), "gold_test.shape", f"{root}/n")
    assert spark.table("gold_test.shape").columns == ["other"]
    publish(numbers(spark, 2).where("id > 9").selectExpr("id AS other"), "gold_test.shape", f"{root}/n")
    assert spark.table("gold_test.shape").count() == 0


def test_publish_all_and_views(spark, rows):
    root = run_dir(spark, "cat")
    create_layers(spark, root, ["gold_test"])
    audit = publish_all(spark, {"p": numbers(spark, 1), "q": numbers(spark, 2)}, "gold_test", root, {"q": ("two", {"id": "key"})})
    assert rows(audit) == [("gold_test.p", 1), ("gold_test.q", 2)]
    as_view(numbers(spark, 4), "staged_numbers")
    assert spark.sql("SELECT count(*) FROM staged_numbers").first()[0] == 4


def test_layer_rebuild_keeps_the_old_build_readable(spark):
    path = run_dir(spark, "layer")
    old = write_layer(numbers(spark, 3), path)
    new = write_layer(numbers(spark, 4), path)
    assert (old.count(), new.count()) == (3, 4)


def test_hot_partition_is_written_whole(spark):
    df = spark.range(3000, numPartitions=4).selectExpr("if(id % 3 = 0, 0, id % 50) AS p", "id")
    stored = write_layer(df, run_dir(spark, "hot"), partition_by="p")
    assert stored.count() == 3000
    assert stored.where("p = 0").count() == df.where("p = 0").count()
