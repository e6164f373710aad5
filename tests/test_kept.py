"""Digests, verified exports, switched partitions, verdict history, ledger, sketches, census."""

import json

import pytest
from pyspark.sql import functions as F

from layerwright.operators.diff import recompute_diff
from layerwright.operators.digests import differing, digest, recompute_diff_digest, relation_diff
from layerwright.operators.grain import PART, GrainSpec, aggregate
from layerwright.operators.history import RUN, check_history, failing_since, islands, record_verdicts
from layerwright.operators.ledger import count_landings, ledger_rate, ledger_summary, read_ledger, update_ledger
from layerwright.operators.quality import REASON, classify, rejection_rate, required
from layerwright.operators.sketches import daily_sketches, rolled_up
from layerwright.session import run_dir
from layerwright.sources import files
from layerwright.sources.bronze import CORRUPT, INGEST_DATE
from layerwright.sources.census import field_census, leaves, path_sets, schema_drift
from layerwright.sources.snapshots import version_path
from layerwright.sources.switching import (
    BATCH,
    MAP,
    NOTE,
    create_switched,
    current_partitions,
    finish_switch,
    read_switched,
    stage_batch,
    switch_partitions,
)
from layerwright.sources.verified import stored_digests, verified_write, verify_snapshot

SPEC = GrainSpec("day", "at", "day", {"who": "who"}, {"n": "count(*)", "mean": "avg(x)"})


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def events(spark, n=600):
    rows = spark.range(n).selectExpr(
        "CASE WHEN id % 50 = 7 THEN NULL ELSE timestamp_ntz'2026-01-01 00:00:00' + (id % 9) * INTERVAL '1' DAY END AS at",
        "CASE WHEN id % 11 = 0 THEN NULL ELSE concat('w', id % 4) END AS who", "id / 7.0D AS x")
    return rows.withColumn(PART, F.col("at").cast("date"))


# ---- digests -------------------------------------------------------------------


def test_digest_does_not_follow_order_and_sees_every_change(spark):
    rows = events(spark)
    same = rows.orderBy(F.desc("x")).repartition(7)
    assert rows_of(digest(rows, ["who"], rows.columns)) == rows_of(digest(same, ["who"], rows.columns))
    assert differing(rows, same, PART, rows.columns).count() == 0
    for changed in (
        rows.withColumn("x", F.when(F.col("x") == 0, F.lit(1e-9)).otherwise(F.col("x"))),
        rows.withColumn("who", F.when(F.col("x") > 85, None).otherwise(F.col("who"))),
        rows.unionAll(rows.limit(1)),
        rows.where("x > 0"),
    ):
        assert differing(rows, changed, PART, rows.columns).count() >= 1


def test_columns_do_not_run_together(spark):
    a = spark.createDataFrame([(1, None, "x"), (1, "x", None)], "k int, a string, b string")
    b = spark.createDataFrame([(1, "x", None), (1, "x", None)], "k int, a string, b string")
    assert differing(a, b, "k", ["a", "b"]).count() == 1


def test_digest_diff_is_the_diff(spark):
    rows = events(spark)
    gold = aggregate(rows, SPEC)
    day = F.dayofmonth("day")
    for stored in (
        gold,
        gold.where("day is not null"),
        gold.where(~day.eqNullSafe(3)),
        gold.unionByName(gold.limit(1).withColumn("who", F.lit("extra"))),
        gold.withColumn("n", F.col("n") + F.when(day == 2, 1).otherwise(0)),
        gold.withColumn("mean", F.col("mean") * (1 + 1e-15)),
        gold.withColumn("mean", F.col("mean") * F.when(day == 4, 1 + 1e-7).otherwise(1.0)),
        gold.limit(0),
    ):
        stored = spark.createDataFrame(stored.collect(), gold.schema)
        assert rows_of(recompute_diff_digest(rows, stored, SPEC)) == rows_of(recompute_diff(gold, stored, SPEC.keys, list(SPEC.measures)))


def test_only_differing_partitions_are_read(spark):
    root = run_dir(spark, "digest-plan")
    rows = events(spark).where("at is not null")
    rows.write.partitionBy(PART).parquet(f"{root}/silver")
    silver = spark.read.schema(rows.schema).parquet(f"{root}/silver")
    gold = aggregate(silver, SPEC)
    tampered = spark.createDataFrame(gold.withColumn("n", F.col("n") + F.when(F.dayofmonth("day") == 5, 1).otherwise(0)).collect(), gold.schema)
    found = recompute_diff_digest(silver, tampered, SPEC)
    assert found.count() > 0 and {r["day"].day for r in found.collect()} == {5}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [({PART}" in plan.replace("isnotnull(", "(") and "2026-01-05" in plan


def test_relation_diff_counts_copies(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (1, None), (2, "y"), (None, None)], "k int, v string")
    b = spark.createDataFrame([("x", 1), (None, 1), (None, 1), ("z", 3), (None, None)], "v string, k int")
    assert rows_of(relation_diff(a, b)) == sorted([("missing", 1, 1, "x"), ("missing", 1, 2, "y"), ("extra", 1, 1, None), ("extra", 1, 3, "z")], key=repr)
    assert relation_diff(a, a).count() == 0 and relation_diff(a.limit(0), b.limit(0)).count() == 0


# ---- verified exports -----------------------------------------------------------


def table(spark):
    return spark.createDataFrame([(1, "a", 0.5, [1]), (2, None, None, None), (None, "ü", float("nan"), [])], "k int, s string, `odd.name` double, l array<int>")


def test_verified_write_and_what_it_tells(spark):
    path = f"{run_dir(spark, 'verified')}/t"
    told = {r["column_name"]: r for r in verified_write(table(spark), path, "t").collect()}
    assert (told["k"]["nulls"], told["k"]["smallest"], told["k"]["largest"]) == (1, "1", "2")
    assert told["l"]["nulls"] == 1 and told["l"]["smallest"] is None
    assert verify_snapshot(spark, path).count() == 0
    assert verified_write(table(spark).limit(0), path, "t").count() == 4 and verify_snapshot(spark, path).count() == 0


@pytest.mark.parametrize(
    "column, value", [("k", "coalesce(k, 7)"), ("s", "CASE WHEN s = 'a' THEN 'b' ELSE s END"), ("l", "CASE WHEN size(l) = 1 THEN array(2) ELSE l END")])
def test_one_altered_value_is_found(spark, column, value):
    path = f"{run_dir(spark, 'altered')}/t"
    verified_write(table(spark), path, "t")
    folder = version_path(spark, path)
    note = files.read_text(spark, f"{folder}/_digest.json")
    altered = spark.createDataFrame(spark.read.parquet(folder).withColumn(column, F.expr(value)).collect(), table(spark).schema)
    altered.write.mode("overwrite").parquet(folder)
    files.write_text(spark, f"{folder}/_digest.json", note)
    assert {r["column_name"] for r in verify_snapshot(spark, path).collect()} == {column}


def test_a_lost_row_is_found(spark):
    path = f"{run_dir(spark, 'lost')}/t"
    verified_write(table(spark), path, "t")
    folder = version_path(spark, path)
    note = files.read_text(spark, f"{folder}/_digest.json")
    spark.createDataFrame(table(spark).where("k = 1").collect(), table(spark).schema).write.mode("overwrite").parquet(folder)
    files.write_text(spark, f"{folder}/_digest.json", note)
    assert (None, "rows", "3", "1") in rows_of(verify_snapshot(spark, path))
    with pytest.raises(FileNotFoundError):
        stored_digests(spark, f"{path}-none")


# ---- switched partitions ---------------------------------------------------------


@pytest.fixture
def switched(spark):
    root = run_dir(spark, "switched")
    name = "t_" + root.rsplit("-", 1)[1]
    create_switched(spark, name, events(spark), root)
    return name, root


def test_switch_only_scope(spark, switched):
    name, root = switched
    rows = events(spark)
    switch_partitions(rows, name)
    assert rows_of(read_switched(spark, name).select(rows.columns)) == rows_of(rows)
    # Two days in scope: one with new rows, one that became empty; rows without a date become empty too.
    some = rows.where(F.dayofmonth("at") == 2).withColumn("who", F.lit("new"))
    switch_partitions(some, name, only=["2026-01-02", "2026-01-03", None])
    want = rows.where("at is not null").where(~F.dayofmonth("at").isin(2, 3)).unionByName(some)
    assert rows_of(read_switched(spark, name).select(rows.columns)) == rows_of(want)
    assert spark.table(name).count() == want.count()
    assert "none" not in current_partitions(spark, name) and "2026-01-03" not in current_partitions(spark, name)


def test_readers_keep_the_grains_they_began_with(spark, switched):
    name, _ = switched
    rows = events(spark)
    switch_partitions(rows, name)
    begun = read_switched(spark, name)
    stage_batch(rows.withColumn("who", F.lit("new")), name)
    between = read_switched(spark, name)
    finish_switch(spark, name)
    assert begun.where("who = 'new'").count() == between.where("who = 'new'").count() == 0 and between.count() == rows.count()
    assert read_switched(spark, name).where("who = 'new'").count() == rows.count()


def test_a_switch_that_broke_off_is_finished(spark, switched):
    name, root = switched
    rows = events(spark)
    switch_partitions(rows, name)
    folder = stage_batch(rows.where(F.dayofmonth("at") == 1).withColumn("who", F.lit("new")), name, only=["2026-01-01"])
    # The map was begun and not ended; the catalog knows nothing yet.
    files.write_text(spark, f"{folder}/{MAP}", '{"2026-01-')
    assert read_switched(spark, name).where("who = 'new'").count() == 0
    assert finish_switch(spark, name) and not finish_switch(spark, name)
    assert files.read_text(spark, f"{root}/{NOTE}") is None
    assert read_switched(spark, name).where("who = 'new'").count() == spark.table(name).where("who = 'new'").count() > 0
    json.loads(files.read_text(spark, f"{folder}/{MAP}"))


def test_old_batches_go(spark, switched):
    name, root = switched
    rows = events(spark)
    for k in range(5):
        switch_partitions(rows.where(F.dayofmonth("at") == 1 + k), name, only=[f"2026-01-0{1 + k}"])
    switch_partitions(rows, name)
    switch_partitions(rows, name)
    assert len(files.partition_values(spark, root, BATCH)) == 2
    assert read_switched(spark, name).count() == rows.count()


# ---- verdicts --------------------------------------------------------------------


def test_failing_since(spark):
    path = f"{run_dir(spark, 'verdicts')}/v"
    outcome = {"a": [0, 3, 0, 2, 5], "b": [1, 1, 1, 1, 1], "c": [4, 0, 0, 0, 0], "d": [0, 0]}
    for run in range(5):
        some = [(c, "t", n[run], n[run] == 0) for c, n in outcome.items() if run < len(n)]
        record_verdicts(spark.createDataFrame(some, "check_name string, table_name string, failures long, passed boolean"), path)
    history = check_history(spark, path)
    assert history.count() == 17
    assert rows_of(failing_since(history)) == [("a", 3, 4, 2, 5), ("b", 0, 4, 5, 1)]
    assert rows_of(islands(history).where("check_name = 'a'").select("passed", "first_run", "last_run")) == [(False, 1, 1), (False, 3, 4), (True, 0, 0), (True, 2, 2)]


def test_runs_that_were_not_stored_whole_do_not_count(spark):
    path = f"{run_dir(spark, 'verdicts')}/v"
    assert check_history(spark, path).count() == 0 and failing_since(check_history(spark, path)).count() == 0
    one = spark.createDataFrame([("a", "t", 1, False)], "check_name string, table_name string, failures long, passed boolean")
    record_verdicts(one, path)
    record_verdicts(one, path)
    files.delete(spark, f"{path}/{RUN}=1/_SUCCESS")
    assert [r[RUN] for r in check_history(spark, path).collect()] == [0]
    assert record_verdicts(one, path) == 2


# ---- ledger and sketches -----------------------------------------------------------


def test_ledger_follows_rewritten_and_withdrawn_landings(spark):
    rows = spark.range(400).selectExpr("CASE WHEN id % 9 = 0 THEN NULL ELSE id END AS k", "CASE WHEN id % 4 < 3 THEN date_add(DATE'2026-01-01', cast(id % 4 AS int)) END AS ingest_date")
    now = classify(rows, required("k"))
    path = f"{run_dir(spark, 'ledger')}/l"
    assert rows_of(ledger_rate(read_ledger(spark, path))) == rows_of(rejection_rate(now.limit(0)))
    update_ledger(now, path)
    for by in ((), (INGEST_DATE,)):
        assert rows_of(ledger_rate(read_ledger(spark, path), by)) == rows_of(rejection_rate(now, by))
    later = now.where("ingest_date is null or ingest_date > '2026-01-01'").where(~((F.col(INGEST_DATE).isNull()) & (F.col("k") < 100)))
    update_ledger(later, path, ["2026-01-01", files.NO_VALUE])
    assert rows_of(ledger_rate(read_ledger(spark, path), [INGEST_DATE])) == rows_of(rejection_rate(later, [INGEST_DATE]))
    assert rows_of(ledger_summary(read_ledger(spark, path))) == rows_of(later.where(F.col(REASON).isNotNull()).groupBy(REASON).agg(F.count("*")))
    assert rows_of(read_ledger(spark, path).select(REASON, "n", INGEST_DATE)) == rows_of(count_landings(later))


def test_sketches_add_up(spark):
    rows = spark.range(60000).selectExpr("date_add(DATE'2026-01-01', cast(id % 59 AS int)) AS d", "CASE WHEN id % 5 = 0 THEN NULL ELSE id % 7001 END AS v", "id % 2 AS g")
    daily = daily_sketches(rows, "d", "v", ["g"])
    for by in (["g"], []):
        got = {tuple(r)[:-2]: r for r in rolled_up(daily, by).collect()}
        for r in rows.groupBy(*by).agg(F.count_distinct("v").alias("n"), F.count("*").alias("rows")).collect():
            mine = got[tuple(r)[:-2]]
            assert abs(mine["approx_distinct"] - r["n"]) <= 0.065 * r["n"] and mine["rows"] == r["rows"]


# ---- census ------------------------------------------------------------------------

LINES = [
    ("2026-01-01", '{"key": 1, "who": "ann", "deep": {"a": [1, 2], "b": null}}'),
    ("2026-01-01", '{"key": 2, "who": "bob"}'),
    ("2026-01-02", '{"key_no": 3, "who": "cy", "more": true}'),
    ("2026-01-02", '{"key_no": 4, "who": "dee"}'),
    ("2026-01-02", "no json"),
    ("2026-01-03", '{"key": 5}'),
]


def test_census_sees_every_leaf(spark):
    lines = spark.createDataFrame(LINES, f"{INGEST_DATE} string, value string").withColumn(INGEST_DATE, F.col(INGEST_DATE).cast("date"))
    first = leaves(lines).where(F.col(INGEST_DATE) == "2026-01-01").select("path", "value")
    assert rows_of(first) == sorted([("key", "1"), ("who", "ann"), ("deep.a[]", "1"), ("deep.a[]", "2"), ("key", "2"), ("who", "bob")])
    counted = {(str(r[INGEST_DATE]), r["path"]): (r["records"], r["landed"]) for r in field_census(lines).collect()}
    assert counted[("2026-01-02", "key_no")] == (2, 3) and counted[("2026-01-02", "more")] == (1, 3)


def test_drift_tells_new_missing_and_renamed(spark):
    lines = spark.createDataFrame(LINES, f"{INGEST_DATE} string, value string").withColumn(INGEST_DATE, F.col(INGEST_DATE).cast("date"))
    found = {(str(r[INGEST_DATE]), r["path"], r["change"], r["renamed_from"]) for r in schema_drift(lines, ["key", "who", "deep.a[]"]).collect()}
    assert found == {
        ("2026-01-02", "key_no", "new", None), ("2026-01-02", "more", "new", None), ("2026-01-02", "deep.a[]", "missing", None),
        ("2026-01-02", "key", "missing", None), ("2026-01-03", "who", "missing", None), ("2026-01-02", "key_no", "renamed", "key"),
    }
    assert schema_drift(lines.limit(0), ["key"]).count() == 0


def test_census_passes_few_times_over_the_lines(spark):
    root = run_dir(spark, "census-lines")
    lines = spark.createDataFrame([*LINES, LINES[1]], f"{INGEST_DATE} string, value string")
    lines.write.partitionBy(INGEST_DATE).text(f"{root}/github_commits")
    found = schema_drift(spark.read.schema(f"value string, {INGEST_DATE} date").text(f"{root}/github_commits"), ["key", "who", "deep.a[]"])
    assert found.count() == 5
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Relation [value") <= 8  # a scan per level and use were over 100


def test_census_of_odd_lines(spark):
    odd = ['{"a.b": 1, "a": {"b": 2}}', '{"a.b": 1, "a": {"b": 2}}', "{}", "[]", "7", "null", None, '{"m": [], "n": {"x": null}}', '[1, {"x": "q"}, [2]]', '{"k": 1, "k": 2}']
    lines = spark.createDataFrame([("2026-01-01", line) for line in odd], f"{INGEST_DATE} string, value string").withColumn(INGEST_DATE, F.col(INGEST_DATE).cast("date"))
    assert rows_of(leaves(lines).select("path", "value")) == sorted([("a.b", "1"), ("a.b", "2")] * 2 + [("[]", "1"), ("[].x", "q"), ("[][]", "2")])
    assert rows_of(leaves(lines, 1).where("path = '[]'").select("value")) == [("1",), ("[2]",), ('{"x":"q"}',)]
    sets = {tuple(r["paths"]): r["records"] for r in path_sets(lines).collect()}
    assert sets[("a.b",)] == 1 and sets[("[]", "[].x", "[][]")] == 1  # equal lines are one record, a path counts once a record


def test_malformed_text_names_its_reason(spark):
    rows = spark.createDataFrame([(1, None), (None, None), (None, "{broken"), (2, "{odd}")], f"k int, {CORRUPT} string")
    assert [r[0] for r in classify(rows, required("k"), CORRUPT).select(REASON).collect()] == [None, "missing_k", "malformed_record", None]
