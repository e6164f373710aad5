import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from layerwright.operators.diff import recompute_diff
from layerwright.operators.grain import PART, GrainSpec, aggregate
from layerwright.operators.incremental import (
    INTENT,
    collect_grains,
    cutoff,
    has_gold,
    in_grains,
    incremental_run,
    late_grains,
    missed_grains,
    read_gold,
    repair_grains,
    since,
    watermark_frame,
)
from layerwright.operators.upsert import survivors, upsert_by_key
from layerwright.plans.domains import FILINGS, REQUESTS
from layerwright.session import run_dir
from layerwright.sources import files
from layerwright.sources.catalog import write_layer

DAILY = GrainSpec("day", "at", "day", {"who": "who"}, {"n": "count(*)", "mean": "avg(v)"})
MONTHLY = GrainSpec("month", "at", "month", {"who": "coalesce(who, '?')"}, {"n": "count(*)", "vs": "count(DISTINCT v)"})
SCHEMA = "at timestamp_ntz, who string, v bigint"


def at(day, month=1, hour=5):
    return dt.datetime(2024, month, day, hour)


def frame(spark, data):
    return spark.createDataFrame(list(data), SCHEMA)


def gold_path(spark):
    return f"{run_dir(spark, 'test')}/gold"


def same(a, b):
    return sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


# ---- watermark ---------------------------------------------------------------


def test_empty_gold_has_the_floor(spark):
    row = watermark_frame(aggregate(frame(spark, []), DAILY), DAILY, 0).first()
    assert row["watermark"] == dt.datetime(1900, 1, 1)


def test_cutoff_is_aligned_to_the_month(spark):
    gold = aggregate(frame(spark, [(at(9, 3), "a", 1)]), MONTHLY)
    assert cutoff(gold, MONTHLY, 3) == dt.datetime(2024, 2, 1)
    assert cutoff(gold, MONTHLY, 0) == dt.datetime(2024, 3, 1)


def test_cap_holds_back_a_future_date(spark, rows):
    path = gold_path(spark)
    incremental_run(frame(spark, [(at(5), "a", 1), (dt.datetime(2990, 1, 1), "a", 1)]), path, DAILY)
    silver = frame(spark, [(at(5), "a", 1), (at(6), "a", 1), (dt.datetime(2990, 1, 1), "a", 1)])
    hidden = incremental_run(silver, path, DAILY)
    assert hidden.count() == 2
    seen = incremental_run(silver, path, DAILY, cap=dt.date(2024, 1, 6))
    assert same(seen, aggregate(silver, DAILY))


# ---- runs --------------------------------------------------------------------


def test_late_row_inside_and_outside_the_lookback(spark):
    base = [(at(d), "a", d) for d in range(1, 11)]
    late = [(at(8), "a", 100)]
    naive, healed = gold_path(spark), gold_path(spark)
    for path in (naive, healed):
        incremental_run(frame(spark, base), path, DAILY)
    silver = frame(spark, base + late)
    stale = incremental_run(silver, naive, DAILY, lookback_days=0)
    diff = recompute_diff(aggregate(silver, DAILY), stale, DAILY.keys, list(DAILY.measures)).collect()
    assert [(r["day"], r["expected_n"], r["actual_n"], r["problem"]) for r in diff] == [(dt.datetime(2024, 1, 8), 2, 1, "changed")]
    assert same(incremental_run(silver, healed, DAILY), aggregate(silver, DAILY))


def test_too_late_row_is_audited_and_repaired(spark):
    path = gold_path(spark)
    base = [(at(d), "a", d) for d in range(1, 11)]
    incremental_run(frame(spark, base), path, DAILY)
    landed = frame(spark, [(at(2), "b", 7)])
    silver = frame(spark, base).unionByName(landed)
    stored = incremental_run(silver, path, DAILY)
    assert [(r["day"], r["who"], r["problem"]) for r in missed_grains(silver, stored, DAILY).collect()] == [(dt.datetime(2024, 1, 2), "b", "missing")]
    days = [r[0] for r in late_grains(landed, DAILY, cutoff(stored, DAILY)).collect()]
    assert days == [dt.date(2024, 1, 2)]
    assert same(repair_grains(silver, path, DAILY, days), aggregate(silver, DAILY))


def test_month_is_never_rebuilt_from_part_of_its_rows(spark):
    """A plain three-day cutoff would replace February by its last three days."""
    silver = frame(spark, [(at(d, 2), "a", d) for d in range(1, 29)] + [(at(1, 3), "a", 1)])
    path = gold_path(spark)
    incremental_run(silver, path, MONTHLY)
    assert same(incremental_run(silver, path, MONTHLY), aggregate(silver, MONTHLY))


def test_null_dimension_is_replaced_not_duplicated(spark):
    silver = frame(spark, [(at(1), None, 1), (at(1), "a", 1)])
    path = gold_path(spark)
    incremental_run(silver, path, DAILY)
    assert incremental_run(silver, path, DAILY).count() == 2


def test_vanished_grain_and_emptied_day_go(spark):
    path = gold_path(spark)
    incremental_run(frame(spark, [(at(1), "a", 1), (at(2), "a", 1), (at(3), "a", 1), (at(3), "b", 1)]), path, DAILY)
    silver = frame(spark, [(at(1), "a", 1), (at(3), "c", 1)])
    assert same(incremental_run(silver, path, DAILY), aggregate(silver, DAILY))


def test_nothing_before_the_window_is_touched(spark):
    path = gold_path(spark)
    incremental_run(frame(spark, [(at(1), "a", 1), (at(20), "a", 1)]), path, DAILY)
    after = incremental_run(frame(spark, [(at(20), "a", 1)]), path, DAILY)
    assert after.count() == 2
    refreshed = incremental_run(frame(spark, [(at(20), "a", 1)]), path, DAILY, full_refresh=True)
    assert refreshed.count() == 1


def test_empty_silver(spark):
    path = gold_path(spark)
    empty = incremental_run(frame(spark, []), path, DAILY)
    assert empty.count() == 0 and empty.columns == [*DAILY.keys, "n", "mean"]
    assert not has_gold(spark, path)
    assert repair_grains(frame(spark, []), path, DAILY, []).count() == 0


events = st.lists(st.tuples(st.integers(1, 28), st.sampled_from(["a", "b", None]), st.integers(0, 5)), min_size=1, max_size=25)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events, st.integers(1, 24))
def test_in_order_batches_equal_a_full_recompute(spark, data, first):
    """Whatever the batching, rows no later than the lookback give the same gold."""
    data = [(at(d), w, v) for d, w, v in data]
    path = gold_path(spark)
    for end in (first, first + 3, 28):
        incremental_run(frame(spark, [r for r in data if r[0].day <= end]), path, DAILY)
    silver = frame(spark, data)
    once = incremental_run(silver, path, DAILY)
    assert same(once, aggregate(silver, DAILY))
    assert same(incremental_run(silver, path, DAILY), aggregate(silver, DAILY))


# ---- pruning -----------------------------------------------------------------


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_filter_prunes_and_pushes_down(spark):
    rows = frame(spark, [(at(d), "a", d) for d in range(1, 11)])
    stored = write_layer(rows.withColumn(PART, DAILY.grain_date("at")), f"{run_dir(spark, 't')}/s", partition_by=PART)
    plan = plan_of(since(stored, DAILY, dt.datetime(2024, 1, 8)))
    assert "PartitionFilters: [isnotnull(grain_date" in plan and "GreaterThanOrEqual(at,2024-01-08T00:00)" in plan
    plan = plan_of(in_grains(stored, DAILY, [dt.date(2024, 1, 2)]))
    assert "PartitionFilters: [isnotnull(grain_date" in plan


def test_date_column_is_compared_as_a_date(spark):
    filed = spark.createDataFrame([(dt.date(2024, 1, 5), "a")], "file_date date, cik string")
    stored = write_layer(filed, f"{run_dir(spark, 't')}/f")
    assert "GreaterThanOrEqual(file_date,2024-01-01)" in plan_of(since(stored, FILINGS.spec, dt.datetime(2024, 1, 1)))


def test_gold_reads_back_with_its_declared_types(spark):
    path = gold_path(spark)
    incremental_run(frame(spark, [(at(1), "a", 1)]), path, DAILY)
    gold = read_gold(spark, path, DAILY)
    assert gold.dtypes == [("day", "timestamp_ntz"), ("who", "string"), ("n", "bigint"), ("mean", "double")]
    assert collect_grains(frame(spark, [(at(1), "a", 1), (at(1, hour=9), "b", 1)]), DAILY) == [dt.date(2024, 1, 1)]


def test_gold_does_not_carry_columns_it_does_not_read(spark):
    staged = spark.createDataFrame([], "request_id bigint, created_at timestamp_ntz, closed_at timestamp_ntz, agency string, agency_name string,"
                                   "complaint_type string, descriptor string, borough string, incident_zip string, status string,"
                                   "latitude double, longitude double")
    path = f"{run_dir(spark, 't')}/staged"
    staged.write.parquet(path)
    plan = plan_of(REQUESTS.gold_of(spark.read.parquet(path)))
    assert "descriptor" not in plan and "incident_zip" not in plan
    assert "IsNotNull(agency)" in plan


# ---- aggregates --------------------------------------------------------------


def test_counts_add_up(spark):
    data = [(1, at(1), s) for s in ("Closed", "Open", None)]
    df = spark.createDataFrame(data, "resolution_hours bigint, created_at timestamp_ntz, status string").selectExpr(
        "*", "'a' AS agency", "'A' AS agency_name", "'t' AS complaint_type"
    )
    row = aggregate(df, REQUESTS.spec).first()
    assert (row["request_count"], row["closed_count"], row["open_count"]) == (3, 1, 2)


def test_average_ignores_nulls(spark):
    df = frame(spark, [(at(1), "a", 1), (at(1), "a", None), (at(1), "a", 4), (at(2), "b", None)])
    assert [r["mean"] for r in aggregate(df, DAILY).orderBy("day").collect()] == [2.5, None]


# ---- delete + insert by key, diff ----------------------------------------------


def keyed(spark, data):
    return spark.createDataFrame(data, "k string, j int, n bigint")


def test_upsert_is_null_safe(spark, rows):
    gold = keyed(spark, [(None, 1, 1), ("a", 1, 1), ("b", None, 1)])
    batch = keyed(spark, [(None, 1, 9), ("b", None, 9), ("c", 1, 9)])
    assert rows(upsert_by_key(gold, batch, ["k", "j"])) == rows(keyed(spark, [("a", 1, 1), (None, 1, 9), ("b", None, 9), ("c", 1, 9)]))
    assert rows(survivors(gold, batch, ["k", "j"])) == [("a", 1, 1)]


def test_upsert_twice_changes_nothing(spark, rows):
    gold, batch = keyed(spark, [("a", 1, 1)]), keyed(spark, [("a", 1, 2), ("b", 1, 3)])
    once = upsert_by_key(gold, batch, ["k", "j"])
    assert rows(upsert_by_key(once, batch, ["k", "j"])) == rows(once)


def test_diff_finds_missing_changed_and_extra(spark, rows):
    expected = keyed(spark, [("a", 1, 1), ("b", 1, 1), (None, 1, 1)])
    actual = keyed(spark, [("a", 1, 2), (None, 1, 1), ("z", 1, 1)])
    assert rows(recompute_diff(expected, actual, ["k", "j"], ["n"])) == rows(
        spark.createDataFrame(
            [("a", 1, 1, 2, "changed"), ("b", 1, 1, None, "missing"), ("z", 1, None, 1, "extra")], "k string, j int, e bigint, a bigint, p string"
        )
    )


def test_plain_one_sided_diff_misreports_null_keys(spark, rows):
    same_rows = keyed(spark, [("a", 1, 1), (None, 1, 1)])
    assert recompute_diff(same_rows, same_rows, ["k", "j"], ["n"]).isEmpty()
    found = recompute_diff(same_rows, same_rows, ["k", "j"], ["n"], two_sided=False, null_safe_keys=False)
    assert rows(found) == [(None, 1, 1, None, "missing")]


def test_diff_tolerates_summation_order_only(spark):
    left = spark.createDataFrame([("a", 0.1 + 0.2)], "k string, m double")
    right = spark.createDataFrame([("a", 0.3)], "k string, m double")
    other = spark.createDataFrame([("a", 0.3001)], "k string, m double")
    none = spark.createDataFrame([("a", None)], "k string, m double")
    assert recompute_diff(left, right, ["k"], ["m"]).isEmpty()
    assert recompute_diff(left, other, ["k"], ["m"]).count() == 1
    assert recompute_diff(left, none, ["k"], ["m"]).count() == 1


def test_diff_is_an_equi_join(spark):
    df = keyed(spark, [("a", 1, 1)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(recompute_diff(df, df, ["k", "j"], ["n"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("hot", [0.4])
def test_hot_group_aggregates_completely(spark, hot):
    df = spark.range(20000, numPartitions=4).select(
        F.lit(at(1)).cast("timestamp_ntz").alias("at"),
        F.when(F.col("id") % 10 < hot * 10, "hot").otherwise(F.col("id").cast("string")).alias("who"),
        F.col("id").alias("v"),
    )
    spec = GrainSpec("day", "at", "day", {"who": "who"}, {"n": "count(*)", "d": "count(DISTINCT v)"})
    assert tuple(aggregate(df, spec).where("who = 'hot'").first())[2:] == (8000, 8000)


def test_scope_of_a_broken_run_is_redone(spark):
    """Whatever a marker names is covered by the next run, and only then forgotten."""
    rows = frame(spark, [(at(d), "a", d) for d in range(1, 11)])
    path = f"{run_dir(spark, 't')}/g"
    incremental_run(rows, path, DAILY)
    marker = f"{path}/{INTENT}"
    assert files.read_text(spark, marker) is None
    for left in ('{"since": null}', '{"since": "2024-01-02"}', '{"only": ["2024-01-03", "2024-01-02"]}', ""):
        files.delete(spark, f"{path}/{PART}=2024-01-02")
        files.write_text(spark, marker, left)
        # A repair elsewhere leaves the marker for a run that reaches its scope.
        repair_grains(rows, path, DAILY, [dt.date(2024, 1, 9)])
        assert files.read_text(spark, marker) is not None
        assert incremental_run(rows, path, DAILY).count() == 10
        assert files.read_text(spark, marker) is None


def test_undated_partition_is_refreshed_and_dropped(spark):
    path = f"{run_dir(spark, 't')}/g"
    dated = [(at(1), "a", 1)]
    assert incremental_run(frame(spark, [*dated, (None, "a", 1)]), path, DAILY).count() == 2
    assert incremental_run(frame(spark, [*dated, (None, "a", 1), (None, "b", 1)]), path, DAILY).count() == 3
    assert repair_grains(frame(spark, [(None, "c", 1)]), path, DAILY, [None]).count() == 2
    assert incremental_run(frame(spark, dated), path, DAILY).count() == 1
