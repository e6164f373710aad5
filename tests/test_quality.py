import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from layerwright.operators.checks import TableChecks, not_null, run_checks, unexpected_failures, unique
from layerwright.operators.dedup import keep_best, keep_best_stored, latest, lowest
from layerwright.operators.quality import (
    accepted,
    classify,
    rejected,
    rejection_gate,
    rejection_rate,
    rejection_rate_of,
    rejection_summary,
    required,
    split,
    valid,
)

RULES = required("a", "b")
SCHEMA = "a bigint, b string, day string"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_first_broken_rule_names_the_reason(spark, rows):
    df = classify(frame(spark, (1, "x", "d"), (None, "x", "d"), (1, None, "d"), (None, None, "d")), RULES)
    assert rows(df.select("a", "b", "rejection_reason")) == rows(
        spark.createDataFrame(
            [(1, "x", None), (None, "x", "missing_a"), (1, None, "missing_b"), (None, None, "missing_a")], "a bigint, b string, r string"
        )
    )


maybe = st.one_of(st.none(), st.integers(0, 3))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(maybe, st.one_of(st.none(), st.just("x")), st.just("d")), max_size=12))
def test_split_is_a_partition(spark, data):
    df = frame(spark, *data)
    good, bad = split(classify(df, RULES), ["a", "b"])
    assert good.count() + bad.count() == len(data)
    assert sorted(map(tuple, good.collect())) == sorted(map(tuple, valid(df, RULES).collect()))
    assert all(a is not None and b is not None for a, b, _ in good.collect())
    assert all(r["rejection_reason"] for r in bad.collect())


def test_rate_counts_duplicates_and_empty_passes(spark):
    df = classify(frame(spark, (1, "x", "d"), (1, "x", "d"), (None, "x", "d")), RULES)
    assert tuple(rejection_rate(df).first()) == (1, 3, 1 / 3)
    empty = classify(frame(spark), RULES)
    assert tuple(rejection_rate(empty).first()) == (0, 0, 0.0)
    assert rejection_gate(empty).isEmpty()


def test_gate_is_strictly_above(spark):
    data = [(None, "x", "d")] + [(1, "x", "d")] * 49
    at = classify(frame(spark, *data), RULES)
    assert rejection_gate(at, 0.02).isEmpty()
    above = classify(frame(spark, *data[:-1]), RULES)
    assert tuple(rejection_gate(above, 0.02).first()) == (1, 49, 1 / 49)


def test_rate_per_batch_is_not_diluted(spark, rows):
    data = [(1, "x", "good")] * 96 + [(1, "x", "bad"), (None, "x", "bad")] * 2
    df = classify(frame(spark, *data), RULES)
    assert rejection_gate(df, 0.02).isEmpty()
    assert rows(rejection_gate(df, 0.02, by=["day"])) == [("bad", 2, 4, 0.5)]


def test_rate_of_two_tables_equals_single_pass(spark):
    staged = frame(spark, (1, "x", "d"), (None, None, "d"))
    df = classify(staged, RULES)
    assert tuple(rejection_rate_of(rejected(df, ["a"]), staged).first()) == tuple(rejection_rate(df).first())


def test_summary(spark, rows):
    df = classify(frame(spark, (None, "x", "d"), (None, None, "d"), (1, None, "d"), (1, "x", "d")), RULES)
    assert rows(rejection_summary(df)) == [("missing_a", 2), ("missing_b", 1)]
    assert accepted(df).columns == ["a", "b", "day"]


# ---- dedup -------------------------------------------------------------------


def test_latest_wins_and_null_loses(spark, rows):
    ts = [dt.datetime(2024, 1, d) for d in (1, 2)]
    df = spark.createDataFrame([(1, ts[0], "old"), (1, ts[1], "new"), (1, None, "none"), (2, None, "only")], "k int, t timestamp_ntz, v string")
    assert [r[2] for r in sorted(keep_best(df, ["k"], [latest("t")]).collect())] == ["new", "only"]


def test_lowest_wins_and_null_loses(spark):
    df = spark.createDataFrame([("a", None, "n"), ("a", 10, "ten"), ("a", 9, "nine")], "k string, seq bigint, v string")
    assert [r["v"] for r in keep_best(df, ["k"], [lowest("seq")]).collect()] == ["nine"]


def test_ties_do_not_depend_on_input_order(spark):
    data = [("a", 1, "x"), ("a", 1, None), ("a", 1, "b")]
    for order in (data, data[::-1], data[1:] + data[:1]):
        df = spark.createDataFrame(order, "k string, seq int, v string").repartition(3)
        assert keep_best(df, ["k"], [lowest("seq")]).first()["v"] == "b"


def test_stored_rows_with_few_repeated_keys_stay_where_they_are(spark):
    data = [(n, n, f"v{n}") for n in range(200)] + [(None, 1, "x"), (None, 2, "y"), (7, 9, "z"), (7, 9, "z"), (8, None, "w")]
    df = spark.createDataFrame(data, "k int, d int, v string")
    want = sorted((tuple(r) for r in keep_best(df, ["k"], [latest("d")]).collect()), key=repr)
    for most in (1_000_000, 3, 2, 0):
        found = keep_best_stored(df, ["k"], [latest("d")], most=most)
        assert found.columns == df.columns and sorted((tuple(r) for r in found.collect()), key=repr) == want
        assert ("LeftAnti" in found._jdf.queryExecution().optimizedPlan().toString()) == (most >= 3)  # three keys repeat
    copies = df.unionAll(df).unionAll(df)
    assert sorted((tuple(r) for r in keep_best_stored(copies, ["k"], [latest("d")]).collect()), key=repr) == want
    assert keep_best_stored(df.limit(0), ["k"], [latest("d")]).count() == 0


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    """A key holding a third of all rows leaves at most one row per map task."""
    df = spark.range(9000, numPartitions=4).selectExpr("if(id % 3 = 0, 0, id) AS k", "id AS seq", "cast(id AS string) AS v")
    best = keep_best(df, ["k"], [lowest("seq")])
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert best.count() == 6001
    assert best.where("k = 0").first()["seq"] == 0


# ---- column checks -----------------------------------------------------------


def test_not_null_and_unique(spark, rows):
    df = frame(spark, (1, "x", "d"), (1, None, "d"), (None, None, "d"), (None, "y", "d"), (2, "z", "d"))
    assert rows(not_null(df, ["a", "b", "day"])) == [("a", 2), ("b", 2)]
    assert rows(unique(df, "a")) == [(1, 2)]


def test_run_checks_and_allowlist(spark, rows):
    df = frame(spark, (1, "x", "d"), (1, None, "d"))
    verdicts = run_checks(
        {"t": df},
        [TableChecks("t", not_null=("a", "b"), unique=("a",))],
        [("rate", "t", rejection_gate(classify(df, RULES)))],
    )
    assert rows(verdicts) == [
        ("not_null_t_a", "t", 0, True),
        ("not_null_t_b", "t", 1, False),
        ("rate", "t", 1, False),
        ("unique_t_a", "t", 1, False),
    ]
    assert rows(unexpected_failures(verdicts, ["rate", "unique_t_a"]).select("check_name")) == [("not_null_t_b",)]
    assert unexpected_failures(verdicts, []).count() == 3
