"""What is kept beside the layers: digests, switched partitions, verdicts over runs, ledgers, sketches, the field census."""

from pyspark.sql import functions as F

from layerwright.operators.checks import run_checks
from layerwright.operators.digests import recompute_diff_digest, relation_diff
from layerwright.operators.grain import PART, aggregate
from layerwright.operators.history import check_history, failing_since, record_verdicts
from layerwright.operators.ledger import ledger_rate, ledger_summary, read_ledger, update_ledger
from layerwright.operators.sketches import daily_sketches, rolled_up
from layerwright.plans.demo import messy_requests
from layerwright.plans.domains import COMMITS, FILINGS, REQUESTS
from layerwright.plans.gated import RunConfig, build
from layerwright.session import run_dir
from layerwright.sources.bronze import CORRUPT, INGEST_DATE, read_bronze, write_bronze
from layerwright.sources.census import declared_paths, raw_lines, schema_drift
from layerwright.sources.switching import create_switched, finish_switch, read_switched, stage_batch, switch_partitions
from layerwright.sources.verified import verified_write
from workload.oracle import ctes, gold_of
from workload.quality_queries import silver
from workload.registry import query
from workload.standins import raw_commits, raw_requests, messages, requests

# ---- digests -------------------------------------------------------------------

_TAMPERED = """
  SELECT request_date, agency, agency_name, complaint_type, request_count + CASE WHEN day(request_date) = 3 THEN 1 ELSE 0 END AS request_count,
         avg_resolution_hours, closed_count, open_count
  FROM gld_r WHERE NOT (day(request_date) = 5 AND agency = (SELECT min(agency) FROM gld_r))
"""


def _tampered(gold):
    least = gold.agg(F.min("agency")).first()[0]
    day = F.dayofmonth("request_date")
    kept = gold.where(~((day == 5) & F.col("agency").eqNullSafe(least)))
    return kept.withColumn("request_count", F.col("request_count") + F.when(day == 3, 1).otherwise(0))


@query(
    "recompute_diff_digest",
    ctes("r", f"stored AS ({_TAMPERED})")
    + """SELECT e.request_date, e.agency, e.agency_name, e.complaint_type, e.request_count AS expected_request_count, s.request_count AS actual_request_count,
                CASE WHEN s.request_count IS NULL THEN 'missing' ELSE 'changed' END AS problem
         FROM gld_r e LEFT JOIN stored s ON e.request_date = s.request_date AND e.agency IS NOT DISTINCT FROM s.agency
              AND e.agency_name IS NOT DISTINCT FROM s.agency_name AND e.complaint_type IS NOT DISTINCT FROM s.complaint_type
         WHERE s.request_count IS DISTINCT FROM e.request_count""",
)
def recompute_diff_digest_query(spark, sf_dir):
    """V-7: stored gold against silver, by digests per grain date; only dates that differ are compared grain by grain."""
    rows = REQUESTS.dated(silver(spark, sf_dir, REQUESTS))
    root = run_dir(spark, "digest")
    rows.write.partitionBy(PART).parquet(f"{root}/silver")
    _tampered(aggregate(rows, REQUESTS.spec)).write.parquet(f"{root}/gold")
    found = recompute_diff_digest(spark.read.schema(rows.schema).parquet(f"{root}/silver"), spark.read.parquet(f"{root}/gold"), REQUESTS.spec)
    return found.select(*REQUESTS.spec.keys, "expected_request_count", "actual_request_count", "problem")


_LEFT = "SELECT agency, complaint_type, status FROM cls_r"
_RIGHT = "SELECT agency, complaint_type, CASE WHEN request_id % 9 = 0 THEN NULL ELSE status END AS status FROM cls_r WHERE request_id IS NULL OR request_id % 8 <> 1"


@query(
    "relation_diff",
    ctes("r", f"e AS ({_LEFT})", f"a AS ({_RIGHT})")
    + """SELECT 'missing' AS problem, count(*) AS copies, agency, complaint_type, status FROM (SELECT * FROM e EXCEPT ALL SELECT * FROM a) GROUP BY ALL
         UNION ALL SELECT 'extra', count(*), agency, complaint_type, status FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM e) GROUP BY ALL""",
)
def relation_diff_query(spark, sf_dir):
    """T-3: two relations without a key, with copies and NULLs, compared as bags."""
    rows = requests(spark, sf_dir)
    left = rows.select("agency", "complaint_type", "status")
    kept = rows.where("request_id is null or request_id % 8 <> 1")
    right = kept.select("agency", "complaint_type", F.when(F.col("request_id") % 9 == 0, None).otherwise(F.col("status")).alias("status"))
    return relation_diff(left, right)


# ---- storage -------------------------------------------------------------------

_COLUMNS = ("request_count", "closed_count", "agency", "complaint_type")


@query(
    "export_verified",
    ctes("r")
    + "UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS nulls, min({c})::varchar AS smallest, max({c})::varchar AS largest FROM gld_r " for c in _COLUMNS),
)
def export_verified(spark, sf_dir):
    """O-7: what each column held when it was written, verified against what was stored."""
    gold = aggregate(silver(spark, sf_dir, REQUESTS), REQUESTS.spec).select(*_COLUMNS)
    return verified_write(gold, f"{run_dir(spark, 'verified')}/gold", "gold").select("column_name", "nulls", "smallest", "largest")


_HALF = "SELECT * FROM slv_r WHERE request_id % 2 = 0"


@query(
    "gold_switch_readers",
    ctes("r", f"half AS ({_HALF})", f"before AS ({gold_of('r', 'half')})")
    + "SELECT 'between' AS seen, request_date, agency, agency_name, complaint_type, request_count FROM before"
    + " UNION ALL SELECT 'after', request_date, agency, agency_name, complaint_type, request_count FROM gld_r",
)
def gold_switch_readers(spark, sf_dir):
    """O-5: a read begun after new grains are written and before they are switched sees the old ones, also once they are switched."""
    spec = REQUESTS.spec
    rows = silver(spark, sf_dir, REQUESTS)
    stored = lambda some: aggregate(some, spec).withColumn(PART, F.col(spec.date_name).cast("date"))
    root = run_dir(spark, "switched")
    name = "gold_" + root.rsplit("-", 1)[1]
    create_switched(spark, name, stored(rows), root)
    switch_partitions(stored(rows.where("request_id % 2 = 0")), name)
    stage_batch(stored(rows), name)
    between = read_switched(spark, name)
    finish_switch(spark, name)
    shown = lambda df, when: df.select(F.lit(when).alias("seen"), *spec.keys, "request_count")
    return shown(between, "between").unionAll(shown(read_switched(spark, name), "after"))


# ---- verdicts, counts, sketches ------------------------------------------------------


def _run_verdicts(spark, sf_dir, path):
    """Runs 0 to 4 over a fifth of the rows each; the checks fail where that fifth holds what they look for."""
    rows = requests(spark, sf_dir)
    for run in range(5):
        some = rows.where(F.pmod(F.coalesce("request_id", F.lit(run)), F.lit(5)) == run) if run != 2 else rows.where("request_id is not null")
        looked_for = [("not_null_request_id", "stg", some.where("request_id is null")), ("no_open_requests", "stg", some.where("status = 'Open' and request_id % 10 < 2"))]
        record_verdicts(run_checks({}, [], looked_for), path, f"2026-08-0{run + 1} 00:00:00")


_VERDICTS = """
  runs(run) AS (VALUES (0), (1), (2), (3), (4)),
  part AS (SELECT run, s.* FROM runs JOIN stg_r s ON CASE WHEN run = 2 THEN request_id IS NOT NULL ELSE coalesce(request_id, run) % 5 = run END),
  verdict AS (
    SELECT 'not_null_request_id' AS check_name, run, count(*) FILTER (WHERE request_id IS NULL) AS failures FROM part GROUP BY run
    UNION ALL SELECT 'no_open_requests', run, count(*) FILTER (WHERE status = 'Open' AND request_id % 10 < 2) FROM part GROUP BY run
  )
"""


@query("check_history", ctes("r") .rstrip() + "," + _VERDICTS + "SELECT check_name, run::bigint AS run, failures, failures = 0 AS passed FROM verdict")
def check_history_query(spark, sf_dir):
    """V-8: the verdicts of five runs, as they were stored."""
    path = f"{run_dir(spark, 'verdicts')}/verdicts"
    _run_verdicts(spark, sf_dir, path)
    return check_history(spark, path).select("check_name", "run", "failures", "passed")


@query(
    "failing_since",
    ctes("r").rstrip() + "," + _VERDICTS + """,
      last_good AS (SELECT check_name, coalesce(max(run) FILTER (WHERE failures = 0), -1) AS run FROM verdict GROUP BY check_name)
      SELECT v.check_name, min(v.run)::bigint AS first_run, max(v.run)::bigint AS last_run, count(*) AS runs, max(failures) AS worst
      FROM verdict v JOIN last_good g ON v.check_name = g.check_name AND v.run > g.run GROUP BY v.check_name""",
)
def failing_since_query(spark, sf_dir):
    """V-8: since which run the checks that failed last have been failing."""
    path = f"{run_dir(spark, 'failing')}/verdicts"
    _run_verdicts(spark, sf_dir, path)
    return failing_since(check_history(spark, path))


@query(
    "rejection_rate_ledger",
    ctes("r", "kept AS (SELECT * FROM cls_r WHERE coalesce(created_at, closed_at, timestamp '2024-01-01')::date <> (SELECT min(created_at)::date FROM cls_r))")
    + """SELECT count(*) FILTER (WHERE rejection_reason IS NOT NULL) AS rejected_count, count(*) AS total_count,
                count(*) FILTER (WHERE rejection_reason IS NOT NULL)::double / count(*) AS rejection_rate FROM kept""",
)
def rejection_rate_ledger(spark, sf_dir):
    """V-3: the rate over all history from counts per landing, after one was rewritten and one withdrawn."""
    rows = raw_requests(requests(spark, sf_dir))
    staged = REQUESTS.classify(REQUESTS.stage(rows, lineage=[INGEST_DATE]))
    first = staged.agg(F.min("created_at").cast("date").cast("string")).first()[0]
    newest = staged.agg(F.max(INGEST_DATE).cast("string")).first()[0]
    path = f"{run_dir(spark, 'ledger')}/ledger"
    # Landed wrong at first: the newest landing without agencies; then rewritten, and the first one withdrawn.
    update_ledger(REQUESTS.classify(staged.drop("rejection_reason").withColumn("agency", F.when(F.col(INGEST_DATE) != newest, F.col("agency")))), path)
    update_ledger(staged.where(F.col(INGEST_DATE) != F.lit(first).cast("date")), path, [first, newest])
    return ledger_rate(read_ledger(spark, path))


@query("rejection_summary_ledger", ctes("r") + "SELECT rejection_reason, count(*) AS n FROM cls_r WHERE rejection_reason IS NOT NULL GROUP BY ALL")
def rejection_summary_ledger(spark, sf_dir):
    """V-2: reasons of all history from the ledger."""
    path = f"{run_dir(spark, 'ledger')}/ledger"
    update_ledger(REQUESTS.classify(REQUESTS.stage(raw_requests(requests(spark, sf_dir)), lineage=[INGEST_DATE])), path)
    return ledger_summary(read_ledger(spark, path))


@query(
    "gold_filers_sketch",
    ctes("f") + "SELECT file_month, unique_filers AS exact, true AS close FROM (SELECT date_trunc('month', file_date)::timestamp AS file_month, count(DISTINCT cik) AS unique_filers FROM slv_f GROUP BY 1)",
)
def gold_filers_sketch(spark, sf_dir):
    """A-5: distinct filers of a month from stored daily sketches, held against the exact count."""
    rows = silver(spark, sf_dir, FILINGS)
    path = f"{run_dir(spark, 'sketches')}/daily"
    daily_sketches(rows, "file_date", "cik", ["biz_state", "form_type"]).write.parquet(path)
    month = F.date_trunc("month", "day").cast("timestamp_ntz")
    rolled = rolled_up(spark.read.parquet(path).withColumn("file_month", month), ["file_month"])
    exact = rows.groupBy(F.date_trunc("month", "file_date").cast("timestamp_ntz").alias("file_month")).agg(F.count_distinct("cik").alias("exact"))
    # Four standard errors, and one for the smallest counts.
    return exact.join(rolled, "file_month").select("file_month", "exact", (F.abs(F.col("approx_distinct") - F.col("exact")) <= 0.065 * F.col("exact") + 1).alias("close"))


# ---- landed fields ---------------------------------------------------------------

_MESSY_DAY = "2030-01-01"


@query(
    "schema_drift",
    ctes("r", "n AS (SELECT least(count(*), 60) AS sampled FROM slv_r)")
    + f"""SELECT 'unique_id' AS path, change, CASE WHEN change = 'renamed' THEN 'unique_key' END AS renamed_from, DATE '{_MESSY_DAY}' AS ingest_date,
                 least(greatest(sampled - 30, 0), 15) AS records FROM n, (VALUES ('new'), ('renamed')) AS c(change)""",
)
def schema_drift_query(spark, sf_dir):
    """S-2: the batch with defects renames the key in 15 of its records; the census says so from the landed text alone."""
    cfg = RunConfig(f"{(root := run_dir(spark, 'drift'))}/bronze", f"{root}/warehouse")
    write_bronze(raw_requests(requests(spark, sf_dir)), cfg.bronze_root, REQUESTS.source)
    messy = messy_requests(raw_requests(silver(spark, sf_dir, REQUESTS))).drop("position", "defect")
    write_bronze(messy.withColumn(INGEST_DATE, F.lit(_MESSY_DAY).cast("date")), cfg.bronze_root, REQUESTS.source)
    drift = schema_drift(raw_lines(spark, cfg.bronze_root, REQUESTS.source), declared_paths(REQUESTS.source))
    return drift.where("change != 'missing'").select("path", "change", "renamed_from", INGEST_DATE, "records")


@query(
    "rejected_malformed",
    """SELECT 'malformed_record' AS rejection_reason, '{"sha":"m' || doc_id || '","commit":"broken ' || doc_id || '"}' AS text FROM documents WHERE doc_id % 50 = 3""",
)
def rejected_malformed(spark, sf_dir):
    """V-1: a record that can't be read has a reason of its own, and its text is kept."""
    root = run_dir(spark, "malformed")
    cfg = RunConfig(f"{root}/bronze", f"{root}/warehouse", domains={COMMITS.source: COMMITS})
    write_bronze(raw_commits(messages(spark, sf_dir)), cfg.bronze_root, COMMITS.source)
    ids = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id % 50 = 3")
    broken = ids.select(F.concat(F.lit("m"), "doc_id").alias("sha"), F.concat(F.lit("broken "), "doc_id").alias("commit"), F.lit(_MESSY_DAY).cast("date").alias(INGEST_DATE))
    write_bronze(broken, cfg.bronze_root, COMMITS.source)
    built = build(spark, COMMITS, cfg)
    return built.classified.where("rejection_reason = 'malformed_record'").select("rejection_reason", F.col(CORRUPT).alias("text"))
