"""Synthesized batches, streams and whole gated runs."""

from dataclasses import replace

from pyspark.sql import functions as F

from layerwright.operators.quality import rejection_summary
from layerwright.plans.demo import SEED, late_request, messy_commits, messy_requests
from layerwright.plans.domains import COMMITS, FILINGS, KNOWN_INTENTIONAL_FAILURES, REQUESTS
from layerwright.plans.gated import RunConfig, build_from, check, register_layers, run_report
from layerwright.session import run_dir
from layerwright.sources.bronze import read_bronze, union_by_name, write_bronze
from layerwright.streaming.available import StreamTables, ingest_available
from workload.oracle import ctes
from workload.quality_queries import silver
from workload.registry import query
from workload.staging_queries import land
from workload.standins import STANDINS, filings, messages, raw_commits, raw_filings, raw_requests, requests

# ---- synthesis ---------------------------------------------------------------

_PICKED_R = f"""picked AS (SELECT *, row_number() OVER (
    ORDER BY md5(concat_ws('|', '{SEED}', request_id, strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f'))), request_id) - 1 AS position
  FROM slv_r QUALIFY position < 60)"""


def _messy(spark, sf_dir):
    return messy_requests(raw_requests(silver(spark, sf_dir, REQUESTS)))


def _stage_some(messy, domain, kept, wanted):
    """Classified, with the bookkeeping columns kept beside the staged ones."""
    mapping = domain.mapping()
    return domain.classify(messy.select(*kept, *[mapping[c].alias(c) for c in wanted]))


@query(
    "inject_defects_requests",
    ctes("r", _PICKED_R)
    + """SELECT position, least(position // 15, 3) AS defect,
                CASE WHEN position // 15 = 2 THEN NULL ELSE cast('9' || (900000 + position) AS bigint) END AS request_id,
                CASE WHEN position // 15 = 2 THEN '9' || (900000 + position) END AS unique_id,
                CASE WHEN position // 15 = 0 THEN NULL ELSE agency END AS agency,
                CASE WHEN position // 15 = 1 THEN NULL ELSE created_at END AS created_at,
                CASE position // 15 WHEN 0 THEN 'missing_agency' WHEN 1 THEN 'missing_created_at' WHEN 2 THEN 'missing_request_id' END
                  AS rejection_reason
         FROM picked""",
)
def inject_requests(spark, sf_dir):
    """T-4, W-5, W-6: 15 rows without agency, 15 without a date, 15 with the key renamed, 15 clean."""
    return _stage_some(_messy(spark, sf_dir), REQUESTS, ("position", "defect", "unique_id"), ("request_id", "agency", "created_at"))


_PICKED_M = f"""picked AS (SELECT *, row_number() OVER (ORDER BY md5('{SEED}|' || commit_sha), commit_sha) - 1 AS position
  FROM slv_m QUALIFY position < 6)"""


@query(
    "inject_defects_commits",
    ctes("m", _PICKED_M)
    + """SELECT position, position % 3 AS defect, 'deadbeef' || lpad(to_hex(position), 32, '0') AS commit_sha,
                CASE WHEN position % 3 < 2 THEN NULL ELSE authored_at END AS authored_at,
                CASE WHEN position % 3 < 2 THEN 'missing_authored_at' END AS rejection_reason
         FROM picked""",
)
def inject_commits(spark, sf_dir):
    """T-5: nested date null, nested date dropped, clean, by turns, under fresh hashes."""
    messy = messy_commits(raw_commits(silver(spark, sf_dir, COMMITS)))
    return _stage_some(messy, COMMITS, ("position", "defect"), ("commit_sha", "authored_at"))


def _with_late_record(spark, sf_dir):
    """Raw requests, and one late copy of the first of them, dated into the tables' range."""
    rows = raw_requests(silver(spark, sf_dir, REQUESTS))
    dates = {"created_date": "2024-01-05T23:50:00.000", "closed_date": "2024-01-11T09:00:00.000"}
    return rows, late_request(rows, dates, ingest_date="2024-01-11")


@query(
    "late_record",
    ctes("r")
    + """SELECT 99999001::bigint AS request_id, timestamp '2024-01-05 23:50:00' AS created_at, timestamp '2024-01-11 09:00:00' AS closed_at,
                130::bigint AS resolution_hours, 'NYPD' AS agency, 'New York City Police Department' AS agency_name,
                'Noise - Street/Sidewalk' AS complaint_type, descriptor, borough, incident_zip, 'Closed' AS status, latitude, longitude
         FROM slv_r ORDER BY slv_r.request_id LIMIT 1""",
)
def late_row(spark, sf_dir):
    """T-6, W-7: the synthesized late record as silver sees it."""
    return REQUESTS.silver_of(REQUESTS.stage(_with_late_record(spark, sf_dir)[1]))


@query(
    "late_record_in_gold",
    ctes("r")
    + """SELECT request_date, agency, sum(request_count)::bigint AS request_count FROM gld_r GROUP BY ALL
         UNION ALL SELECT timestamp '2024-01-05', 'NYPD', 1""",
)
def late_row_in_gold(spark, sf_dir):
    """T-6, A-1: after the late record lands its grain exists, all others are as before."""
    rows = union_by_name(_with_late_record(spark, sf_dir))
    landed = REQUESTS.silver_of(REQUESTS.stage(rows))
    day = F.col("created_at").cast("date").cast("timestamp_ntz")
    return landed.groupBy(day.alias("request_date"), "agency").agg(F.count("*").alias("request_count"))


@query(
    "messy_batch_summary",
    ctes("r", _PICKED_R)
    + """SELECT CASE position // 15 WHEN 0 THEN 'missing_agency' WHEN 1 THEN 'missing_created_at' ELSE 'missing_request_id' END AS rejection_reason, count(*) AS n
         FROM picked WHERE position < 45 GROUP BY 1""",
)
def messy_summary(spark, sf_dir):
    """T-4, O-13, V-2: the messy batch lands as JSON, is read back, and quarantine explains it."""
    messy = _messy(spark, sf_dir).drop("position")
    root = f"{run_dir(spark, 'messy')}/bronze"
    # A nulled field is written as an explicit null; elsewhere an absent field is left out.
    explicit = F.col("defect") == 1
    write_bronze(messy.where(explicit).drop("defect"), root, "nyc_311", keep_nulls=True)
    write_bronze(messy.where(~explicit).drop("defect"), root, "nyc_311")
    return rejection_summary(REQUESTS.classify(REQUESTS.stage(read_bronze(spark, root, "nyc_311"))))


# ---- streams -----------------------------------------------------------------


def _stream_twice(spark, domain, raw, second, label):
    """Land and ingest in two goes, the second holding late rows and corrections."""
    root = run_dir(spark, label)
    tables = StreamTables(f"{root}/stream")
    write_bronze(raw.where(~second), f"{root}/bronze", domain.source, rebalance=False)
    ingest_available(spark, f"{root}/bronze", domain, tables)
    write_bronze(raw.where(second), f"{root}/bronze", domain.source, rebalance=False)
    return ingest_available(spark, f"{root}/bronze", domain, tables)


@query("stream_available_now", ctes("r") + "SELECT * FROM gld_r")
def stream_requests(spark, sf_dir):
    """L-5: newest wins; the second landing corrects and adds rows on days already aggregated."""
    raw = raw_requests(requests(spark, sf_dir))
    return _stream_twice(spark, REQUESTS, raw, F.pmod(F.crc32(F.coalesce("unique_key", F.lit(""))), F.lit(5)) == 0, "stream")


@query("stream_available_now_monthly", ctes("f") + "SELECT * FROM gld_f")
def stream_filings(spark, sf_dir):
    """L-5: lowest sequence wins, so an earlier month's filing can be displaced."""
    raw = raw_filings(filings(spark, sf_dir))
    return _stream_twice(spark, FILINGS, raw, F.pmod(F.crc32("_id"), F.lit(5)) == 0, "stream-filings")


@query(
    "stream_quarantine",
    ctes("m") + "SELECT commit_sha, author_name, author_email, rejection_reason FROM cls_m WHERE rejection_reason IS NOT NULL",
)
def stream_quarantine(spark, sf_dir):
    """L-5, V-1: what a stream rejects is kept with its reason."""
    raw = raw_commits(messages(spark, sf_dir))
    root = run_dir(spark, "stream-quarantine")
    write_bronze(raw, f"{root}/bronze", "github_commits")
    tables = StreamTables(f"{root}/stream")
    ingest_available(spark, f"{root}/bronze", COMMITS, tables)
    return spark.read.parquet(tables.quarantine).drop("batch_id")


# ---- layers by name ------------------------------------------------------------


def _named_layers(spark, sf_dir, domain, label):
    cfg = RunConfig("", run_dir(spark, label), domains={domain.source: domain})
    build_from(STANDINS[domain.source](spark, sf_dir), domain, cfg)
    register_layers(spark, cfg)


@query("sql_over_gold", ctes("f") + "SELECT biz_state, sum(filing_count)::bigint AS filings, max(unique_filers) AS most FROM gld_f GROUP BY biz_state")
def sql_over_gold(spark, sf_dir):
    """O-12, S-6: stored gold is queried by its layer name."""
    _named_layers(spark, sf_dir, FILINGS, "named-gold")
    return spark.sql(
        f"SELECT biz_state, sum(filing_count) AS filings, max(unique_filers) AS most FROM gold.{FILINGS.gold} GROUP BY biz_state"
    )


@query("sql_over_quarantine", ctes("m") + "SELECT rejection_reason, count(*) AS n FROM cls_m WHERE rejection_reason IS NOT NULL GROUP BY 1")
def sql_over_quarantine(spark, sf_dir):
    """V-2, O-2, O-12: why rows were rejected, straight from the quarantine table."""
    _named_layers(spark, sf_dir, COMMITS, "named-quarantine")
    return spark.sql(f"SELECT rejection_reason, count(*) AS n FROM silver.{COMMITS.quarantine} GROUP BY rejection_reason")


# ---- gated runs --------------------------------------------------------------


@query(
    "run_checks_drift",
    ctes("r")
    + f"""SELECT '{REQUESTS.recompute_check}' AS check_name, '{REQUESTS.gold}' AS table_name, count(*) AS failures, false AS passed
          FROM gld_r WHERE request_date = (SELECT min(request_date) FROM gld_r)""",
)
def run_checks_drift(spark, sf_dir):
    """V-7: stored gold whose oldest day was altered fails the recomputation, once per altered grain."""
    cfg = RunConfig("", run_dir(spark, "drift"), domains={REQUESTS.source: REQUESTS})
    built = build_from(STANDINS[REQUESTS.source](spark, sf_dir), REQUESTS, cfg)
    oldest = F.lit(built.gold.agg(F.min("request_date").cast("string")).first()[0]).cast("timestamp_ntz")
    more = (F.col("request_date") == oldest).cast("bigint")
    altered = built.gold.withColumn("request_count", F.col("request_count") + more)
    return check([replace(built, gold=altered)]).where(F.col("check_name") == REQUESTS.recompute_check)


_GOLD_ROWS = "(SELECT count(*) FROM gld_r) + (SELECT count(*) FROM gld_m) + (SELECT count(*) FROM gld_f)"


def _stages_sql(kinds: str) -> str:
    """The report expected when the rejection rates of these kinds may stop the run."""
    over = " UNION ALL ".join(f"SELECT 1 FROM cls_{k} HAVING count(rejection_reason)::double / greatest(count(*), 1) > 0.02" for k in kinds)
    later = f"CASE WHEN bad = 0 THEN 'success' ELSE 'not_started' END, CASE WHEN bad = 0 THEN {_GOLD_ROWS} ELSE 0 END FROM gate"
    return (
        ctes("rmf", f"gate AS (SELECT count(*) AS bad FROM ({over}))")
        + f"""SELECT 'preflight' AS stage, 'success' AS status, 0::bigint AS rows
              UNION ALL SELECT 'build', 'success', {_GOLD_ROWS}
              UNION ALL SELECT 'check', CASE WHEN bad = 0 THEN 'success' ELSE 'failed' END, bad FROM gate
              UNION ALL SELECT 'export', {later}
              UNION ALL SELECT 'publish', {later}"""
    )


def _run(spark, sf_dir, label, **cfg):
    bronze = land(spark, sf_dir, ["nyc_311", "github_commits", "sec_edgar_10k"], label)
    root = bronze.rsplit("/", 1)[0]
    return run_report(spark, RunConfig(bronze, f"{root}/warehouse", database="layerwright_runs", **cfg))


@query("gated_run", _stages_sql("f"))
def gated(spark, sf_dir):
    """V-9: every stage of a run whose only failures are the known ones."""
    return _run(spark, sf_dir, "run", known_failures=KNOWN_INTENTIONAL_FAILURES)


@query("gated_run_halts", _stages_sql("rmf"))
def gated_halts(spark, sf_dir):
    """V-9: two rejection rates are above the threshold, so nothing is exported or published."""
    return _run(spark, sf_dir, "halted")
