"""Late records: lookback windows, replaced partitions, missed grains, repairs."""

import datetime as dt

from pyspark.sql import functions as F

from layerwright.functions import ntz_literal
from layerwright.operators.grain import PART, GrainSpec, aggregate
from layerwright.operators.incremental import (
    INTENT,
    collect_grains,
    incremental_run,
    late_grains,
    missed_grains,
    read_gold,
    repair_grains,
    since,
    watermark_frame,
    cutoff,
)
from layerwright.operators.upsert import upsert_by_key
from layerwright.plans.domains import COMMITS, DOMAINS, FILINGS, REQUESTS
from layerwright.session import run_dir
from layerwright.sources import files
from layerwright.sources.bronze import union_by_name
from layerwright.sources.catalog import write_layer
from layerwright.sources.snapshots import snapshot_read, snapshot_upsert
from workload.oracle import ctes, gold_of
from workload.quality_queries import gold, silver
from workload.registry import query
from workload.standins import REQUESTS_SQL, requests, table

# The base run stops two days before the newest one (`close`).  Some rows of the
# day two days before that (`late day`) are held back and arrive afterwards.
_SPLIT = """edge AS (SELECT date_trunc('day', max(created_at)) - INTERVAL 2 DAY AS close,
                            date_trunc('day', max(created_at)) - INTERVAL 4 DAY AS late_day,
                            date_trunc('day', max(created_at)) - INTERVAL 20 DAY AS old_day FROM slv_r)"""


def _is_held(day: str) -> str:
    return f"(s.request_id % 10 = 3 AND date_trunc('day', s.created_at) = edge.{day})"


class Scenario:
    """Stored request silver, and the part of it the first run saw."""

    def __init__(self, spark, sf_dir, label, held_day_offset):
        self.root = run_dir(spark, label)
        dated = REQUESTS.dated(silver(spark, sf_dir, REQUESTS))
        self.silver = write_layer(dated, f"{self.root}/silver", partition_by=PART)
        newest = self.silver.agg(F.max(PART)).first()[0]
        self.close = newest - dt.timedelta(days=2)
        self.held_day = newest - dt.timedelta(days=held_day_offset)
        held = (F.col("request_id") % 10 == 3) & (F.col(PART) == F.lit(self.held_day))
        self.base = self.silver.where(F.col(PART) < F.lit(self.close)).where(~held)
        self.gold_path = f"{self.root}/gold"

    def run(self, rows, **kwargs):
        return incremental_run(rows, self.gold_path, REQUESTS.spec, **kwargs)


# ---- watermark ---------------------------------------------------------------


@query(
    "watermark_cutoff",
    ctes("rmf")
    + """
    SELECT 'nyc_311' AS domain, max(request_date) AS watermark, date_trunc('day', max(request_date) - INTERVAL 3 DAY) AS cutoff FROM gld_r
    UNION ALL
    SELECT 'github_commits', max(authored_date), date_trunc('day', max(authored_date) - INTERVAL 3 DAY) FROM gld_m
    UNION ALL
    SELECT 'sec_edgar_10k', max(file_month), cast(date_trunc('month', max(file_month) - INTERVAL 3 DAY) AS timestamp) FROM gld_f
    UNION ALL
    SELECT 'empty', timestamp '1900-01-01', cast(date_trunc('month', timestamp '1899-12-29') AS timestamp)
    """,
)
def watermark_cutoff(spark, sf_dir):
    """P-12, A-6, F-4, F-5, J-6: newest grain less the lookback, aligned down to the grain."""
    frames = [
        watermark_frame(gold(spark, sf_dir, d), d.spec).select(F.lit(d.source).alias("domain"), "watermark", "cutoff")
        for d in DOMAINS.values()
    ]
    none = gold(spark, sf_dir, FILINGS).where("false")
    frames.append(watermark_frame(none, FILINGS.spec).select(F.lit("empty").alias("domain"), "watermark", "cutoff"))
    return union_by_name(frames)


@query(
    "watermark_capped",
    ctes("r")
    + "SELECT least(max(request_date), timestamp '2024-01-15') AS watermark,"
    " date_trunc('day', least(max(request_date), timestamp '2024-01-15') - INTERVAL 3 DAY) AS cutoff FROM gld_r",
)
def watermark_capped(spark, sf_dir):
    """R-8: a watermark beyond the run date is held back to it."""
    return watermark_frame(gold(spark, sf_dir, REQUESTS), REQUESTS.spec, cap="2024-01-15 00:00:00")


# ---- runs --------------------------------------------------------------------


@query("incremental_upsert", ctes("r") + "SELECT * FROM gld_r")
def incremental_upsert(spark, sf_dir):
    """O-4, O-5, L-1: late rows inside the lookback are picked up; equals a full recompute."""
    case = Scenario(spark, sf_dir, "upsert", held_day_offset=4)
    case.run(case.base)
    return case.run(case.silver)


@query(
    "incremental_no_lookback_misses",
    ctes("r", _SPLIT, f"seen AS (SELECT s.* FROM slv_r s, edge WHERE NOT {_is_held('late_day')})") + gold_of("r", "seen"),
)
def incremental_no_lookback(spark, sf_dir):
    """L-2: without a lookback the late rows stay invisible."""
    case = Scenario(spark, sf_dir, "naive", held_day_offset=4)
    case.run(case.base)
    return case.run(case.silver, lookback_days=0)


@query("incremental_full_refresh", ctes("r") + "SELECT * FROM gld_r")
def incremental_full_refresh(spark, sf_dir):
    """O-3, L-3: rows later than the window need a full refresh, which finds them."""
    case = Scenario(spark, sf_dir, "refresh", held_day_offset=20)
    case.run(case.base)
    case.run(case.silver)
    return case.run(case.silver, full_refresh=True)


_MISSED = ctes("r", _SPLIT, f"seen AS (SELECT s.* FROM slv_r s, edge WHERE NOT {_is_held('old_day')})", f"stale AS ({gold_of('r', 'seen')})")


@query(
    "missed_grains",
    _MISSED
    + "SELECT e.request_date, e.agency, e.agency_name, e.complaint_type, "
    + ", ".join(
        f"e.{m} AS expected_{m}, a.{m} AS actual_{m}" for m in ("request_count", "avg_resolution_hours", "closed_count", "open_count")
    )
    + """, CASE WHEN a.request_count IS NULL THEN 'missing' ELSE 'changed' END AS problem
    FROM gld_r e LEFT JOIN stale a ON e.request_date = a.request_date AND e.agency = a.agency
      AND e.agency_name = a.agency_name AND e.complaint_type = a.complaint_type
    WHERE a.request_count IS NULL OR a.request_count <> e.request_count""",
)
def missed(spark, sf_dir):
    """L-4: the run leaves rows older than the window out, and the audit lists exactly their grains."""
    case = Scenario(spark, sf_dir, "missed", held_day_offset=20)
    case.run(case.base)
    stored = case.run(case.silver)
    return missed_grains(case.silver, stored, REQUESTS.spec)


@query("repair_grains", ctes("r") + "SELECT * FROM gld_r")
def repair(spark, sf_dir):
    """L-4: re-aggregating only the missed dates makes gold equal a full recompute again."""
    case = Scenario(spark, sf_dir, "repair", held_day_offset=20)
    case.run(case.base)
    stored = case.run(case.silver)
    start = cutoff(stored, REQUESTS.spec)
    arrived = case.silver.join(case.base.select("request_id"), "request_id", "left_anti")
    days = collect_grains(arrived.where(F.col("created_at") < ntz_literal(start)), REQUESTS.spec)
    return repair_grains(case.silver, case.gold_path, REQUESTS.spec, days)


@query(
    "late_grains",
    ctes("r", _SPLIT) + f"SELECT DISTINCT cast(s.created_at AS date) AS grain_date FROM slv_r s, edge WHERE {_is_held('old_day')}",
)
def late(spark, sf_dir):
    """L-4 from the landing's side: dates of newly arrived rows that the next run will not reach."""
    case = Scenario(spark, sf_dir, "late", held_day_offset=20)
    stored = case.run(case.base)
    arrived = case.silver.join(case.base.select("request_id"), "request_id", "left_anti")
    return late_grains(arrived, REQUESTS.spec, cutoff(stored, REQUESTS.spec))


@query("incremental_month_aligned", ctes("f") + "SELECT * FROM gld_f")
def month_aligned(spark, sf_dir):
    """R-1: a three-day lookback over a month boundary still rebuilds whole months."""
    root = run_dir(spark, "months")
    filed = write_layer(FILINGS.dated(silver(spark, sf_dir, FILINGS)), f"{root}/silver", partition_by=PART)
    incremental_run(filed, f"{root}/gold", FILINGS.spec)
    return incremental_run(filed, f"{root}/gold", FILINGS.spec)


_MOVED = """moved AS (SELECT s.* REPLACE (CASE WHEN s.agency = 'error' AND s.created_at >= edge.close THEN 'moved' ELSE s.agency END AS agency)
  FROM slv_r s, edge)"""


@query("incremental_vanished_grain", ctes("r", _SPLIT, _MOVED) + gold_of("r", "moved"))
def vanished(spark, sf_dir):
    """R-6: requests move to another agency; the grains they leave disappear from gold."""
    case = Scenario(spark, sf_dir, "vanished", held_day_offset=4)
    case.run(case.silver)
    moving = (F.col("agency") == "error") & (F.col(PART) >= F.lit(case.close))
    return case.run(case.silver.withColumn("agency", F.when(moving, "moved").otherwise(F.col("agency"))))


@query(
    "incremental_emptied_day",
    ctes("r", _SPLIT, "kept AS (SELECT s.* FROM slv_r s, edge WHERE date_trunc('day', s.created_at) <> edge.close)") + gold_of("r", "kept"),
)
def emptied_day(spark, sf_dir):
    """R-6: a whole day inside the window loses its rows; its partition goes."""
    case = Scenario(spark, sf_dir, "emptied", held_day_offset=4)
    case.run(case.silver)
    return case.run(case.silver.where(F.col(PART) != F.lit(case.close)))


@query("incremental_null_keys", ctes("m") + "SELECT * FROM gld_m")
def null_keys(spark, sf_dir):
    """R-3: running twice over a nullable key leaves no duplicates."""
    path = f"{run_dir(spark, 'nulls')}/gold"
    rows = silver(spark, sf_dir, COMMITS)
    incremental_run(rows, path, COMMITS.spec)
    return incremental_run(rows, path, COMMITS.spec)


@query("upsert_by_key", ctes("m") + "SELECT * FROM gld_m")
def upsert(spark, sf_dir):
    """O-5, J-4, T-2: survivors plus batch on null-safe keys; the base lacks some rows of the batch's days."""
    rows = silver(spark, sf_dir, COMMITS)
    spec = COMMITS.spec
    seen = rows.where("day(authored_date) <> 14 OR author_email IS NOT NULL")
    base = aggregate(seen, spec)
    batch = aggregate(since(rows, spec, dt.datetime(2024, 1, 10)), spec)
    return upsert_by_key(base, batch, spec.keys)


@query(
    "upsert_lineitem_status",
    """
    WITH base AS (SELECT l_returnflag, l_linestatus, l_suppkey, count(*) AS n, max(l_shipdate) AS newest FROM lineitem
                  WHERE NOT (l_returnflag = 'N' AND l_linestatus = 'F') GROUP BY ALL),
         batch AS (SELECT l_returnflag, l_linestatus, l_suppkey, count(*) AS n, max(l_shipdate) AS newest FROM lineitem
                   WHERE l_linestatus = 'F' GROUP BY ALL)
    SELECT * FROM base WHERE (l_returnflag, l_linestatus, l_suppkey) NOT IN (SELECT (l_returnflag, l_linestatus, l_suppkey) FROM batch)
    UNION ALL SELECT * FROM batch
    """,
)
def upsert_lineitem(spark, sf_dir):
    """O-5 on other keys: overlapping, new and untouched keys; every row is in the base, the batch or both."""
    items = table(spark, sf_dir, "lineitem")
    keys = ["l_returnflag", "l_linestatus", "l_suppkey"]

    def mart(rows):
        return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.max("l_shipdate").alias("newest"))

    return upsert_by_key(mart(items.where("NOT (l_returnflag = 'N' AND l_linestatus = 'F')")), mart(items.where("l_linestatus = 'F'")), keys)


@query("upsert_into_snapshot", ctes("r") + "SELECT * FROM gld_r")
def upsert_snapshot(spark, sf_dir):
    """O-5, O-6: the base export lacks the newest days; the batch brings them as the next version."""
    path = f"{run_dir(spark, 'upserted')}/{REQUESTS.gold}"
    mart = gold(spark, sf_dir, REQUESTS)
    start = cutoff(mart, REQUESTS.spec)
    stale = mart.withColumn("request_count", F.when(F.col("request_date") < ntz_literal(start), F.col("request_count")).otherwise(0))
    snapshot_upsert(stale.where("agency <> 'view' OR complaint_type <> 'T1' OR request_count > 0"), path, REQUESTS.spec.keys, REQUESTS.gold)
    snapshot_upsert(mart.where(F.col("request_date") >= ntz_literal(start)), path, REQUESTS.spec.keys, REQUESTS.gold)
    return snapshot_read(spark, path)


@query("gold_read_back", ctes("r") + "SELECT * FROM gld_r WHERE request_date >= timestamp '2024-01-10'")
def gold_read_back(spark, sf_dir):
    """O-5: stored gold shows its DATE partitions as timestamps, and a date filter prunes them."""
    path = f"{run_dir(spark, 'readback')}/gold"
    incremental_run(silver(spark, sf_dir, REQUESTS), path, REQUESTS.spec)
    return read_gold(spark, path, REQUESTS.spec).where(F.col("request_date") >= ntz_literal("2024-01-10 00:00:00"))


# ---- runs on awkward input ---------------------------------------------------


@query("incremental_after_broken_run", ctes("r") + "SELECT * FROM gld_r")
def incremental_after_broken_run(spark, sf_dir):
    """O-4: a first run lost its driver while it moved partitions; the next one finishes its scope, old dates included."""
    case = Scenario(spark, sf_dir, "broken", held_day_offset=4)
    case.run(case.silver)
    oldest = min(files.partition_values(spark, case.gold_path, PART))
    files.delete(spark, f"{case.gold_path}/{PART}={oldest}")
    files.write_text(spark, f"{case.gold_path}/{INTENT}", '{"since": null}')
    return case.run(case.silver)


_BY_AGENCY = GrainSpec("day", "created_at", "day", {"agency": "agency"})


@query(
    "incremental_null_dates",
    f"SELECT date_trunc('day', created_at) AS day, agency, count(*) AS n FROM ({REQUESTS_SQL}) GROUP BY ALL",
)
def incremental_null_dates(spark, sf_dir):
    """O-5: rows without a date keep their grain in every run, and new ones join it."""
    rows = requests(spark, sf_dir)
    rows = rows.withColumn(PART, _BY_AGENCY.grain_date("created_at"))
    path = f"{run_dir(spark, 'null-dates')}/gold"
    incremental_run(rows.where("NOT (created_at IS NULL AND request_id % 2 = 0)"), path, _BY_AGENCY)
    return incremental_run(rows, path, _BY_AGENCY)


# Years beyond 9999 can't travel as Python dates, so the answer names their parts.
def by_calendar(day: str) -> list[str]:
    return [f"cast(year({day}) AS bigint) AS year", f"cast(month({day}) AS bigint) AS month", f"cast(day({day}) AS bigint) AS day"]


FAR_YEARS = 18216  # 2024 becomes 20240


@query(
    "incremental_far_future_date",
    ctes("r", f"moved AS (SELECT agency, CASE WHEN request_id % 500 = 7 THEN created_at + INTERVAL {FAR_YEARS} YEAR ELSE created_at END AS moment FROM slv_r)")
    + f"SELECT {', '.join(by_calendar('moment'))}, agency, count(*) AS n FROM moved GROUP BY ALL",
)
def incremental_far_future_date(spark, sf_dir):
    """P-12: a stored grain in year 20240 neither stops the next run nor, with a cap, hides the normal days from it."""
    far = F.expr(f"CASE WHEN request_id % 500 = 7 THEN created_at + INTERVAL {FAR_YEARS} YEAR ELSE created_at END")
    rows = silver(spark, sf_dir, REQUESTS).withColumn("created_at", far)
    rows = rows.withColumn(PART, _BY_AGENCY.grain_date("created_at"))
    path = f"{run_dir(spark, 'far-future')}/gold"
    close = rows.where("year(created_at) < 9999").agg(F.date_sub(F.max("created_at").cast("date"), 2).cast("string")).first()[0]
    arrived = (F.col("created_at") < ntz_literal(close)) | (F.year("created_at") > 9999)
    incremental_run(rows.where(arrived), path, _BY_AGENCY)
    gold_rows = incremental_run(rows, path, _BY_AGENCY, cap=close)
    return gold_rows.selectExpr(*by_calendar("day"), "agency", "n")
