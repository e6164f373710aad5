"""Quarantine, rates and gates, dedup, silver and gold."""

from pyspark.sql import functions as F

from layerwright.operators.checks import not_null, unexpected_failures, unique
from layerwright.operators.dedup import keep_best, latest, lowest
from layerwright.operators.diff import recompute_diff
from layerwright.operators.quality import (
    accepted,
    over_threshold,
    rejection_gate,
    rejection_rate,
    rejection_rate_of,
    rejection_summary,
)
from layerwright.plans.domains import COMMITS, DOMAINS, FILINGS, REQUESTS
from layerwright.plans.gated import RunConfig, build_from, check, side_by_side
from layerwright.session import run_dir
from layerwright.sources.bronze import union_by_name
from workload.oracle import ctes
from workload.registry import query
from workload.standins import STANDINS, filings, messages, requests

KINDS = {"r": REQUESTS, "m": COMMITS, "f": FILINGS}
_TAGGED = "(" + " UNION ALL ".join(
    f"SELECT '{d.source}' AS domain, rejection_reason FROM cls_{k}" for k, d in KINDS.items()
) + ")"
_RATES = (
    f"SELECT domain, count(rejection_reason) AS rejected_count, count(*) AS total_count,"
    f" count(rejection_reason)::double / greatest(count(*), 1) AS rejection_rate FROM {_TAGGED} GROUP BY domain"
)


def classified(spark, sf_dir, domain):
    return domain.classify(STANDINS[domain.source](spark, sf_dir))


def tagged(spark, sf_dir):
    """All three domains' verdicts as (domain, rejection_reason)."""
    return union_by_name(
        classified(spark, sf_dir, d).select(F.lit(d.source).alias("domain"), "rejection_reason") for d in DOMAINS.values()
    )


# ---- quarantine --------------------------------------------------------------


@query(
    "rejected_requests",
    ctes("r") + "SELECT request_id, created_at, agency, complaint_type, rejection_reason FROM cls_r WHERE rejection_reason IS NOT NULL",
)
def rejected_requests(spark, sf_dir):
    return REQUESTS.rejected_of(requests(spark, sf_dir))


@query(
    "rejected_messages",
    ctes("m") + "SELECT commit_sha, author_name, author_email, rejection_reason FROM cls_m WHERE rejection_reason IS NOT NULL",
)
def rejected_messages(spark, sf_dir):
    return COMMITS.rejected_of(messages(spark, sf_dir))


@query(
    "rejected_filings",
    ctes("f") + "SELECT filing_id, accession_number, cik, rejection_reason FROM cls_f WHERE rejection_reason IS NOT NULL",
)
def rejected_filings(spark, sf_dir):
    return FILINGS.rejected_of(filings(spark, sf_dir))


@query("accepted_requests", ctes("r") + "SELECT * EXCLUDE (rejection_reason) FROM cls_r WHERE rejection_reason IS NULL")
def accepted_requests(spark, sf_dir):
    return accepted(classified(spark, sf_dir, REQUESTS))


@query("accepted_messages", ctes("m") + "SELECT * EXCLUDE (rejection_reason) FROM cls_m WHERE rejection_reason IS NULL")
def accepted_messages(spark, sf_dir):
    return accepted(classified(spark, sf_dir, COMMITS))


@query("accepted_filings", ctes("f") + "SELECT * EXCLUDE (rejection_reason) FROM cls_f WHERE rejection_reason IS NULL")
def accepted_filings(spark, sf_dir):
    return accepted(classified(spark, sf_dir, FILINGS))


@query(
    "rejection_summary",
    ctes("rmf") + f"SELECT domain, rejection_reason, count(*) AS n FROM {_TAGGED} WHERE rejection_reason IS NOT NULL GROUP BY ALL",
)
def summary(spark, sf_dir):
    return rejection_summary(tagged(spark, sf_dir), by=["domain"])


@query("rejection_rate", ctes("rmf") + _RATES)
def rate(spark, sf_dir):
    return rejection_rate(tagged(spark, sf_dir), by=["domain"])


@query("rejection_gate", ctes("rmf") + f"SELECT * FROM ({_RATES}) WHERE rejection_rate > 0.02")
def gate(spark, sf_dir):
    return rejection_gate(tagged(spark, sf_dir), by=["domain"])


_DAILY = (
    "SELECT cast(coalesce(created_at, closed_at) AS date) AS ingest_date, count(rejection_reason) AS rejected_count,"
    " count(*) AS total_count, count(rejection_reason)::double / greatest(count(*), 1) AS rejection_rate FROM cls_r GROUP BY 1"
)


def _by_landing(spark, sf_dir):
    landed = F.coalesce("created_at", "closed_at").cast("date")
    return classified(spark, sf_dir, REQUESTS).withColumn("ingest_date", landed)


@query("rejection_rate_by_batch", ctes("r") + _DAILY)
def rate_by_batch(spark, sf_dir):
    return rejection_rate(_by_landing(spark, sf_dir), by=["ingest_date"])


@query("rejection_gate_by_batch", ctes("r") + f"SELECT * FROM ({_DAILY}) WHERE rejection_rate > 0.03")
def gate_by_batch(spark, sf_dir):
    """V-4: a bad landing is not diluted by good history."""
    return rejection_gate(_by_landing(spark, sf_dir), threshold=0.03, by=["ingest_date"])


@query(
    "rejection_rate_two_tables",
    ctes("f")
    + """SELECT (SELECT count(*) FROM cls_f WHERE rejection_reason IS NOT NULL) AS rejected_count,
              (SELECT count(*) FROM stg_f) AS total_count,
              (SELECT count(*) FROM cls_f WHERE rejection_reason IS NOT NULL)::double
                / greatest((SELECT count(*) FROM stg_f), 1) AS rejection_rate""",
)
def rate_two_tables(spark, sf_dir):
    """J-5: quarantine and staging count themselves, the two counts meet."""
    staged = filings(spark, sf_dir)
    return rejection_rate_of(FILINGS.rejected_of(staged), staged)


@query("rejection_gate_passes", ctes("f") + f"SELECT * FROM ({_RATES.replace(_TAGGED, '(SELECT 1 AS domain, rejection_reason FROM cls_f)')}) WHERE rejection_rate > 0.02")
def gate_passes(spark, sf_dir):
    """P-13: filings are below the threshold, so the relation is empty."""
    rows = classified(spark, sf_dir, FILINGS).withColumn("domain", F.lit(1))
    return over_threshold(rejection_rate(rows, by=["domain"]))


# ---- dedup -------------------------------------------------------------------


@query(
    "dedup_keep_latest",
    ctes("r")
    + """SELECT * EXCLUDE (rejection_reason) FROM cls_r WHERE rejection_reason IS NULL
         QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY created_at DESC) = 1""",
)
def dedup_keep_latest(spark, sf_dir):
    return keep_best(accepted(classified(spark, sf_dir, REQUESTS)), ["request_id"], [latest("created_at")])


@query(
    "dedup_keep_lowest",
    """SELECT * FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber NULLS LAST, l_shipdate, l_partkey, l_suppkey,
         l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) = 1""",
)
def dedup_keep_lowest(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    ties = [
        "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus",
    ]
    return keep_best(items, ["l_orderkey"], [lowest("l_linenumber")], ties)


# ---- silver and gold ---------------------------------------------------------


def silver(spark, sf_dir, domain):
    return domain.silver_of(STANDINS[domain.source](spark, sf_dir))


def gold(spark, sf_dir, domain):
    return domain.gold_of(STANDINS[domain.source](spark, sf_dir))


@query("silver_requests", ctes("r") + "SELECT * FROM slv_r")
def silver_requests(spark, sf_dir):
    return silver(spark, sf_dir, REQUESTS)


@query("silver_messages", ctes("m") + "SELECT * FROM slv_m")
def silver_messages(spark, sf_dir):
    return silver(spark, sf_dir, COMMITS)


@query("silver_filings", ctes("f") + "SELECT * FROM slv_f")
def silver_filings(spark, sf_dir):
    return silver(spark, sf_dir, FILINGS)


@query("gold_daily_summary", ctes("r") + "SELECT * FROM gld_r")
def gold_daily_summary(spark, sf_dir):
    return gold(spark, sf_dir, REQUESTS)


@query("gold_activity_daily", ctes("m") + "SELECT * FROM gld_m")
def gold_activity_daily(spark, sf_dir):
    return gold(spark, sf_dir, COMMITS)


@query("gold_monthly_filers", ctes("f") + "SELECT * FROM gld_f")
def gold_monthly_filers(spark, sf_dir):
    return gold(spark, sf_dir, FILINGS)


# ---- recompute diffs ---------------------------------------------------------

_BROKEN_R = """broken AS (
  SELECT * REPLACE (CASE WHEN agency = 'error' AND complaint_type = 'T1' THEN request_count + 1 ELSE request_count END AS request_count)
  FROM gld_r WHERE NOT (agency = 'view' AND complaint_type = 'T2')
  UNION ALL
  SELECT * REPLACE ('ghost' AS agency) FROM gld_r WHERE agency = 'click' AND complaint_type = 'T0')"""

_R_MEASURES = ("request_count", "avg_resolution_hours", "closed_count", "open_count")


@query(
    "recompute_diff",
    ctes("r", _BROKEN_R)
    + "SELECT coalesce(e.request_date, a.request_date) AS request_date, coalesce(e.agency, a.agency) AS agency,"
    " coalesce(e.agency_name, a.agency_name) AS agency_name, coalesce(e.complaint_type, a.complaint_type) AS complaint_type, "
    + ", ".join(f"e.{m} AS expected_{m}, a.{m} AS actual_{m}" for m in _R_MEASURES)
    + ", CASE WHEN a.request_count IS NULL THEN 'missing' WHEN e.request_count IS NULL THEN 'extra' ELSE 'changed' END AS problem"
    " FROM gld_r e FULL JOIN broken a ON e.request_date IS NOT DISTINCT FROM a.request_date AND e.agency IS NOT DISTINCT FROM a.agency"
    " AND e.agency_name IS NOT DISTINCT FROM a.agency_name AND e.complaint_type IS NOT DISTINCT FROM a.complaint_type"
    " WHERE a.request_count IS NULL OR e.request_count IS NULL OR a.request_count <> e.request_count",
)
def diff_two_sided(spark, sf_dir):
    """V-7, J-3, T-3: changed, missing and extra grains are all found."""
    right = gold(spark, sf_dir, REQUESTS)
    bumped = (F.col("agency") == "error") & (F.col("complaint_type") == "T1")
    broken = right.withColumn("request_count", F.col("request_count") + F.when(bumped, 1).otherwise(0)).where(
        "NOT (agency = 'view' AND complaint_type = 'T2')"
    )
    ghosts = right.where("agency = 'click' AND complaint_type = 'T0'").withColumn("agency", F.lit("ghost"))
    spec = REQUESTS.spec
    return recompute_diff(right, broken.unionByName(ghosts), spec.keys, list(spec.measures))


_M_DIFF = (
    "SELECT e.authored_date, e.author_name, e.author_email, e.commit_count AS expected_commit_count,"
    " a.commit_count AS actual_commit_count, CASE WHEN a.commit_count IS NULL THEN 'missing' ELSE 'changed' END AS problem"
    " FROM gld_m e LEFT JOIN stored a ON {on} WHERE a.commit_count IS NULL OR a.commit_count <> e.commit_count"
)
_M_STORED = """stored AS (SELECT * REPLACE (commit_count + CASE WHEN author_email IS NULL AND day(authored_date) = 9 THEN 1 ELSE 0 END
  AS commit_count) FROM gld_m)"""


def _stored_messages(spark, sf_dir):
    right = gold(spark, sf_dir, COMMITS)
    touched = F.col("author_email").isNull() & (F.dayofmonth("authored_date") == 9)
    return right, right.withColumn("commit_count", F.col("commit_count") + F.when(touched, 1).otherwise(0))


@query(
    "recompute_diff_null_keys",
    ctes("m", _M_STORED)
    + _M_DIFF.format(
        on="e.authored_date IS NOT DISTINCT FROM a.authored_date AND e.author_name IS NOT DISTINCT FROM a.author_name"
        " AND e.author_email IS NOT DISTINCT FROM a.author_email"
    ),
)
def diff_null_keys(spark, sf_dir):
    """J-2, F-12: a NULL key matches itself, so only the altered rows show."""
    right, stored = _stored_messages(spark, sf_dir)
    return recompute_diff(right, stored, COMMITS.spec.keys, ["commit_count"])


@query(
    "recompute_diff_plain_keys",
    ctes("m", _M_STORED)
    + _M_DIFF.format(on="e.authored_date = a.authored_date AND e.author_name = a.author_name AND e.author_email = a.author_email"),
)
def diff_plain_keys(spark, sf_dir):
    """J-1: the one-directional plain comparison reports every NULL-key grain as missing."""
    right, stored = _stored_messages(spark, sf_dir)
    return recompute_diff(right, stored, COMMITS.spec.keys, ["commit_count"], two_sided=False, null_safe_keys=False)


# ---- column checks -----------------------------------------------------------

_CHECKED = ("request_id", "created_at", "closed_at", "agency", "agency_name", "borough", "status")


@query(
    "check_not_null",
    ctes("r")
    + "SELECT * FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS failures FROM stg_r WHERE {c} IS NULL" for c in _CHECKED)
    + ") WHERE failures > 0",
)
def check_not_null(spark, sf_dir):
    return not_null(requests(spark, sf_dir), _CHECKED)


@query(
    "check_unique",
    ctes("r") + "SELECT request_id, count(*) AS n FROM stg_r WHERE request_id IS NOT NULL GROUP BY request_id HAVING count(*) > 1",
)
def check_unique(spark, sf_dir):
    return unique(requests(spark, sf_dir), "request_id")


def all_verdicts(spark, sf_dir):
    """All 27 declared checks over the stored layers of the three stand-ins."""
    cfg = RunConfig(bronze_root="", warehouse_root=run_dir(spark, "checks"))
    return check(side_by_side(lambda d: build_from(STANDINS[d.source](spark, sf_dir), d, cfg), list(DOMAINS.values())))


def _verdict_sql():
    parts = []
    for kind, d in KINDS.items():
        relation = {
            d.silver: f"slv_{kind}",
            d.gold: f"gld_{kind}",
            d.quarantine: f"(SELECT * FROM cls_{kind} WHERE rejection_reason IS NOT NULL)",
        }
        for spec in d.checks:
            head = f"'{spec.table}' AS table_name"
            for c in spec.not_null:
                parts.append(
                    f"SELECT 'not_null_{spec.table}_{c}' AS check_name, {head}, count(*) AS failures"
                    f" FROM {relation[spec.table]} WHERE {c} IS NULL"
                )
            for c in spec.unique:
                parts.append(
                    f"SELECT 'unique_{spec.table}_{c}', '{spec.table}', count(*) FROM (SELECT {c} FROM {relation[spec.table]}"
                    f" WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
                )
        parts.append(
            f"SELECT '{d.rate_check}', '{d.staging}', count(*) FROM (SELECT 1 FROM cls_{kind}"
            f" HAVING count(rejection_reason)::double / greatest(count(*), 1) > 0.02)"
        )
        parts.append(
            f"SELECT '{d.recompute_check}', '{d.gold}', count(*) FROM (SELECT * FROM gld_{kind} EXCEPT ALL SELECT * FROM gld_{kind})"
        )
    return ctes("rmf") + "SELECT *, failures = 0 AS passed FROM (" + " UNION ALL ".join(parts) + ")"


@query("run_checks", _verdict_sql())
def run_all_checks(spark, sf_dir):
    return all_verdicts(spark, sf_dir)


@query(
    "unexpected_failures",
    ctes("mf")
    + " UNION ALL ".join(
        f"""SELECT '{d.rate_check}' AS check_name, '{d.staging}' AS table_name, count(*) AS failures, false AS passed
            FROM (SELECT 1 FROM cls_{k} HAVING count(rejection_reason)::double / greatest(count(*), 1) > 0.02) HAVING count(*) > 0"""
        for k, d in (("m", COMMITS), ("f", FILINGS))
    ),
)
def unexpected(spark, sf_dir):
    """V-8: of the failing gates only those not on the allowlist are reported."""
    return unexpected_failures(all_verdicts(spark, sf_dir), [REQUESTS.rate_check])
