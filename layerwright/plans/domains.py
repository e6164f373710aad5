"""The three domains as declarations over the generic operators.

(fixed values: relation, column and reason names, sentinels, key and grain
columns; they are the interface users query)
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.functions import (
    fill,
    first_element,
    headline,
    hours_between,
    safe_bigint,
    safe_date,
    safe_double,
    safe_timestamp,
    trunc_ntz,
)
from layerwright.operators.checks import TableChecks
from layerwright.operators.dedup import keep_best, keep_best_stored, latest, lowest
from layerwright.operators.grain import PART, GrainSpec, aggregate
from layerwright.operators.quality import MALFORMED, classify, rejected, required, valid
from layerwright.operators.staging import stage
from layerwright.sources.bronze import CORRUPT


@dataclass(frozen=True)
class Domain:
    source: str
    staging: str
    silver: str
    quarantine: str
    gold: str
    mapping: Callable[[], Mapping[str, Column]]
    not_null: Sequence[str]
    quarantine_columns: Sequence[str]
    event_col: str
    key: str
    best: Callable[[], Sequence[Column]]
    # Ties in `best` are settled by the staged columns gold depends on, then by the rest.
    gold_ties: Sequence[str]
    other_ties: Sequence[str]
    conform: Callable[[], Mapping[str, Column]]
    spec: GrainSpec
    checks: Sequence[TableChecks]
    rate_check: str
    recompute_check: str
    comments: Mapping[str, str]
    gold_columns: Mapping[str, str] = field(default_factory=dict)
    # True when the newest date wins: then only later dates can displace a row.
    newest_wins: bool = True

    # -- the layers, each a DataFrame of the one before --

    def stage(self, bronze: DataFrame, lineage: Sequence[str] = ()) -> DataFrame:
        """The staging relation; `lineage` columns (the landing date) may ride along."""
        return stage(bronze, {**self.mapping(), **_columns(*lineage)})

    def staging_rules(self) -> str:
        """What staged rows depend on besides their source: a change calls for staging them again."""
        return f"{self.mapping()} {list(self.not_null)} {MALFORMED}"

    def classify(self, staged: DataFrame) -> DataFrame:
        """With the reason of each rejected row; rows staged with their unreadable text keep it."""
        return classify(staged, required(*self.not_null), CORRUPT if CORRUPT in staged.columns else None)

    def valid(self, staged: DataFrame) -> DataFrame:
        return valid(staged, required(*self.not_null))

    def to_silver(self, good: DataFrame, for_gold: bool = False, stored: bool = False) -> DataFrame:
        """One conformed row per key.

        for_gold=True stops the tie-break at the columns gold depends on: rows
        still tied there add the same to gold whichever is kept, and columns
        gold does not read (a message text, say) are pruned from the scan and
        the shuffle instead of being carried along to break ties.  stored=True says
        that the rows can be read twice: those whose key is unique need not move.
        """
        ties = list(self.gold_ties) if for_gold else [*self.gold_ties, *self.other_ties]
        keep = keep_best_stored if stored else keep_best
        return stage(keep(good, [self.key], self.best(), ties), self.conform())

    def silver_of(self, staged: DataFrame) -> DataFrame:
        return self.to_silver(self.valid(staged))

    def gold_of(self, staged: DataFrame) -> DataFrame:
        """Gold straight from staged rows, without storing silver in between."""
        return aggregate(self.to_silver(self.valid(staged), for_gold=True), self.spec)

    def rejected_of(self, staged: DataFrame) -> DataFrame:
        return rejected(self.classify(staged), self.quarantine_columns)

    def dated(self, rows: DataFrame) -> DataFrame:
        """Rows as they are stored: with the grain date they are partitioned by."""
        return rows.withColumn(PART, self.spec.grain_date(self.event_col))


def _columns(*names: str) -> dict[str, Column]:
    return {n: F.col(n) for n in names}


REQUESTS = Domain(
    source="nyc_311",
    staging="stg_nyc_311",
    silver="slv_311_requests",
    quarantine="rejected_311_requests",
    gold="gold_311_daily_agency_summary",
    mapping=lambda: {
        "request_id": safe_bigint("unique_key"),
        "created_at": safe_timestamp("created_date"),
        "closed_at": safe_timestamp("closed_date"),
        **_columns("agency", "agency_name", "complaint_type", "descriptor", "borough", "incident_zip", "status"),
        "latitude": safe_double("latitude"),
        "longitude": safe_double("longitude"),
    },
    not_null=("request_id", "agency", "created_at"),
    quarantine_columns=("request_id", "created_at", "agency", "complaint_type"),
    event_col="created_at",
    key="request_id",
    best=lambda: [latest("created_at")],
    gold_ties=("closed_at", "agency", "agency_name", "complaint_type", "status"),
    other_ties=("descriptor", "borough", "incident_zip", "latitude", "longitude"),
    conform=lambda: {
        **_columns("request_id", "created_at", "closed_at"),
        "resolution_hours": hours_between("created_at", "closed_at"),
        **_columns("agency", "agency_name", "complaint_type", "descriptor"),
        "borough": fill("borough"),
        **_columns("incident_zip", "status", "latitude", "longitude"),
    },
    spec=GrainSpec(
        date_name="request_date",
        date_col="created_at",
        grain="day",
        dims={"agency": "agency", "agency_name": "agency_name", "complaint_type": "complaint_type"},
        measures={
            "request_count": "count(*)",
            "avg_resolution_hours": "avg(resolution_hours)",
            "closed_count": "count_if(status = 'Closed')",
            "open_count": "count_if(status IS DISTINCT FROM 'Closed')",
        },
    ),
    checks=(
        TableChecks("slv_311_requests", not_null=("request_id", "created_at", "agency"), unique=("request_id",)),
        TableChecks("rejected_311_requests", not_null=("rejection_reason",)),
        TableChecks("gold_311_daily_agency_summary", not_null=("request_date", "agency", "request_count")),
    ),
    rate_check="assert_311_rejection_rate_below_threshold",
    recompute_check="assert_gold_311_matches_full_recompute",
    comments={
        "slv_311_requests": "One row per service request, the latest per request_id.",
        "rejected_311_requests": "Requests missing an id, agency or creation time, with the reason.",
        "gold_311_daily_agency_summary": "One row per day, agency, agency name and complaint type.",
    },
    gold_columns={
        "request_date": "Day the requests were created",
        "avg_resolution_hours": "Mean hours from creation to closing, open requests left out",
        "open_count": "Requests not closed, including those without a status",
    },
)

COMMITS = Domain(
    source="github_commits",
    staging="stg_github_commits",
    silver="slv_commits",
    quarantine="rejected_commits",
    gold="gold_commit_activity_daily",
    mapping=lambda: {
        "commit_sha": F.col("sha"),
        "message": F.col("commit.message"),
        "author_name": F.col("commit.author.name"),
        "author_email": F.col("commit.author.email"),
        "authored_at": safe_timestamp("commit.author.date"),
        "github_login": F.col("author.login"),
    },
    not_null=("commit_sha", "authored_at"),
    quarantine_columns=("commit_sha", "author_name", "author_email"),
    event_col="authored_at",
    key="commit_sha",
    best=lambda: [latest("authored_at")],
    gold_ties=("author_name", "author_email"),
    other_ties=("github_login", "message"),
    conform=lambda: {
        **_columns("commit_sha", "message"),
        "message_headline": headline("message"),
        **_columns("author_name", "author_email", "github_login", "authored_at"),
        "authored_date": trunc_ntz("day", "authored_at"),
    },
    spec=GrainSpec(
        date_name="authored_date",
        date_col="authored_date",
        grain="day",
        dims={"author_name": "author_name", "author_email": "author_email"},
        measures={"commit_count": "count(*)"},
    ),
    checks=(
        TableChecks("slv_commits", not_null=("commit_sha", "authored_at"), unique=("commit_sha",)),
        TableChecks("rejected_commits", not_null=("rejection_reason",)),
        TableChecks("gold_commit_activity_daily", not_null=("authored_date", "commit_count")),
    ),
    rate_check="assert_commits_rejection_rate_below_threshold",
    recompute_check="assert_gold_commits_matches_full_recompute",
    comments={
        "slv_commits": "One row per commit SHA.",
        "rejected_commits": "Commits missing a SHA or an authoring time, with the reason.",
        "gold_commit_activity_daily": "One row per day and author.",
    },
    gold_columns={"authored_date": "Day of authoring", "commit_count": "Commits by this author on this day"},
)

FILINGS = Domain(
    source="sec_edgar_10k",
    staging="stg_sec_edgar_filings",
    silver="slv_sec_filings",
    quarantine="rejected_sec_filings",
    gold="gold_sec_filings_by_state_month",
    mapping=lambda: {
        "filing_id": F.col("_id"),
        "accession_number": F.col("_source.adsh"),
        "form_type": F.col("_source.form"),
        "file_date": safe_date("_source.file_date"),
        "period_ending": F.col("_source.period_ending"),
        "sequence": safe_bigint("_source.sequence"),
        "display_name": first_element("_source.display_names"),
        "cik": first_element("_source.ciks"),
        "biz_state": first_element("_source.biz_states"),
        "sic_code": first_element("_source.sics"),
        "file_type": F.col("_source.file_type"),
    },
    not_null=("accession_number", "cik", "file_date"),
    quarantine_columns=("filing_id", "accession_number", "cik"),
    event_col="file_date",
    key="accession_number",
    best=lambda: [lowest("sequence")],
    gold_ties=("file_date", "biz_state", "form_type", "cik"),
    other_ties=("filing_id", "period_ending", "display_name", "sic_code", "file_type"),
    conform=lambda: _columns(
        "accession_number", "form_type", "file_date", "period_ending", "display_name", "cik", "biz_state", "sic_code"
    ),
    spec=GrainSpec(
        date_name="file_month",
        date_col="file_date",
        grain="month",
        dims={"biz_state": "coalesce(biz_state, 'UNSPECIFIED')", "form_type": "form_type"},
        measures={"filing_count": "count(*)", "unique_filers": "count(DISTINCT cik)"},
    ),
    checks=(
        TableChecks("slv_sec_filings", not_null=("accession_number", "cik", "file_date"), unique=("accession_number",)),
        TableChecks("rejected_sec_filings", not_null=("rejection_reason",)),
        TableChecks("gold_sec_filings_by_state_month", not_null=("file_month", "filing_count")),
    ),
    rate_check="assert_sec_filings_rejection_rate_below_threshold",
    recompute_check="assert_gold_sec_filings_matches_full_recompute",
    comments={
        "slv_sec_filings": "One row per accession number, the primary document.",
        "rejected_sec_filings": "Filings missing an accession number, CIK or filing date, with the reason.",
        "gold_sec_filings_by_state_month": "One row per month, business state and form type.",
    },
    gold_columns={"file_month": "First day of the filing month", "unique_filers": "Distinct CIKs among the filings"},
    newest_wins=False,
)

DOMAINS: dict[str, Domain] = {d.source: d for d in (REQUESTS, COMMITS, FILINGS)}

# Checks that demonstrate the gate and fail on purpose on messy input (fixed values).
KNOWN_INTENTIONAL_FAILURES = (REQUESTS.rate_check, COMMITS.rate_check)
