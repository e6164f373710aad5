"""SQL building blocks of the oracle: staged, silver and gold relations of the stand-ins."""

from workload.standins import FILINGS_SQL, MESSAGES_SQL, REQUESTS_SQL

_REASON = {
    "r": "CASE WHEN request_id IS NULL THEN 'missing_request_id' WHEN agency IS NULL THEN 'missing_agency'"
    " WHEN created_at IS NULL THEN 'missing_created_at' END",
    "m": "CASE WHEN commit_sha IS NULL THEN 'missing_commit_sha' WHEN authored_at IS NULL THEN 'missing_authored_at' END",
    "f": "CASE WHEN accession_number IS NULL THEN 'missing_accession_number' WHEN cik IS NULL THEN 'missing_cik'"
    " WHEN file_date IS NULL THEN 'missing_file_date' END",
}
_STAGED = {"r": REQUESTS_SQL, "m": MESSAGES_SQL, "f": FILINGS_SQL}

_SILVER = {
    "r": """
      SELECT request_id, created_at, closed_at, date_diff('hour', created_at, closed_at) AS resolution_hours,
             agency, agency_name, complaint_type, descriptor, coalesce(borough, 'UNSPECIFIED') AS borough,
             incident_zip, status, latitude, longitude
      FROM cls_r WHERE rejection_reason IS NULL
      QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY created_at DESC) = 1
    """,
    "m": """
      SELECT commit_sha, message, split_part(message, chr(10), 1) AS message_headline, author_name, author_email,
             github_login, authored_at, date_trunc('day', authored_at) AS authored_date
      FROM cls_m WHERE rejection_reason IS NULL
      QUALIFY row_number() OVER (PARTITION BY commit_sha ORDER BY authored_at DESC) = 1
    """,
    "f": """
      SELECT accession_number, form_type, file_date, period_ending, display_name, cik, biz_state, sic_code
      FROM cls_f WHERE rejection_reason IS NULL
      QUALIFY row_number() OVER (PARTITION BY accession_number ORDER BY sequence, file_date, biz_state, form_type, cik, filing_id) = 1
    """,
}


def gold_of(kind: str, silver: str) -> str:
    """The domain's aggregate over any relation shaped like its silver."""
    return {
        "r": f"""
          SELECT date_trunc('day', created_at) AS request_date, agency, agency_name, complaint_type,
                 count(*) AS request_count, avg(resolution_hours) AS avg_resolution_hours,
                 count(*) FILTER (WHERE status = 'Closed') AS closed_count,
                 count(*) FILTER (WHERE status IS DISTINCT FROM 'Closed') AS open_count
          FROM {silver} GROUP BY ALL
        """,
        "m": f"""
          SELECT authored_date, author_name, author_email, count(*) AS commit_count FROM {silver} GROUP BY ALL
        """,
        "f": f"""
          SELECT cast(date_trunc('month', file_date) AS timestamp) AS file_month,
                 coalesce(biz_state, 'UNSPECIFIED') AS biz_state, form_type,
                 count(*) AS filing_count, count(DISTINCT cik) AS unique_filers
          FROM {silver} GROUP BY ALL
        """,
    }[kind]


def ctes(kinds: str, *more: str) -> str:
    """WITH stg_x, cls_x, slv_x, gld_x for each kind (r, m, f), plus any more CTEs."""
    parts = []
    for k in kinds:
        parts += [
            f"stg_{k} AS ({_STAGED[k]})",
            f"cls_{k} AS (SELECT *, {_REASON[k]} AS rejection_reason FROM stg_{k})",
            f"slv_{k} AS ({_SILVER[k]})",
            f"gld_{k} AS ({gold_of(k, f'slv_{k}')})",
        ]
    return "WITH " + ",\n".join([*parts, *more]) + "\n"
