"""Bronze and staging: scans, merges, renames, nested access, safe casts."""

from pyspark.sql import functions as F

from layerwright.functions import trunc_ntz
from layerwright.operators.staging import stage
from layerwright.plans.domains import COMMITS, FILINGS, REQUESTS
from layerwright.plans.gated import side_by_side
from layerwright.session import run_dir
from layerwright.sources import files
from layerwright.sources.bronze import check_bronze, read_bronze, union_by_name, write_bronze
from layerwright.sources.catalog import as_view
from workload.oracle import ctes
from workload.registry import query
from workload.standins import RAW, STANDINS, filings, messages, raw_commits, raw_filings, raw_requests, requests, table


@query(
    "staging_safe_cast",
    """
    WITH raw AS (
      SELECT event_id, value,
             CASE WHEN event_id % 53 = 1 THEN 'x' || event_id WHEN event_id % 59 = 2 THEN event_id || '.5'
                  ELSE cast(event_id AS varchar) END AS unique_key,
             CASE WHEN event_id % 61 = 3 THEN 'not a date' WHEN event_id % 67 = 4 THEN '2024-01'
                  ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS created_date,
             strftime(ts, '%Y-%m-%d') AS closed_date,
             CASE WHEN event_id % 71 = 5 THEN '1.5d' ELSE cast(value AS varchar) END AS latitude,
             CASE WHEN event_id % 73 = 6 THEN 'west' WHEN event_id % 79 = 7 THEN '' ELSE cast(-value AS varchar) END AS longitude
      FROM events)
    SELECT event_id, try_cast(unique_key AS bigint) AS request_id, try_cast(created_date AS timestamp) AS created_at,
           try_cast(closed_date AS timestamp) AS closed_at, try_cast(latitude AS double) AS latitude,
           try_cast(longitude AS double) AS longitude
    FROM raw
    """,
)
def staging_safe_cast(spark, sf_dir):
    """P-1, P-4: ids, dates and numbers arrive as text, some malformed."""
    raw = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "CASE WHEN event_id % 53 = 1 THEN concat('x', event_id) WHEN event_id % 59 = 2 THEN concat(event_id, '.5')"
        " ELSE cast(event_id AS string) END AS unique_key",
        "CASE WHEN event_id % 61 = 3 THEN 'not a date' WHEN event_id % 67 = 4 THEN '2024-01'"
        " ELSE date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") END AS created_date",
        "date_format(ts, 'yyyy-MM-dd') AS closed_date",
        "CASE WHEN event_id % 71 = 5 THEN '1.5d' ELSE cast(value AS string) END AS latitude",
        "CASE WHEN event_id % 73 = 6 THEN 'west' WHEN event_id % 79 = 7 THEN '' ELSE cast(-value AS string) END AS longitude",
    )
    casts = REQUESTS.mapping()
    wanted = ("request_id", "created_at", "closed_at", "latitude", "longitude")
    return stage(raw, {"event_id": F.col("event_id"), **{c: casts[c] for c in wanted}})


@query(
    "staging_nested_fields",
    """
    SELECT event_id, cast(json_extract(props, '$.k') AS bigint) AS k, event_type AS actor_kind, user_id AS actor_id,
           date_trunc('day', ts) AS happened_on
    FROM events
    """,
)
def staging_nested_fields(spark, sf_dir):
    """P-2, F-13, F-14: fields two levels down, and a JSON object held as text."""
    nested = table(spark, sf_dir, "events").select(
        "event_id",
        F.struct(
            F.from_json("props", "k bigint").alias("props"),
            F.struct(F.col("event_type").alias("kind"), F.col("user_id").alias("id")).alias("actor"),
            F.col("ts"),
        ).alias("body"),
    )
    return stage(
        nested,
        {
            "event_id": F.col("event_id"),
            "k": F.col("body.props.k"),
            "actor_kind": F.col("body.actor.kind"),
            "actor_id": F.col("body.actor.id"),
            "happened_on": trunc_ntz("day", "body.ts"),
        },
    )


@query("staging_commits", ctes("m") + "SELECT * FROM stg_m")
def staging_commits(spark, sf_dir):
    """P-1, P-2, P-4: nested commit records to flat, typed columns."""
    return COMMITS.stage(raw_commits(messages(spark, sf_dir)))


@query("staging_first_element", ctes("f") + "SELECT * FROM stg_f")
def staging_first_element(spark, sf_dir):
    """P-3, F-13: filing records whose arrays may be empty."""
    return FILINGS.stage(raw_filings(filings(spark, sf_dir)))


@query(
    "bronze_union_by_name",
    """
    SELECT event_id, ts, event_type, NULL::bigint AS user_id, NULL::double AS value FROM events WHERE event_id % 2 = 0
    UNION ALL
    SELECT event_id, ts, NULL, user_id, value FROM events WHERE event_id % 2 = 1
    """,
)
def bronze_union_by_name(spark, sf_dir):
    """S-2, T-1: two feeds with different columns become one."""
    events = table(spark, sf_dir, "events")
    even = events.where("event_id % 2 = 0").select("event_id", "ts", "event_type")
    odd = events.where("event_id % 2 = 1").select("value", "user_id", "ts", "event_id")
    return union_by_name([even, odd])


def land(spark, sf_dir, sources, label):
    """Write the stand-ins as JSON landings; answers the bronze root."""
    root = f"{run_dir(spark, label)}/bronze"
    side_by_side(lambda s: write_bronze(RAW[s](STANDINS[s](spark, sf_dir)), root, s, rebalance=False), sources)
    return root


@query("bronze_json_roundtrip", ctes("r") + "SELECT * FROM stg_r")
def bronze_json_roundtrip(spark, sf_dir):
    """S-1, S-3, S-4, O-13: land as JSON by date, read back by registry name, stage."""
    root = land(spark, sf_dir, ["nyc_311"], "roundtrip")
    return REQUESTS.stage(read_bronze(spark, root, "nyc_311"))


@query(
    "bronze_by_landing",
    ctes("r")
    + """SELECT cast(coalesce(created_at, closed_at, timestamp '2024-01-01') AS date) AS ingest_date, agency, count(*) AS n
         FROM stg_r GROUP BY ALL""",
)
def bronze_by_landing(spark, sf_dir):
    """S-3: the landing date is kept as lineage and comes from the folder name, not from the records."""
    root = land(spark, sf_dir, ["nyc_311"], "landing")
    return read_bronze(spark, root, "nyc_311").groupBy("ingest_date", "agency").agg(F.count("*").alias("n"))


@query(
    "bronze_preflight",
    """
    SELECT 'nyc_311' AS source, cast(max(ts) AS date) AS ingest_date, 0::bigint AS length, 'empty_file' AS problem FROM events
    UNION ALL
    SELECT 'sec_edgar_10k', NULL, NULL, 'no_files'
    """,
)
def bronze_preflight(spark, sf_dir):
    """S-5: an empty file on the newest date and a source that never landed are both found."""
    events = table(spark, sf_dir, "events")
    root = f"{run_dir(spark, 'preflight')}/bronze"
    dated = events.select(
        F.col("event_id").cast("string").alias("unique_key"),
        F.col("event_type").alias("agency"),
        F.col("ts").cast("date").alias("ingest_date"),
    )
    write_bronze(dated, root, "nyc_311")
    last = events.agg(F.max("ts").cast("date").alias("d")).first()["d"]
    files.create_empty(spark, f"{root}/nyc_311/ingest_date={last}/broken.jsonl")
    found = check_bronze(spark, root, ["nyc_311", "sec_edgar_10k"])
    date = F.regexp_extract("path", r"ingest_date=([0-9-]+)/", 1).try_cast("date")
    return found.select("source", date.alias("ingest_date"), "length", "problem")


@query(
    "staging_view",
    ctes("r") + "SELECT agency, count(*) AS n, count(closed_at) AS closed FROM stg_r WHERE status IS NOT NULL GROUP BY agency",
)
def staging_view(spark, sf_dir):
    """O-1, S-6: staging as a view, computed when SQL reads it."""
    as_view(REQUESTS.stage(raw_requests(requests(spark, sf_dir))), REQUESTS.staging)
    return spark.sql(f"SELECT agency, count(*) AS n, count(closed_at) AS closed FROM {REQUESTS.staging} WHERE status IS NOT NULL GROUP BY agency")


@query("staging_requests", ctes("r") + "SELECT * FROM stg_r")
def staging_requests(spark, sf_dir):
    """P-1, P-4: flat request records, all text, to typed columns."""
    return REQUESTS.stage(raw_requests(requests(spark, sf_dir)))
