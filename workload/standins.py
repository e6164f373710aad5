"""The three domains played by the driver's tables.

The tables are clean, so defects follow fixed arithmetic rules on the ids.
`*_sql` is the same relation in SQL, for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- staged relations --------------------------------------------------------


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as service requests: 3.19 % defective; every 20th is corrected an hour later."""
    events = table(spark, sf_dir, "events")
    first = events.selectExpr(
        "CASE WHEN event_id % 97 = 5 THEN NULL ELSE event_id END AS request_id",
        "CASE WHEN event_id % 89 = 7 THEN NULL ELSE ts END AS created_at",
        "CASE WHEN event_id % 3 = 0 THEN NULL ELSE ts + (event_id % 100) * INTERVAL '37' MINUTE END AS closed_at",
        "CASE WHEN event_id % 83 = 11 THEN NULL ELSE event_type END AS agency",
        "upper(event_type) AS agency_name",
        "concat('T', cast(user_id % 7 AS string)) AS complaint_type",
        "concat(event_type, '/', cast(user_id % 3 AS string)) AS descriptor",
        "CASE WHEN user_id % 10 = 0 THEN NULL ELSE concat('B', cast(user_id % 5 AS string)) END AS borough",
        "cast(10000 + user_id % 500 AS string) AS incident_zip",
        "CASE WHEN event_id % 3 <> 0 THEN 'Closed' WHEN event_id % 2 = 0 THEN 'Open' END AS status",
        "value AS latitude",
        "-value AS longitude",
    )
    corrected = events.where("event_id % 20 = 0").selectExpr(
        "event_id AS request_id",
        "ts + INTERVAL '1' HOUR AS created_at",
        "cast(NULL AS timestamp_ntz) AS closed_at",
        "event_type AS agency",
        "upper(event_type) AS agency_name",
        "concat('T', cast(user_id % 7 AS string)) AS complaint_type",
        "concat(event_type, '/', cast(user_id % 3 AS string)) AS descriptor",
        "concat('B', cast(user_id % 5 AS string)) AS borough",
        "cast(10000 + user_id % 500 AS string) AS incident_zip",
        "'Open' AS status",
        "value AS latitude",
        "-value AS longitude",
    )
    return first.unionByName(corrected)


REQUESTS_SQL = """
  SELECT CASE WHEN event_id % 97 = 5 THEN NULL ELSE event_id END AS request_id,
         CASE WHEN event_id % 89 = 7 THEN NULL ELSE ts END AS created_at,
         CASE WHEN event_id % 3 = 0 THEN NULL ELSE ts + (event_id % 100) * INTERVAL '37' MINUTE END AS closed_at,
         CASE WHEN event_id % 83 = 11 THEN NULL ELSE event_type END AS agency,
         upper(event_type) AS agency_name,
         'T' || (user_id % 7) AS complaint_type,
         event_type || '/' || (user_id % 3) AS descriptor,
         CASE WHEN user_id % 10 = 0 THEN NULL ELSE 'B' || (user_id % 5) END AS borough,
         cast(10000 + user_id % 500 AS varchar) AS incident_zip,
         CASE WHEN event_id % 3 <> 0 THEN 'Closed' WHEN event_id % 2 = 0 THEN 'Open' END AS status,
         value AS latitude, -value AS longitude
  FROM events
  UNION ALL
  SELECT event_id, ts + INTERVAL '1' HOUR, NULL, event_type, upper(event_type), 'T' || (user_id % 7),
         event_type || '/' || (user_id % 3), 'B' || (user_id % 5), cast(10000 + user_id % 500 AS varchar),
         'Open', value, -value
  FROM events WHERE event_id % 20 = 0
"""


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as commits: 3.1 % defective; author_email is a nullable grain key."""
    return table(spark, sf_dir, "documents").selectExpr(
        "CASE WHEN doc_id % 61 = 3 THEN NULL ELSE concat('d', cast(doc_id AS string)) END AS commit_sha",
        "text AS message",
        "source AS author_name",
        "CASE WHEN doc_id % 13 = 0 THEN NULL ELSE concat(source, '@x') END AS author_email",
        "CASE WHEN doc_id % 71 = 4 THEN NULL ELSE timestamp_ntz'2024-01-01 00:00:00'"
        " + (doc_id % 45) * INTERVAL '1' DAY + (doc_id % 1440) * INTERVAL '1' MINUTE END AS authored_at",
        "lang AS github_login",
    )


MESSAGES_SQL = """
  SELECT CASE WHEN doc_id % 61 = 3 THEN NULL ELSE 'd' || doc_id END AS commit_sha,
         text AS message, source AS author_name,
         CASE WHEN doc_id % 13 = 0 THEN NULL ELSE source || '@x' END AS author_email,
         CASE WHEN doc_id % 71 = 4 THEN NULL
              ELSE timestamp '2024-01-01 00:00:00' + (doc_id % 45) * INTERVAL '1' DAY
                   + (doc_id % 1440) * INTERVAL '1' MINUTE END AS authored_at,
         lang AS github_login
  FROM documents
"""


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with its order as filings: 1.76 % defective, many documents per filing."""
    items = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return items.join(orders, items.l_orderkey == orders.o_orderkey).selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS filing_id",
        "CASE WHEN l_orderkey % 101 = 9 THEN NULL ELSE cast(l_orderkey AS string) END AS accession_number",
        "o_orderpriority AS form_type",
        "cast(l_shipdate AS date) AS file_date",
        "cast(cast(o_orderdate AS date) AS string) AS period_ending",
        "cast(l_linenumber AS bigint) AS sequence",
        "concat('Filer ', cast(o_custkey AS string)) AS display_name",
        "CASE WHEN o_custkey % 113 = 1 THEN NULL ELSE cast(o_custkey AS string) END AS cik",
        "CASE WHEN o_custkey % 17 = 0 THEN NULL ELSE concat('S', cast(o_custkey % 9 AS string)) END AS biz_state",
        "cast(l_partkey % 1000 AS string) AS sic_code",
        "concat(l_returnflag, l_linestatus) AS file_type",
    )


FILINGS_SQL = """
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS filing_id,
         CASE WHEN l_orderkey % 101 = 9 THEN NULL ELSE cast(l_orderkey AS varchar) END AS accession_number,
         o_orderpriority AS form_type, cast(l_shipdate AS date) AS file_date,
         cast(cast(o_orderdate AS date) AS varchar) AS period_ending,
         cast(l_linenumber AS bigint) AS sequence,
         'Filer ' || o_custkey AS display_name,
         CASE WHEN o_custkey % 113 = 1 THEN NULL ELSE cast(o_custkey AS varchar) END AS cik,
         CASE WHEN o_custkey % 17 = 0 THEN NULL ELSE 'S' || (o_custkey % 9) END AS biz_state,
         cast(l_partkey % 1000 AS varchar) AS sic_code,
         l_returnflag || l_linestatus AS file_type
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

STANDINS = {"nyc_311": requests, "github_commits": messages, "sec_edgar_10k": filings}


# ---- the same rows as they would land in bronze --------------------------------


def _text(c: str):
    return F.col(c).cast("string")


def _clock(c: str):
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def raw_requests(staged: DataFrame) -> DataFrame:
    plain = ("agency", "agency_name", "complaint_type", "descriptor", "borough", "incident_zip", "status")
    return staged.select(
        _text("request_id").alias("unique_key"),
        _clock("created_at").alias("created_date"),
        _clock("closed_at").alias("closed_date"),
        *plain,
        _text("latitude").alias("latitude"),
        _text("longitude").alias("longitude"),
        # Rows without a creation time still land on some day.
        F.coalesce(F.col("created_at"), F.col("closed_at"), F.lit("2024-01-01").cast("timestamp_ntz")).cast("date").alias("ingest_date"),
    )


def raw_commits(staged: DataFrame) -> DataFrame:
    author = F.struct(
        F.col("author_name").alias("name"), F.col("author_email").alias("email"), _clock("authored_at").alias("date")
    )
    return staged.select(
        F.col("commit_sha").alias("sha"),
        F.struct(F.col("message").alias("message"), author.alias("author")).alias("commit"),
        F.struct(F.col("github_login").alias("login")).alias("author"),
        F.coalesce(F.col("authored_at"), F.lit("2024-01-01").cast("timestamp_ntz")).cast("date").alias("ingest_date"),
    )


def _listed(c: str):
    """One-element array; empty for NULL."""
    return F.when(F.col(c).isNull(), F.array().cast("array<string>")).otherwise(F.array(c))


def raw_filings(staged: DataFrame) -> DataFrame:
    body = F.struct(
        F.col("accession_number").alias("adsh"),
        F.col("form_type").alias("form"),
        _text("file_date").alias("file_date"),
        F.col("period_ending"),
        _text("sequence").alias("sequence"),
        _listed("display_name").alias("display_names"),
        _listed("cik").alias("ciks"),
        _listed("biz_state").alias("biz_states"),
        _listed("sic_code").alias("sics"),
        F.col("file_type"),
    )
    return staged.select(F.col("filing_id").alias("_id"), body.alias("_source"), F.trunc("file_date", "YEAR").alias("ingest_date"))


RAW = {"nyc_311": raw_requests, "github_commits": raw_commits, "sec_edgar_10k": raw_filings}
