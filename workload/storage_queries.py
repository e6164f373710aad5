"""Snapshots, exports and publication."""

from pyspark.sql import functions as F

from layerwright.plans.domains import COMMITS, DOMAINS, FILINGS, REQUESTS
from layerwright.session import run_dir
from layerwright.sources.bronze import read_parquet, union_by_name
from layerwright.sources.catalog import create_layers, described_columns, publish, publish_all
from layerwright.sources.snapshots import (
    published_versions,
    read_published,
    snapshot_all,
    snapshot_read,
    snapshot_write,
    total_rows,
    versions,
)
from workload.oracle import ctes
from workload.quality_queries import gold
from workload.registry import query

DATABASE = "layerwright_queries"


@query(
    "snapshot_versions",
    ctes("r")
    + """SELECT 'gold_311_daily_agency_summary' AS table_name, 0::bigint AS version, count(*) AS rows FROM gld_r WHERE agency <> 'view'
         UNION ALL SELECT 'gold_311_daily_agency_summary', 1, count(*) FROM gld_r""",
)
def snapshot_versions(spark, sf_dir):
    """O-6, O-7, S-8: each write is a new version; every version is counted from its own files."""
    path = f"{run_dir(spark, 'versions')}/{REQUESTS.gold}"
    mart = gold(spark, sf_dir, REQUESTS)
    snapshot_write(mart.where("agency <> 'view'"), path, REQUESTS.gold)
    snapshot_write(mart, path, REQUESTS.gold)
    return union_by_name(
        snapshot_read(spark, path, v).agg(
            F.lit(REQUESTS.gold).alias("table_name"), F.lit(v).cast("bigint").alias("version"), F.count("*").alias("rows")
        )
        for v in versions(spark, path)
    )


@query("snapshot_time_travel", ctes("f") + "SELECT * FROM gld_f WHERE filing_count > 1")
def snapshot_time_travel(spark, sf_dir):
    """S-8: an older version stays readable after a newer write."""
    path = f"{run_dir(spark, 'travel')}/{FILINGS.gold}"
    mart = gold(spark, sf_dir, FILINGS)
    snapshot_write(mart.where("filing_count > 1"), path, FILINGS.gold)
    snapshot_write(mart, path, FILINGS.gold)
    return snapshot_read(spark, path, 0)


def _marts(spark, sf_dir):
    return {d.gold: gold(spark, sf_dir, d) for d in DOMAINS.values()}


@query(
    "export_audit",
    ctes("rmf")
    + f"""SELECT '{REQUESTS.gold}' AS table_name, 0::bigint AS version, count(*) AS rows FROM gld_r
          UNION ALL SELECT '{COMMITS.gold}', 0, count(*) FROM gld_m
          UNION ALL SELECT '{FILINGS.gold}', 0, count(*) FROM gld_f""",
)
def export_audit(spark, sf_dir):
    """O-6, O-7: three tables exported, then published together by their manifest."""
    root = f"{run_dir(spark, 'export')}/export"
    snapshot_all(spark, _marts(spark, sf_dir), root)
    return published_versions(spark, root)


@query("export_read_back", ctes("m") + "SELECT * FROM gld_m")
def export_read_back(spark, sf_dir):
    """S-8: a published table is read at the version its manifest names."""
    root = f"{run_dir(spark, 'exported')}/export"
    snapshot_all(spark, {COMMITS.gold: gold(spark, sf_dir, COMMITS)}, root)
    return read_published(spark, root, COMMITS.gold)


@query(
    "export_total",
    ctes("rmf")
    + """SELECT 3::bigint AS tables, (SELECT count(*) FROM gld_r) + (SELECT count(*) FROM gld_m) + (SELECT count(*) FROM gld_f) AS total_rows""",
)
def export_total(spark, sf_dir):
    """O-7, O-10: the running total of an export."""
    return total_rows(snapshot_all(spark, _marts(spark, sf_dir), f"{run_dir(spark, 'total')}/export"))


def _database(spark, label):
    root = run_dir(spark, label)
    create_layers(spark, root, [DATABASE])
    return root


@query("publish_table", ctes("f") + "SELECT * FROM gld_f")
def publish_table(spark, sf_dir):
    """O-9, O-12, S-7: created or replaced as select, read back by name."""
    root = _database(spark, "publish")
    mart = gold(spark, sf_dir, FILINGS)
    name = f"{DATABASE}.{FILINGS.gold}"
    publish(mart.where("filing_count > 1"), name, f"{root}/{FILINGS.gold}")
    publish(mart, name, f"{root}/{FILINGS.gold}")
    return spark.table(name)


@query(
    "publish_audit",
    ctes("rmf")
    + f"""SELECT '{DATABASE}.{REQUESTS.gold}' AS table_name, count(*) AS rows FROM gld_r
          UNION ALL SELECT '{DATABASE}.{COMMITS.gold}', count(*) FROM gld_m
          UNION ALL SELECT '{DATABASE}.{FILINGS.gold}', count(*) FROM gld_f""",
)
def publish_audit(spark, sf_dir):
    """O-9, O-10: publish all marts, rows per table."""
    root = _database(spark, "publish-all")
    return publish_all(spark, _marts(spark, sf_dir), DATABASE, root)


@query(
    "publish_documentation",
    """
    SELECT * FROM (VALUES ('authored_date', 'timestamp_ntz', 'Day of authoring'), ('author_name', 'string', NULL),
      ('author_email', 'string', NULL), ('commit_count', 'bigint', 'Commits by this author on this day')) t(col_name, data_type, comment)
    """,
)
def publish_documentation(spark, sf_dir):
    """O-11: column comments are readable from the catalog."""
    root = _database(spark, "documented")
    name = f"{DATABASE}.documented_activity"
    publish(gold(spark, sf_dir, COMMITS), name, f"{root}/activity", COMMITS.comments[COMMITS.gold], COMMITS.gold_columns)
    return described_columns(spark, name)


@query("parquet_staging_read", ctes("r") + "SELECT * EXCLUDE (open_count) FROM gld_r")
def parquet_staging_read(spark, sf_dir):
    """S-9, O-8, P-5: Parquet written to a staging folder, read without one column."""
    path = f"{run_dir(spark, 'staging')}/gold"
    gold(spark, sf_dir, REQUESTS).write.parquet(path)
    return read_parquet(spark, path, drop=["open_count"])
