"""Demonstration batches: messy ones that trip the gate, and a late record.

(fixed values: how many rows, which defects, which overrides)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.operators.synthesis import POSITION, Nulled, Renamed, in_blocks, in_turn, inject_defects, late_record, sample_rows

SEED = 7
PER_DEFECT = 15
CLEAN = 15
MESSY_COMMITS = 6

REQUEST_DEFECTS = (Nulled("agency"), Nulled("created_date"), Renamed("unique_key", "unique_id"))
COMMIT_DEFECTS = (Nulled("commit.author.date"), Nulled("commit.author.date"))

LATE_REQUEST = {
    "unique_key": "99999001",
    "created_date": "2026-07-26T23:50:00.000",
    "agency": "NYPD",
    "agency_name": "New York City Police Department",
    "complaint_type": "Noise - Street/Sidewalk",
    "status": "Closed",
    "closed_date": "2026-08-01T09:00:00.000",
}
LATE_INGEST_DATE = "2026-08-01"


def messy_requests(bronze: DataFrame, seed: int = SEED) -> DataFrame:
    """Sampled requests under fresh keys: agency missing, date null, key renamed, clean."""
    numbered = sample_rows(bronze, PER_DEFECT * len(REQUEST_DEFECTS) + CLEAN, ["unique_key", "created_date"], seed)
    fresh = numbered.withColumn("unique_key", F.concat(F.lit("9"), (F.col(POSITION) + 900000).cast("string")))
    return inject_defects(fresh, REQUEST_DEFECTS, in_blocks(PER_DEFECT, len(REQUEST_DEFECTS)))


def messy_commits(bronze: DataFrame, n: int = MESSY_COMMITS, seed: int = SEED) -> DataFrame:
    """Sampled commits under fresh hashes: nested date null, nested date missing, clean, by turns."""
    numbered = sample_rows(bronze, n, ["sha"], seed)
    fresh = numbered.withColumn("sha", F.concat(F.lit("deadbeef"), F.lpad(F.lower(F.hex(POSITION)), 32, "0")))
    return inject_defects(fresh, COMMIT_DEFECTS, in_turn(len(COMMIT_DEFECTS)))


def late_request(bronze: DataFrame, overrides: dict[str, str] | None = None, ingest_date: str = LATE_INGEST_DATE) -> DataFrame:
    """A copy of the first request (by key) for a day already aggregated, landing days later."""
    values = {**LATE_REQUEST, **(overrides or {})}
    by_key = bronze.withColumn("_order", F.col("unique_key").try_cast("bigint"))
    late = late_record(
        by_key, ["_order", "created_date"], {k: F.lit(v) for k, v in values.items()}, F.lit(ingest_date).cast("date")
    )
    return late.drop("_order")
