"""DataFrame-to-DataFrame operators."""

from layerwright.operators.checks import TableChecks, not_null, run_checks, unexpected_failures, unique
from layerwright.operators.dedup import keep_best, latest, lowest
from layerwright.operators.diff import recompute_diff
from layerwright.operators.grain import GrainSpec, aggregate
from layerwright.operators.incremental import (
    cutoff,
    in_grains,
    incremental_run,
    late_grains,
    missed_grains,
    read_gold,
    repair_grains,
    replace_partitions,
    since,
    watermark_frame,
)
from layerwright.operators.quality import (
    accepted,
    classify,
    rejected,
    rejection_gate,
    rejection_rate,
    rejection_rate_of,
    rejection_summary,
    required,
    split,
    valid,
)
from layerwright.operators.staging import stage
from layerwright.operators.synthesis import inject_defects, late_record, sample_rows
from layerwright.operators.upsert import survivors, upsert_by_key

__all__ = [
    "GrainSpec",
    "TableChecks",
    "accepted",
    "aggregate",
    "classify",
    "cutoff",
    "in_grains",
    "incremental_run",
    "inject_defects",
    "keep_best",
    "late_grains",
    "late_record",
    "latest",
    "lowest",
    "missed_grains",
    "not_null",
    "read_gold",
    "recompute_diff",
    "rejected",
    "rejection_gate",
    "rejection_rate",
    "rejection_rate_of",
    "rejection_summary",
    "repair_grains",
    "replace_partitions",
    "required",
    "run_checks",
    "sample_rows",
    "since",
    "split",
    "stage",
    "survivors",
    "unexpected_failures",
    "unique",
    "upsert_by_key",
    "valid",
    "watermark_frame",
]
