"""layerwright: trustworthy bronze -> silver -> gold tables as Spark jobs.

Every operator takes DataFrames and returns DataFrames.  Only single-row
results (a watermark, a gate verdict, a row count) and partition listings
reach the driver; there are no Python UDFs.
"""

from layerwright.session import build_session, run_dir, shared_root, use_engine_settings

__all__ = ["build_session", "run_dir", "shared_root", "use_engine_settings"]
