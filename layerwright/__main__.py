"""Command line: `python -m layerwright <command> --bronze DIR --warehouse DIR`.

preflight  list missing and empty landings
build      bronze to gold for every domain
check      verdicts of all checks over the stored layers; fails on unexpected ones
repair     re-aggregate stored grains that records later than the window have left behind
history    checks that failed when they last ran, and since which run; fails if there are any
sql        run a query over the stored layers (staging.*, silver.*, gold.*)
run        preflight, build, check, export and publish, each behind the one before
messy      land demonstration batches that trip the gate
late       land a late-arriving record
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.operators.checks import unexpected_failures
from layerwright.operators.history import check_history, failing_since
from layerwright.plans.demo import LATE_INGEST_DATE, late_request, messy_commits, messy_requests
from layerwright.plans.domains import DOMAINS
from layerwright.plans.gated import VERDICTS, GateFailed, RunConfig, build, check, gated_run, load, register_layers, repair, side_by_side
from layerwright.session import build_session
from layerwright.sources.bronze import CORRUPT, check_bronze, read_bronze, with_ingest_date, write_bronze


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="layerwright", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("command", choices=["preflight", "build", "check", "repair", "history", "sql", "run", "messy", "late"])
    parser.add_argument("--query", default="SHOW VIEWS IN gold", help="for sql")
    parser.add_argument("--limit", type=int, default=100, help="rows of an answer to print; its size is always printed")
    parser.add_argument("--out", default="", help="also write the whole answer (sql: rows, others: violations) as JSON lines to this new folder")
    parser.add_argument("--cap", default=None, help="YYYY-MM-DD: no watermark may lie beyond this date")
    parser.add_argument("--bronze", default="")
    parser.add_argument("--warehouse", default="")
    parser.add_argument("--source", action="append", choices=list(DOMAINS), help="only these sources (repeatable)")
    parser.add_argument("--database", default="layerwright_published")
    parser.add_argument("--lookback-days", type=int, default=3)
    parser.add_argument("--full-refresh", action="store_true")
    parser.add_argument("--threshold", type=float, default=0.02)
    parser.add_argument("--by-key", action="store_true", help="update silver and gold by the keys that changed, instead of rebuilding silver")
    parser.add_argument("--gate-per-batch", action="store_true", help="judge every landing date by itself")
    parser.add_argument("--allow", action="append", default=[], help="name of a check known to fail (repeatable)")
    parser.add_argument("--ingest-date", default=LATE_INGEST_DATE, help="landing date of messy and late batches")
    return parser.parse_args(argv)


def config(args: argparse.Namespace) -> RunConfig:
    domains = {name: d for name, d in DOMAINS.items() if not args.source or name in args.source}
    return RunConfig(
        bronze_root=args.bronze,
        warehouse_root=args.warehouse,
        database=args.database,
        domains=domains,
        lookback_days=args.lookback_days,
        full_refresh=args.full_refresh,
        threshold=args.threshold,
        known_failures=tuple(args.allow),
        gate_per_batch=args.gate_per_batch,
        by_key=args.by_key,
        cap=args.cap,
    )


def _land(batch: DataFrame, args: argparse.Namespace, source: str) -> None:
    """Append a batch without its bookkeeping columns; explicit nulls stay explicit."""
    plain = with_ingest_date(batch.drop("position", CORRUPT), args.ingest_date)
    explicit = F.col("defect") == 1 if source == "nyc_311" else F.col("defect") == 0
    write_bronze(plain.where(explicit).drop("defect"), args.bronze, source, keep_nulls=True)
    write_bronze(plain.where(~explicit).drop("defect"), args.bronze, source)


def execute(spark: SparkSession, args: argparse.Namespace) -> int:
    """Run one command; 0 when nothing was found wrong."""
    cfg = config(args)
    sources = [d.source for d in cfg.chosen()]
    if args.command == "preflight":
        return _violations(check_bronze(spark, cfg.bronze_root, sources), args)
    if args.command == "build":
        side_by_side(lambda d: build(spark, d, cfg), cfg.chosen())
        return 0
    if args.command == "check":
        verdicts = check([load(spark, d, cfg) for d in cfg.chosen()], cfg.threshold, cfg.gate_per_batch)
        verdicts = verdicts.persist()
        verdicts.orderBy("check_name").show(verdicts.count(), truncate=False)
        return _violations(unexpected_failures(verdicts, cfg.known_failures), args)
    if args.command == "repair":
        side_by_side(lambda d: repair(spark, d, cfg), cfg.chosen())
        return 0
    if args.command == "history":
        return _violations(failing_since(check_history(spark, f"{cfg.warehouse_root}/{VERDICTS}")), args)
    if args.command == "sql":
        register_layers(spark, cfg)
        _answer(spark.sql(args.query), args)
        return 0
    if args.command == "run":
        try:
            gated_run(spark, cfg).show(truncate=False)
            return 0
        except GateFailed as failure:
            failure.report.show(truncate=False)
            return _violations(failure.violations, args)
    if args.command == "messy":
        _land(messy_requests(read_bronze(spark, args.bronze, "nyc_311")), args, "nyc_311")
        _land(messy_commits(read_bronze(spark, args.bronze, "github_commits")), args, "github_commits")
        return 0
    late = late_request(read_bronze(spark, args.bronze, "nyc_311"), ingest_date=args.ingest_date)
    write_bronze(late.drop(CORRUPT), args.bronze, "nyc_311")
    return 0


def _answer(rows: DataFrame, args: argparse.Namespace) -> int:
    """Print the first `--limit` rows and the number of all; `--out` gets every row."""
    if args.out:
        rows.write.option("ignoreNullFields", "false").json(args.out)
    # Counting what was written spares a second run of the query.
    n = rows.sparkSession.read.schema(rows.schema).json(args.out).count() if args.out else rows.count()
    if args.limit > 0:
        rows.show(args.limit, truncate=False)
    print(f"{n} rows" + (f", all in {args.out}" if args.out else ""))
    return n


def _violations(rows: DataFrame, args: argparse.Namespace) -> int:
    return 1 if _answer(rows, args) else 0


if __name__ == "__main__":
    sys.exit(execute(build_session(), arguments()))
