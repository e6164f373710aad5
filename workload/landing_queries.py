"""Landings that are rewritten, withdrawn, undated or dated far ahead: a second build must see each of them."""

from pyspark.sql import functions as F

from layerwright.plans.changed_keys import KeyedPaths, KeyIndex, late_grains_indexed
from layerwright.plans.domains import REQUESTS
from layerwright.plans.gated import RunConfig, build, repair
from layerwright.session import run_dir
from layerwright.sources import files
from layerwright.sources.bronze import INGEST_DATE, write_bronze
from layerwright.streaming.available import StreamTables, ingest_available
from workload.incremental_queries import by_calendar
from workload.oracle import ctes, gold_of
from workload.quality_queries import silver
from workload.registry import query
from workload.standins import raw_requests, requests

_WHOLE = ctes("r") + "SELECT * FROM gld_r"


def _config(spark, label, **options):
    root = run_dir(spark, label)
    return RunConfig(f"{root}/bronze", f"{root}/warehouse", domains={REQUESTS.source: REQUESTS}, **options)


def _land(rows, cfg):
    write_bronze(rows, cfg.bronze_root, REQUESTS.source)


def _build(spark, cfg):
    return build(spark, REQUESTS, cfg).gold


def _withdraw(spark, cfg, date):
    files.delete(spark, f"{cfg.bronze_root}/{REQUESTS.source}/{INGEST_DATE}={date}")


@query("landing_rewritten", _WHOLE)
def landing_rewritten(spark, sf_dir):
    """S-3: every landing is replaced by one of as many rows and letters; nothing of the first is left in gold."""
    cfg = _config(spark, "rewritten")
    raw = raw_requests(requests(spark, sf_dir))
    _land(raw.withColumn("agency", F.reverse("agency")), cfg)
    _build(spark, cfg)
    for date in files.partition_values(spark, f"{cfg.bronze_root}/{REQUESTS.source}", INGEST_DATE):
        _withdraw(spark, cfg, date)
    _land(raw, cfg)
    # The first copies lie on the same days, so the window would reach only the last of them.
    return _build(spark, RunConfig(cfg.bronze_root, cfg.warehouse_root, domains=cfg.domains, lookback_days=36500))


@query("landing_withdrawn_refresh", _WHOLE)
def landing_withdrawn_refresh(spark, sf_dir):
    """O-3: a withdrawn landing leaves with the full refresh, and stays away."""
    cfg = _config(spark, "withdrawn")
    raw = raw_requests(requests(spark, sf_dir))
    _land(raw, cfg)
    _land(raw.withColumn("unique_key", F.concat(F.lit("9"), "unique_key")).withColumn(INGEST_DATE, F.lit("2030-01-01").cast("date")), cfg)
    _build(spark, cfg)
    _withdraw(spark, cfg, "2030-01-01")
    _build(spark, RunConfig(cfg.bronze_root, cfg.warehouse_root, domains=cfg.domains, full_refresh=True))
    return _build(spark, cfg)


@query("landing_without_date", _WHOLE)
def landing_without_date(spark, sf_dir):
    """S-3: rows landed without a date are a landing like others, also when more of them arrive."""
    cfg = _config(spark, "undated", lookback_days=36500)
    raw = raw_requests(requests(spark, sf_dir))
    undated = raw.withColumn(INGEST_DATE, F.lit(None).cast("date"))
    odd = F.coalesce(F.col("unique_key").cast("bigint") % 2, F.lit(0)) == 1
    _land(raw.where(~odd), cfg)
    _land(undated.where(odd & (F.col("borough") == "B1")), cfg)
    _build(spark, cfg)
    _land(undated.where(odd & ~F.col("borough").eqNullSafe("B1")), cfg)
    return _build(spark, cfg)


@query("repair_missed", _WHOLE)
def repair_missed(spark, sf_dir):
    """L-4: rows later than the window are missed by the build and found and mended by the repair."""
    cfg = _config(spark, "repair")
    raw = raw_requests(requests(spark, sf_dir))
    newest = raw.agg(F.max(INGEST_DATE).cast("string")).first()[0]
    late = F.expr("unique_key IS NOT NULL AND pmod(crc32(unique_key), 7) = 0") & (F.col(INGEST_DATE) < F.date_sub(F.lit(newest).cast("date"), 10))
    _land(raw.where(~late), cfg)
    _build(spark, cfg)
    _land(raw.where(late), cfg)
    _build(spark, cfg)
    return repair(spark, REQUESTS, cfg)


@query(
    "stream_far_future_date",
    ctes("r")
    + f"""SELECT {", ".join(by_calendar("request_date"))}, agency, sum(request_count)::bigint AS n FROM gld_r GROUP BY ALL
          UNION ALL SELECT year(created_at) + 18216, month(created_at), day(created_at), agency, count(*)
                    FROM slv_r WHERE request_id % 500 = 7 GROUP BY ALL""",
)
def stream_far_future_date(spark, sf_dir):
    """L-5: records dated in year 20240 are aggregated like others, in the batch they land in and after it."""
    raw = raw_requests(requests(spark, sf_dir))
    good = raw_requests(silver(spark, sf_dir, REQUESTS)).where("cast(unique_key AS bigint) % 500 = 7")
    far = good.withColumn("unique_key", F.concat(F.lit("9000000"), "unique_key")).withColumn(
        "created_date", F.concat((F.substring("created_date", 1, 4).cast("int") + 18216).cast("string"), F.expr("substr(created_date, 5)"))
    )
    root = run_dir(spark, "stream-far")
    tables = StreamTables(f"{root}/stream")
    second = F.pmod(F.crc32(F.coalesce("unique_key", F.lit(""))), F.lit(5)) == 0
    write_bronze(raw.where(~second).unionByName(far), f"{root}/bronze", REQUESTS.source)
    ingest_available(spark, f"{root}/bronze", REQUESTS, tables)
    write_bronze(raw.where(second), f"{root}/bronze", REQUESTS.source)
    gold = ingest_available(spark, f"{root}/bronze", REQUESTS, tables)
    return gold.groupBy(*[F.expr(e) for e in by_calendar("request_date")], "agency").agg(F.sum("request_count").alias("n"))


@query("stream_very_late_record", _WHOLE)
def stream_very_late_record(spark, sf_dir):
    """L-5: the oldest day of all arrives last; only the keys of its grains are read again."""
    raw = raw_requests(requests(spark, sf_dir))
    oldest = raw.agg(F.min(INGEST_DATE).cast("string")).first()[0]
    late = F.col(INGEST_DATE) == F.lit(oldest).cast("date")
    root = run_dir(spark, "stream-late")
    tables = StreamTables(f"{root}/stream")
    write_bronze(raw.where(~late), f"{root}/bronze", REQUESTS.source)
    ingest_available(spark, f"{root}/bronze", REQUESTS, tables)
    write_bronze(raw.where(late), f"{root}/bronze", REQUESTS.source)
    return ingest_available(spark, f"{root}/bronze", REQUESTS, tables)


@query("stream_compacted", _WHOLE)
def stream_compacted(spark, sf_dir):
    """L-5: five micro-batches, the dates of their keys from the key index, and the log folded to two folders per grain date."""
    raw = raw_requests(requests(spark, sf_dir))
    root = run_dir(spark, "stream-compacted")
    tables = StreamTables(f"{root}/stream", index_buckets=4, max_folders=2)
    part = F.pmod(F.crc32(F.coalesce("unique_key", F.lit(""))), F.lit(5))
    for n in range(5):
        write_bronze(raw.where(part == n), f"{root}/bronze", REQUESTS.source)
        gold = ingest_available(spark, f"{root}/bronze", REQUESTS, tables)
    return gold


@query("stream_all_rejected", ctes("r") + "SELECT (SELECT count(*) FROM stg_r) AS rejected, 0::bigint AS gold_rows")
def stream_all_rejected(spark, sf_dir):
    """L-5: where every record so far is rejected, gold is an empty table, not an error."""
    root = run_dir(spark, "stream-rejected")
    tables = StreamTables(f"{root}/stream")
    raw = raw_requests(requests(spark, sf_dir)).withColumn("agency", F.lit(None).cast("string"))
    write_bronze(raw, f"{root}/bronze", REQUESTS.source)
    gold = ingest_available(spark, f"{root}/bronze", REQUESTS, tables)
    rejected = spark.read.parquet(tables.quarantine).selectExpr("1 AS rejected", "0 AS gold_rows")
    both = rejected.unionAll(gold.selectExpr("0 AS rejected", "1 AS gold_rows"))
    return both.agg(F.sum("rejected").alias("rejected"), F.sum("gold_rows").alias("gold_rows"))


# ---- silver by the keys that changed ------------------------------------------

_CORRECTED = """
  SELECT * FROM slv_r WHERE request_id % 11 <> 0
  UNION ALL
  SELECT request_id, created_at + INTERVAL '40' DAY, closed_at, date_diff('hour', created_at + INTERVAL '40' DAY, closed_at), reverse(agency), agency_name,
         complaint_type, descriptor, borough, incident_zip, status, latitude, longitude
  FROM slv_r WHERE request_id % 11 = 0
"""


def _keyed(spark, label):
    return RunConfig(*(run_dir(spark, label) + f"/{x}" for x in ("bronze", "warehouse")), domains={REQUESTS.source: REQUESTS}, by_key=True, index_buckets=4)


def _after_corrections(spark, sf_dir):
    """Built by key three times: over one landing too many; after that one is withdrawn and another has moved a tenth of the records 40 days on; unchanged."""
    cfg = _keyed(spark, "by-key")
    good = raw_requests(silver(spark, sf_dir, REQUESTS))
    key = F.col("unique_key").cast("bigint")

    def later(days, landing):
        moved = F.date_format(F.to_timestamp_ntz("created_date") + F.make_interval(days=F.lit(days)), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        return good.withColumn("created_date", moved).withColumn(INGEST_DATE, F.lit(landing).cast("date"))

    _land(raw_requests(requests(spark, sf_dir)), cfg)
    _land(later(80, "2030-01-02").where(key % 7 == 0).withColumn("agency", F.lit("withdrawn")), cfg)
    build(spark, REQUESTS, cfg)
    _withdraw(spark, cfg, "2030-01-02")
    _land(later(40, "2030-01-01").where(key % 11 == 0).withColumn("agency", F.reverse("agency")), cfg)
    build(spark, REQUESTS, cfg)
    return build(spark, REQUESTS, cfg)


@query("silver_after_correction", ctes("r") + _CORRECTED)
def silver_after_correction(spark, sf_dir):
    """W-1, O-2: records move to another day and a landing is withdrawn; only the keys and days concerned are written again."""
    return _after_corrections(spark, sf_dir).silver.drop("grain_date")


@query(
    "late_grains_indexed",
    ctes("r", "newest AS (SELECT max(created_at)::date AS day FROM cls_r WHERE rejection_reason IS NULL)")
    + """SELECT created_at::date AS grain_date, count(DISTINCT request_id) AS keys FROM cls_r, newest
         WHERE rejection_reason IS NULL AND request_id % 7 = 3 AND created_at::date < day - 10 GROUP BY ALL""",
)
def late_grains_indexed_query(spark, sf_dir):
    """L-4: the grains of a new landing that the window would not reach, from its index entries alone."""
    cfg = _keyed(spark, "late-index")
    rows = requests(spark, sf_dir)
    good = rows.where("request_id is not null and created_at is not null and agency is not null")
    newest = good.agg(F.max("created_at").cast("date").cast("string")).first()[0]
    late = F.coalesce((F.col("request_id") % 7 == 3) & (F.col("created_at").cast("date") < F.date_sub(F.lit(newest).cast("date"), 10)), F.lit(False))
    raw = raw_requests(rows.withColumn("late", late).where("not late").drop("late"))
    _land(raw, cfg)
    build(spark, REQUESTS, cfg)
    _land(raw_requests(rows.withColumn("late", late).where("late").drop("late")).withColumn(INGEST_DATE, F.lit("2030-01-01").cast("date")), cfg)
    build(spark, REQUESTS, cfg)
    index = KeyIndex(spark, KeyedPaths.of(cfg, REQUESTS).index, REQUESTS.silver, cfg.index_buckets)
    return late_grains_indexed(index, ["2030-01-01"], newest)


@query("gold_after_correction", ctes("r", f"corrected AS ({_CORRECTED})", f"g AS ({gold_of('r', 'corrected')})") + "SELECT * FROM g")
def gold_after_correction(spark, sf_dir):
    """L-4: gold of those days, however old, is right without a window; days that became empty are gone."""
    return _after_corrections(spark, sf_dir).gold
