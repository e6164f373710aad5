"""Every query over tables with foreign columns, NULLs in every column, repeated rows, and no rows at all."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from layerwright.llm.queries import QUERIES
from tests.conftest import SMALL

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels")
RUNS = {**QUERIES, "pipeline": corpus_pipeline.run}
# Names that operators use for columns of their own, or are likely to.
FOREIGN = (
    "id key size words word hash n_words n start target source_size taken component_id kept n_links n_shingles text_id block gram "
    "shingles sketch band score label features quality toxic host path rule verdict domain suffix digest payload payload_bytes member "
    "offset length ids tokens n_tokens items item item_id n_hit value cell vector norm a b x y pos part row rank slot point weight root"
).split()


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """Folders of the same tables: as they are, with foreign columns, with odd rows, without rows."""
    base = str(tmp_path_factory.mktemp("tables"))
    for name in TABLES:
        rows = spark.read.parquet(f"{SMALL}/{name}.parquet").coalesce(1)
        extra = [F.lit("clash" if i % 2 else None).cast("string").alias(c) for i, c in enumerate(FOREIGN) if c not in rows.columns]
        nothing = rows.limit(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema])
        rows.select("*", *extra).write.parquet(f"{base}/foreign/{name}.parquet")
        # A row of NULLs, twice, and a few rows that lost one column each.
        lost = [rows.limit(3).withColumn(c, F.lit(None).cast(rows.schema[c].dataType)) for c in rows.columns]
        odd = rows.unionByName(nothing).unionByName(nothing)
        for few in lost:
            odd = odd.unionByName(few)
        odd.write.parquet(f"{base}/odd/{name}.parquet")
        rows.where("false").write.parquet(f"{base}/none/{name}.parquet")
    return base


def answer(df):
    return sorted(repr(sorted(r.asDict().items())) for r in df.collect())


@pytest.mark.parametrize("name", RUNS)
def test_foreign_columns_change_nothing(spark, folders, name):
    assert answer(RUNS[name](spark, f"{folders}/foreign")) == answer(RUNS[name](spark, SMALL))


@pytest.mark.parametrize("name", RUNS)
def test_no_rows_give_no_rows(spark, folders, name):
    assert RUNS[name](spark, f"{folders}/none").count() == 0


@pytest.mark.parametrize("name", RUNS)
def test_nulls_and_repeated_rows_run_alike_twice(spark, folders, name):
    once = answer(RUNS[name](spark, f"{folders}/odd"))
    assert once and once == answer(RUNS[name](spark, f"{folders}/odd"))
