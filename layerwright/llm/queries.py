"""Queries of this package over the test tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.llm import oracles
from layerwright.llm.decontamination import contamination
from layerwright.llm.frames import prepare
from layerwright.llm.hard_negatives import hard_negatives
from layerwright.llm.host_reputation import filter_urls
from layerwright.llm.lattice import embedding_links
from layerwright.llm.license_scan import scan_licenses
from layerwright.llm.mixing import mix
from layerwright.llm.near_duplicates import near_duplicates
from layerwright.llm.quality import quality_scores
from layerwright.llm.substrings import remove_repeats
from layerwright.llm.suffix_dedup import remove_repeated_strings
from layerwright.llm.token_alignment import align_tokens
from layerwright.llm.token_files import read_tokens, write_tokens
from layerwright.llm.zip_warc import read_archives, with_references, write_archives
from layerwright.session import run_dir, use_engine_settings

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(use_engine_settings(spark))
            return fn(lambda table: spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet"))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_lattice_hashing", oracles.EMBEDDINGS)
def _(table):
    return embedding_links(table("embeddings")).select("vec_id", "n_links", "component_id", "kept")


@query("op2_decontamination", oracles.CONTAMINATION)
def _(table):
    return contamination(table("documents"), table("benchmark")).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op3_token_files")
def _(table):
    docs = table("documents")
    folder = run_dir(docs.sparkSession, "tokens")
    return read_tokens(docs.sparkSession, folder, write_tokens(docs, folder, TOKENIZER))


@query("op4_odd_sketch_minhash", oracles.NEAR_DUPLICATES)
def _(table):
    return near_duplicates(table("documents")).select("doc_id", "n_shingles", "component_id", "kept")


@query("op5_quadratic_discriminant")
def _(table):
    return quality_scores(table("documents"), table("labels"))


@query("op6_host_reputation", oracles.URLS)
def _(table):
    return filter_urls(table("pages"), table("labels"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query("op7_induced_suffix_sorting")
def _(table):
    return remove_repeated_strings(table("documents")).drop("kept")


@query("op8_rabin_karp", oracles.SUBSTRINGS)
def _(table):
    return remove_repeats(table("documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op9_low_discrepancy_mix", oracles.MIX)
def _(table):
    return mix(table("documents")).select("doc_id", "size", "source_size", "target", "taken", "first_slot", "n_slots")


@query("op10_zip_warc", oracles.WARC)
def _(table):
    pages = table("pages")
    folder = run_dir(pages.sparkSession, "archives")
    records = read_archives(pages.sparkSession, folder, write_archives(with_references(pages), folder))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op11_bond_hard_negatives", oracles.HARD_NEGATIVES)
def _(table):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table("embeddings").select("vec_id", moved.alias("label"), "embedding"))


@query("op12_token_alignment")
def _(table):
    return align_tokens(table("documents"), TOKENIZER, PIECES)


@query("op13_license_scan", oracles.LICENSES)
def _(table):
    return scan_licenses(table("documents"))
