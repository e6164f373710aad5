"""Files, scores, schedules and the pipeline."""

import io
import json
import zipfile
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from layerwright.llm import mixing
from layerwright.llm.host_reputation import filter_urls
from layerwright.llm.mixing import mix, mixed_documents
from layerwright.llm.quality import keep_good, quality_scores
from layerwright.llm.queries import TOKENIZER, URL_RULES
from layerwright.llm.token_files import TokenFile, read_tokens, write_tokens
from layerwright.llm.zip_warc import Archive, ArchiveWriter, read_archives, with_references, write_archives
from tests.conftest import SMALL


def test_token_files_round_trip(spark, docs, odd_docs, no_docs, tmp_path):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for k, table in enumerate((docs, odd_docs, no_docs)):
        folder = str(tmp_path / str(k))
        manifest = write_tokens(table, folder, TOKENIZER, length=64, batch_rows=4)
        got = sorted(map(tuple, read_tokens(spark, folder, manifest).collect()), key=lambda r: r[1])
        coded = {}
        for d, t in table.select("doc_id", "text").collect():
            ids = library.encode(t or "", add_special_tokens=False).ids + [0]
            coded.setdefault(d, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        assert [g[0] for g in got] == sorted((g[0] for g in got), key=lambda d: (d is not None, d or 0))
        assert [g[1] for g in got] == list(np.cumsum([0, *(g[2] for g in got)])[:-1])
        for d, rows in coded.items():
            assert sorted(g[2:] for g in got if g[0] == d) == sorted(rows)
        for f in manifest.collect():
            file = TokenFile(folder, f["file"])
            last = (f["tokens"] - 1) // 64
            assert len(file.sequence(last)) == 64 and file.mask(last).true_count == f["tokens"] - 64 * last


def test_added_tokens_in_texts_are_tokens(spark, tmp_path):
    end = "<|endoftext|>"
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [f"end of page {end} next", end, end * 3, f"a{end}'s b", f"x  {end}  y", f" {end} ", f"<{end}>", "<|endof", "text|>", f"é {end}\n中 {end[:-1]}", f"1{end}2 " * 200, None]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    folder = str(tmp_path / "added")
    got = {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in read_tokens(spark, folder, write_tokens(table, folder, TOKENIZER)).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        assert got[i] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), t


def test_quality_on_held_out_labels(spark, odd_docs):
    docs, labels = (spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_scores(docs, labels).join(labels, "doc_id").where("held_out").select("predicted", "quality", "score").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert quality_scores(odd_docs, labels).count() == odd_docs.count()
    assert quality_scores(docs, labels.limit(0)).where("score != 0.5").count() == 0
    assert keep_good(odd_docs, labels).columns == odd_docs.columns


def test_mix_meets_its_targets(docs, odd_docs, no_docs):
    for table in (docs, odd_docs, no_docs):
        rows = mix(table, block=50).collect()
        assert len(rows) == table.count()
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
        for source in {r["source"] for r in rows}:
            mine = [r for r in rows if r["source"] == source]
            assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 0.5
            assert mine[0]["target"] <= 2 * mine[0]["source_size"] == 2 * sum(r["size"] for r in mine)
        assert abs(sum({r["source"]: r["target"] for r in rows}.values()) - 1.5 * sum(r["size"] for r in rows)) < 1e-6 * max(1, len(rows))
        out = mixed_documents(table, block=50)
        assert out.columns == table.columns
        assert out.exceptAll(table.unionAll(table)).count() == 0  # whole documents, none more than twice
        words = {(r["source"], r["n"]) for r in out.groupBy("source").agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))).alias("n")).collect()}
        for source, n in words:
            mine = [r for r in rows if r["source"] == source]
            # Of each lap's last document at most half is left out or put in.
            assert abs(n - mine[0]["target"]) <= max(r["size"] for r in mine) / 2 + 1


def test_taken_words_come_through_the_schedule(docs, monkeypatch):
    """With all slots of one point, or none, hardly a block is reached."""
    want = sum(r["taken"] for r in mix(docs, block=50).collect())
    monkeypatch.setattr(mixing, "van_der_corput", lambda number, bits: F.lit(0).cast("bigint"))
    constant = mix(docs, block=50).collect()
    assert want > 0 and sum(r["taken"] for r in constant) != want
    monkeypatch.setattr(mixing, "van_der_corput", lambda number, bits: F.lit(1 << 40).cast("bigint"))
    assert sum(r["taken"] for r in mix(docs, block=50).collect()) == 0


def test_every_stretch_of_slots_is_close_to_the_weights(spark):
    quotas = [1, 300, 77, 500, 2, 120]
    edges = np.cumsum([0, *quotas])
    plan = spark.createDataFrame([(i, q, int(edges[i])) for i, q in enumerate(quotas)], "place int, quota long, edge long")
    rows = sorted(mixing.slots(plan).collect(), key=lambda r: r["slot"])
    n = sum(quotas)
    assert len(rows) == n and len({r["slot"] for r in rows}) == n
    for i, q in enumerate(quotas):
        assert [r["block"] for r in rows if r["place"] == i] == list(range(q))
    places = np.array([r["place"] for r in rows])
    for i, q in enumerate(quotas):
        met = np.cumsum(places == i)
        # A van der Corput prefix counts an interval to within the logarithm of its length.
        assert np.abs(met - np.arange(1, n + 1) * q / n).max() <= np.log2(n) / 2 + 2
    assert np.abs(np.cumsum(np.sort(places) == 3) - np.arange(1, n + 1) * quotas[3] / n).max() > 100  # as a plain order would


def test_copies_of_the_mix_name_their_slots(docs):
    out = mixed_documents(docs, block=50, slot="at")
    assert out.columns == [*docs.columns, "at"] and out.where("at is null").count() == 0
    assert out.drop("at").exceptAll(mixed_documents(docs, block=50)).count() == 0


def test_mix_of_many_sources(spark, docs):
    """More sources than are broadcast: every one meets its target, as with all of them broadcast."""
    n = mixing.FEW_SOURCES + 100
    table = spark.range(2 * n).select(F.col("id").alias("doc_id"), (F.col("id") % n).cast("string").alias("source"), F.expr("repeat('w ', int(id % 7) + 1)").alias("text"))
    rows = mix(table, block=4).collect()
    assert len(rows) == 2 * n
    taken, target = {}, {}
    for r in rows:
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
    assert len(target) == n and all(abs(taken[s] - target[s]) <= 0.5 for s in target)


def test_few_and_many_sources_mix_alike(docs, monkeypatch):
    want = sorted(map(tuple, mix(docs, block=50).collect()))
    monkeypatch.setattr(mixing, "FEW_SOURCES", 0)
    assert sorted(map(tuple, mix(docs, block=50).collect())) == want


def test_warc_archives(spark, tmp_path):
    big = "<p>é</p>" * 200
    rows = [(1, "http://a/\nb", big, "x"), (5, None, big, "x"), (3, "u", big, "x"), (5, "again", big, "x"), (7, "u", "small", "x"), (8, "u", "small", "x"), (9, "u", None, "x"), (None, "u", big, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    for k, table in enumerate((pages, pages.limit(0))):
        folder = str(tmp_path / f"warc{k}")
        got = read_archives(spark, folder, write_archives(with_references(table), folder, archive_bytes=300))
        got = sorted((tuple(r) for r in got.select("page_id", "record_type", "refers_to", "payload_bytes").collect()), key=repr)
        want = [(1, "revisit", 5, 1800), (5, "response", None, 1800), (3, "revisit", 5, 1800), (5, "response", None, 1800), (7, "response", None, 5),
                (8, "response", None, 5), (9, "response", None, 0), (None, "revisit", 5, 1800)]
        assert got == (sorted(want, key=repr) if k == 0 else [])


def test_zip_directory_reads_zip64(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    raw = io.BytesIO()
    out = ArchiveWriter(raw, member_bytes=200)
    for i in range(20):
        out.add(i, f"http://x/{i}", b"payload %d" % i, b"\0" * 20, None)
    out.close()
    assert b"PK\x06\x06" in raw.getvalue()
    raw.size = lambda: len(raw.getvalue())
    archive = Archive(raw)
    assert [h["warc-target-uri"] for h, _ in archive.records()] == [f"http://x/{i}" for i in range(20)]
    assert json.dumps(sorted(archive.directory.members)) and len(archive.directory.members) > 5


def test_url_rules_and_hosts(spark):
    urls = ["http://A.Example.NET/en/x?y", "https://example.net", "http://example.com/de/1#t", "http://z.org/fr/", "nothing", None, "http://h?/x", "http://net/"]
    pages = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    labels = spark.createDataFrame([(5, 0, 0), (4, 0, 1)] * 200, "doc_id long, quality int, toxic int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in filter_urls(pages, labels, URL_RULES).collect()}
    assert got[0] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[1][:3] == ("example.net", "", None) and got[2][2:] == ("example.com/de/", "block") and got[3][2:] == ("org/fr/", "allow")
    assert got[4] == ("", "", None, "block") == got[5]
    assert got[6][:2] == ("h", "") and got[7][2:] == ("net/", "block")
    assert filter_urls(pages, labels.limit(0), URL_RULES).where("rule is null and verdict = 'block'").count() == 0
    assert filter_urls(pages.limit(0), labels, URL_RULES).count() == 0


@pytest.mark.parametrize("name", ["odd", "none"])
def test_pipeline_stages_keep_the_columns(spark, odd_docs, no_docs, name):
    table = {"odd": odd_docs, "none": no_docs}[name]
    for stage, run in corpus_pipeline.STAGES[:-1]:
        out = run(spark, table, SMALL)
        assert out.columns == table.columns, stage
        table = out
    assert corpus_pipeline.STAGES[-1][1](spark, table, SMALL).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
