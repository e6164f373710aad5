"""Plain versions from raw texts for what SQL can't express, measured recall, very long texts, and where tasks write to."""

import math
import re
import zlib

import numpy as np
import pyarrow.fs
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from layerwright.llm import stores
from layerwright.llm import text as text_module
from layerwright.llm.lattice import embedding_links
from layerwright.llm.near_duplicates import near_duplicates
from layerwright.llm.quality import quality_scores
from layerwright.llm.queries import TOKENIZER
from layerwright.llm.text import CHUNK, SPACE, mix, rolling, words
from layerwright.llm.token_files import read_tokens, write_tokens
from tests.conftest import SMALL
from tests.llm import brute

# ---- the classifier, from raw texts and textbook formulas ------------------------------

CLASSES = [
    lambda b: 65 <= b <= 90, lambda b: 48 <= b <= 57, lambda b: chr(b) in ".,;:?", lambda b: chr(b) == "!",
    lambda b: chr(b) in "#$%&*@^~+=<>{}[]_\\/", lambda b: chr(b) == "|", lambda b: b == 10, lambda b: chr(b) in "\"'()-",
]


def plain_statistics(text):
    raw = (text or "").encode()
    w = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    low = [x.lower() for x in re.findall(rb"[^\x20\x09-\x0D]+", raw)]
    many = max(len(w), 1)
    row = [math.sqrt(sum(1 for b in raw if member(b)) / max(len(raw), 1)) for member in CLASSES]
    row += [math.log1p(len(w)), math.log1p(sum(map(len, w)) / many), math.sqrt(sum(len(x) > 14 for x in w) / many)]
    row += [math.sqrt(sum(a == b for a, b in zip(low[k:], low)) / many) for k in (1, 5)]
    return [*row, math.log1p(len(set(low))) - 0.9 * math.log1p(len(w)), math.log1p(len(raw))]


def plain_scores(rows, labels, shrink=0.1, ridge=0.02):
    """rows (doc_id, text), labels (doc_id, quality) -> score of each row, by densities of two Gaussians."""
    x = np.array([plain_statistics(t) for _, t in rows])
    held_out = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 0
    known = [(i, q) for i, (d, _) in enumerate(rows) for e, q in labels if d is not None and d == e and q in (0, 1) and not held_out(d)]
    groups = [x[[i for i, q in known if q == c]] for c in (0, 1)]
    n, d = [len(g) for g in groups], x.shape[1]
    spread = [np.cov(g.T, bias=True) for g in groups]
    pooled = sum(k * s for k, s in zip(n, spread)) / sum(n)
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-8))
    logs = []
    for c in (0, 1):
        weight = min(1.0, shrink + d / n[c])
        cov = ((1 - weight) * spread[c] + weight * pooled) + ridge * np.diag(scale**2)
        away = x - groups[c].mean(axis=0)
        logs.append(math.log(n[c] / sum(n)) - 0.5 * np.einsum("ij,ij->i", away, np.linalg.solve(cov, away.T).T) - 0.5 * np.linalg.slogdet(cov)[1])
    return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


@pytest.mark.parametrize("odd", [False, True])
def test_scores_are_those_of_the_plain_discriminant(spark, docs, odd_docs, odd):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    table = docs.unionByName(odd_docs.select(docs.columns).withColumn("doc_id", F.col("doc_id") + 1_000_000)) if odd else docs
    rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
    want = plain_scores(rows, [tuple(r) for r in labels.select("doc_id", "quality").collect()])
    got = quality_scores(table, labels).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    a = sorted(((r["doc_id"], r["score"]) for r in got), key=key)
    b = sorted(((d, s) for (d, _), s in zip(rows, want)), key=key)
    assert [x[0] for x in a] == [x[0] for x in b]
    assert np.abs(np.array([x[1] for x in a]) - np.array([x[1] for x in b])).max() < 1e-9


# ---- the pipeline against a plain composition of its stages ------------------------------


def plain_mix(rows, weights=(3, 1, 2), block=4096):
    """rows (doc_id, source, text) -> the documents the schedule takes, in no order."""
    size = [len(brute.SPACED.findall(t or "")) for _, _, t in rows]
    names = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, s or ""))
    own = {s: sum(n for n, r in zip(size, rows) if r[1] == s) for s in names}
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_, wanted = {}, set(names), 1.5 * sum(own.values())
    while True:
        level = (wanted - sum(target.values())) / max(1, sum(weight[s] for s in open_))
        full = {s for s in open_ if weight[s] * level >= 2 * own[s]}
        if not full:
            target |= {s: weight[s] * level for s in open_}
            break
        target |= {s: 2.0 * own[s] for s in full}
        open_ -= full
    out = []
    for s in names:
        mine = sorted((i for i, r in enumerate(rows) if r[1] == s), key=lambda i: (__import__("hashlib").md5(f"{rows[i][0]}:0".encode()).hexdigest(), rows[i][0]))
        end = math.floor(target[s] + 0.5)
        at = 0
        for _ in range(2):
            for i in mine:
                got = max(0, min(at + size[i], end) - at)
                if size[i] and 2 * got >= size[i]:
                    out.append(rows[i])
                at += size[i]
    return out


def test_pipeline_is_its_stages(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "source", "text").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    good = [r for r, s in zip(rows, plain_scores([(r[0], r[2]) for r in rows], labels)) if s >= 0.3]
    kept = {d for d, _, _, k in brute.near_duplicates([(r[0], r[2]) for r in good]) if k}
    distinct = [r for r in good if r[0] in kept]
    dirty = {r[0] for r in brute.contamination([(r[0], r[2]) for r in distinct], items) if r[-1]}
    mixed = plain_mix([r for r in distinct if r[0] not in dirty])
    library = Tokenizer.from_file(TOKENIZER)
    want, start = [], 0
    for d, _, t in sorted(mixed, key=lambda r: r[0]):
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert 0 < len(dirty) and len(kept) < len(good) < len(rows)
    assert sorted(map(tuple, corpus_pipeline.run(spark, SMALL).collect())) == want


# ---- recall -----------------------------------------------------------------------------


def test_recall_of_near_duplicates_at_the_threshold(spark):
    """Pairs of 200 shingles each of which 172 are common: 172 / 228 = 0.754."""
    rows = []
    for i in range(300):
        w = brute.WORDS(204, 10_000 + i)
        v = list(w)
        v[60:84] = brute.WORDS(24, 20_000 + i)
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(v))]
    want = brute.near_duplicates(rows[:8])
    assert [r[2] for r in want] == [0, 0, 2, 2, 4, 4, 6, 6]
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(found[2 * i + 1] == 2 * i for i in range(300)) >= 0.99 * 300


def test_recall_of_embedding_links_at_the_threshold(spark):
    """Random pairs in 64 dimensions at cosine 0.951."""
    rng = np.random.default_rng(12)
    rows = []
    for i in range(1500):
        a, b = rng.normal(size=(2, 64))
        a /= np.linalg.norm(a)
        b -= a * (a @ b)
        b /= np.linalg.norm(b)
        c = 0.951 * a + math.sqrt(1 - 0.951**2) * b
        rows += [(2 * i, a.tolist()), (2 * i + 1, c.tolist())]
    found = {r["vec_id"]: r["component_id"] for r in embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert sum(found[2 * i + 1] == 2 * i for i in range(1500)) >= 0.99 * 1500


# ---- very long texts -----------------------------------------------------------------------


def test_tables_stay_small_whatever_the_text(monkeypatch):
    monkeypatch.setattr(text_module, "_POWERS", {})
    one = "some words of a long text, over and over again; "
    data = np.frombuffer(one.encode() * (50_000_000 // len(one)), np.uint8)
    found = words(data, np.array([0, len(data)]), SPACE)
    hashes = found.hashes()
    assert len(hashes) == len(found.starts) and (hashes.reshape(-1, 10) == hashes[:10]).all()
    _, windows = found.windows(hashes, 5)
    assert len(set(windows.tolist())) == 10
    assert max(map(len, text_module._POWERS.values())) == CHUNK + 1


def test_spans_longer_than_a_chunk_hash_alike():
    rng = np.random.default_rng(2)
    values, base = rng.integers(0, 256, 3 * CHUNK + 77, np.uint8), 0x9E3779B97F4A7C15
    spans = np.array([[0, 10], [5, CHUNK + 9], [7, 3 * CHUNK + 50], [CHUNK, 3 * CHUNK + 60], [3 * CHUNK, 3 * CHUNK + 77]])
    table = rng.integers(1, 1 << 62, 256, np.uint64)
    got = rolling(values, base, spans[:, 0], spans[:, 1], table)
    for (a, b), h in zip(spans.tolist(), got):
        total, power = 0, 1
        for v in table[values[a:b]].tolist():
            total = (total + v * power) & ((1 << 64) - 1)
            power = power * base & ((1 << 64) - 1)
        assert mix(np.array([total], np.uint64))[0] == h


def test_one_text_of_many_blocks_is_encoded_like_any(spark, tmp_path):
    text = "A text, longer than any block: 12 345 words of it, and more. " * 100_000
    folder = str(tmp_path / "long")
    got = [tuple(r) for r in read_tokens(spark, folder, write_tokens(spark.createDataFrame([(1, text)], "doc_id long, text string"), folder, TOKENIZER)).collect()]
    ids = Tokenizer.from_file(TOKENIZER).encode(text, add_special_tokens=False).ids + [0]
    assert got == [(1, 0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))]


# ---- stores ----------------------------------------------------------------------------------


def test_schemes_of_spark_paths_reach_the_same_stores(monkeypatch, tmp_path):
    seen = []

    class Stand:
        @staticmethod
        def from_uri(uri):
            seen.append(uri)
            return "fs", uri

    monkeypatch.setattr(stores.pyarrow.fs, "FileSystem", Stand)
    for path in ("s3a://b/x", "s3n://b/x", "s3://b/x", "viewfs://c/x", "hdfs://n:1/x", "gs://b/x", "abfs://c@a/x", "file:///x", "/x/a:b"):
        stores.open_folder(path)
    assert seen == ["s3://b/x", "s3://b/x", "s3://b/x", "hdfs://c/x", "hdfs://n:1/x", "gs://b/x", "abfss://c@a/x", "file:///x", "/x/a:b"]
    fs, path = stores.open_folder("dbfs:/some/folder")
    assert isinstance(fs, pyarrow.fs.LocalFileSystem) and path == "/dbfs/some/folder"


def test_an_unknown_scheme_names_the_known_ones():
    with pytest.raises(ValueError, match="s3a"):
        stores.open_folder("nosuch://b/x")


# ---- planted passages of op 7 ---------------------------------------------------------------------


def test_planted_passages_are_removed_from_400_bytes_on(spark, docs):
    """Passages of 51 to 120 words in two to four documents: bytes are removed exactly where 400 of them repeat."""
    from layerwright.llm.suffix_dedup import remove_repeated_strings

    rng = np.random.default_rng(6)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    sizes, planted = {}, []
    for i in range(40):
        passage = " ".join(brute.WORDS(int(rng.integers(51, 121)), 700_000 + i))
        for k in range(int(rng.integers(2, 5))):
            doc = 1_000_000 + 10 * i + k
            planted.append((doc, " ".join(brute.WORDS(80, 800_000 + doc)) + " " + passage + " " + " ".join(brute.WORDS(30, 900_000 + doc))))
            sizes[doc] = len(passage) + 2
    table = spark.createDataFrame(rows + planted, "doc_id long, text string")
    got = sorted(tuple(r) for r in remove_repeated_strings(table).drop("kept").collect())
    assert got == sorted(brute.repeated_strings(rows + planted))
    for doc, n_bytes, n_removed, *_ in got:
        if doc in sizes:
            assert (n_removed > 0) == (sizes[doc] >= 400) and n_removed <= sizes[doc] + 2
