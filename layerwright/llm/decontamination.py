"""Benchmark decontamination: a broadcast hash set of test n-grams scanned over whole documents.

Texts are lower-cased (A-Z) and cut into runs of digits, a-z and non-ASCII
characters.  Each item gives its windows of `n` words, or one shorter window if
it has fewer.  Their hashes are broadcast; a document window whose hash is in the
set is verified word for word.  A set above `max_windows` is cut into sets that each meet
the bound; the documents are scanned once per set, one set after the other, and at no time
is there more than one set in the driver or a worker.  The hits of a text are joined, and
spans are cut once, after the hits of all sets are known.

Defined cases: a NULL or wordless text has no words and no hits; an item without
words has no window; repeated items count by their distinct ids; repeated
documents are judged alike; an empty benchmark hits nothing; NULL item ids are
left out of the ids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.llm.frames import prepare, stored, text_key
from layerwright.llm.text import NON_ALNUM, Words, text_blocks, words

MAX_WINDOWS = 500_000

_SPANS = "n_words bigint, spans array<struct<first:int,size:int>>, items array<string>"


def benchmark_windows(benchmark: DataFrame, n: int = 10, item: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct windows of all items: hash, size, the words, and the ids of the items that have it."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_blocks(batches, "text"):
            found = words(data, offsets, NON_ALNUM, lower=True)
            hashes = found.hashes()
            ids = batch.column("item").to_pylist()
            rows: dict[str, list] = {"hash": [], "size": [], "words": [], "item": []}
            for size in sorted({n, *(int(c) for c in found.counts if 0 < c < n)}):
                for at, h in zip(*found.windows(hashes, size)):
                    doc = found.doc[at]
                    if size == n or found.counts[doc] == size:
                        rows["hash"].append(int(h.astype(np.int64)))
                        rows["size"].append(size)
                        rows["words"].append(found.joined(at, size))
                        rows["item"].append(ids[doc])
            yield pa.RecordBatch.from_pydict(rows, _WINDOWS)

    source = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))
    return source.mapInArrow(cut, "hash bigint, size int, words binary, item string").groupBy("hash", "size", "words").agg(F.collect_set("item").alias("items"))


_WINDOWS = pa.schema([("hash", pa.int64()), ("size", pa.int32()), ("words", pa.binary()), ("item", pa.string())])


class NgramSet:
    """Windows by hash: a bit table answers most lookups, a sorted array the rest."""

    def __init__(self, rows: list):
        self.sizes = sorted({r["size"] for r in rows})
        self.known: dict[tuple[int, int], list] = {}
        for r in rows:
            self.known.setdefault((r["size"], r["hash"]), []).append((bytes(r["words"]), r["items"]))
        hashes = np.array([r["hash"] for r in rows], np.int64).view(np.uint64)
        self.mask = np.uint64((1 << max(16, int(16 * len(rows) + 1).bit_length())) - 1)
        self.bits = np.zeros(int(self.mask) + 1, bool)
        self.bits[hashes & self.mask] = True
        self.sorted = np.unique(hashes)

    def hits(self, found: Words) -> Iterator[tuple[int, int, list]]:
        """(first word, size, item ids) of every verified window of a block, in order of size and place."""
        hashes = found.hashes()
        for size in self.sizes:
            at, h = found.windows(hashes, size)
            near = np.flatnonzero(self.bits[h & self.mask])
            if len(near):
                place = np.searchsorted(self.sorted, h[near])
                near = near[self.sorted[np.minimum(place, len(self.sorted) - 1)] == h[near]]
            for i in near:
                for text, items in self.known.get((size, int(h[i].astype(np.int64))), ()):
                    if found.joined(at[i], size) == text:
                        yield int(at[i]), size, items


def _parts(benchmark: DataFrame, n: int, item: str, text: str, max_windows: int) -> tuple[DataFrame, int]:
    """The windows, and into how many sets of at most max_windows they are cut (one, unless the benchmark is very large)."""
    table = benchmark_windows(benchmark, n, item, text)
    count = table.count()
    if count <= max_windows:
        return table, 1
    return stored(table, "benchmark-windows"), -(-count // max(1, max_windows // 2))


def _set(table: DataFrame, part: int, parts: int):
    """One set, broadcast."""
    rows = (table if parts == 1 else table.where(F.pmod(F.xxhash64("words"), F.lit(parts)) == part)).collect()
    return table.sparkSession.sparkContext.broadcast(NgramSet(rows))


def _scanned(source: DataFrame, table: DataFrame, parts: int) -> DataFrame:
    """`_scan` of every set, one after the other: a set's hits are stored and its broadcast is gone before the next is made.

    Rows with no hit are kept from the first scan alone (column `part` tells the scans apart).
    """
    out = None
    for part in range(parts):
        shared = _set(table, part, parts)
        found = _scan(source, shared).withColumn("part", F.lit(part))
        found = stored(found if part == 0 else found.where(F.size("spans") > 0), f"benchmark-hits-{part}")
        shared.destroy()
        out = found if out is None else out.unionAll(found)
    return out


def _scan(source: DataFrame, shared) -> DataFrame:
    """id and key of each document with its hit spans and items, from one broadcast set."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch, data, offsets in text_blocks(batches, "text"):
            found = words(data, offsets, NON_ALNUM, lower=True)
            spans: list[list] = [[] for _ in range(batch.num_rows)]
            items: list[set] = [set() for _ in range(batch.num_rows)]
            for at, size, ids in known.hits(found):
                doc = found.doc[at]
                spans[doc].append({"first": at - int(found.first[doc]), "size": size})
                items[doc].update(ids)
            columns = [batch.column(c) for c in batch.schema.names if c != "text"]
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [
                    *columns,
                    pa.array(found.counts, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("size", pa.int32())]))),
                    pa.array([sorted(i) for i in items], pa.list_(pa.string())),
                ],
                names=[*names, "n_words", "spans", "items"],
            )

    kept = [f for f in source.schema.fields if f.name != "text"]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept), _SPANS])
    return source.mapInArrow(scan, schema)


def contamination(
    docs: DataFrame, benchmark: DataFrame, n: int = 10, doc: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items (sorted ids), items_sha256, contaminated."""
    prepare(docs.sparkSession)
    table, parts = _parts(benchmark, n, item, item_text, max_windows)
    source = docs.select(F.col(doc).alias("doc_id"), F.col(text).alias("text"))
    if parts == 1:
        hits = _scan(source, _set(table, 0, 1))
    else:
        whole = _scanned(source.withColumn("key", text_key(F.col("text"))), table, parts)
        # Rows alike in id and text have alike hits, so they are counted and given back as many times.
        whole = whole.groupBy("doc_id", "key").agg(
            F.max("n_words").alias("n_words"), F.flatten(F.collect_set("spans")).alias("spans"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"), F.count_if(F.col("part") == 0).cast("int").alias("copies"))
        hits = whole.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    places = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["first"], s["first"] + s["size"] - 1))))
    ids = F.array_sort("items")
    return hits.select(
        "doc_id", "n_words",
        F.size(places).cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        ids.alias("items"), "spans",
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, n: int = 10, remove: str = "documents", text: str = "text",
    item: str = "item_id", item_text: str = "text", max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """The documents without their benchmark passages, all their columns as they are.

    remove="documents" drops every document with a hit; remove="spans" cuts the
    bytes from the first to the last word of each run of hit words.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove must be documents or spans")
    prepare(docs.sparkSession)
    table, parts = _parts(benchmark, n, item, item_text, max_windows)
    if parts == 1:
        return docs.mapInArrow(_cleaner(_set(table, 0, 1), text, remove), docs.schema)
    # Hits follow from the text alone, and windows of different sets overlap: all hits of a text are known before anything is cut.
    mark = "_hits" + "_" * max(map(len, docs.columns))
    key = mark + "key"
    texts = docs.select(text_key(F.col(text)).alias("key"), F.col(text).alias("text"))
    hits = _scanned(texts, table, parts).where(F.size("spans") > 0).groupBy(F.col("key").alias(key)).agg(F.flatten(F.collect_set("spans")).alias("spans"))
    keyed = docs.withColumn(key, text_key(F.col(text)))
    if remove == "documents":
        return keyed.join(hits, key, "left_anti").select(*docs.columns)
    places = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["first"], s["first"] + s["size"] - 1))))
    marked = keyed.join(hits.select(key, places.alias(mark)), key, "left").select(*docs.columns, F.coalesce(mark, F.array().cast("array<int>")).alias(mark))
    return marked.mapInArrow(_cleaner(None, text, remove, mark), docs.schema)


def _marked(batch: pa.RecordBatch, mark: str | None, found: Words) -> np.ndarray:
    """Which words of a block are marked as hit."""
    hit = np.zeros(len(found.starts), bool)
    if mark is not None:
        column = batch.column(mark)
        doc = pc.list_parent_indices(column).to_numpy()
        hit[found.first[doc] + column.flatten().to_numpy()] = True
    return hit


def _cleaner(shared, text: str, remove: str, mark: str | None = None):
    def clean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if shared is None else shared.value
        for batch, data, offsets in text_blocks(batches, text):
            found = words(data, offsets, NON_ALNUM, lower=True)
            hit = _marked(batch, mark, found)
            if mark is not None:
                batch = batch.drop_columns([mark])
            for at, size, _ in known.hits(found) if known else ():
                hit[at : at + size] = True
            dirty = np.unique(found.doc[hit])
            if remove == "documents":
                keep = np.ones(batch.num_rows, bool)
                keep[dirty] = False
                yield batch.filter(pa.array(keep))
            elif not len(dirty):
                yield batch
            else:
                place = batch.schema.get_field_index(text)
                texts = batch.column(place).to_pylist()
                for d in dirty:
                    texts[d] = _cut(data, offsets, found, hit, int(d))
                yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    return clean


def _cut(data: np.ndarray, offsets: np.ndarray, found: Words, hit: np.ndarray, doc: int) -> str:
    at = offsets[doc]
    pieces = []
    mine = np.arange(found.first[doc], found.first[doc + 1])
    runs = np.flatnonzero(np.diff(np.concatenate(([0], hit[mine].view(np.int8), [0]))))
    for begin, end in zip(runs[::2], runs[1::2]):
        pieces.append(data[at : found.starts[mine[begin]]].tobytes())
        at = found.ends[mine[end - 1]]
    pieces.append(data[at : offsets[doc + 1]].tobytes())
    return b"".join(pieces).decode()
