"""Suffix-array dedup: bytes of every string of `size` bytes that also starts elsewhere are removed.

The suffix arrays are built per shard by induced sorting, and their permuted
common prefixes tell which windows of `size` bytes occur twice.  Shards are dealt
so that equal windows meet: a window's anchor is the smallest hash of the runs of
`gram` bytes inside it, which depends on the window alone, and the stretch of
text whose windows share an anchor goes to the anchor's shard.  Anchors that occur
once in the corpus can't belong to a repeated window and send nothing.

An anchor whose stretches exceed `hot_bytes` (a passage in very many documents) is
split by document over several shards.  Inside each, the suffix array finds what
repeats there; for the rest each such shard gives the 128-bit hashes of its distinct
windows, which Spark counts over the anchor's shards.

Texts that occur more than once as a whole lose everything (if they have `size`
bytes) and only one copy of them enters the shards.

Defined cases: a NULL or empty text has no bytes; a text shorter than `size` keeps
all; repeated rows are copies of one another whatever their ids; a NULL doc_id is
a document like others; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.llm.frames import prepare, stored, text_key
from layerwright.llm.induced_sort import permuted_common_prefixes, suffix_array
from layerwright.llm.text import rolling, sliding, text_blocks

SIZE = 400
GRAM = 64
SHARD_BYTES = 768 << 10
HOT_BYTES = 4 << 20

_GRAM_BASE = 0x9E3779B97F4A7C15
_WINDOW_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_VALUES = np.random.default_rng(411).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SEPARATOR = 0xFF  # no byte of UTF-8
_NO_ID = (1 << 63) - 1


def anchor_runs(data: np.ndarray, offsets: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, ...]:
    """Stretches of window starts that share an anchor: document, first start in it, number of starts, anchor, and
    whether the anchor stands at several places of the document."""
    n, width = len(data) - size + 1, size - gram + 1
    if n <= 0:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, bool))
    at = np.arange(len(data) - gram + 1)
    grams = rolling(data, _GRAM_BASE, at, at + gram, _VALUES)
    anchor = sliding(np.minimum, grams, width)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    valid = owner[:n] == owner[size - 1 :]
    change = np.ones(n, bool)
    change[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:n] != owner[: n - 1])
    begins = valid & (change | ~np.append(False, valid[:-1]))
    stops = valid & (np.append(change[1:], True) | ~np.append(valid[1:], False))
    b, e = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    # Places that are the smallest of some window: equal to the largest minimum of the windows they are in.
    edge = np.zeros(width - 1, np.uint64)
    places = np.flatnonzero(grams == sliding(np.maximum, np.concatenate([edge, anchor, edge]), width))
    doc, value = np.append(owner[places], owner[b]), np.append(grams[places], anchor[b])
    run = np.append(np.full(len(places), -1), np.arange(len(b)))
    order = np.lexsort((run, value, doc))
    group = np.concatenate([[0], np.cumsum((np.diff(doc[order]) != 0) | (np.diff(value[order]) != 0))])
    several = (np.bincount(group, run[order] < 0) > 1)[group]
    twice = np.zeros(len(b), bool)
    mine = run[order] >= 0
    twice[run[order][mine]] = several[mine]
    return owner[b], b - offsets[owner[b]], e - b, anchor[b], twice


def _anchors(batches: Iterable[pa.RecordBatch], size: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Stretches as (anchor, node, place, twice); place holds the start in its high half, the number of starts in the low one."""
    for batch, data, offsets in text_blocks(batches, "text"):
        doc, start, run, anchor, twice = anchor_runs(data, offsets, size, gram)
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchor.view(np.int64)), batch.column("node").take(pa.array(doc)), pa.array(start << 32 | run), pa.array(twice)],
            names=["anchor", "node", "place", "twice"])


def _slices(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The bytes of each stretch, with the shard it goes to."""
    for batch, data, offsets in text_blocks(batches, "text"):
        rows: dict[str, list] = {n: [] for n in ("shard", "salt", "doc", "key", "start", "bytes")}
        docs, keys = batch.column("doc").to_pylist(), batch.column("key").to_pylist()
        for d, stretches in enumerate(batch.column("stretches").to_pylist()):
            for x in stretches:
                start, run = x["place"] >> 32, x["place"] & 0xFFFFFFFF
                begin, end = offsets[d] + start, offsets[d] + start + run + size - 1
                if end > offsets[d + 1]:
                    continue  # of another text with the same node
                rows["shard"].append(x["shard"])
                rows["salt"].append(x["salt"])
                rows["doc"].append(docs[d])
                rows["key"].append(keys[d])
                rows["start"].append(start)
                rows["bytes"].append(data[begin:end].tobytes())
        yield pa.RecordBatch.from_pydict(rows, _SLICE)


_SLICE = pa.schema([("shard", pa.int64()), ("salt", pa.int32()), ("doc", pa.int64()), ("key", pa.binary()), ("start", pa.int64()), ("bytes", pa.binary())])
_FOUND = pa.schema([
    ("doc", pa.int64()), ("key", pa.binary()), ("begin", pa.int64()), ("end", pa.int64()),
    ("shard", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("open", pa.bool_()),
])
_FOUND_DDL = "doc bigint, key binary, begin bigint, end bigint, shard bigint, h1 bigint, h2 bigint, open boolean"


def _distinct(table: pa.Table) -> tuple[list, list]:
    """Slices (key, doc, start, bytes, whether there are equal ones) of a shard, each content once; the others that have an equal one."""
    names = ("key", "doc", "start", "bytes")
    rows = set(zip(*(table.column(n).to_pylist() for n in names)))
    alike: dict[bytes, list] = {}
    for row in sorted(rows, key=lambda r: (r[0], r[1] is None, r[1] or 0, r[2])):
        alike.setdefault(row[3], []).append(row)
    return [(*r[0], len(r) > 1) for r in alike.values()], [x for r in alike.values() for x in r[1:]]


def _merged(rows: list) -> tuple[list, np.ndarray, list, np.ndarray, list]:
    """Slices joined where they overlap in one document: owners, starts, bytes, lengths; and the known stretches as (piece, begin, end)."""
    owners, starts, pieces, known = [], [], [], []
    for key, doc, start, raw, equal in sorted(rows, key=lambda r: (r[0], r[1] is None, r[1] or 0, r[2])):
        if owners and owners[-1] == (doc, key) and start <= starts[-1] + len(pieces[-1]):
            pieces[-1] += raw[max(0, starts[-1] + len(pieces[-1]) - start) :]
        else:
            owners.append((doc, key))
            starts.append(start)
            pieces.append(bytearray(raw))
        if equal:
            known.append((len(pieces) - 1, start - starts[-1], start - starts[-1] + len(raw)))
    return owners, np.array(starts, np.int64), pieces, np.array([len(p) for p in pieces], np.int64), known


def repeated_starts(pieces: list, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the pieces with separators, offset of each piece, and whether a window starting there occurs twice."""
    separator = bytes([_SEPARATOR])
    raw = np.frombuffer(separator.join(pieces) + separator, np.uint8)
    at = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    ends = np.repeat(at + lengths, lengths + 1)
    limit = ends - np.arange(len(raw))
    symbols = raw.astype(np.int32) + 1
    order = suffix_array(np.append(symbols, 0))
    limit = np.append(limit, 0)
    shared, partner = permuted_common_prefixes(np.append(raw, np.uint8(_SEPARATOR)), order, limit)
    hit = shared >= size
    hit[partner[hit]] = True
    return raw, at, hit[:-1]


def _shard(table: pa.Table, size: int) -> pa.Table:
    """Repeated stretches of one shard; of a part of a hot anchor also its distinct windows.

    Slices with the same bytes are repeats from end to end, and one of them stands for all in the suffix array.
    """
    rows, others = _distinct(table)
    owners, starts, pieces, lengths, known = _merged(rows)
    raw, at, hit = repeated_starts(pieces, lengths, size)
    for piece, begin, end in known:
        hit[at[piece] + begin : at[piece] + end - size + 1] = True
    cover = np.zeros(len(raw) + 1, np.int64)
    begins = np.flatnonzero(hit)
    np.add.at(cover, begins, 1)
    np.add.at(cover, begins + size, -1)
    covered = np.cumsum(cover[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
    b, e = edges[::2], edges[1::2]  # separators are never covered, so a run lies in one piece
    piece = np.searchsorted(at, b, "right") - 1
    out = [_rows(owners, piece, starts[piece] + b - at[piece], starts[piece] + e - at[piece])]
    begin = np.array([o[2] for o in others], np.int64)
    out.append(_rows([(o[1], o[0]) for o in others], range(len(others)), begin, begin + np.array([len(o[3]) for o in others], np.int64)))
    salt, shard = table.column("salt")[0].as_py(), table.column("shard")[0].as_py()
    if salt >= 0:
        whole = np.repeat(at + lengths, lengths + 1) - np.arange(len(raw)) >= size
        w = np.flatnonzero(whole)
        h1, h2 = (rolling(raw, base, w, w + size, _VALUES) for base in _WINDOW_BASES)
        _, one = np.unique(h1, return_index=True)
        w, h1, h2 = w[one], h1[one], h2[one]
        piece = np.searchsorted(at, w, "right") - 1
        place = starts[piece] + w - at[piece]
        out.append(_rows(owners, piece, place, place + size, shard, h1, h2, ~hit[w]))
    return pa.concat_tables(out)


def _rows(owners, piece, begin, end, shard=None, h1=None, h2=None, open_=None) -> pa.Table:
    n = len(piece)
    null = lambda kind: pa.nulls(n, kind)
    return pa.table([
        pa.array([owners[p][0] for p in piece], pa.int64()), pa.array([owners[p][1] for p in piece], pa.binary()), pa.array(begin, pa.int64()), pa.array(end, pa.int64()),
        null(pa.int64()) if shard is None else pa.array(np.full(n, shard, np.int64)),
        null(pa.int64()) if h1 is None else pa.array(h1.view(np.int64)), null(pa.int64()) if h2 is None else pa.array(h2.view(np.int64)),
        null(pa.bool_()) if open_ is None else pa.array(open_),
    ], schema=_FOUND)


def repeated_stretches(docs: DataFrame, later: DataFrame, size: int, gram: int, shard_bytes: int, hot_bytes: int) -> DataFrame:
    """docs(doc, key, node, text), copies left out by `later`: (doc, key, begin, end) of stretches covered by repeated windows."""
    found = docs.select("node", "text").mapInArrow(lambda b: _anchors(b, size, gram), "anchor bigint, node bigint, place bigint, twice boolean")
    found = stored(found.join(later, "node", "left_anti"), "byte-anchors")
    extent = F.sum(F.col("place").bitwiseAND(0xFFFFFFFF) + (size - 1))
    seen = found.groupBy("anchor").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.max("twice").alias("twice"), extent.alias("bytes"))
    seen = stored(seen.where("lo != hi or twice").select("anchor", F.ceil(F.col("bytes") / hot_bytes).cast("int").alias("salts"), "bytes"), "repeated-anchors")
    total = seen.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard_bytes))
    hot = F.col("salts") > 1
    shard = F.when(hot, F.col("anchor")).otherwise(F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    salt = F.when(hot, F.pmod(F.xxhash64("node"), F.col("salts")).cast("int")).otherwise(F.lit(-1))
    stretches = found.join(seen.select("anchor", "salts"), "anchor").groupBy("node").agg(
        F.collect_list(F.struct(shard.alias("shard"), salt.alias("salt"), "place")).alias("stretches"))
    joined = docs.join(stored(stretches, "anchor-places"), "node").select("doc", "key", "text", "stretches")
    slices = joined.mapInArrow(lambda b: _slices(b, size), "shard bigint, salt int, doc bigint, key binary, start bigint, bytes binary")
    rows = stored(slices.groupBy("shard", "salt").applyInArrow(lambda t: _shard(t, size), _FOUND_DDL), "stretches")
    windows = rows.where("h1 is not null")
    common = windows.groupBy("shard", "h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("shard", "h1", "h2")
    across = windows.where("open").join(common, ["shard", "h1", "h2"], "left_semi")
    return rows.where("h1 is null").select("doc", "key", "begin", "end").unionAll(across.select("doc", "key", "begin", "end"))


_RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def remove_repeated_strings(
    docs: DataFrame, size: int = SIZE, gram: int = GRAM, shard_bytes: int = SHARD_BYTES, hot_bytes: int = HOT_BYTES,
    doc: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the bytes kept."""
    if not 1 <= gram <= size:
        raise ValueError("gram must be between 1 and size")
    prepare(docs.sparkSession)
    source = docs.select(F.col(doc).cast("bigint").alias("doc"), text_key(F.col(text)).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # A document is known by 64 bits of its id and text where its stretches are counted, which keeps those rows short.
    source = source.withColumn("node", F.xxhash64(F.coalesce(F.col("doc"), F.lit(_NO_ID)), "key"))
    long = source.where(F.octet_length("text") >= size)
    # NULL ids count as the largest, so that a group of copies has one first row to stand for it.
    rank = F.coalesce(F.col("doc"), F.lit(_NO_ID))
    narrow = stored(long.select("doc", "key", "node"), "text-keys")
    groups = narrow.groupBy("key").agg(F.count("*").alias("n"), F.min(rank).alias("first")).where("n > 1")
    alike = narrow.join(groups, "key").select("doc", "key", "node", (rank > F.col("first")).alias("later"))
    alike = stored(alike, "alike")
    copies = alike.groupBy(F.col("doc").alias("copy_doc")).agg(F.collect_set("key").alias("copy_keys"))
    same = F.col("doc").eqNullSafe(F.col("copy_doc"))
    stretches = repeated_stretches(long, alike.where("later").select("node").distinct(), size, gram, shard_bytes, hot_bytes)
    spans = stretches.groupBy("doc").agg(F.collect_list(F.struct("key", "begin", "end")).alias("spans"))
    spans = stored(spans.withColumnRenamed("doc", "span_doc"), "spans")
    none = F.array().cast(spans.schema["spans"].dataType)
    marked = source.join(spans, F.col("doc").eqNullSafe(F.col("span_doc")), "left").join(copies, same, "left").select(
        "doc", "text", F.filter(F.coalesce("spans", none), lambda s: s["key"] == F.col("key")).alias("spans"), F.coalesce(F.array_contains("copy_keys", F.col("key")), F.lit(False)).alias("copy"))

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_blocks(batches, "text"):
            cover = np.zeros(len(data) + 1, np.int64)
            lists = batch.column("spans")
            flat = lists.flatten()
            owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            np.add.at(cover, flat.field("begin").to_numpy() + offsets[owner], 1)
            np.add.at(cover, flat.field("end").to_numpy() + offsets[owner], -1)
            copies_at = np.flatnonzero(batch.column("copy").to_numpy(zero_copy_only=False).astype(bool))
            np.add.at(cover, offsets[copies_at], 1)
            np.add.at(cover, offsets[copies_at + 1], -1)
            gone = np.cumsum(cover[:-1]) > 0
            steps = np.concatenate([[0], np.cumsum(gone)])
            run = gone.copy()
            run[1:] &= ~gone[:-1]
            heads = offsets[:-1][offsets[:-1] < len(data)]
            run[heads] = gone[heads]
            runs = np.concatenate([[0], np.cumsum(run)])
            kept = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"), pa.array(np.diff(offsets)), pa.array(steps[offsets[1:]] - steps[offsets[:-1]]),
                    pa.array(runs[offsets[1:]] - runs[offsets[:-1]]), pa.array([hashlib.sha256(k).hexdigest() for k in kept]), pa.array(kept, pa.binary()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return marked.mapInArrow(apply, _RESULT)
