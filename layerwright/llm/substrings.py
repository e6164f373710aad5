"""Substring dedup: Rabin-Karp hashes of every window of `size` words, counted in Spark.

A window is a repeat if its word sequence also starts earlier: in a document with
a smaller doc_id, or earlier in the same one.  Every word a repeat covers goes;
windows are judged on the input.

Most windows of a corpus occur once, so they are sorted out before they are
counted.  Each window has an anchor, the smallest hash of the runs of `gram`
words inside it; equal windows have equal anchors, and neighbouring windows mostly
share theirs, so there is about one anchor per seven words.  Anchors are counted
first, and only windows whose anchor occurs twice become rows (hash, doc_id),
once per document.  The smallest doc_id of each hash is found by a combined
aggregate, so a passage that a third of the documents share stays one row per map
task, and repeats inside one document are found where it is read.  Of documents
with the same text only the first takes part; a later copy loses all words.

Windows are counted by 128 bits, in two numbers; inside a document, and where the windows
found are looked up again in it, by the first 64 of them.

Defined cases: a NULL, empty or wordless text keeps nothing and loses nothing; a
text of fewer than `size` words has no window; rows that share a doc_id are equally
early, so neither repeats the other; a NULL doc_id comes after all others;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.llm.frames import prepare, stored, text_key
from layerwright.llm.text import SPACE, Words, sliding, text_blocks, words

SIZE = 20
GRAM = 8
_LAST = (1 << 63) - 1  # stands for a NULL doc_id: after all others


def anchored_windows(found: Words, size: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, anchor and hash of every window of a block."""
    hashes = found.hashes()
    at, window = found.windows(hashes, size)
    grams_at, grams = found.windows(hashes, gram)
    every = np.full(max(len(hashes), 1), np.iinfo(np.uint64).max, np.uint64)
    every[grams_at] = grams
    return at, sliding(np.minimum, every, size - gram + 1)[at] if len(at) else window, window


def _distinct(docs: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Places of one of each (document, value), in order of both."""
    order = np.lexsort((values, docs))
    d, v = docs[order], values[order]
    fresh = np.ones(len(d), bool)
    fresh[1:] = (d[1:] != d[:-1]) | (v[1:] != v[:-1])
    return order[fresh]


def _anchors(batches: Iterable[pa.RecordBatch], size: int, gram: int) -> Iterator[pa.RecordBatch]:
    """(anchor, doc): distinct anchors of each document."""
    for batch, data, offsets in text_blocks(batches, "text"):
        found = words(data, offsets, SPACE)
        at, anchor, _ = anchored_windows(found, size, gram)
        doc = found.doc[at]
        run = np.ones(len(at), bool)
        run[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
        doc, anchor = doc[run], anchor[run]
        one = _distinct(doc, anchor)
        yield pa.RecordBatch.from_arrays([pa.array(anchor[one].view(np.int64)), batch.column("doc").take(pa.array(doc[one]))], names=["anchor", "doc"])


def _candidates(batches: Iterable[pa.RecordBatch], size: int, gram: int) -> Iterator[pa.RecordBatch]:
    """(doc, h1, h2): distinct windows of each document that hold one of its repeated anchors."""
    for batch, data, offsets in text_blocks(batches, "text"):
        found = words(data, offsets, SPACE)
        at, anchor, h1 = anchored_windows(found, size, gram)
        doc = found.doc[at]
        keep = _holds(batch.column("anchors"), doc, anchor)
        at, h1, doc = at[keep], h1[keep], doc[keep]
        _, h2 = found.windows(found.hashes(1), size, 1)
        h2 = h2[keep]
        one = _distinct(doc, h1)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc").take(pa.array(doc[one])), pa.array(h1[one].view(np.int64)), pa.array(h2[one].view(np.int64))], names=["doc", "h1", "h2"])


def _among(values: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each value is in the sorted array `known`, and its place there."""
    place = np.searchsorted(known, values)
    place[place == len(known)] = 0
    return known[place] == values, place


def _holds(lists: pa.Array, doc: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether each (document, value) is among the document's list of hashes."""
    offsets = lists.offsets.to_numpy()
    listed = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].astype(np.int64).view(np.uint64)
    owner = np.repeat(np.arange(len(lists)), np.diff(offsets))
    out = np.zeros(len(values), bool)
    if not len(listed) or not len(values):
        return out
    unique, rank = np.unique(listed, return_inverse=True)
    known, place = _among(values, unique)
    near = np.flatnonzero(known)
    n = np.int64(len(unique))
    out[near] = _among(doc[near] * n + place[near], np.unique(owner * n + rank))[0]
    return out


def removed_words(found: Words, size: int, doc: np.ndarray, at: np.ndarray, h1: np.ndarray, repeated: np.ndarray) -> np.ndarray:
    """Mask of the words covered by windows that repeat elsewhere (`repeated`) or earlier in their own document."""
    order = np.lexsort((at, h1, doc))
    d, h = doc[order], h1[order]
    later = np.zeros(len(d), bool)
    later[1:] = (d[1:] == d[:-1]) & (h[1:] == h[:-1])
    gone = repeated.copy()
    gone[order[later]] = True
    steps = np.zeros(len(found.starts) + 1, np.int64)
    np.add.at(steps, at[gone], 1)
    np.add.at(steps, at[gone] + size, -1)
    return np.cumsum(steps[:-1]) > 0


def repeated_windows(docs: DataFrame, size: int, gram: int) -> DataFrame:
    """(doc, text, repeats, copy): the hashes of windows that start in an earlier document; whether one has the whole text."""
    firsts = docs.select("key", "doc").groupBy("key").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    docs_text = docs.select("doc", "text")
    anchors = stored(docs_text.mapInArrow(lambda b: _anchors(b, size, gram), "anchor bigint, doc bigint"), "anchors")
    counted = anchors.groupBy("anchor").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
    # A repeat inside one document needs no partner: it is found when the document is read.
    seen = counted.where("lo < hi").select("anchor")
    hits = stored(anchors.join(seen, "anchor").groupBy("doc").agg(F.collect_set("anchor").alias("anchors")), "anchor-hits")
    copies = docs.select("key", "doc").join(firsts, "key").where("doc > first").groupBy("doc").agg(F.collect_set("key").alias("copy_keys"))
    copies = stored(copies, "copies")
    known = F.coalesce(F.array_contains("copy_keys", F.col("key")), F.lit(False))
    sources = docs.join(hits, "doc").join(copies, "doc", "left").where(~known).select("doc", "text", "anchors")
    windows = stored(sources.mapInArrow(lambda b: _candidates(b, size, gram), "doc bigint, h1 bigint, h2 bigint"), "windows")
    earliest = windows.groupBy("h1", "h2").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi").select("h1", "h2", "lo")
    repeats = windows.join(earliest, ["h1", "h2"]).where("doc > lo").groupBy("doc").agg(F.collect_set("h1").alias("repeats"))
    marked = docs.join(stored(repeats, "repeats"), "doc", "left").join(copies, "doc", "left")
    return marked.select("doc", "text", F.coalesce("repeats", F.array().cast("array<bigint>")).alias("repeats"), known.alias("copy"))


_RESULT = "doc_id bigint, n_words bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept string"


def remove_repeats(docs: DataFrame, size: int = SIZE, gram: int = GRAM, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of docs: doc_id, n_words, n_removed, n_spans (runs of removed words), kept_sha256, kept (words joined by a space)."""
    if not 1 <= gram <= size:
        raise ValueError("gram must be between 1 and size")
    prepare(docs.sparkSession)
    source = docs.select(F.coalesce(F.col(doc).cast("bigint"), F.lit(_LAST)).alias("doc"), text_key(F.col(text)).alias("key"), F.col(text).alias("text"))
    marked = repeated_windows(source, size, gram)

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_blocks(batches, "text"):
            found = words(data, offsets, SPACE)
            at, h1 = found.windows(found.hashes(), size)
            owner = found.doc[at]
            copies = batch.column("copy").to_numpy(zero_copy_only=False).astype(bool)
            gone = removed_words(found, size, owner, at, h1, _holds(batch.column("repeats"), owner, h1) | copies[owner])
            steps = np.concatenate([[0], np.cumsum(gone)])
            runs = gone.copy()
            runs[1:] &= ~(gone[:-1] & (found.doc[1:] == found.doc[:-1]))
            spans = np.bincount(found.doc[runs], minlength=batch.num_rows)
            kept = [_kept(found, gone, d) for d in range(batch.num_rows)]
            ids = batch.column("doc").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64(), mask=ids == _LAST), pa.array(found.counts, pa.int64()),
                    pa.array(steps[found.first[1:]] - steps[found.first[:-1]], pa.int64()), pa.array(spans, pa.int64()),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept]), pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return marked.mapInArrow(apply, _RESULT)


def _kept(found: Words, gone: np.ndarray, doc: int) -> bytes:
    begin, end = found.first[doc], found.first[doc + 1]
    data, starts, ends = found.data, found.starts, found.ends
    stay = np.flatnonzero(~gone[begin:end]) + begin
    return b" ".join([data[s:e].tobytes() for s, e in zip(starts[stay].tolist(), ends[stay].tolist())])
