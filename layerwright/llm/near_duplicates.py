"""MinHash near-dedup with odd sketches: bands propose, parity bitmaps sort out, full shingle sets confirm.

A document's set holds the 64-bit hashes of its distinct runs of `shingle` words
(A-Z lower-cased; the whole sequence if it has fewer).  Documents with equal sets
are one class, and only a class's smallest doc_id takes part further on.

* MinHash: `bands * rows` minima per class; a band's minima hash to its bucket.
* Odd sketches: each minimum flips one bit of a 1024-bit parity map, so the bits in
  which two maps differ count the minima in which they differ, precisely for high
  similarities.  A pair is dropped only if it differs in more bits than a pair at
  the threshold can by chance (`SPREADS` standard deviations).  A second map takes
  all shingles: its bits can't differ in more places than the sets do, so it and the
  set sizes rule pairs out for certain, above all of short texts.
* What is left is confirmed on the full sets, which are cut from the texts of those
  documents alone that share a bucket.

Buckets may hold a third of all documents, so they are never expanded into all
pairs.  First every member is compared with its bucket's smallest member; the
links found give components.  Then only members of one bucket that are still in
*different* components are paired (a bucket whose members are together by then
costs nothing), and components are taken again.  At the threshold a pair shares no
bucket with probability (1 - 0.75^5)^48 = 2e-6, above it less.

Texts that share a template meet in large buckets without being near duplicates.  A bucket
in which more than `PART` members stand outside the main component is therefore split
by further minima of its members: `TABLES` other bands each, again where parts are still
that large, up to `DEPTH` times.  Only members of one part are paired.  A pair at the
threshold that shares a bucket shares a part of it with probability 1 - (1 - 0.75^5)^6 =
0.80 a level, so it is missed in all of its buckets with (1 - 0.24 * 0.65)^48 = 3e-4 if
all of them are split twice; parts left large after that are paired whole.

Defined cases: a NULL, empty or wordless text has an empty set, links with
nothing and is its own component; rows with one doc_id are one node; a NULL
doc_id is linked with nothing and kept; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.llm.frames import components, prepare, stored
from layerwright.llm.text import SPACE, mix, text_blocks, words

SHINGLE = 5
BANDS, ROWS = 48, 5
SKETCH_WORDS = 16  # 1024 bits
SPREADS = 4.5
PART, TABLES, DEPTH = 256, 6, 2  # up to so many outsiders, pairing a bucket costs less than splitting it
MAX_BROADCAST_IDS = 1_000_000  # 8 MB of ids: more are joined by a shuffle


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a block's documents, ordered by document and hash; first entry of each document."""
    found = words(data, offsets, SPACE, lower=True)
    hashes = found.hashes()
    at, values = found.windows(hashes, size)
    docs = found.doc[at]
    for few in range(1, size):
        if np.any(found.counts == few):
            at, whole = found.windows(hashes, few)
            whole, at = whole[found.counts[found.doc[at]] == few], at[found.counts[found.doc[at]] == few]
            docs, values = np.concatenate([docs, found.doc[at]]), np.concatenate([values, whole])
    order = np.lexsort((values, docs))
    docs, values = docs[order], values[order]
    fresh = np.ones(len(docs), bool)
    fresh[1:] = (docs[1:] != docs[:-1]) | (values[1:] != values[:-1])
    docs, values = docs[fresh], values[fresh]
    return values, np.searchsorted(docs, np.arange(len(offsets)))


class Signer:
    """MinHash bands and odd sketches of many sets at once."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, sketch_words: int = SKETCH_WORDS, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.bands, self.rows, self.words = bands, rows, sketch_words
        self.salts = rng.integers(0, 1 << 63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
        self.shifts = rng.integers(0, 1 << 63, bands * rows, np.uint64)

    def sign(self, values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sets, bands) bucket hashes and (sets, words) sketches of the non-empty sets first[i]:first[i+1]."""
        begin = first[:-1]
        n, k = len(begin), self.bands * self.rows
        minima = np.empty((k, n), np.uint64)
        for i in range(k):
            # Multiply and shift: the high half of an odd multiple orders the hashes anew.
            minima[i] = np.minimum.reduceat((values * self.salts[i] + self.shifts[i]) >> np.uint64(16), begin)
        buckets = np.zeros((n, self.bands), np.uint64)
        for b in range(self.bands):
            h = np.full(n, b + 1, np.uint64)
            for r in range(self.rows):
                h = mix(h ^ minima[b * self.rows + r])
            buckets[:, b] = h
        sketch = np.zeros((n, self.words), np.uint64)
        rows = np.arange(n)
        for i in range(k):
            bit = mix(minima[i] + np.uint64(i + 1)) % np.uint64(64 * self.words)
            sketch[rows, (bit >> np.uint64(6)).astype(np.int64)] ^= np.uint64(1) << (bit & np.uint64(63))
        return buckets.view(np.int64), sketch.view(np.int64)

    def parity(self, values: np.ndarray, first: np.ndarray) -> np.ndarray:
        """(sets, words) odd sketches of all members of the sets."""
        out = np.zeros((len(first) - 1) * self.words, np.uint64)
        bit = mix(values + np.uint64(1)) % np.uint64(64 * self.words)
        owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        np.bitwise_xor.at(out, owner * self.words + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
        return out.reshape(-1, self.words).view(np.int64)


def most_differing_bits(percent: int = 75, samples: int = BANDS * ROWS, bits: int = 64 * SKETCH_WORDS, spreads: float = SPREADS) -> int:
    """Bits in which two sketches at the threshold differ at most, but for chance beyond `spreads` deviations.

    Of `samples` minima a binomial number d differs; each flips a bit in either
    map, which leaves bits * (1 - (1 - 2/bits)^(2d)) / 2 odd ones on average.
    """
    miss = 1 - percent / 100
    d = samples * miss
    even = (1 - 2 / bits) ** (2 * d)
    from_minima = samples * miss * (1 - miss) * (2 * even) ** 2
    from_bits = bits / 4 * (1 - (1 - 4 / bits) ** (2 * d))
    return min(bits, math.ceil(bits / 2 * (1 - even) + spreads * math.sqrt(from_minima + from_bits)))


def set_signatures(docs: DataFrame, signer: Signer, shingle: int, doc: str, text: str) -> DataFrame:
    """doc_id, n_shingles, the set's 128-bit identity (k1, k2), bands, sketch and parity (empty for an empty set)."""

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_blocks(batches, "text"):
            values, first = shingles(data, offsets, shingle)
            counts = np.diff(first)
            full = np.flatnonzero(counts)
            k1, k2 = np.zeros(len(counts), np.uint64), np.zeros(len(counts), np.uint64)
            bands, sketches = np.zeros((0, signer.bands), np.int64), np.zeros((0, signer.words), np.int64)
            parity = sketches
            if len(full):
                begin = np.concatenate([first[full], [len(values)]])
                k1[full] = np.add.reduceat(mix(values), begin[:-1])
                k2[full] = np.add.reduceat(mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), begin[:-1])
                bands, sketches = signer.sign(values, begin)
                parity = signer.parity(values, begin)
            lists = []
            for table in (bands, sketches, parity):
                ends = np.zeros(len(counts) + 1, np.int32)
                ends[1:] = np.cumsum((counts > 0) * table.shape[1])
                lists.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(table.ravel())))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), *lists],
                names=["doc_id", "n_shingles", "k1", "k2", "bands", "sketch", "parity"],
            )

    source = docs.select(F.col(doc).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(sign, "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, bands array<bigint>, sketch array<bigint>, parity array<bigint>")


def shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """doc_id and its whole set of shingle hashes."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_blocks(batches, "text"):
            values, first = shingles(data, offsets, shingle)
            sets = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sets], names=["doc_id", "shingles"])

    return texts.mapInArrow(cut, "doc_id bigint, shingles array<bigint>")


def _bits_apart(a: str, b: str, n: int = SKETCH_WORDS):
    return sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(n)), F.lit(0))


def _side(sketches: DataFrame, name: str) -> DataFrame:
    return sketches.select(*(F.col(c).alias(f"{c}_{name}") for c in sketches.columns))


def _allowed(percent: int):
    """What set sizes and parity maps of all shingles leave possible of a pair of _side() rows.

    At the threshold p the sets differ in (1 - p) / (1 + p) of their joint size.
    """
    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    return sizes & (_bits_apart("parity_a", "parity_b") * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent))


def _likely(pairs: DataFrame, sketches: DataFrame, percent: int, near: int) -> DataFrame:
    """The pairs (id_a, id_b) that sizes, parity maps and odd sketches of the minima leave."""
    both = pairs.join(_side(sketches, "a"), "id_a").join(_side(sketches, "b"), "id_b").where(_allowed(percent))
    return both.where(_bits_apart("sketch_a", "sketch_b") <= near).select("id_a", "id_b").distinct()


def _states(rows: DataFrame) -> DataFrame:
    """bucket, main (its largest component) and outside (members not of it), of the buckets with several components."""
    parts = rows.groupBy("bucket", "component").agg(F.count("*").alias("m"))
    return parts.groupBy("bucket").agg(
        F.max_by("component", F.struct("m", "component")).alias("main"), (F.sum("m") - F.max("m")).alias("outside"), F.count("*").alias("parts")).where("parts > 1").drop("parts")


def open_parts(placed: DataFrame, signed: DataFrame, bands: int, part: int = PART, tables: int = TABLES, depth: int = DEPTH) -> DataFrame:
    """bucket, id, component, main of what is to be paired; placed(bucket, id, component, used), signed(id, bands).

    Buckets that hold one component drop out.  Those with more than `part` members outside
    their main one are split by further bands of their members: a part's members agree in all
    bands that led to it.  A part reached by two ways is one.
    """
    whole = placed.join(_states(placed), "bucket")
    out, large = whole.where(F.col("outside") <= part), whole.where(F.col("outside") > part)
    for level in range(depth):
        large = stored(large, f"large-buckets-{level}")
        if large.isEmpty():
            return out.select("bucket", "id", "component", "main")
        unused = F.array_except(F.sequence(F.lit(0), F.lit(bands - 1)), "used")
        turn = F.pmod("bucket", F.size("unused")).cast("int")
        # The same bands for all members of a bucket: as many as `tables` from a place that its hash names.
        chosen = F.slice(F.concat(F.slice("unused", turn + 1, F.size("unused")), F.slice("unused", F.lit(1), turn)), 1, tables)
        rows = large.select("bucket", "id", "component", "used").withColumn("unused", unused).where(F.size("unused") > 0)
        rows = rows.select("id", "component", "used", F.explode(chosen).alias("band")).join(signed, "id")
        rows = rows.withColumn("used", F.array_sort(F.array_append("used", F.col("band"))))
        key = F.xxhash64(F.transform("used", lambda b: F.struct(b.alias("band"), F.get("bands", b).alias("value"))))
        rows = stored(rows.select(key.alias("bucket"), "id", "component", "used").dropDuplicates(["bucket", "id"]), f"split-buckets-{level}")
        whole = rows.join(_states(rows), "bucket")
        out = out.unionByName(whole.where(F.col("outside") <= part))
        large = whole.where(F.col("outside") > part)
    return out.unionByName(large).select("bucket", "id", "component", "main")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = 75, bands: int = BANDS, rows: int = ROWS,
    doc: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, class_id (smallest doc_id with an equal set), component_id, kept.

    Links join documents with 100 * |intersection| >= percent * |union|.
    """
    prepare(docs.sparkSession)
    signer = Signer(bands, rows)
    signed = stored(set_signatures(docs, signer, shingle, doc, text), "signatures")
    classes = signed.where("n_shingles > 0 and doc_id is not null").groupBy("n_shingles", "k1", "k2").agg(F.min("doc_id").alias("class_id"))
    members = stored(
        signed.select("doc_id", "n_shingles", "k1", "k2").join(
            classes.withColumnsRenamed({"n_shingles": "n", "k1": "c1", "k2": "c2"}),
            (F.col("n_shingles") == F.col("n")) & (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")), "left",
        ).select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id"), "k1", "k2"), "classes")
    # One row per class, combined before the shuffle (a doc_id may stand for two classes, by repeated rows).
    firsts = signed.where("n_shingles > 0 and doc_id is not null").groupBy("n_shingles", "k1", "k2").agg(
        F.min("doc_id").alias("id"), F.min_by(F.struct("bands", "sketch", "parity"), "doc_id").alias("s"))
    firsts = stored(firsts.select("id", F.col("n_shingles").alias("n"), "s.*"), "representatives")
    buckets = firsts.select("id", F.posexplode("bands").alias("band", "bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("id").alias("center"), F.max("id").alias("top")).where("center < top").select("bucket", "center")
    buckets = stored(buckets.join(shared, "bucket"), "buckets")

    # What the comparisons need, of the documents that share a bucket.
    active = stored(buckets.select("id").distinct(), "active")
    sketches = stored(firsts.join(active, "id", "left_semi").select("id", "n", "sketch", "parity"), "sketches")
    ids = active.select(F.col("id").alias("doc_id"))
    ids = F.broadcast(ids) if ids.count() <= MAX_BROADCAST_IDS else ids
    texts = docs.select(F.col(doc).cast("bigint").alias("doc_id"), F.col(text).alias("text")).join(ids, "doc_id", "left_semi")
    sets = stored(shingle_sets(texts, shingle), "sets")

    near = most_differing_bits(percent, bands * rows)
    stars = buckets.where("id > center").select(F.col("center").alias("id_a"), F.col("id").alias("id_b")).distinct()
    stars = stored(_likely(stars, sketches, percent, near), "star-pairs")
    links = stored(_confirmed(stars, sets, percent), "star-links")
    joined = components(links, "star-components")

    # Members of one bucket in different components: those outside the bucket's main component, against all.  A bucket
    # that came together drops out before any pairing, and a large component is never paired with itself.
    placed = buckets.join(joined, buckets["id"] == joined["node"], "left").select(
        "bucket", "id", F.coalesce("component", "id").alias("component"), F.array("band").alias("used"))
    rest = stored(open_parts(stored(placed, "placed"), firsts.select("id", "bands"), bands).join(sketches.drop("sketch"), "id"), "open-buckets")
    outside, everyone = _side(rest.where("component != main"), "a"), _side(rest, "b")
    once = (F.col("component_b") == F.col("main_b")) | (F.col("id_a") < F.col("id_b"))
    apart = (F.col("component_a") != F.col("component_b")) & once & _allowed(percent)
    across = outside.join(everyone, (F.col("bucket_a") == F.col("bucket_b")) & apart).select(
        F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b")).distinct()
    across = stored(_likely(across.join(stars, ["id_a", "id_b"], "left_anti"), sketches, percent, near), "cross-pairs")
    links = links.unionAll(_confirmed(across, sets, percent))
    # A doc_id on rows of different sets joins their classes.
    twice = members.where("class_id is not null").groupBy("doc_id").agg(F.min("class_id").alias("a"), F.max("class_id").alias("b")).where("a < b")
    twice = members.where("class_id is not null").join(twice.select("doc_id"), "doc_id").select(F.col("doc_id").alias("a"), F.col("class_id").alias("b"))
    final = components(links.select("a", "b").unionAll(twice), "components")
    lowest = members.where("class_id is not null").groupBy("doc_id").agg(F.min("class_id").alias("any_class"))
    found = lowest.join(final, lowest["any_class"] == final["node"], "left").select(F.col("doc_id").alias("d"), F.coalesce("component", "any_class").alias("component"))
    out = members.join(found, F.col("doc_id") == F.col("d"), "left")
    return out.select(
        "doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component", "doc_id"), F.lit(True)).alias("kept"))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    first = sets.select(F.col("doc_id").alias("id_a"), F.col("shingles").alias("set_a"))
    second = sets.select(F.col("doc_id").alias("id_b"), F.col("shingles").alias("set_b"))
    both = pairs.join(first, "id_a").join(second, "id_b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    return both.where(common * 100 >= union * percent).select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()


def without_near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document per component, all its columns as they are (of rows alike in id, one)."""
    kept = near_duplicates(docs, doc=doc, text=text, **options).where("kept").select(F.col("doc_id").alias("_d")).distinct()
    some = docs.where(F.col(doc).isNull())
    rows = docs.join(kept, F.col(doc).cast("bigint") == F.col("_d"), "left_semi")
    return rows.dropDuplicates([doc]).unionAll(some)
