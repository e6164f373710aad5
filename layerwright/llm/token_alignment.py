"""Alignment of two tokenizers' tokens by pointer jumping, and how often their ids meet in the corpus.

A text is cut by a byte-level BPE (A, over space + text) and by a piece model (B, which
adds that space itself).  Both cover the same bytes.  Every token points to its
farthest-right overlapping token: an A token to the B token over its last byte, a B
token to the A token over its last byte if that one ends later, else to itself.
Doubling all pointers at once (next = next[next]) until nothing moves leads each
token to the terminal token of its component; terminals label the groups.

Links are the overlapping pairs of an A and a B token.  Their id pairs are counted over
the whole corpus, in the tasks first; a document's `n_best` counts links whose pair is
the most frequent of its B id, `count_sum` sums the counts of its links.  Only pairs met
twice and more are sent to the tasks (any other pair's count is 1), and only while there
are at most `max_pairs` of them; beyond it links are joined to the counts by a shuffle.

A text longer than a block is worked off in slices that end where a token of either
kind surely begins, so memory follows the block, not the text (a text without a single
space between other characters is one slice).

Defined cases: a text that is NULL, empty, or not spelled by either tokenizer's tokens
byte for byte (U+2581 reads as a space) has no tokens: zeros and ''.  Rows alike in id
are rows of their own; each counts in the corpus.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.llm.frames import prepare, stored
from layerwright.llm.text import give_back, prefix_sums, text_blocks, text_buffers
from layerwright.llm.token_files import Encoder, piece_starts

BLOCK = 1 << 18
MAX_PAIRS = 4_000_000  # 48 MB in each worker
COUNTED_PAIRS = 400_000  # a task's own counts are given out beyond so many

_MARK = "▁".encode()


def byte_level_bytes(token: str) -> bytes:
    """A token of a byte-level vocabulary as bytes: printable bytes stand for themselves, the others for U+0100 and on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = {256 + i: b for i, b in enumerate(sorted(set(range(256)) - plain))}
    return bytes(others.get(ord(c), ord(c)) for c in token)


def piece_bytes(piece: str) -> bytes:
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.encode().replace(_MARK, b" ")


class Spelling:
    """The bytes of every id, as one array with offsets."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.first = prefix_sums(self.sizes)
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        digits = [str(i).encode() for i in range(len(tokens))]
        self.digits = np.fromiter(map(len, digits), np.int64, len(tokens))
        width = int(self.digits.max()) + 1
        self.decimal = np.frombuffer(b"".join(d.ljust(width, b"\0") for d in digits), np.uint8).reshape(len(tokens), width)

    def ends(self, ids: np.ndarray) -> np.ndarray:
        return np.cumsum(self.sizes[ids])

    def spells(self, ids: np.ndarray, data: np.ndarray) -> bool:
        sizes = self.sizes[ids]
        before = prefix_sums(sizes)
        if before[-1] != len(data):
            return False
        return bool((self.data[np.repeat(self.first[ids] - before[:-1], sizes) + np.arange(len(data))] == data).all())


class PlainEncoder(Encoder):
    """Byte-level ids, added tokens' strings being ordinary text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.library.encode_special_tokens = True
        self.added = []
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            tokens[i] = byte_level_bytes(token) if all(ord(c) < 0x180 for c in token) else token.encode()
        self.spelling = Spelling(tokens)


class PieceEncoder(Encoder):
    """Ids of a piece model, piece by piece.

    No piece of such a model holds its mark for a space after another character, so no
    merge crosses from one to the other, and a text falls apart before each space that
    follows another character.  That is looked up in the vocabulary; a model that has
    such a piece gets whole texts.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.vocab_size())]
        self.dtype = np.dtype("<u2" if len(pieces) <= 1 << 16 else "<u4")
        self.by_piece = not any("▁" in p.lstrip("▁") for p in pieces)
        self.added = []
        self.first = self.second = np.zeros(0, np.uint64)
        self.at, self.size = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.ids, self.used = np.zeros(1 << 16, self.dtype), 0
        self.space = self.library.piece_to_id("▁")
        self.spelling = Spelling([piece_bytes(p) for p in pieces])

    def _library(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        # The library puts the leading space back, but for a space alone, which a text may end with.
        ids = self.library.encode([t[1:].decode("utf-8", "replace") for t in texts], num_threads=1)
        ids = [[self.space] if t == b" " else one for t, one in zip(texts, ids)]
        sizes = np.fromiter(map(len, ids), np.int32, len(ids))
        flat = np.fromiter((i for one in ids for i in one), self.dtype, int(sizes.sum()))
        return flat, sizes

    def starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        cut = np.zeros(len(data), bool)
        cut[offsets[:-1][offsets[:-1] < len(data)]] = True
        cut[1:] |= (data[1:] == 0x20) & (data[:-1] != 0x20)
        return np.flatnonzero(cut)


@lru_cache(maxsize=2)
def coders(path_a: str, path_b: str) -> tuple[PlainEncoder, PieceEncoder]:
    return PlainEncoder(path_a), PieceEncoder(path_b)


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terminal token of each A and each B token (as a number of a B token), by pointer jumping.

    Both ends are ascending, from one common start to one common end.
    """
    n = len(ends_a)
    over_a = np.searchsorted(ends_b, ends_a)  # the B token over the last byte of each A token
    over_b = np.searchsorted(ends_a, ends_b)
    later = ends_a[over_b] > ends_b
    nodes = np.concatenate([over_a + n, np.where(later, over_b, np.arange(len(ends_b)) + n)])
    while True:
        further = nodes[nodes]
        if np.array_equal(further, nodes):
            return nodes[:n] - n, nodes[n:] - n
        nodes = further


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All overlapping pairs: between two neighbouring ends of either kind lies exactly one."""
    ends = np.union1d(ends_a, ends_b)
    return np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)


def group_strings(ids_a: np.ndarray, ids_b: np.ndarray, to_a: np.ndarray, to_b: np.ndarray, a: Spelling, b: Spelling) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """'a1,a2|b1;a3|b2;' of all groups as bytes, the length of each token's part, and the group of each, in order."""
    last = np.flatnonzero(to_b == np.arange(len(to_b)))  # the terminals are the last B tokens of their groups
    group_a, group_b = np.searchsorted(last, to_a), np.searchsorted(last, to_b)
    count_a, count_b = np.bincount(group_a, minlength=len(last)), np.bincount(group_b, minlength=len(last))
    at_a = np.arange(len(ids_a)) + (np.cumsum(count_b) - count_b)[group_a]
    at_b = np.arange(len(ids_b)) + np.cumsum(count_a)[group_b]
    width = max(a.decimal.shape[1], b.decimal.shape[1])
    cells = np.zeros((len(ids_a) + len(ids_b), width), np.uint8)
    for ids, at, spelling, counts, mark in ((ids_a, at_a, a, count_a, b"|"), (ids_b, at_b, b, count_b, b";")):
        cells[at, : spelling.decimal.shape[1]] = spelling.decimal[ids]
        ends = np.full(len(ids), ord(","), np.uint8)
        ends[np.cumsum(counts) - 1] = mark[0]
        cells[at, spelling.digits[ids]] = ends
    sizes, groups = np.empty(len(cells), np.int64), np.empty(len(cells), np.int64)
    sizes[at_a], sizes[at_b] = a.digits[ids_a] + 1, b.digits[ids_b] + 1
    groups[at_a], groups[at_b] = group_a, group_b
    flat = cells.ravel()
    return flat[flat != 0], sizes, groups


class _Slice:
    """One or more whole texts, or a part of one, aligned."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, a: PlainEncoder, b: PieceEncoder):
        """data: texts, each with its leading space (a later part of a text begins with one of its own)."""
        n = len(offsets) - 1
        self.ids_a, self.n_a = a.encode(data, offsets)
        self.ids_b, self.n_b = b.encode(data, offsets)
        good = self._spelled(data, offsets, a.spelling, b.spelling)
        self.good = good
        if not good.all():
            keep_a, keep_b = np.repeat(good, self.n_a), np.repeat(good, self.n_b)
            self.ids_a, self.ids_b = self.ids_a[keep_a], self.ids_b[keep_b]
            self.n_a, self.n_b = self.n_a * good, self.n_b * good
        ends_a, ends_b = a.spelling.ends(self.ids_a), b.spelling.ends(self.ids_b)
        # Texts begin and end together, so groups never cross from one to the next.
        to_a, to_b = terminals(ends_a, ends_b)
        self.text, sizes, groups = group_strings(self.ids_a, self.ids_b, to_a, to_b, a.spelling, b.spelling)
        one, other = links(ends_a, ends_b)
        self.pairs = self.ids_a[one].astype(np.int64) << 32 | self.ids_b[other]
        text_of = np.repeat(np.arange(n), self.n_b)
        self.n_links = np.bincount(text_of[other], minlength=n)
        self.n_groups = np.bincount(text_of[to_b == np.arange(len(to_b))], minlength=n)
        parts = prefix_sums(sizes)
        self.edges = parts[prefix_sums(self.n_a + self.n_b)]

    def _spelled(self, data, offsets, a: Spelling, b: Spelling) -> np.ndarray:
        n = len(offsets) - 1
        if a.spells(self.ids_a, data) and b.spells(self.ids_b, data):
            same = (prefix_sums(a.sizes[self.ids_a])[prefix_sums(self.n_a)] == offsets) & (prefix_sums(b.sizes[self.ids_b])[prefix_sums(self.n_b)] == offsets)
            if same.all():
                return np.diff(offsets) > 0
        at_a, at_b = prefix_sums(self.n_a), prefix_sums(self.n_b)
        good = np.zeros(n, bool)
        for i in range(n):
            own = data[offsets[i] : offsets[i + 1]]
            good[i] = len(own) and a.spells(self.ids_a[at_a[i] : at_a[i + 1]], own) and b.spells(self.ids_b[at_b[i] : at_b[i + 1]], own)
        return good


def _led(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a space before each that is not empty."""
    sizes = np.diff(offsets)
    if len(sizes) == 1:
        return (np.concatenate([np.full(1, 0x20, np.uint8), data]), np.array([0, len(data) + 1])) if len(data) else (data, offsets)
    full = sizes > 0
    led = prefix_sums(sizes + full)
    out = np.full(int(led[-1]), 0x20, np.uint8)
    out[np.arange(len(data)) + np.repeat(led[:-1] + full - offsets[:-1], sizes)] = data
    return out, led


def _cuts(data: np.ndarray, limit: int) -> Iterator[int]:
    """Ends of the slices of one long text: before a space at which tokens of both kinds begin."""
    margin, begin, at = 8, 0, limit // 2
    while len(data) - begin > limit and at < len(data):
        # Only places some bytes inside the part looked at, so that what stands before them is seen.
        part = data[max(at - margin, 0) : at + limit // 2]
        spaces = piece_starts(part, np.array([0, len(part)]))
        spaces = spaces[(spaces >= margin) & (spaces < len(part) - margin)]
        spaces = spaces[(part[spaces] == 0x20) & (part[spaces - 1] != 0x20)]
        if len(spaces):
            begin = max(at - margin, 0) + int(spaces[-1])
            yield begin
            at = begin
        at += limit // 2
    yield len(data)


def slices(batches: Iterable[pa.RecordBatch], coder_a: PlainEncoder, coder_b: PieceEncoder, limit: int = BLOCK) -> Iterator[tuple[pa.RecordBatch, Iterator[_Slice]]]:
    """Blocks of rows with their slices: one of all texts, or several of a single long one."""
    whole = coder_a.by_piece and coder_b.by_piece

    def parts(data: np.ndarray) -> Iterator[_Slice]:
        begin = 0
        for end in _cuts(data, limit):
            yield _Slice(data[begin:end], np.array([0, end - begin]), coder_a, coder_b)
            begin = end

    for batch, data, offsets in text_blocks(batches, "text", limit):
        led, edges = _led(data, offsets)
        yield batch, parts(led) if whole and batch.num_rows == 1 and len(led) > limit else iter([_Slice(led, edges, coder_a, coder_b)])


_ALIGNED = (
    "kind int, row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs binary, id_a int, id_b int, n bigint"
)


class _Counts:
    """Pairs counted by a task."""

    def __init__(self):
        self.keys, self.counts, self.waiting, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def add(self, pairs: np.ndarray) -> None:
        self.merge(*np.unique(pairs, return_counts=True))

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.size += len(keys)
        if self.size > max(COUNTED_PAIRS, len(self.keys)):
            self.fold()

    def fold(self) -> None:
        keys = np.concatenate([self.keys, *[k for k, _ in self.waiting]])
        counts = np.concatenate([self.counts, *[c for _, c in self.waiting]])
        order = np.argsort(keys, kind="stable")
        keys, sums = keys[order], prefix_sums(counts[order])
        ends = np.flatnonzero(np.append(keys[1:] != keys[:-1], True)) if len(keys) else np.zeros(0, np.int64)
        self.keys, self.counts = keys[ends], np.diff(sums[np.append(0, ends + 1)])
        self.waiting, self.size = [], 0

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        self.fold()
        out = self.keys, self.counts
        self.keys = self.counts = np.zeros(0, np.int64)
        return out


def _rows(**columns) -> pa.RecordBatch:
    """A batch of the schema _ALIGNED with NULLs in the columns left out."""
    n = len(columns["kind"])
    kinds = {"kind": pa.int32(), "groups_sha256": pa.string(), "pairs": pa.binary(), "id_a": pa.int32(), "id_b": pa.int32()}
    names = [c.split()[0] for c in _ALIGNED.split(", ")]
    arrays = [columns[c] if isinstance(columns.get(c), pa.Array) else pa.array(columns[c], kinds.get(c, pa.int64())) if c in columns else pa.nulls(n, kinds.get(c, pa.int64())) for c in names]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def aligned(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, doc: str, text: str) -> DataFrame:
    """Rows of kind 0: a document, its numbers and its distinct id pairs with how often it has each (packed); of kind 1: a task's count of a pair."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = coders(tokenizer_a, tokenizer_b)
        counts, row = _Counts(), TaskContext.get().partitionId() << 36

        def counted() -> Iterator[pa.RecordBatch]:
            keys, n = counts.take()
            for i in range(0, len(keys), 100_000):
                part = keys[i : i + 100_000]
                yield _rows(kind=np.ones(len(part), np.int32), id_a=(part >> 32).astype(np.int32), id_b=(part & 0xFFFFFFFF).astype(np.int32), n=n[i : i + 100_000])

        for batch, parts in slices(batches, a, b):
            yield _documents(batch, parts, counts, row, np.promote_types(a.dtype, b.dtype))
            row += batch.num_rows
            if len(counts.keys) > 4 * COUNTED_PAIRS:
                yield from counted()
        yield from counted()
        give_back()

    source = docs.select(F.col(doc).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, _ALIGNED)


def _documents(batch: pa.RecordBatch, parts: Iterable[_Slice], counts: _Counts, row: int, dtype: np.dtype) -> pa.RecordBatch:
    n = batch.num_rows
    totals = np.zeros((4, n), np.int64)
    sums = [hashlib.sha256() for _ in range(n)]
    packed: list[list[bytes]] = [[] for _ in range(n)]
    good, own, later = np.ones(n, bool), _Counts(), False
    for part in parts:
        good &= part.good
        totals += [part.n_a, part.n_b, part.n_groups, part.n_links]
        own.add(part.pairs)
        raw, ends = memoryview(part.text), prefix_sums(part.n_links).tolist()
        cells = np.stack([part.pairs >> 32, part.pairs & 0xFFFFFFFF], 1).astype(dtype)  # links stand in the order of their texts
        for i, (x, y) in enumerate(zip(part.edges[:-1].tolist(), part.edges[1:].tolist())):
            if y > x:
                if later:
                    sums[i].update(b";")
                sums[i].update(raw[x : y - 1])  # without the last separator
                packed[i].append(cells[ends[i] : ends[i + 1]].tobytes())
        later = True
    if not good.all():  # a part that isn't spelled takes the whole text with it
        totals[:, ~good] = 0
        packed = [p if g else [] for p, g in zip(packed, good)]
    if n > 1 or good[0]:  # several texts are one part, which leaves out texts that aren't spelled
        counts.merge(*own.take())
    shas = [s.hexdigest() if g else "" for s, g in zip(sums, totals[0] > 0)]
    return _rows(
        kind=np.zeros(n, np.int32), row=row + np.arange(n), doc_id=batch.column("doc_id"), n_a=totals[0], n_b=totals[1], n_groups=totals[2], n_links=totals[3],
        groups_sha256=shas, pairs=[b"".join(p) for p in packed])


def _links(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The links' ids (pairs) of the rows of a batch, and the first link of each row."""
    data, offsets = text_buffers(batch.column("pairs"))
    first = prefix_sums(batch.column("n_links").to_numpy())
    wide = np.dtype("<u4") if first[-1] and len(data) == 8 * first[-1] else np.dtype("<u2")
    return np.frombuffer(data.tobytes(), wide).reshape(-1, 2), first


def _looked_up(rows: DataFrame, counts: DataFrame, best: DataFrame) -> DataFrame:
    """row, n_best, count_sum, by pairs known to every task (bounded by the caller)."""
    spark = rows.sparkSession
    known = counts.where("n > 1").select(F.expr("(cast(id_a as bigint) << 32) | id_b").alias("key"), "n").orderBy("key").toArrow()
    most = best.toArrow()  # a row per id of the second vocabulary
    highest = np.ones(max([0, *most.column("b").to_pylist()]) + 1, np.int64)
    highest[most.column("b").to_numpy()] = most.column("most").to_numpy()
    tables = spark.sparkContext.broadcast((known.column("key").to_numpy(), known.column("n").to_numpy(), highest))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, numbers, high = tables.value
        for batch in batches:
            ids, first = _links(batch)
            n_best, sums = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for x in range(0, len(ids), 1 << 18):
                part = ids[x : x + (1 << 18)].astype(np.int64)
                distinct, which = np.unique(part[:, 0] << 32 | part[:, 1], return_inverse=True)
                n = np.ones(len(distinct), np.int64)
                at = np.searchsorted(keys, distinct)
                at[at == len(keys)] = 0
                met = keys[at] == distinct if len(keys) else np.zeros(len(distinct), bool)
                n[met] = numbers[at[met]]
                n = n[which]
                low, top = np.clip(first[:-1], x, x + len(part)) - x, np.clip(first[1:], x, x + len(part)) - x
                total, hits = prefix_sums(n), prefix_sums((n == high[part[:, 1]]).astype(np.int64))
                sums += total[top] - total[low]
                n_best += hits[top] - hits[low]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(n_best), pa.array(sums)], names=["row", "n_best", "count_sum"])
        give_back()

    return rows.select("row", "n_links", "pairs").mapInArrow(run, "row bigint, n_best bigint, count_sum bigint")


def _joined(rows: DataFrame, counts: DataFrame, best: DataFrame) -> DataFrame:
    """row, n_best, count_sum, by a join of each row's distinct pairs with the counts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, first = _links(batch)
            for i, row in enumerate(batch.column("row").to_pylist()):
                distinct, times = np.unique(ids[first[i] : first[i + 1]].astype(np.int64), axis=0, return_counts=True)
                if len(distinct):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(distinct), row)), pa.array(distinct[:, 0].astype(np.int32)), pa.array(distinct[:, 1].astype(np.int32)), pa.array(times)],
                        names=["row", "id_a", "id_b", "times"])

    pairs = rows.select("row", "n_links", "pairs").mapInArrow(run, "row bigint, id_a int, id_b int, times bigint")
    known = counts.join(best, F.col("id_b") == F.col("b")).select("id_a", "id_b", "n", (F.col("n") == F.col("most")).cast("bigint").alias("top"))
    return pairs.join(known, ["id_a", "id_b"]).groupBy("row").agg(F.sum(F.col("times") * F.col("top")).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))


def align_tokens(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, doc: str = "doc_id", text: str = "text", max_pairs: int = MAX_PAIRS) -> DataFrame:
    """Per row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    prepare(docs.sparkSession)
    both = stored(aligned(docs, tokenizer_a, tokenizer_b, doc, text), "aligned")
    rows = both.where("kind = 0")
    counts = stored(both.where("kind = 1").groupBy("id_a", "id_b").agg(F.sum("n").alias("n")), "pair-counts")
    best = counts.groupBy(F.col("id_b").alias("b")).agg(F.max("n").alias("most"))
    few = counts.where("n > 1").count() <= max_pairs
    scored = (_looked_up if few else _joined)(rows, counts, best)
    out = rows.join(scored.withColumnRenamed("row", "r"), F.col("row") == F.col("r"), "left")
    zero = F.lit(0).cast("bigint")
    return out.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")


def token_groups(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The groups themselves: doc_id, group (from 0), a_ids, b_ids."""
    prepare(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = coders(tokenizer_a, tokenizer_b)
        for batch, parts in slices(batches, a, b):
            ids = batch.column("doc_id").to_pylist()
            strings: list[list[bytes]] = [[] for _ in ids]
            good = np.ones(len(ids), bool)
            for part in parts:
                good &= part.good
                raw = part.text.tobytes()
                for i, (x, y) in enumerate(zip(part.edges[:-1].tolist(), part.edges[1:].tolist())):
                    strings[i].append(raw[x:y])
            for key, pieces, fine in zip(ids, strings, good):
                found = b"".join(pieces).decode().rstrip(";").split(";") if fine and any(pieces) else []
                for k in range(0, len(found), 10_000):
                    sides = [[[int(t) for t in side.split(",")] for side in g.split("|")] for g in found[k : k + 10_000]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key] * len(sides), pa.int64()), pa.array(range(k, k + len(sides)), pa.int64()),
                         pa.array([s[0] for s in sides], pa.list_(pa.int32())), pa.array([s[1] for s in sides], pa.list_(pa.int32()))],
                        names=["doc_id", "group", "a_ids", "b_ids"])

    source = docs.select(F.col(doc).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, "doc_id bigint, group bigint, a_ids array<int>, b_ids array<int>")
