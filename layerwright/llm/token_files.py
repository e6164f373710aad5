"""Token ids as Arrow IPC files of fixed-size lists: equal-length sequences and masks, read without copying.

A data set is a folder with one pair of files per range of documents:

* `*.tokens.arrow`: record batches of `batch_rows` rows; `tokens` is a
  fixed-size list of `length` ids (uint16 where the vocabulary allows, else
  uint32), `mask` a fixed-size list of as many booleans (a bit each), false for the padding
  at the end of the file.  Row i is in batch i // batch_rows, so a reader that
  maps the file reaches any sequence without touching the rest.
* `*.index.arrow`: doc_id, start (within the file) and n_tokens per document.

Documents are written in ascending doc_id order (NULL first, equal ids by a hash
of their text), each followed by the end id; sequences run across documents.  A
file is named by the task attempt that wrote it and counts only if that attempt
reported it, so a lost executor or a second attempt leaves no wrong data.

Defined cases: a NULL or empty text is the end id alone; repeated rows are
written as often as they occur; an empty table gives no files and no rows.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.llm.frames import prepare, stored
from layerwright.llm.stores import open_folder
from layerwright.llm.text import rolling, text_blocks

LENGTH = 1024
BATCH_ROWS = 128
MEMO_PIECES = 1_500_000
MEMO_IDS = 12_000_000

_LETTER, _DIGIT, _PUNCTUATION = 1, 2, 3
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = _PUNCTUATION
_KIND[ord("'")] = 0  # may begin a contraction
_KIND[0x30:0x3A] = _DIGIT
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_PRINTED = np.zeros(256, bool)
_PRINTED[0x21:0x7F] = True
# First bytes of characters of 2 bytes, and of 3 and 4, among which there is no white space (that is under C2, E1, E2 and E3).
_TWO = np.isin(np.arange(256), range(0xC3, 0xE0))
_THREE = np.isin(np.arange(256), range(0xE4, 0xF0))
_FOUR = np.isin(np.arange(256), range(0xF0, 0xF5))
_OPENS = _PRINTED | _TWO | _THREE | _FOUR


def piece_starts(data: np.ndarray, offsets: np.ndarray, added: list[tuple[int, int]] = ()) -> np.ndarray:
    """Places where byte-level BPE surely starts a new token, whatever stands around them.

    Its pre-tokens are an optional space with letters, digits or other signs, and
    runs of white space; a contraction begins with an apostrophe.  So one starts
    where an ASCII letter, digit or sign (no apostrophe) follows one of another
    kind, and at a single space between two characters that are no white space.
    The spans of added tokens are pieces of their own, and never cut inside.
    """
    n = len(data)
    cut = np.zeros(n, bool)
    cut[offsets[:-1][offsets[:-1] < n]] = True
    kind = _KIND[data]
    cut[1:] |= (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
    spaces = np.flatnonzero(data[1 : n - 1] == 0x20) + 1
    back = lambda k: data[np.maximum(spaces - k, 0)]
    later = back(1) >= 0x80
    closes = _PRINTED[back(1)] | later & (_TWO[back(2)] | (back(2) >= 0x80) & (_THREE[back(3)] | (back(3) >= 0x80) & _FOUR[back(4)]))
    cut[spaces[closes & _OPENS[data[spaces + 1]]]] = True
    for begin, end in added:
        cut[begin + 1 : end] = False
        cut[[begin, *([end] if end < n else [])]] = True
    return np.flatnonzero(cut)


class Encoder:
    """Whole texts to ids as the tokenizers library gives them by default, remembering the ids of pieces seen before.

    The string of an added token (`<|endoftext|>`) in a text is that token.

    Pieces are known by 128 bits of hash, kept sorted with the place of their ids in
    one array, so a million of them take some 40 MB and no Python object each.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.library = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        pre = self.library.pre_tokenizer
        self.by_piece = isinstance(pre, ByteLevel) and pre.use_regex and not pre.add_prefix_space and self.library.normalizer is None
        added = self.library.get_added_tokens_decoder().values()
        self.by_piece &= not any(t.lstrip or t.rstrip or t.single_word for t in added)
        self.added = sorted((t.content.encode() for t in added if t.content), key=len, reverse=True)  # of two at one place the longer counts
        self.first = self.second = np.zeros(0, np.uint64)
        self.at, self.size = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.ids, self.used = np.zeros(1 << 16, self.dtype), 0

    def _library(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        coded = self.library.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        ids = [e.ids for e in coded]
        return np.fromiter(chain.from_iterable(ids), self.dtype), np.fromiter(map(len, ids), np.int32, len(ids))

    def _added(self, raw: bytes, offsets: np.ndarray) -> list[tuple[int, int]]:
        """Spans of the added tokens' strings in the texts of a block."""
        if not any(t in raw for t in self.added):
            return []
        pattern = re.compile(b"|".join(map(re.escape, self.added)))
        edges = offsets.tolist()
        return [m.span() for a, b in zip(edges[:-1], edges[1:]) for m in pattern.finditer(raw, a, b)]

    def _look_up(self, first: np.ndarray, second: np.ndarray, piece) -> tuple[np.ndarray, np.ndarray]:
        """Places and numbers of ids of distinct pieces in order of `first`; piece(i) gives the bytes of one."""
        place = np.searchsorted(self.first, first)
        at, size = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
        known = np.flatnonzero(place < len(self.first))
        known = known[(self.first[place[known]] == first[known]) & (self.second[place[known]] == second[known])]
        at[known], size[known] = self.at[place[known]], self.size[place[known]]
        new = np.ones(len(first), bool)
        new[known] = False
        new = np.flatnonzero(new)
        if len(new):
            ids, sizes = self._library([piece(i) for i in new.tolist()])
            end = self.used + len(ids)
            if end > len(self.ids):
                self.ids = np.concatenate([self.ids[: self.used], np.zeros(end, self.dtype)])
            self.ids[self.used : end] = ids
            at[new], size[new] = self.used + np.cumsum(sizes) - sizes, sizes
            if len(self.first) + len(new) <= MEMO_PIECES and end <= MEMO_IDS:
                self.first, self.second = np.insert(self.first, place[new], first[new]), np.insert(self.second, place[new], second[new])
                self.at, self.size = np.insert(self.at, place[new], at[new]), np.insert(self.size, place[new], sizes)
                self.used = end
        return at, size

    def starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the pieces begin that are encoded each by itself."""
        return piece_starts(data, offsets, self._added(data.tobytes(), offsets) if self.added else ())

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a block of texts, one after another, and the number of ids of each text."""
        n = len(offsets) - 1
        raw = data.tobytes()
        if not self.by_piece:
            ids, counts = self._library([raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())])
            return ids, counts.astype(np.int64)
        starts = self.starts(data, offsets)
        if not len(starts):
            return np.zeros(0, self.dtype), np.zeros(n, np.int64)
        ends = np.append(starts[1:], len(data))
        second = rolling(data, _BASES[1], starts, ends, _VALUES)
        first, one, which = np.unique(rolling(data, _BASES[0], starts, ends, _VALUES), return_index=True, return_inverse=True)
        at, size = self._look_up(first, second[one], lambda i: raw[starts[one[i]] : ends[one[i]]])
        counts = size[which]
        before = np.cumsum(counts) - counts
        ids = self.ids[np.repeat(at[which] - before, counts) + np.arange(int(counts.sum()))]
        total = np.append(before, len(ids))
        edges = np.searchsorted(starts, offsets)
        return ids, total[edges[1:]] - total[edges[:-1]]


_VALUES = np.random.default_rng(50257).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _schema(dtype: np.dtype, length: int) -> pa.Schema:
    return pa.schema([("tokens", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length))])


_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
_MANIFEST = "part int, file string, docs bigint, tokens bigint"


class _Writer:
    """One token file: ids go in as they come, whole batches go out."""

    def __init__(self, stream, dtype: np.dtype, length: int, batch_rows: int):
        self.dtype, self.length, self.size = dtype, length, length * batch_rows
        self.schema = _schema(dtype, length)
        self.file = pa.ipc.new_file(stream, self.schema)
        self.rest = np.zeros(0, dtype)

    def add(self, ids: np.ndarray) -> None:
        values = np.concatenate([self.rest, ids])
        whole = len(values) // self.size * self.size
        for i in range(0, whole, self.size):
            self._batch(values[i : i + self.size], self.size)
        self.rest = values[whole:].copy()

    def _batch(self, values: np.ndarray, real: int) -> None:
        tokens = pa.FixedSizeListArray.from_arrays(pa.array(values), self.length)
        mask = pa.FixedSizeListArray.from_arrays(pa.array(np.arange(len(values)) < real), self.length)
        self.file.write_batch(pa.RecordBatch.from_arrays([tokens, mask], schema=self.schema))

    def close(self) -> None:
        if len(self.rest):
            padded = np.zeros(-(-len(self.rest) // self.length) * self.length, self.dtype)
            padded[: len(self.rest)] = self.rest
            self._batch(padded, len(self.rest))
        self.file.close()


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, doc: str = "doc_id", text: str = "text",
    length: int = LENGTH, batch_rows: int = BATCH_ROWS,
) -> DataFrame:
    """Encode all documents into `folder`; one manifest row per file: part (in order), file, docs, tokens."""
    prepare(docs.sparkSession)
    source = docs.select(F.col(doc).cast("bigint").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("tie"))
    ordered = source.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex[:12]}"
        fs, root = open_folder(folder)
        out, keys, sizes = None, [], []
        for batch, data, offsets in text_blocks(batches, "text"):
            if out is None:
                fs.create_dir(root, recursive=True)
                stream = fs.open_output_stream(f"{root}/{name}.tokens.arrow")
                out = _Writer(stream, coder.dtype, length, batch_rows)
            ids, counts = coder.encode(data, offsets)
            ended = np.full(len(ids) + len(counts), end_id, coder.dtype)
            ended[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
            out.add(ended)
            keys.append(batch.column("doc_id"))
            sizes.append(counts + 1)
        if out is None:
            return
        out.close()
        stream.close()
        sizes = np.concatenate(sizes)
        table = pa.RecordBatch.from_arrays([pa.concat_arrays(keys), pa.array(np.cumsum(sizes) - sizes), pa.array(sizes)], schema=_INDEX)
        with fs.open_output_stream(f"{root}/{name}.index.arrow") as sink, pa.ipc.new_file(sink, _INDEX) as index:
            index.write_batch(table)
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "file": [name], "docs": [len(sizes)], "tokens": [int(sizes.sum())]})

    return stored(ordered.mapInArrow(write, _MANIFEST), "token-manifest")


class TokenFile:
    """Random access to one file: `sequence(i)` and `mask(i)` are views of the mapped file where the store allows it."""

    def __init__(self, folder: str, name: str):
        fs, root = open_folder(folder)
        path = f"{root}/{name}.tokens.arrow"
        source = pa.memory_map(path) if isinstance(fs, pa.fs.LocalFileSystem) else fs.open_input_file(path)
        self.reader = pa.ipc.open_file(source)
        with fs.open_input_file(f"{root}/{name}.index.arrow") as f:
            self.index = pa.ipc.open_file(f).read_all()
        self.length = self.reader.schema.field("tokens").type.list_size
        self.batch_rows = self.reader.get_batch(0).num_rows

    def sequence(self, i: int) -> np.ndarray:
        batch = self.reader.get_batch(i // self.batch_rows)
        at = (i % self.batch_rows) * self.length
        return batch.column("tokens").values.to_numpy()[at : at + self.length]

    def mask(self, i: int) -> pa.BooleanArray:
        """A view of the mapped bits; `to_numpy(zero_copy_only=False)` expands them to a byte each."""
        return self.reader.get_batch(i // self.batch_rows).column("mask")[i % self.batch_rows].values

    def runs(self) -> Iterator[np.ndarray]:
        """All real ids, batch by batch."""
        for i in range(self.reader.num_record_batches):
            batch = self.reader.get_batch(i)
            values = batch.column("tokens").values.to_numpy()
            yield values[: batch.column("mask").values.true_count]


def read_tokens(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    prepare(spark)
    files = manifest.orderBy("part").collect()  # one row per file
    rows, before = [], 0
    for f in files:
        rows.append((f["file"], before))
        before += f["tokens"]
    listed = spark.createDataFrame(rows, "file string, before bigint").repartition(max(1, len(rows)), "file")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _digest(TokenFile(folder, row["file"]), row["before"])

    return listed.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _digest(file: TokenFile, before: int) -> pa.RecordBatch:
    starts = file.index.column("start").to_numpy()
    sizes = file.index.column("n_tokens").to_numpy()
    ends = starts + sizes
    sums = np.zeros(len(starts), np.int64)
    at, doc, crc = 0, 0, 0
    for values in file.runs():
        raw = memoryview(values.astype("<u4").tobytes())
        stop = at + len(values)
        while doc < len(ends) and at < stop:
            upto = min(int(ends[doc]), stop)
            crc = zlib.crc32(raw[4 * (at - stop + len(values)) : 4 * (upto - stop + len(values))], crc)
            at = upto
            if at == ends[doc]:
                sums[doc], crc, doc = crc, 0, doc + 1
    if doc != len(ends):
        raise ValueError("a token file is shorter than its index")
    return pa.RecordBatch.from_arrays(
        [file.index.column("doc_id").combine_chunks(), pa.array(starts + before), pa.array(sizes), pa.array(sums)],
        names=["doc_id", "start", "n_tokens", "ids_crc32"],
    )
