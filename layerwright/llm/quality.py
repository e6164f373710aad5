"""Quality classifier: regularised quadratic discriminant over transformed statistics of whole documents.

Every document gives a vector of character and word statistics (no label,
language, source or id among them).  Each class gets its mean and covariance from
sums that Spark combines before the shuffle; the covariance is shrunk towards the
pooled one and a multiple of the identity, and its Cholesky factor is kept.  A
score is the logistic of the difference of log densities (Mahalanobis distance
and determinant from the factor) plus log priors.

Defined cases: NULL, empty and wordless texts have the statistics of an empty
text and a score; documents without a label, or with a label other than 0 and 1,
are scored but not learned from; a document with contrary labels counts for both;
with no labelled document of one class the score is 1.0 or 0.0 for the other,
with none at all 0.5; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.llm.frames import prepare, stored
from layerwright.llm.text import LOWER, SPACE, prefix_sums, text_blocks, words

# Byte classes whose shares are statistics.
_CLASSES = {
    "upper": [*range(65, 91)], "digit": [*range(48, 58)], "stop": [ord(c) for c in ".,;:?"], "shout": [ord("!")],
    "symbol": [ord(c) for c in "#$%&*@^~+=<>{}[]_\\/"], "bar": [ord("|")], "line": [10], "quote": [ord(c) for c in "\"'()-"],
}
FEATURES = (*_CLASSES, "words", "word_length", "long_words", "repeat", "repeat_near", "distinct", "bytes")
HELD_OUT_FOLDS = 5


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES per document of a block, transformed to be roughly symmetric."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    found = words(data, offsets, SPACE)
    count = found.counts.astype(float)
    lengths = (found.ends - found.starts).astype(float)
    out = np.zeros((n, len(FEATURES)))
    for k, members in enumerate(_CLASSES.values()):
        table = np.zeros(256, bool)
        table[members] = True
        sums = prefix_sums(table[data].astype(np.int64))
        out[:, k] = np.sqrt((sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(size, 1))
    hashes = words(LOWER[data], offsets, SPACE).hashes()
    per_doc = lambda x: np.bincount(found.doc, x, n) if len(x) else np.zeros(n)
    many = np.maximum(count, 1)
    out[:, -7] = np.log1p(count)
    out[:, -6] = np.log1p(per_doc(lengths) / many)
    out[:, -5] = np.sqrt(per_doc((lengths > 14).astype(float)) / many)
    for column, step in ((-4, 1), (-3, 5)):
        same = np.zeros(len(hashes))
        same[step:] = (hashes[step:] == hashes[:-step]) & (found.doc[step:] == found.doc[:-step])
        out[:, column] = np.sqrt(per_doc(same) / many)
    order = np.lexsort((hashes, found.doc))
    fresh = np.ones(len(hashes))
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (found.doc[order][1:] != found.doc[order][:-1])
    # Distinct words grow with length: the log ratio to the count's 0.9th power is close to flat.
    out[:, -2] = np.log1p(np.bincount(found.doc[order], fresh, n) if len(order) else np.zeros(n)) - 0.9 * np.log1p(count)
    out[:, -1] = np.log1p(size)
    return out


def document_statistics(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and features array<double> of every row."""
    prepare(docs.sparkSession)

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_blocks(batches, "text"):
            values = statistics(data, offsets)
            rows = pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, len(FEATURES)), pa.int32()), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), rows], names=["doc_id", "features"])

    source = docs.select(F.col(doc).alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(measure, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, features array<double>")


@dataclass
class Discriminant:
    """Class means, log priors, inverse Cholesky factors and log determinants."""

    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray
    constant: float | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row."""
        if self.constant is not None:
            return np.full(len(x), self.constant)
        log = []
        for mean, factor, constant in zip(self.means, self.factors, self.constants):
            z = (x - mean) @ factor.T
            log.append(constant - 0.5 * np.einsum("ij,ij->i", z, z))
        return 1.0 / (1.0 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def fit(labelled: DataFrame, shrink: float = 0.1, ridge: float = 0.02) -> Discriminant:
    """Discriminant from rows of (features, label); only two rows of sums reach the driver."""
    d = len(FEATURES)
    f = F.col("features")
    sums = [F.sum(f[i]).alias(f"s{i}") for i in range(d)]
    products = [F.sum(f[i] * f[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)]
    rows = {r["label"]: r for r in labelled.where("label in (0, 1)").groupBy("label").agg(F.count("*").alias("n"), *sums, *products).collect()}
    if len(rows) < 2:
        return Discriminant(np.zeros(0), np.zeros(0), np.zeros(0), float(next(iter(rows))) if rows else 0.5)
    counts = np.array([rows[c]["n"] for c in (0, 1)], float)
    means = np.array([[rows[c][f"s{i}"] / rows[c]["n"] for i in range(d)] for c in (0, 1)])
    spreads = np.zeros((2, d, d))
    for c in (0, 1):
        for i in range(d):
            for j in range(i, d):
                spreads[c, i, j] = spreads[c, j, i] = rows[c][f"p{i}_{j}"] / counts[c] - means[c, i] * means[c, j]
    pooled = np.tensordot(counts / counts.sum(), spreads, 1)
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-8))
    factors, constants = [], []
    for c in (0, 1):
        weight = min(1.0, shrink + d / counts[c])  # small classes lean on the pooled covariance more
        unit = ((1 - weight) * spreads[c] + weight * pooled) / np.outer(scale, scale)
        lower = np.linalg.cholesky(unit + ridge * np.eye(d))
        factors.append(np.linalg.inv(lower) / scale)
        constants.append(np.log(counts[c] / counts.sum()) - np.log(np.diag(lower)).sum())
    return Discriminant(means, np.array(factors), np.array(constants))


def in_held_out(doc: Column, folds: int = HELD_OUT_FOLDS) -> Column:
    """Whether crc32 of the id's text leaves remainder 0 (a NULL id is not held out)."""
    return F.coalesce(F.crc32(doc.cast("string").cast("binary")) % folds == 0, F.lit(False))


def train(features: DataFrame, labels: DataFrame, label: str = "quality", doc: str = "doc_id", **options) -> Discriminant:
    """Fit on all labelled documents outside the held-out fold."""
    known = labels.select(F.col(doc).alias("doc_id"), F.col(label).cast("int").alias("label")).where(~in_held_out(F.col("doc_id")))
    return fit(features.join(known, "doc_id"), **options)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, held_out, score (0 to 1), predicted (1 if score >= threshold)."""
    features = stored(document_statistics(docs, doc, text), "quality-features")
    model = train(features, labels, doc=doc)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("features").values.to_numpy(zero_copy_only=False)
            at = batch.column("features").offsets.to_numpy()
            values = model.scores(x[at[0] : at[-1]].reshape(-1, len(FEATURES))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values)], names=["doc_id", "score"])

    scored = features.mapInArrow(score, f"doc_id {features.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select("doc_id", in_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents whose score reaches the threshold, all their columns as they are, without moving a text."""
    features = stored(document_statistics(docs, doc, text), "quality-features")
    model = train(features, labels, doc=doc)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_blocks(batches, text):
            yield batch.filter(pa.array(model.scores(statistics(data, offsets)) >= threshold))

    return docs.mapInArrow(keep, docs.schema)
