"""Hard negatives against all scores, on the given vectors, odd rows, ties, and one label that most rows hold."""

import math

import numpy as np
import pytest

from layerwright.llm import hard_negatives as module
from layerwright.llm.hard_negatives import Block, hard_negatives, scan
from tests.conftest import SMALL


def brute(rows, every=100, positives=5, negatives=10):
    """rows (id, label, vector) -> (anchor, positive, rank, negative, positive score, negative score)"""
    good = {(i, lb, tuple(v)) for i, lb, v in rows if i is not None and lb is not None and v is not None and all(x is not None and math.isfinite(x) and abs(256 * x) <= 1 << 26 for x in v)}
    width = max((len(v) for _, _, v in good), default=0)
    good = [(i, lb, [math.floor(256 * x) for x in v] + [0] * (width - len(v))) for i, lb, v in good]
    out = []
    for k, (a, label, v) in enumerate(good):
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, lb) for j, (i, lb, w) in enumerate(good) if j != k)
        for p, positive, _ in [s for s in scored if s[2] == label][:positives]:
            inside = [(i, -s) for s, i, lb in scored if lb != label and 30 * -p <= 100 * -s <= 90 * -p][:negatives]
            out += [(a, positive, n + 1, i, -p, s) for n, (i, s) in enumerate(inside)]
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(params=[1 << 19, 1 << 8])
def block_cells(request, monkeypatch):
    """Large blocks, and blocks and groups of a few rows with many shards."""
    monkeypatch.setattr(module, "BLOCK_CELLS", request.param)
    monkeypatch.setattr(module, "GROUP_CELLS", request.param)


SCHEMA = "vec_id long, label int, embedding array<float>, `group` int, shard string, cells int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)


def test_given_vectors(spark, block_cells):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet").limit(300)
    rows = [(r["vec_id"], r["label"], r["embedding"]) for r in df.collect()]
    assert rows_of(hard_negatives(frame(spark, rows), every=20)) == brute(rows, every=20)


def test_odd_rows(spark, block_cells):
    rng = np.random.default_rng(8)
    vector = lambda n=6: [float(np.float32(x)) for x in rng.normal(size=n) * 0.3]
    rows = [(i, int(rng.choice([0, 1, 1, 1, 2])), vector()) for i in range(60)]
    same = vector()
    rows += [(100 + i, 1 + i % 2, same) for i in range(20)]  # ties
    rows += [(0, 1, same), (0, 2, same), (0, 2, same), (20, 1, vector(4)), (40, 0, []), (-100, 1, vector())]
    rows += [(None, 1, same), (200, None, same), (300, 1, None), (400, 1, [None] * 6), (500, 1, [float("nan")] * 6), (600, 1, [float("inf")] * 6), (700, 1, [3e38] * 6), (800, 1, [0.0] * 6)]
    assert rows_of(hard_negatives(frame(spark, rows), every=20)) == brute(rows, every=20)


def test_no_rows_and_no_partners(spark):
    assert hard_negatives(frame(spark, [])).count() == 0
    assert hard_negatives(frame(spark, [(0, 1, [0.5]), (1, 2, [0.4])])).count() == 0  # no positive
    assert hard_negatives(frame(spark, [(0, 1, [0.5]), (1, 1, [0.4])])).count() == 0  # no negative


def test_scan_drops_candidates_before_the_last_dimension():
    """Vectors far from the anchor in its largest dimensions are out after the first step, and no row within the bar is lost."""
    rng = np.random.default_rng(4)
    cells = rng.integers(-40, 40, (16, 500))
    cells[:4, 50:] = -40
    cells[:4, :50] = 40
    anchor = np.array([90] * 4 + [3] * 12)
    row = {"n": 500, "cells": np.ascontiguousarray(cells.astype("<i4")).tobytes(), **{c: np.arange(500).astype("<i8").tobytes() for c in ("ids", "labels", "row_keys")}}
    block = Block(row, 16)
    seen = []

    def stays(least, most):
        seen.append(len(least))
        assert (least <= most).all()
        return most >= 5000

    found, sums = scan(block, anchor, np.arange(500), stays)
    want = anchor @ cells
    assert found.tolist() == np.flatnonzero(want >= 5000).tolist() and sums.tolist() == want[found].tolist()
    assert seen[0] == 500 and seen[1] <= 50
