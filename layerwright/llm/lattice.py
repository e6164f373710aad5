"""Embedding near-dedup by lattice hashing: projections decoded to E8 points, neighbouring cells probed, cosines verified.

Vectors are scaled to length 1.  Each of `tables` hash tables projects them with a
seeded Gaussian matrix to `parts` times eight numbers; each eight are decoded to
the nearest point of the E8 lattice, and the points together are the vector's
home cell.  For every part the vector also probes the cells it lies nearest to
across a boundary: the same decoding after small seeded steps.  Two vectors are
candidates where a home of one is a home or probe of the other, and their cosine is
verified in double precision.

Equal vectors are one class, numbered and hashed once, whatever vec_ids they stand on.  A cell is worked on in tiles of
two blocks of rows, so a cell that holds a third of all vectors is spread over
many tasks and no list of its pairs exists: a tile gives each vector's number of
partners, and links that join its connected vectors in a chain.  A pair that meets
in several tables or cells counts in the first only, which both vectors' cell
lists tell.

Defined cases: a NULL or empty vector, one with a NULL or non-finite component, and
a zero vector link with nothing; vectors of different length never link; rows with
one vec_id are one node, also where their vectors differ, and each row counts as a
vector; a NULL vec_id is linked
with nothing; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.llm.frames import components, prepare, stored
from layerwright.llm.text import mix

COSINE = 0.95
# Recall of pairs at a cosine of exactly 0.95 in 64 dimensions 0.995, of 0.96 0.999; 4 of 100,000 random pairs share a cell.
TABLES = 12
PARTS = 2
PROBES = 4
SCALE = 0.25  # lattice units per unit of a projected coordinate's spread
BLOCK_ROWS = 1024
BUNDLE_ROWS = 10_000  # rows of small cells that one group holds
_FEW = 24  # cells up to this size are paired by offsets, larger ones by a matrix product
_PAIRS = 20_000


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest point of E8 = D8 or D8 + 1/2 for each row of eight, doubled to whole numbers."""

    def nearest_d8(y):
        whole = np.rint(y)
        odd = np.flatnonzero(np.mod(whole.sum(1), 2) != 0)
        if len(odd):
            off = y[odd] - whole[odd]
            worst = np.abs(off).argmax(1)
            whole[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1, -1)
        return whole

    plain, half = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    closer = ((x - plain) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return (2 * np.where(closer[:, None], plain, half)).astype(np.int64)


class LatticeHash:
    """Home and probe cells of unit vectors in several tables."""

    def __init__(self, dim: int, tables: int = TABLES, parts: int = PARTS, probes: int = PROBES, scale: float = SCALE, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.tables, self.parts, self.probes = tables, parts, probes
        self.matrix = rng.standard_normal((tables * parts, dim, 8)) * scale * np.sqrt(8)
        self.shift = rng.uniform(0, 2, (tables * parts, 1, 8))

    @staticmethod
    def _fold(points: np.ndarray, seed: int) -> np.ndarray:
        h = np.full(len(points), seed + 1, np.uint64)
        for k in range(points.shape[1]):
            h = mix(h ^ points[:, k].view(np.uint64))
        return h

    def cells(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, tables) homes and (rows, tables, parts * probes) probes; a probe equal to the home repeats it."""
        n = len(unit)
        homes = np.empty((n, self.tables), np.uint64)
        probes = np.empty((n, self.tables, self.parts * self.probes), np.uint64)
        for t in range(self.tables):
            points, near = [], []
            for p in range(self.parts):
                k = t * self.parts + p
                x = unit @ self.matrix[k] + self.shift[k]
                home = nearest_e8(x)
                points.append(self._fold(home, k))
                near.append(self._neighbours(x, home, k))
            home = mix(points[0] ^ np.uint64(t))
            for extra in points[1:]:
                home = mix(home ^ extra)
            homes[:, t] = home
            for p in range(self.parts):
                for j in range(self.probes):
                    cell = mix((near[p][j] if p == 0 else points[0]) ^ np.uint64(t))
                    for q in range(1, self.parts):
                        cell = mix(cell ^ (near[q][j] if p == q else points[q]))
                    probes[:, t, p * self.probes + j] = cell
        return homes, probes

    def _neighbours(self, x: np.ndarray, home: np.ndarray, k: int) -> list[np.ndarray]:
        """Folded points of the neighbouring cells a vector lies nearest to: E8's 240 shortest vectors lead to them."""
        off = x - home / 2
        # Distance to the neighbour home + m shrinks with the product of off and m: take the largest products.
        order = np.argsort(-(off @ SHORTEST.T), axis=1)[:, : self.probes]
        return [self._fold(home + (2 * SHORTEST[order[:, j]]).astype(np.int64), k) for j in range(self.probes)]


def _shortest() -> np.ndarray:
    """The 240 shortest vectors of E8, by rule: two coordinates of +-1, or all of +-1/2 with an even number of minuses."""
    out = []
    for i in range(8):
        for j in range(i):
            for a in (1, -1):
                for b in (1, -1):
                    v = np.zeros(8)
                    v[i], v[j] = a, b
                    out.append(v)
    for bits in range(256):
        if bits.bit_count() % 2 == 0:
            out.append(np.array([-0.5 if bits >> i & 1 else 0.5 for i in range(8)]))
    return np.array(out)


SHORTEST = _shortest()


def _valid_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values and offsets of a list column as doubles, and which rows are vectors that can link."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.cast(pa.float64())
    flat = values.fill_null(float("nan")).to_numpy(zero_copy_only=False)
    ok = ~np.asarray(column.is_null()) & (np.diff(offsets) > 0)
    good = np.concatenate([[0], np.cumsum(np.isfinite(flat))])
    ok &= good[offsets[1:]] - good[offsets[:-1]] == np.diff(offsets)
    some = np.concatenate([[0], np.cumsum(flat != 0)])
    ok &= some[offsets[1:]] - some[offsets[:-1]] > 0
    return flat, offsets, ok


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _hashed(batches: Iterable[pa.RecordBatch], options: dict) -> Iterator[pa.RecordBatch]:
    """The other columns, vector (of length 1), homes and probes of valid vectors."""
    made: dict[int, LatticeHash] = {}
    for batch in batches:
        flat, offsets, ok = _valid_rows(batch.column("vector"))
        width = np.diff(offsets)
        for dim in np.unique(width[ok]):
            rows = np.flatnonzero(ok & (width == dim))
            dim = int(dim)
            hasher = made.setdefault(dim, LatticeHash(dim, **options))
            unit = _unit(flat[offsets[rows][:, None] + np.arange(dim)])
            homes, probes = hasher.cells(unit)
            salt = np.uint64(dim)
            homes, probes = mix(homes ^ salt), mix(probes ^ salt).reshape(len(rows), -1)
            others = [c for c in batch.schema.names if c != "vector"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(pa.array(rows)) for c in others), _lists(unit), _lists(homes.view(np.int64)), _lists(probes.view(np.int64))],
                names=[*others, "vector", "homes", "probes"])


def _lists(table: np.ndarray) -> pa.ListArray:
    n, k = table.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * k + 1, max(k, 1))[: n + 1], pa.int32()), pa.array(np.ascontiguousarray(table).ravel()))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


_TILE = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("class_id", pa.int64()), ("to", pa.int64())])


def _tile(table: pa.Table, cosine: float, tables: int) -> pa.Table:
    """Links found in one tile of a large cell or in a bundle of small ones.

    Gives each class's number of new partners, its class_id and the smallest class_id
    it is connected with here.
    """
    rows = {
        "id": table.column("id").to_numpy(), "weight": table.column("weight").to_numpy(), "cell": table.column("cell").to_numpy(),
        "table": table.column("table").to_numpy(), "side": table.column("side").to_numpy(),
        "homes": _matrix(table.column("homes")), "probes": _matrix(table.column("probes")),
    }
    vectors = table.column("vector").combine_chunks()
    offsets, flat = vectors.offsets.to_numpy(), vectors.values.to_numpy()
    order = np.lexsort((rows["id"], rows["side"], rows["cell"], rows["table"]))
    change = np.flatnonzero((np.diff(rows["table"][order]) != 0) | (np.diff(rows["cell"][order]) != 0)) + 1
    begins = np.concatenate([[0], change])
    sizes = np.diff(np.append(begins, len(order)))
    dim = int(offsets[1] - offsets[0])
    get = lambda which: flat[offsets[which][:, None] + np.arange(dim)]

    def candidates() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        in_small = np.repeat((sizes <= _FEW) & (rows["side"][order[begins]] == rows["side"][order[begins + sizes - 1]]), sizes)
        cell_of = np.repeat(np.arange(len(begins)), sizes)
        for step in range(1, min(_FEW, len(order))):
            at = np.flatnonzero(in_small[:-step] & (cell_of[:-step] == cell_of[step:]))
            if len(at):
                yield order[at], order[at + step]
        for begin, size in zip(begins, sizes):
            if in_small[begin]:
                continue
            mine = order[begin : begin + size]
            first, second = mine[rows["side"][mine] == 0], mine[rows["side"][mine] == 1]
            within = not len(second)
            second = first if within else second
            if not len(first):
                continue
            x, y = get(first), get(second)
            for lo in range(0, len(first), 256):
                i, j = np.nonzero(x[lo : lo + 256] @ y.T >= cosine - 1e-9)
                keep = j > i + lo if within else np.ones(len(i), bool)
                yield first[i[keep] + lo], second[j[keep]]

    found_a, found_b = [], []
    for a, b in candidates():
        for lo in range(0, len(a), _PAIRS):
            i, j = a[lo : lo + _PAIRS], b[lo : lo + _PAIRS]
            close = (rows["id"][i] != rows["id"][j]) & (np.einsum("ij,ij->i", get(i), get(j)) >= cosine)
            i, j = i[close], j[close]
            here = _first_meeting(rows, i, j, tables)
            found_a.append(i[here])
            found_b.append(j[here])
    if not found_a:
        return _TILE.empty_table()
    ids, one, place = np.unique(rows["id"], return_index=True, return_inverse=True)
    names = table.column("class_id").to_numpy()[one]
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    links = np.zeros(len(ids), np.int64)
    np.add.at(links, place[a], rows["weight"][b])
    np.add.at(links, place[b], rows["weight"][a])
    out = pa.table([pa.array(ids), pa.array(links), pa.array(names), pa.array(_least_connected(names, place[a], place[b]))], schema=_TILE)
    return out.filter(pa.array(links > 0))


def _first_meeting(rows: dict, i: np.ndarray, j: np.ndarray, tables: int) -> np.ndarray:
    """Whether a pair counts here: no earlier table has it, and of two cells of this table this is the smaller."""
    keep = np.ones(len(i), bool)
    homes, probes = rows["homes"], rows["probes"].reshape(len(rows["id"]), tables, -1)
    here, cell = rows["table"][i], rows["cell"][i]
    for t in range(tables):
        at = np.flatnonzero(keep & (here >= t))
        if not len(at):
            continue
        a, b = i[at], j[at]
        ha, hb = homes[a, t], homes[b, t]
        met = ha == hb
        at_a, at_b = met | (probes[b, t] == ha[:, None]).any(1), met | (probes[a, t] == hb[:, None]).any(1)
        place = np.where(at_a & at_b, np.minimum(ha, hb), np.where(at_a, ha, hb))
        keep[at] = np.where(here[at] == t, (at_a | at_b) & (place == cell[at]), ~(at_a | at_b))
    return keep


def _least_connected(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest id each one reaches over the tile's pairs."""
    low = ids.copy()
    while len(a):
        new = low.copy()
        m = np.minimum(low[a], low[b])
        np.minimum.at(new, a, m)
        np.minimum.at(new, b, m)
        if np.array_equal(new, low):
            break
        low = new
    return low


def embedding_links(
    vectors: DataFrame, cosine: float = COSINE, tables: int = TABLES, parts: int = PARTS, probes: int = PROBES, scale: float = SCALE,
    block_rows: int = BLOCK_ROWS, vec: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """Per row of vectors: vec_id, n_links, class_id (smallest vec_id with an equal vector), component_id, kept."""
    spark = vectors.sparkSession
    prepare(spark)
    source = vectors.select(F.col(vec).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    # Zero has two signs, which compare alike.
    source = source.select("id", F.transform("vector", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x)).alias("vector"))
    usable = F.col("id").isNotNull() & F.coalesce((F.size("vector") > 0) & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    usable &= F.coalesce(F.exists("vector", lambda x: x != 0), F.lit(False))
    key = F.when(usable, F.unhex(F.md5(F.array_join(F.transform("vector", lambda x: x.cast("string")), ",").cast("binary"))))
    keyed = source.select("id", "vector", key.alias("key"))
    classes = keyed.where("key is not null").groupBy("key").agg(F.min("id").alias("class_id"), F.count("*").alias("weight"), F.first("vector").alias("vector"))
    options = {"tables": tables, "parts": parts, "probes": probes, "scale": scale}
    numbered = classes.select(F.monotonically_increasing_id().alias("id"), "key", "class_id", "weight", "vector")
    hashed = stored(numbered.mapInArrow(
        lambda b: _hashed(b, options), "id bigint, key binary, class_id bigint, weight bigint, vector array<double>, homes array<bigint>, probes array<bigint>"), "hashed-vectors")
    numbers = hashed.select("key", "class_id", "weight", F.col("id").alias("class"))
    members = stored(keyed.select("id", "key").join(numbers, "key", "left").select("id", "class", "class_id", "weight"), "vector-classes")

    per_table = parts * probes
    cells = hashed.select("id", F.explode(F.array_distinct(F.concat(
        F.transform("homes", lambda h, t: F.struct(t.alias("table"), h.alias("cell"), F.lit(True).alias("is_home"))),
        F.transform("probes", lambda p, i: F.struct(F.floor(i / per_table).cast("int").alias("table"), p.alias("cell"), F.lit(False).alias("is_home"))),
    ))).alias("c")).select("id", "c.*")
    cells = cells.groupBy("id", "table", "cell").agg(F.max("is_home").alias("is_home"))
    # A cell matters if it is somebody's home and holds two.  Small ones are bundled, large ones cut into blocks.
    sizes = cells.groupBy("table", "cell").agg(F.count("*").alias("n"), F.max("is_home").alias("some_home")).where("n > 1 and some_home").select("table", "cell", "n")
    dealt = stored(cells.join(sizes, ["table", "cell"]).select("id", "table", "cell", "n"), "cells")
    bundles = max(1, dealt.count() // BUNDLE_ROWS)
    blocks = F.ceil(F.col("n") / block_rows).cast("int")
    block = F.pmod(F.xxhash64("id"), blocks).cast("int")
    # Block x meets every block y >= x: as the first side of tiles (x, y) and the second side of tiles (y, x).
    tiles = F.transform(F.sequence(F.lit(0), blocks - 1), lambda y: F.struct(
        F.least(block, y).alias("x"), F.greatest(block, y).alias("y"), F.when(block <= y, 0).otherwise(1).alias("side")))
    small = F.array(F.struct(F.lit(-1).alias("x"), F.lit(-1).alias("y"), F.lit(0).alias("side")))
    dealt = dealt.select("id", "table", "cell", F.explode(F.when(blocks == 1, small).otherwise(tiles)).alias("t")).select("id", "table", "cell", "t.*")
    group = F.when(F.col("x") < 0, F.pmod(F.xxhash64("table", "cell"), F.lit(bundles))).otherwise(F.col("cell"))
    dealt = dealt.withColumn("group", group).withColumn("part", F.when(F.col("x") < 0, -1).otherwise(F.col("table")))
    found = dealt.join(hashed.drop("key"), "id").withColumn("dim", F.size("vector")).groupBy("group", "part", "x", "y", "dim").applyInArrow(
        lambda t: _tile(t, cosine, tables), "id bigint, links bigint, class_id bigint, to bigint")
    found = stored(found, "vector-links")
    linked = found.groupBy("id").agg(F.sum("links").alias("links"))
    # A vec_id on rows of several classes makes them one node, and rows whose vector cannot link belong to it too.
    usual = members.where("class_id is not null")
    several = usual.groupBy("id").agg(F.min("class_id").alias("lo"), F.max("class_id").alias("hi"))
    twice = usual.join(several.where("lo < hi"), "id").select(F.col("class_id").alias("a"), F.col("lo").alias("b"))
    edges = found.where("class_id != to").select(F.col("class_id").alias("a"), F.col("to").alias("b")).unionAll(twice.distinct())
    joined = components(edges, "vector-components")
    unlinked = members.where("class_id is null").join(several.select("id", "lo"), "id", "left")
    rows = usual.withColumn("lo", F.col("class_id")).unionByName(unlinked)
    out = rows.join(linked.withColumnRenamed("id", "l"), F.col("class") == F.col("l"), "left").join(joined, F.col("lo") == F.col("node"), "left")
    n_links = F.when(F.col("class_id").isNotNull(), F.col("weight") - 1 + F.coalesce("links", F.lit(0))).otherwise(F.lit(0))
    component = F.coalesce("component", "lo", "id")
    return out.select(F.col("id").alias("vec_id"), n_links.cast("bigint").alias("n_links"), F.coalesce("class_id", "id").alias("class_id"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
