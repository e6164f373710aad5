"""Each operator against its plain version, on odd rows and on a small table."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from layerwright.llm.decontamination import contamination, decontaminate
from layerwright.llm.frames import components
from layerwright.llm.lattice import embedding_links
from layerwright.llm.near_duplicates import near_duplicates, without_near_duplicates
from layerwright.llm.substrings import remove_repeats
from layerwright.llm.suffix_dedup import remove_repeated_strings
from tests.conftest import SMALL
from tests.llm import brute


def pairs(df, *columns):
    return [tuple(r) for r in df.select(*(columns or ("doc_id", "text"))).collect()]


def same(df, want):
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)


@pytest.fixture(params=["odd", "small", "none"])
def table(request, docs, odd_docs, no_docs):
    return {"odd": odd_docs, "small": docs, "none": no_docs}[request.param]


def test_components(spark):
    edges = [(5, 4), (4, 3), (3, 2), (2, 1), (9, 8), (7, 7), (20, 10), (10, 30), (30, 20)] + [(k, k + 1) for k in range(100, 140)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    nodes = {x for e in edges for x in e}
    want = brute.components(nodes, edges)
    assert got == {k: v for k, v in want.items() if k != 7}


def test_near_duplicates(table):
    same(near_duplicates(table).select("doc_id", "n_shingles", "component_id", "kept"), brute.near_duplicates(pairs(table)))


def test_near_duplicates_in_one_large_group(spark):
    """A chain of texts of which only neighbours are alike, and many variants of one text."""
    base = brute.WORDS(120, 5)
    rows = [(i, " ".join(brute.WORDS(400, 6)[i * 2 : i * 2 + 60])) for i in range(60)]
    for i in range(60):
        w = list(base)
        w[(i * 7) % 100], w[(i * 13) % 100] = f"v{i}", f"u{i}"
        rows.append((1000 + i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same(near_duplicates(df).select("doc_id", "n_shingles", "component_id", "kept"), brute.near_duplicates(rows))


def test_one_document_of_each_group_stays(docs, odd_docs):
    for table in (docs, odd_docs):
        out = without_near_duplicates(table)
        assert out.columns == table.columns
        kept = {d for d, _, c, k in brute.near_duplicates(pairs(table)) if k and d is not None}
        assert sorted(r[0] for r in out.where("doc_id is not null").select("doc_id").collect()) == sorted(kept)
        assert out.where("doc_id is null").count() == table.where("doc_id is null").count()


def test_substrings(table):
    same(remove_repeats(table).select("doc_id", "n_words", "n_removed", "kept_sha256"), brute.substrings(pairs(table)))


def test_short_windows(docs):
    got = remove_repeats(docs, size=3, gram=2).select("doc_id", "n_words", "n_removed", "kept_sha256")
    same(got, brute.substrings(pairs(docs), 3))


@pytest.mark.parametrize("hot_bytes", [4 << 20, 1500])
def test_repeated_strings(table, hot_bytes):
    """With a small limit every frequent anchor is split over shards and its windows are counted between them."""
    got = remove_repeated_strings(table, hot_bytes=hot_bytes, shard_bytes=20_000).drop("kept")
    same(got, brute.repeated_strings(pairs(table)))


def test_repeated_short_strings(docs):
    few = docs.where("doc_id < 60")
    same(remove_repeated_strings(few, size=30, gram=12, hot_bytes=3000).drop("kept"), brute.repeated_strings(pairs(few), 30))


@pytest.fixture(scope="module")
def items(spark):
    rows = pairs(spark.read.parquet(f"{SMALL}/benchmark.parquet"), "item_id", "text")
    rows += [(900, "One!"), (901, "two three"), (902, None), (903, " .. "), (900, "One!"), (None, "lead AND trail")]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("max_windows", [500_000, 400])
def test_contamination(table, items, max_windows):
    got = contamination(table, items, max_windows=max_windows).drop("items", "spans")
    rows = [(i, t) for i, t in pairs(items, "item_id", "text") if i is not None]
    want = brute.contamination(pairs(table), pairs(items, "item_id", "text"))
    ids = {d: (n, s) for d, _, _, n, s, _ in brute.contamination(pairs(table), rows)}
    # An item without an id hits, but has no id to report.
    same(got, [(d, w, h, *ids[d], c) if d in ids else (d, w, h, n, s, c) for d, w, h, n, s, c in want])


def test_decontaminated_documents_have_no_hits(table, items):
    for remove in ("documents", "spans"):
        out = decontaminate(table, items, remove=remove)
        assert out.columns == table.columns
        if remove == "documents":
            clean = [d for d, *_, c in brute.contamination(pairs(table), pairs(items, "item_id", "text")) if not c]
            assert sorted(map(repr, [r[0] for r in out.select("doc_id").collect()])) == sorted(map(repr, clean))
        else:
            assert out.count() == table.count()


def brute_cut(text, items, n=10):
    """The text without the bytes from the first to the last word of each run of hit words."""
    low = lambda t: (t or "").translate(brute._LOWER)
    cut = lambda t: brute.BENCH.findall(low(t))
    known = {tuple(w[i : i + min(n, len(w))]) for w in (cut(t) for t in items) if w for i in range(len(w) - min(n, len(w)) + 1)}
    spans = [m.span() for m in brute.BENCH.finditer(low(text))]
    w = cut(text)
    hit = {k for g in {len(g) for g in known} for i in range(len(w) - g + 1) if tuple(w[i : i + g]) in known for k in range(i, i + g)}
    for k in sorted(hit, reverse=True):
        text = text[: spans[k][0]] + text[spans[k + 1][0] if k + 1 in hit else spans[k][1] :]
    return text


def test_one_broadcast_set_at_a_time(spark, docs, monkeypatch):
    """A benchmark of many sets never has two of them broadcast, and none stays behind in a plan."""
    from pyspark.core.broadcast import Broadcast

    from layerwright.llm import decontamination

    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    alive, most = set(), []
    make, destroy = decontamination._set, Broadcast.destroy

    def made(*args):
        shared = make(*args)
        alive.add(id(shared))
        most.append(len(alive))
        return shared

    def destroyed(self, blocking=False):
        alive.discard(id(self))
        return destroy(self, blocking)

    monkeypatch.setattr(decontamination, "_set", made)
    monkeypatch.setattr(Broadcast, "destroy", destroyed)
    df = contamination(docs, items, max_windows=100)
    assert len(most) > 3 and max(most) == 1 and not alive
    assert "MapInArrow" not in df._jdf.queryExecution().executedPlan().toString()
    clean = decontaminate(docs, items, max_windows=100)
    assert max(most) == 1 and not alive
    assert sorted(r[0] for r in clean.select("doc_id").collect()) == sorted(r["doc_id"] for r in df.collect() if not r["contaminated"])


@pytest.mark.parametrize("max_windows", [500_000, 400, 7])
def test_spans_are_cut_alike_in_slices(spark, max_windows):
    """Overlapping windows of one passage lie in different slices."""
    few = {500_000: 3, 400: 40, 7: 2}[max_windows]
    passages = [" ".join(brute.WORDS(25, 70 + k)) for k in range(few)]
    items = spark.createDataFrame([*enumerate(passages), (900, "one")], "item_id long, text string")
    lead, tail = " ".join(brute.WORDS(20, 6)), " ".join(brute.WORDS(20, 7))
    rows = [(k, f"{lead}: {p.upper()}! {tail}") for k, p in enumerate(passages)]
    rows += [(100, " ".join(passages[0].split(" ")[3:15])), (101, passages[0] + ", " + passages[1]), (102, f"é One {lead}"), (103, None), (104, ""), (0, rows[0][1]), (None, lead)]
    table = spark.createDataFrame([(*r, "m") for r in rows], "doc_id long, text string, _hits string").coalesce(1)
    got = decontaminate(table, items, remove="spans", max_windows=max_windows)
    assert got.columns == table.columns
    same(got, [(d, brute_cut(t, [*passages, "one"]), "m") for d, t in rows])


def test_empty_benchmark(docs, items):
    assert contamination(docs, items.limit(0)).where("contaminated").count() == 0


def brute_links(rows, cosine=0.95):
    """rows (vec_id, vector) -> (vec_id, n_links, component_id, kept)"""
    unit = []
    for _, v in rows:
        x = None if not v or any(c is None for c in v) else np.array(v, float)
        unit.append(None if x is None or not np.isfinite(x).all() or not x.any() else x / np.linalg.norm(x / abs(x).max()) / abs(x).max())
    n, links = [0] * len(rows), []
    for i, a in enumerate(unit):
        for j in range(i):
            b = unit[j]
            if a is not None and b is not None and len(a) == len(b) and rows[i][0] is not None and rows[j][0] is not None and a @ b >= cosine:
                n[i], n[j] = n[i] + 1, n[j] + 1
                links.append((rows[i][0], rows[j][0]))
    found = brute.components({r[0] for r in rows if r[0] is not None}, links)
    return [(r[0], n[i], found.get(r[0]), r[0] is None or found[r[0]] == r[0]) for i, r in enumerate(rows)]


def vectors(n, seed, dim=64):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = rng.standard_normal(dim)
        rows.append((i, v.tolist()))
    for k in range(n):  # partners at cosines on both sides of the limit, and clusters
        v = np.array(rows[k % 20 if k % 3 == 0 else k][1])
        w = rng.standard_normal(dim)
        w -= (w @ v) / (v @ v) * v
        c = rng.choice([0.9, 0.94, 0.97, 0.99])
        rows.append((n + k, (3 * (c * v / np.linalg.norm(v) + np.sqrt(1 - c * c) * w / np.linalg.norm(w))).tolist()))
    return rows


def test_embedding_links(spark):
    rows = vectors(300, 3)
    rows += [(5000, None), (5001, []), (5002, [0.0] * 64), (5003, [float("nan")] + [1.0] * 63), (5004, [float("inf")] + [1.0] * 63), (5005, [None] + [1.0] * 63),
             (5006, rows[3][1]), (5007, rows[3][1]), (5008, [2 * x for x in rows[3][1]]), (5009, [1.0, 0.0]), (5010, [1.0, 0.01]), (5011, [-1.0, -0.0]), (5012, [-1.0, 0.0])]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], "vec_id long, embedding array<double>, cell string, id int")
    got = sorted(map(tuple, embedding_links(df).select("vec_id", "n_links", "component_id", "kept").collect()))
    want = sorted(brute_links(rows))
    assert sum(g[1] for g in got) >= 0.99 * sum(w[1] for w in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert [g for g in got if g[0] >= 5000] == [w for w in want if w[0] >= 5000]


def test_rows_of_one_vec_id_with_different_vectors(spark):
    rng = np.random.default_rng(12)
    a, b, c, d, e, f, g = (list(map(float, x)) for x in rng.standard_normal((7, 64)))
    near = lambda v: [x + 0.01 * y for x, y in zip(v, rng.standard_normal(64).tolist())]
    rows = [(7, a), (7, b), (3, a), (5, near(b)), (6, near(a)), (10, c), (10, d), (11, near(c)), (12, near(d)), (20, e), (20, None), (18, near(e)),
            (30, f), (30, f), (30, near(f)), (31, g), (31, None), (40, None), (40, [0.0] * 64), (None, a)]
    for k in range(50, 90):  # each has partners by both of its vectors
        v, w = rng.standard_normal((2, 64)).tolist()
        rows += [(k, v), (k, w), (k + 100, near(v)), (k + 200, near(w))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    same(embedding_links(df).select("vec_id", "n_links", "component_id", "kept"), brute_links(rows))


def test_recall_at_the_limit(spark):
    """Pairs at a cosine of 0.951, the hardest there are."""
    rng = np.random.default_rng(8)
    rows = []
    for k in range(1000):
        v, w = rng.standard_normal((2, 64))
        v /= np.linalg.norm(v)
        w -= (w @ v) * v
        rows += [(2 * k, v.tolist()), (2 * k + 1, (0.951 * v + np.sqrt(1 - 0.951**2) * w / np.linalg.norm(w)).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert embedding_links(df).agg(F.sum("n_links")).first()[0] >= 0.99 * 2000


def test_a_large_cell_is_cut_into_tiles(spark):
    rng = np.random.default_rng(9)
    v = rng.standard_normal(64)
    rows = [(k, (v + 0.1 * rng.standard_normal(64)).tolist()) for k in range(300)] + [(1000 + k, rng.standard_normal(64).tolist()) for k in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for block_rows in (40, 1024):
        same(embedding_links(df, block_rows=block_rows).select("vec_id", "n_links", "component_id", "kept"), brute_links(rows))


def test_no_embeddings(spark):
    assert embedding_links(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def _templated(n, seed=0):
    """Documents of one 150-word template and 100 words of their own: pairwise similarity 0.41, never linked."""
    template = brute.WORDS(150, 77)
    return [(i, " ".join(template + brute.WORDS(100, 1_000_000 * seed + 500 + i))) for i in range(n)]


def test_templated_texts_are_not_paired_with_all_others(spark, monkeypatch):
    """Parts that are paired hold few outsiders each, so pairs grow in proportion to the documents, not with their square."""
    from layerwright.llm import near_duplicates as module

    pairs = []
    real = module.open_parts

    def counted(*args, **options):
        parts = real(*args, part=32, **options)
        sizes = parts.groupBy("bucket").agg(F.count("*").alias("m"), F.count_if(F.expr("component != main")).alias("outside"))
        pairs.append(sizes.agg(F.sum(F.col("m") * F.col("outside"))).first()[0] or 0)
        return parts

    monkeypatch.setattr(module, "open_parts", counted)
    for n in (300, 1200):
        rows = _templated(n)
        got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
        assert got.where("kept").count() == n
    assert pairs[1] <= 6 * pairs[0]


def test_pairs_in_split_buckets_are_found(spark, monkeypatch):
    """Near copies among many documents of one template, all in buckets that are split."""
    from layerwright.llm import near_duplicates as module

    real = module.open_parts
    monkeypatch.setattr(module, "open_parts", lambda *args, **options: real(*args, part=8, **options))
    rows = _templated(600, seed=3)
    for i in range(0, 600, 6):
        w = rows[i][1].split(" ")
        w[200:215] = brute.WORDS(15, 9_000_000 + i)
        rows.append((10_000 + i, " ".join(w)))
    same(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_shingles", "component_id", "kept"), brute.near_duplicates(rows))
