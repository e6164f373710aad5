"""Token alignment against plain encoding of whole texts, and its parts."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from layerwright.llm.queries import PIECES, QUERIES, TOKENIZER
from layerwright.llm.token_alignment import align_tokens, byte_level_bytes, coders, links, terminals, token_groups
from tests.conftest import SMALL

CHARACTERS = "ab cd  e\n\t.,'1 9é中ß😀▁<|endoftext|> <s> </s> ﬁ　 ​\x00\x1fİ\xa0"


def _spans(tokens):
    out, at = [], 0
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def brute(rows):
    """rows (doc_id, text) -> the contract's columns, by whole texts and nested loops."""
    plain = Tokenizer.from_file(TOKENIZER)
    plain.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counts, kept = Counter(), []
    for d, text in rows:
        groups, pairs, a, b = [], [], [], []
        if text:
            coded = plain.encode(" " + text, add_special_tokens=False)
            a = [(i, byte_level_bytes(t)) for i, t in zip(coded.ids, coded.tokens)]
            b = [(i, bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()) for i, p in ((i, pieces.id_to_piece(i)) for i in pieces.encode(text))]
            if any(b"".join(t for _, t in side) != (" " + text).encode() for side in (a, b)):
                a, b = [], []
            a, b = _spans(a), _spans(b)
            ia = ib = 0
            for end in sorted({e for _, _, e in a} & {e for _, _, e in b}):
                ja, jb = ia, ib
                while ja < len(a) and a[ja][2] <= end:
                    ja += 1
                while jb < len(b) and b[jb][2] <= end:
                    jb += 1
                groups.append((a[ia:ja], b[ib:jb]))
                ia, ib = ja, jb
            pairs = [(x[0], y[0]) for ga, gb in groups for x in ga for y in gb if x[1] < y[2] and y[1] < x[2]]
        counts.update(pairs)
        kept.append((d, len(a), len(b), groups, pairs))
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(n, most.get(y, 0))
    out = []
    for d, n_a, n_b, groups, pairs in kept:
        said = ";".join(",".join(str(x[0]) for x in ga) + "|" + ",".join(str(y[0]) for y in gb) for ga, gb in groups)
        out.append((d, n_a, n_b, len(groups), len(pairs), sum(counts[p] == most[p[1]] for p in pairs), sum(counts[p] for p in pairs),
                    hashlib.sha256(said.encode()).hexdigest() if groups else ""))
    return out


def odd_rows():
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice(CHARACTERS) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    return rows + [
        (None, None), (None, "no id"), (7, ""), (8, " "), (9, "   "), (10, "ends in a space "), (3, "x <|endoftext|> y"), (3, "<s> a </s> <unk> <0x41>"),
        (5, "word " * 80000 + "end"), (6, "ab▁c " + "word " * 80000), (6, "no_space" * 40000), (4, "twice"), (4, "twice"),
    ]


@pytest.mark.parametrize("max_pairs", [4_000_000, 3])
def test_odd_texts(spark, max_pairs):
    rows = odd_rows()
    got = align_tokens(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), TOKENIZER, PIECES, max_pairs=max_pairs)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(rows), key=repr)


def test_query_on_whole_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op12_token_alignment"](spark, SMALL)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(rows), key=repr)


def test_groups_spell_the_digest(spark):
    rows = [(1, "Token groups, aligned"), (2, ""), (3, "▁"), (4, "long words " * 40000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    digests = {r["doc_id"]: r for r in align_tokens(docs, TOKENIZER, PIECES).collect()}
    side = lambda c: F.array_join(F.col(c).cast("array<string>"), ",")
    said = token_groups(docs, TOKENIZER, PIECES).groupBy("doc_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("group", F.concat(side("a_ids"), F.lit("|"), side("b_ids")).alias("s")))), lambda x: x["s"]), ";").alias("s"))
    found = {r["doc_id"]: hashlib.sha256(r["s"].encode()).hexdigest() for r in said.collect()}
    assert found == {d: r["groups_sha256"] for d, r in digests.items() if r["n_groups"]} and set(found) == {1, 4}


def test_pieces_encode_like_whole_texts():
    a, b = coders(TOKENIZER, PIECES)
    plain = Tokenizer.from_file(TOKENIZER)
    plain.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for _, text in odd_rows():
        if text and "▁" not in text:
            data = np.frombuffer((" " + text).encode(), np.uint8)
            offsets = np.array([0, len(data)])
            assert a.encode(data, offsets)[0].tolist() == plain.encode(" " + text, add_special_tokens=False).ids
            assert b.encode(data, offsets)[0].tolist() == pieces.encode(text)


def test_pointers_end_at_the_last_token_of_a_group():
    rng = np.random.default_rng(5)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        ends = [np.unique(np.append(rng.integers(1, n + 1, int(rng.integers(0, n + 1))), n)) for _ in range(2)]
        common = np.intersect1d(*ends)
        to_a, to_b = terminals(*ends)
        for own, to in zip(ends, (to_a, to_b)):
            assert (ends[1][to] == common[np.searchsorted(common, own)]).all()
        want = {(i, j) for i in range(len(ends[0])) for j in range(len(ends[1]))
                if (ends[0][i - 1] if i else 0) < ends[1][j] and (ends[1][j - 1] if j else 0) < ends[0][i]}
        assert set(zip(*(x.tolist() for x in links(*ends)))) == want
