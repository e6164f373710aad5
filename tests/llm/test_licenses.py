"""Licence scan: planted notices, odd texts, and base phrases against a plain scan."""

import re

import pytest

from layerwright.llm.license_scan import PHRASES, TEMPLATES, notices, scan_licenses
from tests.llm.brute import BENCH, WORDS, _LOWER

TEXT = {t.label: t.text for t in TEMPLATES}


def base(text):
    w = BENCH.findall((text or "").translate(_LOWER))
    found = [(i, label) for phrase, label in PHRASES.items() for i in range(len(w)) if w[i : i + phrase.count(" ") + 1] == phrase.split(" ")]
    places = [i for i, _ in found]
    return len(w), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found}))


@pytest.fixture(scope="module")
def planted(spark):
    filler = [" ".join(WORDS(50, s)) for s in range(40)]
    rows = [(i, f) for i, f in enumerate(filler)]
    rows += [(100 + i, f"{filler[i]} {t.text.title()}. {filler[i + 1]}") for i, t in enumerate(TEMPLATES)]
    rows += [
        (200, "MIT License, Apache License; mit-license"), (201, "cc by cc by"), (202, "gnu general  public\nlicense"), (203, "Kbsd mit licensİ apache"),
        (204, None), (205, ""), (206, "  ..  "), (None, "Released under the MIT License"), (207, "é中 apache license é"), (208, "license apache mit cc"),
        (209, " ".join(WORDS(30000, 3)) + " Licensed under the Apache License, Version 2.0 " + " ".join(WORDS(30000, 4))),
        (210, "redistribution and use in forms source and binary"), (211, f"{TEXT['bsd']} {filler[3]} {TEXT['mpl-2.0']}"), (100, "another text of one id"), (212, "cc by"), (212, "cc by"),
    ]
    return rows, spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, words string, template int")


def test_base_columns_are_the_plain_scan(planted):
    rows, df = planted
    got = [(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in scan_licenses(df).collect()]
    assert sorted(got, key=repr) == sorted(((d, *base(t)) for d, t in rows), key=repr)


def test_every_planted_notice_is_found(planted):
    _, df = planted
    got = {(r["doc_id"], r["n_words"]): r for r in scan_licenses(df).collect()}
    by_id = {d: r for (d, _), r in got.items()}
    for i, t in enumerate(TEMPLATES):
        r = max((v for (d, _), v in got.items() if d == 100 + i), key=lambda x: x["n_words"])
        assert t.label in r["labels"].split(","), t.label
        assert r["score"] == pytest.approx(1.0)
    assert by_id[211]["labels"] == "bsd,mpl-2.0"
    assert "apache-2.0" in by_id[209]["labels"]
    assert by_id[None]["labels"] == "mit,mit-release"


def test_clean_texts_have_no_labels(planted):
    _, df = planted
    for r in scan_licenses(df).where("doc_id < 40 or doc_id in (204, 205, 206, 208, 210)").collect():
        assert (r["labels"], r["score"]) == ("", 0.0)
    assert set(re.split(",", next(r["labels"] for r in scan_licenses(df).where("doc_id = 200").collect()))) >= {"apache", "mit"}


def test_words_out_of_place_are_no_notice(spark):
    """The looked-up words agree on one start only if they stand at the template's distances."""
    shuffled = " filler ".join(reversed(TEXT["mpl-2.0"].split(" ")))
    moved = TEXT["mpl-2.0"].replace("source code form", "source code and form")
    df = spark.createDataFrame([(1, shuffled), (2, moved), (3, TEXT["mpl-2.0"])], "doc_id long, text string")
    weights = {w: 2 for w in TEXT["mpl-2.0"].split(" ")}
    template = [t for t in TEMPLATES if t.label == "mpl-2.0"]
    found = {r["doc_id"]: r["score"] for r in notices(df, weights, tuple(template)).collect()}
    assert set(found) == {2, 3} and found[2] < found[3]


def test_empty_table_and_no_python_on_the_way(spark, planted):
    _, df = planted
    assert scan_licenses(df.limit(0)).count() == 0
    plan = scan_licenses(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInArrow" not in plan
