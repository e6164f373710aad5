import numpy as np
import pyarrow as pa
import pytest

from layerwright.llm.induced_sort import permuted_common_prefixes, suffix_array
from layerwright.llm.text import NON_ALNUM, SPACE, sliding, text_blocks, words
from tests.llm.brute import BENCH, SPACED

TEXTS = ["", "a", " a  bb\tccc\n", "Été 中文 x9", "\x00a\x1fb c", "A-B c_d", "   ", "end", None, "\x0b\x0cq"]


@pytest.mark.parametrize("limit", [1, 7, 1000])
def test_words_are_those_of_the_patterns(limit):
    batch = pa.RecordBatch.from_pydict({"text": TEXTS, "i": range(len(TEXTS))})
    for separators, pattern, lower in ((SPACE, SPACED, False), (NON_ALNUM, BENCH, True)):
        got = []
        for rows, data, offsets in text_blocks([batch.slice(1), batch.slice(0, 0)], "text", limit):
            found = words(data, offsets, separators, lower)
            for d in range(rows.num_rows):
                got.append([found.joined(k, 1).decode() for k in range(found.first[d], found.first[d + 1])])
        fold = (lambda t: "".join(c.lower() if c.isascii() else c for c in t)) if lower else (lambda t: t)
        assert got == [pattern.findall(fold(t or "")) for t in TEXTS[1:]]


def test_equal_windows_hash_alike_wherever_they_stand():
    batch = pa.RecordBatch.from_pydict({"text": ["a b c d", "x a b  c", "b c d", "ab c d"]})
    (_, data, offsets), = text_blocks([batch], "text")
    found = words(data, offsets, SPACE)
    at, h = found.windows(found.hashes(), 3)
    grams = [found.joined(k, 3) for k in at]
    assert len(grams) == 6
    for a, x in zip(grams, h):
        for b, y in zip(grams, h):
            assert (a == b) == (x == y)


def test_sliding():
    x = np.random.default_rng(1).integers(0, 50, 200)
    for width in (1, 2, 5, 13, 64):
        assert np.array_equal(sliding(np.minimum, x, width), [x[i : i + width].min() for i in range(len(x) - width + 1)])


@pytest.mark.parametrize("sigma", [1, 2, 4, 300, 5000])
def test_suffix_array_is_the_sorted_order(sigma):
    rng = np.random.default_rng(sigma)
    for n in (0, 1, 2, 5, 40, 400):
        for s in (rng.integers(1, sigma + 1, n), np.tile(rng.integers(1, sigma + 1, 3), n)):
            s = np.append(s, 0)
            t = s.tolist()
            assert suffix_array(s).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


def test_common_prefixes_end_at_the_separator():
    pieces = [b"abcabcabc" * 5, b"xabcabcy", b"", b"abcabcabc" * 5, b"q"]
    raw = np.frombuffer(b"\xff".join(pieces) + b"\xff\xff", np.uint8)
    ends = np.concatenate([np.arange(len(p), -1, -1) for p in pieces] + [[0]])
    order = suffix_array(np.append(raw[:-1].astype(int) + 1, 0))
    shared, partner = permuted_common_prefixes(raw, order, ends)
    text = raw.tobytes()
    for i in range(len(raw)):
        if partner[i] >= 0:
            n = 0
            while n < ends[i] and text[i + n] == text[partner[i] + n : partner[i] + n + 1][0]:
                n += 1
            assert shared[i] == n, i
