"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

Positions are S (smaller than the next suffix) or L (larger); an S after an L
starts a leftmost-smaller (LMS) substring.  LMS suffixes are sorted by inducing
their substrings' order, naming equal ones alike and sorting the names' string
recursively; from them one pass over the buckets from the left places all L
suffixes and one from the right all S suffixes.

A pass goes bucket by bucket (all suffixes with one first symbol).  Within a
bucket the suffixes already placed give their predecessors at once, in order; only
runs of one symbol feed their own bucket and go in waves.  A recursive string has
many small buckets, so there as many neighbouring buckets go together as do not
feed one another.
"""

from __future__ import annotations

import numpy as np


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Order of the suffixes of s, whose last symbol must be the only smallest one (0)."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int32)
    s = s.astype(np.int32)
    small = _types(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    sigma = int(s.max()) + 1
    ends = np.cumsum(np.bincount(s, minlength=sigma))
    order = _induce(s, small, lms[np.argsort(s[lms], kind="stable")], ends)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    ordered = order[is_lms[order]]
    names, distinct = _names(s, lms, ordered)
    if distinct == len(lms):
        return _induce(s, small, ordered, ends)
    return _induce(s, small, lms[suffix_array(names)], ends)


def _types(s: np.ndarray) -> np.ndarray:
    """True for S positions; the last position is S."""
    n = len(s)
    rises = np.empty(n, bool)
    rises[:-1] = s[:-1] < s[1:]
    rises[-1] = True
    # An equal neighbour has the type of the next position that differs from its neighbour.
    decides = np.flatnonzero(np.append(s[:-1] != s[1:], True))
    return rises[decides[np.searchsorted(decides, np.arange(n))]]


def _names(s: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, int]:
    """Rank of each LMS substring, in text order, and how many differ."""
    length = np.zeros(len(s), np.int32)
    length[lms[:-1]] = np.diff(lms) + 1
    length[lms[-1]] = 1
    a, b = ordered[:-1], ordered[1:]
    same = length[a] == length[b]
    active = np.flatnonzero(same)
    k = 0
    while len(active):
        differ = s[a[active] + k] != s[b[active] + k]
        same[active[differ]] = False
        k += 1
        active = active[~differ & (length[a[active]] > k)]
    rank = np.concatenate([[0], np.cumsum(~same)]).astype(np.int32)
    place = np.empty(len(s), np.int32)
    place[ordered] = rank
    return place[lms], int(rank[-1]) + 1


def _induce(s: np.ndarray, small: np.ndarray, seeds: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The order induced from LMS positions, given by first symbol and then in their order."""
    n, sigma = len(s), len(ends)
    begins = np.concatenate([[0], ends[:-1]])
    sa = np.full(n, -1, np.int32)
    symbols = s[seeds]
    first = np.searchsorted(symbols, symbols, "left")
    in_bucket = np.bincount(symbols, minlength=sigma)
    sa[ends[symbols] - in_bucket[symbols] + np.arange(len(seeds)) - first] = seeds
    large = ~small
    heads = begins.copy()
    _sweep(s, sa, large, begins, ends, heads, 1)
    l_ends = heads
    # The S suffixes are placed anew, from the ends of their buckets.
    stay = np.zeros(n + 1, np.int32)
    np.add.at(stay, begins, 1)
    np.add.at(stay, l_ends, -1)
    sa[np.cumsum(stay[:-1]) <= 0] = -1
    sa[0] = n - 1
    tails = ends.copy()
    tails[0] -= 1
    _sweep(s, sa, small, begins, ends, tails, -1)
    return sa


def _sweep(s, sa, wanted, begins, ends, edge, step) -> None:
    """Place all `wanted` suffixes: step 1 from the left, buckets filling from their begins (`edge`), -1 the mirror image."""
    sigma = len(begins)
    bucket = 0 if step == 1 else sigma - 1
    width = 1
    while 0 <= bucket < sigma:
        if width > 1:
            other = min(sigma - 1, bucket + width - 1) if step == 1 else max(0, bucket - width + 1)
            lo, hi = (bucket, other) if step == 1 else (other, bucket)
            found = sa[begins[lo] : ends[hi]][::step]
            found = found[found >= 0]
            previous = found[found > 0] - 1
            previous = previous[wanted[previous]]
            targets = s[previous]
            inside = targets[(targets >= lo) & (targets <= hi)]
            if len(inside):
                # Buckets up to the first one that is fed from among them can go together.
                stop = int(inside.min() if step == 1 else inside.max())
                if stop == bucket:
                    width = 1
                    continue
                fits = stop - 1 if step == 1 else stop + 1
                lo, hi = (lo, fits) if step == 1 else (fits, hi)
                found = sa[begins[lo] : ends[hi]][::step]
                found = found[found > 0]
                previous = found - 1
                previous = previous[wanted[previous]]
                targets = s[previous]
            _place(sa, previous, targets, edge, step)
            done = hi - lo + 1
            width = min(2 * done + 1, 1 << 16) if done >= width // 2 else max(2, done * 2)
            bucket += step * done
            continue
        _one(s, sa, wanted, begins, ends, edge, bucket, step)
        bucket += step
        width = 2 if sigma > 1024 else 1


def _one(s, sa, wanted, begins, ends, edge, bucket, step) -> None:
    """One bucket: first what is placed at its edge, in waves, as its own runs add to it; then the rest of it."""
    start = begins[bucket] if step == 1 else ends[bucket] - 1
    at = start
    while True:
        # edge is where the next suffix goes: for step 1 the first free place, for -1 one above it.
        stop = edge[bucket] if step == 1 else edge[bucket] - 1
        if at == stop:
            break
        wave = sa[at:stop] if step == 1 else sa[stop + 1 : at + 1][::-1]
        at = stop
        _feed(s, sa, wanted, wave, edge, step)
    rest = sa[edge[bucket] : ends[bucket]] if step == 1 else sa[begins[bucket] : edge[bucket]][::-1]
    rest = rest[rest >= 0]
    if len(rest):
        _feed(s, sa, wanted, rest, edge, step)


def _feed(s, sa, wanted, found, edge, step) -> None:
    previous = found[found > 0] - 1
    previous = previous[wanted[previous]]
    if len(previous):
        _place(sa, previous, s[previous], edge, step)


def _place(sa, previous, targets, edge, step) -> None:
    """Append positions to their buckets, keeping their order."""
    if not len(previous):
        return
    if len(previous) == 1:
        t = targets[0]
        sa[edge[t] if step == 1 else edge[t] - 1] = previous[0]
        edge[t] += step
        return
    if len(previous) < 48:
        # So few are placed faster one by one than by sorting them.
        if step == 1:
            for p, t in zip(previous.tolist(), targets.tolist()):
                at = edge[t]
                sa[at] = p
                edge[t] = at + 1
        else:
            for p, t in zip(previous.tolist(), targets.tolist()):
                at = edge[t] - 1
                sa[at] = p
                edge[t] = at
        return
    keys = targets.astype(np.uint16) if len(edge) <= 1 << 16 else targets
    order = keys.argsort(kind="stable")
    sorted_targets = targets[order]
    fresh = np.empty(len(order), bool)
    fresh[0] = True
    np.not_equal(sorted_targets[1:], sorted_targets[:-1], out=fresh[1:])
    begin = fresh.nonzero()[0]
    buckets = sorted_targets[begin]
    counts = np.empty(len(begin), np.int64)
    np.subtract(begin[1:], begin[:-1], out=counts[:-1])
    counts[-1] = len(order) - begin[-1]
    # Where each group goes, less where it begins in the sorted order.
    if step == 1:
        sa[np.arange(len(order)) + (edge[buckets] - begin).repeat(counts)] = previous[order]
    else:
        sa[(edge[buckets] - 1 + begin).repeat(counts) - np.arange(len(order))] = previous[order]
    edge[buckets] += step * counts


def permuted_common_prefixes(s: np.ndarray, sa: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position the length it shares with the suffix before it in order, and that suffix.

    Lengths end at limit[i], the symbols up to the position's own separator.  A
    position whose left neighbour equals that of its partner shares one symbol less
    than the position before it; only the others are compared, eight bytes a step.
    s: bytes.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    positions = np.arange(n)
    partner = before.copy()
    irreducible = np.ones(n, bool)
    inner = (positions > 0) & (partner > 0)
    i = positions[inner]
    irreducible[i] = (s[i - 1] != s[partner[i] - 1]) | (limit[i - 1] == 0)
    padded = np.concatenate([s, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)[: n + 1]
    eight = np.ascontiguousarray(eight).view(np.uint64).ravel()
    shared = np.zeros(n, np.int64)
    active = positions[irreducible & (partner >= 0) & (limit > 0)]
    k = 0
    while len(active):
        other = partner[active]
        inside = other + k <= n
        differ = eight[np.minimum(active + k, n)] ^ eight[np.minimum(other + k, n)]
        stops = (differ != 0) | ~inside
        ended = active[stops]
        if len(ended):
            low = differ[stops] & (~differ[stops] + np.uint64(1))
            shared[ended] = k + np.where(low > 0, np.log2(np.maximum(low, 1).astype(np.float64)) // 8, 0).astype(np.int64)
        k += 8
        goes_on = active[~stops]
        full = limit[goes_on] <= k
        shared[goes_on[full]] = k
        active = goes_on[~full]
    shared = np.minimum(shared, limit)
    last = np.maximum.accumulate(np.where(irreducible, positions, 0))
    out = np.maximum(shared[last] - (positions - last), 0)
    return np.minimum(out, limit), partner
