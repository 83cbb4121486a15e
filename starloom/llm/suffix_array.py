"""Suffix arrays of byte strings by induced sorting, and permuted common prefixes, in numpy.

Suffixes are classified into smaller (S) and larger (L) than their successor;
the leftmost S of each run, LMS, cut the string into substrings, which are
sorted and named; the string of names is sorted in turn by doubling; from the
sorted LMS suffixes all others are induced in two linear scans, bucket by bucket.
"""

from __future__ import annotations

import numpy as np

SYMBOLS = 257  # bytes moved up by one, and 0 as the end of each part
PACK, WIDTH = 6, 10


def _types(t: np.ndarray) -> np.ndarray:
    """True for S: smaller than the next suffix. Runs of one symbol take the type of what follows them."""
    n = len(t)
    differs = np.flatnonzero(t[1:] != t[:-1])
    s = np.ones(n, dtype=bool)
    if n > 1 and len(differs):
        nxt = np.searchsorted(differs, np.arange(n - 1))
        inside = nxt < len(differs)
        at = differs[np.minimum(nxt, len(differs) - 1)]
        s[:-1] = ~inside | (t[at] < t[at + 1])
    return s


def _refine(rank: np.ndarray, member: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Order ``member`` by ``(rank, key)`` and give each the rank of its first equal.

    Ranks are positions of a group's first member in the sorted order, so they
    stay in order when whole groups are refined. Returns members still tied.
    """
    order = np.lexsort((key, rank[member]))
    m, k, r = member[order], key[order], rank[member][order]
    new_group = np.r_[True, r[1:] != r[:-1]]
    new_key = new_group | np.r_[True, k[1:] != k[:-1]]
    at = np.arange(len(m))
    group_first = np.maximum.accumulate(np.where(new_group, at, 0))
    key_first = np.maximum.accumulate(np.where(new_key, at, 0))
    rank[m] = r + (key_first - group_first)
    size = np.diff(np.r_[np.flatnonzero(new_key), len(m)])
    return m[np.repeat(size > 1, size)]


def _names(t: np.ndarray, s: np.ndarray, lms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of the LMS substrings, ``PACK`` symbols with their types at a time, and those that tie."""
    m = len(lms)
    symbol = np.concatenate([t.astype(np.int64) * 2 + s + 1, np.zeros(PACK, np.int64)])
    length = np.r_[lms[1:] - lms[:-1] + 1, 1]
    rank, tied, done = np.zeros(m, np.int64), np.arange(m), 0
    while len(tied) and done < length[tied].max():
        key = np.zeros(len(tied), np.int64)
        left = length[tied] - done
        for k in range(PACK):
            at = np.minimum(lms[tied] + done + k, len(symbol) - 1)
            key = (key << WIDTH) | np.where(k < left, symbol[at], 0)
        tied = _refine(rank, tied, key)
        done += PACK
    return rank, tied


def _sorted_lms(t: np.ndarray, s: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """LMS suffixes in order: the string of their names, ranked by doubling where names tie."""
    rank, tied = _names(t, s, lms)
    step = 1
    while len(tied):
        follow = tied + step
        key = np.where(follow < len(lms), rank[np.minimum(follow, len(lms) - 1)], -1)
        tied = _refine(rank, tied, key)
        step *= 2
    order = np.empty(len(lms), np.int64)
    order[rank] = lms
    return order


def _deal(positions: np.ndarray, symbols: np.ndarray, to: list[list[np.ndarray]]) -> None:
    """Append positions to their symbols' buckets, keeping their order."""
    if not len(positions):
        return
    order = np.argsort(symbols, kind="stable")
    p, c = positions[order], symbols[order]
    first = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
    for a, b in zip(first.tolist(), np.r_[first[1:], len(c)].tolist()):
        to[c[a]].append(p[a:b])


def _scan(t: np.ndarray, wanted: np.ndarray, seeds: list[np.ndarray], ascending: bool) -> list[list[np.ndarray]]:
    """One inducing scan. ``wanted`` marks the type that is induced; ``seeds`` are the other type's suffixes per symbol, in scan order."""
    found: list[list[np.ndarray]] = [[] for _ in range(SYMBOLS)]
    out: list[list[np.ndarray]] = [[] for _ in range(SYMBOLS)]

    def before(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = p[p > 0] - 1
        p = p[wanted[p]]
        return p, t[p]

    for c in range(SYMBOLS) if ascending else range(SYMBOLS - 1, -1, -1):
        current = np.concatenate(found[c]) if found[c] else np.zeros(0, np.int64)
        while len(current):
            out[c].append(current)
            p, symbol = before(current)
            same = symbol == c
            _deal(p[~same], symbol[~same], found)
            current = p[same]
        if len(seeds[c]):
            _deal(*before(seeds[c]), found)
    return out


def _by_symbol(t: np.ndarray, positions: np.ndarray) -> list[np.ndarray]:
    """Positions in suffix order, split by their first symbols."""
    return np.split(positions, np.searchsorted(t[positions], np.arange(1, SYMBOLS)))


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Suffix array of symbols ``0 .. 256`` (int16) that end in a 0; 0 may stand inside too."""
    n = len(t)
    if n < 2:
        return np.arange(n)
    s = _types(t)
    lms = np.flatnonzero(s[1:] & ~s[:-1]) + 1
    order = _sorted_lms(t, s, lms) if len(lms) else np.zeros(0, np.int64)
    larger = _scan(t, ~s, _by_symbol(t, order), ascending=True)
    cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    larger_of = [cat(x) for x in larger]
    smaller = _scan(t, s, [x[::-1] for x in larger_of], ascending=False)
    parts = [np.array([n - 1])]  # the last end is the least suffix and precedes no other
    for c in range(SYMBOLS):
        parts += [larger_of[c], cat(smaller[c])[::-1]]
    return np.concatenate(parts)


def permuted_prefixes(t: np.ndarray, sa: np.ndarray, starts: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """``(before, plcp)``: per position the suffix before it in order, and the length of their common prefix.

    Values are exact up to ``cap``. Only irreducible positions are compared, eight
    symbols a step: after position ``i`` with the same symbol before both
    suffixes the common prefix is the last one's less one. ``starts`` are
    compared as well, so no value is carried from one part into the next.
    """
    n = len(t)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    padded = np.concatenate([t.astype(np.uint16), np.zeros(8, np.uint16)])
    previous = np.r_[np.uint16(0xFFFF), padded[: n - 1]]
    plain = (before > 0) & (np.arange(n) > 0)
    plain &= previous == previous[np.maximum(before, 0)]
    plain[starts] = False
    a = np.flatnonzero(~plain & (before >= 0))
    b = before[a]
    word = np.ndarray((n + 5,), dtype="<u8", buffer=padded.data, strides=(2,))  # four symbols a word
    length = np.zeros(len(a), np.int64)
    open_, done = np.arange(len(a)), 0
    while len(open_) and done < cap:
        x, y = a[open_] + done, b[open_] + done
        inside = (x < n) & (y < n)
        differ = word[np.minimum(x, n)] ^ word[np.minimum(y, n)]
        same = inside & (differ == 0)
        ended = ~same
        d = differ[ended]
        low = d & (~d + np.uint64(1))
        at = np.where(d == 0, 0, np.log2(np.maximum(low, 1).astype(np.float64)).astype(np.int64) >> 4)
        length[open_[ended]] = done + at
        length[open_[same]] = done + 4
        open_ = open_[same]
        done += 4
    value = np.full(n, -(1 << 40), np.int64)
    value[a] = length + a
    last = np.zeros(n, np.int64)
    last[a] = a
    last = np.maximum.accumulate(last)
    plcp = np.maximum(value[last] - np.arange(n), 0)
    plcp[before < 0] = 0
    return before, plcp
