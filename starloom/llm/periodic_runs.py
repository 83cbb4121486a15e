"""Maximal periodic runs of words, and texts without the repeats.

A run is a stretch of consecutive words with smallest period ``q`` that holds at
least two periods and that no neighbouring word extends. A document has at most
as many runs as words, but trying every period costs its square. Here periods
are proposed by string synchronising sets: at each scale ``t`` (4, 8, 16, ...)
a sparse set of positions is selected by hash, such that membership depends on
the ``2t`` words that follow and every stretch without a short period holds a
member. Both copies of a period between ``3t`` and ``6t`` therefore hold a pair
of members with equal context at just that distance. Stretches with periods of
at most ``t / 3`` have no members; they are runs that earlier scales have
found, and where two of them meet in different phase, they propose the rest.

Hashes only propose: each run's borders are compared word by word before it is reported.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.tokens import NOT_WHITE, Slice, join_hash, mix, slices

BATCH_BYTES = 4 << 20
FIRST_SCALE = 4
_TOP = np.uint64(2**64 - 1)
# Two primes below 2**31: products of residues fit 64 bits, and so do sums of 2**32 of them.
_PRIMES = (2147483647, 2147483629)
_BASES = (1000003, 998244353)
RUN = "array<struct<start:long,length:long,period:long>>"

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]


class Prefixes:
    """Compares stretches of words of any length by prefix sums of a polynomial modulo two primes."""

    def __init__(self, h: np.ndarray):
        self.n = len(h)
        self.parts = []
        for prime, base in zip(_PRIMES, _BASES):
            power = np.ones(self.n + 1, dtype=np.int64)
            done = 1
            while done <= self.n:
                step = pow(base, done, prime)
                more = min(done, self.n + 1 - done)
                power[done : done + more] = power[:more] * step % prime
                done += more
            sums = np.zeros(self.n + 1, dtype=np.int64)
            np.cumsum((h % np.uint64(prime)).astype(np.int64) * power[:-1] % prime, out=sums[1:])
            self.parts.append((prime, power, sums % prime))

    def same(self, i: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the ``length`` words from ``i`` and from ``j >= i`` agree."""
        out = np.ones(len(i), dtype=bool)
        for prime, power, sums in self.parts:
            left = (sums[i + length] - sums[i]) % prime * power[j - i] % prime
            out &= left == (sums[j + length] - sums[j]) % prime
        return out

    def _longest(self, most: np.ndarray, agrees) -> np.ndarray:
        low, high = np.zeros_like(most), most.copy()
        while (open_ := low < high).any():
            mid = (low + high + 1) >> 1
            ok = agrees(mid)
            low = np.where(open_ & ok, mid, low)
            high = np.where(open_ & ~ok, mid - 1, high)
        return low

    def around(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of the longest stretch with period ``j - i`` around ``i`` and ``j``."""
        right = self._longest(self.n - j, lambda x: self.same(i, j, x))
        left = self._longest(i.copy(), lambda x: self.same(i - x, j - x, x))
        return i - left, j + right


def _stretches(same: np.ndarray, period: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the stretches with a period, from where words equal the one a period on."""
    at = np.flatnonzero(same)
    if not at.size:
        return at, at
    cut = np.flatnonzero(np.diff(at) > 1)
    return at[np.r_[0, cut + 1]], at[np.r_[cut, at.size - 1]] + 1 + period


def _small(h: np.ndarray, least: int) -> list[Runs]:
    """Runs whose periods lie below the first scale's, by comparing the words at each such distance."""
    out = []
    for p in range(1, min(3 * FIRST_SCALE, len(h))):
        begin, end = _stretches(h[:-p] == h[p:], p)
        size = end - begin
        use = (size >= max(4, 3 * p)) | (size >= max(least, 2 * p))
        out.append((begin[use], end[use], np.full(int(use.sum()), p)))
    return out


def _joined(found: list[Runs]) -> Runs:
    """Each stretch once, with its smallest period: a longer one of the same stretch is a multiple."""
    begin, end, period = (np.concatenate([f[k] for f in found]).astype(np.int64) for k in range(3))
    order = np.lexsort((period, end, begin))
    begin, end, period = begin[order], end[order], period[order]
    first = np.ones(len(begin), dtype=bool)
    first[1:] = (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])
    return begin[first], end[first], period[first]


def _synchronising(window: np.ndarray, t: int, runs: Runs) -> np.ndarray:
    """Members at scale ``t``: the smallest window hash among the ``t + 1`` from here is the first's or the last's.

    Windows inside a run with a period of at most ``t / 3`` take no part.
    """
    begin, end, period = runs
    ids = window.copy()
    inside = (3 * period <= t) & (end - begin >= t) & (begin < len(ids))
    if inside.any():
        edge = np.zeros(len(ids) + 1, dtype=np.int64)
        np.add.at(edge, begin[inside], 1)
        np.add.at(edge, np.minimum(end[inside] - t + 1, len(ids)), -1)
        ids[np.cumsum(edge[:-1]) > 0] = _TOP
    least, w = ids, 1
    while w < t:
        least = np.minimum(least[:-w], least[w:])
        w *= 2
    least = np.minimum(least[:-1], least[1:])
    n = len(least)
    return np.flatnonzero((least != _TOP) & ((least == ids[:n]) | (least == ids[t : t + n])))


def _pairs(members: np.ndarray, context: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of members with equal context, ``3t`` up to ``6t`` words apart.

    Equal contexts stand over ``t / 3`` words apart, else they would be
    periodic, so that a member has fewer than 18 partners.
    """
    order = np.argsort(context, kind="stable")
    at, context = members[order], context[order]
    left, right = [], []
    k = 1
    while k < len(at):
        gap = at[k:] - at[:-k]
        near = (context[k:] == context[:-k]) & (gap < 6 * t)
        if not near.any():
            break
        pick = np.flatnonzero(near & (gap >= 3 * t))
        left.append(at[pick])
        right.append(at[pick + k])
        k += 1
    none = np.zeros(0, dtype=np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _meetings(text: Prefixes, runs: Runs) -> tuple[np.ndarray, np.ndarray]:
    """Pairs proposed where two runs of one small period meet out of phase.

    A square whose half is inside one of them and whose other half is inside the
    next has a period fixed modulo the small one. Two runs of one period share fewer words than it,
    so that only neighbours can meet.
    """
    begin, end, period = runs
    long = end - begin >= 9 * period
    order = np.lexsort((begin[long], period[long]))
    begin, end, period = begin[long][order], end[long][order], period[long][order]
    left, right = [], []
    for k in np.flatnonzero((period[1:] == period[:-1]) & (begin[1:] <= end[:-1])):
        a, b, q = begin[k], begin[k + 1], int(period[k])
        most = min(end[k] - a, end[k + 1] - b)
        shift = np.arange(q)
        phase = np.flatnonzero(text.same(a + shift, np.full(q, b), np.full(q, q)))
        if not phase.size:
            continue
        lowest = 9 * q
        p = np.arange(lowest + (b - a - phase[0] - lowest) % q, most + 1, q)
        i = np.maximum(a, b - p)
        left.append(i)
        right.append(i + p)
    none = np.zeros(0, dtype=np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _proposed(text: Prefixes, i: np.ndarray, j: np.ndarray) -> Runs:
    begin, end = text.around(i, j)
    use = end - begin >= 2 * (j - i)
    return begin[use], end[use], (j - i)[use]


def _confirmed(h: np.ndarray, runs: Runs) -> Runs:
    """Borders word by word. Hashes can only make a stretch too long, so one that fails is cut at its differences."""
    out = [runs]
    good = np.ones(len(runs[0]), dtype=bool)
    for k, (a, b, p) in enumerate(zip(*(x.tolist() for x in runs))):
        same = h[a : b - p] == h[a + p : b]
        if not same.all():
            good[k] = False
            begin, end = _stretches(same, p)
            use = end - begin >= 2 * p
            out.append((begin[use] + a, end[use] + a, np.full(int(use.sum()), p)))
    out[0] = tuple(x[good] for x in runs)
    return _joined(out)


def find_runs(h: np.ndarray, reach, least: int) -> Runs:
    """``(begin, end, period)`` of all runs of at least ``least`` words in a sequence of word hashes.

    Texts are parted by values that occur nowhere else, the longest first;
    ``reach(words)`` is how much of the sequence holds the texts of that many words or more.
    """
    found = _small(h, least)
    runs = _joined(found)
    text, window, t = None, h, 1
    while True:
        n = reach(6 * t if t >= FIRST_SCALE else 6 * FIRST_SCALE)
        if n < 6 * FIRST_SCALE:
            break
        window = window[: n - t + 1]
        if t >= FIRST_SCALE:
            members = _synchronising(window, t, runs)
            members = members[members < len(window) - t]
            i, j = _pairs(members, join_hash(window[members], window[members + t], 2 * t), t)
            if i.size:
                text = text or Prefixes(h)
                runs = _joined([runs, _proposed(text, i, j)])
        window = join_hash(window[:-t], window[t:], 2 * t)
        t *= 2
    if ((runs[1] - runs[0]) >= 9 * runs[2]).sum() > 1:
        text = text or Prefixes(h)
        i, j = _meetings(text, runs)
        if i.size:
            runs = _joined([runs, _proposed(text, i, j)])
    begin, end, period = _confirmed(h, runs)
    use = end - begin >= np.maximum(least, 2 * period)
    return begin[use], end[use], period[use]


def _side_by_side(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of a slice's texts, longest first and each followed by a border; the order of the texts, their begins."""
    words = np.diff(part.word_off)
    order = np.argsort(-words, kind="stable")
    begins = np.r_[0, np.cumsum(words[order] + 1)]
    h = np.empty(int(begins[-1]), dtype=np.uint64)
    border = begins[1:] - 1
    inner = np.ones(len(h), dtype=bool)
    inner[border] = False
    source = np.repeat(part.word_off[:-1][order] - begins[:-1], words[order]) + np.flatnonzero(inner)
    h[inner] = part.word_hashes()[source]
    h[border] = mix(np.arange(1, len(border) + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return h, order, begins


def _of_slice(part: Slice, least: int) -> list[Runs]:
    """Runs of each text of a slice, in word numbers, by start and then period."""
    part.find_words(NOT_WHITE, lower=False)
    h, order, begins = _side_by_side(part)
    sizes = np.diff(begins) - 1
    begin, end, period = find_runs(h, lambda n: int(begins[np.searchsorted(-sizes, -n, side="right")]), least)
    text = np.searchsorted(begins, begin, side="right") - 1
    by = np.lexsort((period, begin, text))
    begin, end, period, text = begin[by] - begins[text[by]], end[by] - begins[text[by]], period[by], text[by]
    cut = np.searchsorted(text, np.arange(part.rows + 1))
    out: list[Runs] = [None] * part.rows
    for k, row in enumerate(order.tolist()):
        a, b = cut[k], cut[k + 1]
        out[row] = (begin[a:b], end[a:b], period[a:b])
    return out


def _collapsed(raw: bytes, runs: Runs) -> bytes:
    words = raw.split()  # bytes part at just the six white characters
    if not len(runs[0]):
        return b" ".join(words)
    keep = np.ones(len(words), dtype=bool)
    for a, b, p in zip(*(x.tolist() for x in runs)):
        keep[a + p : b] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def periodic_runs(docs: DataFrame, least: int = 12) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of whole texts.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. ``runs`` lists all
    maximal runs of at least ``least`` words and two periods by start, then
    period; ``collapsed`` joins by one space the words that no run holds after
    its first period.

    Null and empty texts have no words, no runs and an empty ``collapsed``. Rows
    are judged one by one: repeated rows and ids give equal rows, and null ids
    stay. Other columns are ignored, whatever their names; an empty table gives
    an empty table. A task holds a few MB of texts at a time, or one longer
    text, with about 100 bytes of arrays for each word.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()),
        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.string()),
    ])

    def judge(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for part in slices(batch.column("text"), BATCH_BYTES):
                found = _of_slice(part, least)
                off, raw = part.off.tolist(), part.buf.tobytes()
                texts = [_collapsed(raw[a:b], runs) for a, b, runs in zip(off, off[1:], found)]
                begin, end, period = (np.concatenate([r[k] for r in found]) for k in range(3))
                runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (begin, end - begin, period)], names=["start", "length", "period"])
                counts = np.r_[0, np.cumsum([len(r[0]) for r in found])]
                columns = [
                    ids.slice(part.first_row, part.rows),
                    pa.array(np.diff(part.word_off), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(counts, pa.int32()), runs),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return columns.mapInArrow(judge, f"doc_id long, n_words long, runs {RUN}, collapsed string")
