"""Periodic runs against a comparison at every distance."""

import hashlib
import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from starloom.llm import periodic_runs as runs_module
from starloom.llm import suite
from starloom.llm.periodic_runs import periodic_runs
from starloom.llm.tokens import slices
from tests.llm import corpus

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def smallest_period(words):
    border, k = [0] * len(words), 0
    for i in range(1, len(words)):
        while k and words[i] != words[k]:
            k = border[k - 1]
        k += words[i] == words[k]
        border[i] = k
    return len(words) - border[-1]


def every_run(words, least=12):
    """Start, length and period of all runs, each distance compared over the whole text."""
    number = {}
    a = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    out = []
    for p in range(1, len(a) // 2 + 1):
        same = np.r_[False, a[:-p] == a[p:], False]
        edges = np.flatnonzero(same[1:] != same[:-1])
        for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - begin + p >= max(least, 2 * p) and smallest_period(words[begin : end + p]) == p:
                out.append((begin, end - begin + p, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept(words, found):
    gone = {i for start, length, period in found for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def awkward(rng):
    """Texts of few letters: random, repeated, Fibonacci, stretches of many periods, periodic halves that meet out of phase."""
    n, kind = rng.randint(0, 400), rng.randint(0, 6)
    letters = lambda k, some="ab": [rng.choice(some) for _ in range(k)]
    if kind < 2:
        return letters(n, "ab" if kind else "abcde")
    if kind == 2:
        return letters(rng.randint(0, 20), "abc") + (letters(rng.randint(1, 60)) * 8)[:n] + letters(rng.randint(0, 20), "abc")
    if kind == 3:
        return fibonacci(n)
    if kind == 4:
        return sum((letters(rng.randint(1, 4)) * rng.randint(1, 25) for _ in range(6)), [])
    if kind == 5:
        half = list("ab") * rng.randint(3, 40) + ["a"] * rng.randint(0, 2)
        return list("ba") * rng.randint(0, 9) + half + half + list("ba") * rng.randint(0, 9)
    root = letters(rng.randint(1, 6))
    return letters(rng.randint(0, 2)) + (root * 60)[: rng.randint(1, 150)] * 2 + (root * 9)[: rng.randint(0, 40)]


def found_in(texts, least=12):
    got = []
    for part in slices(pa.array([" ".join(t) for t in texts]), 1 << 16):
        got += [[(int(a), int(b - a), int(p)) for a, b, p in zip(*r)] for r in runs_module._of_slice(part, least)]
    return got


@pytest.mark.parametrize("seed", range(6))
def test_all_runs(seed):
    rng = random.Random(seed)
    texts = [awkward(rng) for _ in range(120)]
    assert found_in(texts) == [every_run(t) for t in texts]


@pytest.mark.parametrize("least", [2, 5, 30])
def test_other_least_length(least):
    rng = random.Random(least)
    texts = [awkward(rng) for _ in range(40)]
    assert found_in(texts, least) == [every_run(t, least) for t in texts]


def test_meeting_runs_supply_periods(monkeypatch):
    text = list("ba" * 40 + "ab" * 33)
    assert found_in([text]) == [every_run(text)]
    monkeypatch.setattr(runs_module, "_meetings", lambda *_: (np.zeros(0, np.int64), np.zeros(0, np.int64)))
    assert found_in([text]) != [every_run(text)]


def test_hash_only_proposes(monkeypatch):
    """A comparison that always says yes proposes stretches that are too long; the words cut them."""
    monkeypatch.setattr(runs_module.Prefixes, "same", lambda self, i, j, n: np.ones(len(i), dtype=bool))
    rng = random.Random(1)
    text = ([rng.choice("abcdefgh") for _ in range(40)] * 3) + [rng.choice("abcdefgh") for _ in range(40)]
    assert found_in([text])[0] == every_run(text)


def test_awkward_rows(spark):
    rows = corpus.corpus()
    got = sorted(
        ((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(corpus.frame(spark, rows)).collect()), key=repr
    )
    want = []
    for d, t in rows:
        words = corpus.WORD.findall(t or "")
        found = every_run(words)
        want.append((d, len(words), found, kept(words, found)))
    assert got == sorted(want, key=repr)
    assert any(w[2] for w in want)
    assert periodic_runs(corpus.frame(spark, [])).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables absent")
def test_query(spark):
    want = {}
    for d, t in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect():
        words = corpus.WORD.findall(t or "")
        h, n = zlib.crc32(str(d).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        found = every_run(words)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        text = "".join(f"{s},{k},{p}\n" for s, k, p in found)
        want[d] = (
            len(found), *best, 1000 * best[1] // best[2] if found else None,
            hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(kept(words, found).encode()).hexdigest(),
        )
    out = suite.queries()["op11_periodic_runs"](spark, SF_DIR)
    got = {r[0]: tuple(r)[1:] for r in out.collect()}
    assert got == want
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_made_runs(spark):
    texts = [(i, " ".join(f"w{k}" for k in range(i % 37))) for i in range(400)] + [(None, "a b"), (5, None)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in suite.with_made_runs(frame).collect()), key=repr)
    want = []
    for d, t in texts:
        words = (t or "").split()
        h, n = zlib.crc32(str(d).encode()), len(words)
        if d is not None and h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            t = " ".join(w if i < a else words[a + (i - a) % p] for i, w in enumerate(words))
        want.append((d, t))
    assert got == sorted(want, key=repr)
