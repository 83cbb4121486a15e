"""Dedup operators and decontamination against brute force, on a corpus with every awkward case."""

from collections import Counter

import numpy as np
import pytest

from starloom.llm import minhash_dedup as near_module
from starloom.llm.components import components
from starloom.llm.decontaminate import decontaminate
from starloom.llm.line_dedup import line_dedup
from starloom.llm.minhash_dedup import minhash_dedup
from starloom.llm.substring_dedup import substring_dedup
from starloom.llm.suffix_array import permuted_prefixes, suffix_array
from starloom.llm.suffix_dedup import suffix_dedup
from tests.llm import corpus

ROWS = corpus.corpus()


def collected(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def expected(result):
    """One entry per input row."""
    return Counter((d, *result[d, t]) for d, t in ROWS)


@pytest.mark.parametrize(("words", "base"), [(20, 10), (20, 5), (8, 8)])
def test_substring(spark, words, base):
    got = collected(substring_dedup(corpus.frame(spark, ROWS), words, base), "doc_id", "text", "n_words", "n_removed")
    assert got == expected(corpus.substring(ROWS, words))


@pytest.mark.parametrize(("length", "segments"), [(400, 2000), (60, 2000), (60, 1)])
def test_suffix(spark, length, segments):
    got = suffix_dedup(corpus.frame(spark, ROWS), length, segments).collect()
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got)
    assert got == expected(corpus.suffix(ROWS, length))


@pytest.mark.parametrize("chunk", [2048, 2])
def test_near(spark, monkeypatch, chunk):
    monkeypatch.setattr(near_module, "FAMILY_CHUNK", chunk)
    got = collected(minhash_dedup(corpus.frame(spark, ROWS)), "doc_id", "n_shingles", "component_id")
    assert got == expected(corpus.near(ROWS))


def test_near_family_beyond_its_centre(spark):
    """Copies that drift: each is near the next one, the ends are far apart, and all are one component."""
    rng = np.random.default_rng(3)
    words, rows = [f"w{x}" for x in rng.integers(0, 10**6, 200)], []
    for i in range(40):
        rows.append((i, " ".join(words)))
        words[5 * i % 200] = f"new{i}"
    rows += [(100 + i, " ".join(f"w{x}" for x in rng.integers(0, 10**6, 30))) for i in range(20)]
    got = {r.doc_id: r.component_id for r in minhash_dedup(corpus.frame(spark, rows)).collect()}
    assert got == {d: v[1] for (d, _), v in corpus.near(rows).items()}
    assert {got[i] for i in range(40)} == {0}


def test_texts_of_one_id_join_their_components(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(1, a), (2, a), (2, b), (3, b + " tail"), (4, "other words"), (None, a), (5, "")]
    got = {(r.doc_id, r.n_shingles): r.component_id for r in minhash_dedup(corpus.frame(spark, rows[:5] + rows[6:])).collect()}
    assert got == {(1, 56): 1, (2, 56): 1, (3, 57): 1, (4, 1): 4, (5, 0): 5}
    assert {r.component_id for r in minhash_dedup(corpus.frame(spark, rows)).where("n_shingles > 50").collect()} == {None}


def test_lines(spark):
    got = collected(line_dedup(corpus.frame(spark, ROWS)), "doc_id", "text", "n_lines", "n_dropped")
    assert got == expected(corpus.lines(ROWS))
    assert sum(n for (*_, dropped), n in got.items() if dropped) > 3


def test_lines_carry(spark):
    out = line_dedup(corpus.frame(spark, ROWS), carry=["source", "text", "doc_id"])
    assert {r.source for r in out.collect()} == {"s"}


@pytest.mark.parametrize("block_terms", [2_000_000, 40])
def test_decontaminate(spark, block_terms):
    texts = [t for _, t in ROWS if t]
    pick = [" ".join(t.split(" ")[3:20]) for t in texts if len(t.split(" ")) > 40][:6]
    items = [(1, pick[0]), (2, pick[1].upper()), (3, pick[2]), (11, pick[0]), (4, "one two"), (5, ""), (6, None), (None, pick[3]), (7, "zzz never"), (1, pick[0])]
    table = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, win string")
    got = decontaminate(corpus.frame(spark, ROWS), table, block_terms=block_terms).collect()
    got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got)
    want = corpus.contaminated(ROWS, items)
    assert got == Counter((d, want[d, t][0], want[d, t][1], tuple(want[d, t][2])) for d, t in ROWS)
    assert any(k[2] for k in got)


def test_proximity(spark):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = corpus.frame(spark, [(1, passage), (2, passage.replace("zeta", "zeta and")), (3, passage.replace("kappa", "other"))])
    items = spark.createDataFrame([(9, passage)], "item_id long, text string")
    got = {r.doc_id: (r["items"], r.near_items) for r in decontaminate(docs, items).collect()}
    assert got[1] == (["9"], [])
    assert got[2] == ([], ["9"])


def test_empty_tables(spark):
    empty = corpus.frame(spark, ROWS).limit(0)
    items = spark.createDataFrame([], "item_id long, text string")
    for out in (substring_dedup(empty), suffix_dedup(empty), minhash_dedup(empty), line_dedup(empty), decontaminate(empty, items)):
        assert out.count() == 0
    assert decontaminate(corpus.frame(spark, ROWS), items).where("n_hit > 0").count() == 0


def test_components(spark):
    rng = np.random.default_rng(5)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7), (None, 3)]
    parent = {}

    def top(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and a != b:
            p, q = sorted((top(a), top(b)))
            parent[q] = p
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: top(x) for x in list(parent)}


def test_suffix_array():
    rng = np.random.default_rng(1)
    for _ in range(120):
        parts = []
        for _ in range(rng.integers(1, 5)):
            parts += [*rng.integers(1, rng.choice([2, 3, 11]), rng.integers(1, 30)).tolist(), 0]
        t = np.array(parts * int(rng.integers(1, 3)), np.int16)
        sa = suffix_array(t)
        suffixes = [tuple(t[i:]) for i in range(len(t))]
        assert sa.tolist() == sorted(range(len(t)), key=suffixes.__getitem__)
        before, shared = permuted_prefixes(t, sa, np.flatnonzero(np.r_[True, t[:-1] == 0]), 1000)
        for i, j in zip(sa[1:].tolist(), sa[:-1].tolist()):
            same = next((k for k, (x, y) in enumerate(zip(suffixes[i], suffixes[j])) if x != y), min(len(t) - i, len(t) - j))
            assert (before[i], shared[i]) == (j, same)
