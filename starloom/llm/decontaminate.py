"""Benchmark decontamination with a distributed positional inverted index.

Windows of the test items are looked up in postings ``(term, document,
positions)`` of the training documents. The corpus is counted first, so each
window knows its rarest terms; postings are stored for those alone. A window's
lists are intersected from the rarest term on, positions shifted by the term's
offset in the window; starts that survive are checked against the whole window
in the document's text, which tells exact phrases from proximity matches.

The terms of the items go to every task in blocks of at most ``block_terms``; a
larger benchmark is searched in several passes. Postings, candidates and texts
are joined by Spark, never gathered.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.rows import keyed
from starloom.llm.tokens import LETTERS, slices
from starloom.scale import stable

WINDOW = 10
PROBES = 3
SLOP = 2
BLOCK_TERMS = 2_000_000


class Terms:
    """Membership of hashes in a sorted array, behind a table over their top bits."""

    BITS = 20

    def __init__(self, hashes: np.ndarray):
        self.sorted = np.unique(hashes.astype(np.int64).view(np.uint64))
        self.table = np.zeros(1 << self.BITS, dtype=bool)
        self.table[self.sorted >> np.uint64(64 - self.BITS)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``h`` of members, and their indexes in the sorted array."""
        at = np.flatnonzero(self.table[h >> np.uint64(64 - self.BITS)])
        where = np.searchsorted(self.sorted, h[at])
        where[where == len(self.sorted)] = 0
        hit = self.sorted[where] == h[at] if len(self.sorted) else np.zeros(len(at), bool)
        return at[hit], where[hit]


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """``item_id, win, n, terms``: a row per window; ``win`` is its hash, ``terms`` its word hashes."""

    def cut(batches):
        for batch in batches:
            ids = batch.column("item_id").to_pylist()
            out = {"item_id": [], "win": [], "n": [], "terms": []}
            for s in slices(batch.column("text")):
                s.find_words(LETTERS, lower=True)
                h = s.word_hashes()
                by_size = {}
                for r in range(s.rows):
                    a, b = int(s.word_off[r]), int(s.word_off[r + 1])
                    n = min(window, b - a)
                    if not n:
                        continue
                    if n not in by_size:
                        by_size[n] = s.windows(h, n)
                    for i in range(a, b - n + 1):
                        out["item_id"].append(ids[s.first_row + r])
                        out["win"].append(int(by_size[n][i].view(np.int64)))
                        out["n"].append(n)
                        out["terms"].append(h[i : i + n].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out["item_id"], pa.string()),
                    pa.array(out["win"], pa.int64()),
                    pa.array(out["n"], pa.int32()),
                    pa.array(out["terms"], pa.list_(pa.int64())),
                ],
                names=["item_id", "win", "n", "terms"],
            )

    columns = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    return columns.mapInArrow(cut, "item_id string, win long, n int, terms array<long>")


def term_counts(rows: DataFrame, terms: Terms) -> DataFrame:
    """``term, df``: occurrences in the corpus, summed per task before the shuffle."""

    def count(batches):
        total = np.zeros(len(terms.sorted), dtype=np.int64)
        for batch in batches:
            for s in slices(batch.column("text")):
                _, where = terms.find(s.find_words(LETTERS, lower=True).word_hashes())
                total += np.bincount(where, minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(terms.sorted[some].view(np.int64)), pa.array(total[some])], names=["term", "df"])

    return rows.select("text").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def postings(rows: DataFrame, terms: Terms) -> DataFrame:
    """``term, _d, _h, positions``: the index over the given terms."""

    def post(batches):
        for batch in batches:
            d, h_row = (np.asarray(batch.column(c)) for c in ("_d", "_h"))
            for s in slices(batch.column("text")):
                at, where = terms.find(s.find_words(LETTERS, lower=True).word_hashes())
                if not len(at):
                    continue
                doc = np.searchsorted(s.word_off, at, side="right") - 1
                order = np.lexsort((at, where, doc))
                at, where, doc = at[order], where[order], doc[order]
                first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (where[1:] != where[:-1])])
                positions = pa.ListArray.from_arrays(
                    pa.array(np.r_[first, len(at)].astype(np.int32)), pa.array((at - s.word_off[doc]).astype(np.int32))
                )
                row = doc[first] + s.first_row
                yield pa.RecordBatch.from_arrays(
                    [pa.array(terms.sorted[where[first]].view(np.int64)), pa.array(d[row]), pa.array(h_row[row]), positions],
                    names=["term", "_d", "_h", "positions"],
                )

    return rows.select("_d", "_h", "text").mapInArrow(post, "term long, _d long, _h long, positions array<int>")


def _collected(terms: DataFrame) -> Terms:
    """The terms of one block, bounded by ``block_terms``."""
    return Terms(np.array([r[0] for r in terms.collect()], dtype=np.int64))


def candidates(rows: DataFrame, windows: DataFrame, probes: int, slop: int) -> DataFrame:
    """``_d, _h, win, n, start``: starts where the window's rarest terms stand within ``slop`` of their places."""
    terms = windows.select(F.posexplode("terms").alias("off", "term"), "win", "n")
    first = terms.groupBy("win", "n", "term").agg(F.min("off").alias("off"))
    counts = term_counts(rows, _collected(first.select("term").distinct()))
    rank = F.row_number().over(Window.partitionBy("win").orderBy("df", "off"))
    plan = stable(
        first.join(counts, "term", "left")
        .withColumn("rank", rank)
        .withColumn("absent", F.max(F.col("df").isNull()).over(Window.partitionBy("win")))
        .where((F.col("rank") <= probes) & ~F.col("absent"))
        .select("win", "n", "term", "off", "rank")
    )
    index = stable(postings(rows, _collected(plan.select("term").distinct())))
    start = F.explode(F.transform("positions", lambda p: p - F.col("off")))
    found = index.join(plan.where("rank = 1"), "term").select("_d", "_h", "win", "n", start.alias("start")).where("start >= 0")
    for k in range(2, probes + 1):
        step = plan.where(F.col("rank") == k).select("win", F.col("term").alias("_term"), F.col("off").alias("_off"))
        lists = index.select(F.col("term").alias("_term"), "_d", "_h", "positions")
        near = F.exists("positions", lambda p: F.abs(p - F.col("start") - F.col("_off")) <= slop)
        # a window of fewer different terms has no such probe and passes
        found = (
            found.join(step, "win", "left")
            .join(lists, ["_term", "_d", "_h"], "left")
            .where(F.col("_term").isNull() | near)
            .select("_d", "_h", "win", "n", "start")
        )
    return found.distinct()


def _checked(window: int):
    """Check candidates in the texts; a row per document."""

    def check(batches):
        for batch in batches:
            found = batch.column("found").to_pylist()
            n_words, n_hit, hits, near = [], [], [], []
            for s in slices(batch.column("text")):
                s.find_words(LETTERS, lower=True)
                counts = np.diff(s.word_off)
                n_words += counts.tolist()
                some = [r for r in range(s.rows) if found[s.first_row + r]]
                h = s.word_hashes() if some else None
                by_size = {}
                marks = {}
                for r in some:
                    a, total = int(s.word_off[r]), int(counts[r])
                    hit, exact, close = np.zeros(total, bool), set(), set()
                    for c in found[s.first_row + r]:
                        n, i = c["n"], c["start"]
                        if n not in by_size:
                            by_size[n] = s.windows(h, n).view(np.int64)
                        if i + n <= total and by_size[n][a + i] == c["win"]:
                            hit[i : i + n] = True
                            exact.update(c["items"])
                        else:
                            close.update(c["items"])
                    marks[r] = int(hit.sum()), sorted(exact), sorted(close - exact)
                for r in range(s.rows):
                    x, y, z = marks.get(r, (0, [], []))
                    n_hit.append(x)
                    hits.append(y)
                    near.append(z)
            text = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "_d", "_h")), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(hits, text), pa.array(near, text)],
                names=["doc_id", "_d", "_h", "n_words", "n_hit", "items", "near_items"],
            )

    return check


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, probes: int = PROBES, slop: int = SLOP, block_terms: int = BLOCK_TERMS
) -> DataFrame:
    """``doc_id, n_words, n_hit, items, near_items, _d, _h``: one row per input row.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z is lower-cased. A
    window is ``window`` consecutive words of an item; an item with fewer words,
    but not none, is one window. ``n_hit`` counts document words inside any exact
    occurrence; ``items`` are the ids (as strings, sorted) of items with one;
    ``near_items`` those of which only proximity matches were found: the rarest
    ``probes`` terms of a window within ``slop`` words of their places.

    Null texts have no words. Items with a null id are left out. Equal rows get
    equal results, rows of one id with different texts each their own; a null id
    is kept. Repeated items count once. Empty tables on either side: no hits.
    Other columns are ignored.
    """
    rows = keyed(docs)
    windows = stable(item_windows(items.where(F.col("item_id").isNotNull()), window))
    unique = windows.groupBy("win").agg(F.first("n").alias("n"), F.first("terms").alias("terms"))
    blocks = 1 + windows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] // block_terms
    parts = [unique.where(F.pmod("win", F.lit(blocks)) == b) if blocks > 1 else unique for b in range(blocks)]
    found = reduce(DataFrame.unionByName, [candidates(rows, p, probes, slop) for p in parts])
    named = windows.groupBy("win").agg(F.collect_set("item_id").alias("items"))
    per_doc = (
        found.join(named, "win").groupBy("_d", "_h").agg(F.collect_list(F.struct("start", "n", "win", "items")).alias("found"))
    )
    return (
        rows.join(per_doc, ["_d", "_h"], "left")
        .select("doc_id", "_d", "_h", "text", "found")
        .mapInArrow(_checked(window), "doc_id long, _d long, _h long, n_words long, n_hit long, items array<string>, near_items array<string>")
    )
