"""MinHash near-duplicates with odd sketches.

Signatures: ``BANDS * ROWS`` MinHash values of a document's 5-word shingles. Bands
of ``ROWS`` values name candidate pairs; at the threshold a pair shares no band
with probability ``(1 - 0.75 ** 4) ** 32``, 5 in a million, and less above it. All
values together are folded into an odd sketch, a bitmap of parities; the
population count of two bitmaps' XOR estimates high similarities well, and pairs
it puts far below the threshold go no further. What is left is confirmed on the
full shingle sets.

No bucket is expanded into pairs. Documents with the same set are one class.
First, each class is compared with one centre: of the leaders of its buckets with
a near sketch, the one that meets most others. Members of a centre's family that it does not link
are compared with the rest of the family by their differences from the centre.
Then only the buckets that still hold several components are looked at again,
and only pairs across components and families: every link of a bucket is so
either confirmed, refused or implied.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.components import components
from starloom.llm.rows import LOWEST_ID, keyed
from starloom.llm.tokens import NOT_WHITE, Slice, mix, slices
from starloom.scale import stable, stored

SHINGLE = 5
PERCENT = 75
BANDS = 32
ROWS = 4
SKETCH_WORDS = 8  # 64-bit words of an odd sketch: 512 parities for 128 values
# Sketches refuse pairs under this estimate: six standard deviations below the threshold.
LOOSE = 0.45

# A family beyond this is compared chunk by chunk, each pair of chunks in a task of its own.
FAMILY_CHUNK = 2048

_SKETCH = [f"s{i}" for i in range(SKETCH_WORDS)]


def _parameters() -> tuple[np.ndarray, np.ndarray]:
    k = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return k[: BANDS * ROWS].astype(np.uint32), k[BANDS * ROWS :].astype(np.uint32) | np.uint32(1)


def shingle_hashes(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of a slice's texts and their offsets; a short text is one shingle."""
    h = s.find_words(NOT_WHITE, lower=True).word_hashes()
    counts = np.diff(s.word_off)
    full = s.windows(h, SHINGLE)
    keep = s.whole(SHINGLE)
    for n in range(1, SHINGLE):
        short = np.flatnonzero(counts == n)
        if len(short):
            at = s.word_off[:-1][short]
            full[at] = s.windows(h, n)[at]
            keep[at] = True
    return full[keep], np.concatenate(([0], np.cumsum(keep)))[s.word_off]


def _signatures(batches):
    flip, factor = _parameters()
    bit = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for batch in batches:
        sizes, set_a, set_b, bands, sketches = [], [], [], [], []
        for s in slices(batch.column("text")):
            h, off = shingle_hashes(s)
            some = np.flatnonzero(np.diff(off))
            size = np.zeros(s.rows, np.int64)
            a, b = np.zeros(s.rows, np.uint64), np.zeros(s.rows, np.uint64)
            for r in some.tolist():
                u = np.unique(h[off[r] : off[r + 1]])
                size[r] = len(u)
                a[r] = mix(u.copy()).sum()
                b[r] = mix(u ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum()
            values = np.zeros((BANDS * ROWS, s.rows), np.uint32)
            if len(some):
                short, begin = (h >> np.uint64(32)).astype(np.uint32), off[:-1][some]
                for k in range(BANDS * ROWS):
                    values[k, some] = np.minimum.reduceat((short ^ flip[k]) * factor[k], begin)
            place = np.arange(BANDS * ROWS, dtype=np.uint64)[:, None] << np.uint64(32)
            each = mix(values.astype(np.uint64) + place)
            key = np.zeros((BANDS, s.rows), np.uint64)
            for k in range(ROWS):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + each[k::ROWS] + np.uint64(k))
            odd = np.zeros((SKETCH_WORDS, s.rows), np.uint64)
            at = (each >> np.uint64(55)).astype(np.int64)  # 9 bits
            for k in range(BANDS * ROWS):
                odd[at[k] >> 6, np.arange(s.rows)] ^= bit[at[k] & 63]
            sizes.append(size)
            set_a.append(a)
            set_b.append(b)
            bands.append(np.ascontiguousarray(key.T))
            sketches.append(odd)
        cat = lambda x: np.concatenate(x).view(np.int64)
        keys = cat(bands) if bands else np.zeros((0, BANDS), np.int64)
        fixed = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel()))
        odd = np.concatenate(sketches, axis=1).view(np.int64) if sketches else np.zeros((SKETCH_WORDS, 0), np.int64)
        whole = [pa.array(cat(x) if x else np.zeros(0, np.int64)) for x in (sizes, set_a, set_b)]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "_d", "_h")), *whole, fixed, *(pa.array(odd[i]) for i in range(SKETCH_WORDS))],
            names=["doc_id", "_d", "_h", "n_shingles", "set_a", "set_b", "bands", *_SKETCH],
        )


def signatures(rows: DataFrame) -> DataFrame:
    schema = "doc_id long, _d long, _h long, n_shingles long, set_a long, set_b long, bands array<long>, " + ", ".join(
        f"{c} long" for c in _SKETCH
    )
    return rows.select("doc_id", "_d", "_h", "text").mapInArrow(_signatures, schema)


def _far() -> int:
    """Most differing bits of two sketches whose estimate is ``LOOSE``: similarity is ``1 + bits / (4 values) * ln(1 - 2 z / bits)``."""
    bits, values = 64 * SKETCH_WORDS, BANDS * ROWS
    return int(bits / 2 * (1 - math.exp((LOOSE - 1) * 4 * values / bits)))


def _apart(left: str, right: str) -> Column:
    """Differing bits of two odd sketches."""
    return reduce(add, [F.bit_count(F.col(f"{left}.{c}").bitwiseXOR(F.col(f"{right}.{c}"))) for c in _SKETCH])


def _near(left: str, right: str) -> Column:
    """Pairs that sizes and sketches leave possible."""
    n, m = F.col(f"{left}.n_shingles"), F.col(f"{right}.n_shingles")
    return (100 * F.least(n, m) >= PERCENT * F.greatest(n, m)) & (_apart(left, right) <= _far())


def _sets(texts: pa.Array) -> list[np.ndarray]:
    out = []
    for s in slices(texts):
        h, off = shingle_hashes(s)
        out += [np.unique(h[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
    return out


def _linked(both: int, n: int, m: int) -> bool:
    return 100 * both >= PERCENT * (n + m - both)


def _confirm(batches):
    """Compare full sets, some hundred pairs at a time. ``gone`` and ``novel`` say how the second set differs from the first."""
    for batch in batches:
        linked, size_a, size_b, gone, novel = [], [], [], [], []
        for begin in range(0, batch.num_rows, 256):
            part = batch.slice(begin, 256)
            for x, y in zip(_sets(part.column("text_a")), _sets(part.column("text_b"))):
                stays = np.isin(x, y, assume_unique=True)
                linked.append(_linked(int(stays.sum()), len(x), len(y)))
                size_a.append(len(x))
                size_b.append(len(y))
                gone.append(np.packbits(~stays).tobytes())
                novel.append(np.setdiff1d(y, x, assume_unique=True).astype("<u8").tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("a"),
                batch.column("b"),
                pa.array(linked, pa.bool_()),
                pa.array(size_a, pa.int64()),
                pa.array(size_b, pa.int64()),
                pa.array(gone, pa.binary()),
                pa.array(novel, pa.binary()),
            ],
            names=["a", "b", "linked", "size_a", "size_b", "gone", "novel"],
        )


def compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs with the verdict on their full sets. Both texts are joined to a pair; nothing is grouped."""
    second = pairs.join(texts.select(F.col("cid").alias("b"), F.col("text").alias("text_b")), "b")
    both = second.join(texts.select(F.col("cid").alias("a"), F.col("text").alias("text_a")), "a")
    schema = "a long, b long, linked boolean, size_a long, size_b long, gone binary, novel binary"
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_confirm, schema)


def _family_links(table: pa.Table) -> pa.Table:
    """Links between members of a centre's family that are not yet in one component.

    Against the centre's set C, a member is C less ``gone`` plus ``novel``, so an
    intersection is a population count and the overlap of two short lists. Only
    as many links are returned as connect what is connected.
    """
    cid, label = (table[c].combine_chunks().to_numpy() for c in ("b", "label"))
    size, centre = table["size_b"].combine_chunks().to_numpy(), int(table["size_a"][0].as_py())
    novel = [np.frombuffer(x, "<u8") for x in table["novel"].to_pylist()]
    words = -(-centre // 64)
    gone = np.zeros((len(cid), words * 8), np.uint8)
    for i, x in enumerate(table["gone"].to_pylist()):
        gone[i, : len(x)] = np.frombuffer(x, np.uint8)
    gone = gone.view(np.uint64)
    extra = np.array([len(x) for x in novel])
    groups = {v: v for v in label.tolist()}

    def top(v: int) -> int:
        while groups[v] != v:
            groups[v] = groups[groups[v]]
            v = groups[v]
        return v

    names = label.tolist()
    out = []
    for i in np.flatnonzero(~table["joined"].combine_chunks().to_numpy(zero_copy_only=False)).tolist():
        lost = np.bitwise_count(gone | gone[i]).sum(axis=1, dtype=np.int64)
        most = centre - lost + np.minimum(extra, extra[i])
        possible = np.flatnonzero((100 * most >= PERCENT * (size + size[i] - most)) & (label != label[i]))
        for j in possible.tolist():
            x, y = top(names[i]), top(names[j])
            if x != y:
                both = centre - int(lost[j]) + len(np.intersect1d(novel[i], novel[j], assume_unique=True))
                if _linked(both, int(size[i]), int(size[j])):
                    groups[x] = y
                    out.append((cid[i], cid[j]))
    return pa.table([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])


def _labels(links: DataFrame) -> DataFrame:
    return components(links).select(F.col("node").alias("cid"), F.col("component").alias("label"))


def links_of(classes: DataFrame, rows: DataFrame) -> DataFrame:
    """``a, b``: pairs of classes that connect all that links connect."""
    bands = classes.select(F.explode("bands").alias("key"), "cid")
    crowd = stable(bands.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    shared = stable(bands.join(crowd, "key"))
    sketched = classes.select("cid", "n_shingles", *_SKETCH)

    # a bucket's leader is the class that meets most others: the one at the centre of a group of near copies
    met = stable(shared.groupBy("cid").agg(F.sum("n").alias("met")))
    leaders = stable(shared.join(met, "cid").groupBy("key").agg(F.max(F.struct("met", "cid"))["cid"].alias("leader")))
    stars = shared.join(leaders, "key").where("cid <> leader").select(F.col("leader").alias("a"), F.col("cid").alias("b")).distinct()
    close = (
        stars.join(sketched.alias("x"), F.col("a") == F.col("x.cid"))
        .join(sketched.alias("y"), F.col("b") == F.col("y.cid"))
        .where(_near("x", "y"))
        .select("a", "b")
    )
    # of the leaders its sketch is near to, the one in the thick of things: so a group has one centre and not many
    ranked = close.join(met.select(F.col("cid").alias("a"), "met"), "a")
    centres = stable(ranked.groupBy("b").agg(F.max(F.struct("met", "a"))["a"].alias("a")).select("a", "b"))
    place = classes.join(met.select("cid"), "cid").select("cid", F.col("rep").alias("_d"), F.col("rep_h").alias("_h"))
    # equal rows of one id name the same text
    texts = stored(rows.join(place, ["_d", "_h"]).select("cid", "text").dropDuplicates(["cid"]), "near")
    families = stable(compared(centres, texts))
    first = families.where("linked").select("a", "b")

    # families with members that the centre does not link: compare those with the others, in chunks
    named = families.withColumnRenamed("linked", "joined").withColumn("label", F.when(F.col("joined"), F.col("a")).otherwise(F.col("b")))
    loose = stable(named.groupBy("a").agg(F.count("*").alias("n"), F.count_if(~F.col("joined")).alias("n_loose")).where("n_loose > 0 and n > 1"))
    chunks = F.ceil(F.col("n") / FAMILY_CHUNK).cast("int")
    mine = F.pmod(F.xxhash64("b"), chunks).cast("int")
    pieces = (
        named.join(loose, "a")
        .withColumn("_i", mine)
        .withColumn("_k", F.explode(F.sequence(F.lit(0), chunks - 1)))
        .select("a", F.least("_i", "_k").alias("_i"), F.greatest("_i", "_k").alias("_k"), "b", "label", "joined", "size_a", "size_b", "gone", "novel")
    )
    second = stable(first.unionByName(pieces.groupBy("a", "_i", "_k").applyInArrow(_family_links, "a long, b long")))

    # buckets that still hold several components: pairs across components and families
    label = stable(_labels(second))
    family = centres.select(F.col("b").alias("cid"), F.col("a").alias("centre"))
    labelled = stable(
        shared.select("key", "cid")
        .join(label, "cid", "left")
        .join(family, "cid", "left")
        .select("key", "cid", F.coalesce("label", "cid").alias("label"), F.coalesce("centre", "cid").alias("centre"))
    )
    several = labelled.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.min("centre").alias("c"), F.max("centre").alias("d"))
    open_keys = stable(several.where("x < y and c < d").select("key"))
    rest = stable(labelled.join(open_keys, "key").join(sketched, "cid"))
    x, y = rest.alias("x"), rest.alias("y")
    apart = (F.col("x.cid") < F.col("y.cid")) & (F.col("x.label") != F.col("y.label")) & (F.col("x.centre") != F.col("y.centre"))
    apart &= (F.col("x.centre") != F.col("y.cid")) & (F.col("y.centre") != F.col("x.cid"))  # compared above
    across = (
        x.join(y, (F.col("x.key") == F.col("y.key")) & apart & _near("x", "y"))
        .select(F.col("x.cid").alias("a"), F.col("y.cid").alias("b"))
        .distinct()
    )
    third = compared(stable(across), texts).where("linked").select("a", "b")
    # what is connected so far are stars already
    return label.select(F.col("cid").alias("a"), F.col("label").alias("b")).unionByName(third)


def minhash_dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, _d, _h``: one row per input row.

    Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z is lower-cased; a document's set is
    its distinct 5-word shingles; with one to four words, the whole sequence.
    Documents are linked when ``100 * intersection >= 75 * union``;
    ``component_id`` is the smallest id reachable.

    Null and blank texts have an empty set and are linked with nothing. A null
    id counts as the lowest long and comes out as null. Rows of one id are one
    document and so in one component. Other columns are ignored; an empty table
    gives an empty table.
    """
    rows = keyed(docs)
    signed = stable(signatures(rows).withColumn("cid", F.xxhash64("set_a", "set_b", "n_shingles")))
    first = F.min(F.struct("_d", "_h", "n_shingles", "bands", *_SKETCH)).alias("p")
    classes = stable(
        signed.where("n_shingles > 0")
        .groupBy("cid")
        .agg(first)
        .select("cid", F.col("p._d").alias("rep"), F.col("p._h").alias("rep_h"), "p.n_shingles", "p.bands", *[f"p.{c}" for c in _SKETCH])
    )
    # texts of one id are one document
    told = signed.where("n_shingles > 0").groupBy("_d").agg(F.min("cid").alias("a"), F.max("cid").alias("b")).where("a < b")
    same_id = signed.join(told.select("_d", "a"), "_d").select("a", F.col("cid").alias("b")).where("a <> b")
    links = links_of(classes, rows).unionByName(same_id)
    joined = components(links).select(F.col("node").alias("cid"), F.col("component").alias("label"))
    # classes without a link are components of their own; each component is named by its smallest id
    labelled = stable(classes.select("cid", "rep").join(joined, "cid", "left").withColumn("label", F.coalesce("label", "cid")))
    smallest = stable(labelled.groupBy("label").agg(F.min("rep").alias("component")))
    named = stable(labelled.join(smallest, "label").select("cid", "component"))
    out = signed.select("doc_id", "_d", "_h", "n_shingles", "cid").join(named, "cid", "left")
    lowest = F.lit(LOWEST_ID).cast("long")
    return out.select(
        "doc_id", "n_shingles", F.nullif(F.coalesce("component", "_d"), lowest).alias("component_id"), "_d", "_h"
    )
