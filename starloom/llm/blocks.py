"""Blocks of documents that exchange packed questions and answers with buckets of hashes.

A step that asks "is this hash found elsewhere?" for every position of a corpus
would shuffle a row per position. Here documents are dealt once into blocks; a
block sends each bucket one row with its distinct hashes, packed and sorted, and
the bucket answers with one bit per hash. Copies inside a block are merged
before they are sent, so a hash that a third of all documents share costs a
bucket one entry per block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.rows import shuffle_parts

BLOCKS_PER_PARTITION = 2
MESSAGE = "_bucket long, _b int, payload binary"
_SCHEMA = pa.schema([("_bucket", pa.int64()), ("_b", pa.int32()), ("payload", pa.binary())])


class DistinctRows:
    """The distinct rows of a block by id and text: ``texts``; ``row`` leads from each ``doc_id`` of the block to its text."""

    def __init__(self, table: pa.Table):
        text = pc.fill_null(table["text"].combine_chunks(), "")
        order = pc.sort_indices(pa.table([table["_d"].combine_chunks(), text], names=["d", "t"]), [("d", "ascending"), ("t", "ascending")])
        ids, texts = table["_d"].combine_chunks().take(order), text.take(order)
        n = len(texts)
        fresh = np.ones(n, dtype=bool)
        if n > 1:  # equal rows are one document and share its result
            again = pc.and_(pc.equal(ids.slice(1), ids.slice(0, n - 1)), pc.equal(texts.slice(1), texts.slice(0, n - 1)))
            fresh[1:] = ~np.asarray(again)
        self.texts = texts.filter(pa.array(fresh))
        self.doc_id = table["doc_id"].combine_chunks().take(order)
        self.row = np.cumsum(fresh) - 1


def bucket_bits(docs: DataFrame) -> int:
    """Buckets are a power of two, one or more for each shuffle partition: messages are blocks times buckets at most."""
    return (shuffle_parts(docs) - 1).bit_length()


def with_blocks(rows: DataFrame, ordered: bool) -> DataFrame:
    """Add ``_b``, the block of a row: by ranges of ``_d`` when ``ordered``, else by a hash of the row.

    Range bounds come from one approximate-quantile pass over the ids; the
    driver gets a number per block. Rows of one id share a block.
    """
    blocks = BLOCKS_PER_PARTITION * shuffle_parts(rows)
    if not ordered:
        return rows.withColumn("_b", F.pmod(F.xxhash64("_d", "_h"), F.lit(blocks)).cast("int"))
    at = [(i + 1) / blocks for i in range(blocks - 1)]
    cuts = rows.agg(F.percentile_approx(F.col("_d").cast("double"), at, 5 * blocks)).first()[0] or [0.0]
    splits = [-float("inf"), *sorted(set(cuts)), float("inf")]
    dealt = Bucketizer(splits=splits, inputCol="_x", outputCol="_y").transform(rows.withColumn("_x", F.col("_d").cast("double")))
    return dealt.withColumn("_b", F.col("_y").cast("int")).drop("_x", "_y")


def messages(bucket, block, payload) -> pa.Table:
    return pa.table([pa.array(bucket, pa.int64()), pa.array(block, pa.int32()), pa.array(payload, pa.binary())], schema=_SCHEMA)


def bucket_bounds(sorted_hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(buckets, first, last)`` of the buckets that sorted 64-bit hashes fall into, by their top bits."""
    bucket = (sorted_hashes >> np.uint64(64 - bits)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, np.int64)
    return bucket[first], first, np.r_[first[1:], len(bucket)].astype(np.int64)


def send(sorted_hashes: np.ndarray, bits: int, block: int, pack, memo: bytes | None = None) -> pa.Table:
    """One message per bucket; ``pack(first, last)`` gives its payload. ``memo`` comes back to the block unread."""
    buckets, first, last = bucket_bounds(sorted_hashes, bits)
    payload = [pack(a, b) for a, b in zip(first.tolist(), last.tolist())]
    to = buckets.tolist()
    if memo is not None:
        to.append(-1 - block)
        payload.append(memo)
    return messages(to, [block] * len(to), payload)


def answered(replies: pa.Table, sorted_hashes: np.ndarray, bits: int, kinds: int = 1) -> np.ndarray:
    """``kinds`` rows of a bit per hash, from replies in the order of ``send``."""
    out = np.zeros((kinds, len(sorted_hashes)), dtype=bool)
    found = dict(zip(replies["_bucket"].to_pylist(), replies["payload"].to_pylist()))
    buckets, first, last = bucket_bounds(sorted_hashes, bits)
    for k, a, b in zip(buckets.tolist(), first.tolist(), last.tolist()):
        if k in found:
            flags = np.unpackbits(np.frombuffer(found[k], np.uint8), count=kinds * (b - a))
            out[:, a:b] = flags.reshape(kinds, b - a)
    return out


def relayed(table: pa.Table) -> pa.Table | None:
    """Memos pass a bucket as they are."""
    return table.select(["_bucket", "_b", "payload"]) if table["_bucket"][0].as_py() < 0 else None


def memo_of(replies: pa.Table) -> bytes | None:
    return next((p for k, p in zip(replies["_bucket"].to_pylist(), replies["payload"].to_pylist()) if k < 0), None)


def reply(blocks: list[int], bucket: int, flags: list[np.ndarray]) -> pa.Table:
    """A message back to each block that has a flag set."""
    some = [(b, np.packbits(f).tobytes()) for b, f in zip(blocks, flags) if f.any()]
    return messages([bucket] * len(some), [b for b, _ in some], [p for _, p in some])
