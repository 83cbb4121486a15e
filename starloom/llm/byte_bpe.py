"""Byte-level BPE encoding and decoding in length-bucketed numpy matrices.

A text is cut into pieces by the tokenizer's pattern. Pieces that a task has
not met are encoded together: those of similar length fill the rows of one
padded matrix, and each round every row merges its leftmost pair of least rank,
found by a hashed pair table, and closes the gap. Known pieces come from a
bounded cache. Documents are independent, so there is no shuffle.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CACHE_PIECES = 400_000
MATRIX_CELLS = 1 << 18
GROUP_TEXTS = 512
NONE = np.int32(2**31 - 1)


class PairTable:
    """Open-addressing table from a pair of ids to the id, which is the rank, of their merge."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        bits = max(4, int(4 * len(merged) - 1).bit_length()) if len(merged) else 4
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.values = np.full(1 << bits, NONE, dtype=np.int32)
        self.depth = 1
        key = (left.astype(np.int64) << 32) | right
        slot, left_over = self._slot(key), np.arange(len(key))
        step = 0
        while len(left_over):
            at = (slot[left_over] + step) & self.mask
            free = self.keys[at] == -1
            took, index = np.unique(at[free], return_index=True)
            winner = left_over[free][index]
            self.keys[took], self.values[took] = key[winner], merged[winner]
            left_over = np.setdiff1d(left_over, winner, assume_unique=True)
            # whoever lost a slot that was free looks at it again and finds it taken
            step += 1
            self.depth = max(self.depth, step)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 32) | right
        slot = self._slot(key)
        out = np.where(self.keys[slot] == key, self.values[slot], NONE)
        open_ = np.flatnonzero((out == NONE) & (self.keys[slot] != -1))
        for step in range(1, self.depth):
            if not len(open_):
                break
            at = (slot[open_] + step) & self.mask
            hit = self.keys[at] == key[open_]
            out[open_[hit]] = self.values[at[hit]]
            open_ = open_[~hit & (self.keys[at] != -1)]
        return out


class ByteBpe:
    """Encoder and decoder for a table of ranks, given as the bytes of a ``.tiktoken`` file."""

    def __init__(self, ranks: bytes, pattern: str, cache_pieces: int = CACHE_PIECES):
        tokens: dict[bytes, int] = {}
        for line in io.BytesIO(ranks):
            if line.strip():
                token, rank = line.split()
                tokens[base64.b64decode(token)] = int(rank)
        self.pattern = regex.compile(pattern)
        self.tokens = tokens
        self.bytes_of = {i: t for t, i in tokens.items()}
        self.byte_id = np.array([tokens[bytes([b])] for b in range(256)], dtype=np.int32)
        left, right, merged = [], [], []
        for token, rank in tokens.items():
            for cut in range(1, len(token)):
                a, b = tokens.get(token[:cut]), tokens.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        self.pairs = PairTable(np.array(left, np.int64), np.array(right, np.int64), np.array(merged, np.int32))
        self.cache_pieces = cache_pieces
        self.cache: dict[str, tuple[str, int, bytes]] = {}

    def merge_rows(self, pieces: list[bytes], width: int) -> list[list[int]]:
        """Ids of pieces of at most ``width`` bytes: rows of one padded matrix."""
        n = len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, n)
        flat = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        ids = np.full((n, width + 1), -1, dtype=np.int32)  # one column of padding behind
        ids[np.arange(width + 1)[None, :] < lengths[:, None]] = flat
        rank = np.full((n, width), NONE, dtype=np.int32)
        inside = np.arange(width)[None, :] < (lengths - 1)[:, None]
        rank[inside] = self.pairs.find(ids[:, :-1][inside], ids[:, 1:][inside])
        done: list[list[int]] = [[]] * n
        live = np.arange(n)
        while len(live):
            at = rank.argmin(axis=1)  # the leftmost of the least
            every = np.arange(len(live))
            best = rank[every, at]
            finished = best == NONE
            if finished.any():
                for r in np.flatnonzero(finished).tolist():
                    done[live[r]] = ids[r, : lengths[r]].tolist()
                keep = ~finished
                ids, rank, lengths, live, at, best = ids[keep], rank[keep], lengths[keep], live[keep], at[keep], best[keep]
                if not len(live):
                    break
                most = int(lengths.max())
                ids, rank = ids[:, : most + 1], rank[:, :most]
                every = np.arange(len(live))
            # close the gap: what stands right of the merged pair moves one to the left
            column = np.arange(ids.shape[1] - 1)[None, :]
            moved = column > at[:, None]
            ids = np.concatenate([np.where(moved, ids[:, 1:], ids[:, :-1]), np.full((len(live), 1), -1, np.int32)], axis=1)
            ids[every, at] = best
            shifted = np.concatenate([rank[:, 1:], np.full((len(live), 1), NONE, np.int32)], axis=1)
            rank = np.where(column[:, : rank.shape[1]] > at[:, None], shifted, rank)
            lengths -= 1
            rank[every, at] = NONE
            for off in (-1, 0):
                a = at + off
                ok = np.flatnonzero((a >= 0) & (a + 1 < lengths))
                rank[ok, a[ok]] = self.pairs.find(ids[ok, a[ok]], ids[ok, a[ok] + 1])
        return done

    def _long(self, piece: bytes) -> list[int]:
        """Pieces too long for a matrix row: the same merges with a queue of pairs, in n log n."""
        ids = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        found = self.pairs.find(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        queue = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(found) if r != NONE]
        heapq.heapify(queue)

        def look(i: int) -> None:
            j = after[i]
            if i >= 0 and j < n:
                r = int(self.pairs.find(np.array([ids[i]]), np.array([ids[j]]))[0])
                if r != NONE:
                    heapq.heappush(queue, (r, i, ids[i], ids[j]))

        while queue:
            r, i, a, b = heapq.heappop(queue)
            j = after[i] if alive[i] else n
            if not alive[i] or ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], alive[j] = r, False
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            look(i)
            if before[i] >= 0:
                look(before[i])
        return [x for x, ok in zip(ids, alive) if ok]

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece. Widths double from bucket to bucket, and a matrix has at most ``MATRIX_CELLS`` cells."""
        out: list[list[int]] = [[]] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            known = self.tokens.get(p)
            if known is not None:
                out[i] = [known]
            elif len(p) > 512:
                out[i] = self._long(p)
            elif p:
                buckets.setdefault(max(4, (len(p) + 3) // 4 * 4 if len(p) <= 32 else 1 << (len(p) - 1).bit_length()), []).append(i)
        for width, members in buckets.items():
            rows = max(1, MATRIX_CELLS // width)
            for a in range(0, len(members), rows):
                some = members[a : a + rows]
                for i, ids in zip(some, self.merge_rows([pieces[i] for i in some], width)):
                    out[i] = ids
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def learn(self, pieces: set[str]) -> None:
        """Put pieces into the cache: ids as text, their number, and the bytes the ids decode to."""
        new = [p for p in pieces if p not in self.cache]
        if len(self.cache) + len(new) > self.cache_pieces:
            self.cache.clear()
            new = list(pieces)
        for p, ids in zip(new, self.encode_pieces([p.encode() for p in new])):
            self.cache[p] = (",".join(map(str, ids)), len(ids), self.decode(ids))

    def encode_texts(self, texts: list[str]) -> Iterator[tuple[str, int, bytes]]:
        """Per text: ids joined by commas, their number, and the bytes they decode to."""
        cut = [self.pattern.findall(t) for t in texts]
        self.learn(set().union(*cut))
        for pieces in cut:
            got = [self.cache[p] for p in pieces]
            yield ",".join([g[0] for g in got]), sum([g[1] for g in got]), b"".join([g[2] for g in got])


def read_ranks(spark: SparkSession, path: str) -> bytes:
    """The bytes of a rank file, read by Spark so that any store will do; a vocabulary is a few MB."""
    return bytes(spark.read.format("binaryFile").load(path if "://" in path else f"file://{path}").select("content").first()[0])


def byte_bpe(docs: DataFrame, ranks: bytes, pattern: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``, and ``ids`` (array) and ``decoded`` (binary) with ``with_ids``.

    The ids are those of ``ranks`` for each match of ``pattern`` separately,
    without special tokens; ``ids_sha256`` is of the decimal ids joined by
    commas, ``decoded_sha256`` of the bytes the ids stand for.

    Null and empty texts have no tokens: 0 and the hash of nothing. Rows are
    encoded one by one, so repeated rows and ids give equal rows, and null ids
    stay. Other columns are ignored; an empty table gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pattern))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded binary" if with_ids else "")

    def encode(batches):
        bpe = ByteBpe(*shared.value)
        for batch in batches:
            n_tokens, ids_sha, bytes_sha, ids, decoded = [], [], [], [], []
            texts = batch.column("text")
            for i in range(0, len(texts), GROUP_TEXTS):
                for joined, n, back in bpe.encode_texts([t or "" for t in texts.slice(i, GROUP_TEXTS).to_pylist()]):
                    n_tokens.append(n)
                    ids_sha.append(hashlib.sha256(joined.encode()).hexdigest())
                    bytes_sha.append(hashlib.sha256(back).hexdigest())
                    if with_ids:
                        ids.append(np.array(joined.split(","), np.int32) if n else np.zeros(0, np.int32))
                        decoded.append(back)
            columns = [batch.column("doc_id"), pa.array(n_tokens, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(bytes_sha, pa.string())]
            if with_ids:
                columns += [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in schema.split(", ")])

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return columns.mapInArrow(encode, schema)
