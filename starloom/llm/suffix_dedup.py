"""Removal of repeated byte strings with sharded suffix arrays.

Every window of ``length`` bytes is dealt by its anchor, the least hash among
its substrings of ``length / 2`` bytes: equal windows have equal anchors, so a
shard that holds all text around an anchor sees all their matches. Neighbouring
windows with one anchor form a segment. Blocks first send only hashes of
anchors and segments: a segment found twice is repeated throughout and needs no
text, an anchor with one segment matches nothing. Text goes to a shard only
where different segments share an anchor; the shard sorts its suffixes by
induced sorting and reads repeated windows off the permuted common prefixes.
Anchors with more segments than ``shard_segments`` are not gathered: their
windows are compared by hash, over all buckets, which is exact too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from starloom.llm.blocks import MESSAGE, DistinctRows, answered, bucket_bits, memo_of, messages, relayed, reply, send, with_blocks
from starloom.llm.rows import keyed, shuffle_parts
from starloom.llm.suffix_array import permuted_prefixes, suffix_array
from starloom.llm.tokens import mix, slices

LENGTH = 400
SHARD_SEGMENTS = 500
SHARD_BYTES = 1 << 20

BASE = 0x5851F42D4C957F2D
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    size = max(1 << 20, 1 << max(n - 1, 1).bit_length())
    if size not in _powers:
        _powers.clear()
        with np.errstate(over="ignore"):
            up, down = (np.full(size + 1, x, np.uint64) for x in (BASE, pow(BASE, -1, 2**64)))
            up[0] = down[0] = 1
            _powers[size] = np.cumprod(up), np.cumprod(down)
    return _powers[size]


class Windows:
    """Windows, anchors and segments of the texts of one slice."""

    def __init__(self, s, length: int):
        n = int(s.off[-1])
        self.s, self.length = s, length
        up, self.down = powers(n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[s.buf[:n]] * up[:n], out=self.sums[1:])
        self.first = self.last = np.zeros(0, np.int64)
        self.anchor = self.content = np.zeros(0, np.uint64)
        gram, span = length // 2, length - length // 2 + 1
        if n < length:
            return
        hashes = mix(self.of(np.arange(n - gram + 1), gram))
        # the high bits of the hash, then the place: the least is the leftmost of the least
        least = (hashes & np.uint64(0xFFFFFFFF80000000)) | np.arange(len(hashes), dtype=np.uint64)
        reach = 1
        while 2 * reach <= span:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if span > reach:
            least = np.minimum(least[: len(least) - (span - reach)], least[span - reach :])
        end = np.repeat(s.off[1:], np.diff(s.off))[: len(least)]
        starts = np.flatnonzero(np.arange(len(least)) + length <= end)
        if not len(starts):
            return
        place = (least[starts] & np.uint64(0x7FFFFFFF)).astype(np.int64)
        new = np.r_[True, (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)]
        at = np.flatnonzero(new)
        self.first = starts[at]
        self.last = starts[np.r_[at[1:], len(starts)] - 1] + 1
        self.anchor = mix(hashes[place[at]])  # the least of many hashes has high bits of zero; mixed again they name buckets evenly
        size = self.last - self.first + length - 1
        self.content = mix(self.of(self.first, size) + size.astype(np.uint64))

    def of(self, at: np.ndarray, size) -> np.ndarray:
        """Hashes of substrings: sums of powers, brought down to their start."""
        return (self.sums[at + size] - self.sums[at]) * self.down[at]


class Block(DistinctRows):
    """Segments of a block's texts, all and distinct."""

    def __init__(self, table: pa.Table, length: int):
        super().__init__(table)
        self.length = length
        parts = [(Windows(s, length)) for s in slices(self.texts)]
        cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        shift = np.cumsum([0] + [int(w.s.off[-1]) for w in parts])
        self.first = cat([w.first + k for w, k in zip(parts, shift)], np.int64)
        self.last = cat([w.last + k for w, k in zip(parts, shift)], np.int64)
        anchor, content = cat([w.anchor for w in parts], np.uint64), cat([w.content for w in parts], np.uint64)
        self.buf = cat([w.s.buf[: int(w.s.off[-1])] for w in parts], np.uint8)
        self.off = np.concatenate([[0], *[w.s.off[1:] + k for w, k in zip(parts, shift)]]).astype(np.int64)
        del parts
        order = np.lexsort((content, anchor))
        a, c = anchor[order], content[order]
        new = np.r_[True, (a[1:] != a[:-1]) | (c[1:] != c[:-1])] if len(a) else np.zeros(0, bool)
        self.anchor, self.content = a[new], c[new]
        self.kind = np.empty(len(order), np.int64)  # which distinct segment each segment is
        self.kind[order] = np.cumsum(new) - 1
        self.count = np.bincount(self.kind, minlength=len(self.anchor))
        self.one = order[new]  # a segment of each kind

    def window_hashes(self, segments: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the windows of some segments, and hashes of the windows' bytes."""
        starts = [np.arange(self.first[i], self.last[i]) for i in segments]
        at = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        acc = np.zeros(len(at), np.uint64)
        for k in range(self.length):
            acc *= np.uint64(0xD6E8FEB86659FD93)
            acc += _BYTE[self.buf[at + k]]
        return at, mix(acc)


def _pack_kinds(block: Block):
    twice = (block.count > 1).astype(np.uint8)
    a, c = block.anchor.astype("<u8"), block.content.astype("<u8")
    return lambda i, j: a[i:j].tobytes() + c[i:j].tobytes() + twice[i:j].tobytes()


def _bucket_kinds(limit: int):
    """Per distinct segment of each block: is it found twice; must its text be sent; is its anchor too common for that."""

    def judge(table: pa.Table) -> pa.Table:
        blocks, payload = table["_b"].to_pylist(), table["payload"].to_pylist()
        sizes = [len(p) // 17 for p in payload]
        cat = lambda kind, at: np.concatenate([np.frombuffer(p, kind, count=n, offset=at * n) for p, n in zip(payload, sizes)])
        a, c, twice = cat("<u8", 0), cat("<u8", 8), cat("u1", 16)
        order = np.lexsort((c, a))  # stable: the first block in the table owns a segment
        sa, sc = a[order], c[order]
        new_a = np.r_[True, sa[1:] != sa[:-1]]
        new = new_a | np.r_[True, sc[1:] != sc[:-1]]
        kind, anchor = np.cumsum(new) - 1, np.cumsum(new_a) - 1
        repeated = (np.bincount(kind) > 1) | (np.bincount(kind, weights=twice[order]) > 0)
        kinds_of_anchor = np.bincount(anchor[new])
        n = kinds_of_anchor[anchor]
        flags = np.zeros((3, len(a)), bool)
        flags[0, order] = repeated[kind]
        flags[1, order] = new & (n > 1) & (n <= limit)
        flags[2, order] = new & (n > limit)
        cuts = np.cumsum(sizes)[:-1]
        return reply(blocks, table["_bucket"][0].as_py(), np.split(flags, cuts, axis=1))

    return judge


def _send_texts(block: Block, send_text: np.ndarray, wide: np.ndarray, repeated: np.ndarray, bits: int, key: int) -> pa.Table:
    """Texts of segments to their anchors' buckets, window hashes of common anchors' segments to theirs, and a memo."""
    chosen = np.flatnonzero(send_text)

    def pack(i: int, j: int) -> bytes:
        some = block.one[chosen[i:j]]
        size = block.last[some] - block.first[some] + block.length - 1
        texts = b"".join(block.buf[a : a + n].tobytes() for a, n in zip(block.first[some].tolist(), size.tolist()))
        return np.int64(j - i).tobytes() + block.anchor[chosen[i:j]].astype("<u8").tobytes() + size.astype("<i8").tobytes() + texts

    memo = np.packbits(np.concatenate([repeated, send_text, wide])).tobytes()
    out = [send(block.anchor[chosen], bits, key, pack, memo)]
    if wide.any():
        _, h = block.window_hashes(block.one[np.flatnonzero(wide)])
        u, count = np.unique(h, return_counts=True)
        twice = (count > 1).astype(np.uint8)
        table = send(u, bits, key, lambda i, j: u[i:j].astype("<u8").tobytes() + twice[i:j].tobytes())
        to = pa.array(np.asarray(table["_bucket"]) + (1 << bits))
        out.append(table.set_column(0, "_bucket", to))
    return pa.concat_tables(out)


def _windows_found(table: pa.Table) -> pa.Table:
    payload = table["payload"].to_pylist()
    sizes = [len(p) // 9 for p in payload]
    h = np.concatenate([np.frombuffer(p, "<u8", count=n) for p, n in zip(payload, sizes)])
    twice = np.concatenate([np.frombuffer(p, "u1", offset=8 * n) for p, n in zip(payload, sizes)])
    _, back, count = np.unique(h, return_inverse=True, return_counts=True)
    found = ((count > 1) | (np.bincount(back, weights=twice) > 0))[back]
    return reply(table["_b"].to_pylist(), table["_bucket"][0].as_py(), np.split(found, np.cumsum(sizes)[:-1]))


def _repeated_starts(texts: list[np.ndarray], length: int) -> list[np.ndarray]:
    """Per text, whether the window at each start is found at another place in the texts."""
    sizes = np.array([len(x) for x in texts])
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    t = np.zeros(ends[-1], np.int16)
    for a, x in zip(starts.tolist(), texts):
        t[a : a + len(x)] = x.astype(np.int16) + 1
    before, shared = permuted_prefixes(t, suffix_array(t), starts, cap=4 * length)
    left = np.repeat(ends - 1, sizes + 1) - np.arange(len(t))
    at = np.flatnonzero((shared >= length) & (left >= length))
    mark = np.zeros(len(t), bool)
    mark[at] = True
    mark[before[at]] = True
    return [mark[a : a + n - length + 1] for a, n in zip(starts.tolist(), sizes.tolist())]


def _shards(length: int):
    """Suffix arrays over a bucket's texts, whole anchors together, in shards of some ``SHARD_BYTES``."""

    def match(table: pa.Table) -> pa.Table:
        bucket = table["_bucket"][0].as_py()
        blocks, anchors, texts, owner = table["_b"].to_pylist(), [], [], []
        for i, p in enumerate(table["payload"].to_pylist()):
            n = int(np.frombuffer(p, "<i8", count=1)[0])
            anchors.append(np.frombuffer(p, "<u8", count=n, offset=8))
            size = np.frombuffer(p, "<i8", count=n, offset=8 + 8 * n)
            body = np.frombuffer(p, np.uint8, offset=8 + 16 * n)
            texts += np.split(body, np.cumsum(size)[:-1])
            owner += [i] * n
        anchor = np.concatenate(anchors)
        marks: list[np.ndarray | None] = [None] * len(texts)
        order = np.argsort(anchor, kind="stable").tolist()
        shard, held = [], 0
        for k, i in enumerate(order):
            if held >= SHARD_BYTES and anchor[i] != anchor[order[k - 1]]:
                for j, m in zip(shard, _repeated_starts([texts[j] for j in shard], length)):
                    marks[j] = m
                shard, held = [], 0
            shard.append(i)
            held += len(texts[i])
        for j, m in zip(shard, _repeated_starts([texts[j] for j in shard], length)):
            marks[j] = m
        flags: list[list[np.ndarray]] = [[] for _ in blocks]
        for i, m in zip(owner, marks):
            flags[i].append(m)
        return reply(blocks, bucket, [np.concatenate(f) for f in flags])

    return match


def suffix_dedup(docs: DataFrame, length: int = LENGTH, shard_segments: int = SHARD_SEGMENTS) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept``: texts less every byte in a repeated string of ``length`` bytes.

    A string is repeated if it starts at another place too, in the same document
    or another, overlaps included; all its copies go. Strings are judged on the
    input and never cross documents. ``kept`` is binary, the remaining bytes.
    Anchors and segments are told apart by 128 hash bits together.

    Null and empty texts have no bytes. Equal rows (id and text) are one
    document, each with its result; rows of one id with different texts are
    different documents; a null id is kept. Other columns are ignored; an empty
    table gives an empty table.
    """
    rows = with_blocks(keyed(docs), ordered=False).select("_b", "_d", "doc_id", "text")
    bits = bucket_bits(rows)

    def anchors(key, table):
        block = Block(table, length)
        return send(block.anchor, bits, key[0].as_py(), _pack_kinds(block))

    def texts(key, table, replies):
        if not replies.num_rows or not table.num_rows:
            return messages([], [], [])
        block = Block(table, length)
        repeated, send_text, wide = answered(replies, block.anchor, bits, kinds=3)
        return _send_texts(block, send_text, wide, repeated, bits, key[0].as_py())

    matcher = _shards(length)

    def matches(table):
        if (memo := relayed(table)) is not None:
            return memo
        return _windows_found(table) if table["_bucket"][0].as_py() >= 1 << bits else matcher(table)

    def finish(_, table, replies):
        block = Block(table, length)
        step = np.zeros(len(block.buf) + 1, np.int64)
        memo = memo_of(replies)
        if memo is not None:
            flags = np.unpackbits(np.frombuffer(memo, np.uint8), count=3 * len(block.anchor)).astype(bool)
            repeated, send_text, wide = flags.reshape(3, -1)
            some = np.flatnonzero(repeated[block.kind])
            np.add.at(step, block.first[some], 1)
            np.add.at(step, block.last[some] + length - 1, -1)
            starts = []
            found = {k: v for k, v in zip(replies["_bucket"].to_pylist(), replies["payload"].to_pylist()) if k >= 0}
            chosen = np.flatnonzero(send_text)
            bucket = (block.anchor[chosen] >> np.uint64(64 - bits)).astype(np.int64)
            for k in np.unique(bucket).tolist():
                if k in found:
                    mine = block.one[chosen[bucket == k]]
                    at = np.concatenate([np.arange(block.first[i], block.last[i]) for i in mine])
                    starts.append(at[np.unpackbits(np.frombuffer(found[k], np.uint8), count=len(at)).astype(bool)])
            if wide.any():
                at, h = block.window_hashes(block.one[np.flatnonzero(wide)])
                u, back = np.unique(h, return_inverse=True)
                shift = pa.array(np.asarray(replies["_bucket"].combine_chunks()) - (1 << bits))
                starts.append(at[answered(replies.set_column(0, "_bucket", shift), u, bits)[0][back]])
            for at in starts:
                np.add.at(step, at, 1)
                np.add.at(step, at + length, -1)
        removed = np.cumsum(step[:-1]) > 0
        # a run ends with its document
        begins = removed & ~np.r_[False, removed[:-1]] if len(removed) else removed
        inner = block.off[1:-1]
        inner = inner[inner < len(removed)]
        begins[inner] = removed[inner]
        total = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[block.off])
        kept_off = np.concatenate(([0], np.cumsum(~removed)))[block.off]
        data = block.buf[~removed].tobytes()
        kept = pa.array([data[a:b] for a, b in zip(kept_off[:-1].tolist(), kept_off[1:].tolist())], pa.binary())
        row = pa.array(block.row)
        count = lambda x: pa.array(np.asarray(x, np.int64)).take(row)
        return pa.table(
            {
                "doc_id": block.doc_id,
                "n_bytes": count(np.diff(block.off)),
                "n_removed": count(total(removed)),
                "n_spans": count(total(begins)),
                "kept": kept.take(row),
            }
        )

    by_block = lambda df: df.groupBy("_b")
    asked = by_block(rows).applyInArrow(anchors, MESSAGE)
    answers = asked.groupBy("_bucket").applyInArrow(_bucket_kinds(shard_segments), MESSAGE)
    sent = by_block(rows).cogroup(by_block(answers)).applyInArrow(texts, MESSAGE)
    # a stated number of tasks: adaptive execution would merge buckets by their bytes, while sorting them is the work
    found = sent.repartition(shuffle_parts(rows), "_bucket").groupBy("_bucket").applyInArrow(matches, MESSAGE)
    return by_block(rows).cogroup(by_block(found)).applyInArrow(finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
