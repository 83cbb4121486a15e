"""Exact deduplication of word sequences by level-wise doubling.

Level one asks for every window of ``base_words`` words whether it is found
twice in the corpus. Only where two neighbouring windows both are can a window
of twice the length repeat; those are the candidates of the next level, and so
on up to ``min_words``. A level that leaves a block no candidates sends nothing
more for it. The last level tells which occurrence comes first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from starloom.llm.blocks import MESSAGE, DistinctRows, answered, bucket_bits, memo_of, messages, relayed, reply, send, with_blocks
from starloom.llm.rows import keyed
from starloom.llm.tokens import NOT_WHITE, join_hash, mix, slices

MIN_WORDS = 20
BASE_WORDS = 10
SPACE = 0x20


class Block(DistinctRows):
    """The hashes of windows over the distinct rows of a block."""

    def hashes(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window hashes of ``n`` words, whether the window is whole, and the word hashes."""
        h, counts, words = [], [], []
        for s in slices(self.texts):
            s.find_words(NOT_WHITE, lower=False)
            w = s.word_hashes()
            words.append(w)
            h.append(s.windows(w, n))
            counts.append(np.diff(s.word_off))
        cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        self.counts = cat(counts, np.int64)
        return cat(h, np.uint64), self.whole(n), cat(words, np.uint64)

    def whole(self, n: int) -> np.ndarray:
        """Whether ``n`` words from each word on are in its document."""
        end = np.cumsum(self.counts)
        return np.arange(end[-1] if len(end) else 0) + n <= np.repeat(end, self.counts)


def _second(words: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """16 more bits of a window's fingerprint, from another combination of its word hashes."""
    acc = np.zeros(len(at), dtype=np.uint64)
    for k in range(n):
        acc *= np.uint64(0xD6E8FEB86659FD93)
        acc += words[at + k]
    return (mix(acc) >> np.uint64(48)).astype("<u2")


def _ask_repeated(h: np.ndarray, cand: np.ndarray, bits: int, block: int, memo: bool) -> pa.Table:
    """31 hash bits below the bucket's, and whether the block has the window twice."""
    u, count = np.unique(h[cand], return_counts=True)
    mark = ((u >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFE)).astype("<u4") | (count > 1)
    return send(u, bits, block, lambda a, b: mark[a:b].tobytes(), np.packbits(cand).tobytes() if memo else None)


def _ask_first(h: np.ndarray, words: np.ndarray, cand: np.ndarray, n: int, bits: int, block: int) -> pa.Table:
    """The whole 80-bit fingerprint: blocks are in document order, so the bucket knows which is first."""
    at = np.flatnonzero(cand)
    u, first = np.unique(h[at], return_index=True)
    extra = _second(words, at[first], n)
    return send(u, bits, block, lambda a, b: u[a:b].astype("<u8").tobytes() + extra[a:b].tobytes(), np.packbits(cand).tobytes())


def _bucket_repeated(table: pa.Table) -> pa.Table:
    if (memo := relayed(table)) is not None:
        return memo
    marks = [np.frombuffer(p, "<u4") for p in table["payload"].to_pylist()]
    every = np.concatenate(marks)
    _, back, count = np.unique(every >> 1, return_inverse=True, return_counts=True)
    twice = np.zeros(len(count), dtype=bool)
    np.logical_or.at(twice, back, (every & 1).astype(bool))
    found = (twice | (count > 1))[back]
    return reply(table["_b"].to_pylist(), table["_bucket"][0].as_py(), np.split(found, np.cumsum([len(m) for m in marks])[:-1]))


def _bucket_first(table: pa.Table) -> pa.Table:
    if (memo := relayed(table)) is not None:
        return memo
    payload, blocks = table["payload"].to_pylist(), np.array(table["_b"].to_pylist())
    sizes = [len(p) // 10 for p in payload]
    h = np.concatenate([np.frombuffer(p, "<u8", count=n) for p, n in zip(payload, sizes)])
    extra = np.concatenate([np.frombuffer(p, "<u2", offset=8 * n) for p, n in zip(payload, sizes)])
    order = np.lexsort((np.repeat(blocks, sizes), extra, h))
    later = np.zeros(len(h), dtype=bool)
    later[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (extra[order[1:]] == extra[order[:-1]])
    return reply(blocks.tolist(), table["_bucket"][0].as_py(), np.split(later, np.cumsum(sizes)[:-1]))


def _candidates(memo: bytes | None, ok: np.ndarray) -> np.ndarray:
    return ok if memo is None else np.unpackbits(np.frombuffer(memo, np.uint8), count=len(ok)).astype(bool)


def _kept_text(block: Block, removed: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Per document: kept words joined by one space, words, removed words."""
    texts, n_words, n_removed, at = [], [], [], 0
    for s in slices(block.texts):
        s.find_words(NOT_WHITE, lower=False)
        n = len(s.starts)
        keep = ~removed[at : at + n]
        at += n
        starts, ends = s.starts[keep], s.ends[keep]
        step = np.zeros(len(s.buf) + 1, dtype=np.int8)  # a kept word and the byte after it
        step[starts] += 1
        step[ends + 1] -= 1
        mask = np.cumsum(step[:-1]) > 0
        # a word that ends its text has no byte after it: the pad or the next text's first byte is not its own
        tail = np.isin(ends, s.off[1:])
        mask[ends[tail]] = False
        mask[starts] = True
        buf = s.buf.copy()
        buf[ends[~tail]] = SPACE
        out, length = buf[mask], np.concatenate(([0], np.cumsum(mask)))
        data, bound = out.tobytes(), length[s.off]
        texts += [data[a:b].removesuffix(b" ").decode() for a, b in zip(bound[:-1].tolist(), bound[1:].tolist())]
        total = np.concatenate(([0], np.cumsum(~keep)))[s.word_off]
        n_words.append(np.diff(s.word_off))
        n_removed.append(np.diff(total))
    cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return texts, cat(n_words), cat(n_removed)


def substring_dedup(docs: DataFrame, min_words: int = MIN_WORDS, base_words: int = BASE_WORDS) -> DataFrame:
    """``doc_id, text, n_words, n_removed``: texts less every word inside a window that also starts earlier.

    A window is ``min_words`` consecutive words ``[^\\x20\\x09-\\x0D]+`` of one
    document; earlier means a smaller id, or the same document and an earlier
    start. ``min_words`` is ``base_words`` times a power of two. Kept words are
    joined by one space; windows are judged on the input. Windows are told apart
    by 80 hash bits.

    Null and blank texts have no words and give ``""``. A null id sorts first.
    Equal rows are one document: each gets its result. Rows of one id with
    different texts come in text order. Other columns are ignored; an empty
    table gives an empty table.
    """
    levels = [base_words]
    while levels[-1] < min_words:
        levels.append(2 * levels[-1])
    if levels[-1] != min_words:
        raise ValueError("min_words must be base_words times a power of two")
    rows = with_blocks(keyed(docs), ordered=True).select("_b", "_d", "doc_id", "text")
    bits = bucket_bits(rows)
    by_block = lambda df: df.groupBy("_b")

    def begin(key, table):
        block = Block(table)
        h, ok, words = block.hashes(base_words)
        if len(levels) == 1:
            return _ask_first(h, words, ok, base_words, bits, key[0].as_py())
        return _ask_repeated(h, ok, bits, key[0].as_py(), memo=False)

    asked = by_block(rows).applyInArrow(begin, MESSAGE)
    def extension(n, double):
        def extend(key, table, replies):
            if not replies.num_rows or not table.num_rows:
                return messages([], [], [])
            block = Block(table)
            h, ok, words = block.hashes(n)
            cand = _candidates(memo_of(replies), ok)
            u, back = np.unique(h[cand], return_inverse=True)
            found = np.zeros(len(h), dtype=bool)
            found[cand] = answered(replies, u, bits)[0][back]
            follow, twice = np.zeros(len(h), dtype=bool), np.zeros_like(h)
            if len(h) > n:
                follow[:-n] = found[:-n] & found[n:]
                twice[:-n] = join_hash(h[:-n], h[n:], double)
            follow &= block.whole(double)
            if not follow.any():
                return messages([], [], [])
            if double == min_words:
                return _ask_first(twice, words, follow, double, bits, key[0].as_py())
            return _ask_repeated(twice, follow, bits, key[0].as_py(), memo=True)

        return extend

    for n, double in zip(levels, levels[1:]):
        answers = asked.groupBy("_bucket").applyInArrow(_bucket_repeated, MESSAGE)
        asked = by_block(rows).cogroup(by_block(answers)).applyInArrow(extension(n, double), MESSAGE)

    def finish(_, table, replies):
        block = Block(table)
        memo = memo_of(replies)
        h, ok, _words = block.hashes(min_words)
        removed = np.zeros(len(h), dtype=bool)
        if memo is not None:
            at = np.flatnonzero(_candidates(memo, ok))
            u, first, back = np.unique(h[at], return_index=True, return_inverse=True)
            again = answered(replies, u, bits)[0][back]
            local = np.ones(len(at), dtype=bool)
            local[first] = False
            begins = np.zeros(len(h) + 1, dtype=np.int64)
            begins[1:][at] = again | local
            total = np.cumsum(begins)
            removed = total[1:] > total[np.maximum(np.arange(1, len(h) + 1) - min_words, 0)]
        texts, n_words, n_removed = _kept_text(block, removed)
        row = pa.array(block.row)
        return pa.table(
            {
                "doc_id": block.doc_id,
                "text": pa.array(texts, pa.string()).take(row),
                "n_words": pa.array(n_words, pa.int64()).take(row),
                "n_removed": pa.array(n_removed, pa.int64()).take(row),
            }
        )

    answers = asked.groupBy("_bucket").applyInArrow(_bucket_first, MESSAGE)
    return by_block(rows).cogroup(by_block(answers)).applyInArrow(finish, "doc_id long, text string, n_words long, n_removed long")
