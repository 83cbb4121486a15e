"""Token ids in binary files: all ids of a shard side by side, Elias-Fano document boundaries behind them.

A file holds, in this order: 8 magic bytes; the ids, little endian, 2 bytes each
where the vocabulary allows and else 4; the boundaries (where each document
begins, and the end) and the documents' ids, both in Elias-Fano form; a footer
of fixed size. A reader maps the file and gets to document ``i`` by two selects,
to a document id by a binary search over selects; nothing is unpacked for that.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.elias_fano import EliasFano, encode
from starloom.llm.rows import shuffle_parts

MAGIC = b"TOKIDS01"
_FOOT = struct.Struct("<BxxxxxxxQQQqQQ8s")
GROUP_CHARS = 1 << 20
CACHED_SEGMENTS = 1_000_000
CACHED_CHARS = 64
JOINED_SEGMENTS = 8192
READ_IDS = 1 << 21
_MANIFEST = "shard int, file string, n_docs long, n_ids long"


def read_vocabulary(spark: SparkSession, path: str) -> str:
    """A tokenizer file as text, read by Spark so that any store will do; it is a few MB."""
    return spark.read.text(path if "://" in path else f"file://{path}", wholetext=True).first()[0]


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder: a plain path, or a URI of a store that all executors reach."""
    if "://" not in uri:
        uri = "file://" + re.sub("^file:", "", uri)
    return fs.FileSystem.from_uri(uri)


class Tokens:
    """Ids of texts by the tokenizers library, as bytes.

    Where the vocabulary parts texts as byte-level BPE does, no token spans a
    single space or line feed between two visible characters. Such texts are
    cut there, and the library sees each different segment once for as long as
    the cache, of a bounded size, holds it. Other vocabularies get whole texts.
    """

    def __init__(self, vocabulary: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(vocabulary)
        self.kind = np.dtype("<u2" if max(end_id + 1, self.library.get_vocab_size(with_added_tokens=True)) <= 1 << 16 else "<u4")
        self.end = np.array([end_id], dtype=self.kind).tobytes()
        self.cut = self._parts_at_spaces(json.loads(vocabulary))
        vocabulary_of = self.library.get_vocab(with_added_tokens=True)
        self.sizes = np.zeros(max(vocabulary_of.values(), default=0) + 1, dtype=np.int64)
        for token, number in vocabulary_of.items():  # a character of a byte-level token stands for a byte
            self.sizes[number] = len(token)
        self.led: dict[str, bytes] = {}  # by segment without the space before it
        self.bare: dict[str, bytes] = {}

    @staticmethod
    def _parts_at_spaces(made: dict) -> bool:
        first = made.get("pre_tokenizer") or {}
        added = made.get("added_tokens") or []
        return (
            first.get("type") == "ByteLevel"
            and first.get("use_regex", True)
            and not first.get("add_prefix_space")
            and not made.get("normalizer")
            and not made.get("truncation")
            and not made.get("padding")
            and not made["model"].get("dropout")
            and all(re.fullmatch(r"\S+", t["content"]) and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in added)
        )

    def _ids(self, texts: list[str]) -> list[bytes]:
        # one text at a time holds the library's own memory, many times the text, to that of the longest
        many = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.kind).tobytes() for e in many]

    def _ids_led(self, segments: list[str]) -> list[bytes]:
        """Ids of segments with a space before each, many in one text; the bytes of its tokens tell where each ends."""
        out = []
        width = self.kind.itemsize
        for a in range(0, len(segments), JOINED_SEGMENTS):
            some = segments[a : a + JOINED_SEGMENTS]
            ids = np.frombuffer(self._ids([" " + " ".join(some)])[0], self.kind)
            ends = np.cumsum(self.sizes[ids])
            wanted = np.cumsum([1 + len(s.encode()) for s in some])
            last = np.minimum(np.searchsorted(ends, wanted), len(ends) - 1)
            if (ends[last] != wanted).any():  # a vocabulary that does not spell every byte
                out += self._ids([" " + s for s in some])
                continue
            raw, cuts = ids.tobytes(), [0, *((last + 1) * width).tolist()]
            out += [raw[x:y] for x, y in zip(cuts, cuts[1:])]
        return out

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text with the end id, as bytes."""
        if not self.cut:
            for t in texts:
                yield self._ids([t])[0] + self.end
            return
        if len(self.led) + len(self.bare) > CACHED_SEGMENTS:
            self.led, self.bare = {}, {}
        cut = [t.split(" ") for t in texts]
        found = [list(map(self.led.get, c)) for c in cut]  # of the first segment only the text itself is asked below
        gaps = [[i for i, f in enumerate(x) if f is None and i] for x in found]
        unseen = {c[i] for c, g in zip(cut, gaps) for i in g}
        # empty, or with white space at an end: a gap is longer than a space, and the text is cut with care
        odd = {s for s in unseen if not s or s[0].isspace() or s[-1].isspace()}
        new = list(unseen - odd)
        self.led.update(zip(new, self._ids_led(new)))
        for i, (c, g) in enumerate(zip(cut, gaps)):
            if c[0][-1:].isspace() or odd and any(c[k] in odd for k in g):
                cut[i] = None
        firsts = {s for c, t in zip(cut, texts) for s in ([c[0]] if c else _BEFORE_SPACE.split(t))}
        bare = [s for s in firsts if s not in self.bare]
        self.bare.update(zip(bare, self._ids(bare)))
        for c, x, g, t in zip(cut, found, gaps, texts):
            if c is None:
                yield b"".join([*map(self.bare.__getitem__, _BEFORE_SPACE.split(t)), self.end])
                continue
            for k in g:
                x[k] = self.led[c[k]]
            x[0] = self.bare[c[0]]
            x.append(self.end)
            yield b"".join(x)
        for known, fresh in ((self.bare, bare), (self.led, new)):
            for s in fresh:
                if len(s) > CACHED_CHARS:
                    del known[s]


# A single space or line feed between two visible characters.
_BEFORE_SPACE = re.compile(r"(?<=\S)(?=[ \n]\S)")


@cache
def _tokens(vocabulary: str, end_id: int) -> Tokens:
    """One per worker process, so that tasks share the parsed vocabulary and the cache."""
    return Tokens(vocabulary, end_id)


def _grouped(batch: pa.RecordBatch) -> Iterator[tuple[list[int | None], list[str]]]:
    ids, texts, chars = [], [], 0
    for d, t in zip(batch.column(0).to_pylist(), batch.column(1)):
        t = t.as_py() or ""
        ids.append(d)
        texts.append(t)
        chars += len(t)
        if chars >= GROUP_CHARS:
            yield ids, texts
            ids, texts, chars = [], [], 0
    if ids:
        yield ids, texts


def _write_shard(out, batches, tokens: Tokens) -> tuple[int, int]:
    """One file from rows in order; documents and ids in it."""
    width = tokens.kind.itemsize
    out.write(MAGIC)
    sizes: list[np.ndarray] = []
    known: list[np.ndarray] = []
    nulls = 0
    for batch in batches:
        for ids, texts in _grouped(batch):
            coded = list(tokens.encode(texts))
            out.write(b"".join(coded))
            sizes.append(np.array([len(c) // width for c in coded], dtype=np.uint64))
            present = [d for d in ids if d is not None]
            nulls += len(ids) - len(present)
            known.append(np.array(present, dtype=np.int64))
    ends = np.cumsum(np.concatenate(sizes)) if sizes else np.zeros(0, np.uint64)
    doc_ids = np.concatenate(known) if known else np.zeros(0, np.int64)
    first = int(doc_ids[0]) if len(doc_ids) else 0
    bounds = encode(np.r_[np.zeros(1, np.uint64), ends])
    docs = encode(doc_ids.astype(np.uint64) - np.uint64(first % 2**64))
    n_ids = int(ends[-1]) if len(ends) else 0
    out.write(bounds)
    out.write(docs)
    out.write(_FOOT.pack(width, len(ends), n_ids, nulls, first, len(bounds), len(docs), MAGIC))
    return len(ends), n_ids


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int) -> DataFrame:
    """Encode whole texts and write their ids, each document's with ``end_id`` after them, by ascending ``doc_id``.

    ``folder`` must be new, and a place that all executors reach: a plain path,
    or a URI of a store that pyarrow opens. Returns the manifest, a row per
    shard, which is also written to ``folder/manifest``. A file counts only once the
    manifest names it: a lost or repeated task leaves a file of its own name that nothing reads, and that is removed at the end.

    Null texts are empty, so a document has at least the end id. Null ids come
    first; rows of one id follow each other by a hash of their text, and repeated rows are
    documents of their own. Other columns are ignored; an empty table gives a
    manifest without rows. Shards are ranges of (id, hash of the text, place in the
    input), so one id or one row that many rows share is cut as well. A task holds 16 bytes per document of its shard, its longest
    text and a bounded cache.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)
    store, path = _store(folder)
    store.create_dir(path, recursive=True)

    def write(batches):
        shard = TaskContext.get().partitionId()
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}.tok"
        store, path = _store(folder)
        with store.open_output_stream(f"{path}/{name}") as out:
            n_docs, n_ids = _write_shard(out, _with_first(first, batches), _tokens(shared.value, end_id))
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int32()), "file": [name],
            "n_docs": pa.array([n_docs], pa.int64()), "n_ids": pa.array([n_ids], pa.int64()),
        })

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.xxhash64(F.col("text").cast("string")).alias("_h"),
        F.monotonically_increasing_id().alias("_m"),
    )
    keys = ["doc_id", "_h", "_m"]
    dealt = rows.repartitionByRange(shuffle_parts(docs), *keys).sortWithinPartitions(*keys).select("doc_id", "text")
    dealt.mapInArrow(write, _MANIFEST).write.parquet(f"{folder}/manifest")
    manifest = read_manifest(spark, folder)
    named = {r["file"] for r in manifest.select("file").collect()}
    for info in store.get_file_info(fs.FileSelector(path)):
        if info.base_name.endswith(".tok") and info.base_name not in named:
            store.delete_file(info.path)
    return manifest


def _with_first(first, rest):
    yield first
    yield from rest


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")


class TokenFile:
    """A shard, read in place."""

    def __init__(self, source: pa.NativeFile):
        self.source = source
        size = source.size()
        foot = source.read_at(_FOOT.size, size - _FOOT.size)
        width, self.n_docs, self.n_ids, self.n_null, self.first, bounds, docs, magic = _FOOT.unpack(foot)
        if magic != MAGIC or source.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError("not a token file")
        self.kind = np.dtype(f"<u{width}")
        at = len(MAGIC) + self.n_ids * width
        self.bounds = EliasFano(source.read_at(bounds, at))
        self.docs = EliasFano(source.read_at(docs, at + bounds))

    def ids(self, start: int, end: int) -> np.ndarray:
        width = self.kind.itemsize
        return np.frombuffer(self.source.read_at((end - start) * width, len(MAGIC) + start * width), self.kind)

    def span(self, i: int) -> tuple[int, int]:
        """Where the ids of the shard's document ``i`` begin and end."""
        return self.bounds[i], self.bounds[i + 1]

    def document(self, i: int) -> np.ndarray:
        return self.ids(*self.span(i))

    def find(self, doc_id: int | None) -> range:
        """Numbers of the documents with an id."""
        if doc_id is None:
            return range(self.n_null)
        if doc_id < self.first:
            return range(0)
        below = self.docs.before(doc_id - self.first)
        return range(self.n_null + below, self.n_null + self.docs.before(doc_id - self.first + 1))

    def doc_ids(self) -> list[int | None]:
        known = (self.docs.values() + np.uint64(self.first % 2**64)).astype(np.int64)
        return [None] * self.n_null + known.tolist()

    def checksums(self) -> np.ndarray:
        """crc32 of each document's ids as little-endian unsigned 32-bit integers, read in slabs."""
        out = np.zeros(self.n_docs, dtype=np.int64)
        edge = self.bounds.values().astype(np.int64)
        for a in range(0, self.n_ids, READ_IDS):
            b = min(self.n_ids, a + READ_IDS)
            slab = memoryview(self.ids(a, b).astype("<u4").tobytes())
            first, last = np.searchsorted(edge, a, side="right") - 1, np.searchsorted(edge, b, side="left")
            cuts = np.clip(edge[first : last + 1], a, b) - a
            for k, (x, y) in enumerate(zip(cuts.tolist(), cuts[1:].tolist()), int(first)):
                out[k] = zlib.crc32(slab[4 * x : 4 * y], int(out[k]))
        return out


def open_shard(folder: str, name: str) -> TokenFile:
    store, path = _store(folder)
    return TokenFile(store.open_input_file(f"{path}/{name}"))


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, shard, start, n_tokens, ids_crc32`` of every document, from the files.

    ``start`` counts the ids of all documents before it, over all shards. The
    driver adds up one number per shard.
    """
    total, first = 0, []
    for r in read_manifest(spark, folder).orderBy("shard").collect():
        first.append((r["shard"], r["file"], total))
        total += r["n_ids"]
    shards = spark.createDataFrame(first, "shard int, file string, start long").repartition(max(1, len(first)), "shard")

    def read(batches):
        for batch in batches:
            for shard, name, start in zip(*(c.to_pylist() for c in batch.columns)):
                file = open_shard(folder, name)
                edge = file.bounds.values().astype(np.int64)
                n = file.n_docs
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(file.doc_ids(), pa.int64()), "shard": pa.array([shard] * n, pa.int32()),
                    "start": pa.array(edge[:-1] + start, pa.int64()), "n_tokens": pa.array(np.diff(edge), pa.int64()),
                    "ids_crc32": pa.array(file.checksums(), pa.int64()),
                })

    return shards.mapInArrow(read, "doc_id long, shard int, start long, n_tokens long, ids_crc32 long")
