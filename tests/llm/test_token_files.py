"""Token files against the library on whole texts, and Elias-Fano sequences against plain arrays."""

import os
import random
import zlib

import numpy as np
import pytest

from starloom.llm import suite
from starloom.llm.elias_fano import EliasFano, encode
from starloom.llm.token_files import Tokens, open_shard, read_manifest, read_token_files, read_vocabulary, write_token_files
from tests.llm import corpus

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH) as f:
        return f.read()


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 3000, 70000])
@pytest.mark.parametrize("top", [0, 1, 1000, 10**9, 2**63])
def test_elias_fano(n, top):
    rng = random.Random(n + top)
    values = np.array(sorted(rng.randint(0, top) for _ in range(n)), dtype=np.uint64)
    data = encode(values)
    coded = EliasFano(data)
    assert len(coded) == n and coded.size == len(data) and (coded.values() == values).all()
    for i in rng.sample(range(n), min(n, 60)):
        assert coded[i] == int(values[i])
        assert coded.before(int(values[i])) == int((values < values[i]).sum())
    assert coded.before(2**64) == n


def test_elias_fano_is_small():
    values = np.cumsum(np.random.default_rng(1).integers(1, 2000, 50000)).astype(np.uint64)
    assert 8 * len(encode(values)) / len(values) < 2.5 + np.log2(values[-1] / len(values))
    with pytest.raises(ValueError):
        encode(np.array([2, 1], dtype=np.uint64))
    with pytest.raises(IndexError):
        EliasFano(encode(values))[len(values)]


def test_cut_texts_are_whole_texts(library, vocabulary):
    """Cutting at spaces changes no id, whatever white space, signs and special words a text holds."""
    rng = random.Random(2)
    pieces = [" ", "  ", "\n", "\n\n", "\t", "\r\n", " ", " ", "\u0085", "\x1c", "a", "Wort", "漢字", "😀", "'s", "don't", ".", ",,", "12", "é", "<|endoftext|>"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    tokens = Tokens(vocabulary, 0)
    assert tokens.cut
    got = [np.frombuffer(b, tokens.kind).tolist() for b in tokens.encode(texts)]
    assert got == [e.ids + [0] for e in library.encode_batch(texts, add_special_tokens=False)]


def test_other_vocabularies_get_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path) as f:
        tokens = Tokens(f.read(), 7)
    assert not tokens.cut
    texts = ["Two  words", "", "UPPER\nlower"]
    want = [e.ids + [7] for e in tokenizers.Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, tokens.kind).tolist() for b in tokens.encode(texts)] == want


def wanted(rows, library):
    """Id, start, tokens and checksum in file order, up to the order of rows of one id."""
    out, start = [], 0
    for d, t in sorted(rows, key=lambda r: corpus.order(r[0])):
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u4")
        out.append((d, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out, start


def test_files(spark, tmp_path, library, vocabulary):
    rows = corpus.corpus() + [(3, "hot row")] * 300
    folder = f"{tmp_path}/out"
    manifest = write_token_files(corpus.frame(spark, rows).repartition(5), folder, vocabulary, 0)
    assert sorted(f for f in os.listdir(folder) if f.endswith(".tok")) == sorted(r.file for r in manifest.collect())
    assert manifest.where("n_docs > 250").count() == 0  # rows of one id and text are cut over shards
    want, total = wanted(rows, library)
    got = sorted((tuple(r) for r in read_token_files(spark, folder).select("start", "doc_id", "n_tokens", "ids_crc32").collect()))
    assert sorted(((d, n, c) for _, d, n, c in got), key=repr) == sorted(want, key=repr)
    assert [d for _, d, _, _ in got] == [d for d, _, _ in want]
    assert [s for s, *_ in got] == [0, *np.cumsum([n for _, _, n, _ in got]).tolist()[:-1]]
    assert sum(r.n_ids for r in manifest.collect()) == total
    texts = {}
    for d, t in rows:
        texts.setdefault(d, []).append(library.encode(t or "", add_special_tokens=False).ids + [0])
    found = {}
    for r in read_manifest(spark, folder).collect():
        file = open_shard(folder, r.file)
        assert file.n_docs == r.n_docs and file.n_ids == r.n_ids
        for i, d in enumerate(file.doc_ids()):
            assert i in file.find(d)
            found.setdefault(d, []).append(file.document(i).tolist())
        assert len(file.find(10**15)) == 0 and len(file.find(-(10**15))) == 0
    assert {d: sorted(v) for d, v in found.items()} == {d: sorted(v) for d, v in texts.items()}


def test_no_documents(spark, tmp_path, vocabulary):
    folder = f"file://{tmp_path}/none"
    assert write_token_files(corpus.frame(spark, []), folder, vocabulary, 0).count() == 0
    assert read_token_files(spark, folder).count() == 0


def test_not_a_token_file(spark, tmp_path):
    (tmp_path / "x.tok").write_bytes(b"x" * 200)
    with pytest.raises(ValueError):
        open_shard(str(tmp_path), "x.tok")


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables absent")
def test_query(spark, library):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    want, _ = wanted(rows, library)
    starts = np.cumsum([0] + [n for _, n, _ in want]).tolist()
    got = sorted(tuple(r) for r in suite.queries()["op13_token_files"](spark, SF_DIR).collect())
    assert got == [(d, s, n, c) for (d, n, c), s in zip(want, starts)]
    assert read_vocabulary(spark, PATH)
