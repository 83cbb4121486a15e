"""The registered document queries on driver tables, against their SQL or brute force, and the pipeline against brute force."""

import base64
import hashlib
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starloom.llm import suite
from tests.compare import database, differences
from tests.llm import corpus

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables absent")


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


@pytest.fixture(scope="module")
def rows(con):
    return con.execute("SELECT doc_id, text FROM documents").fetchall()


@pytest.mark.parametrize("key", sorted(suite.oracle_sql()))
def test_against_sql(spark, con, key):
    assert differences(suite.queries()[key](spark, SF_DIR), con, suite.oracle_sql()[key]) == []


def test_suffix_query(spark, rows):
    want = corpus.suffix(rows, 400)
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suite.queries()["op8_suffix_dedup"](spark, SF_DIR).collect())
    assert got == Counter((d, *want[d, t][:3], hashlib.sha256(want[d, t][3]).hexdigest()) for d, t in rows)


@pytest.mark.parametrize("key", ["op2_secret_scan", "op4_toxicity", "op6_sanitise"])
def test_one_row_per_document(spark, rows, key):
    out = suite.queries()[key](spark, SF_DIR)
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == sorted(d for d, _ in rows)


def test_pipeline(spark, con, rows):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    pipeline = pytest.importorskip("corpus_pipeline")
    with open(public_tokenizers.path(pipeline.VOCABULARY), "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    bpe = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    assert [name for name, _ in pipeline.STAGES] == ["quality rules", "line dedup", "near-dedup", "decontamination", "token ids"]

    judged = pipeline.keep_quality(spark, spark.read.parquet(f"{SF_DIR}/documents.parquet"), SF_DIR)
    assert judged.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert judged.where(F.length("text") != F.col("n_chars")).count() == 0
    docs = [(r.doc_id, r.text) for r in judged.collect()]
    failed = {d for d, t in rows if corpus.quality(t)[-1]}
    assert docs and not failed & {d for d, _ in docs}
    docs = [(d, v[0]) for (d, _), v in corpus.lines(docs).items()]
    groups = corpus.near(docs)
    docs = [(d, t) for d, t in docs if groups[d, t][1] == d]
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    hits = corpus.contaminated(docs, items)
    want = {}
    for d, t in docs:
        if not hits[d, t][1]:
            ids = bpe.encode_ordinary(t)
            want[d] = len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in pipeline.run(spark, SF_DIR).collect()}
    assert got == want
