"""The corpus pipeline: quality rules, line dedup, near-dedup, benchmark decontamination, token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table; all but the last
keep the columns of ``documents``. ``run`` writes every stage's table to the
shared folder and reads it back as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.byte_bpe import byte_bpe, read_ranks
from starloom.llm.decontaminate import decontaminate
from starloom.llm.line_dedup import line_dedup
from starloom.llm.minhash_dedup import minhash_dedup
from starloom.llm.quality_rules import quality_rules
from starloom.llm.rows import keyed, replaced
from starloom.scale import stored
from starloom.session import configure

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others lose the lines that fail."""
    judged = quality_rules(docs).where("kept")
    return replaced(judged, F.col("clean_text")).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; every document stays, if only as an empty text."""
    cut = line_dedup(docs, carry=docs.columns)
    return replaced(cut, F.col("text")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    surplus = minhash_dedup(docs).where(~F.equal_null("doc_id", "component_id")).select("_d", "_h").distinct()
    return keyed(docs, docs.columns).join(surplus, ["_d", "_h"], "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    hit = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("n_hit > 0").select("_d", "_h").distinct()
    return keyed(docs, docs.columns).join(hit, ["_d", "_h"], "left_anti").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the bytes they decode to."""
    import public_tokenizers

    return byte_bpe(docs, read_ranks(spark, public_tokenizers.path(VOCABULARY)), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("near-dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("token ids", encode),
]

# Byte-level BPE has no SQL form; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
