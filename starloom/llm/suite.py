"""Registered queries of the document operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.byte_bpe import byte_bpe, read_ranks
from starloom.llm.decontaminate import decontaminate
from starloom.llm.line_dedup import line_dedup
from starloom.llm.minhash_dedup import minhash_dedup
from starloom.llm.oracles import ORACLES
from starloom.llm.periodic_runs import periodic_runs
from starloom.llm.quality_rules import quality_rules
from starloom.llm.rows import let
from starloom.llm.sanitise import sanitise
from starloom.llm.secret_scan import secret_scan
from starloom.llm.substring_dedup import substring_dedup
from starloom.llm.suffix_dedup import suffix_dedup
from starloom.llm.token_files import read_token_files, read_vocabulary, write_token_files
from starloom.llm.toxicity import fit, toxicity
from starloom.llm.whitening import NO_VECTORS, fixed_point, identity_error, squared_deviation, whiten
from starloom.llm.whitening import fit as fit_whitening
from starloom.scale import scratch
from starloom.session import configure, size_shuffles

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(size_shuffles(configure(spark), sf_dir), sf_dir)

    _QUERIES[fn.__name__] = run
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def spans_text(spans):
    """``kind:start:end`` of the spans, comma-joined in their order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kind(spans, *kinds):
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


@query
def op1_quality_rules(spark, sf_dir):
    return quality_rules(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines_cut"
    )


@query
def op2_secret_scan(spark, sf_dir):
    spans = F.col("spans")
    return secret_scan(documents(spark, sf_dir)).select(
        "doc_id",
        *[F.size(of_kind(spans, k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex", "guess")],
        F.sha2(spans_text(of_kind(spans, "assign", "access", "hex")), 256).alias("base_sha256"),
        spans_text(spans).alias("spans"),
    )


@query
def op3_substring_dedup(spark, sf_dir):
    return substring_dedup(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op4_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return toxicity(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@query
def op5_minhash_dedup(spark, sf_dir):
    return minhash_dedup(documents(spark, sf_dir)).select(
        "doc_id", "n_shingles", "component_id", F.equal_null("doc_id", "component_id").alias("kept")
    )


@query
def op6_sanitise(spark, sf_dir):
    spans = F.col("spans")
    base = ("email", "ip", "card", "phone")
    return sanitise(documents(spark, sf_dir)).select(
        "doc_id",
        *[F.size(of_kind(spans, k)).cast("long").alias(f"n_{k}") for k in (*base, "term_removed", "term_generalised")],
        F.sha2(spans_text(of_kind(spans, *base)), 256).alias("base_sha256"),
        spans_text(spans).alias("spans"),
    )


@query
def op7_line_dedup(spark, sf_dir):
    return line_dedup(documents(spark, sf_dir)).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op8_suffix_dedup(spark, sf_dir):
    return suffix_dedup(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op9_byte_bpe(spark, sf_dir):
    import public_tokenizers

    ranks = read_ranks(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return byte_bpe(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


@query
def op10_decontaminate(spark, sf_dir):
    found = decontaminate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def with_made_runs(docs: DataFrame) -> DataFrame:
    """The texts of the periodic query: in a tenth of the documents, chosen by id, all words from one on repeat with a period."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    seed = F.floor(chosen / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        begin = F.pmod(seed, n).cast("int")
        period = (F.lit(1) + F.floor((n - begin) / (F.lit(3) + F.pmod(seed, F.lit(8))))).cast("int")
        copies = F.array_repeat(F.slice(words, begin + 1, period), F.ceil((n - begin) / period).cast("int"))
        made = F.concat(F.slice(words, F.lit(1), begin), F.slice(F.flatten(copies), F.lit(1), n - begin))
        return F.when(n > 0, F.array_join(made, " "))

    words = F.regexp_extract_all(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    made = F.when(F.pmod(chosen, F.lit(10)) == 0, let(words, repeated))
    return docs.withColumn("text", F.coalesce(made, F.col("text")))


@query
def op11_periodic_runs(spark, sf_dir):
    found = periodic_runs(with_made_runs(documents(spark, sf_dir).select("doc_id", "text")))
    order = F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))
    longest = F.array_min(order)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        (-F.col("longest.less")).alias("length"),
        F.col("longest.period").alias("period"),
        F.floor(-F.col("longest.less") * 1000 / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_whitening(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    points = fixed_point(table, "embedding", scale=64, offset=1_000_000).select("vec_id", "point")
    model = fit_whitening(points)
    if model is None:
        model = NO_VECTORS
    out = whiten(points, model)
    error = identity_error(out, "whitened", len(model.eigenvalues))
    explained = F.array(*[F.lit(float(v)) for v in model.eigenvalues / model.trace]) if len(model.eigenvalues) else F.array().cast("array<double>")
    # the deviation is worked out below the explosion, once a vector
    measured = out.select("vec_id", squared_deviation("point", model).alias("deviation"), "whitened")
    return measured.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


@query
def op13_token_files(spark, sf_dir):
    import public_tokenizers

    folder = scratch(spark, "token-files")
    vocabulary = read_vocabulary(spark, public_tokenizers.path("byte_bpe_50k.json"))
    write_token_files(documents(spark, sf_dir).select("doc_id", "text"), folder, vocabulary, end_id=0)
    return read_token_files(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
