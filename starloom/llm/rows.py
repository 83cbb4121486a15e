"""Column helpers shared by the document operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOWEST_ID = -(2**63)
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
DIGEST_BITS = 256


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also when ``body`` uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def keyed(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, ``text``, the columns to carry, and the two key columns of a row: ``_d`` and ``_h``.

    ``_d`` is the id with null as the lowest long, so that a null id is one
    document that sorts first. ``_h`` tells rows of one id with different texts
    apart; equal rows share both and so get equal results. Columns of these two names are not carried.
    """
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        *[c for c in carry if c not in ("doc_id", "text", "_d", "_h")],
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST_ID)).alias("_d"),
        F.xxhash64(F.col("text").cast("string"), F.col("text").isNull()).alias("_h"),
    )


def replaced(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with a new text, and with ``n_chars`` to match where there is such a column."""
    out = docs.withColumn("text", text)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def shuffle_parts(docs: DataFrame) -> int:
    return max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
