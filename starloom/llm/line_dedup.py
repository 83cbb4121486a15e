"""Corpus-wide line deduplication, with DataFrame functions only.

Lines are exploded, normalised and hashed; distinct documents are counted per
hash; a line whose hash reaches the threshold stays in one document alone; the
rest is reassembled by position. The text moves once, for the reassembly: the
counting works on 128-bit hashes, and a hot line costs one row per task and
document in a partial aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.rows import WHITE, keyed, let
from starloom.scale import stable

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lines_of(text: Column) -> Column:
    """Lines split at \\n; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """White space stripped at both ends, A-Z lower-cased, other letters as they are."""
    bare = F.btrim(line, F.lit(WHITE))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, UPPER.lower()))


def repeated_lines(rows: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """``_d, _h, drop``: per row, the sorted positions of the lines to drop."""
    line = rows.select("_d", "_h", F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    keys = line.select("_d", "_h", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    # two 64-bit hashes with different seeds stand for the key
    keys = keys.select("_d", "_h", "pos", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(1), "key").alias("k2"))
    # stored, so that both sides of the join below are plain shuffles and Spark can split a hot line's
    common = stable(
        keys.groupBy("k1", "k2")
        .agg(F.count_distinct("_d").alias("n"), F.max("_d").alias("keeper"))
        .where(F.col("n") >= min_docs)
        .select("k1", "k2", "keeper")
    )
    return (
        keys.join(common, ["k1", "k2"])
        .where(F.col("_d") != F.col("keeper"))
        .groupBy("_d", "_h")
        .agg(F.sort_array(F.collect_set("pos")).alias("drop"))
    )


def without(lines: Column, drop: Column) -> Column:
    """``lines`` less the sorted positions ``drop``: the slices between them, so linear in the lines."""

    def cut(d: Column) -> Column:
        def piece(i: Column) -> Column:
            begin = F.when(i == 0, F.lit(0)).otherwise(F.get(d, i - 1) + 1)
            end = F.coalesce(F.get(d, i), F.size(lines))
            return F.slice(lines, begin + 1, end - begin)

        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(d)), piece))

    return let(drop, cut)


def line_dedup(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped``: one row per input row, in no order.

    A line whose key has ``min_chars`` code points or more and is found in
    ``min_docs`` or more distinct documents is dropped everywhere but in the
    document with the largest id that holds it, where all its copies stay.

    Null or empty text: one empty line, never dropped (result text ``""``). Null
    ids count as one document below all others. Rows of the same id count as one
    document; each is rewritten on its own. An empty table gives an empty table.
    Columns named in ``carry`` come along; others are ignored.
    """
    rows = keyed(docs, carry)
    drops = repeated_lines(rows, min_chars, min_docs)
    joined = rows.join(drops, ["_d", "_h"], "left")
    lines = lines_of(F.col("text"))
    kept = F.when(F.col("drop").isNull(), F.coalesce(F.col("text"), F.lit(""))).otherwise(
        let(lines, lambda all_lines: F.array_join(without(all_lines, F.col("drop")), "\n"))
    )
    return joined.select(
        "doc_id",
        kept.alias("text"),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"),
        *[c for c in carry if c not in ("doc_id", "text")],
    )
