"""Line-first quality rules, with DataFrame functions only.

Every line is judged by punctuation, navigation and boilerplate rules; failing
lines go; a document that loses too much of its text is rejected. All of it is
one projection over the documents: no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.rows import let

BREAK = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"
# Phrases of web page furniture, lower case.
BOILERPLATE = ("all rights reserved", "privacy policy", "cookies", "javascript", "lorem ipsum", "newsletter")


@dataclass(frozen=True)
class Rules:
    """Bounds of the rules; shares are per word or per line character, in percent."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_symbol_percent: int = 30
    max_shout_percent: int = 30
    max_bar_percent: int = 20
    max_furniture_words: int = 30
    max_lost_percent: int = 50


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BREAK, -1), "")


def count_of(text: Column, pattern: str) -> Column:
    """Characters of ``text`` that a class matches."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern + "+", ""))


def repeat_words(words: Column, n: int = 3) -> Column:
    """Words inside windows of ``n`` words that are found twice or more; ``words`` should be bound by :func:`let`.

    Windows stand as 64-bit hashes. Where none repeats, a hash set tells so;
    else windows sorted with their starts put equal ones side by side, so the
    work is n log n even for texts that repeat throughout.
    """
    size = F.size(words) - (n - 1)
    windows = F.transform(F.arrays_zip(*[F.slice(words, F.lit(k + 1), size) for k in range(n)]), lambda w: F.xxhash64(w))

    def covered(hashes: Column) -> Column:
        with_start = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))

        def repeated(order: Column) -> Column:
            same = lambda i, j: F.coalesce(F.get(order, i)["h"] == F.get(order, j)["h"], F.lit(False))
            found = F.filter(order, lambda x, k: same(k, k - 1) | same(k, k + 1))
            return F.sort_array(F.transform(found, lambda x: x["i"]))

        def total(starts: Column) -> Column:
            step = lambda s, k: F.coalesce(F.least(F.get(starts, k + 1) - s, F.lit(n)), F.lit(n))
            return F.aggregate(F.transform(starts, step), F.lit(0), lambda a, x: a + x)

        return let(F.sort_array(with_start), lambda order: let(repeated(order), total))

    def judged(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered(hashes))

    return F.when(size < 2, F.lit(0)).otherwise(let(windows, judged)).cast("long")


def suspects(text: Column) -> Column:
    """Whether the text has anything that a rule looks at: symbols, bars, brackets, shouts, stock phrases."""
    return text.rlike("[#*$%&<>|\\u00BB{};\\[\\]!]") | reduce(or_, [F.lower(text).contains(p) for p in BOILERPLATE])


def line_fails(line: Column, rules: Rules) -> Column:
    """Whether a line breaks a rule; blank lines break none."""

    def judge(n: Column) -> Column:
        percent = lambda x, bound: x * 100 > n * bound
        symbols = percent(count_of(line, "[#*$%&<>]"), rules.max_symbol_percent)
        bars = percent(count_of(line, "[|\\u00BB]"), rules.max_bar_percent)
        shouting = percent(F.regexp_count(line, F.lit("!!")), rules.max_shout_percent)
        furniture = (n <= rules.max_furniture_words) & reduce(or_, [F.lower(line).contains(p) for p in BOILERPLATE])
        braces = line.rlike("^[\\x20\\x09]*[{}\\[\\];]+[\\x20\\x09]*$")
        return (n > 0) & (symbols | bars | shouting | furniture | braces)

    return let(F.size(words_of(line)), judge)


def quality_rules(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``docs`` with the cleaned text, counts and the verdict.

    Added: ``clean_text`` (lines that pass, joined by \\n), ``n_words``,
    ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` (all of
    the whole input text), ``n_lines_cut``, ``base_failed`` and ``kept``. A
    document is kept unless it has under ``min_words`` words, has over
    ``max_repeat_percent`` of its words in repeated 3-word windows, or loses over
    ``max_lost_percent`` of its word characters with the lines cut.

    Null, empty and blank texts have no words: all counts 0, base_failed, not
    kept. Rows are judged one by one, so repeated rows get equal rows. Columns
    of ``docs`` with a name listed above are replaced.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    added = ("clean_text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines_cut", "base_failed", "kept")
    docs = docs.drop(*added, "__w", "__c")
    lines = F.split(text, "\n", -1)
    duplicates = let(
        F.filter(lines, lambda x: F.btrim(x, F.lit(" \t\x0b\x0c\r")) != ""),
        lambda x: F.size(x) - F.size(F.array_distinct(x)),
    )
    solid = lambda words: F.length(F.array_join(words, ""))
    passed = lambda: let(
        F.filter(lines, lambda x: ~line_fails(x, rules)),
        lambda kept: F.struct(F.array_join(kept, "\n").alias("text"), F.size(kept).alias("n")),
    )
    counted = docs.select(
        "*",
        let(
            words_of(text),
            lambda w: F.struct(F.size(w).alias("n"), solid(w).alias("chars"), repeat_words(w).alias("repeat")),
        ).alias("__w"),
        F.when(suspects(text), passed()).alias("__c"),
    )
    n_words = F.col("__w.n").cast("long")
    base = (n_words < rules.min_words) | (F.col("__w.repeat") * 100 > n_words * rules.max_repeat_percent)
    uncut = F.col("__c").isNull()
    cut = F.when(uncut, F.lit(0)).otherwise(F.size(lines) - F.col("__c.n"))
    lost = (F.col("__w.chars") - solid(words_of(F.col("__c.text")))) * 100 > F.col("__w.chars") * rules.max_lost_percent
    return counted.select(
        *docs.columns,
        F.coalesce("__c.text", text).alias("clean_text"),
        n_words.alias("n_words"),
        F.col("__w.chars").cast("long").alias("word_chars"),
        F.when(uncut, F.lit(0)).otherwise(count_of(text, SYMBOLS)).cast("long").alias("n_symbols"),
        duplicates.cast("long").alias("n_dup_lines"),
        F.col("__w.repeat").alias("n_repeat_words"),
        cut.cast("long").alias("n_lines_cut"),
        base.alias("base_failed"),
        (~base & (uncut | ~lost)).alias("kept"),
    )
