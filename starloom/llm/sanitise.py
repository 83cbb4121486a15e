"""Information-theoretic sanitisation of personal data, with DataFrame functions only.

Fixed patterns find the protected entities. Corpus co-occurrence then tells how
much a term reveals of an entity: its pointwise mutual information with the
entity, as a share of the entity's information content. Terms at or above
``generalise_at`` are generalised in the documents that name the entity, those
at or above ``remove_at`` removed. All counts are of different texts. Only texts
that name an entity are kept and joined; of the others term counts are, summed
in the scan's own tasks, and terms of texts with copies.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.rows import keyed, let
from starloom.scale import size_checked, stable

# The patterns of the contract, with possessive repeats where those match the same and cannot recurse or go quadratic.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
WORD = r"\p{L}[\p{L}\p{M}]*+"
SPAN = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"


@dataclass(frozen=True)
class Disclosure:
    """Bounds of the method: ``doubt`` of few texts, shares of an entity's information."""

    doubt: float = 5.0
    generalise_at: float = 0.6
    remove_at: float = 0.9


CHUNK = 32


def matches(text: Column, pattern: str, kind, keep=lambda hit: F.lit(True)) -> Column:
    """Spans of the matches to keep, leftmost and not overlapping: hits and the gaps between them give the places.

    ``kind`` is a name, or a function of the hit. Spans are gathered by chunks of
    hits, for an array is copied with each span that it gains.
    """
    p = F.lit(pattern)
    name = kind if callable(kind) else lambda hit: F.lit(kind)

    def place(both: Column) -> Column:
        hits, gaps = both["hits"], both["gaps"]
        none = F.array().cast(SPAN)
        zero = F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans"))

        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + F.length(x["gap"])
            end = start + F.length(x["hit"])
            span = F.struct(name(x["hit"]).alias("kind"), start.alias("start"), end.alias("end"), x["hit"].alias("value"))
            spans = F.when(keep(x["hit"]), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
            return F.struct(end.alias("at"), spans.alias("spans"))

        def chunks(pairs: Column) -> Column:
            def more(acc: Column, i: Column) -> Column:
                start = F.struct(acc["at"].alias("at"), none.alias("spans"))
                part = F.aggregate(F.slice(pairs, i, F.lit(CHUNK)), start, step)
                return let(part, lambda x: F.struct(x["at"].alias("at"), F.concat(acc["spans"], F.array(x["spans"])).alias("spans")))

            begun = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))
            return F.aggregate(F.sequence(F.lit(1), F.size(pairs), F.lit(CHUNK)), begun, more, lambda acc: F.flatten(acc["spans"]))

        pairs = F.zip_with(hits, F.slice(gaps, F.lit(1), F.size(hits)), lambda h, g: F.struct(h.alias("hit"), g.alias("gap")))
        few = F.size(hits) <= CHUNK
        return F.when(few, F.aggregate(pairs, zero, step, lambda acc: acc["spans"])).otherwise(let(pairs, chunks))

    return let(F.struct(F.regexp_extract_all(text, p, F.lit(0)).alias("hits"), F.split(text, pattern, -1).alias("gaps")), place)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def weight(d: Column, i: Column) -> Column:
        twice = d.cast("int") * 2
        return F.when(i % 2 == 0, d.cast("int")).when(twice > 9, twice - 9).otherwise(twice)

    single = F.filter(F.split(F.reverse(number), "", -1), lambda d: d != "")
    return F.aggregate(F.transform(single, weight), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid_ip(value: Column) -> Column:
    part = lambda p: F.ltrim(p, F.lit("0"))
    return F.forall(F.split(value, "\\.", -1), lambda p: (F.length(part(p)) <= 3) & (F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255))


def _valid_card(value: Column) -> Column:
    n = digits(value)
    return F.when(F.length(n).between(16, 19), luhn(n)).otherwise(False)


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns, by kind as listed and then start. A cheap test first spares most texts the search."""
    none = F.array().cast(SPAN)
    found = lambda test, spans: F.when(test, spans).otherwise(none)
    return F.concat(
        found(text.contains("@"), matches(text, EMAIL, "email")),
        found(text.rlike(r"[0-9]\.[0-9]++\.[0-9]"), F.filter(matches(text, IP, "ip"), lambda s: _valid_ip(s["value"]))),
        found(text.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"), F.filter(matches(text, CARD, "card"), lambda s: _valid_card(s["value"]))),
        found(
            text.contains("+"),
            F.filter(matches(text, PHONE, "phone"), lambda s: F.length(digits(s["value"])).between(8, 15)),
        ),
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with spaces in place of the spans, so that other words keep their places."""
    by_start = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    zero = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(acc: Column, s: Column) -> Column:
        start = F.greatest(s["start"], acc["at"])
        between = F.substring(text, (acc["at"] + 1).cast("int"), (start - acc["at"]).cast("int"))
        blank = F.repeat(F.lit(" "), (s["end"] - start).cast("int"))
        return F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(F.concat(acc["out"], F.array(between, blank)).alias("out"), s["end"].alias("at")))

    rest = lambda acc: F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))
    return F.aggregate(by_start, zero, step, lambda acc: F.concat(F.array_join(acc["out"], ""), rest(acc)))


def terms_in(text: Column) -> Column:
    """Distinct words, lower-cased."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))


def hashed(terms: Column) -> Column:
    return F.transform(terms, lambda t: F.xxhash64(t))


def term_counts(whole: DataFrame, named: DataFrame) -> tuple[DataFrame, int]:
    """``term, term_docs`` over the corpus' different texts, entities left out, and the number of those texts.

    Every row is counted in the scan; what repeated texts and the words of
    entities have too much is then subtracted.
    """
    per_text = stable(whole.groupBy("_h").agg(F.count("*").alias("copies")))
    n = per_text.count()
    copied, _ = size_checked(per_text.where("copies > 1"))
    plain = whole.select(F.explode(terms_in(F.col("text"))).alias("t")).select(F.xxhash64("t").alias("term"), F.lit(1).cast("long").alias("w"))
    again = (
        whole.select("_h", hashed(terms_in(F.col("text"))).alias("terms"))
        .join(copied, "_h")
        .groupBy("_h")
        .agg(F.first("terms").alias("terms"), F.first("copies").alias("copies"))
        .select(F.explode("terms").alias("term"), (1 - F.col("copies")).alias("w"))
    )
    inside = named.select(F.explode(F.array_except("whole_terms", "terms")).alias("term"), F.lit(-1).cast("long").alias("w"))
    counted = plain.unionByName(again).unionByName(inside).groupBy("term").agg(F.sum("w").alias("term_docs"))
    return counted, n


def revealing_terms(whole: DataFrame, named: DataFrame, entities: DataFrame, bounds: Disclosure) -> DataFrame:
    """``_h, term, share``: terms of a text that tell ``generalise_at`` or more of the information of an entity it names.

    ``named`` has a row per different text with an entity, ``_h, terms,
    whole_terms``, ``entities`` the different pairs ``_h, entity``. Entities of
    the same texts have equal shares and are one. A pair found in ``b`` texts has
    its probability smoothed by ``b * b / (b * b + doubt)``: one text tells
    something only where the entity's information is large.
    """
    counted, n = term_counts(whole, named)
    mix = lambda salt: F.bit_xor(F.xxhash64("_h", F.lit(salt)))
    groups = entities.groupBy("entity").agg(F.count("*").alias("docs"), mix("a").alias("a"), mix("b").alias("b"))
    per_text = (
        entities.join(groups.select("entity", "docs", F.xxhash64("docs", "a", "b").alias("group")), "entity")
        .select("_h", "group", "docs")
        .distinct()
    )
    information = F.log(F.lit(float(n))) - F.log("docs")

    def share(both: Column) -> Column:
        mutual = F.log(both * float(n)) - F.log(F.col("docs").cast("double") * F.col("term_docs")) - F.log1p(bounds.doubt / (both * both))
        return F.least(mutual / information, F.lit(1.0))

    # no pair is in more texts than its term or its entity: where that many would not do, it is left out before pairs are counted
    most = F.least("docs", "term_docs").cast("double")
    pairs = stable(
        named.select("_h", F.explode("terms").alias("term"))
        .join(counted, "term")
        .join(per_text, "_h")
        .where((information > 0) & (share(most) >= bounds.generalise_at))
        .select("_h", "group", "term", "docs", "term_docs")
    )
    told = (
        pairs.groupBy("group", "term")
        .agg(F.count("*").cast("double").alias("both"), F.first("docs").alias("docs"), F.first("term_docs").alias("term_docs"))
        .select("group", "term", share(F.col("both")).alias("share"))
        .where(F.col("share") >= bounds.generalise_at)
    )
    return pairs.select("_h", "group", "term").join(told, ["group", "term"]).select("_h", "term", "share")


def sanitise(docs: DataFrame, bounds: Disclosure = Disclosure()) -> DataFrame:
    """``doc_id, spans``: protected entities and revealing terms of every row, as ``kind, start, end, value`` in code points.

    Kinds come in the order ``email, ip, card, phone, term_removed,
    term_generalised``, each by start. Terms are the words of the whole text
    outside protected entities, of any length; one is marked wherever it stands
    in a document that names an entity it reveals.

    Null and empty texts have no spans. Equal texts are one text in the counts,
    and each row gets its result; null ids stay. Other columns are ignored; an
    empty table gives an empty table.
    """
    rows = keyed(docs)
    whole = rows.select("doc_id", "_h", F.coalesce("text", F.lit("")).alias("text"))
    found = stable(
        whole.select("doc_id", "_h", "text", base_spans(F.col("text")).alias("spans")).select(
            "doc_id", "_h", "spans", F.when(F.size("spans") > 0, masked(F.col("text"), F.col("spans"))).alias("rest"), F.when(F.size("spans") > 0, F.col("text")).alias("text")
        )
    )
    naming = found.where(F.size("spans") > 0)
    named = stable(
        naming.select("_h", hashed(terms_in(F.col("rest"))).alias("terms"), hashed(terms_in(F.col("text"))).alias("whole_terms"))
        .groupBy("_h")
        .agg(F.first("terms").alias("terms"), F.first("whole_terms").alias("whole_terms"))
    )
    entity = lambda s: F.xxhash64(F.when(s["kind"] == "email", F.lower(s["value"])).otherwise(digits(s["value"])), s["kind"])
    entities = stable(naming.select("_h", F.explode("spans").alias("s")).select("_h", entity(F.col("s")).alias("entity")).distinct())
    marked, _ = size_checked(
        stable(
            revealing_terms(whole, named, entities, bounds)
            .groupBy("_h")
            .agg(
                F.collect_set(F.when(F.col("share") >= bounds.remove_at, F.col("term"))).alias("remove"),
                F.collect_set(F.col("term")).alias("reveal"),
            )
        )
    )
    term = lambda hit: F.xxhash64(F.lower(hit))
    kind = lambda hit: F.when(F.array_contains("remove", term(hit)), "term_removed").otherwise("term_generalised")
    words = matches(F.col("rest"), WORD, kind, lambda hit: F.array_contains("reveal", term(hit)))
    of = lambda w, k: F.filter(w, lambda s: s["kind"] == k)
    every = let(words, lambda w: F.concat(F.col("spans"), of(w, "term_removed"), of(w, "term_generalised")))
    told = naming.join(marked, "_h", "left").select("doc_id", F.when(F.col("reveal").isNull(), F.col("spans")).otherwise(every).alias("spans"))
    return told.unionByName(found.where(F.size("spans") == 0).select("doc_id", "spans"))


def sanitised(text: Column, spans: Column) -> Column:
    """The text with entities replaced by their kind, revealing terms generalised to ``[term]`` or removed."""
    shown = lambda s: F.when(s["kind"] == "term_removed", "").when(s["kind"] == "term_generalised", "[term]").otherwise(
        F.concat(F.lit("["), s["kind"], F.lit("]"))
    )
    by_start = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), shown(s).alias("shown"))))
    zero = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(acc: Column, s: Column) -> Column:
        between = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.when(s["start"] < acc["at"], acc).otherwise(
            F.struct(F.concat(acc["out"], between, s["shown"]).alias("out"), s["end"].alias("at"))
        )

    return F.aggregate(by_start, zero, step, lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
