"""Toxicity scores from a weighted lexicon, matched by Aho-Corasick.

Texts are folded first: case, homoglyphs of Latin letters, digits and signs that
stand for letters inside a word, and all else to single spaces. Lexicon entries
are words and beginnings of words; one automaton finds them all in a pass. A
word's weight is that of its heaviest entry, nothing inside an exception phrase
counts, and the sums are normalised by length.

Entries, weights, exceptions and the scale are learned from labelled rows, at
most ``train_rows`` of them, a documented bound, picked by a hash of the id. All
rows are scored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5

# Letters of other scripts that look like Latin ones, and signs that stand for letters.
HOMOGLYPHS = str.maketrans(
    "аеорсухіјһԁԛѕкмтαειορτυνκı",
    "aeopcyxijhdqskmtaeioptuvki",
)
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"}
_SIGN = re.compile(r"(?<=[^\W\d_])[013457@$!|8]+(?=[^\W\d_])")
_WORD = re.compile(r"[^\W\d_]+")
# Phrases in which a lexicon word is harmless.
EXCEPTIONS = ("class clown", "clown fish", "trash can", "trash bin", "trash bag", "pond scum", "scum line", "sore loser rule")


@dataclass(frozen=True)
class Training:
    """Bounds of the fit. ``train_rows`` bounds the labelled rows used; entries need ``min_docs`` toxic documents."""

    train_rows: int = 20_000
    min_docs: int = 6
    min_share: float = 0.003
    min_weight: float = 2.0
    shortest: int = 4
    longest: int = 8


@dataclass
class Model:
    """Lexicon entries (with their leading, and for whole words closing, space) and the logistic scale."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    scale: tuple[float, ...] = (-3.0, 1.0, 0.0, 0.0)


def fold(text: str) -> str:
    """Folded words between single spaces, with a space at both ends."""
    low = text.lower()
    if not low.isascii():
        low = unicodedata.normalize("NFC", low).translate(HOMOGLYPHS)
    if any(c in low for c in SIGNS):
        low = _SIGN.sub(lambda m: "".join(SIGNS[c] for c in m[0]), low)
    return " " + " ".join(_WORD.findall(low)) + " "


def entries_of(folded: str, training: Training) -> set[str]:
    """Distinct words and word beginnings of a folded text."""
    out = set()
    for w in set(folded.split()):
        out.add(f" {w} ")
        out.update(f" {w[:k]}" for k in range(training.shortest, min(training.longest, len(w) - 1) + 1))
    return out


class Matcher:
    """The automaton of a model."""

    def __init__(self, model: Model):
        self.model = model
        self.automaton = ahocorasick.Automaton()
        for entry, weight in model.weights.items():
            self.automaton.add_word(entry, (len(entry), weight))
        for phrase in model.exceptions:
            padded = f" {phrase} "
            if padded not in model.weights:
                self.automaton.add_word(padded, (len(padded), None))
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, folded: str) -> dict[int, float]:
        """Heaviest entry by the place of its word, less those in exception phrases."""
        found: dict[int, float] = {}
        spared = []
        if len(self.automaton):
            for end, (size, weight) in self.automaton.iter(folded):
                start = end - size + 1
                if weight is None:
                    spared.append((start, end))
                elif weight > found.get(start, 0.0):
                    found[start] = weight
        for a, b in spared:
            for start in [x for x in found if a <= x < b]:
                del found[start]
        return found

    def features(self, folded: str) -> tuple[float, float, float]:
        """Weight of the different words hit, the same per word of text, and the heaviest."""
        found = self.hits(folded)
        if not found:
            return 0.0, 0.0, 0.0
        words: dict[str, float] = {}
        for start, weight in found.items():
            words[folded[start : folded.index(" ", start + 1)]] = weight
        total, n = sum(words.values()), folded.count(" ") - 1
        return math.log1p(total), total / math.sqrt(n + 20), max(words.values())

    def score(self, text: str) -> float:
        x = self.features(fold(text))
        z = self.model.scale[0] + sum(c * v for c, v in zip(self.model.scale[1:], x))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training: crc32 of its id as text, modulo 5, is 0. A null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _fit_scale(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression with a small ridge, by Newton steps."""
    a = np.c_[np.ones(len(x)), x]
    w = np.zeros(a.shape[1])
    ridge = np.diag([1e-6, *[0.05] * x.shape[1]])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge, a.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in w)


def _texts(batches):
    for batch in batches:
        yield from zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), batch.column("_part").to_pylist())


def fit(docs: DataFrame, labels: DataFrame, training: Training = Training()) -> Model:
    """Learn a model from labelled rows outside the held-out fold.

    Labels are ``doc_id, toxic``; null labels are left out, and of several labels
    of one id the largest counts. At most about ``train_rows`` rows are read, a
    share of all by a hash of the id: three parts in four for the lexicon, the
    rest for the scale. Only counts per entry, and three numbers per row of the
    last part, reach the driver. Without toxic rows the lexicon is empty.
    """
    rated = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    share = min(1.0, training.train_rows / max(1, rated.count()))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1_000_000))
    chosen = rated.where(draw < int(share * 1_000_000)).withColumn("_part", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(4)).cast("int"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # bounded by train_rows; spread anew, for the rows of a few files may be all
    sample = texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic", "_part").repartition(max(2, docs.sparkSession.sparkContext.defaultParallelism)).cache()
    try:
        return _fit(sample, training)
    finally:
        sample.unpersist()


def _fit(sample: DataFrame, training: Training) -> Model:
    sizes = {(r[0], r[1]): r[2] for r in sample.groupBy("toxic", (F.col("_part") > 0).alias("learn")).count().collect()}
    n_toxic, n_clean = sizes.get((1, True), 0), sizes.get((0, True), 0)
    if not n_toxic or not n_clean:
        return Model()
    least = max(training.min_docs, int(training.min_share * n_toxic))

    def toxic_counts(batches):
        seen = Counter()
        for text, toxic, part in _texts(batches):
            if toxic and part:
                seen.update(entries_of(fold(text), training))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["entry", "n"])

    counted = sample.mapInArrow(toxic_counts, "entry string, n long").groupBy("entry").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    toxic_docs = {r[0]: r[1] for r in counted.collect()}  # bounded by the sample

    def clean_counts(batches):
        seen = Counter()
        for text, toxic, part in _texts(batches):
            if not toxic and part:
                seen.update(entries_of(fold(text), training) & toxic_docs.keys())
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["entry", "n"])

    clean_docs = {r[0]: r[1] for r in sample.mapInArrow(clean_counts, "entry string, n long").groupBy("entry").agg(F.sum("n")).collect()}
    odds = lambda e: math.log((toxic_docs[e] + 0.5) / (n_toxic + 1)) - math.log((clean_docs.get(e, 0) + 0.5) / (n_clean + 1))
    weights = {e: w for e in toxic_docs if (w := odds(e)) >= training.min_weight}
    model = Model(weights=weights)

    def phrases(batches):
        """Word pairs around hits in documents of either label, and features of the rest."""
        matcher, seen = Matcher(model), Counter()
        for text, toxic, part in _texts(batches):
            folded = fold(text)
            if part:
                for start in matcher.hits(folded):
                    end = folded.index(" ", start + 1)
                    before = folded.rfind(" ", 0, start) + 1 if start else 0
                    after = folded.find(" ", end + 1)
                    if start:
                        seen[folded[before:end], toxic] += 1
                    if after > 0:
                        seen[folded[start + 1 : after], toxic] += 1
        keys = list(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array([seen[k] for k in keys], pa.int64())],
            names=["phrase", "toxic", "n"],
        )

    pairs = sample.mapInArrow(phrases, "phrase string, toxic int, n long").groupBy("phrase").agg(
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("clean"), F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad")
    )
    harmless = [r[0] for r in pairs.where("clean >= 3 and bad = 0").select("phrase").collect()]
    model = Model(weights=weights, exceptions=(*EXCEPTIONS, *sorted(harmless)))

    def features(batches):
        matcher, out = Matcher(model), []
        for text, toxic, part in _texts(batches):
            if not part:
                out.append((*matcher.features(fold(text)), float(toxic)))
        columns = list(zip(*out)) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in columns], names=["a", "b", "c", "y"])

    held = np.array([tuple(r) for r in sample.mapInArrow(features, "a double, b double, c double, y double").collect()])
    if not len(held) or held[:, 3].min() == held[:, 3].max():
        return model
    order = np.lexsort(held.T)  # the same sums whatever the order of tasks
    return Model(weights, model.exceptions, _fit_scale(held[order, :3], held[order, 3]))


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted``: one row per input row.

    The score, 0 to 1, is of the text alone. Null and empty texts get the score
    of a text without hits. Rows are scored one by one, so repeated rows get
    equal rows, and null ids stay (not held out). Other columns are ignored; an
    empty table gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        matcher = Matcher(shared.value)
        for batch in batches:
            scores = [matcher.score(t) for i in range(0, batch.num_rows, 512) for t in batch.column("text").slice(i, 512).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "score"])

    columns = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    scored = columns.mapInArrow(score, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
