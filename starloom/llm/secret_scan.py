"""Secret scans: fixed patterns, and guess costs for values in credential contexts.

The cost of a value is that of its cheapest segmentation into words, dates,
repeats, keyboard walks and brute-force spans, found by dynamic programming; a
value that stays expensive is a secret and not an ordinary word. Only texts that
hold one of the context words, or a long hexadecimal run, are looked at by
regular expressions; the search for those is a pass over the bytes of a batch.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.tokens import LOWER, byte_class, slices

ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

# Contexts of the method: a credential word, a separator or "is", and a value of printable characters.
CONTEXT = re.compile(
    rb"""(?<![A-Za-z])(pwd|passphrase|passcode|password|passwd|credentials?|bearer|secret|token|private_?key|access_?key|api_?key)"""
    rb"""["']?\x20*(?:[:=]|is\x20|\x20(?=[^\x20]*[0-9]))\x20*["']?([!#-&(-+\--~]{6,})""",
    re.IGNORECASE,
)
_ASSIGN_WORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
_CONTEXT_WORDS = (*_ASSIGN_WORDS, b"pwd", b"passphrase", b"passcode", b"credential", b"bearer", b"private", b"access")
_HEX_BYTES = byte_class(b"0123456789abcdef")
KINDS = ("assign", "access", "hex", "guess")

# Common parts of passwords, most common first; a word's place is its cost.
WORDS = (
    "password pass admin qwerty welcome login master monkey dragon letmein football baseball sunshine princess shadow "
    "superman michael jordan summer winter spring autumn secret token test user root guest changeme default hello "
    "love money server access private public example sample demo temp null none true false undefined value string "
    "your here this that the and for key api name mail home work school company office internet computer system "
    "network database service account customer manager london paris berlin monday friday january june december"
).split()
_RANK = {w: math.log10(i + 2) for i, w in enumerate(WORDS)}
_LONGEST = max(map(len, WORDS))
_FOLD = str.maketrans("0134578@$!", "oleastbasi")
_ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
_KEY = {c: (y, x) for y, row in enumerate(_ROWS) for x, c in enumerate(row)}
_DATE = re.compile(r"(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])(?:[-/._]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)?\d\d")
SPLIT_COST = math.log10(2)
# A keyboard walk: its first key, and each step from there.
WALK_COST = math.log10(47)
STEP_COST = 0.3
MIN_GUESSES = 10.0
# After "is", what looks like a word of prose costs so many times as much.
PROSE_TIMES = 2.4
_PROSE = re.compile(rb"[A-Za-z]?[a-z]+(?:[-'/][a-z]+)*[.,;:!?)\]]*")
_IS = re.compile(rb"is\x20+[\"']?\Z", re.IGNORECASE)


def _near(a: str, b: str) -> bool:
    p, q = _KEY.get(a), _KEY.get(b)
    return p is not None and q is not None and p != q and abs(p[0] - q[0]) <= 1 and abs(p[1] - q[1]) <= 1


def _brute(c: str) -> float:
    return 1.0 if c.isdigit() else math.log10(26) if c.isascii() and c.isalpha() else math.log10(33)


def _cheapest(best: list[float], first: int, end: int, least: int, step: float) -> float:
    """The least cost of a run of ``least`` characters or more that begins at ``first`` or later and ends at ``end``."""
    if end - first < 64:
        return min(best[j] + math.log10(end - j) + step * (end - j - 1) for j in range(first, end - least + 1))
    size = np.arange(end - first, least - 1, -1)
    return float((np.array(best[first : end - least + 1]) + np.log10(size) + step * (size - 1)).min())


def guess_cost(value: str) -> float:
    """log10 of the guesses that the cheapest segmentation needs.

    ``best[i]`` is the least cost of the first ``i`` characters: a brute-force
    character more, or a word, date, repeat or keyboard walk that ends at ``i``.
    A repeat or walk may begin at any place of its run, also where a word before
    it has taken the run's first characters. A segment other than brute force costs ``SPLIT_COST`` on top.
    Words and dates are short; only a run costs more than a step a character.
    """
    n, low = len(value), value.lower()
    folded = low.translate(_FOLD)
    dates: dict[int, list[int]] = {}
    for i in range(n):
        if low[i].isdigit() and (m := _DATE.match(low, i)):
            dates.setdefault(m.end(), []).append(i)
    best = [0.0] * (n + 1)
    run = walk = 0  # starts of the longest repeat and walk that end here
    for i in range(1, n + 1):
        c = value[i - 1]
        cost = best[i - 1] + _brute(c)
        if i > 1 and value[i - 2] != c:
            run = i - 1
        if i > 1 and not _near(low[i - 2], low[i - 1]):
            walk = i - 1
        if i - run >= 3:
            cost = min(cost, _cheapest(best, run, i, 3, 0.0) + _brute(c) + SPLIT_COST)
        if i - walk >= 4:
            cost = min(cost, _cheapest(best, walk, i, 4, STEP_COST) + WALK_COST + SPLIT_COST)
        for size in range(3, min(_LONGEST, i) + 1):
            part = folded[i - size : i]
            rank = _RANK.get(part)
            if rank is not None:
                given = value[i - size : i]
                variants = (0 if given.islower() else math.log10(size) if given != given.capitalize() else SPLIT_COST) + (
                    0 if low[i - size : i] == part else SPLIT_COST * 2
                )
                cost = min(cost, best[i - size] + rank + variants + SPLIT_COST)
        for j in dates.get(i, ()):
            cost = min(cost, best[j] + math.log10(365 * 120) + SPLIT_COST)
        # a block that repeats the one before it
        for size in (2, 3, 4):
            if i >= 2 * size and value[i - size : i] == value[i - 2 * size : i - size]:
                cost = min(cost, best[i - size] + SPLIT_COST)
        best[i] = cost
    return best[n]


def find_secrets(text: bytes, wants_hex: bool, wants_words: bool, min_guesses: float) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` in bytes, base kinds by start and kind, then the method's own."""
    base = [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    if wants_words:
        base += [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if wants_hex:
        base += [(2, m.start(), m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= MIN_HEX]
    more = []
    if wants_words:
        for m in CONTEXT.finditer(text):
            value = m[2].decode()
            prose = _PROSE.fullmatch(m[2]) and _IS.search(text, m.end(1), m.start(2))
            if guess_cost(value) >= min_guesses * (PROSE_TIMES if prose else 1):
                a, b = m.start(2), m.end(2)
                if not any(s <= a and b <= e for _, s, e in base):
                    more.append((3, a, b))
    return sorted(base + more, key=lambda x: (x[1], x[0]))


def _code_points(text: bytes) -> np.ndarray:
    """Code points before each byte offset."""
    lead = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    return np.concatenate(([0], np.cumsum(lead)))


def _suspects(s, words: tuple[bytes, ...], raw: bytes) -> np.ndarray:
    """Which texts of a slice hold one of some byte strings."""
    found = []
    for w in words:
        at = raw.find(w)
        while at >= 0:
            found.append(at)
            at = raw.find(w, at + 1)
    mark = np.zeros(s.rows, bool)
    mark[np.searchsorted(s.off, np.array(found, np.int64), side="right") - 1] = bool(found)
    return mark


def secret_scan(docs: DataFrame, min_guesses: float = MIN_GUESSES) -> DataFrame:
    """``doc_id, spans``: an array of ``kind, start, end`` per row, code points, end exclusive, by start and then kind.

    Kinds are ``assign``, ``access`` and ``hex``, found by fixed patterns, and
    ``guess``, values in credential contexts that lie in none of those and cost
    ``10 ** min_guesses`` guesses or more; a value that looks like a word of
    prose after "is" needs ``PROSE_TIMES`` that power. Without a separator or
    "is", a context needs a value with a digit.

    Null and empty texts have no spans. Rows are scanned one by one, so repeated
    rows give equal rows, and null ids stay. Other columns are ignored; an empty
    table gives an empty table.
    """
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def scan(batches):
        for batch in batches:
            spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for s in slices(batch.column("text")):
                n = int(s.off[-1])
                whole = s.buf[:n].tobytes()
                words = _suspects(s, _CONTEXT_WORDS, LOWER[s.buf[:n]].tobytes())
                keys = _suspects(s, (b"AKIA",), whole)
                stops = np.flatnonzero(~_HEX_BYTES[s.buf[: n + 1]])  # the pad is a stop
                runs = stops[1:][np.diff(stops) > MIN_HEX] if len(stops) else stops
                runs = np.r_[stops[:1][stops[:1] >= MIN_HEX], runs]
                hexes = np.zeros(s.rows, bool)
                # a run over a border of texts may be long in neither: both are looked at
                for r in runs.tolist():
                    hexes[np.searchsorted(s.off, r - 1, side="right") - 1] = True
                    first = stops[np.searchsorted(stops, r) - 1] + 1 if r > stops[0] else 0
                    hexes[np.searchsorted(s.off, first, side="right") - 1 : np.searchsorted(s.off, r - 1, side="right")] = True
                for i in np.flatnonzero(words | keys | hexes).tolist():
                    text = whole[s.off[i] : s.off[i + 1]]
                    found = find_secrets(text, bool(hexes[i]), bool(words[i]), min_guesses)
                    if found:
                        at = _code_points(text)
                        spans[s.first_row + i] = [{"kind": KINDS[k], "start": int(at[a]), "end": int(at[b])} for k, a, b in found]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, pa.list_(kind))], names=["doc_id", "spans"])

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return columns.mapInArrow(scan, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def redacted(text, spans):
    """``text`` with each span replaced by its kind in brackets; columns in, column out. Overlaps are covered once."""
    piece = F.aggregate(
        spans,
        F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda acc, x: F.when(x["end"] <= acc["at"], acc).otherwise(
            F.struct(
                F.concat(
                    acc["out"],
                    F.substring(text, (acc["at"] + 1).cast("int"), F.greatest(x["start"] - acc["at"], F.lit(0)).cast("int")),
                    F.concat(F.lit("["), x["kind"], F.lit("]")),
                ).alias("out"),
                x["end"].alias("at"),
            )
        ),
        lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))),
    )
    return F.when(F.size(spans) == 0, text).otherwise(piece)
