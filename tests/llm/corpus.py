"""A small corpus with every awkward case, and brute-force versions of the operators."""

from __future__ import annotations

import collections
import math
import random
import re

SCHEMA = "doc_id long, text string, source string, n_words long, spans string, _d string, _h string, _b string, key string, kept string, label string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def corpus(seed: int = 7) -> list[tuple[int | None, str | None]]:
    """Ids and texts: null, empty, blank and long texts, a null id, repeated rows, one id twice, copies, near copies, shared passages."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdéfgß漢😀") for _ in range(rng.randint(1, 9))) for _ in range(300)] + ["the", "of", "a", "The", "OF"]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage = " ".join(words(90))
    line = "A line that many documents share, word for word."
    texts: list[str | None] = [None, "", " \n\t ", "one", "one two three four", "x" * 3000, "ab " * 500, "\n".join([line] * 3)]
    for i in range(30):
        text = " ".join(words(rng.randint(5, 160)))
        if i % 3 == 0:
            text += f"\n{line}\r\n  {line.upper() if i % 2 else line}  \n"
        if i % 4 == 0:
            text = text[: len(text) // 2] + " " + passage + " " + text[len(text) // 2 :]
        texts.append(text)
    base = words(120)
    for i in range(8):
        near = list(base)
        for _ in range(i):
            near[rng.randrange(len(near))] = rng.choice(vocabulary)
        texts.append(" ".join(near))
    texts += [texts[10], texts[10], texts[12], " ".join(words(4000)), "tail\n", "\n\n"]
    rows: list[tuple[int | None, str | None]] = [(i * 3 - 5, t) for i, t in enumerate(texts)]
    rows += [rows[9], rows[20], (None, texts[11]), (rows[15][0], "another text of the same id, with a few words")]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "s", -1, "x", "d", "h", "b", "k", "no", "l") for d, t in rows], SCHEMA)


def order(d):
    return -(2**63) if d is None else d


def substring(rows, n: int):
    """Kept text, words and removed words by row; equal rows are one document."""
    first: set = set()
    out = {}
    for d, t in sorted(set(rows), key=lambda r: (order(r[0]), r[1] or "")):
        w = WORD.findall(t or "")
        gone = set()
        for i in range(len(w) - n + 1):
            gram = tuple(w[i : i + n])
            if gram in first:
                gone.update(range(i, i + n))
            first.add(gram)
        out[d, t] = (" ".join(x for i, x in enumerate(w) if i not in gone), len(w), len(gone))
    return out


def suffix(rows, n: int):
    """Bytes, removed, spans and kept bytes by row; equal rows are one document."""
    seen: collections.Counter = collections.Counter()
    distinct = {(d, t): (t or "").encode() for d, t in rows}
    for b in distinct.values():
        seen.update(b[i : i + n] for i in range(len(b) - n + 1))
    out = {}
    for key, b in distinct.items():
        gone = set()
        for i in range(len(b) - n + 1):
            if seen[b[i : i + n]] > 1:
                gone.update(range(i, i + n))
        spans = sum(1 for i in gone if i - 1 not in gone)
        out[key] = (len(b), len(gone), spans, bytes(x for i, x in enumerate(b) if i not in gone))
    return out


def near(rows):
    """Set size and component by row; rows of one id are one document."""
    sets = {}
    for d, t in set(rows):
        w = WORD.findall((t or "").translate(LOWER))
        sets[d, t] = frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    parent = {d: d for d, _ in sets}

    def top(d):
        while parent[d] != d:
            d = parent[d]
        return d

    keys = list(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((top(a[0]), top(b[0])), key=order)
                parent[q] = p
    return {k: (len(sets[k]), top(k[0])) for k in keys}


def lines(rows, min_chars=20, min_docs=3):
    """Text, lines and dropped lines by row."""
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    docs = collections.defaultdict(set)
    for d, t in rows:
        for x in (t or "").split("\n"):
            docs[key(x)].add(order(d))
    out = {}
    for d, t in rows:
        every = (t or "").split("\n")
        kept = [x for x in every if not (len(key(x)) >= min_chars and len(docs[key(x)]) >= min_docs and max(docs[key(x)]) != order(d))]
        out[d, t] = ("\n".join(kept), len(every), len(every) - len(kept))
    return out


def contaminated(rows, items, window=10):
    """Words, hit words and items by row."""
    grams = collections.defaultdict(set)
    for i, t in items:
        w = TERM.findall((t or "").translate(LOWER))
        n = min(window, len(w))
        for k in range(len(w) - n + 1) if n and i is not None else ():
            grams[tuple(w[k : k + n])].add(str(i))
    sizes = {len(g) for g in grams}
    out = {}
    for d, t in rows:
        w = TERM.findall((t or "").translate(LOWER))
        hit, ids = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                found = grams.get(tuple(w[k : k + n]))
                if found:
                    hit.update(range(k, k + n))
                    ids |= found
        out[d, t] = (len(w), len(hit), sorted(ids))
    return out


def quality(text):
    t = text or ""
    w = WORD.findall(t)
    grams = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for x in t.split("\n"):
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    symbols = len(re.findall(r"[#*$%&|<>]", t))
    return len(w), sum(map(len, w)), symbols, dup, len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)


def entities(t):
    """Kind, start and end of the fixed patterns' spans."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    luhn = lambda d: sum(x - 9 * (x > 9) for x in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(d)))) % 10 == 0
    out = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", m) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(digits(m[0])) <= 15]
    return [(k, m.start(), m.end()) for k, m in out]


def personal(rows, doubt=5.0, generalise=0.6, remove=0.9):
    """Kind, start and end of entities and revealing terms by id."""
    texts = {t or "" for _, t in rows}
    spans = {t: entities(t) for t in texts}
    blank = {}
    for t in texts:
        chars = list(t)
        for _, a, b in spans[t]:
            chars[a:b] = " " * (b - a)
        blank[t] = "".join(chars)
    words = {t: [(m[0].lower(), m.start(), m.end()) for m in re.finditer(r"[^\W\d_]+", blank[t])] for t in texts}
    names = {t: {(k, t[a:b].lower() if k == "email" else re.sub("[^0-9]", "", t[a:b])) for k, a, b in spans[t]} for t in texts}
    terms = {t: {w for w, _, _ in words[t]} for t in texts}
    term_docs = collections.Counter(w for t in texts for w in terms[t])
    entity_docs = collections.Counter(e for t in texts for e in names[t])
    both = collections.Counter((e, w) for t in texts for e in names[t] for w in terms[t])

    def share(e, w):
        b, information = both[e, w], math.log(len(texts) / entity_docs[e])
        return 0 if information <= 0 else (math.log(b * len(texts) / (entity_docs[e] * term_docs[w])) - math.log1p(doubt / b**2)) / information

    out = {}
    for d, t in rows:
        t = t or ""
        most = {w: max((share(e, w) for e in names[t]), default=0) for w in terms[t]}
        gone = [("term_removed", a, b) for w, a, b in words[t] if most[w] >= remove]
        out[d] = spans[t] + gone + [("term_generalised", a, b) for w, a, b in words[t] if generalise <= most[w] < remove]
    return out
