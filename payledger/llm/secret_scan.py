"""Secret scans with password guess costs (operator 4).

Base patterns find assignments, access keys and long hex runs. Beside them,
values in a wider credential context (``DB_PASS=``, ``credential:``, ``Bearer`` ...)
are judged by how hard they are to guess: dynamic programming finds the
segmentation into words, dates, repeats, keyboard walks and brute-force spans
with the least total of log10 guesses. A value at or above ``GUESSES`` is a
secret (kind ``guess``); ``pwd: password1990`` is not. A value inside a base
match is not reported again, base matches always stay.

Defined results: a null or empty text has no spans and the digest of the empty
string. Positions are code points, ends exclusive. The whole text is read;
the dynamic programme runs on single whole values, in time in proportion to them. Repeated rows and null ids
keep their own result; extra columns are ignored (``scan``) or kept (``redact``).
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # 18 characters or more: shorter runs fail as a whole
HEX = re.compile(r"[0-9a-f]{16,}")  # maximal runs of 16 or more
ASSIGN_LEAST = 12
KINDS = ("assign", "access", "hex", "guess")

#: Wider credential contexts: a keyword (after ``_`` or ``-`` too), a separator, a scheme or none, a value without white
#: space. After ``bearer`` alone a word of prose is no value: it has a digit, a sign, inner capitals or 20 characters.
CONTEXT = re.compile(
    r"""(?<![A-Za-z0-9])(?:(?:pwd|pass(?:word|wd|phrase|code)?|pin|secret|token|credentials?|auth(?:orization)?|bearer|private[_-]?key|"""
    r"""(?:secret[_-]?)?access[_-]?key|api[_-]?key|client[_-]?secret)["']?[\x20\t]*(?::=|[:=]|[\x20\t]is[\x20\t])[\x20\t]*["']?"""
    r"""(?:(?:bearer|basic|token)(?:[\x20\t]*[:=][\x20\t]*|[\x20\t]+)["']?)?|"""
    r"""bearer[\x20\t]+["']?(?=[^\s"'<>,;]*(?:\d|[+/_=~]|(?-i:[a-z][A-Z]))|[^\s"'<>,;]{20}))([^\s"'<>,;]{6,})""", re.I | re.A)
#: Every context holds one of these, lower-cased.
HINTS = ("pwd", "pass", "pin", "secret", "token", "credential", "auth", "bearer", "key")
#: log10 of the guesses from which a value counts as a secret.
GUESSES = 9.0

# Words that guessers try first, in the order of their rank.
WORDS = (
    "password pass admin user login welcome secret test guest root master letmein monkey dragon qwerty shadow sunshine "
    "princess football baseball superman batman summer winter spring autumn hello love money power freedom computer internet "
    "server system example changeme default public private token key access super access account service demo temp sample "
    "the and for with this that from have your what name word home house world time life friend family happy black white red "
    "green blue orange yellow silver golden star moon sun night day fire water earth tiger lion eagle wolf bear horse "
    "january february march april may june july august september october november december monday tuesday wednesday thursday "
    "friday saturday sunday michael jennifer thomas jordan hunter daniel andrew joshua robert charlie"
).split()
RANK = {w: i + 1 for i, w in reversed(list(enumerate(WORDS)))}
LEET = str.maketrans("@4310$5!7", "aaeiossit")
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz")
WORD_LEAST, WORD_MOST, DATE_MOST = 2, max(map(len, WORDS)), 10
#: Neighbours on a walk: along a row, or from a row of keys to the next one, straight or aslant.
WALK = {frozenset(p) for row in ROWS for p in zip(row, row[1:])}
WALK |= {frozenset((a, low[j])) for up, low in zip(ROWS[:3], ROWS[1:4]) for i, a in enumerate(up) for j in (i - 1, i) if 0 <= j < len(low)}
DATE = re.compile(r"(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])(?:[-/._]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d")


def _alphabet(ch: str) -> int:
    if ch.isdigit():
        return 10
    if ch.islower() or ch.isupper():
        return 26
    return 33 if ch.isascii() else 100


def pieces(value: str) -> Iterator[tuple[int, int, float]]:
    """``(start, end, log10 guesses)`` of the pieces that a guesser tries, by end: single
    characters by brute force; words, reversed too; dates; and the longest walk on the
    keyboard, run of one character and repeat that end there, three characters or more.
    A repeat copies what stands at one distance before it, the distance at which the
    last three characters occurred last."""
    low = value.lower()
    plain = low.translate(LEET)
    last: dict[str, int] = {}  # where three characters ended last
    walk_from = run_from = copy_from = distance = 0
    for end in range(1, len(value) + 1):
        ch = value[end - 1]
        yield end - 1, end, math.log10(_alphabet(ch))
        if end > 1:
            if frozenset(low[end - 2 : end]) not in WALK:
                walk_from = end - 1
            if low[end - 2] != low[end - 1]:
                run_from = end - 1
        if end - walk_from >= 3:  # a walk: where it starts, its length and turns
            yield walk_from, end, math.log10(4 * len(ROWS) * 10 * (end - walk_from))
        if end - run_from >= 3:  # one character, repeated
            yield run_from, end, math.log10(_alphabet(ch) * (end - run_from))
        if end >= 3:
            gram = low[end - 3 : end]
            back = end - last[gram] if gram in last else 0
            if back != distance:
                distance, copy_from = back, end - 3
            last[gram] = end
            if back and copy_from >= back:
                yield copy_from, end, math.log10(2 * back * (end - copy_from))
        for size in range(WORD_LEAST, min(WORD_MOST, end) + 1):
            start = end - size
            word = plain[start:end]
            for guess, twist in ((word, 1), (word[::-1], 2)):
                if guess in RANK:
                    twists = twist * (2 if low[start:end] != word else 1) * (2 if value[start:end] != low[start:end] else 1)
                    yield start, end, math.log10(RANK[guess] * twists + 1)
        for size in range(4, min(DATE_MOST, end) + 1):
            if DATE.fullmatch(low, end - size, end):
                yield end - size, end, 2.2 if size == 4 else 4.6


def guess_cost(value: str) -> float:
    """log10 of the guesses that the cheapest segmentation of ``value`` into ``pieces`` costs."""
    best = [0.0] + [math.inf] * len(value)
    for start, end, cost in pieces(value):
        if best[start] + cost < best[end]:
            best[end] = best[start] + cost
    return best[-1]


def find_spans(text: str | None) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of every secret, base kinds first at equal starts."""
    if not text:
        return []
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    low = text.lower()
    if any(h in low for h in HINTS):
        base = sorted(found)
        for m in CONTEXT.finditer(text):
            s, e = m.span(1)
            if not any(b[0] < e and s < b[1] for b in base) and guess_cost(m[1]) >= GUESSES:
                found.append((s, e, "guess"))
    return sorted(found, key=lambda f: (f[0], KINDS.index(f[2])))


def _listed(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
            spans = find_spans(text if isinstance(text, str) else None)
            kinds = [k for _, _, k in spans]
            base = _listed(s for s in spans if s[2] != "guess")
            out.append((None if pd.isna(doc_id) else int(doc_id), kinds.count("assign"), kinds.count("access"), kinds.count("hex"),
                        hashlib.sha256(base.encode()).hexdigest(), _listed(spans)))
        yield pd.DataFrame(out, columns=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]).astype({"doc_id": "Int64"})


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` for every row."""
    return docs.select("doc_id", "text").mapInPandas(
        _scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def masked(text: str | None, mask: str = "[REDACTED]") -> str | None:
    """``text`` with every span, overlapping ones merged, replaced by ``mask``."""
    if not text:
        return text
    out, at = [], 0
    merged: list[list[int]] = []
    for s, e, _ in find_spans(text):
        if merged and s < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    for s, e in merged:
        out += [text[at:s], mask]
        at = e
    return "".join([*out, text[at:]]) if merged else text


def redact(docs: DataFrame, mask: str = "[REDACTED]") -> DataFrame:
    """``docs`` with its secrets masked in ``text`` and ``n_chars`` brought in line."""

    @F.pandas_udf("string")
    def hide(text: pd.Series) -> pd.Series:
        return pd.Series([masked(t, mask) if isinstance(t, str) else None for t in text], dtype=object)

    out = docs.withColumn("text", hide("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return out.select(*docs.columns)
