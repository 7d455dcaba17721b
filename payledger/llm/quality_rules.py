"""Quality rules and gradient-boosted trees (operator 7).

Base statistics and the base rule come from every whole text. What passes the
base rule is judged by gradient-boosted trees over document statistics, trained
in numpy on at most about ``SAMPLE`` labelled rows (the documented bound of the
classifier's sample): a row is good with ``quality`` 1 and without ``toxic`` 1.
One statistic is the share of words of a lexicon, itself learned from the
sample: words that occur ``LEXICON_RATIO`` times as often in toxic rows. The
score may not rise with the features in ``FALLING`` (monotonic constraints,
kept by bounds on the leaves). Trees are flattened into node arrays, which
score all rows of a batch level by level.

Defined results: a null or empty text has zero statistics and fails the base
rule. Without labels every document that passes the base rule is kept. Labels
without ``doc_id`` or with both labels null teach nothing; a document with
several labels teaches with each. Extra columns are ignored.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payledger.llm.common import WordHash, covered, ngram_hashes, stored

SAMPLE = 8000
LEXICON_RATIO, LEXICON_LEAST, LEXICON_WORDS = 20.0, 10, 500
TREES, DEPTH, RATE, BINS, LEAST_LEAF, RIDGE = 60, 3, 0.2, 32, 20, 1.0
KEEP_AT = 0.5
FEATURES = ("log_words", "mean_word", "symbols", "dup_lines", "repeats", "distinct", "upper", "digits", "stops", "lexicon")
FALLING = ("symbols", "dup_lines", "repeats", "lexicon")

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".!?,;:")] = True
_PLAIN = bytes(c if (48 <= c < 58 or 97 <= c < 123 or c >= 128) else c + 32 if 65 <= c < 91 else 32 for c in range(256))


def plain_words(raw: bytes) -> list[bytes]:
    return raw.translate(_PLAIN).split()


def statistics(text: str | None, words_of: WordHash, lexicon: frozenset) -> tuple:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` and the features."""
    if not text:
        return (0, 0, 0, 0, 0, np.zeros(len(FEATURES)))
    raw = text.encode("utf-8", "surrogatepass")
    seen = np.frombuffer(raw, dtype=np.uint8)
    count = np.bincount(seen, minlength=256)
    words = raw.split()
    n = len(words)
    chars = len(text) - int(count[_SPACE].sum())
    symbols = int(count[_SYMBOL].sum())
    dup = 0
    if b"\n" in raw:
        lines = [x for x in raw.split(b"\n") if x.split()]
        dup = len(lines) - len(set(lines))
    h = words_of.of(words)
    grams = ngram_hashes(h, 8)
    repeat = 0
    if len(grams) > 1:
        order = np.sort(grams)
        twice = order[1:][order[1:] == order[:-1]]
        if len(twice):
            repeat = int(covered(np.isin(grams, twice), 8, n).sum())
    bad = sum(map(lexicon.__contains__, plain_words(raw))) if lexicon else 0
    n1, c1 = max(n, 1), max(chars, 1)
    features = np.array([np.log1p(n), chars / n1, symbols / c1, dup / n1, repeat / n1, len(set(words)) / n1,
                         count[_UPPER].sum() / c1, count[_DIGIT].sum() / c1, count[_STOP].sum() / n1, bad / n1])
    return n, chars, symbols, dup, repeat, features


class Boosted:
    """Gradient-boosted trees for a 0/1 target as flat node arrays."""

    def __init__(self, falling: tuple[int, ...] = ()):
        self.falling = frozenset(falling)
        self.base, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Boosted:
        mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
        self.base = float(np.log(mean / (1 - mean)))
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
        score = np.full(len(y), self.base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            tree = self._grow(binned, cuts, p - y, p * (1 - p), depth)
            self.trees.append(tree)
            score += self._walk(tree, x)
        return self

    def _grow(self, binned, cuts, g, h, depth):
        feature, cut, left, value = [], [], [], []

        def add():
            for a, v in ((feature, -1), (cut, 0.0), (left, -1), (value, 0.0)):
                a.append(v)
            return len(feature) - 1

        todo = [(add(), np.arange(len(g)), depth, -np.inf, np.inf)]
        while todo:
            node, rows, more, lo, hi = todo.pop()
            total_g, total_h = g[rows].sum(), h[rows].sum()
            value[node] = RATE * float(np.clip(-total_g / (total_h + RIDGE), lo, hi))
            best = None
            for j in range(binned.shape[1]) if more and len(rows) >= 2 * LEAST_LEAF else ():
                k = len(cuts[j]) + 1
                b = binned[rows, j]
                gl, hl = np.cumsum(np.bincount(b, g[rows], k))[:-1], np.cumsum(np.bincount(b, h[rows], k))[:-1]
                nl = np.cumsum(np.bincount(b, minlength=k))[:-1]
                vl = np.clip(-gl / (hl + RIDGE), lo, hi)
                vr = np.clip(-(total_g - gl) / (total_h - hl + RIDGE), lo, hi)
                # loss of constant leaves at their (bounded) values
                gain = -(gl * vl + (hl + RIDGE) * vl**2 / 2 + (total_g - gl) * vr + (total_h - hl + RIDGE) * vr**2 / 2)
                ok = (nl >= LEAST_LEAF) & (len(rows) - nl >= LEAST_LEAF)
                if j in self.falling:
                    ok &= vl >= vr
                if ok.any():
                    at = int(np.argmax(np.where(ok, gain, -np.inf)))
                    if best is None or gain[at] > best[0]:
                        best = (gain[at], j, at, vl[at], vr[at])
            if best is None or best[0] <= total_g**2 / (2 * (total_h + RIDGE)) + 1e-9:
                continue
            _, j, at, vl, vr = best
            a, b = add(), add()
            feature[node], cut[node], left[node] = j, float(cuts[j][at]), a
            mid = (vl + vr) / 2
            goes = binned[rows, j] <= at
            bounds = ((mid, hi), (lo, mid)) if j in self.falling else ((lo, hi), (lo, hi))
            todo += [(a, rows[goes], more - 1, *bounds[0]), (b, rows[~goes], more - 1, *bounds[1])]
        return np.array(feature), np.array(cut), np.array(left), np.array(value)

    @staticmethod
    def _walk(tree, x):
        feature, cut, left, value = tree
        at = np.zeros(len(x), dtype=np.int64)
        rows = np.arange(len(x))
        while True:
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                return value[at]
            step = left[at] + (x[rows, np.maximum(f, 0)] > cut[at])
            at = np.where(inner, step, at)

    def predict(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        for tree in self.trees:
            score += self._walk(tree, x)
        return 1 / (1 + np.exp(-score))


def _word_rates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    toxic, clean, n = Counter(), Counter(), [0, 0]
    for pdf in batches:
        for text, bad in zip(pdf["text"], pdf["toxic"]):
            found = set(plain_words(text.encode("utf-8", "surrogatepass"))) if isinstance(text, str) else ()
            (toxic if bad == 1 else clean).update(found)
            n[int(bad == 1)] += 1
    words = [*(set(toxic) | set(clean)), b""]
    toxic[b""], clean[b""] = n[1], n[0]
    yield pd.DataFrame({"word": words, "toxic": [toxic[w] for w in words], "clean": [clean[w] for w in words]})


def _feature_rows(lexicon: frozenset):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words_of = WordHash()
        for pdf in batches:
            x = [statistics(t if isinstance(t, str) else None, words_of, lexicon)[5] for t in pdf["text"]]
            yield pd.DataFrame({"good": pdf["good"], "x": x})

    return run


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[Boosted | None, frozenset]:
    """Trees and lexicon, from a hash sample of about ``sample`` labelled rows."""
    marks = labels.select("doc_id", "quality", "toxic").where("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)")
    n = marks.count()
    share = min(1.0, sample / max(n, 1))
    chosen = marks.where(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    toxic = F.coalesce("toxic", F.lit(0))
    rows = stored(docs.select("doc_id", "text").join(chosen, "doc_id").select(
        "text", toxic.cast("int").alias("toxic"), ((F.coalesce("quality", F.lit(1)) == 1) & (toxic != 1)).cast("int").alias("good")), "labelled")
    rates = rows.mapInPandas(_word_rates, "word binary, toxic long, clean long").groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    rates = stored(rates, "rates")
    totals = rates.where(F.length("word") == 0).first()
    if totals is None or totals["toxic"] + totals["clean"] == 0:
        return None, frozenset()
    ratio = (F.col("toxic") / float(max(totals["toxic"], 1))) / ((F.col("clean") + 1) / float(max(totals["clean"], 1)))
    top = rates.where((F.length("word") > 0) & (F.col("toxic") >= LEXICON_LEAST) & (ratio >= LEXICON_RATIO)).orderBy(ratio.desc(), "word")
    lexicon = frozenset(bytes(r["word"]) for r in top.limit(LEXICON_WORDS).collect())
    got = rows.mapInPandas(_feature_rows(lexicon), "good int, x array<double>").collect()
    x, y = np.array([r["x"] for r in got]), np.array([r["good"] for r in got], dtype=float)
    order = np.lexsort((y, *x.T))  # the same model whatever the order of the rows
    if len(set(y)) < 2:
        return None, lexicon
    return Boosted(tuple(FEATURES.index(f) for f in FALLING)).fit(x[order], y[order]), lexicon


def _judge(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, lexicon = pickle.loads(shared.value)
        words_of = WordHash()
        for pdf in batches:
            rows = [statistics(t if isinstance(t, str) else None, words_of, lexicon) for t in pdf["text"]]
            score = model.predict(np.array([r[5] for r in rows])) if model and rows else np.ones(len(rows))
            out = pd.DataFrame([r[:5] for r in rows], columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])
            out["base_failed"] = (out["n_words"] < 20) | (100 * out["n_repeat_words"] > 30 * out["n_words"])
            out["kept"] = ~out["base_failed"].to_numpy(bool) & (score >= KEEP_AT)
            out["good_score"] = score
            out.insert(0, "doc_id", pdf["doc_id"].astype("Int64").to_numpy(dtype=object))
            yield out.astype({"doc_id": "Int64"})

    return run


def judge(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, good_score`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(fit(docs, labels, sample)))  # TREES small arrays, LEXICON_WORDS words
    return docs.select("doc_id", "text").mapInPandas(
        _judge(shared), "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, good_score double")
