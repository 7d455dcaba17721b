"""Removal of passages that an earlier document holds too (operator 3).

A window is ``WINDOW`` consecutive words of one document; a word goes when a
window that covers it also starts in a document with a smaller ``doc_id``.

1. *Seeds.* ``SEED``-word hashes are winnowed: every window selects the smallest
   seed hash inside it, so two equal windows select equal seeds. The selected
   hashes of a document are its anchors (about one word in 13).
2. *Anchor join.* Anchors are aggregated to their first and last document;
   only those of two documents or more go back to their documents.
3. *Extension both ways.* Round each shared anchor the text is extended left
   and right to all windows that select it. The windows are aggregated by
   128 bits of hash to the first document that holds them, which answers the
   extension for all partners of a hot passage at once: no pairs are formed inside
   a group.
4. *Maximal repeats.* Adjoining windows that an earlier document holds merge
   into the maximal repeats of at least ``WINDOW`` words, and their words go.

Documents whose whole word sequence is an earlier document's are settled
first by one aggregate, so thousands of copies cost no extension.

Defined results: a null or empty text has no words and the digest of the empty
string. A row without ``doc_id`` comes after every id and removes nothing from
others. Rows that repeat a ``doc_id`` do not remove from each other. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payledger.llm.common import LAST_ID, WordHash, covered, ngram_hashes, ngram_pairs, stored, text_key, window_min

WINDOW, SEED = 50, 25


def _words(text) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if isinstance(text, str) else []


def _anchors(window: int, seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words_of = WordHash()
        for pdf in batches:
            out = []
            for o, th, text in zip(pdf["ord"], pdf["th"], pdf["text"]):
                words = _words(text)
                joined = b" ".join(words)
                anchors = None
                if len(words) >= window:
                    anchors = np.unique(window_min(ngram_hashes(words_of.of(words), seed), window - seed + 1)).view(np.int64)
                out.append((o, th, len(words), hashlib.sha256(joined).hexdigest(), anchors))
            yield pd.DataFrame(out, columns=["ord", "th", "n_words", "whole", "anchors"])

    return run


def _distinct(w: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of two hash arrays."""
    order = np.lexsort((v, w))
    w, v = w[order], v[order]
    new = np.ones(len(w), dtype=bool)
    new[1:] = (w[1:] != w[:-1]) | (v[1:] != v[:-1])
    return w[new], v[new]


def _extended(window: int, seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words_of = WordHash()
        for pdf in batches:
            out = []
            for o, th, text, anchors in zip(pdf["ord"], pdf["th"], pdf["text"], pdf["anchors"]):
                h = words_of.of(_words(text))
                low = window_min(ngram_hashes(h, seed), window - seed + 1)
                near = np.isin(low, np.asarray(anchors, dtype=np.int64).view(np.uint64))
                w, v = ngram_pairs(h, window)
                w, v = _distinct(w[near], v[near])
                out.append((o, th, w.view(np.int64), v.view(np.int64)))
            yield pd.DataFrame(out, columns=["ord", "th", "w", "v"])

    return run


def _removed(window: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words_of = WordHash()
        for pdf in batches:
            out = []
            for o, th, text, early, check in zip(pdf["ord"], pdf["th"], pdf["text"], pdf["w"], pdf["v"]):
                words = _words(text)
                w, v = (x.view(np.int64) for x in ngram_pairs(words_of.of(words), window))
                hit = np.isin(w, np.asarray(early, dtype=np.int64))
                at, pairs = np.flatnonzero(hit), set(zip(early, check))
                hit[at] = [p in pairs for p in zip(w[at].tolist(), v[at].tolist())]
                gone = covered(hit, window, len(words))
                kept = b" ".join([words[i] for i in np.flatnonzero(~gone)])
                out.append((o, th, int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "surrogatepass")))
            yield pd.DataFrame(out, columns=["ord", "th", "n_removed", "kept_sha256", "kept_text"])

    return run


def repeated_passages(docs: DataFrame, window: int = WINDOW, seed: int = SEED, with_text: bool = False) -> DataFrame:
    """``doc_id, th, n_words, n_removed, kept_sha256`` for every row; with
    ``with_text`` also ``kept_text`` (null where nothing was removed)."""
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("ord"), "text", text_key().alias("th"))
    rows = stored(keyed.mapInPandas(
        _anchors(window, seed), "ord long, th long, n_words long, whole string, anchors array<bigint>"), "anchors")
    first = stored(rows.where(F.col("n_words") >= window).groupBy("whole").agg(F.min("ord").alias("first")), "whole")
    base = rows.join(first, "whole", "left").withColumn("copy", F.coalesce(F.col("ord") > F.col("first"), F.lit(False)))

    seeds = stored(base.where("first = ord").select("ord", "th", F.explode("anchors").alias("a")), "seeds")
    shared = stored(seeds.groupBy("a").agg(F.min("ord").alias("lo"), F.max("ord").alias("hi")).where("lo < hi").select("a"), "shared")
    need = seeds.join(shared, "a").groupBy("ord", "th").agg(F.collect_set("a").alias("anchors"))
    spread = stored(keyed.join(need, ["ord", "th"]).select("ord", "th", "text", "anchors").mapInPandas(
        _extended(window, seed), "ord long, th long, w array<bigint>, v array<bigint>"), "extended")
    wide = spread.select("ord", "th", F.inline(F.arrays_zip("w", "v")))
    early = stored(wide.groupBy("w", "v").agg(F.min("ord").alias("lo"), F.max("ord").alias("hi")).where("lo < hi").select("w", "v", "lo"), "early")
    hits = wide.join(early, ["w", "v"]).where("ord > lo").groupBy("ord", "th").agg(F.collect_set(F.struct("w", "v")).alias("windows"))
    hits = hits.select("ord", "th", F.col("windows.w").alias("w"), F.col("windows.v").alias("v"))
    gone = keyed.join(hits, ["ord", "th"]).select("ord", "th", "text", "w", "v").mapInPandas(
        _removed(window), "ord long, th long, n_removed long, kept_sha256 string, kept_text string")
    if not with_text:
        gone = gone.drop("kept_text")
    gone = stored(gone, "removed").dropDuplicates(["ord", "th"])

    empty = hashlib.sha256(b"").hexdigest()
    out = base.join(gone, ["ord", "th"], "left")
    extra = [F.when(F.col("copy"), F.lit("")).otherwise(F.col("kept_text")).alias("kept_text")] if with_text else []
    return out.select(
        F.when(F.col("ord") != LAST_ID, F.col("ord")).alias("doc_id"), "th", "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("copy"), F.lit(empty)).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"), *extra)
