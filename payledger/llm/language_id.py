"""Language identification by nearest centroids (operator 5).

Texts become L2-normalised TF-IDF vectors of hashed character 1- to 3-grams.
Document frequencies count all training documents. ``CENTROIDS`` spherical
k-means centroids are fitted per language on a hash sample of about
``SAMPLE_PER_LANGUAGE`` labelled documents (the documented bound of the
classifier's sample): documents are drawn by id and text, so copies of a text are
drawn apart, and a row that repeats both counts once. A text gets the language of the centroid with the highest
cosine. A text is *rejected* when it has no letter, or when that cosine falls
below ``REJECT`` times the lowest that a sampled document of the language has
with its own language.

Defined results: ``lang_pred`` is ``und``, score 0 and rejected for a null text,
a text without a letter, or when nothing can be learned. The score is the cosine,
cut to 0..1. Documents without ``lang`` teach nothing; a null ``doc_id`` is never
held out. Ties go to the language that sorts first. Extra columns are ignored
(``predict``) or kept (``keep_accepted``).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payledger.llm.common import held_out, stored

DIM = 1 << 13
CENTROIDS = 4
SAMPLE_PER_LANGUAGE = 1500
REJECT = 0.5
_K = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def counts_of(text: str | None) -> np.ndarray | None:
    """Hashed n-gram counts of the letters and gaps of a text; None without a letter."""
    if not text:
        return None
    low = text.lower()
    codes = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    # ASCII letters and everything from U+00C0 on that is alphabetic stand, the rest is a gap
    letter = (codes - np.uint32(97)) < 26
    wide = np.flatnonzero(codes >= 0xAA)
    if len(wide):
        kinds, inverse = np.unique(codes[wide], return_inverse=True)
        letter[wide] = np.array([chr(c).isalpha() for c in kinds])[inverse]
    if not letter.any():
        return None
    c = np.where(letter, codes, np.uint32(32))
    c = np.concatenate(([np.uint32(32)], c, [np.uint32(32)]))
    c = c[np.concatenate(([True], (c[1:] != 32) | (c[:-1] != 32)))]  # gaps are one character wide
    one = c * _K[0]
    two = one[:-1] * _K[1] + c[1:] * _K[2]
    three = two[:-1] * _K[1] + c[2:] * _K[0]
    shift = np.uint32(32 - 13)
    grams = np.concatenate([(x ^ (x >> np.uint32(15))) * _K[2] >> shift for x in (one, two, three)])
    return np.bincount(grams, minlength=DIM)


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts).astype(np.float32) * idf
    return v / max(float(np.linalg.norm(v)), 1e-12)


def _frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    df, n = np.zeros(DIM, dtype=np.int64), 0
    for pdf in batches:
        for text in pdf["text"]:
            c = counts_of(text if isinstance(text, str) else None)
            if c is not None:
                df += c > 0
                n += 1
    yield pd.DataFrame({"slot": np.arange(DIM + 1), "n": np.append(df, n)})


def _vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for lang, text in zip(pdf["lang"], pdf["text"]):
            c = counts_of(text if isinstance(text, str) else None)
            if c is not None:
                at = np.flatnonzero(c)
                out.append((lang, at.astype(np.int32).tobytes(), c[at].astype(np.int32).tobytes()))
        yield pd.DataFrame(out, columns=["lang", "slots", "counts"])


def _k_means(x: np.ndarray, k: int, turns: int = 8) -> np.ndarray:
    """Spherical k-means, started from the mean and the farthest points from it."""
    mean = x.mean(axis=0)
    centres = [mean / max(float(np.linalg.norm(mean)), 1e-12)]
    while len(centres) < min(k, len(x)):
        centres.append(x[int(np.argmin(np.max(x @ np.array(centres).T, axis=1)))])
    c = np.array(centres)
    for _ in range(turns):
        near = np.argmax(x @ c.T, axis=1)
        for j in range(len(c)):
            if (near == j).any():
                m = x[near == j].mean(axis=0)
                c[j] = m / max(float(np.linalg.norm(m)), 1e-12)
    return c


def drawn(train: DataFrame, sample: int) -> DataFrame:
    """About ``sample`` of the distinct ``doc_id, lang, text`` of every language,
    drawn by a hash of id and text."""
    sizes = stored(train.groupBy("lang").agg(F.count("*").alias("rows")), "languages")
    u = F.pmod(F.xxhash64(F.lit("sample"), "doc_id", "text"), F.lit(1 << 52)) / float(1 << 52)
    return train.join(sizes, "lang").where(u * F.col("rows") < sample).select("doc_id", "lang", "text").distinct()


def fit(train: DataFrame, sample: int = SAMPLE_PER_LANGUAGE, centroids: int = CENTROIDS) -> dict:
    """Model over ``train(doc_id, text, lang)``: ``langs``, ``owner`` (language of each
    centroid), ``centres``, ``idf``, ``floor`` (rejection cosine per language)."""
    freq = train.select("text").mapInPandas(_frequencies, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    df = np.zeros(DIM + 1, dtype=np.int64)
    for r in freq.collect():  # DIM + 1 rows
        df[r["slot"]] = r["n"]
    idf = (np.log((1.0 + df[DIM]) / (1.0 + df[:DIM])) + 1.0).astype(np.float32)
    rows = drawn(train, sample).select("lang", "text").mapInPandas(_vectors, "lang string, slots binary, counts binary").collect()  # `sample` a language
    owner, centres, langs, floor = [], [], sorted({r["lang"] for r in rows}), []
    for i, lang in enumerate(langs):
        mine = sorted([r for r in rows if r["lang"] == lang], key=lambda r: (len(r["slots"]), bytes(r["slots"]), bytes(r["counts"])))
        x = np.zeros((len(mine), DIM), dtype=np.float32)
        for j, r in enumerate(mine):
            slots = np.frombuffer(r["slots"], dtype=np.int32)
            x[j, slots] = np.log1p(np.frombuffer(r["counts"], dtype=np.int32)) * idf[slots]
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        c = _k_means(x, centroids)
        floor.append(REJECT * float(np.max(x @ c.T, axis=1).min()))
        owner += [i] * len(c)
        centres.append(c)
    return {"langs": langs, "owner": np.array(owner, dtype=int), "idf": idf, "floor": floor,
            "centres": np.concatenate(centres).astype(np.float32) if centres else np.zeros((0, DIM), np.float32)}


def _predict(model_bytes):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = pickle.loads(model_bytes.value)
        for pdf in batches:
            out = []
            for doc_id, th, held, text in zip(pdf["doc_id"], pdf["th"], pdf["held_out"], pdf["text"]):
                c = counts_of(text if isinstance(text, str) else None) if m["langs"] else None
                lang, score, reject = "und", 0.0, True
                if c is not None:
                    cos = m["centres"] @ _weighted(c, m["idf"])
                    best = int(np.argmax(cos))
                    i = int(m["owner"][best])
                    lang, score = m["langs"][i], float(min(1.0, max(0.0, cos[best])))
                    reject = score < m["floor"][i]
                out.append((None if pd.isna(doc_id) else int(doc_id), th, held, lang, score, reject))
            yield pd.DataFrame(out, columns=["doc_id", "th", "held_out", "lang_pred", "score", "rejected"]).astype({"doc_id": "Int64"})

    return run


def predict(docs: DataFrame) -> DataFrame:
    """``doc_id, th, held_out, lang_pred, score, rejected`` for every row; learns
    from the rows with ``lang`` that are not held out."""
    held = held_out(3, 1)
    train = docs.where(~held & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(fit(train)))  # DIM x CENTROIDS floats per language
    return docs.select("doc_id", F.xxhash64("text").alias("th"), held.alias("held_out"), "text").mapInPandas(
        _predict(shared), "doc_id long, th long, held_out boolean, lang_pred string, score double, rejected boolean")


def keep_accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected."""
    out = stored(predict(docs).where("rejected").select("doc_id", "th").distinct(), "rejected")
    keyed = docs.withColumn("__th", F.xxhash64("text"))
    cond = keyed["doc_id"].eqNullSafe(out["doc_id"]) & (keyed["__th"] == out["th"])
    return keyed.join(out, cond, "left_anti").drop("__th")
