"""MinHash near-duplicate detection with exact links (operator 6).

1. *Signatures.* Words are the A-Z-lower-cased runs between ASCII white space;
   a document's set holds its distinct 4-word shingles (64-bit hashes). The
   signature keeps the minima of ``BANDS * ROWS`` universal hash functions.
2. *Classes.* Documents with equal sets form one class (a partial aggregate, so
   a third of all rows may be copies of one text); only classes go on.
3. *Banding.* Classes that agree on one band of ``ROWS`` minima share a bucket.
   At a similarity of 0.8 a pair misses every band with probability
   (1 - 0.8**4)**36 = 6e-9.
4. *Verification.* A bucket never emits all its pairs. First its members are
   checked against one pivot: by the signature estimate (rejected 7 standard
   deviations below the threshold), then on the full shingle sets; components
   follow by alternating large-star and small-star. Most buckets then lie in
   one component. The members of the others are compared in blocks of ``BLOCK``,
   a pair of blocks to a task: pairs that the estimate allows are verified on
   their sets, likely ones first, unless links found before connect them
   already, so a task returns fewer links than it has members. No pair of a
   bucket is left unchecked unless its ends are connected.

Defined results: a null, empty or white-space text has an empty set, is linked
with nothing and is its own component. Rows without ``doc_id`` take part; a
component's id is its smallest non-null ``doc_id`` (null if there is none, and
such rows are kept). Repeated rows share the component. Extra columns of the
input are ignored (``near_duplicates``) or passed on (``keep_one``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payledger.llm.common import WordHash, ngram_hashes, same, stored, text_key

BANDS, ROWS = 36, 4
#: Rejecting an estimate this far below the threshold loses a link with p < 1e-10.
ESTIMATE_MARGIN = 0.24
#: Members of an unsettled bucket that one task holds, twice.
BLOCK = 1000


def _universal(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240607)
    a = rng.integers(1, 1 << 63, count, dtype=np.uint64) | np.uint64(1)
    return a, rng.integers(0, 1 << 63, count, dtype=np.uint64)


def shingle_set(text: str | None, words_of: WordHash, width: int) -> np.ndarray:
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    return np.unique(ngram_hashes(words_of.of(words), min(width, len(words))) ^ np.uint64(min(width, len(words))))


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray, block: int = 512) -> np.ndarray:
    """Minimum of every hash function over the set, upper 32 bits."""
    low = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(shingles), block):
        part = np.multiply.outer(a, shingles[i : i + block])
        part += b[:, None]
        np.minimum(low, part.min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _sign(width: int):
    a, b = _universal(BANDS * ROWS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words_of = WordHash()
        for pdf in batches:
            out = []
            for doc_id, th, text in zip(pdf["doc_id"], pdf["th"], pdf["text"]):
                s = shingle_set(text if isinstance(text, str) else None, words_of, width)
                node = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                out.append((None if pd.isna(doc_id) else int(doc_id), th, len(s), node, signature(s, a, b) if len(s) else None))
            yield pd.DataFrame(out, columns=["doc_id", "th", "n_shingles", "node", "sig"]).astype({"doc_id": "Int64"})

    return run


def _sets(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words_of = WordHash()
        for pdf in batches:
            yield pd.DataFrame({
                "node": pdf["node"],
                "shingles": [shingle_set(t if isinstance(t, str) else None, words_of, width).view(np.int64) for t in pdf["text"]],
            })

    return run


def connected_components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """``(node, label)`` of every node of ``edges(u, v)``, the label being the
    smallest node of its component, by alternating large-star and small-star.

    Each half-step is one partial aggregate (the smallest neighbour) and one
    join; the edges are written after each turn. Only a count and a checksum
    come to the driver."""
    cur = stored(edges.where("u != v").select("u", "v").distinct(), name)
    mark = None
    while True:
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        turned = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v")
        low = turned.groupBy("u").agg(F.min("v").alias("m"))
        small = turned.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                             F.col("m").alias("v"))
        cur = stored(small.union(low.select("u", F.col("m").alias("v"))).where("u != v").distinct(), name)
        seen = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    return cur.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        cur.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()


def _labels(members: DataFrame, links: DataFrame) -> DataFrame:
    cc = connected_components(links)
    return stored(members.select("node").join(cc, "node", "left").select("node", F.coalesce("label", "node").alias("label")), "label")


def _blocks(threshold: int, least: int):
    """Links between the members of one or two blocks that connect what was not."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["block", "node"], kind="stable").reset_index(drop=True)
        sig = np.array(pdf["sig"].tolist(), dtype=np.int32)
        n, block, node = pdf["n"].to_numpy(), pdf["block"].to_numpy(), pdf["node"].tolist()
        _, root = np.unique(pdf["label"].to_numpy(), return_inverse=True)
        root = root.copy()  # component of each row
        across = pdf["i"].iloc[0] != pdf["j"].iloc[0]
        likely = []
        for x in range(len(pdf) - 1):
            alike = (sig[x + 1 :] == sig[x]).sum(axis=1)
            ok = (alike >= least) & (root[x + 1 :] != root[x])
            ok &= 100 * np.minimum(n[x + 1 :], n[x]) >= threshold * np.maximum(n[x + 1 :], n[x])
            if across:
                ok &= block[x + 1 :] != block[x]
            at = np.flatnonzero(ok)
            likely.append(np.stack([alike[at], np.full(len(at), x), at + x + 1], axis=1))
        found = []
        if likely:
            likely = np.concatenate(likely)
            for _, x, y in likely[np.argsort(-likely[:, 0], kind="stable")]:
                if root[x] != root[y]:
                    both = len(np.intersect1d(pdf["shingles"].iat[x], pdf["shingles"].iat[y], assume_unique=True))
                    if 100 * both >= threshold * (n[x] + n[y] - both):
                        found.append((node[x], node[y]))
                        root[root == root[y]] = root[x]
        return pd.DataFrame(found, columns=["u", "v"])

    return run


def near_duplicates(docs: DataFrame, width: int = 4, threshold: int = 80) -> DataFrame:
    """``doc_id, th, n_shingles, component_id, kept`` for every row of ``docs``
    (``doc_id``, ``text``); ``threshold`` is in percent."""
    keyed = docs.select("doc_id", "text", text_key().alias("th"))
    rows = stored(keyed.mapInPandas(
        _sign(width), "doc_id long, th long, n_shingles long, node binary, sig array<int>"), "sign")
    classes = rows.where("n_shingles > 0").groupBy("node").agg(
        F.min(F.struct("doc_id", "th")).alias("rep"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"),
        F.min("doc_id").alias("first_id"))
    classes = stored(classes, "classes")

    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.slice("sig", i * ROWS + 1, ROWS)))
    banded = classes.select("node", F.explode(keys).alias("key"))
    shared = banded.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo != hi").select("key")
    buckets = stored(banded.join(shared, "key"), "buckets")

    members = stored(classes.join(buckets.select("node").distinct(), "node", "left_semi"), "members")
    reps = members.select("node", F.col("rep.doc_id").alias("doc_id"), F.col("rep.th").alias("th"))
    texts = keyed.join(reps, same(keyed, reps, ["doc_id", "th"])).select(reps["node"], keyed["text"])
    sets = texts.mapInPandas(_sets(width), "node binary, shingles array<bigint>").dropDuplicates(["node"])
    full = stored(sets.join(members.select("node", "n", "sig"), "node"), "sets")

    least = int((threshold / 100 - ESTIMATE_MARGIN) * BANDS * ROWS)
    # the pivot is the member that meets most others: the original among its variants
    sizes = buckets.groupBy("key").agg(F.count("*").alias("size"))
    meets = buckets.join(sizes, "key").groupBy("node").agg(F.sum("size").alias("meets"))
    pivots = stored(buckets.join(meets, "node").groupBy("key").agg(F.max_by("node", F.struct("meets", "node")).alias("pivot")), "pivots")
    pairs = buckets.join(pivots, "key").where("node != pivot").select("pivot", "node").distinct()
    left = full.select(F.col("node").alias("pivot"), *[F.col(c).alias("p_" + c) for c in ("n", "sig", "shingles")])
    alike = F.size(F.filter(F.arrays_zip(F.col("sig").alias("x"), F.col("p_sig").alias("y")), lambda s: s["x"] == s["y"]))
    likely = pairs.join(full.select("node", "n", "sig"), "node").join(left.select("pivot", "p_n", "p_sig"), "pivot").where(
        (100 * F.least("n", "p_n") >= threshold * F.greatest("n", "p_n")) & (alike >= least)).select("pivot", "node")
    checked = likely.join(full.select("node", "n", "shingles"), "node").join(left.drop("p_sig"), "pivot")
    checked = checked.withColumn("both", F.size(F.array_intersect("shingles", "p_shingles"))).where(
        100 * F.col("both") >= threshold * (F.col("n") + F.col("p_n") - F.col("both")))
    links = stored(checked.select(F.col("pivot").alias("u"), F.col("node").alias("v")), "links")
    label = _labels(members, links)

    # buckets whose members, but for the pivot, are not all connected
    rest = buckets.join(pivots, "key").where("node != pivot").join(label, "node").select("key", "node", "label")
    unsettled = rest.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("size")).where("lo != hi")
    unsettled = unsettled.select("key", F.ceil(F.col("size") / BLOCK).alias("blocks"))
    at = rest.join(unsettled, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    cells = at.select("key", "node", "label", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    cells = cells.select("key", "node", "label", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    more = cells.join(full, "node").groupBy("key", "i", "j").applyInPandas(_blocks(threshold, least), "u binary, v binary")
    more = stored(more.distinct(), "links")
    if not more.isEmpty():
        label = _labels(members, links.union(more))

    named = classes.select("node", "first_id").join(label, "node", "left").select(
        "node", "first_id", F.coalesce("label", "node").alias("label"))
    ids = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    names = stored(named.join(ids, "label").select("node", "component_id"), "components")
    out = rows.drop("sig").join(names, "node", "left").withColumn(
        "component_id", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", "th", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, width: int = 4, threshold: int = 80) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` names their component."""
    kept = near_duplicates(docs, width, threshold).where("kept").select("doc_id", "th").distinct()
    keyed = docs.withColumn("__th", text_key())
    cond = keyed["doc_id"].eqNullSafe(kept["doc_id"]) & (keyed["__th"] == kept["th"])
    return keyed.join(kept, cond, "left_semi").drop("__th")
