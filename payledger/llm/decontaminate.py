"""Benchmark decontamination (operator 2, DataFrame functions only).

Words are the runs of 0-9, a-z and non-ASCII characters after lower-casing A-Z.
A window is ``WINDOW`` consecutive words of a benchmark item; an item of fewer
words, but not none, is one window of its own length. The distinct windows form
a hash set which is broadcast while its measured bytes allow it. Beyond that the
hashes of document windows are shuffled to it, without words; hits go back to
their document, which gives the words of these windows only. Document windows of
the same lengths are hashed and probed; a hit is verified on the words themselves. Words inside verified hits count
once, however many windows cover them.

Defined results: a null or empty text has no words and no hits; an item without
words has no window. Rows are told apart by (``doc_id``, text), so a null or
repeated ``doc_id`` is no special case. Items with a null ``item_id`` hit words
but are not listed or counted. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payledger.llm.common import same, stored, text_key

WINDOW = 10
#: The hash set is broadcast up to this many bytes of words and items, arrays and keys counted in.
BROADCAST_BYTES = 256 << 20
#: Bytes a window takes beside its words and items, and bytes of each of these beside its characters.
_PER_WINDOW, _PER_VALUE = 96, 16

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column | str) -> Column:
    """The normalised words of a text; an empty array for null."""
    low = F.translate(F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(low, SEPARATORS), "")


def _with_hashes(df: DataFrame, widths: Sequence[int]) -> DataFrame:
    """``df`` with ``h<width>``: the hash of every run of ``width`` words of the column
    ``words``, empty where there are fewer.

    Each word is hashed once. The hash of twice as many words comes from two hashes
    side by side, and a width is put together from such runs, the longest first; its
    hash hence depends on the words of the run alone. Explode the columns as *outer*:
    else the planner adds a filter on their size, which hashes all runs once more."""

    def beside(name: str, other: str, offset: int) -> Column:
        return F.transform(name, lambda h, i: F.xxhash64(h, F.get(F.col(other), i + offset)))

    out, run = df.withColumn("__1", F.transform("words", lambda w: F.xxhash64(w))), 1
    while 2 * run <= max(widths):
        out, run = out.withColumn(f"__{2 * run}", beside(f"__{run}", f"__{run}", run)), 2 * run
    made = [c for c in out.columns if c not in df.columns]
    for width in widths:
        runs = [1 << b for b in reversed(range(width.bit_length())) if width >> b & 1]
        name, length = f"__{runs[0]}", runs[0]
        for more in runs[1:]:
            made.append(f"__{width}_{length + more}")
            out = out.withColumn(made[-1], beside(name, f"__{more}", length))
            name, length = made[-1], length + more
        # the last runs would reach beyond the text
        out = out.withColumn(f"h{width}", F.slice(name, 1, F.greatest(F.size("words") - (width - 1), F.lit(0))))
    return out.drop(*made)


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``width, h, gram, item_id`` of every distinct window of an item."""
    items = benchmark.select("item_id", words("text").alias("words")).where(F.size("words") > 0)
    width = F.least(F.size("words"), F.lit(window))
    starts = F.sequence(F.lit(1), F.size("words") - width + 1)
    grams = items.select("item_id", width.alias("width"), F.explode(F.transform(starts, lambda i: F.slice("words", i, width))).alias("gram"))
    hashed = _with_hashes(grams.withColumn("words", F.col("gram")), range(1, window + 1))
    h = F.coalesce(*[F.when(F.col("width") == w, F.get(f"h{w}", F.lit(0))) for w in range(1, window + 1)])
    return hashed.select("width", h.alias("h"), "gram", "item_id").distinct()


def _set_bytes(probe: DataFrame) -> int:
    """Bytes of the broadcast hash set, as Spark holds its rows."""
    letters = F.aggregate("gram", F.lit(0), lambda n, w: n + F.octet_length(w) + _PER_VALUE)
    items = F.aggregate("items", F.lit(0), lambda n, x: n + F.octet_length(x) + _PER_VALUE)
    return probe.agg(F.sum((letters + items + _PER_WINDOW).cast("long"))).first()[0] or 0


def _shuffled(split: DataFrame, probe: DataFrame, widths: list[int]) -> DataFrame:
    """The hits by shuffle joins. A document's words do not travel with its
    windows: hashes meet the hash set, the positions that it knows are gathered
    per document, and only the words of these windows meet the set again."""
    known = probe.select("width", "h").distinct()

    def placed(width: int) -> Column:
        return F.transform(f"h{width}", lambda h, i: F.struct(F.lit(width).alias("width"), i.alias("pos"), h.alias("h")))

    at = _with_hashes(split, widths).select("doc_id", "th", F.inline_outer(F.concat(*[placed(w) for w in widths])))
    maybe = at.join(known, ["width", "h"]).groupBy("doc_id", "th").agg(F.collect_set(F.struct("pos", "width")).alias("places"))
    maybe = maybe.withColumnsRenamed({"doc_id": "m_id", "th": "m_th"})
    back = split.join(maybe, split["doc_id"].eqNullSafe(maybe["m_id"]) & (split["th"] == maybe["m_th"]))
    grams = F.transform("places", lambda p: F.struct(p["pos"].alias("pos"), F.slice("words", p["pos"] + 1, p["width"]).alias("gram")))
    return back.select("doc_id", "th", F.inline(grams)).join(probe.select("width", "gram", "items"), "gram").select(
        "doc_id", "th", "pos", "width", "items")


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, th, pos, width, item_id``: every verified occurrence of a
    window at word ``pos`` (from 0) of a document."""
    grams = stored(benchmark_windows(benchmark, window), "windows")
    widths = sorted(r["width"] for r in grams.select("width").distinct().collect())  # at most `window` rows
    probe = grams.groupBy("width", "h", "gram").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    split = docs.select("doc_id", text_key().alias("th"), words("text").alias("words"))
    if widths:
        probe = stored(probe, "probe")
        if _set_bytes(probe) > BROADCAST_BYTES:
            return _shuffled(split, probe, widths)
        probe = F.broadcast(probe)
    found = None
    for width in widths:
        hashed = _with_hashes(split.where(F.size("words") >= width), [width])
        at = hashed.select("doc_id", "th", "words", F.posexplode_outer(f"h{width}").alias("pos", "h"))
        # by both bounds: an equality would become a join key, built for every window and not for hits alone
        gram = F.slice("words", F.col("pos") + 1, width)
        verified = (gram <= F.col("gram")) & (gram >= F.col("gram"))
        one = at.join(probe.where(F.col("width") == width), "h").where(verified)
        one = one.select("doc_id", "th", "pos", F.lit(width).alias("width"), "items")
        found = one if found is None else found.union(one)
    if found is None:
        empty = docs.select("doc_id", text_key().alias("th")).where(F.lit(False))
        found = empty.select("*", F.lit(0).alias("pos"), F.lit(0).alias("width"), F.array().cast("array<string>").alias("items"))
    return found


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, th, n_words, n_hit, n_items, items_sha256, contaminated`` for
    every row of ``docs``."""
    found = stored(hits(docs, benchmark, window), "hits")
    hit_words = found.select("doc_id", "th", F.explode(F.sequence("pos", F.col("pos") + F.col("width") - 1)).alias("w"))
    n_hit = hit_words.distinct().groupBy("doc_id", "th").agg(F.count("*").alias("n_hit"))
    items = found.select("doc_id", "th", F.explode("items").alias("item")).distinct().groupBy("doc_id", "th").agg(
        F.array_sort(F.collect_list("item")).alias("items"))
    rows = docs.select("doc_id", text_key().alias("th"), F.size(words("text")).cast("long").alias("n_words"))
    key = ["doc_id", "th"]
    items = items.withColumnsRenamed({"doc_id": "i_id", "th": "i_th"})
    per_doc = n_hit.join(items, n_hit["doc_id"].eqNullSafe(items["i_id"]) & (n_hit["th"] == items["i_th"]), "left").select(
        *key, "n_hit", "items")
    out = rows.join(per_doc, same(rows, per_doc, key), "left").select(
        rows["doc_id"], rows["th"], "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return out.select(*key, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any occurrence of a benchmark window."""
    bad = hits(docs, benchmark, window).select("doc_id", "th").distinct()
    keyed = docs.withColumn("__th", text_key())
    cond = keyed["doc_id"].eqNullSafe(bad["doc_id"]) & (keyed["__th"] == bad["th"])
    return keyed.join(bad, cond, "left_anti").drop("__th")
