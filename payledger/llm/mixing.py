"""Mixing sources to target weights (operator 1, DataFrame functions only).

Sources, by code point with null last, weigh 3, 1, 2, repeating, and share
``SHARE`` times all words. A target stops at twice its source's words; what is
cut is shared again by weight until none is above, which is the fixed point
``min(cap, level * weight)``.

1. *Packing.* A source's documents stand in the order of a seeded hash; their
   words form one stream, cut into blocks of ``block`` words (the last may be
   shorter). Stream offsets come from a two-level prefix sum over bounded
   chunks, so a hot source meets no single task.
2. *Drawing.* Output shards of ``shard`` slots draw their sources from the
   multinomial distribution of the targets: each slot's hash picks a cell of a
   ``CELLS``-cell table that holds every source in proportion.
3. *Balancing.* Shards number the draws of a source on. Draws beyond what a
   source's target needs are dealt again, by rank, to the sources that came out
   short, so that the words taken hit the target to the word.
4. *Permutation.* Draw ``i`` of a source is block ``perm(i)`` of its current
   epoch, by an affine permutation of the block indices seeded by source and
   epoch (a short last block comes last). No block is drawn more than twice.
5. *Join.* Slots join the pieces of documents on (source, block).

Defined results: a null or empty text has size 0 and takes nothing; a source
without words has target 0. Rows are told apart by (``doc_id``, text); repeated
rows (equal id and text) are counted as many times as they occur and share the
words taken evenly by their place in the stream. Everything is seeded by
content, so reruns agree. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payledger.llm.common import stored, text_key

# The weights in turn, the share of all words, the cap.
WEIGHTS = (3, 1, 2)
SHARE, CAP = 1.5, 2
BLOCK, SHARD = 256, 1024
CELLS = 1 << 16
CHUNK_ROWS = 10_000
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column | str) -> Column:
    return F.regexp_count(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), F.lit(WORD)).cast("long")


def prefix_sum(df: DataFrame, key: str, chunk: str, order: list, value: str, out: str, name: str) -> DataFrame:
    """``out``: the sum of ``value`` over the rows of ``key`` before this one, by
    (chunk, order). Windows hold one chunk of a key, or a key's chunk totals."""
    df = stored(df, name)
    totals = df.groupBy(key, chunk).agg(F.sum(value).alias("__sum"))
    before = Window.partitionBy(key).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(key, chunk, F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(key, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumn("__in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return local.join(starts, [key, chunk]).withColumn(out, (F.col("__start") + F.col("__in")).cast("long")).drop("__start", "__in")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source, sid, source_size, n_rows, target`` per source of ``sizes(source, size)``."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())  # one row per source
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    per = per.withColumn("sid", F.row_number().over(by_name) - 1)
    per = per.withColumn("weight", F.element_at(weights, (F.col("sid") % len(WEIGHTS) + 1).cast("int")))
    per = per.withColumn("cap", F.col("source_size") * float(CAP))
    by_cap = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), "sid")
    every = Window.partitionBy(F.lit(0))
    per = per.withColumn("capped", F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    per = per.withColumn("rest", F.sum("weight").over(by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    total = F.sum("source_size").over(every) * float(SHARE)
    per = per.withColumn("level", (total - F.col("capped")) / F.col("rest"))
    # the first source, by cap per weight, that the level leaves below its cap sets the level
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "sid", "level"))).over(every)
    per = per.withColumn("level", level["level"])
    target = F.when(F.col("level").isNull() | (F.col("level") * F.col("weight") > F.col("cap")), F.col("cap")).otherwise(F.col("level") * F.col("weight"))
    return per.select("source", "sid", "source_size", "n_rows", "weight", target.alias("target"))


def permuted(i: Column, n: Column, sid: Column, epoch: Column) -> Column:
    """An affine permutation of 0..n-1, seeded by source and epoch. A prime that
    does not divide n is prime to it; below 2**23 products stay exact up to
    n = 2**40 blocks."""
    n = F.when(n > 0, n)
    primes = (8388593, 8388587, 8388581, 8388571, 8388547, 8388539)
    step = F.coalesce(*[F.when(n % p != 0, F.lit(p)) for p in primes], F.lit(1))
    shift = F.pmod(F.xxhash64(F.lit("shift"), sid, epoch), n)
    return F.pmod(i * step.cast("long") + shift, n)


def mix(docs: DataFrame, block: int = BLOCK, shard: int = SHARD) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(sources, pieces, slots)``. ``pieces(doc_id, th, source, sid, size, block,
    from_word, in_block, n)``: the words of a document in a block. ``slots(shard,
    sid, draw, epoch, block, take)``: a slot holds the first ``take`` words of its block."""
    rows = stored(docs.select("doc_id", "source", text_key().alias("th"), size_of("text").alias("size")), "sizes")
    src = stored(source_targets(rows), "sources")
    src = src.withColumns({"full": F.floor(F.col("source_size") / block), "goal": F.round("target").cast("long")})
    src = src.withColumn("blocks", F.ceil(F.col("source_size") / block))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("goal") / F.col("source_size"))).otherwise(0)
    src = src.withColumn("epochs", epochs)
    src = src.withColumn("need", F.col("epochs") * F.col("blocks") + F.ceil((F.col("goal") - F.col("epochs") * F.col("source_size")) / block))
    src = stored(src, "plan")

    # packing: repeated rows are told apart by their place among their equals
    ids = src.select("source", "sid", "n_rows")
    named = rows.join(ids, rows["source"].eqNullSafe(ids["source"])).select(
        "doc_id", "th", "size", "sid", F.xxhash64(F.lit("order"), "doc_id", "th").alias("o"),
        F.ceil(F.col("n_rows") / CHUNK_ROWS).alias("chunks"))
    named = named.where("size > 0").groupBy("doc_id", "th", "size", "sid", "o", "chunks").agg(F.count("*").alias("copies"))
    named = named.withColumns({"chunk": F.pmod(F.col("o"), F.col("chunks")), "words": F.col("size") * F.col("copies")})
    placed = prefix_sum(named, "sid", "chunk", ["o", "doc_id", "th"], "words", "start", "placed")
    last = F.floor((F.col("start") + F.col("words") - 1) / block)
    pieces = placed.select("doc_id", "th", "size", "copies", "sid", "start", "words",
                           F.explode(F.sequence(F.floor(F.col("start") / block), last)).alias("block"))
    lo = F.greatest(F.col("start"), F.col("block") * block)
    hi = F.least(F.col("start") + F.col("words"), (F.col("block") + 1) * block)
    pieces = pieces.select("doc_id", "th", "size", "copies", "sid", "block", (lo - F.col("start")).alias("from_word"),
                           (lo - F.col("block") * block).alias("in_block"), (hi - lo).alias("n"))

    # drawing: one slot per hash, its cell names the source
    by_sid = Window.partitionBy(F.lit(0)).orderBy("sid")
    upto = F.try_divide(F.sum("need").over(by_sid), F.sum("need").over(Window.partitionBy(F.lit(0))))
    cells = src.select("sid", F.round(upto * CELLS).cast("long").alias("hi"))  # null if nothing is needed
    cells = cells.withColumn("lo", F.coalesce(F.lag("hi").over(by_sid), F.lit(0).cast("long")))
    table = cells.where("hi > lo").select("sid", F.explode(F.sequence(F.col("lo"), F.col("hi") - 1)).alias("cell"))  # CELLS rows
    n_slots = src.agg(F.coalesce(F.sum("need"), F.lit(0))).first()[0]
    spark = docs.sparkSession
    drawn = spark.range(int(n_slots)).select(
        F.floor(F.col("id") / shard).alias("shard"), F.pmod(F.xxhash64(F.lit("draw"), "id"), F.lit(CELLS)).alias("cell"))
    counts = drawn.join(F.broadcast(table), "cell").groupBy("shard", "sid").agg(F.count("*").alias("count"))
    counts = counts.withColumn("chunk", F.floor(F.col("shard") / CHUNK_ROWS))
    numbered = stored(prefix_sum(counts, "sid", "chunk", ["shard"], "count", "first", "counts"), "numbered")

    # balancing: the k-th draw too many becomes the k-th draw missing
    got = numbered.groupBy("sid").agg(F.sum("count").alias("got"))
    bal = src.join(got, "sid", "left").withColumn("got", F.coalesce("got", F.lit(0)))
    before = by_sid.rowsBetween(Window.unboundedPreceding, -1)
    bal = bal.withColumns({"over": F.greatest(F.col("got") - F.col("need"), F.lit(0)), "short": F.greatest(F.col("need") - F.col("got"), F.lit(0))})
    bal = bal.withColumns({"over_from": F.coalesce(F.sum("over").over(before), F.lit(0)), "short_from": F.coalesce(F.sum("short").over(before), F.lit(0))})
    bal = stored(bal.select("sid", "need", "got", "short", "over_from", "short_from"), "balance")
    missing = bal.where("short > 0").select(
        F.col("sid").alias("to_sid"), F.posexplode(F.sequence(F.col("short_from"), F.col("short_from") + F.col("short") - 1)).alias("k", "rank"),
        F.col("got").alias("g")).select("to_sid", "rank", (F.col("g") + F.col("k")).alias("to_draw"))
    every = numbered.join(bal.select("sid", "need", "over_from"), "sid").select(
        "shard", "sid", "need", "over_from", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("count") - 1)).alias("draw"))
    within = every.where("draw < need").select("shard", "sid", "draw")
    beyond = every.where("draw >= need").withColumn("rank", F.col("over_from") + F.col("draw") - F.col("need"))
    redealt = beyond.join(missing, "rank").select("shard", F.col("to_sid").alias("sid"), F.col("to_draw").alias("draw"))

    # permutation
    at = within.union(redealt).join(src.select("sid", "source_size", "full", "blocks", "goal"), "sid")
    epoch, place = F.floor(F.col("draw") / F.col("blocks")), F.col("draw") % F.col("blocks")
    at = at.withColumns({"epoch": epoch, "place": place})
    chosen = F.when(F.col("place") < F.col("full"), permuted(F.col("place"), F.col("full"), F.col("sid"), F.col("epoch"))).otherwise(F.col("place"))
    used = F.col("epoch") * F.col("source_size") + F.col("place") * block
    slots = at.select("shard", "sid", "draw", "epoch", chosen.alias("block"),
                      F.least(F.lit(block), F.col("goal") - used, F.col("source_size") - F.col("place") * block).cast("long").alias("take"))
    return src, stored(pieces, "pieces"), stored(slots, "slots")


def mixed_words(docs: DataFrame, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row of ``docs``."""
    src, pieces, slots = mix(docs, block, shard)
    used = pieces.join(slots.select("sid", "block", "take"), ["sid", "block"])
    part = F.greatest(F.least(F.col("n"), F.col("take") - F.col("in_block")), F.lit(0))
    # words of a repeated row: copy c of a text spans words [c * size, (c + 1) * size) of its place
    copy_ = F.sequence(F.floor(F.col("from_word") / F.col("size")), F.floor((F.col("from_word") + F.greatest(F.col("part") - 1, F.lit(0))) / F.col("size")))
    used = used.withColumn("part", part).where("part > 0").select("*", F.explode(copy_).alias("copy"))
    lo = F.greatest(F.col("from_word"), F.col("copy") * F.col("size"))
    hi = F.least(F.col("from_word") + F.col("part"), (F.col("copy") + 1) * F.col("size"))
    taken = used.select("doc_id", "th", "copy", (hi - lo).alias("w")).groupBy("doc_id", "th", "copy").agg(F.sum("w").alias("taken"))

    rows = docs.select("doc_id", "source", text_key().alias("th"), size_of("text").alias("size"))
    # the place among equal rows; equal rows are interchangeable
    equal = rows.groupBy("doc_id", "source", "th", "size").agg(F.count("*").alias("copies"))
    one = equal.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))
    out = one.join(taken.withColumnsRenamed({"doc_id": "t_id", "th": "t_th", "copy": "t_copy"}),
                   one["doc_id"].eqNullSafe(F.col("t_id")) & (one["th"] == F.col("t_th")) & (one["copy"] == F.col("t_copy")), "left")
    per = src.select(F.col("source").alias("s_source"), "source_size", "target")
    out = out.join(per, out["source"].eqNullSafe(per["s_source"]))
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), "source", "th")
