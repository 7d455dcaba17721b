"""Merkle dataset manifest: one 16-ary hash tree per source, and one over the sources.

A document is a leaf, the SHA-256 of its length-prefixed fields. The leaves of a
source ascend by ``doc_id``; every run of 16 consecutive nodes hashes to one node
of the next level until one is left, the source's subroot. The subroots, ordered
by source, make the root in the same way. A document's proof are the digests that
turn its leaf into the root; ``verify`` folds a (possibly altered) document with
the stored proof.

How the levels are made: nodes carry their 0-based position ``idx`` and the number
of nodes ``size`` of their level. A window over each run gives fixed-offset ``lead``
and ``lag`` columns, masked by the slot (``idx`` mod 16) and the run's length. The
first-child row hashes them into the parent; every row takes its siblings from them.

Positions need the order of a whole source. Thin rows are range-partitioned by
(source, doc_id, leaf), stored with partition number and position, and the count
of each (partition, source) gives the offsets: no task holds a source, and a
source with a third of all rows spreads over as many partitions as its share.

Results at the edges:

- null fields are the byte ``-``; a null text differs from an empty one;
- null ``doc_id``: before all others of the source, never altered by the tamper rule;
- null source: a source of its own, before the others;
- rows that share (source, doc_id) are ordered by leaf; fully repeated rows are
  leaves of their own, and which of the equal rows is which makes no difference;
- an empty table has no rows (and no root);
- other columns of the table are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payledger.llm.common import stored

FAN = 16
#: Leaf fields, in the order of the digest.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated parts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(text: Column) -> Column:
    return digest(*[field(text if f == "text" else F.col(f)) for f in FIELDS])


def altered(doc_id: Column) -> Column:
    """The tamper rule: 5 divides the CRC-32 of the decimal id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranged(df: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """``df`` stored in the order of ``by`` (nulls first): ``part`` ascends with
    the range, ``at`` within it. The row number breaks ties, so that many equal
    rows still spread."""
    order = [*[F.col(c).asc_nulls_first() for c in by], F.col("row")]
    out = df.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).drop("row")
    return stored(out.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), name)


def numbered_sources(leaves: DataFrame) -> DataFrame:
    """Per (part, source) of ranged leaves: ``first`` (its smallest ``at``),
    ``before`` (leaves of the source in earlier partitions), ``size`` (of the
    source), ``tree`` (0-based rank of the source) and ``trees`` (sources).

    The table has one row a partition and one a source at most."""
    cut = leaves.groupBy("part", "source").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    of_source = Window.partitionBy("source")
    cut = stored(cut.withColumns({
        "before": F.coalesce(F.sum("n").over(of_source.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "size": F.sum("n").over(of_source)}), "merkle-cuts")
    names = ranged(cut.select("source").distinct(), ["source"], "merkle-sources")
    per = names.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("low"))
    # one row a partition of the shuffle
    per = per.withColumns({"skip": F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
                           "trees": F.sum("n").over(Window.partitionBy(F.lit(0)))})
    ranks = names.join(per, "part").select(F.col("source").alias("of"), (F.col("at") - F.col("low") + F.col("skip")).alias("tree"), "trees")
    return cut.join(ranks, cut["source"].eqNullSafe(ranks["of"])).drop("of")


#: Position of a node's parent, and the number of parents of a level.
RUN = f"idx div {FAN}"
RUNS = f"(size + {FAN - 1}) div {FAN}"


def _run() -> tuple[Window, Column, Column]:
    """The window of a run of siblings (column ``run``), the slot of a row in it, and its length."""
    length = F.least(F.lit(FAN), F.col("size") - F.col("run") * FAN)
    return Window.partitionBy("tree", "run").orderBy("idx"), F.col("idx") % FAN, length


def parents(nodes: DataFrame) -> DataFrame:
    """The next level of every tree that has more than one node left."""
    run, slot, length = _run()
    more = nodes.where("size > 1").withColumn("run", F.expr(RUN))
    ahead = {f"next{k}": F.lead("digest", k).over(run) for k in range(1, FAN)}
    children = [F.coalesce(F.when(length > k, F.col(f"next{k}")), F.lit("")) for k in range(1, FAN)]
    return more.withColumns(ahead).where(slot == 0).select(
        "tree", F.col("run").alias("idx"), F.expr(RUNS).alias("size"),
        digest(F.col("digest"), *children).alias("digest"))


def with_siblings(nodes: DataFrame) -> DataFrame:
    """Add ``step``: the joined digests left and right of the row in its run."""
    run, slot, length = _run()
    around = {}
    for k in range(1, FAN):
        around[f"prev{k}"] = F.lag("digest", k).over(run)
        around[f"next{k}"] = F.lead("digest", k).over(run)
    none = F.lit("")
    left = F.concat(*[F.coalesce(F.when(slot >= k, F.col(f"prev{k}")), none) for k in range(FAN - 1, 0, -1)])
    right = F.concat(*[F.coalesce(F.when(slot + k < length, F.col(f"next{k}")), none) for k in range(1, FAN)])
    return nodes.withColumns(around).withColumn("step", F.struct(left.alias("left"), right.alias("right"))).drop(*around)


def levels(nodes: DataFrame, name: str) -> list[DataFrame]:
    """All levels from the leaves up; the last has one node a tree at most.
    The sizes of the leaf level fix how many there are."""
    size = nodes.agg(F.max("size")).first()[0] or 0
    out = [nodes]
    while size > 1:
        out.append(stored(parents(out[-1]), name))
        size = -(-size // FAN)
    return out


def with_path(nodes: DataFrame, above: DataFrame | None, tops: DataFrame) -> DataFrame:
    """Add ``path`` (the steps from the node to the end of the proof) and the
    columns of ``tops``: a node that is alone in its tree has the path of
    ``tops``; any other one its own step and the path of its parent in ``above``."""
    carried = [c for c in tops.columns if c not in ("tree", "path")]
    lone = nodes.where("size = 1").join(tops, "tree")
    if above is None:
        return lone
    up = above.select("tree", F.col("idx").alias("run"), F.col("path").alias("rest"), *carried)
    kept = with_siblings(nodes.where("size > 1").withColumn("run", F.expr(RUN)).join(up, ["tree", "run"]))
    kept = kept.withColumn("path", F.concat(F.array("step"), F.col("rest")))
    return lone.unionByName(kept.select(*lone.columns))


def walked_down(ups: list[DataFrame], tops: DataFrame, name: str) -> DataFrame:
    """Paths of the lowest level, from the top down; levels above it are stored."""
    above = None
    for nodes in reversed(ups[1:]):
        above = stored(with_path(nodes, above, tops), name)
    return with_path(ups[0], above, tops)


def folded(leaf: Column, path: Column) -> Column:
    """The digest that a leaf and a stored path lead to."""
    return F.aggregate(path, leaf, lambda got, step: digest(step["left"], got, step["right"]))


def manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, source, leaf, subroot, root, path, changed`` for every row:
    ``path`` is the proof, an array of (left, right) digests; ``changed`` is the
    leaf of the altered document, null where the rule leaves it alone."""
    leaves = docs.select(
        F.col("doc_id"), F.col("source"), leaf_digest(F.col("text")).alias("leaf"),
        F.when(altered(F.col("doc_id")), leaf_digest(lower_ascii(F.col("text")))).alias("changed"))
    leaves = ranged(stored(leaves, "merkle-leaves"), ["source", "doc_id", "leaf"], "merkle-ranged")
    cuts = numbered_sources(leaves).withColumnsRenamed({"part": "cut_part", "source": "cut_source"})
    placed = leaves.join(cuts, (leaves["part"] == cuts["cut_part"]) & leaves["source"].eqNullSafe(cuts["cut_source"]))
    nodes = stored(placed.select(
        "tree", (F.col("at") - F.col("first") + F.col("before")).alias("idx"), "size", "trees",
        F.col("leaf").alias("digest"), "doc_id", "source", "changed"), "merkle-nodes")
    by_source = levels(nodes.select("tree", "idx", "size", "digest"), "merkle-level")
    subroots = by_source[0].where("size = 1")
    for level in by_source[1:]:
        subroots = subroots.unionByName(level.where("size = 1"))
    # the tree over the sources: its leaves are the subroots
    trees = nodes.select("tree", "trees").distinct()
    forest = stored(subroots.join(trees, "tree").select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.col("trees").alias("size"), "digest"), "merkle-subroots")
    over_sources = levels(forest, "merkle-top")
    root = over_sources[-1].where("size = 1").select(
        "tree", F.array().cast("array<struct<left:string,right:string>>").alias("path"), F.col("digest").alias("root"))
    tops = stored(walked_down(over_sources, root, "merkle-top-path").select(
        F.col("idx").alias("tree"), "path", F.col("digest").alias("subroot"), "root"), "merkle-tops")
    leaf_level = nodes.drop("trees")
    return walked_down([leaf_level, *by_source[1:]], tops, "merkle-path").select(
        "doc_id", "source", F.col("digest").alias("leaf"), "subroot", "root", "path", "changed")


def verify(proofs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``: every
    document (the altered one where the rule alters it) folded with its proof."""
    siblings = F.concat_ws("", F.flatten(F.transform("path", lambda s: F.array(s["left"], s["right"]))))
    out = proofs.withColumn("folded_root", folded(F.coalesce("changed", "leaf"), F.col("path")))
    return out.select("doc_id", "leaf", "subroot", "root", digest(siblings).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))
