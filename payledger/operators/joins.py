"""Join helpers: size-checked broadcasts and skew-safe left joins."""

from __future__ import annotations

import contextlib
import math
import threading
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def bounded_broadcast(df: DataFrame, max_bytes: int, limit: int) -> DataFrame:
    """Broadcast ``df`` when its size is bounded by construction.

    ``max_bytes`` is a bound known without running a job (for example the
    number of days of a generated calendar). Above ``limit`` the frame is
    left to the planner (sort-merge join, or an AQE broadcast at run time).
    """
    return F.broadcast(df) if max_bytes <= limit else df


def is_small(df: DataFrame, limit: int) -> bool:
    """True when the planner's statistics bound ``df`` by ``limit`` bytes.

    The bound comes from file or catalog sizes through the optimized plan, so no
    job runs. It is tight for a scan or a materialised dimension and far too wide
    for a join (the product of its sides): dimensions that come from joins are
    materialised first. A frame whose bound is too wide is not broadcast here; the
    planner or AQE may still do so once it has seen the real size.
    """
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes())) <= limit


def broadcast_if_small(df: DataFrame, limit: int) -> DataFrame:
    """Broadcast a dimension only when it is proven to hold at most ``limit``
    bytes; a larger table keeps the shuffle join (which AQE may re-plan)."""
    return F.broadcast(df) if is_small(df, limit) else df


def source_bytes(df: DataFrame) -> int:
    """Bytes of what ``df`` reads (files or tables, each as often as it is read), by the
    planner's statistics: no job runs, and joins do not multiply them."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


@dataclass(frozen=True)
class HotKeys:
    """Join keys that hold at least a given share of the rows: their hashes (see
    ``key_hash``), and over how many pieces each is to be spread."""

    hashes: tuple[int, ...]
    pieces: int


#: Items that the frequency sketch of ``frequent_keys`` tracks; its counts are high by rows * 3.5 / tracked at most.
TRACKED = 8192


def key_hash(columns: Sequence[Column]) -> Column:
    return F.xxhash64(*[c.cast("string") for c in columns])


def frequent_keys(df: DataFrame, keys: Mapping[str, Sequence[Column]], share: float, partitions: int) -> dict[str, HotKeys]:
    """Per named key, the values that hold ``share`` of the rows or more.

    One pass with a frequent-items sketch per key (merged map-side, a few thousand
    entries whatever the input); at most ``1 / share`` hashes come back. A key with a
    NULL part is left out: it has no partner. The sketch never counts too low, so no
    hot key is missed; one taken for hot by its error is split for nothing.
    ``pieces`` gives a hot key as many shuffle partitions as its share is worth."""
    if not 0 < share <= 1:
        raise ValueError("share must be above 0 and at most 1")
    k = math.ceil(1 / share) + 1
    frame = df.select(*[
        F.when(reduce(lambda a, b: a & b, [c.isNotNull() for c in cols]), key_hash(cols)).alias(name) for name, cols in keys.items()])
    found = frame.agg(F.count(F.lit(1)).alias("rows"), *[F.expr(f"approx_top_k(`{n}`, {k}, {max(TRACKED, 8 * k)})").alias(n) for n in keys]).first()
    out = {}
    for name in keys:
        hot = [(i["item"], i["count"]) for i in found[name] or [] if i["item"] is not None and i["count"] >= share * found["rows"]]
        most = max((c for _, c in hot), default=0) / max(found["rows"], 1)
        out[name] = HotKeys(tuple(sorted(h for h, _ in hot)), max(2, math.ceil(most * partitions)))
    return out


def left_join_salted_nulls(
    left: DataFrame,
    right: DataFrame,
    pairs: Sequence[tuple[Column, str]],
    salt_from: Sequence[str],
    hot: HotKeys | None = None,
    within: tuple[Column, str, str] | None = None,
) -> DataFrame:
    """Left join on ``left_expr == right[right_col]`` for every pair.

    A NULL key can never match, but a shuffle join still sends every such
    row to the one partition NULL hashes to. Here a left row with a NULL key
    gets, in place of each string key (and of the first key in any case), a
    marker plus the whole hash of ``salt_from`` (deterministic, so retries
    agree): those rows spread over all shuffle partitions. A left-only residual
    ``NOT null_key`` keeps them from matching anything, so every left row is
    kept and none gains a partner. The salt lives in the keys themselves: a
    separate salt column, or a salt in a key that a filter makes constant (the
    client, say), would be folded away by the optimizer.

    ``hot`` keys are split as well, without AQE: their left rows are dealt by the
    same hash over ``hot.pieces``, their right rows are repeated once a piece, and
    the piece joins along. Every left row meets every right row of its key once.

    ``within`` (left value, two right columns) admits only right rows whose range
    holds the value.
    """
    any_null = reduce(lambda a, b: a | b, [expr.isNull() for expr, _ in pairs])
    salt = F.concat(F.lit("\u0001"), F.xxhash64(*[F.col(c) for c in salt_from]).cast("string"))
    key_names = [f"__k{i}" for i in range(len(pairs))]
    kinds = left.select(*[expr for expr, _ in pairs]).schema.fields
    as_text = [i == 0 or (f.dataType.typeName() == "string" and right.schema[rc].dataType.typeName() == "string")
               for i, (f, (_, rc)) in enumerate(zip(kinds, pairs))]
    keys = {name: F.when(any_null, salt).otherwise(expr.cast("string")) if text else expr
            for name, text, (expr, _) in zip(key_names, as_text, pairs)}
    added = {**keys, "__null_key": any_null}
    columns = right.columns
    if hot is not None and hot.hashes:
        if not all(as_text):
            raise ValueError("hot keys are told by their text: all key columns must be strings")
        mine, theirs = key_hash([e for e, _ in pairs]), key_hash([F.col(rc) for _, rc in pairs])
        piece = F.pmod(F.xxhash64(*[F.col(c) for c in salt_from]), F.lit(hot.pieces)).cast("int")
        added["__piece"] = F.when(mine.isin(*hot.hashes), piece).otherwise(F.lit(0))
        copies = F.when(theirs.isin(*hot.hashes), F.sequence(F.lit(0), F.lit(hot.pieces - 1))).otherwise(F.array(F.lit(0)))
        right = right.withColumn("__piece", F.explode(copies))
    if within is not None:
        added["__at"] = within[0]
    left_keyed = left.withColumns(added)
    cond = ~F.col("l.__null_key")
    for name, text, (_, rc) in zip(key_names, as_text, pairs):
        other = F.col(f"r.{rc}")
        cond = cond & (F.col(f"l.{name}") == (other.cast("string") if text else other))
    if "__piece" in added:
        cond = cond & (F.col("l.__piece") == F.col("r.__piece"))
    if within is not None:
        cond = cond & F.col("l.__at").between(F.col(f"r.{within[1]}"), F.col(f"r.{within[2]}"))
    joined = left_keyed.alias("l").join(right.alias("r"), cond, "left")
    return joined.select(*[F.col(f"l.{c}") for c in left.columns], *[F.col(f"r.{c}") for c in columns])


def left_join_nulls_apart(
    left: DataFrame,
    right: DataFrame,
    pairs: Sequence[tuple[Column, str]],
    salt_from: Sequence[str],
    hot: HotKeys | None = None,
) -> DataFrame:
    """The left join of ``left_join_salted_nulls`` for a left side that is cheap to read
    twice (a stored one): rows with a NULL key have no partner and pass by, so only
    the others are shuffled and sorted, without a salt. Column names must differ."""
    any_null = reduce(lambda a, b: a | b, [expr.isNull() for expr, _ in pairs])
    keyed, rest = left.where(~any_null), left.where(any_null)
    if hot is not None and hot.hashes:
        joined = left_join_salted_nulls(keyed, right, pairs, salt_from, hot)
    else:
        joined = keyed.join(right, reduce(lambda a, b: a & b, [expr == F.col(f"`{rc}`") for expr, rc in pairs]), "left")
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
    return joined.unionByName(rest.select("*", *none))


def lookup_left_join(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[Column, str]],
                     salt_from: Sequence[str], limit: int, within: tuple[Column, str, str] | None = None) -> DataFrame:
    """Left join to a lookup table: broadcast when it is proven small, else a
    shuffle join whose NULL-key rows are salted across partitions. ``within`` as
    in ``left_join_salted_nulls``."""
    small = broadcast_if_small(right, limit)
    if small is not right:
        cond = None
        for expr, rc in pairs:
            c = expr == small[rc]
            cond = c if cond is None else cond & c
        if within is not None:
            cond = cond & within[0].between(small[within[1]], small[within[2]])
        return left.join(small, cond, "left")
    return left_join_salted_nulls(left, right, pairs, salt_from, within=within)


def materialize(df: DataFrame, name: str = "dimension") -> DataFrame:
    """Write a small dimension once to the shared checkpoint folder and read it
    back as a plan leaf: consumers no longer carry (and re-analyse) its whole
    plan, and a lost executor does not recompute it.

    The leaf's statistics are its own bytes, so a size check sees the dimension
    and not the product of the tables it was joined from (which is what the
    statistics of a checkpointed or joined frame say). The files are plain: no
    compression and no dictionaries, which would make a dimension of few distinct
    values look smaller than the rows a broadcast holds. Needs
    ``spark.checkpoint.dir`` (see ``payledger.session.checkpoint_dir``)."""
    from payledger.session import checkpoint_dir

    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "none").option("parquet.enable.dictionary", "false").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_WRITING = threading.RLock()
_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _write(df: DataFrame, path: str) -> DataFrame:
    """Write a large frame and read it back. Its shuffle files go when it is written, not
    when the driver next collects garbage: nothing reads them again, and the jobs that
    follow need the disk. Large frames are written one at a time, for the same reason."""
    conf = df.sparkSession.conf
    with _WRITING:
        before = conf.get(_REMOVE_SHUFFLES, None)
        conf.set(_REMOVE_SHUFFLES, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            conf.unset(_REMOVE_SHUFFLES) if before is None else conf.set(_REMOVE_SHUFFLES, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _new_path(df: DataFrame, name: str) -> str:
    from payledger.session import checkpoint_dir

    return f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_once(df: DataFrame, name: str) -> DataFrame:
    """Write a large frame once to the shared checkpoint folder and read it back, so
    that several branches of a plan read its rows and none computes them again."""
    return _write(df, _new_path(df, name))


@contextlib.contextmanager
def written(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``write_once`` for the length of a block: its files are removed at the end, so
    what is made of the frame has to be written within it."""
    path = _new_path(df, name)
    try:
        yield _write(df, path)
    finally:
        jvm, jsc = df.sparkSession._jvm, df.sparkSession.sparkContext._jsc
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(jsc.hadoopConfiguration()).delete(where, True)


def columns_read(build: Callable[[DataFrame], DataFrame], spark: SparkSession, schema: StructType) -> list[str]:
    """The columns that ``build`` reads of a stored frame of ``schema``, in its order: what
    Spark leaves in the scans of an empty one. Nothing but the empty frame is written."""
    with written(spark.createDataFrame([], schema), "columns") as leaf:
        folder = leaf.inputFiles()[0].split("/")[-2]  # its name alone: paths are written in several ways
        scans, read = build(leaf)._jdf.queryExecution().sparkPlan().collectLeaves(), set()
        for scan in map(scans.apply, range(scans.size())):
            if scan.nodeName().startswith("Scan parquet") and folder in scan.relation().location().rootPaths().mkString(" "):
                read.update(scan.requiredSchema().fieldNames())
    return [c for c in schema.names if c in read]


def widened(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with every column of ``schema``; those that were not stored, as nothing reads
    them (``columns_read``), are NULL."""
    return df.select(*[F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
