"""Versioned tables in a shared folder: data folders and commit markers.

    root/_commits/00000000000000000007.json   what version 7 consists of
    root/version=7/...                        files written by version 7
    root/version=4/conv_year=1999/...         a partition that version 7 still uses

A version is published by its marker alone, which is created without overwriting:
of several writers of one version exactly one succeeds, the others start again from
the version that won (or raise ``ConflictError``). Files are written aside first and
named in the marker; whoever reads or writes next finishes the move to ``version=N``,
so a writer lost in between does no harm and readers never meet a half table.

With a partition column a version names one folder per value, and only partitions
whose rows changed are written. Older versions stay readable until ``retain``. The
partition values of a table (years, say) are listed on the driver; rows never are.

The marker is created by a rename that fails on an existing file, which HDFS does
atomically; on a local file system (tests) by a hard link. Object stores without
such a rename need one writer at a time.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from payledger.operators.upsert import upsert

WHOLE = ""
#: The folder name Spark gives to a null partition value.
NULL = "__HIVE_DEFAULT_PARTITION__"


class ConflictError(RuntimeError):
    """Another writer published the version first."""


@dataclass(frozen=True)
class Partition:
    """Partition column ``name`` with the SQL rule that gives its value for a row.
    One task writes a partition, sorted by ``order``: for tables whose partitions
    are bounded by what they describe (the days of a year), not by documents."""

    name: str
    rule: str
    order: str | None = None


@dataclass(frozen=True)
class Commit:
    """One version: a folder (under the root) per partition value, or one under
    ``WHOLE``; ``digests`` of the partitions; ``inputs`` it was built from."""

    version: int
    folders: Mapping[str, str]
    schema: str | None = None
    partition: Partition | None = None
    digests: Mapping[str, str] = field(default_factory=dict)
    inputs: Mapping[str, str] = field(default_factory=dict)
    aside: str | None = None

    def state(self) -> str:
        """Names the content: equal for two versions that consist of the same files."""
        return hashlib.sha256(json.dumps([sorted(self.folders.items()), self.schema]).encode()).hexdigest()


def _fs(spark: SparkSession, path: str):
    """The file system of ``path`` and the path in its terms."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder is there; a file system error is no answer and rises."""
    fs, at = _fs(spark, path)
    return fs.exists(at)


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, at = _fs(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []


def _at(root: str, *names: str) -> str:
    return "/".join([root.rstrip("/"), *names])


def _marker(version: int) -> str:
    return f"{version:020d}.json"


def _read_text(spark: SparkSession, path: str) -> str:
    fs, at = _fs(spark, path)
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file with its whole content; False when it is there already."""
    fs, at = _fs(spark, path)
    fs.mkdirs(at.getParent())
    if fs.getUri().getScheme() == "file":
        target = at.toUri().getPath()
        draft = os.path.join(os.path.dirname(target), f"_{uuid.uuid4().hex}")
        with open(draft, "w", encoding="utf-8") as f:
            f.write(text)
        try:
            os.link(draft, target)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
    draft = spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), f"_{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not fs.exists(at) and fs.rename(draft, at):
        return True
    fs.delete(draft, False)
    return False


def versions(spark: SparkSession, root: str) -> list[int]:
    """Published versions: those with a marker, and ``version=N`` folders from
    before markers were written; not those that ``retain`` removed."""
    markers = _names(spark, _at(root, "_commits"))
    marked = {int(n.removesuffix(".json")) for n in markers if n.endswith(".json")}
    gone = {int(n.removesuffix(".removed")) for n in markers if n.endswith(".removed")}
    plain = {n.removeprefix("version=") for n in _names(spark, root) if n.startswith("version=")}
    return sorted((marked | {int(n) for n in plain if n.isdigit()}) - gone)


def load(spark: SparkSession, root: str, version: int) -> Commit:
    """The version's commit, with its files in their place."""
    path = _at(root, "_commits", _marker(version))
    if not exists(spark, path):
        return Commit(version, {WHOLE: f"version={version}"})
    raw = json.loads(_read_text(spark, path))
    raw["partition"] = Partition(**raw["partition"]) if raw["partition"] else None
    found = Commit(**raw)
    if found.aside and exists(spark, _at(root, found.aside)):
        fs, aside = _fs(spark, _at(root, found.aside))
        fs.rename(aside, _fs(spark, _at(root, f"version={version}"))[1])
    return found


def current(spark: SparkSession, root: str) -> Commit | None:
    found = versions(spark, root)
    return load(spark, root, found[-1]) if found else None


def read(spark: SparkSession, root: str, commit: Commit | None = None, only: Collection[str] | None = None) -> DataFrame:
    """The rows of a version (default: the newest), or of some of its partitions."""
    commit = commit or current(spark, root)
    if commit is None:
        raise FileNotFoundError(f"no published version under {root}")
    paths = [_at(root, f) for value, f in sorted(commit.folders.items()) if only is None or value in only]
    if commit.schema is None:
        return spark.read.parquet(*paths)
    schema = StructType.fromJson(json.loads(commit.schema))
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _value(partition: Partition) -> Column:
    """A row's partition value as in the folder names."""
    return F.coalesce(F.expr(partition.rule).cast("string"), F.lit(NULL))


def _digests(df: DataFrame, columns: Sequence[str], partition: Partition) -> dict[str, str]:
    """A digest of the rows of each partition that does not depend on their order.
    One row a partition value comes back to the driver."""
    hashes = [F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in columns]) for seed in (1, 2)]
    per = df.groupBy(_value(partition).alias("value")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(h.cast("decimal(38,0)")).alias(f"h{i}") for i, h in enumerate(hashes)])
    return {r["value"]: f"{r['n']}:{r['h0']}:{r['h1']}" for r in per.collect()}


@dataclass(frozen=True)
class Draft:
    """What a writer proposes: rows to write (the changed partitions), and the
    folders of the base version that stay."""

    rows: DataFrame | None
    kept: Mapping[str, str]
    digests: Mapping[str, str]


def commit(spark: SparkSession, root: str, schema: StructType, make: Callable[[Commit | None], Draft], partition: Partition | None = None,
           inputs: Mapping[str, str] | None = None, keys: Sequence[str] | None = None, retries: int = 3, rebase: bool = True) -> Commit:
    """Publish what ``make`` proposes on top of the newest version. When another
    writer was faster, ``make`` is asked again on top of that version, ``retries``
    times at most; without ``rebase`` a lost race raises at once. Rows with a
    repeated key are refused before anything is published."""
    for _ in range(retries + 1):
        base = current(spark, root)
        version = 0 if base is None else base.version + 1
        draft = make(base)
        folders, aside = dict(draft.kept), None
        if draft.rows is not None:
            aside = f"_writing-{uuid.uuid4().hex}"
            path = _at(root, aside)
            if partition is None:
                draft.rows.write.parquet(path)
                folders[WHOLE] = f"version={version}"
            else:
                order = [partition.name, *([partition.order] if partition.order else [])]
                draft.rows.repartition(partition.name).sortWithinPartitions(*order).write.partitionBy(partition.name).parquet(path)
                for name in _names(spark, path):
                    if name.startswith(f"{partition.name}="):
                        folders[unquote(name.split("=", 1)[1])] = f"version={version}/{name}"
            if keys:
                twice = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path).groupBy(*keys).count().where(
                    "count > 1").limit(1).collect()
                if twice:
                    raise ValueError(f"duplicate key in the new version: {twice[0].asDict()}")
        new = Commit(version, folders, schema.json(), partition, dict(draft.digests), dict(inputs or {}), aside)
        if put_if_absent(spark, _at(root, "_commits", _marker(version)), json.dumps(asdict(new))):
            return load(spark, root, version)
        if aside is not None:
            fs, at = _fs(spark, _at(root, aside))
            fs.delete(at, True)
        if not rebase:
            break
    raise ConflictError(f"version {version} of {root} was published by another writer")


def replace_table(spark: SparkSession, root: str, df: DataFrame, partition: Partition | None = None,
                  inputs: Mapping[str, str] | None = None) -> Commit:
    """Publish ``df`` as the next version. Of a partitioned table only partitions
    whose rows differ from the newest version are written; those that ``df`` has
    no rows for are left out of the new version."""
    if partition is None:
        return commit(spark, root, df.schema, lambda base: Draft(df, {}, {}), inputs=inputs)
    rows = df.withColumn(partition.name, F.expr(partition.rule))
    digests = _digests(rows, df.columns, partition)

    def make(base: Commit | None) -> Draft:
        return _changed(base, df.schema, rows, digests, partition, {})

    return commit(spark, root, df.schema, make, partition, inputs)


def _changed(base: Commit | None, schema: StructType, rows: DataFrame, digests: Mapping[str, str], partition: Partition,
             others: Mapping[str, str]) -> Draft:
    """Write the partitions of ``rows`` whose digest is new; ``others`` are partitions of the base that stay."""
    same = base is not None and base.schema == schema.json() and base.partition == partition
    kept = {v: base.folders[v] for v, d in digests.items() if same and base.digests.get(v) == d and v in base.folders}
    write = [v for v in digests if v not in kept]
    old = {v: base.digests[v] for v in others} if base is not None else {}
    return Draft(rows.where(_value(partition).isin(write)) if write else None, {**others, **kept}, {**old, **digests})


def upsert_table(spark: SparkSession, root: str, source: DataFrame, keys: Sequence[str], partition: Partition | None = None,
                 retries: int = 3, rebase: bool = True) -> Commit:
    """MERGE ``source`` into the table (no delete branch). With a partition column
    that depends on the keys only, just the partitions that hold source rows are
    read, and of those the changed ones written: bytes follow the source."""
    keys = list(keys)

    def make(base: Commit | None) -> Draft:
        if partition is None or (base is not None and base.partition != partition):
            rows = source if base is None else upsert(read(spark, root, base), source, keys, check_unique=True)
            if partition is None:
                return Draft(rows, {}, {})
            rows, others = rows.withColumn(partition.name, F.expr(partition.rule)), {}
        else:
            touched = {r["v"] for r in source.select(_value(partition).alias("v")).distinct().collect()}
            others = {} if base is None else {v: f for v, f in base.folders.items() if v not in touched}
            rows = source if base is None else upsert(read(spark, root, base, touched), source, keys, check_unique=True)
            rows = rows.withColumn(partition.name, F.expr(partition.rule))
        return _changed(base, source.schema, rows, _digests(rows, source.columns, partition), partition, others)

    return commit(spark, root, source.schema, make, partition, keys=keys, retries=retries, rebase=rebase)


def retain(spark: SparkSession, root: str, keep: int) -> list[int]:
    """Remove all but the newest ``keep`` versions, and the folders that none of the
    rest names. Returns the versions removed. Readers of removed versions fail."""
    if keep < 1:
        raise ValueError("at least one version must stay")
    found = versions(spark, root)
    gone, stay = found[:-keep], [load(spark, root, v) for v in found[-keep:]]
    used = {f for c in stay for f in c.folders.values()}
    for version in gone:
        folders = set(load(spark, root, version).folders.values())
        # the removal is on record first: a folder that newer versions still use is no version of its own
        put_if_absent(spark, _at(root, "_commits", f"{version:020d}.removed"), "")
        fs, marker = _fs(spark, _at(root, "_commits", _marker(version)))
        fs.delete(marker, False)
        for folder in folders - used:
            fs.delete(_fs(spark, _at(root, folder))[1], True)
        top = _fs(spark, _at(root, f"version={version}"))[1]
        if fs.exists(top) and not any(f.startswith(f"version={version}/") or f == f"version={version}" for f in used):
            fs.delete(top, True)
    return gone


def catalog_view(spark: SparkSession, database: str, name: str, root: str, found: Commit) -> str:
    """A persistent catalog view ``database.name`` over the files of a version, with
    the column comments of its schema. The view is replaced in one step, so readers
    find the old or the new version. A filter on the column that a partition value
    is made from reaches the folders through the partition rule."""
    full = f"{database}.{name}"
    schema = StructType.fromJson(json.loads(found.schema))
    columns = ", ".join(f"`{f.name}`" for f in schema.fields)
    if found.partition is None:
        body = f"SELECT {columns} FROM parquet.`{_at(root, found.folders[WHOLE])}`"
    else:
        by_version: dict[str, list[str]] = {}
        for value, folder in sorted(found.folders.items()):
            by_version.setdefault(folder.split("/", 1)[0], []).append(value)
        col = f"`{found.partition.name}`"
        parts = [f"SELECT {columns} FROM parquet.`{_at(root, top)}` WHERE coalesce(CAST({col} AS STRING), '{NULL}') IN ("
                 + ", ".join(f"'{v}'" for v in values) + f") AND {col} <=> {found.partition.rule}" for top, values in sorted(by_version.items())]
        nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
        body = " UNION ALL ".join(parts) or f"SELECT {nothing} WHERE false"
    if spark.catalog.tableExists(full) and spark.catalog.getTable(full).tableType != "VIEW":
        spark.sql(f"DROP TABLE {full}")  # a table of an earlier layout; its files stay
    listed = []
    for f in schema.fields:
        comment = f.metadata.get("comment")
        quoted = comment.replace("\\", "\\\\").replace("'", "\\'") if comment else None
        listed.append(f"`{f.name}` COMMENT '{quoted}'" if quoted else f"`{f.name}`")
    spark.sql(f"CREATE OR REPLACE VIEW {full} ({', '.join(listed)}) AS {body}")
    return full
