"""Replicated ERP tables: resolve names to stored tables, and stage them.

The source model reads ``{project}.{dataset}.name`` for each ERP table. Here a
``TableResolver`` maps each name either to a catalog table (``database.name``)
or to a parquet folder under ``root``; nothing else in the library knows where
tables live.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Document tables and the keys their joins use: staged hash-bucketed by them so
# header/line joins read co-partitioned data (no shuffle of either side).
DOCUMENT_KEYS: dict[str, list[str]] = {
    "bkpf": ["mandt", "bukrs", "gjahr", "belnr"],
    "bseg": ["mandt", "bukrs", "gjahr", "belnr"],
    "rbkp": ["mandt", "belnr", "gjahr"],
    # lines and assignments meet in a full outer join on the line key
    "rseg": ["mandt", "belnr", "gjahr", "buzei"],
    "rbco": ["mandt", "belnr", "gjahr", "buzei"],
    # as large as the lines: history per purchase order item
    "ekbe": ["mandt", "ebeln", "ebelp"],
}

# The replicated tables the model reads.
MODEL_TABLES = ("bkpf", "bseg", "rbkp", "rseg", "rbco", "prps", "ekbe", "lfa1", "kna1", "adrc", "t001", "t009", "t009b",
                "tcurx", "tcurr", "tcurf", "tvarvc")
HOLIDAY_TABLE = "febraban_holiday"


@dataclass(frozen=True)
class TableResolver:
    """Where ERP tables live: ``database`` (catalog) or ``root`` (parquet folders)."""

    root: str | None = None
    database: str | None = None
    overrides: Mapping[str, str] = field(default_factory=dict)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        if name in self.overrides:
            return spark.read.parquet(self.overrides[name])
        if self.database is not None:
            return spark.table(f"{self.database}.{name}")
        if self.root is None:
            raise ValueError("TableResolver needs a root folder or a database")
        return spark.read.parquet(f"{self.root.rstrip('/')}/{name}")

    def tables(self, spark: SparkSession, names: Iterable[str]) -> dict[str, DataFrame]:
        return {n: self.read(spark, n) for n in names}


def stage_tables(tables: Mapping[str, DataFrame], root: str, buckets: int | None = None,
                 database: str | None = None) -> TableResolver:
    """Write ERP tables once (parquet under ``root``) and return their resolver.

    With ``buckets`` and a ``database``, document tables are saved as bucketed
    catalog tables on their join keys (same bucket count on both sides of
    each header/line join), so those joins need no exchange.
    """
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        path = f"{root.rstrip('/')}/{name}"
        keys = DOCUMENT_KEYS.get(name)
        if buckets and database and keys:
            (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet")
             .bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(f"{database}.{name}"))
        else:
            df.repartition(spark.sparkContext.defaultParallelism).write.mode("overwrite").parquet(path)
            if database:
                spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
                spark.catalog.createTable(f"{database}.{name}", path=path, source="parquet")
    return TableResolver(root=None if database else root, database=database)


def table_states(spark: SparkSession, resolver: TableResolver, names: Iterable[str]) -> dict[str, str]:
    """Name -> digest of the table's files (path, size, time of change), for
    ``deploy(states=...)``. The files are listed and hashed by Spark; their content
    is not read, and only a digest per table comes back. A catalog table's folder is
    taken from the catalog."""
    out = {}
    for name in names:
        if name in resolver.overrides:
            path = resolver.overrides[name]
        elif resolver.database is not None:
            rows = spark.sql(f"DESCRIBE TABLE EXTENDED {resolver.database}.{name}").where("col_name = 'Location'").collect()
            path = rows[0]["data_type"] if rows else None
        else:
            path = f"{resolver.root.rstrip('/')}/{name}"
        if path is None:
            continue  # a view: its content cannot be named, so what builds on it is always built
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
        h = F.xxhash64("path", "length", "modificationTime")
        r = files.agg(F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).alias("h")).first()
        out[name] = f"{r['n']}:{r['h']}"
    return out
