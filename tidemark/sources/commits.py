"""Loads of raw tables that are there as a whole or not at all.

A load writes folders of its own below its tables and the ledger.  Nobody reads them until its
rows are added to ``<raw root>/_commits``: one per folder, with the schema the table has from then on, all in one
file that is moved into place when it is complete.  A run that dies before has loaded nothing: its
folders are never read, and :func:`vacuum` removes them.  There is one writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import _file_system

COMMITS = "_commits"
# ``table`` is NULL in the row that stands for the load's ledger entries; a table without ``folder`` has no rows from then on
COMMIT = "load string, number bigint, table string, folder string, schema string"
LOAD = "load-"
_ROOT = "_raw_root"


def exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = _file_system(spark, path)
    return fs.exists(jpath)


def commits(spark: SparkSession, raw_root: str) -> DataFrame | None:
    """One row per folder of a finished load; None before the first one."""
    path = f"{raw_root.rstrip('/')}/{COMMITS}"
    return spark.read.schema(COMMIT).parquet(path) if exists(spark, path) else None


def table_folders(spark: SparkSession, raw_root: str, table: str) -> tuple[list[str], T.StructType | None]:
    """The folders of a table's finished loads in their order, and its schema; the driver sees one line per load."""
    done = commits(spark, raw_root)
    if done is None:
        return [], None
    rows = done.where(F.col("table") == table).orderBy("number").select("folder", "schema").collect()
    return [r["folder"] for r in rows], T.StructType.fromJson(json.loads(rows[-1]["schema"])) if rows else None


def folder_of(path: str, load: str, part: int = 0) -> str:
    return f"{path.rstrip('/')}/{LOAD}{load}-{part}"


def read_loads(spark: SparkSession, path: str) -> DataFrame | None:
    """A raw table, all its finished loads; None before the first one.

    Columns that later loads brought are NULL in earlier ones.
    """
    raw_root, _, table = path.rstrip("/").rpartition("/")
    folders, schema = table_folders(spark, raw_root, table)
    return spark.read.schema(schema).parquet(*folders) if folders else None


def publish(spark: SparkSession, raw_root: str, load: str, written: Sequence[tuple[str, str | None, T.StructType]]) -> None:
    """Make a load, (table, folder, schema) of each folder, visible; the one step that counts."""
    done = commits(spark, raw_root)
    number = 0 if done is None else done.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    rows = [(load, number + 1, None, None, None),
            *[(load, number + 2 + i, t, folder, s.json()) for i, (t, folder, s) in enumerate(written)]]
    spark.createDataFrame(rows, COMMIT).coalesce(1).write.mode("append").parquet(f"{raw_root.rstrip('/')}/{COMMITS}")


def tie_ledger(spark: SparkSession, ledger_path: str, raw_root: str) -> None:
    """Note once where the commits are that the ledger's loads belong to."""
    path = f"{ledger_path.rstrip('/')}/{_ROOT}"
    if not exists(spark, path):
        spark.createDataFrame([(raw_root,)], "root string").coalesce(1).write.mode("overwrite").parquet(path)


def read_ledger_loads(spark: SparkSession, ledger_path: str, schema: T.StructType) -> DataFrame:
    """The ledger's entries of finished loads."""
    path = f"{ledger_path.rstrip('/')}/{_ROOT}"
    done = commits(spark, spark.read.schema("root string").parquet(path).first()["root"]) if exists(spark, path) else None
    loads = [] if done is None else [r["load"] for r in done.where("table is null").select("load").collect()]
    if not loads:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[folder_of(ledger_path, x) for x in loads])


def vacuum(spark: SparkSession, raw_root: str, ledger_path: str) -> list[str]:
    """Remove the folders of loads that were never finished; returns their names.  No load may be running."""
    done = commits(spark, raw_root)
    rows = [] if done is None else done.select("load", "folder").collect()
    kept = {r["folder"].rpartition("/")[2] for r in rows if r["folder"]}
    entered = {folder_of("", r["load"]).rpartition("/")[2] for r in rows}
    jroot, fs = _file_system(spark, raw_root)
    tables = [s.getPath().getName() for s in fs.listStatus(jroot) if s.isDirectory()] if fs.exists(jroot) else []
    removed = []
    for path, names in [*((f"{raw_root.rstrip('/')}/{t}", kept) for t in tables if not t.startswith("_")), (ledger_path, entered)]:
        jpath, fs = _file_system(spark, path)
        for status in fs.listStatus(jpath) if fs.exists(jpath) else []:
            name = status.getPath().getName()
            if name.startswith(LOAD) and name not in names:
                fs.delete(status.getPath(), True)
                removed.append(name)
    return removed
