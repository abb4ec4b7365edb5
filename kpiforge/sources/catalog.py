"""Catalog tables: databases, versioned full-replace sinks, recovery of tables
written by an earlier process, and tolerant reads."""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kpiforge.session import hadoop_fs
from kpiforge.sources.columns import with_numeric_columns

RAW_DB = "raw"
ANALYTICS_DB = "analytics"


def ensure_databases(spark: SparkSession, *names: str) -> None:
    for n in names or (RAW_DB, ANALYTICS_DB):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{n}`")


def table_path(spark: SparkSession, db: str, table: str) -> str:
    """Folder of ``db.table``: inside the database's location."""
    return f"{spark.catalog.getDatabase(db).locationUri.rstrip('/')}/{table}"


# a version folder without a commit marker may belong to a writer still at
# work; one that began this long ago is taken for dead
ABANDONED_MS = 7 * 24 * 3600 * 1000


def versions_db(db: str) -> str:
    """The database of the version tables that the views of ``db`` point at."""
    return f"{db}__versions"


def replace_table(df: DataFrame, db: str, table: str, keep: int = 2,
                  buckets: tuple[int, str] | None = None, partition_by: str | None = None) -> int:
    """Replace ``db.table``, rows and columns, so that readers see the old or the
    new content whole, and never no table. ``db.table`` is a view on one version
    table: the new rows are written as a version of their own, then one
    ``ALTER VIEW`` turns to it, whatever its columns.

    Versions are ordered by their time, and every writer turns the view to the
    newest complete one until that is where it points: of several writers at
    once the newest wins whole, whoever comes last. The ``keep`` newest versions
    stay, for readers that resolved the view just before; older ones are deleted,
    and unfinished ones that began more than ``ABANDONED_MS`` ago. ``keep=1``
    keeps no previous version (raw tables: no doubled storage).

    ``buckets`` = (number, column) stores the rows hashed and sorted by a column,
    so that joins and folds on it need no exchange; ``partition_by`` gives each
    value of a column its own folder. Returns the number of rows written
    (observed during the write)."""
    spark = df.sparkSession
    base = table_path(spark, db, table)
    now = int(time.time() * 1000)
    version = f"_v{now:015d}_{uuid.uuid4().hex[:8]}"
    obs = Observation(f"rows_{db}_{table}_{uuid.uuid4().hex[:8]}")
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.format("parquet")
    if buckets:
        writer = writer.bucketBy(*buckets).sortBy(buckets[1])
    if partition_by:
        writer = writer.partitionBy(partition_by)
    ensure_databases(spark, versions_db(db))
    try:
        writer.option("path", f"{base}/{version}").saveAsTable(_entry(db, table, version))
    except AnalysisException:
        # another writer found the files complete and registered them first
        if version not in _versions(spark, base)[0]:
            raise
    _turn_to_newest(spark, db, table, df.columns if partition_by else None)
    committed, unfinished = _versions(spark, base)
    dead = [v for v in unfinished if int(v[2:17]) < now - ABANDONED_MS]
    fs = hadoop_fs(spark, base)[1]
    for v in committed[:-keep] + dead:
        spark.sql(f"DROP TABLE IF EXISTS {_entry(db, table, v)}")  # external: the files go next
        fs.delete(hadoop_fs(spark, f"{base}/{v}")[0], True)
    return int(obs.get["rows"])


def _entry(db: str, table: str, version: str) -> str:
    return f"`{versions_db(db)}`.`{table}{version}`"


def _turn_to_newest(spark: SparkSession, db: str, table: str, columns: list[str] | None = None) -> None:
    """Point the view ``db.table`` at the newest complete version."""
    base, name = table_path(spark, db, table), f"`{db}`.`{table}`"
    pointed = None
    while pointed != (newest := _versions(spark, base)[0][-1]):
        entry = _entry(db, table, newest)
        if not spark.catalog.tableExists(entry):  # written by another process
            spark.sql(f"CREATE TABLE IF NOT EXISTS {entry} USING parquet LOCATION '{base}/{newest}'")
            if any(c.isPartition for c in spark.catalog.listColumns(entry)):
                spark.catalog.recoverPartitions(entry)
        shown = ", ".join(f"`{c}`" for c in columns or spark.table(entry).columns)
        query = f"SELECT {shown} FROM {entry}"
        if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
            spark.sql(f"DROP TABLE {name}")  # an entry of the time before versions were tables
        spark.sql(f"CREATE VIEW IF NOT EXISTS {name} AS {query}")
        spark.sql(f"ALTER VIEW {name} AS {query}")
        pointed = newest


def _versions(spark: SparkSession, base: str) -> tuple[list[str], list[str]]:
    """Version folders of a table folder, oldest first: (complete, not complete)."""
    root, fs = hadoop_fs(spark, base)
    if not fs.exists(root):
        return [], []
    committed, other = [], []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("_v"):
            done = fs.exists(hadoop_fs(spark, f"{base}/{name}/_SUCCESS")[0])
            (committed if done else other).append(name)
    return sorted(committed), sorted(other)


def recover_tables(spark: SparkSession, db: str) -> list[str]:
    """Register the tables whose folders exist under ``db``'s location but
    which the catalog does not know (a new process without a persistent
    metastore), each at its newest complete version: a version folder whose
    write committed (``_SUCCESS``), so a half-written version is never used."""
    ensure_databases(spark, db, versions_db(db))
    base = spark.catalog.getDatabase(db).locationUri.rstrip("/")
    root, fs = hadoop_fs(spark, base)
    if not fs.exists(root):
        return []
    known = {t.name for t in spark.catalog.listTables(db)}
    found = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name not in known and not name.startswith(("_", ".")) and _versions(spark, f"{base}/{name}")[0]:
            _turn_to_newest(spark, db, name)
            found.append(name)
    return found


def load_table(spark: SparkSession, name: str, db: str = ANALYTICS_DB,
               cache: bool = False, numeric: bool = False, text: tuple[str, ...] = ()) -> DataFrame:
    """``SELECT * FROM db.name``. The package's KPI columns are stored typed; for
    tables that hold numbers as text ``numeric=True`` reads each text column, but
    for those named in ``text``, as DOUBLE if all of its values are numbers, and
    leaves it whole as it is otherwise. ``cache=True`` keeps the (small) KPI table
    in memory for repeated dashboard reads; call ``refresh`` after a rerun."""
    df = spark.table(f"`{db}`.`{name}`")
    if numeric:
        df = with_numeric_columns(df, keep=text)
    return df.cache() if cache else df


def try_load(spark: SparkSession, name: str, db: str = ANALYTICS_DB) -> DataFrame | None:
    """The table, or None when it does not exist (yet). A table written by an
    earlier process is registered again from its folder first."""
    if not spark.catalog.tableExists(f"{db}.{name}"):
        recover_tables(spark, db)
    if not spark.catalog.tableExists(f"{db}.{name}"):
        return None
    return load_table(spark, name, db)


def refresh(spark: SparkSession, name: str, db: str = ANALYTICS_DB) -> None:
    """Drop cached data of a table after it was rewritten."""
    if spark.catalog.tableExists(f"{db}.{name}"):
        spark.catalog.uncacheTable(f"`{db}`.`{name}`")
        spark.catalog.refreshTable(f"`{db}`.`{name}`")


def raw_tables(spark: SparkSession, db: str = RAW_DB) -> dict[str, DataFrame]:
    """Every table of the raw database, by name (tables written by an earlier
    process are registered again from their folders)."""
    recover_tables(spark, db)
    return {t.name: spark.table(f"`{db}`.`{t.name}`") for t in spark.catalog.listTables(db) if not t.isTemporary}
