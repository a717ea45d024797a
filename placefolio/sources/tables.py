"""Table sinks. Parquet tables in the session catalog have neither REPLACE nor MERGE.

A stored table is a view over the folders that hold its present rows. Rows are always written to folders of their own
first, and one statement then points the view at them, so readers see the old rows or the new ones, also after a failure
between the two. A keyed table has a folder per key bucket; rows of some keys are replaced by rewriting their buckets only.
One writer at a time is taken for granted.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from placefolio.session import staged
from placefolio.sources.folders import delete, subfolders

# Versions of a table that stay on disk, the present one included.
KEEP_VERSIONS = 2
# Key buckets of a table. They are the unit that an upsert rewrites, so a bucket should hold a few GB.
BUCKETS = 16
# Folders that additions to a table may leave before they become one.
MAX_PARTS = 64
_BUCKET = "_bucket"
# Holds the schema in one file without rows, so that a table may be empty.
_NO_ROWS = f"{_BUCKET}=none"
_PROPERTY = "placefolio.versions"

Counts = tuple[Observation, list[Column]]


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def table_state(spark: SparkSession, name: str) -> dict | None:
    """``root``, ``key``, ``buckets`` and ``versions`` (lists of folders, the present one last) of a stored table."""
    if not spark.catalog.tableExists(name) or not is_view(spark, name):
        return None
    row = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == _PROPERTY).first()
    return json.loads(row["value"]) if row else None


def is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.getTable(name).tableType == "VIEW"


def _point(spark: SparkSession, name: str, state: dict, columns: list[str]) -> DataFrame:
    """The one step that makes the last of the versions the table."""
    if spark.catalog.tableExists(name) and not is_view(spark, name):
        spark.sql(f"DROP TABLE {name}")
    listed = ", ".join(f"`{c}`" for c in columns)
    value = json.dumps(state).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{_PROPERTY}' = '{value}') AS "
              f"SELECT {listed} FROM parquet.`{state['root']}/{{{','.join(state['versions'][-1])}}}`")
    return spark.table(name)


def _write(df: DataFrame, root: str, key: str | None, buckets: int, counts: Counts | None = None) -> list[str]:
    """Write a version below ``root`` and name its folders. ``counts`` are taken from the rows as they are written."""
    # Behind the last shuffle, so each row counts once, also if a lost executor has others computed again.
    seen = lambda rows: rows.observe(counts[0], *counts[1]) if counts else rows
    spark = df.sparkSession
    number = 1 + max((int(f.split("-")[1]) for f in subfolders(spark, root) if f.startswith("v-")), default=0)
    version = f"v-{number:08d}-{uuid.uuid4().hex[:8]}"
    if not key:
        seen(df).write.parquet(f"{root}/{version}")
        return [version]
    # Spark evens out the files: large buckets get several, small ones share a task.
    (seen(df.withColumn(_BUCKET, bucket_of(key, buckets)).hint("rebalance", _BUCKET))
     .write.partitionBy(_BUCKET).parquet(f"{root}/{version}"))
    spark.createDataFrame([], df.schema).coalesce(1).write.parquet(f"{root}/{version}/{_NO_ROWS}")
    return [f"{version}/{folder}" for folder in subfolders(spark, f"{root}/{version}") if folder.startswith(_BUCKET)]


def _retire(spark: SparkSession, state: dict) -> None:
    """Delete folders that no kept version names."""
    named = {folder for version in state["versions"] for folder in version}
    for version in subfolders(spark, state["root"]):
        if not version.startswith("v-") or version in named:
            continue
        parts = [f"{version}/{p}" for p in subfolders(spark, f"{state['root']}/{version}")]
        gone = [p for p in parts if p not in named]
        for folder in [version] if len(gone) == len(parts) else gone:
            delete(spark, f"{state['root']}/{folder}")


def _commit(spark: SparkSession, name: str, state: dict, folders: list[str], columns: list[str], keep: int) -> DataFrame:
    state = state | {"versions": [*state["versions"], folders][-max(keep, 1):]}
    table = _point(spark, name, state, columns)
    _retire(spark, state)
    return table


def write_table(df: DataFrame, name: str, path: str | None = None, key: str | None = None, buckets: int = BUCKETS,
                keep: int = KEEP_VERSIONS, counts: Counts | None = None) -> DataFrame:
    """Full refresh of a table, schema included. Returns the table as read back.

    ``counts``, an observation and its aggregates, are taken while the rows are written. The folders lie below ``path``, else below the schema's own folder. ``df`` may read the table it replaces. With ``key``
    the rows are stored in key buckets, for :func:`replace_keys`. The last ``keep`` versions stay for readers that have
    begun; older ones and what failed writes have left are deleted.
    """
    spark = df.sparkSession
    old = table_state(spark, name)
    if path is None:
        schema, _, table = name.rpartition(".")
        path = f"{spark.catalog.getDatabase(schema or spark.catalog.currentDatabase()).locationUri}/{table}"
    state = {"root": path, "key": key, "buckets": buckets,
             "versions": old["versions"] if old and old["root"] == path else []}
    return _commit(spark, name, state, _write(df, path, key, buckets, counts), df.columns, keep)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int = BUCKETS, path: str | None = None) -> DataFrame:
    """Write a table in Spark's own buckets of ``key``, each sorted by it, and read it back.

    Tables with the same number of buckets are joined and grouped by ``key`` without a shuffle. They are for consumers that
    do so again and again; such a table is replaced as a whole.
    """
    spark = df.sparkSession
    drop_table(spark, name)
    # One task per bucket, so one file per bucket.
    writer = (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key).mode("overwrite"))
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return spark.table(name)


def replace_keys(new: DataFrame, name: str, scope: DataFrame, keep: int = KEEP_VERSIONS) -> DataFrame:
    """Make ``new`` all the rows that a keyed table has for the keys of ``scope``; rows of other keys stay.

    A key of ``scope`` without new rows loses the rows it had; keys of ``new`` count as in scope. Only buckets with such
    keys are read and written, all others keep their files. Rows without a key are never replaced.
    """
    spark = new.sparkSession
    state = table_state(spark, name)
    if not state or not state["key"]:
        raise ValueError(f"{name} is not a table with key buckets")
    key, buckets, present = state["key"], state["buckets"], state["versions"][-1]
    columns = spark.table(name).columns
    if set(columns) != set(new.columns):
        raise ValueError(f"{name}: new rows have other columns than the table")
    new = staged(new.select(*columns), "new-rows")
    keys = staged(scope.select(key).union(new.select(key)).distinct(), "replaced-keys")
    # At most as many numbers as there are buckets.
    touched = {r[0] for r in keys.select(bucket_of(key, buckets)).distinct().collect()}
    number = lambda folder: folder.rpartition("=")[2]
    stale = [f for f in present if number(f).isdigit() and int(number(f)) in touched]
    rest = [f for f in present if f not in stale]
    old = (spark.read.schema(new.schema).parquet(*[f"{state['root']}/{f}" for f in stale]) if stale else new.limit(0))
    merged = old.join(keys, key, "left_anti").select(*columns).unionByName(new)
    written = _write(merged, state["root"], key, buckets)
    # One folder for the schema is enough.
    return _commit(spark, name, state, rest + [f for f in written if not f.endswith(_NO_ROWS)], columns, keep)


def append_rows(df: DataFrame, name: str, path: str | None = None, keep: int = KEEP_VERSIONS) -> DataFrame:
    """Add rows to a table without key buckets, or begin it. After every ``MAX_PARTS`` additions it is written as one."""
    spark = df.sparkSession
    state = table_state(spark, name)
    if not state or len(state["versions"][-1]) >= MAX_PARTS:
        return write_table(spark.table(name).unionByName(df) if state else df, name, path, keep=keep)
    if state["key"]:
        raise ValueError(f"{name} has key buckets")
    columns = spark.table(name).columns
    return _commit(spark, name, state, state["versions"][-1] + _write(df.select(*columns), state["root"], None, 0), columns, keep)


def drop_table(spark: SparkSession, name: str, purge: bool = False) -> None:
    """Drop a table if it exists, with ``purge`` also its folders."""
    if not spark.catalog.tableExists(name):
        return
    state = table_state(spark, name)
    spark.sql(f"DROP {'VIEW' if is_view(spark, name) else 'TABLE'} {name}")
    for version in subfolders(spark, state["root"]) if state and purge else ():
        if version.startswith("v-"):
            delete(spark, f"{state['root']}/{version}")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``old`` with every row whose key ``new`` holds taken from ``new``."""
    return old.join(new.select(key), key, "left_anti").select(*old.columns).unionByName(new)


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys of more than one row, for tables that have one row per key."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
