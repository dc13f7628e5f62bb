"""K1/K2: replace a stored table, in layers, so that a failed write leaves the old table.

The reference reads a table, cleans it and writes it back under the same
name.  Spark refuses to overwrite a path it is reading from, and a failed
rewrite would lose the input, so data moves through layers instead:
``raw`` -> ``clean`` -> ``mart``; each write replaces one table of one layer.

A table is a folder of versions.  A write fills a folder of its own
(``v-<id>``) and then adds an empty commit record whose name holds the commit's
number and the version (``_commits/<number>.v-<id>``); creating one file is
atomic on HDFS and object stores.  Readers take the highest record, so they see
the old table or the new one, never a mix and never a half.  A write that is
killed leaves a folder that no record names.  ``drop_old_versions`` deletes
what is no longer needed.

Tables are Parquet folders under a shared root (object store / HDFS on a
cluster), optionally partitioned so later filters prune files, or bucketed on
``id`` so the many joins on ``id`` read co-partitioned data.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

LAYERS = ("raw", "clean", "mart")


def layer_path(root: str, layer: str, name: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}; expected one of {LAYERS}")
    return f"{root.rstrip('/')}/{layer}/{name}"


_COMMITS = "_commits"


def _folder(spark: SparkSession, path: str):
    """The file system of a path and the path, through Spark's own readers of storage."""
    jvm = spark._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, folder = _folder(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def committed_versions(spark: SparkSession, root: str, layer: str, name: str) -> list[str]:
    """Version folders of a table in order of their commits; the last one is the table."""
    path = layer_path(root, layer, name)
    return [f"{path}/{record.split('.', 1)[1]}" for record in _names(spark, f"{path}/{_COMMITS}")]


def _commit(spark: SparkSession, path: str, version: str) -> None:
    records = _names(spark, f"{path}/{_COMMITS}")
    number = int(records[-1].split(".", 1)[0]) + 1 if records else 1
    fs, record = _folder(spark, f"{path}/{_COMMITS}/{number:010d}.{version}")
    fs.create(record, False).close()


def write_layer(df: DataFrame, root: str, layer: str, name: str,
                partition_by: list[str] | None = None,
                bucket_by: list[str] | None = None, buckets: int | None = None) -> str:
    """``dbWriteTable(con, name, df, overwrite=TRUE)`` into one layer; returns the folder of the new version.

    The old version stays readable until the new one is committed, and its
    files stay until ``drop_old_versions``, so ``df`` may read the table that
    it replaces.  ``bucket_by``/``buckets`` store the table hash-bucketed (and
    sorted) on those columns, registered in the session catalog as
    ``<layer>.<name>`` with its files at the version's folder.  Tables bucketed
    the same way join and group on the bucket columns without a shuffle.
    """
    spark, path, version = df.sparkSession, layer_path(root, layer, name), f"v-{uuid.uuid4().hex}"
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        if not buckets:
            raise ValueError("bucket_by needs a bucket count")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{root.rstrip('/')}/{layer}'")
        (w.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
         .option("path", f"{path}/{version}").saveAsTable(f"{layer}.{name}"))
    else:
        w.parquet(f"{path}/{version}")
    _commit(spark, path, version)
    return f"{path}/{version}"


def drop_old_versions(spark: SparkSession, root: str, layer: str, name: str, keep: int = 1) -> list[str]:
    """Delete all but the last ``keep`` committed versions, and what writes that never committed left.  For times when
    no one writes the table or reads an older version."""
    if keep < 1:
        raise ValueError("the current version cannot be dropped")
    path = layer_path(root, layer, name)
    kept = {v.rsplit("/", 1)[1] for v in committed_versions(spark, root, layer, name)[-keep:]}
    if not kept:
        return []
    dropped = [v for v in _names(spark, path) if v != _COMMITS and v not in kept]
    records = [r for r in _names(spark, f"{path}/{_COMMITS}") if r.split(".", 1)[1] not in kept]
    for gone in [f"{_COMMITS}/{r}" for r in records] + dropped:  # records first: no reader finds a deleted version
        fs, found = _folder(spark, f"{path}/{gone}")
        fs.delete(found, True)
    return dropped


def _location(spark: SparkSession, table: str) -> str | None:
    row = (spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
           .where("col_name = 'Location'").select("data_type").first())
    return row[0] if row else None


def read_layer(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    """A layer table as last committed: through the catalog when it is
    registered there for this very version (which keeps its bucketing), else
    from its files."""
    versions = committed_versions(spark, root, layer, name)
    if not versions:
        raise FileNotFoundError(f"no committed version of {layer_path(root, layer, name)}")
    path, table = versions[-1], f"{layer}.{name}"
    if spark.catalog.tableExists(table):
        location = (_location(spark, table) or "").rstrip("/")
        # the catalog stores a qualified URI (file:/..., hdfs://...); compare
        # the path part so another root's table of the same name, or a version
        # that was never committed, is ignored
        if location.endswith(path.split(":", 1)[-1]):
            return spark.table(table)
    return spark.read.parquet(path)


def store_code_lists(lists: dict[str, DataFrame], root: str) -> dict[str, str]:
    """``dbWriteTable(con, list, ...)`` for every code list: stored in the raw
    layer under the list's name."""
    return {name: write_layer(df, root, "raw", name) for name, df in lists.items()}
