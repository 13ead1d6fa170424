"""Reading and writing table folders."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMAT = "parquet"

_shared_root: dict[str, str] = {}


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = FORMAT
) -> DataFrame:
    """A lakehouse table. ``fmt`` may be any format on the class path, such as delta."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def write_table(
    df: DataFrame, path: str, partition_by: str | None = None, sort_by: str | None = None, fmt: str = FORMAT,
    lookup_by: str | None = None, then: Callable[[DataFrame], DataFrame] | None = None, **options: str,
) -> None:
    """Replace the table at ``path``.

    With a partition column the rows are rebalanced on it first: each folder
    gets few, evenly sized files, and a folder that holds much of the data is
    written by many tasks. Sorting inside the files lets a lookup on that column
    skip row groups; a Bloom filter does so for ``lookup_by``, which the files are not
    sorted by. ``then`` adds columns after the rows have moved, so those that follow from
    others are neither shuffled nor sorted.
    """
    then = then or (lambda moved: moved)
    if lookup_by:
        options[f"parquet.bloom.filter.enabled#{lookup_by}"] = "true"
    if partition_by is None:
        then(df).write.format(fmt).options(**options).mode("overwrite").save(path)
    else:
        df = df.hint("rebalance", F.col(partition_by))
        if sort_by:
            df = df.sortWithinPartitions(partition_by, sort_by)
        then(df).write.format(fmt).options(**options).mode("overwrite").partitionBy(partition_by).save(path)


def replace_partition(df: DataFrame, path: str, partition_by: str, fmt: str = FORMAT) -> None:
    """Replace only those partitions of ``path`` that ``df`` has rows for."""
    (
        df.write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_by)
        .save(path)
    )


def with_audit(df: DataFrame, **labels: str) -> DataFrame:
    """Constant label columns and the write time, as a derived table carries them."""
    for name, value in labels.items():
        df = df.withColumn(name, F.lit(value))
    return df.withColumn("created_at", F.current_timestamp())


def warehouse_query(spark: SparkSession, query: str, args: dict | None = None) -> DataFrame:
    """Rows of a parameterised query. Values bind through ``:name`` markers."""
    return spark.sql(query, args=args or {})


def jdbc_table(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A table of an outside database. Give partitionColumn, lowerBound, upperBound and
    numPartitions for a parallel read."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


# ------------------------------------------------------------------- staging
def _delete(spark: SparkSession, path: str, at_exit: bool = False) -> None:
    """Delete a folder of any file system that Spark can write to, now or when the application ends."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if at_exit:
        files.mkdirs(place)  # only what exists can be marked
        files.deleteOnExit(place)
    else:
        files.delete(place, True)


def _root(spark: SparkSession) -> str:
    """This application's folder for staged tables; it goes when the application ends.

    It lies in the folder that spark.checkpoint.dir names or, where that is not set, in
    the warehouse, which all executors share as well.
    """
    context = spark.sparkContext
    app = context.applicationId
    if app not in _shared_root:
        base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
        base = base or spark.conf.get("spark.sql.warehouse.dir")
        _shared_root[app] = f"{base.rstrip('/')}/tillscope-{app}-{uuid.uuid4().hex[:8]}"
        _delete(spark, _shared_root[app], at_exit=True)
    return _shared_root[app]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Tables staged inside are deleted at the end, for applications that live long.

    Nothing lazily built inside may be read afterwards.
    """
    app = spark.sparkContext.applicationId
    outer = _root(spark)
    _shared_root[app] = f"{outer}/{uuid.uuid4().hex[:8]}"
    try:
        yield _shared_root[app]
    finally:
        _delete(spark, _shared_root[app])
        _shared_root[app] = outer


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{_root(spark)}/{name}-{uuid.uuid4().hex[:8]}"


def stage(
    df: DataFrame, name: str, partition_by: str | None = None, sort_by: str | None = None, lookup_by: str | None = None,
    then: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    Cuts the lineage at a table that several jobs read. The files outlive any
    executor, the reader prunes columns, and the planner knows the size.
    """
    path = scratch_path(df.sparkSession, name)
    schema = (then(df) if then else df).schema
    write_table(df, path, partition_by, sort_by, lookup_by=lookup_by, then=then, compression="zstd")
    return read_table(df.sparkSession, path, schema)
