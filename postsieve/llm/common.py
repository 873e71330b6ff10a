"""Helpers the corpus operators share: tables, the shared folder, cut lineage, blocks of rows."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postsieve.session import checkpoint, shared_folder

__all__ = ["checkpoint", "read_table", "shared_folder", "spread", "written", "typed", "open_folder"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def corpus_query(name: str, sql: str | None = None):
    """Register ``run(spark, folder)`` under ``name``, with the SQL it must agree with, if any."""

    def add(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def typed(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, each cast to its type, so that further columns can't clash."""
    return df.select(*[df[name].cast(kind).alias(name) for name, kind in columns.items()])


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder, read again: survives executors, cuts the lineage."""
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def spread(df: DataFrame, *columns: str | Column) -> DataFrame:
    """Deal rows out evenly by a hash of ``columns`` over the session's shuffle partitions."""
    count = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(count, F.xxhash64(*columns))


def open_folder(uri: str):
    """A pyarrow file system and the path in it, for files that are not tables."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path, recursive=True)
    return system, path


def put_file(system, path: str, pieces) -> None:
    """Write ``pieces`` under a name of this attempt alone, then move it: a retry can't mix."""
    part = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        for piece in pieces:
            out.write(piece)
    system.move(part, path)


def child(path: str, name: str) -> str:
    return posixpath.join(path, name)
