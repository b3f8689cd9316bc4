"""Tables cut off from their lineage, in the folder that all executors share."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most bytes that an operator may broadcast; beyond it a shuffle join is used.
BROADCAST_BYTES = 8 << 20


_written: dict[str, DataFrame] = {}


def _delete(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written() -> frozenset[str]:
    """The tables that stage has written in this session and that are still there."""
    return frozenset(_written)


def clear(spark: SparkSession, before: frozenset[str] = frozenset(), *keep: DataFrame) -> None:
    """Delete the tables that stage has written in this session, but those that ``written`` gave
    as before, and those to keep. Results of operators read them, so write those first."""
    for path, df in list(_written.items()):
        if path not in before and not any(df is k for k in keep):
            del _written[path]
            _delete(spark, path)


def dropped(table: DataFrame) -> None:
    """Delete a table that stage has written and that nothing will read again."""
    for path, df in list(_written.items()):
        if df is table:
            del _written[path]
            _delete(table.sparkSession, path)


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Where it is unset, a local folder if all of
    Spark runs in this process (tests), else an error: other machines wouldn't see it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = os.environ.get("MEDLOOM_LOCAL_SHARED")
        if not root:
            root = os.environ["MEDLOOM_LOCAL_SHARED"] = tempfile.mkdtemp(prefix="spark-")
    return root.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/medloom/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and return the written table.

    A lost executor can't take it along, and what follows doesn't recompute df.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    _written[path] = df.sparkSession.read.schema(df.schema).parquet(path)
    return _written[path]


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """df, a staged table, marked for a broadcast if its rows of about row_bytes come to
    BROADCAST_BYTES at most; else as it is, for a shuffle join."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def row_hash(df: DataFrame) -> Column:
    """A hash of a whole row, to tell rows with the same doc_id apart. Maps have no hash."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()])


def fresh(df: DataFrame, name: str) -> str:
    """name, or the first of name_, name__ ... that df has no column of."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
