"""Sources of clinical tables and staged results with a manifest."""

from __future__ import annotations

import datetime
import json
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``. Where it is unset, a local
    folder if all of Spark runs in this process (tests), else an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = os.environ.get("MEDLOOM_LOCAL_STAGED")
        if not root:
            root = os.environ["MEDLOOM_LOCAL_STAGED"] = tempfile.mkdtemp(prefix="spark-")
    return root.rstrip("/")


def cut(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read again: without its lineage, and safe from the
    loss of an executor."""
    path = f"{shared_root(df.sparkSession)}/medloom/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, path: str, form: str = "parquet", columns: list[str] | None = None, **options) -> DataFrame:
    """A table in parquet, orc, json or csv form, or over jdbc, with only the columns asked for."""
    reader = spark.read.options(**options)
    df = reader.format("jdbc").option("dbtable", path).load() if form == "jdbc" else reader.format(form).load(path)
    return df.select(*columns) if columns else df


#: Version of the manifest that is written, and that is read.
MANIFEST = 2
_FIELDS = "name string, path string, fields string, version int, expires timestamp"


def write_staged(outputs: dict[str, DataFrame], path: str, keep_days: float | None = None, most_outputs: int = 100) -> str:
    """Write results as parquet, and last a manifest that names them: readers go by the
    manifest, so a run that was broken off leaves nothing that they see. After keep_days
    readers refuse it."""
    if not 0 < len(outputs) <= most_outputs:
        raise ValueError(f"{len(outputs)} outputs; from 1 to {most_outputs} can be staged")
    spark = next(iter(outputs.values())).sparkSession
    run = uuid.uuid4().hex
    for name, df in outputs.items():
        df.write.parquet(f"{path}/{run}/{name}")
    expires = None if keep_days is None else datetime.datetime.now() + datetime.timedelta(days=keep_days)
    rows = [(name, f"{path}/{run}/{name}", json.dumps([[f.name, f.dataType.simpleString()] for f in df.schema]), MANIFEST, expires) for name, df in outputs.items()]
    spark.createDataFrame(rows, _FIELDS).coalesce(1).write.json(f"{path}/{run}/manifest")
    return f"{path}/{run}"


def read_staged(spark: SparkSession, run: str) -> dict[str, DataFrame]:
    """The staged results by name. One that has expired, or of another version, is an error."""
    rows = spark.read.schema(_FIELDS).json(f"{run}/manifest").collect()  # a row per output
    if any(r.version != MANIFEST for r in rows):
        raise ValueError(f"the manifest isn't of version {MANIFEST}")
    if any(r.expires and r.expires < datetime.datetime.now() for r in rows):
        raise ValueError("the staged results have expired")
    return {r.name: spark.read.parquet(r.path) for r in rows}


def write_cohort(cohort: DataFrame, path: str) -> None:
    """Keep cohorts in parquet, a folder for each cohort_definition_id; those that are
    written again are replaced, the others stay."""
    cohort.repartition("cohort_definition_id", "subject_id").write.partitionBy("cohort_definition_id").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def read_cohort(spark: SparkSession, path: str, definition: int | None = None) -> DataFrame:
    """Kept cohorts; of one definition only its folder is read."""
    df = spark.read.parquet(path)
    return df if definition is None else df.where(df["cohort_definition_id"] == definition)
