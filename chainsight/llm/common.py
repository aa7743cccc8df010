"""Helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """A new folder name under ``chainsight-llm/<application id>`` in the folder that the
    cluster names in ``spark.checkpoint.dir``; a temporary folder only where none is set and
    all tasks run on the driver's machine (tests).

    The tables of one application are in one folder: delete it once their results are
    written, or after a lost run."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="chainsight-llm-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/chainsight-llm/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts lineage: a later read finds the files whichever executor is lost, and
    row numbers stored in the table stay what they were."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def beside(df: DataFrame, *wanted: str) -> str:
    """A column name that ``df`` doesn't have, for work columns (one struct holds them all)."""
    name, taken = "_work", {c.lower() for c in (*df.columns, *wanted)}
    while name in taken:
        name += "_"
    return name


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of an array of span structs, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns that an operator is about to add (names compare
    as Spark's own do, so an input's column of the same name gives way)."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])
