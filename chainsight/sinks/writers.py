"""Table writers (K1-K8).

Writes are plain DataFrame writes: each task writes its own files, the
driver only commits.  Parquet is the default; ``fmt`` can name ``delta``
where its package is installed.  Row counts ride on ``DataFrame.observe``,
so verifying a write needs no second pass over the data.
"""

from __future__ import annotations

import time
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from chainsight.run import RunContext


class SchemaMismatch(ValueError):
    pass


# K1 -------------------------------------------------------------------------
def overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | list[str] | None = None) -> None:
    """Full overwrite, replacing the schema.  K3 when ``partition_by`` is given:
    tasks write one file per partition value they hold, so a market holding a
    third of the rows is spread over all tasks instead of one."""
    w = df.write.format(fmt).mode("overwrite")
    if fmt == "delta":
        w = w.option("overwriteSchema", "true")
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.save(path)


# K2 -------------------------------------------------------------------------
def existing_schema(spark: SparkSession, path: str, fmt: str = "parquet") -> T.StructType | None:
    """Schema of the table at ``path``; None if nothing is there.  A table that is there
    and can't be read raises, so that it isn't taken for a new one."""
    try:
        return spark.read.format(fmt).load(path).schema
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def check_same_schema(spark: SparkSession, df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Raise unless the target is new or has the same columns and types."""
    current = existing_schema(spark, path, fmt)
    if current is not None:
        have = [(f.name, f.dataType.simpleString()) for f in current.fields]
        want = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
        if sorted(have) != sorted(want):
            raise SchemaMismatch(f"{path}: existing {have} != new {want}")


def overwrite_same_schema(spark: SparkSession, df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite only when the target is new or has the same columns and types."""
    check_same_schema(spark, df, path, fmt)
    overwrite(df, path, fmt)


# K4 -------------------------------------------------------------------------
def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Put the finished table at ``staged`` in the place of the one at ``path``.

    Input = output: a job writes beside the table that it reads or replaces, checks
    what it wrote, and then publishes it by two renames in the file system that holds
    both.  Until then the old table is untouched; between the renames it stands at
    ``<path>.old``, which the next publication removes."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    new, current, old = hadoop(staged), hadoop(path), hadoop(f"{path}.old")
    fs = new.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(old, True)
    if fs.exists(current) and not fs.rename(current, old):
        raise OSError(f"{path}: can't be moved aside")
    if not fs.rename(new, current):
        raise OSError(f"{staged}: can't be moved to {path}")
    fs.delete(old, True)


def new_version(root: str) -> str:
    """Folder for the next version of the table kept under ``root``; names sort by time."""
    return f"{root.rstrip('/')}/version={time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def switch(spark: SparkSession, name: str, version: str, fmt: str = "parquet") -> None:
    """Let readers of the catalogue name ``name`` see the finished table at ``version``.

    One statement to the catalogue, which does it whole or not at all, and no rename, so
    it also holds where the storage has none: a query that was resolved before reads the
    earlier version, whose files stay, and every later one the new one.  There is no
    moment without a table.  (A job may read ``name`` and publish to it.)"""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {fmt}.`{version}`")


def drop_old_versions(spark: SparkSession, root: str, current: str, keep: int = 2) -> list[str]:
    """Delete all but the last ``keep`` versions under ``root`` that are older than ``current``;
    the caller knows for how long a reader may still use one."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(root).getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in fs.listStatus(hadoop(root)))
    older = [n for n in names if n.startswith("version=") and n < current.rstrip("/").rsplit("/", 1)[-1]]
    gone = older[:max(0, len(older) - keep)]
    for n in gone:
        fs.delete(hadoop(f"{root}/{n}"), True)
    return gone


# K5 -------------------------------------------------------------------------
def write_counted(df: DataFrame, path: str, fmt: str = "parquet",
                  partition_by: str | list[str] | None = None, same_schema_as: SparkSession | None = None) -> int:
    """Write and return the number of rows written, observed during the write.

    With ``same_schema_as=spark`` the write is K2: refused when the existing
    table has other columns or types.
    """
    if same_schema_as is not None:
        check_same_schema(same_schema_as, df, path, fmt)
    obs = Observation("written")
    overwrite(df.observe(obs, F.count(F.lit(1)).alias("rows")), path, fmt, partition_by)
    return int(obs.get["rows"])


def read_back_count(spark: SparkSession, path: str, fmt: str = "parquet") -> int:
    return spark.read.format(fmt).load(path).count()


# K6 -------------------------------------------------------------------------
RUN_LOG = T.StructType([
    T.StructField("job", T.StringType()),
    T.StructField("table_path", T.StringType()),
    T.StructField("operation", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("version", T.StringType()),
    T.StructField("logged_at", T.TimestampType()),
    T.StructField("run_id", T.StringType()),
])


def log_run(spark: SparkSession, log_path: str, job: str, table_path: str, operation: str,
            rows: int, version: str = "", run: RunContext | None = None) -> None:
    """Append one row to the run log (the write history of every table).  All rows of a run
    carry its id; ``logged_at`` is the time of the write."""
    row = spark.createDataFrame([(job, table_path, operation, int(rows), version)], T.StructType(RUN_LOG.fields[:5]))
    row.withColumn("logged_at", F.current_timestamp()).withColumn("run_id", F.lit(run.run_id if run else None).cast("string")) \
        .write.mode("append").parquet(log_path)


def history(spark: SparkSession, log_path: str, table_path: str | None = None) -> DataFrame:
    log = spark.read.schema(RUN_LOG).parquet(log_path)  # logs from before a column was added lack it
    if table_path is not None:
        log = log.where(F.col("table_path") == table_path)
    return log.orderBy(F.col("logged_at").desc())


# K8 -------------------------------------------------------------------------
def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
