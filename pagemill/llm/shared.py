"""Tables that several steps read: written to the folder that driver and executors share."""

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. A local session without it (tests) gets a temporary one."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="shared-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Writes df as Parquet in the shared folder, with the writer's options, and reads it again: later steps neither
    recompute it nor depend on the executors that made it."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialized(df: DataFrame, column: Column, name: str, *keep: str) -> DataFrame:
    """keep columns and `column`, evaluated once per row.

    A plain projection may be inlined into each later use, also into a lambda that runs per array
    element. A generator of one row is a barrier to that.
    """
    return df.select(*keep, F.explode(F.array(column)).alias(name))
