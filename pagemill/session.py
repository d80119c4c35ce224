"""Session helper and table reading."""

from pyspark.sql import DataFrame, SparkSession, functions as F


def get_session(master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName("pagemill")
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition only when the rows of the input stand in fewer splits than the cluster has cores, or most in a few.

    A few large files make few tasks and leave cores idle in CPU-bound jobs. So does a large file of one row group: it has
    many splits, of which one holds all rows. The rows of each split are counted from the files' footers. With
    enough splits, as in any large table, the input is left alone and nothing is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        held = df.groupBy(F.spark_partition_id().alias("split")).agg(F.count("*").alias("n"))
        rows = held.agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
        if rows["all"] is None or rows["most"] * cores <= 2 * rows["all"]:
            return df
    return df.repartition(max(cores, input_bytes(df) // PAGE_BYTES_PER_TASK), *keys)


#: Bytes of input for each task of a job that takes pages apart: a page grows manyfold there.
PAGE_BYTES_PER_TASK = 16 * 1024 * 1024


def input_bytes(df: DataFrame) -> int:
    """Bytes of the tables that df reads, by the optimizer's statistics; tables of unknown size count nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return sum(size for size in sizes if size < 1 << 60)


def by_page(pages: DataFrame, *keys: str) -> DataFrame:
    """Pages dealt by key to as many tasks as the input's size asks for, the session's shuffle partitions at least."""
    least = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pages.repartition(max(least, input_bytes(pages) // PAGE_BYTES_PER_TASK), *keys)
