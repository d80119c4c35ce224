"""Body files: responses written out, request bodies read in."""

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from pagemill.fixed import BODY_EXTENSIONS
from pagemill.operators.requests import extension_allowed, file_extension


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder of spark.checkpoint.dir. A local session without it gets a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="pagemill-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def body_sink(responses: DataFrame, body: str, path: str, partition: str) -> DataFrame:
    """Write bodies as a partitioned table; return the responses with an empty body and the path.

    Every task writes its own files, so a partition value that holds most rows is written in
    parallel and nothing is shuffled.
    """
    responses.write.mode("errorifexists").partitionBy(partition).parquet(path)
    return responses.withColumn(body, F.lit("")).withColumn("body_path", F.lit(path))


def _stored(spark: SparkSession, folder: str, part: str, schema: str) -> DataFrame:
    """Rows of the store's committed runs; none while there is no store.

    A run that was killed before its commit has files but no row in `commits`, so nothing of it is seen.
    """
    try:
        commits = spark.read.schema("run string").parquet(f"{folder}/commits")
        rows = spark.read.schema(f"{schema}, run string").parquet(f"{folder}/{part}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{schema}, run string, body_path string")
    return rows.withColumn("body_path", F.col("_metadata.file_path")).join(commits, "run", "left_semi")


def stored_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """body_sha256, body and body_path (the file that holds it) of each different body; one row a body, even if two
    writers stored it at the same time."""
    return _stored(spark, folder, "bodies", "body_sha256 string, body string").groupBy("body_sha256").agg(
        F.min_by("body", "body_path").alias("body"), F.min("body_path").alias("body_path"))


def store_bodies(responses: DataFrame, keys: list[str], body: str, folder: str) -> DataFrame:
    """Write bodies to a store by content; returns (keys, body_sha256, body_bytes, body_path) of this run's rows.

    Equal bodies are stored once, those of earlier runs not again; a null body has no file. First the bodies are written,
    then the map from rows to files, and last one row that commits the run: until then readers see nothing of it, and
    a task that is lost writes its files anew. Bodies are shuffled by digest, copies being combined before that.
    """
    spark, run = responses.sparkSession, uuid.uuid4().hex
    digest = F.sha2(F.col(body), 256)
    earlier = stored_bodies(spark, folder).select("body_sha256", "body_path")
    (responses.where(F.col(body).isNotNull()).select(digest.alias("body_sha256"), F.col(body).alias("body"))
     .groupBy("body_sha256").agg(F.first("body").alias("body"))
     .join(earlier, "body_sha256", "left_anti")
     .write.parquet(f"{folder}/bodies/run={run}"))
    new = spark.read.schema("body_sha256 string").parquet(f"{folder}/bodies/run={run}").select(
        "body_sha256", F.col("_metadata.file_path").alias("body_path"))
    rows = responses.select(*keys, digest.alias("body_sha256"), F.octet_length(body).cast("bigint").alias("body_bytes"))
    (rows.join(earlier.unionByName(new), "body_sha256", "left").select(*keys, "body_sha256", "body_bytes", "body_path")
     .write.parquet(f"{folder}/rows/run={run}"))
    spark.createDataFrame([(run,)], "run string").coalesce(1).write.mode("append").parquet(f"{folder}/commits")
    return spark.read.parquet(f"{folder}/rows/run={run}")


def body_source(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as request bodies: (path, body), only with an allowed extension."""
    files = (
        spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body")))
    return files.where(extension_allowed(F.col("path")))


def load_bodies(requests: DataFrame, files: DataFrame) -> DataFrame:
    """Requests (body, body_file, ...) with the bodies of the files they name, from files (body_file, body).

    Adds from_file, true where a body came from a file, and file_error, where the extension is not allowed or there is
    no such file. A request that gives both a body and a file keeps its own body, so that the manifest refuses it. Only
    names that may be read meet the files; a file that many requests name is joined as AQE sees fit.
    """
    named = F.coalesce("body_file", F.lit("")) != ""
    own = F.coalesce("body", F.lit("")) != ""
    asked = F.when(named & ~own & extension_allowed(F.col("body_file")), F.col("body_file"))
    rows = requests.withColumn("_asked", asked).join(
        files.select(F.col("body_file").alias("_file"), F.col("body").alias("_read"), F.lit(True).alias("_found")),
        F.col("_asked") == F.col("_file"), "left")
    error = (
        F.when(named & ~own & ~extension_allowed(F.col("body_file")), F.concat(
            F.lit('Failed to read body file: File extension "'), file_extension(F.col("body_file")),
            F.lit(f'" is not allowed for read operation. Allowed: {", ".join(BODY_EXTENSIONS)}')))
        .when(F.col("_asked").isNotNull() & F.col("_found").isNull(),
              F.concat(F.lit("Failed to read body file: File not found: "), "body_file")))
    found = F.col("_found").isNotNull()
    others = [F.col(f"`{c}`") for c in requests.columns if c != "body"]
    return rows.select(*others, F.when(found, F.col("_read")).otherwise(F.col("body")).alias("body"),
                       found.alias("from_file"), error.alias("file_error"))
