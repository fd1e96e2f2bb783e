"""Reading the corpus tables and cutting lineage in the shared folder."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from plumbline.session import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one table; other columns, whatever their names, stay unread."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def kept(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written to the folder all executors share, and read from there.

    A lost executor then costs a file read, not a new run of what came before.  The
    files stay until ``forget``: results are read from them.
    """
    spark = df.sparkSession
    path = f"{_folder(spark)}/{name}-{uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession) -> str:
    """The folder of this application in the one all executors share."""
    return f"{shared_folder(spark)}/kept-{spark.sparkContext.applicationId}"


def forget(spark: SparkSession) -> None:
    """Remove all that ``kept`` has written in this application.

    To be called when the results of its operators have been written or read; frames
    that were made from these files cannot be read any more.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


#: bytes of an Arrow batch on its way to a Python worker; a text that is longer travels alone
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker is handed at once by bytes, not by rows alone.

    A session that has a bound of its own keeps it.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == "67108864b":  # Spark's own
        spark.conf.set(name, f"{BATCH_BYTES}b")
