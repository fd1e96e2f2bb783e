"""Session defaults and the one way the engine cuts lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "plumbline", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the operators rely on.

    UTC keeps naive timestamps and ``as_of`` literals comparable; AQE chooses
    join strategies, splits skewed join partitions and merges small ones at
    run time.  Shuffle width is left to the caller or the cluster defaults.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # do not record a Python call site per expression: wide rule sets build thousands
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder, one for all it writes.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    own = spark.sparkContext.applicationId
    if own not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[own] = tempfile.mkdtemp(prefix="plumbline-")
    return _LOCAL_FOLDERS[own]


_LOCAL_FOLDERS: dict[str, str] = {}


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and read it from there.

    Used where one small derived table (a profile, a result set) feeds several
    consumers, so that the scan behind it runs once and a lost executor costs a
    file read instead of a new scan.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)
