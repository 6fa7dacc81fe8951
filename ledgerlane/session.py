"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
    "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true",
}


def local_session(cores: int | str = "*", app: str = "ledgerlane") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    A local session that names none gets one under /tmp; any other must name
    it, as executors don't share their machines' folders.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect session has no SparkContext
        sc = None
    if not path and sc is not None:
        path = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if sc is None or not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def read_or_empty(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", nested: bool = False) -> DataFrame:
    """The files under ``path`` by a declared schema; an empty table where nothing was written.  ``nested``: folders are no partitions."""
    try:
        return spark.read.schema(schema).format(fmt).option("recursiveFileLookup", nested).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder for one run, in this application's part of the shared folder."""
    return f"{_own(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _own(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/ledgerlane-{spark.sparkContext.applicationId}"


def clean(spark: SparkSession) -> None:
    """Delete this application's scratch folder: call it when results that read from there are done with."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
