"""Session builder and the shared scratch folder used for written tables."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "faremill", cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Settings the wide plans here need.

    The JVM does not compile methods above 8,000 bytes of bytecode, so a whole-stage method beyond that
    would run interpreted; with this limit Spark splits such a stage into smaller compiled projections.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it in spark.checkpoint.dir.

    Only a local session may do without: its executors share the driver's disk, so it gets a temporary folder. On a cluster a folder of
    the driver's own would be read back incomplete, so there it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="faremill-")
        spark.conf.set("spark.checkpoint.dir", folder)
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/faremill/{name}-{uuid.uuid4().hex}"


def written_table(df: DataFrame, name: str, rows: int = 0) -> DataFrame:
    """Write df once and read it back: later readers share one result and its lineage is cut.

    With `rows` no file holds more of them, so that a reader's tasks stay small however well the rows compress.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_stamp(spark: SparkSession, path: str, *also: str) -> str:
    """A short name for a table as it is now (its place, bytes and the time it was last changed) and whatever else what is made of it hangs on."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    told = f"{path}|{files.getContentSummary(at).getLength()}|{files.getFileStatus(at).getModificationTime()}|{'|'.join(also)}"
    return hashlib.sha256(told.encode()).hexdigest()[:16]


def path_exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
