"""Session defaults and tables kept in the folder that the whole cluster shares."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "annolith", cores: str = "8", **conf: str) -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    defaults = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
        "spark.sql.adaptive.enabled": "true",
    }
    for key, value in (defaults | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; where none is set, a temporary folder under a local master, an error elsewhere."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isEmpty():
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="annolith-"))
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
    return current.get().rstrip("/")


def kept(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage is cut, lost executors do no harm.

    The path is in ``.kept_path`` of the returned frame, for :func:`discard`.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/annolith/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.kept_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete tables made by :func:`kept` that no later plan reads."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.kept_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def sweep(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished steps: Spark deletes them once no plan on the driver refers to them."""
    gc.collect()
    spark._jvm.System.gc()
