"""Session helpers: a tuned builder for local runs and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "foliate") -> SparkSession:
    """A session for one machine. Clusters bring their own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship_package(spark: SparkSession) -> None:
    """Let the executors' Python workers import this package, wherever it lies on the driver. Done once a context."""
    context = spark.sparkContext
    if getattr(context, "_foliate_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="foliate-")) / "foliate.zip"  # the driver serves it to the executors
    atexit.register(shutil.rmtree, archive.parent, ignore_errors=True)
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, Path("foliate") / file.relative_to(root))
    context.addPyFile(str(archive))
    context._foliate_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir of the session.

    Only where the session names none (a local run, as in tests) a folder of this machine is used.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return "file://" + _own_folder()


@lru_cache(1)
def _own_folder() -> str:
    """A folder of this process for local runs, removed at its end."""
    path = tempfile.mkdtemp(prefix="foliate-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def written(df: DataFrame, what: str, *by: str) -> DataFrame:
    """Cut the lineage of df: write it once to the shared folder (one part per value of the columns `by`) and read it back.

    Parquet on shared storage outlives any executor, and a second reader doesn't compute df again. The tables of a
    session lie in a folder of its own, which `clear_written` removes.
    """
    spark = df.sparkSession
    path = f"{session_dir(spark)}/{what}-{uuid.uuid4().hex}"
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def session_dir(spark: SparkSession) -> str:
    """The folder of this session's tables below the shared folder, named by the application's id."""
    return f"{shared_dir(spark)}/foliate-{spark.sparkContext.applicationId}"


def clear_written(spark: SparkSession) -> None:
    """Remove the tables that this session wrote: when its results are saved, for they may still read them."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(session_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
