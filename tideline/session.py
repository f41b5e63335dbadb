"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings a streaming aggregation job wants.  Shuffle partitions are frozen into a
# streaming checkpoint on first start, so they are an explicit argument below.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Recording the Python line of every column doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app_name: str = "tideline",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    packages: list[str] | None = None,
    **conf: str,
) -> SparkSession:
    """Create (or reuse) a session; ``packages`` adds connectors such as Kafka or Avro."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if packages:
        builder = builder.config("spark.jars.packages", ",".join(packages))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        path = tempfile.mkdtemp(prefix="tideline-")
        spark.conf.set("spark.checkpoint.dir", path)
        return path
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for one run's checkpoint or table."""
    return f"{shared_dir(spark)}/tideline/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` from a table in the shared folder: computed once, without lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table or folder that this package has made under the shared folder."""
    if not path.startswith(f"{shared_dir(spark)}/"):
        raise ValueError(f"{path} is not in the shared folder")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def ship(spark: SparkSession) -> None:
    """Give the Python workers of every executor this package, once per session."""
    context = spark.sparkContext
    if getattr(context, "_tideline_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    # The driver's own folder: executors fetch the file from the driver.
    archive = os.path.join(tempfile.mkdtemp(prefix="tideline-"), "tideline.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("tideline", os.path.relpath(path, root)))
    context.addPyFile(archive)
    context._tideline_shipped = True
