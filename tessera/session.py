"""Session factory, table access and fault-tolerant intermediate tables."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "tessera", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this engine assumes; explicit ``conf`` wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    } | conf
    return builder.config(map=settings).getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the executors' Python workers, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_tessera_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='tessera-')}/{package.name}", "zip", package.parent, package.name)
    sc.addPyFile(archive)
    sc._tessera_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Repartition a scan that would leave most cores idle (few large row groups); else unchanged."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() * 2 > cores else df.repartition(cores)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``).

    Where the setting is absent a private folder is made and set, in local mode only: elsewhere the
    executors have no folder of one machine in common.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        sc = spark.sparkContext
        if not sc._jsc.sc().getCheckpointDir().isDefined():
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="tessera-"))
        path = sc._jsc.sc().getCheckpointDir().get()
    return path.rstrip("/")


def materialize(df: DataFrame, tag: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a compressed table in the shared folder and read it back.

    This cuts lineage without depending on any single executor: the table outlives lost
    executors, unlike a local checkpoint. The folder is removed when the driver's JVM exits.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex[:12]}"
    jvm, hconf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    target.getFileSystem(hconf).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)
