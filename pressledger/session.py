"""Session helpers."""

import gc
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pressledger")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # Larger generated methods are never JIT-compiled; smaller pieces are.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a fresh temporary folder; a cluster has no such place, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pressledger-checkpoint-"))
    return spark.sparkContext.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared folder, so a lost executor costs one re-read."""
    if not df.sparkSession.sparkContext.getCheckpointDir():
        df.sparkSession.sparkContext.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def released(spark: SparkSession) -> None:
    """Have the shuffle files of finished steps deleted now.

    Spark deletes them when the driver's garbage collector finds that nothing refers to them any more. A driver that has memory to
    spare collects rarely, so without this they all stay on the disks until the job ends.
    """
    gc.collect()
    spark._jvm.System.gc()


def spread_if_small(df: DataFrame, limit: int = 1 << 30) -> DataFrame:
    """Spread an input below ``limit`` bytes over all cores.

    A small file is often one row group, hence one task whatever the number of cores. Larger inputs
    and those of at least as many files as cores already have as many splits and are left alone.
    """
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    cores = df.sparkSession.sparkContext.defaultParallelism
    if int(str(size)) > limit or len(df.inputFiles()) >= cores:
        return df
    return df.repartition(cores)
