"""Session helpers: local sessions for tests and benches, the shared
checkpoint folder, and lineage cuts that survive executor loss."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "arrivo", driver_memory: str = "8g") -> SparkSession:
    """A local session configured like the cluster profile: ANSI on, UTC,
    adaptive execution with skew-join splitting, no UI server."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; an error if the
    session names none, because a machine-local folder would not survive a
    lost executor."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a folder that driver "
                           "and executors share")
    return configured


def use_local_checkpoints(spark: SparkSession) -> None:
    """Give a local-mode session (one machine; tests, benches) a folder of
    its own if it names none. A cluster session is left as it is."""
    if spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local":
        if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
            spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="arrivo-ckpt-"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/arrivo-scratch/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back. Used where a frame is read by many jobs or where ids must stay the
    same: lost executors read the files again, and later reads are pruned
    and pushed down like any scan. ``drop_cut`` deletes the files."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_cut(df: DataFrame) -> None:
    """Delete the files of a frame that ``cut_lineage`` returned."""
    spark = df.sparkSession
    root = checkpoint_root(spark).rstrip("/") + "/arrivo-scratch/"
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    base = jvm.org.apache.hadoop.fs.Path(root)
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if path.getParent().toUri().getPath() == base.toUri().getPath():
            path.getFileSystem(conf).delete(path, True)


def storage_bytes(spark: SparkSession) -> int:
    """Bytes that the executors have for cached rows; the driver's count only
    where it is the executor (local mode)."""
    sc = spark.sparkContext._jsc.sc()
    driver = sc.env().blockManager().blockManagerId().hostPort()
    held, each = {}, sc.getExecutorMemoryStatus().iterator()
    while each.hasNext():
        one = each.next()
        held[one._1()] = int(one._2()._1())
    return sum(v for k, v in held.items() if k != driver) or held.get(driver, 0)


def default_parallelism(spark: SparkSession) -> int:
    """Number of shuffle partitions to use for explicit repartitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
