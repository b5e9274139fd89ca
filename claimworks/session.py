"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Settings a job on a cluster should start with. Partition counts are left to adaptive
#: execution: start high and let it coalesce towards the advisory size.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session on this machine, for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("claimworks")
    settings = {
        **RECOMMENDED,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    On a cluster the setting must be there. Only a local session gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="claimworks-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession, *paths: str) -> None:
    """Delete folders that ``scratch_path`` named; anything outside the shared folder is left."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = hadoop.Path(shared_folder(spark)).toUri().getPath()
    for path in paths:
        folder = hadoop.Path(path)
        if folder.toUri().getPath().startswith(f"{root}/"):
            folder.getFileSystem(conf).delete(folder, True)


@contextmanager
def session_conf(spark: SparkSession, **settings: str):
    """Set SQL settings (``__`` stands for a dot) for one action and put the old ones back."""
    names = {key.replace("__", "."): value for key, value in settings.items()}
    before = {key: spark.conf.get(key, None) for key in names}
    for key, value in names.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """While it lasts, each execution that ends deletes its shuffle files.

    Else they stay until the driver's collector finds the plan unused, which on a large heap may be
    after the job. For executions that are not repeated: a frame acted on again would shuffle again.
    Inside another one, as in threads of a session, it leaves the setting to that one.
    """
    if spark.conf.get(_FREED, None) == "true":
        yield
        return
    with session_conf(spark, **{_FREED: "true"}):
        yield
