"""Session defaults, the shared scratch folder and table materialisation."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "bramble", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; cluster sizing is left to the submitter."""
    builder = (SparkSession.builder.appName(app)
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_local_root: str | None = None


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by the session; a private folder only for local masters."""
    shared = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="bramble-")
    return _local_root


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_path(spark, "checkpoints"))


_written: list[str] = []


def owned(path: str) -> str:
    """Note a path below the shared folder as this process's own, to be deleted by ``drop_materialised``."""
    _written.append(path)
    return path


def written_so_far() -> int:
    """How many tables this process holds; a mark for ``drop_materialised``."""
    return len(_written)


def drop_materialised(spark: SparkSession, since: int = 0, keep: Sequence[str] = ()) -> int:
    """Delete the tables written after the mark ``since``, but for the paths in ``keep``; the number deleted.

    To be called once no result that reads them is needed.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = [p for p in _written[since:] if p not in keep]
    _written[since:] = [p for p in _written[since:] if p in keep]
    for name in gone:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
    return len(gone)


def materialise(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write once to the shared folder (to ``path`` if given) and read back.

    Used where a result feeds several later jobs: the files outlive executors, and, unlike
    ``checkpoint()``, the plan runs only once.
    """
    path = path or scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    owned(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition by key when a table has fewer files or splits than there are cores.

    For work that is heavy per row on a table of few files, each of which may be a single row group
    and hence one task; inputs with enough files stay as they are and no shuffle is added.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    files = len(df._jdf.inputFiles())
    few = 0 < files < cores or df.rdd.getNumPartitions() < cores
    return df.repartition(cores, *keys) if few else df
