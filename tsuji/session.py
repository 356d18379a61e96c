"""Session helpers: building a local session for tests/bench and finding the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Session settings the operators rely on. Everything else is left to the cluster's defaults.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tsuji") -> SparkSession:
    """A local session for tests and the benchmark (never used on a cluster)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    b = (
        b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TSUJI_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_local_dirs: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder; set a local one only when none is configured.

    On a cluster ``spark.checkpoint.dir`` names shared storage (HDFS, S3, ...); every written
    intermediate table in this package goes below it, never to a machine-local folder.
    """
    sc = spark.sparkContext
    d = (spark.conf.get("spark.checkpoint.dir", None) or _local_dirs.get(sc.applicationId)
         or sc.getCheckpointDir())
    if not d:
        if not (sc.master or "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        # Only reached in tests / local runs where nothing was configured.
        d = tempfile.mkdtemp(prefix="tsuji-ckpt-", dir=os.environ.get("TSUJI_SCRATCH", "/tmp"))
        _local_dirs[sc.applicationId] = d
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # not settable at runtime in this deployment: the record above is used
            pass
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder for a written intermediate table."""
    return f"{ensure_checkpoint_dir(spark)}/tsuji/{name}-{uuid.uuid4().hex[:12]}"


def version_path(table: str) -> str:
    """A new folder for the next version of ``table``."""
    return f"{table.rstrip('/')}/version-{uuid.uuid4().hex[:12]}"


def publish(spark: SparkSession, table: str, version: str) -> None:
    """Make ``version`` the current one of ``table``: the pointer is one small text file, written
    after the version is complete, so readers see either the old table or the whole new one."""
    n = len(_pointers(spark, table)) + 1
    spark.createDataFrame([(version.rsplit("/", 1)[-1],)], "version string").coalesce(1).write.text(f"{table.rstrip('/')}/current/{n:09d}")


def _pointers(spark: SparkSession, table: str) -> list[str]:
    """Committed pointers, oldest first."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table.rstrip('/')}/current/*/_SUCCESS")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or []
    return sorted(f.getPath().getParent().toString() for f in found)


def current(spark: SparkSession, table: str) -> str:
    """Folder of the published version of ``table``."""
    pointers = _pointers(spark, table)
    if not pointers:
        raise FileNotFoundError(f"no published version of {table}")
    return f"{table.rstrip('/')}/{spark.read.text(pointers[-1]).first()[0]}"


TASKS_PER_CORE = 4


def dealt_out(df: DataFrame) -> DataFrame:
    """``df`` in some tasks per core of the cluster, whatever its files: a scan has no more tasks than row
    groups, and adaptive execution would join small partitions again, which costly work on rows cannot afford."""
    return df.repartition(TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so tasks that run its Python
    functions find it wherever the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="tsuji-ship-"), "tsuji-package.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join(os.path.basename(root), os.path.relpath(full, root)))
    sc.addPyFile(out)
    _shipped.add(sc.applicationId)


_materialized: dict[tuple, str] = {}


def materialized(spark: SparkSession, name: str, key: tuple, build) -> str:
    """Path of a table written once per application below the shared checkpoint folder.

    ``build()`` returns the DataFrame to write. Used for prepared inputs (the merged roads table,
    the loaded admin areas, the sorted layout) that many queries read, so lineage is cut by a
    written table instead of recomputing it in every query.
    """
    k = (spark.sparkContext.applicationId, name, key)
    path = _materialized.get(k)
    if path is None:
        path = scratch_path(spark, name)
        build().write.mode("overwrite").parquet(path)
        _materialized[k] = path
    return path


def arrow_fs(path: str):
    """(pyarrow filesystem, path) for a Spark-style URI, for the few tasks that touch storage
    directly: ``file:`` and bare paths are local, ``s3a://`` is read as ``s3://``, other schemes
    (``hdfs://``, ``gs://``, ...) go to pyarrow's resolver."""
    import pyarrow.fs as pafs

    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    if path.startswith("s3a://") or path.startswith("s3n://"):
        path = "s3://" + path.split("://", 1)[1]
    return pafs.FileSystem.from_uri(path)
