"""Session helpers.

The library never creates its own scratch storage on a cluster: iterative operators cut
lineage with ``DataFrame.checkpoint()`` into the shared folder named by
``spark.checkpoint.dir``.  Only a *local* session without that setting (tests, a laptop)
gets a fresh folder under the system temp directory.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings for a local test/bench session.  On a cluster the caller's session wins.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "ledgerprofile", extra: dict | None = None) -> SparkSession:
    """A session configured like the tests and the bench expect."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder of this session.

    Order: a folder already set on the SparkContext, then ``spark.checkpoint.dir`` from the
    session conf, then - for local masters only - a new temp folder.  A cluster session
    without a shared checkpoint folder is a configuration error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the checkpoint folder
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerprofile-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set: iterative operators need a shared checkpoint folder"
    )


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder that this library wrote, wherever it is (classic sessions only)."""
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001 - Spark Connect: the server cleans up
        return
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(conf).delete(path, True)


def folder_exists(spark: SparkSession, folder: str) -> bool:
    """Whether a folder is there, wherever it is (on Spark Connect: whether it can be read)."""
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001 - Spark Connect: ask the server
        try:
            return spark.read.format("binaryFile").load(folder).schema is not None
        except Exception:  # noqa: BLE001
            return False
    path = jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(conf).exists(path)


class Scratch:
    """Intermediate tables of a job, written as Parquet under the checkpoint folder.

    Like a reliable checkpoint, a stored frame is cut from its lineage and survives lost
    executors.  Unlike one, it keeps its true size for the optimiser: the estimated size of a
    checkpointed join is the product of its inputs, which grows without bound in a loop.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = checkpoint_dir(spark).rstrip("/")
        self._stored: dict[int, tuple[DataFrame, str, bool]] = {}

    def store(self, df: DataFrame, buckets: int | None = None, by: tuple[str, ...] = ()) -> DataFrame:
        """Write ``df`` and return the stored frame; with ``buckets``, dealt by ``by`` like a shuffle."""
        name = f"ledgerprofile_{uuid.uuid4().hex}"
        path = f"{self.folder}/{name}"
        if buckets:
            df.write.bucketBy(buckets, *by).option("path", path).saveAsTable(name)
            out = self.spark.table(name)
        else:
            df.write.parquet(path)
            out = self.spark.read.schema(df.schema).parquet(path)
        self._stored[id(out)] = out, name, bool(buckets)
        return out

    def append(self, name: str | None, df: DataFrame, buckets: int, by: tuple[str, ...]) -> str:
        """Add rows to the bucketed table ``name``, or to a new one, and return its name."""
        name = name or f"ledgerprofile_{uuid.uuid4().hex}"
        (df.write.bucketBy(buckets, *by).option("path", f"{self.folder}/{name}").mode("append").saveAsTable(name))
        return name

    def appended(self, name: str) -> DataFrame:
        """All rows of a table made by :meth:`append`, read in place."""
        return self.spark.table(name)

    def drop_appended(self, name: str | None) -> None:
        if name:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            drop_folder(self.spark, f"{self.folder}/{name}")

    def drop(self, *frames: DataFrame | None) -> None:
        """Delete stored frames; they must not be read again."""
        for df in frames:
            if df is not None and id(df) in self._stored:
                _, name, is_table = self._stored.pop(id(df))
                if is_table:
                    self.spark.sql(f"DROP TABLE IF EXISTS {name}")
                drop_folder(self.spark, f"{self.folder}/{name}")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add this package to the session's Python files, once per application.

    For operators that run Python inside tasks: the archive is written by the driver and
    fetched by each executor from Spark's own file distribution, as with ``--py-files``, so
    tasks import the package wherever they run.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server's installation counts
        return
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix=f"{package.name}-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)
