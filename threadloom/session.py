"""Session factory, table access and cut points for long lineages.

Intermediate results that several branches need, or that an iteration feeds
back, are written once to the folder the cluster shares
(``spark.checkpoint.dir``) and read back.  A lost executor then costs a re-read
of files, never a re-run of the whole history.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def get_session(app: str = "threadloom", cpus: str | int = "*", **conf: str) -> SparkSession:
    """A session with UTC timestamps and adaptive execution.

    It runs locally on ``cpus`` cores unless the program was submitted to a cluster,
    a session is active or ``conf`` names a master.
    """
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if "spark.master" not in conf and "PYSPARK_GATEWAY_PORT" not in os.environ and SparkSession.getActiveSession() is None:
        b = b.master(f"local[{cpus}]")
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ship_package(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory (a file or a folder of parts)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a private one is made only when the session names none."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("on a cluster spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="threadloom-")
        atexit.register(shutil.rmtree, _LOCAL[app], True)
    return _LOCAL[app]


@contextmanager
def spent_shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is executed inside are removed as soon as it has ended, not when the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


class Stage:
    """A DataFrame written to the shared folder, with the means to remove it; what is left goes when the driver ends."""

    def __init__(self, df: DataFrame, tag: str):
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark)}/threadloom/{tag}-{uuid.uuid4().hex}"
        with spent_shuffles_removed(self.spark):
            df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)
        self._fs, self._at = file_system(self.spark, self.path)
        self._fs.deleteOnExit(self._at)

    def drop(self) -> None:
        self._fs.delete(self._at, True)
        self._fs.cancelDeleteOnExit(self._at)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, local or shared, and the path as it knows it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def materialize(df: DataFrame, tag: str = "stage") -> DataFrame:
    """Write once to the shared folder and read back: one computation, no lineage behind it."""
    return Stage(df, tag).df


def collect_bounded(df: DataFrame, most: int) -> list:
    """Rows of a table that is small by its nature; more than ``most`` is an error, never a cut."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a table meant to be small has more than {most} rows")
    return rows


def ship_package(spark: SparkSession) -> None:
    """Send this package to executors that cannot import it from their own path."""
    app = spark.sparkContext.applicationId
    if _LOCAL.get("shipped") == app:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="threadloom-zip-")
    atexit.register(shutil.rmtree, folder, True)
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(folder, "threadloom"), "zip", os.path.dirname(root), "threadloom"))
    _LOCAL["shipped"] = app
