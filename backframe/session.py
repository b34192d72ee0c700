"""Session defaults for local runs and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("backframe")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Only a local session, whose executors share the machine, may go without the setting; it
    gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="backframe-")
    return _LOCAL_FOLDERS[application]


#: Folders made within the innermost open ``scratch_run``.
_OPEN_RUN: ContextVar[list[str] | None] = ContextVar("backframe_scratch", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which the open ``scratch_run``, if any, will remove."""
    path = os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
    made = _OPEN_RUN.get()
    if made is not None:
        made.append(path)
    return path


def _folder(spark: SparkSession, path: str):
    """The path and its file system, as Spark's writers see them."""
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    return own, own.getFileSystem(spark._jsc.hadoopConfiguration())


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[list[str]]:
    """Frames stored in this block live as long as it, whether it ends well or not.

    Results must be written, by ``publish`` or otherwise, before it ends. Blocks may be nested; each removes
    its own folders.
    """
    made: list[str] = []
    token = _OPEN_RUN.set(made)
    try:
        yield made
    finally:
        _OPEN_RUN.reset(token)
        for path in made:
            own, files = _folder(spark, path)
            files.delete(own, True)


def publish(df: DataFrame, path: str) -> None:
    """Write a result so that ``path`` holds all of it or what it held before.

    It is written to a folder beside, which then takes the place of the old one. A run that fails leaves
    the old result and no folder of its own; the same call may simply be made again.
    """
    spark = df.sparkSession
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    old = f"{path.rstrip('/')}.old-{uuid.uuid4().hex}"
    (new_path, files), (place, _), (old_path, _) = (_folder(spark, p) for p in (staging, path, old))
    try:
        df.write.parquet(staging)
        replaced = files.exists(place)
        if replaced and not files.rename(place, old_path):
            raise OSError(f"cannot move {path} away")
        if not files.rename(new_path, place):
            if replaced:
                files.rename(old_path, place)
            raise OSError(f"cannot publish {path}")
        if replaced:
            files.delete(old_path, True)
    finally:
        files.delete(new_path, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written out once to the shared folder and read back.

    For a frame whose joins are costly and which several consumers read. Unlike a cache, the
    files survive the loss of executors, and each reader scans only the columns it needs. They stay
    until the ``scratch_run`` around them ends, or for good without one.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: HotSpot compiles no method beyond this size. Projections of many columns that become one are
#: interpreted for each row; with this limit Spark divides them.
SHORT_METHODS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


@contextmanager
def settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    """SQL settings for what runs in this block, as ``stored`` does; the session's own return after it."""
    own = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in own.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


#: Rows up to which a stored frame of a few numbers a row is sent to all tasks.
SMALL_ROWS = 100_000


def small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """The frame, to be broadcast if it has no more than ``rows`` rows; else joins take it as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Functions that run in workers refer to the package's modules. Workers started elsewhere, with
    no path to it, get it as a zip from the driver.
    """
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="backframe-ship-"), "backframe.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(here)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(application)
