"""Session helpers: local sessions, the shared work folder, plan size checks."""

from __future__ import annotations

import io
import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def local_session(cpus: int | str = 8, app: str = "footfall", **conf) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        # call sites are not recorded for every column expression, which doubles the time to build a plan
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once a session, so that Python stages find it there.

    Not needed where the package is installed, or named in ``--py-files`` or PYTHONPATH, on every machine.
    """
    context = spark.sparkContext
    if getattr(context, "_footfall_shipped", False):
        return
    top = Path(__file__).resolve().parent
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(top.rglob("*.py")):
            out.write(path, str(path.relative_to(top.parent)))
    target = os.path.join(tempfile.mkdtemp(prefix="footfall-ship-"), "footfall.zip")
    Path(target).write_bytes(held.getvalue())
    context.addPyFile(target)
    context._footfall_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    A session in one process without the setting gets a new temporary folder; a cluster
    without it is an error, because a machine-local folder would be lost with
    the machine.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or getattr(spark.sparkContext, "_footfall_folder", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    spark.sparkContext._footfall_folder = tempfile.mkdtemp(prefix="footfall-")
    return spark.sparkContext._footfall_folder


def work_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return os.path.join(_own_folder(spark), f"{name}-{uuid.uuid4().hex}")


def _own_folder(spark: SparkSession) -> str:
    return os.path.join(shared_dir(spark), "footfall", spark.sparkContext.applicationId)


def clear_work(spark: SparkSession) -> None:
    """Deletes what this application has written for its own use; call it when its results are no longer read."""
    remove_path(spark, _own_folder(spark))


def written(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Writes the frame to the shared folder, in folders by the columns ``by`` if any, and reads it back.

    Cuts the lineage in a way that survives the loss of executors, and leaves a
    table whose size the optimizer knows exactly.
    """
    path = work_path(df.sparkSession, name)
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared store, if it is there."""
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def plan_bytes(df: DataFrame) -> int:
    """Spark's size estimate of a frame, huge when it knows nothing.

    Taken before optimization: it costs no planning time, and as it counts every column
    of the files and multiplies the sides of joins, it errs towards large.
    """
    try:
        return int(df._jdf.queryExecution().analyzed().stats().sizeInBytes())
    except AttributeError:  # a remote session has no such handle: treat the frame as large
        return 1 << 62


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Puts a small text in place as a whole: it is written beside its place and renamed."""
    fs, target = _fs(spark, path)
    beside = target.suffix(f"-{uuid.uuid4().hex}.tmp")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(beside, target):  # stores whose rename does not replace
        fs.delete(target, False)
        if not fs.rename(beside, target):
            raise OSError(f"{path} cannot be replaced")


def get_text(spark: SparkSession, path: str) -> str | None:
    """A small text, or None where there is none."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return None
    source = fs.open(target)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a glob pattern names in the shared store."""
    fs, target = _fs(spark, pattern)
    return [status.getPath().toString() for status in fs.globStatus(target) or []]


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a path, from the store's listing."""
    fs, target = _fs(spark, path)
    return int(fs.getContentSummary(target).getLength())


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target
