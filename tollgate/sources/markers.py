"""Files of one line: marks that only one can set, and pointers that switch at once.

They go through Hadoop's file systems, so they lie wherever the tables do.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _caused_by(err: Py4JJavaError, name: str) -> bool:
    return err.java_exception.getClass().getSimpleName() == name


def read_line(spark: SparkSession, path: str) -> str | None:
    """The line in ``path``; None without such a file."""
    target, system = _place(spark, path)
    if not system.exists(target):
        return None
    stream = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def _write(system, target, line: str, overwrite: bool) -> None:
    stream = system.create(target, overwrite)
    try:
        stream.write(bytearray(f"{line}\n".encode()))
    finally:
        stream.close()


def switch(spark: SparkSession, path: str, line: str) -> None:
    """Make ``path`` hold ``line``: a reader sees the old line or the new one, whole.

    The line is written beside it and renamed over it, in one step where the file
    system renames in one step. An object store shows a file only when it is complete.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    beside, system = _place(spark, f"{path}.{uuid.uuid4().hex}")
    _write(system, beside, line, True)
    replace = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    replace[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    target = jvm.org.apache.hadoop.fs.Path(path)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), conf).rename(beside, target, replace)


def claim(spark: SparkSession, path: str) -> bool:
    """Set the mark ``path``; False if it is set already. Of many at once one succeeds.

    Hadoop's own local file system looks before it creates, so there Java's file
    system, which does both in one step, is asked.
    """
    target, system = _place(spark, path)
    jvm = spark._jvm
    system.mkdirs(target.getParent())
    try:
        if system.getUri().getScheme() == "file":
            own = jvm.java.io.File(system.makeQualified(target).toUri().getPath())
            return own.createNewFile()
        system.create(target, False).close()
    except Py4JJavaError as err:
        if not _caused_by(err, "FileAlreadyExistsException"):
            raise
        return False
    return True


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete files or folders, named by path or by URI."""
    for name in paths:
        target, system = _place(spark, name)
        system.delete(target, True)
