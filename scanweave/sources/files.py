"""Small text files on any file system Spark reaches, replaced as a whole."""

import time
import uuid
from datetime import timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return system, system.makeQualified(target)


def _write_beside(spark: SparkSession, system, target, text: str):
    """The text in a hidden file of the target's folder."""
    beside = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_new-{uuid.uuid4().hex}")
    stream = system.create(beside)
    stream.write(bytearray(text.encode()))
    stream.close()
    return beside


def _rename(spark: SparkSession, system, source, target, overwrite: bool) -> None:
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE if overwrite else rename.NONE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        system.getUri(), spark._jsc.hadoopConfiguration()
    )
    context.rename(source, target, options)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace the file: readers find the old text or the new one."""
    system, target = _located(spark, path)
    _rename(spark, system, _write_beside(spark, system, target, text), target, overwrite=True)


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file with all its text, unless it exists; whether this call created it.

    Of several callers one succeeds, on file systems whose rename refuses an existing target. A local
    folder has no such rename; there a link takes its place.
    """
    system, target = _located(spark, path)
    beside = _write_beside(spark, system, target, text)
    try:
        if target.toUri().getScheme() == "file":
            paths = spark._jvm.java.nio.file.Path
            own, goal = (paths.of(place.toUri()) for place in (beside, target))
            spark._jvm.java.nio.file.Files.createLink(goal, own)
        else:
            _rename(spark, system, beside, target, overwrite=False)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    finally:
        system.delete(beside, False)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all it holds; nothing if it is not there."""
    system, target = _located(spark, path)
    system.delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _located(spark, path)
    return system.exists(target)


def make_folder(spark: SparkSession, path: str) -> None:
    """Make sure that the folder is there."""
    system, target = _located(spark, path)
    system.mkdirs(target)


def move_files(spark: SparkSession, source: str, target: str, prefix: str) -> None:
    """Move the files below a folder to the same places below another, under names that begin with `prefix`.

    Repeated after a stop half-way, it moves what is left; a file that is in both places is replaced.
    """
    system, folder = _located(spark, source)
    found = system.listFiles(folder, True)
    while found.hasNext():
        path = found.next().getPath()
        if path.getName().startswith(("_", ".")):
            continue
        below = path.getParent().toString().removeprefix(folder.toString())
        _, goal = _located(spark, f"{target}{below}/{prefix}{path.getName()}")
        system.mkdirs(goal.getParent())
        system.delete(goal, False)
        if not system.rename(path, goal):
            raise OSError(f"could not move {path} to {goal}")


def age(spark: SparkSession, path: str) -> timedelta:
    """Time since the file or folder last changed."""
    system, target = _located(spark, path)
    return timedelta(milliseconds=time.time() * 1000 - system.getFileStatus(target).getModificationTime())


def read_text(spark: SparkSession, path: str) -> str:
    system, target = _located(spark, path)
    stream = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder, hidden ones left out; none if there is no folder."""
    system, target = _located(spark, folder)
    if not system.exists(target):
        return []
    found = [status.getPath().getName() for status in system.listStatus(target)]
    return sorted(name for name in found if not name.startswith(("_", ".")))


def move_backdated(spark: SparkSession, source: str, target: str, age: timedelta) -> None:
    """Move the files below a folder, dated back by `age`: an arrival that was long under way."""
    system, folder = _located(spark, source)
    found = system.listFiles(folder, True)
    while found.hasNext():
        status = found.next()
        path = status.getPath()
        if path.getName().startswith(("_", ".")):
            continue
        system.setTimes(path, status.getModificationTime() - age // timedelta(milliseconds=1), -1)
        _, goal = _located(spark, target + path.toString().removeprefix(folder.toString()))
        system.mkdirs(goal.getParent())
        system.rename(path, goal)
