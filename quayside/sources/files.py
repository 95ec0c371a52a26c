"""Small files of the lake's own, through the file system that Spark uses for a path."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, system = _path(spark, path)
    return system.exists(hadoop)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The file's text, None where there is no file."""
    hadoop, system = _path(spark, path)
    if not system.exists(hadoop):
        return None
    stream = system.open(hadoop)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write beside the file and move over it, so that a reader sees the old text or the new one."""
    target, system = _path(spark, path)
    beside, _ = _path(spark, f"{path}.new")
    system.mkdirs(target.getParent())
    stream = system.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(system.makeQualified(beside), system.makeQualified(target), options)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new file; its folder is made if need be."""
    target, system = _path(spark, path)
    system.mkdirs(target.getParent())
    stream = system.create(target, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename to a path that must not exist; False if it does."""
    old, system = _path(spark, source)
    new, _ = _path(spark, target)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(system.makeQualified(old), system.makeQualified(new), options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        return False
    return True


def move(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to a path that does not exist; the folder above it is made if need be."""
    old, system = _path(spark, source)
    new, _ = _path(spark, target)
    system.mkdirs(new.getParent())
    if not system.rename(old, new):
        raise OSError(f"{source} could not be moved to {target}")


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no folder."""
    hadoop, system = _path(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(hadoop)) if system.exists(hadoop) else []


def modified(spark: SparkSession, path: str) -> float:
    """When the file or folder was last changed, in seconds."""
    hadoop, system = _path(spark, path)
    return system.getFileStatus(hadoop).getModificationTime() / 1000


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files in a folder."""
    hadoop, system = _path(spark, path)
    return system.getContentSummary(hadoop).getLength()


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all in it."""
    hadoop, system = _path(spark, path)
    system.delete(hadoop, True)


def make_folder(spark: SparkSession, path: str) -> None:
    hadoop, system = _path(spark, path)
    system.mkdirs(hadoop)
