"""Files and folders through the session's Hadoop file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


_CLASSES: dict[str, tuple] = {}


def java_class(spark: SparkSession, name: str):
    """A class of the JVM; looked up once, as each part of its name is a call."""
    jvm = spark.sparkContext._jvm
    if _CLASSES.get(name, (None,))[0] is not jvm:
        found = jvm
        for part in name.split("."):
            found = getattr(found, part)
        _CLASSES[name] = (jvm, found)
    return _CLASSES[name][1]


def fs_path(spark: SparkSession, path: str):
    p = java_class(spark, "org.apache.hadoop.fs.Path")(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = fs_path(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = fs_path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def swap_folder(spark: SparkSession, new: str, path: str) -> None:
    """Put the folder ``new`` in the place of ``path``, which is then deleted.
    If it can't be put there, ``path`` is as before."""
    fs, at = fs_path(spark, path)
    _, ready = fs_path(spark, new)
    _, old = fs_path(spark, f"{new}.old")
    held = fs.exists(at)
    if held and not fs.rename(at, old):
        raise OSError(f"cannot move {path} away")
    if not fs.rename(ready, at):
        if held:
            fs.rename(old, at)
        raise OSError(f"cannot move {new} to {path}")
    if held:
        fs.delete(old, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = fs_path(spark, path)
    fs.mkdirs(p)


def path_bytes(spark: SparkSession, path: str) -> int:
    fs, p = fs_path(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def list_children(spark: SparkSession, path: str) -> list[str]:
    fs, p = fs_path(spark, path)
    if not fs.exists(p):
        return []
    # one call for all names: folders of a stream have thousands
    paths = java_class(spark, "org.apache.hadoop.fs.FileUtil").stat2Paths(fs.listStatus(p))
    paths = java_class(spark, "scala.collection.immutable.ArraySeq").unsafeWrapArray(paths)
    return [x.rsplit("/", 1)[-1] for x in paths.mkString("\0").split("\0") if x]


def rename_file(spark: SparkSession, path: str, to: str) -> None:
    fs, p = fs_path(spark, path)
    if not fs.rename(p, fs_path(spark, to)[1]):
        raise OSError(f"cannot rename {path} to {to}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = fs_path(spark, path)
    stream = fs.open(p)
    try:
        return java_class(spark, "org.apache.commons.io.IOUtils").toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all: written aside, then renamed."""
    fs, p = fs_path(spark, path)
    _, aside = fs_path(spark, f"{path}.tmp")
    stream = fs.create(aside, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    fs.rename(aside, p)
