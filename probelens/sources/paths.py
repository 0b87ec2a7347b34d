"""Paths as the file system knows them, and the folder shared by a cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs, fs.makeQualified(p)


def qualified(spark: SparkSession, path: str) -> str:
    """One spelling per place: scheme, authority, no ``.``, ``..`` or doubled slashes."""
    _, p = _hadoop(spark, path)
    uri = p.toUri().normalize()
    return str(uri.toString()).replace("file:///", "file:/").rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return bool(fs.exists(p))


def inside(spark: SparkSession, path: str, other: str) -> bool:
    """Whether ``path`` is ``other`` or lies in it, or the other way round."""
    a, b = qualified(spark, path) + "/", qualified(spark, other) + "/"
    return a.startswith(b) or b.startswith(a)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's content; None where it does not exist."""
    fs, p = _hadoop(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return str(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not exist yet."""
    fs, p = _hadoop(spark, path)
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def replace_file(spark: SparkSession, source: str, target: str) -> None:
    """Move ``source`` to ``target`` in one step: readers find the old file or the new one."""
    jvm = spark.sparkContext._jvm
    _, src = _hadoop(spark, source)
    _, dst = _hadoop(spark, target)
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(src.toUri(), conf).rename(src, dst, how)


def move_to_new(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to a place that must not exist yet."""
    fs, src = _hadoop(spark, source)
    _, dst = _hadoop(spark, target)
    if fs.exists(dst):
        raise FileExistsError(f"output exists, write to a new place: {target}")
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"could not move {source} to {target}")


def make_folder(spark: SparkSession, path: str) -> str:
    fs, p = _hadoop(spark, path)
    fs.mkdirs(p)
    return path


def refuse_existing(spark: SparkSession, *paths: str) -> None:
    """A job writes to new places only, so what was there before stays readable."""
    found = [p for p in paths if exists(spark, p)]
    if found:
        raise FileExistsError(f"output exists, write to a new place: {', '.join(found)}")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; it has to be named by the session."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        raise ValueError("name a folder that all executors share: spark.checkpoint.dir or setCheckpointDir()")
    return found.rstrip("/")
