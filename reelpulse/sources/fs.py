"""Names in whatever store holds a path (Hadoop's FileSystem, which Spark itself
uses): listing, removal, small text files and atomic renames.  Tables are read and
written by Spark."""

from __future__ import annotations

import hashlib
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, store = _open(spark, path)
    return store.exists(where)


def _children(spark: SparkSession, path: str):
    where, store = _open(spark, path)
    try:
        return store.listStatus(where)
    except Py4JJavaError as err:
        if "FileNotFoundException" in str(err.java_exception):
            return []
        raise


def list_dirs(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, modification time in ms) of the directories directly below
    ``path``; empty when it does not exist."""
    return [(s.getPath().getName(), s.getModificationTime()) for s in _children(spark, path) if s.isDirectory()]


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, modification time in ms) of the files directly below ``path``."""
    return [(s.getPath().getName(), s.getModificationTime()) for s in _children(spark, path) if not s.isDirectory()]


def remove(spark: SparkSession, path: str) -> None:
    where, store = _open(spark, path)
    store.delete(where, True)


def read_text(spark: SparkSession, path: str) -> str:
    where, store = _open(spark, path)
    stream = store.open(where)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    where, store = _open(spark, path)
    stream = store.create(where, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def rename_new(spark: SparkSession, old: str, new: str) -> bool:
    """Move ``old`` to ``new`` in one step unless ``new`` exists (then False)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    source, store = _open(spark, old)
    source = store.makeQualified(source)
    target = store.makeQualified(jvm.org.apache.hadoop.fs.Path(new))
    if target.getParent() is not None:
        store.mkdirs(target.getParent())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(conf).rename(source, target, none)
        return True
    except Py4JJavaError as err:
        if "FileAlreadyExistsException" in str(err.java_exception) or store.exists(target):
            return False
        raise


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """A file that did not exist before, with its whole text, or False."""
    folder, name = path.rsplit("/", 1)
    if exists(spark, path):
        return False
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    write_text(spark, draft, text)
    if rename_new(spark, draft, path):
        return True
    remove(spark, draft)
    return False


def fingerprint(spark: SparkSession, files: list[str]) -> str:
    """A short key of files' names, lengths and modification times."""
    seen = []
    for name in sorted(files):
        where, store = _open(spark, name)
        status = store.getFileStatus(where)
        seen.append(f"{name} {status.getLen()} {status.getModificationTime()}")
    return hashlib.sha256("\n".join(seen).encode()).hexdigest()[:16]
