"""Listings and small files in the store that a path names, by the file system that Spark itself would use."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, *parts: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(*parts)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path as listings give it: with its store, without a slash at its end."""
    at, store = _at(spark, path)
    return store.makeQualified(at).toString()


def listed(spark: SparkSession, folder: str, pattern: str) -> list[tuple[str, int, int]]:
    """(path, length, time of the last change) of the files that match, by path."""
    path, store = _at(spark, folder, pattern)
    return sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in store.globStatus(path) or [])


def exists(spark: SparkSession, path: str) -> bool:
    at, store = _at(spark, path)
    return store.exists(at)


def complete(spark: SparkSession, table: str) -> bool:
    """Whether a job that wrote the table came to its end."""
    return exists(spark, f"{table}/_SUCCESS")


def read_bytes(spark: SparkSession, path: str) -> bytes:
    at, store = _at(spark, path)
    data = store.open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(data))
    finally:
        data.close()


def read_text(spark: SparkSession, path: str) -> str:
    return read_bytes(spark, path).decode("utf-8")


def input_file(path: str):
    """A file that a task can read at any place, in the store that its URI names."""
    from pyarrow import fs

    store, at = (fs.LocalFileSystem(), path.removeprefix("file:")) if path.startswith(("file:", "/")) else fs.FileSystem.from_uri(path)
    return store.open_input_file(at)


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Written beside its place and then moved there, so a reader finds all of it or nothing. No checksum stays: people may edit it."""
    at, store = _at(spark, path)
    aside, _ = _at(spark, f"{path}.new")
    store.setWriteChecksum(False)
    try:
        out = store.create(aside, True)
        try:
            out.write(bytearray(data))
        finally:
            out.close()
    finally:
        store.setWriteChecksum(True)
    if store.exists(at):
        store.delete(at, False)
    if not store.rename(aside, at):
        raise OSError(f"{path} couldn't be written")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    write_bytes(spark, path, text.encode("utf-8"))


def move(spark: SparkSession, path: str, to: str) -> None:
    at, store = _at(spark, path)
    if not store.rename(at, _at(spark, to)[0]):
        raise OSError(f"{path} couldn't be moved to {to}")


def remove(spark: SparkSession, path: str) -> None:
    at, store = _at(spark, path)
    store.delete(at, True)
