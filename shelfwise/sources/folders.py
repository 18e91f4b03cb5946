"""Folders and small text files in whatever file system a path names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

DONE = "_SUCCESS"


def _opened(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    return hadoop, root, root.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_names(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names below ``path`` that begin with ``prefix``; none if there is no such folder."""
    _, root, fs = _opened(spark, path)
    if not fs.exists(root):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(root))
    return sorted(n for n in names if n.startswith(prefix))


def finished_folders(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names of the folders below ``path`` that a writer has finished, from one listing."""
    hadoop, root, fs = _opened(spark, path)
    found = fs.globStatus(hadoop.Path(root, f"{prefix}*/{DONE}")) or []
    return sorted(status.getPath().getParent().getName() for status in found)


def complete_folders(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The numbers of the finished folders ``<path>/<prefix><n>``, ascending."""
    return sorted(int(name.removeprefix(prefix)) for name in finished_folders(spark, path, prefix))


def remove_folder(spark: SparkSession, path: str) -> None:
    _, target, fs = _opened(spark, path)
    fs.delete(target, True)


def mark_finished(spark: SparkSession, path: str) -> None:
    """Say that all of a folder is written, for what several writes fill."""
    hadoop, root, fs = _opened(spark, path)
    fs.create(hadoop.Path(root, DONE), True).close()


def write_lines(spark: SparkSession, path: str, lines: Iterable[str]) -> None:
    """A small text file, replaced as a whole."""
    _, target, fs = _opened(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray("".join(f"{line}\n" for line in lines).encode()))
    finally:
        out.close()


def read_lines(spark: SparkSession, path: str) -> list[str] | None:
    """The lines of a small text file, None if there is no such file."""
    _, target, fs = _opened(spark, path)
    if not fs.exists(target):
        return None
    source = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8").splitlines()
    finally:
        source.close()


def file_states(spark: SparkSession, pattern: str) -> list[tuple[str, int, int]]:
    """(path, bytes, time of change) of all files that a path, folder or pattern names."""
    _, root, fs = _opened(spark, pattern)
    states = []
    for status in fs.globStatus(root) or []:
        files = fs.listFiles(status.getPath(), True)
        while files.hasNext():
            file = files.next()
            states.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return sorted(states)
