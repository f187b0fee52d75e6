"""Driver-side metadata operations on the shared file system: listing, small
text files, and log entries that appear whole or not at all."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def subfolders(spark: SparkSession, folder: str, prefix: str = "", finished: bool = False) -> list[str]:
    """Names of a folder's subfolders, those with a ``_SUCCESS`` marker if asked."""
    fs, path = _at(spark, folder)
    if not fs.exists(path):
        return []
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return [st.getPath().getName() for st in fs.listStatus(path)
            if st.isDirectory() and st.getPath().getName().startswith(prefix)
            and (not finished or fs.exists(marker(st.getPath(), "_SUCCESS")))]


def file_names(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _at(spark, folder)
    return [st.getPath().getName() for st in fs.listStatus(path) if st.isFile()] if fs.exists(path) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def commit_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under another name and rename it, so readers see the
    whole file or none."""
    fs, p = _at(spark, path)
    _, temp = _at(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}.tmp")
    out = fs.create(temp, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if not fs.rename(temp, p):
        raise OSError(f"could not commit {path}")


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def order_slices(spark: SparkSession, folder: str, prefix: str) -> set[int]:
    """Give the data files below ``<folder>/<prefix><n>/`` times in the order of
    n, by which a file stream takes them up, whatever task wrote them first.
    Returns the numbers of files that slices have. The file system must keep
    the times it is given (local, HDFS)."""
    found, sizes = subfolders(spark, folder, prefix), set()
    for n, name in enumerate(sorted(found, key=lambda x: int(x[len(prefix):]))):
        fs, path = _at(spark, f"{folder}/{name}")
        files, each = fs.listFiles(path, True), 0
        while files.hasNext():
            st = files.next()
            if not st.getPath().getName().startswith(("_", ".")):
                fs.setTimes(st.getPath(), 1_000_000_000_000 + n * 60_000, -1)
                each += 1
        sizes.add(each)
    return sizes


class Log:
    """Numbered JSON entries in a folder. The highest number is the current
    state: writing an entry is what switches readers to a new version. One
    writer at a time, as a streaming query has."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in file_names(self.spark, self.folder) if n.endswith(".json") and n[:-5].isdigit())

    def entry(self, number: int | None = None) -> dict | None:
        """The entry of that number, or the newest (none: null)."""
        numbers = self.numbers()
        if not numbers or (number is not None and number not in numbers):
            return None
        return json.loads(read_text(self.spark, f"{self.folder}/{numbers[-1] if number is None else number:020d}.json"))

    def commit(self, number: int, entry: dict) -> None:
        commit_text(self.spark, f"{self.folder}/{number:020d}.json", json.dumps(entry))

    def drop(self, number: int) -> None:
        remove(self.spark, f"{self.folder}/{number:020d}.json")
