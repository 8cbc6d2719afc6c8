"""The few file-system calls the sinks need, through Hadoop's FileSystem API."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def written(spark: SparkSession, path: str) -> bool:
    """True when a Spark write to the folder has been committed."""
    return exists(spark, f"{path}/_SUCCESS")


def children(spark: SparkSession, path: str) -> list[str]:
    p, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def first_line(spark: SparkSession, path: str) -> str:
    """The one line of a text, which is a file or a folder that Spark has written: read without a job."""
    p, fs = _path(spark, path)
    if fs.getFileStatus(p).isDirectory():
        parts = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith("part-") and s.getLen()]
        p = parts[0]
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split("\n")[0]
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def land(spark: SparkSession, parts: str, column: str, number: int, folder: str) -> None:
    """Move the files below `parts/<column>=0`, `=1` and so on, one each, to `folder`, in that order by name and by
    time of change. A number that has none gets a copy of the file below `parts/empty`."""
    there, fs = _path(spark, folder)
    fs.mkdirs(there)
    path, copy = spark._jvm.org.apache.hadoop.fs.Path, spark._jvm.org.apache.hadoop.fs.FileUtil.copy
    found = {}
    for part in fs.globStatus(path(f"{parts}/{column}=*/part-*")):
        k = int(part.getPath().getParent().getName().removeprefix(f"{column}="))
        if k in found:
            raise ValueError(f"{part.getPath()} is not the only file of its number")
        found[k] = part
    (empty,) = fs.globStatus(path(f"{parts}/empty/part-*"))
    newest = max(part.getModificationTime() for part in found.values())
    for k in range(number):
        place = path(f"{folder}/part-{k:09d}.parquet")
        if k not in found:
            copy(fs, empty.getPath(), fs, place, False, spark._jsc.hadoopConfiguration())
        elif not fs.rename(found[k].getPath(), place):
            raise OSError(f"cannot land {place}")
        # A renamed file may keep the time it was written at; stores without such a call take that of the move.
        fs.setTimes(place, newest - number + k, -1)
