"""Partition folders of a stored table: list and drop, on any file system Spark writes to."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import SparkSession

# Folder value that Spark writes for a null key.
HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"


def _path(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, files = _path(spark, path)
    return files.exists(target)


def list_partitions(spark: SparkSession, path: str, keys: Sequence[str]) -> list[dict[str, str]]:
    """Key values of the partition folders (names only, no data is read)."""
    target, files = _path(spark, "/".join([path, *[f"{key}=*" for key in keys]]))
    found = []
    for status in files.globStatus(target) or []:
        names = status.getPath().toString().rstrip("/").split("/")[-len(keys):]
        found.append({name.split("=", 1)[0]: unquote(name.split("=", 1)[1]) for name in names})
    return sorted(found, key=lambda values: tuple(values.values()))


def partition_files(spark: SparkSession, path: str,
                    values: Mapping[str, str]) -> dict[tuple[str, ...], set[str]]:
    """Names of the files of every partition that fits the key values (``*`` fits any), from one
    listing; every write gives its files new names."""
    target, files = _path(spark, "/".join([path, *[f"{k}={v}" for k, v in values.items()], "*"]))
    found: dict[tuple[str, ...], set[str]] = {}
    for status in files.globStatus(target) or []:
        *_, name = parts = status.getPath().toString().split("/")[-len(values) - 1:]
        key = tuple(unquote(part.split("=", 1)[1]) for part in parts[:-1])
        found.setdefault(key, set()).add(name)
    return found


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it; a missing one is no error."""
    target, files = _path(spark, path)
    files.delete(target, True)


def replace_folder(spark: SparkSession, new: str, old: str) -> None:
    """Put a finished folder in the place of another one, by a rename."""
    source, files = _path(spark, new)
    target, _ = _path(spark, old)
    files.delete(target, True)
    if not files.rename(source, target):
        raise OSError(f"cannot move {new} to {old}")


def drop_partition(spark: SparkSession, path: str, values: Mapping[str, str]) -> None:
    drop_folder(spark, "/".join([path, *[f"{k}={v}" for k, v in values.items()]]))
