"""Immutable numbered commit records in a shared folder.

A record is one file ``c=<number>``, written aside and moved to its name only
if no other writer took that number before; it is never changed. A reader sees
a record whole or not at all, and of two writers of one number the second
fails. The folder's file system must move files atomically (HDFS does).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, folder: str) -> list[str]:
    """Entries of a folder; none where it does not exist. Any other failure is raised."""
    fs, p = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def size(spark: SparkSession, folder: str) -> int:
    """Bytes of the files below a folder; 0 where it does not exist."""
    fs, p = _fs(spark, folder)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def commit(spark: SparkSession, folder: str, number: int, record: dict) -> None:
    """Publish ``record`` as ``number``; raises where the number is taken."""
    fs, aside = _fs(spark, f"{folder}/_{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    out.write(json.dumps(record, sort_keys=True).encode("utf-8"))
    out.close()
    fs_package = spark._jvm.org.apache.hadoop.fs
    place = fs.makeQualified(fs_package.Path(f"{folder}/c={number:012d}"))
    never_over = spark.sparkContext._gateway.new_array(fs_package.Options.Rename, 1)
    never_over[0] = fs_package.Options.Rename.NONE
    try:
        fs_package.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration()) \
            .rename(fs.makeQualified(aside), place, never_over)
    except Exception as e:
        fs.delete(aside, False)
        raise FileExistsError(f"commit {number} of {folder} was made by another writer") from e


def read(spark: SparkSession, folder: str, number: int) -> tuple[int, dict]:
    text = spark.read.text(f"{folder}/c={number:012d}", wholetext=True).first()[0]
    return number, json.loads(text)


def latest(spark: SparkSession, folder: str) -> tuple[int, dict] | None:
    """The commit of the largest number, or None before the first: one listing and one small file."""
    found = [n for n in names(spark, folder) if n.startswith("c=")]
    return read(spark, folder, int(found[-1][2:])) if found else None
