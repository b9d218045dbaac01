"""Tables that are replaced whole: every version in a folder of its own, which appears under its name when it is complete.

A reader takes the newest version and sees either the old table or the new one. Publishing is one rename, which the file
system makes atomic (HDFS, local disks; not every object store). One writer at a time: a second one that publishes the
same version fails.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

_VERSION = re.compile(r"version-(\d{6,})")


def _at(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """The published versions, oldest first."""
    folder, files = _at(spark, path)
    if not files.exists(folder):
        return []
    names = [str(status.getPath().getName()) for status in files.listStatus(folder)]
    return sorted(int(found[1]) for name in names if (found := _VERSION.fullmatch(name)))


def _folder(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/version-{version:06d}"


def part(spark: SparkSession, path: str, name: str) -> str | None:
    """The folder `name` of the newest version; None if nothing was published or it has no such part."""
    found = versions(spark, path)
    if not found:
        return None
    folder, files = _at(spark, f"{_folder(path, found[-1])}/{name}")
    return str(folder) if files.exists(folder) else None


def publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """write(folder) the parts of the next version, then publish it. What a failed writer left behind is not read."""
    target = _folder(path, max([0, *versions(spark, path)]) + 1)
    staged, files = _at(spark, f"{path.rstrip('/')}/_staged-{uuid.uuid4().hex}")
    files.mkdirs(staged)
    write(str(staged))
    final, _ = _at(spark, target)
    if files.exists(final) or not files.rename(staged, final):
        raise FileExistsError(f"{target} was published meanwhile")
    return target


def drop_old(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete all but the newest `keep` versions (1 at least); a job that still reads an older one fails."""
    for version in versions(spark, path)[: -max(1, keep)]:
        folder, files = _at(spark, _folder(path, version))
        files.delete(folder, True)
