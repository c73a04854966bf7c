"""Staged publication: a package is written aside, checked there, and then put in its place.

Output goes to a folder of its own beside the target. When it is complete, its parts are renamed into the
target, the commit record (the manifest) last. So a target without a manifest is uncommitted: readers find no
package in it, and the next run replaces what a broken one has left. A committed package is never touched.
Renames go through Hadoop's file system API, so every location that Spark can write to can be published to.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: The part that is moved last; a package is committed if it has it.
COMMIT = "manifest"


def _path(spark: SparkSession, name: str):
    """A Hadoop path and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, name: str) -> bool:
    path, system = _path(spark, name)
    return system.exists(path)


def _delete(spark: SparkSession, name: str) -> None:
    path, system = _path(spark, name)
    system.delete(path, True)


def _move(spark: SparkSession, source: str, target: str) -> None:
    path, system = _path(spark, source)
    goal, _ = _path(spark, target)
    system.mkdirs(goal.getParent())
    if not system.rename(path, goal):
        raise OSError(f"{source} could not be renamed to {target}.")


def is_committed(spark: SparkSession, out: str) -> bool:
    """Whether a folder holds a whole package."""
    return _exists(spark, f"{out.rstrip('/')}/{COMMIT}")


def require_committed(spark: SparkSession, out: str) -> None:
    if not is_committed(spark, out):
        raise FileNotFoundError(f"There is no manifest below {out}.")


def _require_uncommitted(spark: SparkSession, out: str) -> None:
    if is_committed(spark, out):
        raise FileExistsError(f"There already is a package at {out}.")


@contextmanager
def staged(spark: SparkSession, out: str, parts: Sequence[str]) -> Iterator[str]:
    """A folder to write ``parts`` and the manifest to; they are moved to ``out`` when the block ends well.

    A block that breaks leaves ``out`` as it was. A run that dies while it moves parts leaves ``out``
    uncommitted, and the next run replaces them.
    """
    out = out.rstrip("/")
    _require_uncommitted(spark, out)
    folder = f"{out}.staging-{uuid.uuid4().hex}"
    try:
        yield folder
        _require_uncommitted(spark, out)
        for part in (*parts, COMMIT):
            _delete(spark, f"{out}/{part}")
            _move(spark, f"{folder}/{part}", f"{out}/{part}")
    finally:
        _delete(spark, folder)
