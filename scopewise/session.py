"""Session helpers: builder defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import weakref
import zipfile
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import partial
from pathlib import Path

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "scopewise", cores: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder.

    Executors must all see the folder, so a machine-local one is accepted for
    a local master only.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("Set spark.checkpoint.dir to a folder all executors share.")
        base = tempfile.mkdtemp(prefix="scopewise-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def together(spark: SparkSession, *jobs: Callable[[], object]) -> None:
    """Run independent jobs at the same time and wait for all; the first error is raised.

    Short jobs then share the cluster instead of waiting for each other's last task.
    """
    if not jobs:
        return
    with ThreadPoolExecutor(min(len(jobs), 8)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    for job in running:
        job.result()


#: Tables that ``materialize`` wrote and nobody has emptied yet.
_live: dict[str, SparkSession] = {}
_path_of: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    The stored table cuts the lineage: values that depend on how a run split
    its data (row positions) stay the same for every later reader, and a lost
    executor costs one file read instead of a recomputation.
    """
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    _live[path] = df.sparkSession
    _path_of[stored] = path
    return stored


def _empty(path: str) -> None:
    if spark := _live.pop(path, None):
        spark.range(0).write.mode("overwrite").parquet(path)


def discard(*stored: DataFrame) -> None:
    """Empty tables that ``materialize`` returned and that nothing will read again."""
    for df in stored:
        if path := _path_of.pop(df, None):
            _empty(path)


@contextmanager
def scratch_tables() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Empty all tables stored inside when the block ends, but those passed to what it yields."""
    before, kept = set(_live), set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(_path_of[df])
        return df

    try:
        yield keep
    finally:
        paths = set(_live) - before - kept
        if paths:
            together(_live[min(paths)], *[partial(_empty, path) for path in paths])


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give executors this package, once per application; they may have no copy on their path."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="scopewise-")) / "scopewise.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as file:
        for source in sorted(package.rglob("*.py")):
            file.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
