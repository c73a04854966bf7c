"""File inventories, content hashes and manifests.

Spark's own file sources skip names that start with "_" or "." and load a
binary file as one cell.  An inventory must have such names and files of any
size, so folders are listed and files are hashed in tasks, through the file
system API of Arrow: all folders that are known at once, then those below them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scopewise.session import materialize, ship_package

CHUNK_BYTES = 1 << 20
#: A task goes on below a folder until it has seen so many entries there.
ENTRIES_PER_FOLDER = 200

FILE_SCHEMA = "relative_path string, size_bytes bigint, sha256 string"
ENTRY_SCHEMA = "relative_path string, is_folder boolean, size_bytes bigint"

MANIFEST_ENTRY = T.StructType(
    [
        T.StructField("file_name", T.StringType()),
        T.StructField("relative_path", T.StringType()),
        T.StructField("sha256", T.StringType()),
        T.StructField("size_bytes", T.LongType()),
    ]
)
MANIFEST_SCHEMA = T.StructType(
    [T.StructField("files", T.MapType(T.StringType(), MANIFEST_ENTRY))]
)


def location(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a location; bare and ``file:`` paths are local."""
    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        path = unquote(parsed.path) if parsed.scheme else uri
        return fs.LocalFileSystem(), path.rstrip("/")
    scheme = "s3" if parsed.scheme in ("s3a", "s3n") else parsed.scheme
    filesystem, path = fs.FileSystem.from_uri(scheme + uri[len(parsed.scheme) :])
    return filesystem, path.rstrip("/")


def list_folders(batches: Iterator[pd.DataFrame], root: str, include_hidden: bool = True) -> Iterator[pd.DataFrame]:
    """The files of every folder, and the folders below it that are still to list.

    Small folders are listed as deep as ``ENTRIES_PER_FOLDER`` entries last, so
    a small tree takes one job; what is left is dealt to tasks again.
    """
    filesystem, base = location(root)

    def hidden(path: str) -> bool:
        return not include_hidden and path.rpartition("/")[2].startswith(".")

    for batch in batches:
        for folder in batch["relative_path"]:
            listed, waiting, seen = [], [folder], 0
            while waiting and seen < ENTRIES_PER_FOLDER:
                path = waiting.pop()
                found = filesystem.get_file_info(fs.FileSelector(f"{base}/{path}" if path else base))
                seen += len(found) + 1
                for entry in found:
                    name = entry.path[len(base) + 1 :]
                    if hidden(name):
                        continue
                    if entry.type == fs.FileType.Directory:
                        waiting.append(name)
                    else:
                        listed.append((name, False, entry.size or 0))
            yield pd.DataFrame(
                [*listed, *((name, True, 0) for name in waiting)],
                columns=["relative_path", "is_folder", "size_bytes"],
            ).astype({"is_folder": bool, "size_bytes": "int64"})


def hash_files(batches: Iterator[pd.DataFrame], root: str) -> Iterator[pd.DataFrame]:
    """SHA-256 of each file, read in chunks; the empty path is the root itself."""
    filesystem, base = location(root)

    def sha256(path: str) -> str:
        digest = hashlib.sha256()
        with filesystem.open_input_stream(path, compression=None) as stream:
            while chunk := stream.read(CHUNK_BYTES):
                digest.update(chunk)
        return digest.hexdigest()

    for batch in batches:
        yield batch.assign(sha256=[sha256(f"{base}/{path}") for path in batch["relative_path"]])


def _tasks(spark: SparkSession) -> int:
    """A path is a few bytes, the work behind it is not: a number that adaptive execution leaves alone."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def list_files(spark: SparkSession, root: str, include_hidden: bool = False) -> DataFrame:
    """Relative path and size of all files below ``root``.

    The driver learns no path: it starts jobs until no folder is left to list.
    """
    ship_package(spark)
    filesystem, base = location(root)
    kind = filesystem.get_file_info(base).type
    if kind == fs.FileType.NotFound:
        raise FileNotFoundError(f"There is nothing to list at {root}.")
    if kind == fs.FileType.File:
        name = base.rpartition("/")[2]
        size = filesystem.get_file_info(base).size
        return spark.range(1).select(F.lit(name).alias("relative_path"), F.lit(size).cast("bigint").alias("size_bytes"))
    folders = spark.range(1).select(F.lit("").alias("relative_path"))
    levels = []
    while True:
        listed = folders.repartition(_tasks(spark), "relative_path").mapInPandas(
            lambda batches: list_folders(batches, root, include_hidden), ENTRY_SCHEMA
        )
        level = materialize(listed, "listing")
        levels.append(level.where("NOT is_folder").select("relative_path", "size_bytes"))
        folders = level.where("is_folder").select("relative_path")
        if folders.isEmpty():
            break
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    return found


def inventory(spark: SparkSession, root: str, include_hidden: bool = False) -> DataFrame:
    """Relative path, size and SHA-256 of all files below ``root``.

    Sort by ``path_order()`` for the order of a file tree.
    """
    listed = list_files(spark, root, include_hidden)
    filesystem, base = location(root)
    if filesystem.get_file_info(base).type == fs.FileType.File:
        root = root.rstrip("/").rpartition("/")[0] or "/"
    return listed.repartition(_tasks(spark), "relative_path").mapInPandas(
        lambda batches: hash_files(batches, root), FILE_SCHEMA
    )


def path_order() -> Column:
    """Sort key of a file tree: folder by folder."""
    return F.split("relative_path", "/")


def content_hash(col: Column) -> Column:
    """SHA-256 of text or binary content, computed in the JVM."""
    return F.sha2(col, 256)


def manifest_rows(manifests: DataFrame, *keep: str) -> DataFrame:
    """The ``files`` map of manifest documents as one row per file."""
    exploded = manifests.select(*keep, F.explode("files").alias("file_key", "entry"))
    return exploded.select(
        *keep,
        "file_key",
        F.coalesce("entry.relative_path", "entry.file_name").alias("relative_path"),
        F.col("entry.size_bytes").alias("size_bytes"),
        F.col("entry.sha256").alias("sha256"),
    )


def read_manifest_rows(spark: SparkSession, path) -> DataFrame:
    """Listed files of JSON manifests, one document per file."""
    return manifest_rows(spark.read.schema(MANIFEST_SCHEMA).option("multiLine", True).json(path))
