"""One digest for a set of files, as the root of a hash tree, and proofs of single files.

A leaf is the hash of path, size and SHA-256 of a file. Leaves stand in the order of their paths; ``FAN_OUT``
neighbours are hashed together to one node of the next level, until one is left. Levels are built by
grouping in tasks, so the number of files does not matter, and two sets have the same root only if they
have the same paths, sizes and contents.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scopewise.operators.ranking import add_position
from scopewise.session import materialize

#: Nodes that are hashed together.
FAN_OUT = 64


def leaves(files: DataFrame) -> DataFrame:
    """(relative_path, level, position, hash) of ``files`` (relative_path, size_bytes, sha256).

    Paths are told apart byte by byte; each must occur once.
    """
    path = F.col("relative_path")
    # The length of the path keeps it apart from what follows.
    text = F.concat_ws(
        "|", F.lit("file"), F.octet_length(path).cast("string"), path, F.col("size_bytes").cast("string"), F.col("sha256")
    )
    hashed = files.select("relative_path", F.sha2(text.cast("binary"), 256).alias("hash"))
    numbered = add_position(hashed, ["relative_path"])
    return numbered.select("relative_path", F.lit(0).alias("level"), (F.col("position") - 1).alias("position"), "hash")


def _node(hashes: Column) -> Column:
    return F.sha2(F.concat(F.lit("node"), F.concat_ws("", hashes)).cast("binary"), 256)


def tree(files: DataFrame, fan_out: int = FAN_OUT) -> DataFrame:
    """All nodes (relative_path of leaves, level, position, hash) of the tree over ``files``; stored.

    A table without files has the root of no leaves: the hash of an empty node.
    """
    level = materialize(leaves(files), "leaves")
    whole, number, rows = level, 0, level.count()
    if not rows:
        root = files.sparkSession.range(1).select(F.array().cast("array<string>").alias("none"))
        return root.select(
            F.lit(None).cast("string").alias("relative_path"),
            F.lit(0).alias("level"),
            F.lit(0).cast("long").alias("position"),
            _node(F.col("none")).alias("hash"),
        )
    while rows > 1:
        number += 1
        children = F.array_sort(F.collect_list(F.struct("position", "hash")))
        above = (
            level.groupBy(F.floor(F.col("position") / fan_out).alias("position"))
            .agg(children.alias("children"))
            .select(
                F.lit(None).cast("string").alias("relative_path"),
                F.lit(number).alias("level"),
                "position",
                _node(F.col("children.hash")).alias("hash"),
            )
        )
        level = materialize(above, "nodes")
        whole, rows = whole.unionByName(level), -(-rows // fan_out)
    return whole


def root(nodes: DataFrame) -> str:
    """The digest of a tree: the hash of its topmost node."""
    return nodes.orderBy(F.desc("level")).select("hash").first()["hash"]


def prove(nodes: DataFrame, relative_path: str, fan_out: int = FAN_OUT) -> list[tuple[int, list[str]]]:
    """What shows that a file belongs to the root: per level, the place of its node among those hashed with it.

    A proof has ``fan_out`` hashes per level, however many files there are.
    """
    leaf = nodes.where((F.col("level") == 0) & (F.col("relative_path") == relative_path)).first()
    if leaf is None:
        raise KeyError(relative_path)
    top = nodes.agg(F.max("level")).first()[0]
    near = F.lit(False)
    for level in range(top):
        group = leaf["position"] // fan_out ** (level + 1)
        near |= (F.col("level") == level) & (F.floor(F.col("position") / fan_out) == group)
    found: dict[int, list] = {level: [] for level in range(top)}
    for row in nodes.where(near).select("level", "position", "hash").collect():
        found[row["level"]].append((row["position"], row["hash"]))
    return [
        (leaf["position"] // fan_out**level % fan_out, [h for _, h in sorted(found[level])]) for level in range(top)
    ]


def proves(
    proof: list[tuple[int, list[str]]], digest: str, relative_path: str, size_bytes: int, sha256: str
) -> bool:
    """Whether a proof leads from a file to the digest of a tree."""
    path = relative_path.encode()
    hashed = hashlib.sha256(b"|".join([b"file", str(len(path)).encode(), path, str(size_bytes).encode(), sha256.encode()]))
    current = hashed.hexdigest()
    for place, hashes in proof:
        if hashes[place] != current:
            return False
        current = hashlib.sha256(("node" + "".join(hashes)).encode()).hexdigest()
    return current == digest
