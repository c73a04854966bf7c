"""Near-duplicate documents by min-max hashing.

Every permutation of the shingles of a document gives two signature values, its minimum and its maximum;
either agrees between two documents with the probability of their Jaccard similarity. So half as many
permutations are evaluated for a signature of the same length. Bands of the signature put documents into
buckets.

Links are confirmed on the full shingle sets (128 bits per shingle, made from exact or cryptographic
codes of its words), and no pair within a component is looked at twice:

1. Documents with equal sets collapse to the smallest doc_id.
2. In every bucket each document is compared with the smallest one only. This joins nearly all groups.
3. Where a bucket still holds several components, the documents outside its largest component are
   compared with all others of the bucket, so that no link between components is missed. Blocks of both
   sides meet in tasks, which look at a pair in the first bucket that its documents share, skip what is
   connected already, and return links only, never pairs.

The number of bands and the least agreement of signatures of a pair that is compared follow from the
threshold (``sizes``): the chance to miss a pair at it is below 1e-5 in all bands, and below 1e-6 by the
agreement.

Defined cases: texts without words are linked with nothing; a row without doc_id is linked with nothing,
has no component and is kept; repeated rows of a document are one document, and each gets a row; other
columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scopewise.llm.batches import encoded, map_batches, pieces
from scopewise.llm.components import components
from scopewise.llm.shingles import common, mix, shingle_digests
from scopewise.session import discard, materialize

#: Permutations per band (each gives a minimum and a maximum).
PERMUTATIONS = 3
#: Link documents whose sets have this similarity, in percent, unless a caller names another.
PERCENT = 85
#: Documents compared with one document by one task.
BLOCK = 256
#: Chances to miss a pair at the threshold: in all bands, and by the agreement of signatures.
MISSED_BANDS, MISSED_AGREEMENT = 1e-5, 1e-6


@functools.cache
def sizes(percent: int) -> tuple[int, float]:
    """Bands, and the least share of equal signature values of a pair that is compared.

    Minimum and maximum of a permutation agree together least often in small sets, where they are drawn
    from few shingles; bands are counted for the worst size.
    """
    if not 50 < percent < 100:
        raise ValueError(f"a similarity of {percent} percent is not between 50 and 100")
    common = {union: -(-percent * union // 100) for union in range(2, 1000)}
    both = min(n * (n - 1) / (union * (union - 1)) for union, n in common.items())
    bands = math.ceil(math.log(MISSED_BANDS) / math.log(1 - both**PERMUTATIONS))
    values, share, missed, least = 2 * PERMUTATIONS * bands, percent / 100, 0.0, 0
    while True:
        ways = math.lgamma(values + 1) - math.lgamma(least + 1) - math.lgamma(values - least + 1)
        missed += math.exp(ways + least * math.log(share) + (values - least) * math.log(1 - share))
        if missed >= MISSED_AGREEMENT:
            return bands, least / values
        least += 1


BANDS = sizes(PERCENT)[0]


@functools.cache
def _permutations(bands: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and shifts."""
    rnd = np.random.default_rng(20_240_601)
    factors = rnd.integers(1, 1 << 62, bands * PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
    return factors, rnd.integers(0, 1 << 62, bands * PERMUTATIONS, np.uint64)


def signatures(sets: list[np.ndarray], bands: int = BANDS) -> np.ndarray:
    """Minimum and maximum of every permutation, one row per non-empty set."""
    flat = np.concatenate(sets)
    lengths = np.fromiter(map(len, sets), np.int64, len(sets))
    starts = np.cumsum(lengths) - lengths
    factors, shifts = _permutations(bands)
    out = np.empty((len(sets), 2 * len(factors)), np.uint64)
    for i, (factor, shift) in enumerate(zip(factors, shifts, strict=True)):
        permuted = flat * factor + shift
        out[:, 2 * i] = np.minimum.reduceat(permuted, starts)
        out[:, 2 * i + 1] = np.maximum.reduceat(permuted, starts)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One number per band and document, different between bands."""
    width = 2 * PERMUTATIONS
    bands = signature.shape[1] // width
    keys = np.empty((len(signature), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(signature), band + 1, np.uint64)
        for value in range(width):
            key = mix(key * np.uint64(31) + signature[:, band * width + value])
        keys[:, band] = key
    return keys.view(np.int64)


SIGNED = "doc_id long, n_shingles long, set_hash string, bands array<long>, sketch binary"


def _sign(batches: Iterable[pa.RecordBatch], n_bands: int = BANDS) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, limit=1 << 20):
        sets = shingle_digests(encoded(piece))
        full = [i for i, (own, _) in enumerate(sets) if len(own)]
        bands: list = [None] * len(sets)
        sketches: list = [None] * len(sets)
        if full:
            signature = signatures([sets[i][0] for i in full], n_bands)
            for i, keys, short in zip(full, band_keys(signature), (signature >> np.uint64(47)).astype(np.uint16), strict=True):
                bands[i], sketches[i] = keys, short.tobytes()
        digests = [hashlib.sha256(b"".join(half.tobytes() for half in own)).hexdigest()[:40] if len(own[0]) else None for own in sets]
        yield pa.RecordBatch.from_arrays(
            [
                piece.column("doc_id"),
                pa.array([len(own) for own, _ in sets], pa.int64()),
                pa.array(digests, pa.string()),
                pa.array(bands, pa.list_(pa.int64())),
                pa.array(sketches, pa.binary()),
            ],
            ["doc_id", "n_shingles", "set_hash", "bands", "sketch"],
        )


def _agreeing(batches: Iterable[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches agree in this share of their values."""
    for batch in batches:
        if batch.num_rows:
            one, two = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1)
                for c in ("sketch_a", "sketch_b")
            )
            enough = (one == two).mean(axis=1) >= least
            yield batch.filter(pa.array(enough)).select(["a", "b"])


def _packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(3)
    for piece in pieces(batches):
        rows = [packer.compress(content) for content in encoded(piece)]
        yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(rows, pa.binary())], ["doc_id", "packed"])


def _sets(rows: Iterable[bytes], unpacker: zstandard.ZstdDecompressor) -> list[tuple[np.ndarray, np.ndarray]]:
    return shingle_digests([unpacker.decompress(row) for row in rows])


def _confirm(key: tuple, one: pd.DataFrame, others: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Whether document a is linked with each b of a block."""
    unpacker = zstandard.ZstdDecompressor()
    if not len(one) or not len(others):
        return pd.DataFrame({"a": [], "b": [], "linked": []}).astype({"a": int, "b": int, "linked": bool})
    (own,) = _sets(one["own"][:1], unpacker)
    linked = []
    for begin in range(0, len(others), 64):
        for other in _sets(others["packed"][begin : begin + 64], unpacker):
            both = common(own, other)
            linked.append(100 * both >= percent * (len(own[0]) + len(other[0]) - both))
    return pd.DataFrame({"a": key[0], "b": others["b"].to_numpy(), "linked": linked})


def confirm(pairs: DataFrame, packed: DataFrame, signed: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b, linked) of pairs of documents, after the agreement of sketches.

    Pairs are dealt by document a and blocks of partners, so that a document with very many partners is
    compared by many tasks.
    """
    sketch = signed.select("doc_id", "sketch")
    least = sizes(percent)[1]
    promising = materialize(
        pairs.join(sketch.toDF("a", "sketch_a"), "a")
        .join(sketch.toDF("b", "sketch_b"), "b")
        .select("a", "b", "sketch_a", "sketch_b")
        .transform(map_batches, lambda batches: _agreeing(batches, least), "a long, b long"),
        "near-pairs",
    )
    blocks = promising.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    dealt = promising.join(blocks, "a").select("a", "b", F.pmod(F.xxhash64("b"), "blocks").alias("block"))
    left = blocks.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        F.col("a").alias("doc_id"), "block"
    )
    ones = left.join(packed, "doc_id").select(
        F.col("doc_id").alias("a"), "block", F.col("packed").alias("own")
    )
    others = dealt.withColumnRenamed("b", "doc_id").join(packed, "doc_id").select(
        "a", F.col("doc_id").alias("b"), "block", "packed"
    )
    return (
        ones.groupBy("a", "block")
        .cogroup(others.groupBy("a", "block"))
        .applyInPandas(lambda key, one, two: _confirm(key, one, two, percent), "a long, b long, linked boolean")
    )


def _rows(packed: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sketches and band keys of the documents of a block, as matrices."""
    sketch = np.frombuffer(b"".join(packed["sketch"]), np.uint16).reshape(len(packed), -1)
    return sketch, np.array(packed["bands"].tolist(), np.int64).reshape(len(packed), -1)


def _link_blocks(key: tuple, left: pd.DataFrame, right: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links between documents of two blocks of a bucket that join different components."""
    if not len(left) or not len(right):
        return pd.DataFrame({"a": [], "b": []}).astype(int)
    bucket, least = key[0], sizes(percent)[1]
    (one, one_bands), (two, two_bands) = _rows(left), _rows(right)
    x, y = left["doc_id"].to_numpy(), right["doc_id"].to_numpy()
    cx, cy = left["component"].to_numpy(), right["component"].to_numpy()
    n, m = left["n"].to_numpy(), right["n"].to_numpy()
    in_main = (right["component"] == right["main"]).to_numpy()
    pairs: list[tuple[float, int, int]] = []
    for i in range(len(left)):
        agreement = (one[i] == two).mean(axis=1)
        shared = one_bands[i] == two_bands
        first = one_bands[i][shared.argmax(axis=1)] == bucket
        fits = 100 * np.minimum(n[i], m) >= percent * np.maximum(n[i], m)
        wanted = first & fits & (cx[i] != cy) & (in_main | (y > x[i])) & (agreement >= least)
        pairs += [(-agreement[j], i, j) for j in np.flatnonzero(wanted).tolist()]
    unpacker = zstandard.ZstdDecompressor()
    sets: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    above: dict[int, int] = {}

    def root(label: int) -> int:
        while above.get(label, label) != label:
            label = above[label]
        return label

    def shingles(side: int, i: int) -> tuple[np.ndarray, np.ndarray]:
        if (side, i) not in sets:
            (sets[side, i],) = _sets([(left, right)[side]["packed"].iat[i]], unpacker)
        return sets[side, i]

    links = []
    for _, i, j in sorted(pairs):  # the likeliest first
        if root(cx[i]) != root(cy[j]):
            both = common(shingles(0, i), shingles(1, j))
            if 100 * both >= percent * (n[i] + m[j] - both):
                above[root(cx[i])] = root(cy[j])
                links.append((x[i], y[j]))
    return pd.DataFrame(links, columns=["a", "b"]).astype(int)


def link_open_buckets(rows: DataFrame, signed: DataFrame, packed: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b) links between the components of buckets.

    ``rows`` are (bucket, doc_id, n, component, main) of buckets that hold more than their main component.
    """
    outside = F.col("component") != F.col("main")
    blocks = rows.groupBy("bucket").agg(
        F.ceil(F.count_if(outside) / BLOCK).alias("left_blocks"), F.ceil(F.count("*") / BLOCK).alias("right_blocks")
    )
    sized = rows.join(blocks, "bucket")
    content = signed.select("doc_id", "bands", "sketch").join(packed, "doc_id")

    def dealt(part: DataFrame, own: str, other: str, blocks: str, others: str) -> DataFrame:
        return (
            part.withColumn(own, F.pmod(F.xxhash64("doc_id"), F.col(blocks)))
            .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(others) - 1)))
            .select("bucket", "i", "j", "doc_id", "n", "component", "main")
            .join(content, "doc_id")
        )

    left = dealt(sized.where(outside), "i", "j", "left_blocks", "right_blocks")
    right = dealt(sized, "j", "i", "right_blocks", "left_blocks")
    right = right.toDF(*right.columns)
    return (
        left.groupBy("bucket", "i", "j")
        .cogroup(right.groupBy("bucket", "i", "j"))
        .applyInPandas(lambda key, one, two: _link_blocks(key, one, two, percent), "a long, b long")
    )


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    Documents whose shingle sets have a similarity of ``percent`` or more are linked; the smallest doc_id
    of a component stays.
    """
    n_bands, _ = sizes(percent)
    slim = docs.select(F.col("doc_id").cast("long"), "text")
    signed = materialize(slim.transform(map_batches, lambda batches: _sign(batches, n_bands), SIGNED), "signed")
    groups = (
        signed.where("doc_id IS NOT NULL AND n_shingles > 0")
        .groupBy("set_hash")
        .agg(F.min("doc_id").alias("first_id"))
    )
    groups = materialize(groups, "set-groups")
    firsts = groups.select(F.col("first_id").alias("doc_id"))
    reps = materialize(signed.join(firsts, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "near-reps")
    packed = slim.transform(map_batches, _packed, "doc_id long, packed binary").join(firsts, "doc_id", "left_semi")

    rows = reps.select("doc_id", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    smallest = rows.groupBy("bucket").agg(F.min("doc_id").alias("a"), F.count("*").alias("size")).where("size > 1")
    crowded = materialize(rows.join(smallest.drop("size"), "bucket"), "near-buckets")
    stars = crowded.where("doc_id <> a").select("a", F.col("doc_id").alias("b")).distinct()
    tested = materialize(confirm(stars, packed, reps, percent), "near-tested")
    links = tested.where("linked").select("a", "b")
    labels = components(links)

    own = F.coalesce("component", "doc_id").alias("component")
    placed = crowded.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("bucket", "doc_id", "n", own)
    parts = placed.groupBy("bucket", "component").agg(F.count("*").alias("size"))
    mixed = parts.groupBy("bucket").agg(F.max_by("component", F.struct("size", "component")).alias("main"), F.count("*").alias("parts"))
    open_rows = materialize(placed.join(mixed.where("parts > 1").drop("parts"), "bucket"), "near-open")
    more = materialize(link_open_buckets(open_rows, reps, packed, percent).distinct(), "near-rest")
    if not more.isEmpty():
        labels = components(links.union(more))
    discard(crowded, tested, open_rows, more, reps)
    return (
        signed.select("doc_id", "n_shingles", "set_hash")
        .join(groups, "set_hash", "left")
        .join(labels.toDF("first_id", "component"), "first_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("component", "first_id", "doc_id").alias("component_id"),
        )
        .select("*", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )
