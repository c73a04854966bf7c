"""Draw the documents that look most like a target text, by importance weights and Gumbel noise.

Words, word pairs and triples are hashed to buckets. The gain of a bucket is the scaled log ratio of its
share in the target to its share in all documents; the weight of a document is the sum of the gains of its
features, its score adds noise that depends on the document alone. The documents with the highest scores
are a draw without replacement in proportion to their weights.

1. One job per table counts the buckets (one array per task); the driver holds the ``BUCKETS`` gains.
2. One job scores all documents by array lookups. Its table, a few numbers per document, is stored.
3. The cutoff score is found by bisection: jobs that count the documents at or above a score, exactly. Each
   job counts at the 15 scores that the next four halvings may ask for. Documents tied at the cutoff are cut
   by a second bisection over doc_id.
4. Only drawn rows are sorted, range-partitioned by (score, doc_id), to number them.

Defined cases: a null or empty text has no features, weight 0 and no part in the draw; a null doc_id is
hashed as the empty text and comes after all others among ties; of repeated rows at the very end of the
draw as many are drawn as still fit; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scopewise.llm.batches import encoded, map_batches, pieces
from scopewise.llm.runs import blocks
from scopewise.operators.ranking import add_position
from scopewise.session import materialize

#: Buckets of the feature hash.
BUCKETS = 10_000
#: Seed of the noise.
SEED = 42
#: Documents of fewer words are not drawn.
MIN_WORDS = 20
#: Share of the documents that is drawn, in percent.
PERCENT = 5
#: Interior points that one counting job tries: those of four halvings.
_POINTS = 15
#: Features whose buckets are added up at once.
_MANY = 1 << 20

#: A-Z lowered, a-z, 0-9 and all bytes beyond ASCII kept, every other byte a space.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def features(data: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the features that end in them) of a text, block by block."""
    last_one: list[int] = []
    last_two: list[int] = []
    for block in blocks(data.translate(_WORD_BYTES)):
        words = block.split()
        if not words:
            continue
        follow = [b" " + word for word in words]
        ones = list(map(crc32, words))
        before = last_one + ones
        twos = list(map(crc32, follow[1 - len(last_one) :], before))
        pairs = last_two + twos
        threes = list(map(crc32, follow[2 - len(last_one) - len(last_two) :], pairs))
        last_one, last_two = before[-1:], pairs[-1:]
        yield len(words), np.array(ones + twos + threes, np.uint32) % np.uint32(BUCKETS)


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    held, size = [], 0
    for piece in pieces(batches):
        for data in encoded(piece):
            for _, found in features(data):
                held.append(found)
                size += len(found)
                if size >= _MANY:
                    total += np.bincount(np.concatenate(held), minlength=BUCKETS)
                    held, size = [], 0
    if held:
        total += np.bincount(np.concatenate(held), minlength=BUCKETS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features per bucket over all texts; one number per bucket reaches the driver."""
    found = (
        texts.select("text")
        .transform(map_batches, _count, "bucket long, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    counts = np.zeros(BUCKETS, np.int64)
    counts[found["bucket"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Scaled log ratio of target to source per bucket, one added to every count."""
    all_source, all_target = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * all_source / ((s + 1.0) * all_target)))
            for s, t in zip(source.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def _weigh(batches: Iterable[pa.RecordBatch], gain: np.ndarray) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        rows = []
        for data in encoded(piece):
            n_words = n_features = weight = 0
            for words, found in features(data):
                n_words += words
                n_features += len(found)
                weight += int(gain[found].sum())
            rows.append((n_words, n_features, weight))
        n_words, n_features, weight = (pa.array(column, pa.int64()) for column in zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), n_words, n_features, weight], ["doc_id", "n_words", "n_features", "weight"]
        )


def noise(seed: int = SEED) -> Column:
    """Standard Gumbel noise of a document in thousandths, from the hash of its doc_id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def scores(docs: DataFrame, target: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row of ``docs`` (doc_id, text)."""
    gain = gains(bucket_counts(docs), bucket_counts(target))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    weighed = docs.select("doc_id", "text").transform(
        map_batches,
        lambda batches: _weigh(batches, gain),
        f"doc_id {id_type}, n_words long, n_features long, weight long",
    )
    return weighed.withColumn("score", F.col("weight") + noise(seed))


def _bisect(low: int, high: int, enough: Callable[[list[int]], list[bool]]) -> int:
    """The largest number from ``low`` to below ``high`` that is enough; all up to it are, none beyond."""
    while high - low > 1:
        points = sorted({low + (high - low) * i // (_POINTS + 1) for i in range(1, _POINTS + 1)} - {low})
        found = enough(points)
        low = max([low, *(p for p, fits in zip(points, found, strict=True) if fits)])
        high = min([high, *(p for p, fits in zip(points, found, strict=True) if not fits)])
    return low


def _counts_where(rows: DataFrame, conditions: list[Column]) -> list[int]:
    return list(rows.agg(*(F.count_if(c).alias(f"c{i}") for i, c in enumerate(conditions))).first())


def draw(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """Add ``rank`` (1, 2 ... by falling score, ties to smaller doc_id; null where not drawn).

    ``scored`` should be stored: it is read once per counting job.
    """
    may = scored.where(F.col("n_words") >= min_words)
    n, least, most = may.agg(F.count("*"), F.min("score"), F.max("score")).first()
    wanted = percent * n // 100
    undrawn = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return scored.select("*", undrawn)

    def reached(points: list[int]) -> list[bool]:
        return [c >= wanted for c in _counts_where(may, [F.col("score") >= p for p in points])]

    cutoff = _bisect(least, most + 1, reached)
    above, tied, tied_ids, first, last = may.agg(
        F.count_if(F.col("score") > cutoff),
        F.count_if(F.col("score") == cutoff),
        F.count_if((F.col("score") == cutoff) & F.col("doc_id").isNotNull()),
        F.min(F.when(F.col("score") == cutoff, F.col("doc_id"))),
        F.max(F.when(F.col("score") == cutoff, F.col("doc_id"))),
    ).first()
    open_places = wanted - above
    level = F.col("score") == cutoff
    if open_places < tied and open_places <= tied_ids:

        def too_few(points: list[int]) -> list[bool]:
            found = _counts_where(may, [level & (F.col("doc_id") < p) for p in points])
            return [c < open_places for c in found]

        level &= F.col("doc_id") <= _bisect(first, last + 1, too_few)
    taken = F.coalesce((F.col("n_words") >= min_words) & ((F.col("score") > cutoff) | level), F.lit(False))
    placed = add_position(
        scored.where(taken).withColumns({"_fall": -F.col("score"), "_last": F.col("doc_id").isNull()}),
        ["_fall", "_last", "doc_id"],
        "rank",
    ).drop("_fall", "_last")
    placed = placed.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    return scored.where(~taken).select("*", undrawn).unionByName(placed)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED
) -> DataFrame:
    """Scores of all rows of ``docs`` and the ranks of the ``percent`` percent that are drawn."""
    return draw(materialize(scores(docs, target, seed), "resample-scores"), percent, min_words)
