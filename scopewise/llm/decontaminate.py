"""Benchmark decontamination: size-partitioned MinHash containment search, with DataFrame functions only.

A test item is found in a document if the document holds ``MIN_CONTAINMENT`` of the item's distinct
five-word shingles, wherever they stand. Words are runs of characters other than space and 0x09 to 0x0D,
A-Z lowered. An item of one to four words has one shingle, all its words; documents are then read in
shingles of that many words too, so that such an item is found wherever its words stand together.

1. Documents keep only shingles that some item has. Containment does not change by this, and what is left
   is small. The join is a broadcast while the shingles of all items take at most ``BROADCAST_BYTES``,
   and a shuffle beyond that.
2. Items are partitioned by size into powers of two. For every size class a document is read in
   overlapping windows of twice the class's upper bound, so that an item is at least a quarter as large as
   the window that contains it, and MinHash values agree often enough to be found. Windows hold shingles
   of one length only.
3. Window and item that share a MinHash value of their class are a candidate. With ``HASHES`` values the
   chance to miss an item at the threshold is below 2e-6.
4. Candidates are verified by the exact share of the item's shingles, as texts, in the whole document.

Defined cases: null or wordless texts contain nothing and are found nowhere; rows without an id cannot be
named and are left out; repeated rows are one document or item; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scopewise.session import materialize

SHINGLE_WORDS = 5
MIN_CONTAINMENT = 0.8
#: MinHash values per window and item.
HASHES = 64
#: Bytes of the shingles of all items, with ``ROW_BYTES`` for each, up to which they are broadcast.
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 64
#: Positions of shingles of different lengths in a document are this far apart.
_APART = 1 << 40

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    plain = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(plain, "[\\x20\\x09-\\x0D]+"), "")


def _rows(split: DataFrame, key: str, size: int, starts: Column, offset: int = 0) -> DataFrame:
    """(key, position, w0..w4, code) of the runs of ``size`` words; words that a run lacks are null."""
    names = [f"w{i}" for i in range(SHINGLE_WORDS)]
    zipped = F.arrays_zip(*(F.slice("w", F.lit(i + 1), starts) for i in range(size))).cast(
        "array<struct<" + ",".join(f"{name}:string" for name in names[:size]) + ">>"
    )
    rows = split.select(key, F.posexplode(zipped).alias("position", "s")).select(
        key,
        (F.col("position").cast("long") + offset).alias("position"),
        *(F.col("s")[name].alias(name) for name in names[:size]),
        *(F.lit(None).cast("string").alias(name) for name in names[size:]),
    )
    return rows.withColumn("code", F.xxhash64(*names))


def _split(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias(key), words(F.col("text")).alias("w"))


def item_rows(items: DataFrame) -> DataFrame:
    """Shingles of five words of every item, or all its words if it has fewer."""
    starts = F.greatest(F.size("w") - (SHINGLE_WORDS - 1), F.least(F.size("w"), F.lit(1)))
    return _rows(_split(items, "item_id"), "item_id", SHINGLE_WORDS, starts)


def document_rows(docs: DataFrame, short: list[int]) -> DataFrame:
    """Shingles of five words of every document, and those of each length in ``short``."""
    split = _split(docs, "doc_id")
    rows = None
    for size in [SHINGLE_WORDS, *short]:
        starts = F.greatest(F.size("w") - (size - 1), F.lit(0))
        more = _rows(split, "doc_id", size, starts, (SHINGLE_WORDS - size) * _APART)
        rows = more if rows is None else rows.union(more)
    return rows


def shingle_text() -> Column:
    """The words of a shingle in one text; a word holds no space."""
    return F.concat_ws(" ", *(f"w{i}" for i in range(SHINGLE_WORDS)))


def _sketch(rows: DataFrame, *group: str) -> DataFrame:
    """(group, place, value): the smallest value of every hash over the shingles of a group."""
    smallest = [F.min(F.xxhash64("shingle", F.lit(i))).alias(f"h{i}") for i in range(HASHES)]
    wide = rows.groupBy(*group).agg(*smallest)
    return wide.select(*group, F.posexplode(F.array(*(f"h{i}" for i in range(HASHES)))).alias("place", "value"))


def find_items(docs: DataFrame, items: DataFrame, min_containment: float = MIN_CONTAINMENT) -> DataFrame:
    """doc_id, item_id, n_common, n_item and containment of every item found in a document."""
    n_words = sum((F.col(f"w{i}").isNotNull().cast("int") for i in range(SHINGLE_WORDS)), F.lit(0)).alias("n_words")
    own = item_rows(items).select("item_id", "code", shingle_text().alias("shingle"), n_words).distinct()
    sized = own.join(own.groupBy("item_id").agg(F.count("*").alias("n_item")), "item_id")
    bound = F.pow(F.lit(2), F.floor(F.log2("n_item")) + 1).cast("long")
    sized = materialize(sized.withColumn("bound", bound), "item-shingles")
    known = sized.select("code", F.col("shingle").alias("text"), "bound").distinct()
    if (sized.agg(F.sum(F.octet_length("shingle") + ROW_BYTES)).first()[0] or 0) <= BROADCAST_BYTES:
        known = F.broadcast(known)
    # at most four lengths
    short = sorted(r[0] for r in sized.where(F.col("n_words") < SHINGLE_WORDS).select("n_words").distinct().collect())
    hits = materialize(
        document_rows(docs, short)
        .join(known, "code")
        .where(F.col("text") == shingle_text())
        .select("doc_id", "position", "bound", F.col("text").alias("shingle")),
        "document-shingles",
    )
    at = F.floor(F.col("position") / F.col("bound"))
    windows = hits.withColumn("window", F.explode(F.array(at - 1, at)))
    found = (
        _sketch(windows, "doc_id", "bound", "window")
        .join(_sketch(sized, "item_id", "bound"), ["bound", "place", "value"])
        .select("doc_id", "item_id")
        .distinct()
    )
    common = (
        found.join(sized, "item_id")
        .join(hits.select("doc_id", "shingle").distinct(), ["doc_id", "shingle"])
        .groupBy("doc_id", "item_id")
        .agg(F.count("*").alias("n_common"), F.first("n_item").alias("n_item"))
    )
    return common.withColumn("containment", F.col("n_common") / F.col("n_item")).where(
        F.col("containment") >= min_containment
    )
