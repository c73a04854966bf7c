"""Spelling variants: words that differ by one character, and the frequent form of each.

1. Tasks cut all texts into runs of letters and count them; counts are added up before and after one shuffle.
2. Two words that differ by one character agree in the first half of either or in the second. Every word is
   dealt to bins by its halves, once as the word that asks and once as one that may be found by words one
   character shorter, equally long, or longer. Halves shared by more than ``hot_words`` words are split:
   what remains between the equal parts is halved again, and one of its halves must agree too. This ends with
   one character, so no bin grows with a frequent half.
3. A bin builds an FM-index of its words (``fmindex``), in the direction that starts with the equal half, and
   searches all its words with one error in the other half. It returns a count and the best form per word, no
   pairs: a pair is counted in the one place where it agrees in the first part that it can agree in.
4. Forms grow tenfold in frequency at every step, so chains are short; pointer jumping finds their ends.

Defined cases: null and empty texts have no words; a null doc_id counts as the empty text; repeated rows count
as often as they occur; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scopewise.llm import fmindex
from scopewise.llm.batches import encoded, give_back, map_batches, pieces
from scopewise.llm.runs import blocks
from scopewise.session import materialize, scratch_tables, ship_package

#: Code points and occurrences that a word must have.
MIN_LENGTH, MIN_COUNT = 7, 2
#: A form is at least this many times as frequent as the word.
FORM_FACTOR = 10
#: One run in so many loses a character.
DAMAGE = 31
#: Words that may share a half in one bin; more are split by a further part.
HOT_WORDS = 1 << 15
#: Rows that a bin has on average.
BIN_ROWS = 1 << 16
#: Distinct words that a task counts before it gives them on.
_COUNTED = 200_000

#: a-z kept, every other byte a space (lowered ASCII texts).
_ASCII_LETTERS = bytes(b if 97 <= b <= 122 else 32 for b in range(256))
_RUNS = re.compile("[a-zÀ-ÿ]+")


def long_runs(data: bytes, least: int) -> Iterator[list[bytes]]:
    """Runs of A-Z, a-z and U+00C0 to U+00FF with at least ``least`` characters, A-Z lowered, in blocks."""
    for block in blocks(data.lower()):
        if block.isascii():
            yield [run for run in block.translate(_ASCII_LETTERS).split() if len(run) >= least]
        else:
            yield [run.encode() for run in _RUNS.findall(block.decode()) if len(run) >= least]


def damaged(run: bytes, h: int) -> bytes:
    """The run without the character that the hash points at."""
    text = run.decode()
    at = h % len(text)
    return (text[:at] + text[at + 1 :]).encode()


def _count(batches: Iterable[pa.RecordBatch], damage: int, least: int) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def give() -> pa.RecordBatch:
        found = [word.decode() for word in counts]
        batch = pa.RecordBatch.from_arrays(
            [pa.array(found, pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
        )
        counts.clear()
        return batch

    for piece in pieces(batches):
        for doc_id, data in zip(piece.column("doc_id").to_pylist(), encoded(piece), strict=True):
            start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for runs in long_runs(data, least):
                if damage:
                    hashes = np.fromiter(map(crc32, runs, repeat(start)), np.int64, len(runs))
                    for i in np.flatnonzero(hashes % damage == 0).tolist():
                        runs[i] = damaged(runs[i], int(hashes[i]))
                counts.update(runs)
                if len(counts) >= _COUNTED:
                    yield give()
    if counts:
        yield give()


def vocabulary(
    docs: DataFrame, damage: int = DAMAGE, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT
) -> DataFrame:
    """(word, n): the distinct words of ``docs`` (doc_id, text) and how often each occurs."""
    return (
        docs.select("doc_id", "text")
        .transform(map_batches, lambda batches: _count(batches, damage, min_length), "word string, n long")
        .where(F.char_length("word") >= min_length)
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= min_count)
    )


# Bins


def _places(words: DataFrame) -> DataFrame:
    """Rows of words under their halves: ``text`` ends with the equal part, ``of`` is the length that asks."""
    forward = F.struct(F.lit(False).alias("forward"), F.reverse("word").alias("text"))
    backward = F.struct(F.lit(True).alias("forward"), F.col("word").alias("text"))
    length = F.char_length("word")
    return (
        words.select("n", F.explode(F.array(forward, backward)).alias("way"), length.alias("length"))
        .select("n", "way.*", "length", F.explode(F.array(*(F.col("length") + d for d in (-1, 0, 1)))).alias("of"))
        .withColumn("tail", F.when(F.col("forward"), F.ceil((F.col("of")) / 2)).otherwise(F.floor(F.col("of") / 2)))
        .withColumns({"tail": F.col("tail").cast("int"), "head": F.lit(0), "not_tail": F.lit(0)})
        .transform(_with_key)
    )


def _with_key(rows: DataFrame) -> DataFrame:
    parts = F.expr("right(text, tail)"), F.expr("left(text, head)")
    return rows.withColumn("key", F.xxhash64("forward", "of", "tail", "head", "not_tail", *parts))


def _split(rows: DataFrame, hot_words: int) -> DataFrame:
    """Split keys with more than ``hot_words`` rows until none is left that can be."""
    hole = F.col("of") - F.col("tail") - F.col("head")
    while True:
        hot = rows.where(hole > 1).groupBy("key").count().where(F.col("count") > hot_words).select("key")
        hot = materialize(hot, "hot-halves")
        if hot.isEmpty():
            return rows
        rest = rows.join(hot, "key", "left_anti")
        longer = F.col("tail") + (hole / 2).cast("int")
        more = rows.join(hot, "key", "left_semi")
        by_tail = more.withColumn("tail", longer)
        by_head = more.withColumns({"head": F.col("of") - longer, "not_tail": longer})
        deeper = by_tail.unionByName(by_head).transform(_with_key)
        rows = materialize(rest.unionByName(deeper), "halves")


def _shared(a: str, b: str, tail: int, head: int) -> bool:
    return a[len(a) - tail :] == b[len(b) - tail :] and a[:head] == b[:head]


def _search_bin(rows: pa.Table) -> pa.Table:
    """Number of near words and the best one for every row that asks."""
    _, group, sizes = np.unique(rows.column("key").to_numpy(), return_inverse=True, return_counts=True)
    rows = rows.filter(pa.array(sizes[group] > 1))
    n_of = dict(zip(rows.column("text").to_pylist(), rows.column("n").to_pylist(), strict=True))
    forward = rows.num_rows > 0 and rows.column("forward")[0].as_py()
    asking = rows.filter(pa.array(rows.column("of").to_numpy() == rows.column("length").to_numpy()))
    found: dict[int, list] = {}
    if asking.num_rows:
        texts, tails, heads, not_tails = (
            asking.column(c).to_pylist() for c in ("text", "tail", "head", "not_tail")
        )
        index = fmindex.build(sorted(n_of))
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        # Words equal in both halves but for the place between them are found from the first half alone.
        first_half = (lengths // 2).tolist()
        exact = lengths - lengths // 2 if forward else lengths // 2
        for query, number in zip(*(a.tolist() for a in fmindex.one_error(index, texts, exact)), strict=True):
            text, near = texts[query], index.words[number]
            if not _shared(text, near, tails[query], heads[query]):
                continue
            if not_tails[query] and _shared(text, near, not_tails[query], 0):
                continue
            if forward and _shared(text, near, 0, first_half[query]):
                continue
            word = near if forward else near[::-1]
            best = found.setdefault(query, [0, 0, word])
            best[0] += 1
            best[1:] = min(best[1:], [-n_of[near], word])
    words = [texts[q] if forward else texts[q][::-1] for q in found]
    near, falling, form = zip(*found.values(), strict=True) if found else ((), (), ())
    give_back()
    return pa.table(
        [pa.array(words, pa.string()), pa.array(near, pa.int64()), pa.array(falling, pa.int64()), pa.array(form, pa.string())],
        ["word", "n_near", "falling", "near"],
    )


def near_words(words: DataFrame, hot_words: int = HOT_WORDS, bin_rows: int = BIN_ROWS) -> DataFrame:
    """(word, n_near, near, near_n) of the words (word, n; stored) that have near words.

    ``near`` is the one that occurs most; ties go to the smallest in code point order.
    """
    ship_package(words.sparkSession)
    bins = 1 + 6 * words.count() // bin_rows
    rows = _split(_places(words), hot_words)
    bin_of = F.struct("forward", F.pmod("key", F.lit(bins)))
    return (
        rows.groupBy(bin_of.alias("bin"))
        .applyInArrow(_search_bin, "word string, n_near long, falling long, near string")
        .groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), F.min(F.struct("falling", "near")).alias("best"))
        .select("word", "n_near", "best.near", (-F.col("best.falling")).alias("near_n"))
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of forms of every word of ``forms`` (word, form)."""
    ends = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ends = materialize(
            ends.select("word", "root")
            .join(further, "root", "left")
            .select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "roots",
        )
        if ends.where("moved").isEmpty():
            return ends.select("word", "root")


def variants(
    docs: DataFrame,
    damage: int = DAMAGE,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    factor: int = FORM_FACTOR,
    hot_words: int = HOT_WORDS,
    bin_rows: int = BIN_ROWS,
) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of ``docs`` (doc_id, text).

    ``damage=0`` takes the texts as they are; otherwise one run in ``damage`` loses a character. ``min_length``
    is at least 2, so that both halves of a word have a character.
    """
    with scratch_tables() as keep:
        words = keep(materialize(vocabulary(docs, damage, max(2, min_length), min_count), "vocabulary"))
        near = keep(materialize(near_words(words, hot_words, bin_rows), "near-words"))
        frequent = F.col("near_n") >= factor * F.col("n")
        formed = keep(
            materialize(
                words.join(near, "word", "left").select(
                    "word",
                    "n",
                    F.coalesce("n_near", F.lit(0)).alias("n_near"),
                    F.when(frequent, F.col("near")).alias("form"),
                    F.when(frequent, F.col("near_n")).alias("form_n"),
                ),
                "forms",
            )
        )
        roots = keep(materialize(_roots(formed.where("form is not null").select("word", "form")), "word-roots"))
    return formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
