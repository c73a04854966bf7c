"""Language identification: script ranges, word scores, and a Viterbi path over the words.

A model holds, per language, log probabilities of hashed character trigrams and the scripts that the
language is written in. Every word is scored for the languages of its script; a Viterbi path with a
fixed penalty per switch labels the words, so that mixed texts fall into spans. A document gets the
language with the most letters on its path; the score is that language's share of the letters.

Defined cases: a text that is null or has no letter gets ``und`` and score 0, and so does every text if
there was nothing to learn from; a word in a script of no learned language is open to all languages;
equal shares go to the language first in the alphabet; a null doc_id is passed on and never held out;
repeated rows each get a row.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scopewise.llm.batches import factorize, map_batches, pieces, ragged, texts

UNKNOWN = "und"
#: Hashed trigrams; the model has this many numbers per language.
BUCKETS = 1 << 16
#: Labelled documents that a model is fitted on at most, about; chosen by a hash of doc_id.
MAX_TRAINING_DOCS = 20_000
#: Cost of a switch of language between two words, in nats.
SWITCH = 12.0
#: Share of a language's letters that a script must have to count as one of its scripts.
MIN_SCRIPT_SHARE = 0.001
#: Text that is scored at once, in bytes; less with more than eight languages.
PIECE = 2 << 20

#: First code points of script ranges, fixed values of the Unicode blocks, and their scripts.
SCRIPT_STARTS = np.array(
    [0x0000, 0x0370, 0x0400, 0x0530, 0x0590, 0x0600, 0x0900, 0x0980, 0x0A00, 0x0E00, 0x0E80, 0x10A0, 0x1100,
     0x1200, 0x1E00, 0x1F00, 0x2000, 0x2C60, 0x3040, 0x30A0, 0x3100, 0x3400, 0xA000, 0xAC00, 0xD800, 0xF900, 0xFB00]
)
SCRIPTS = (
    "latin greek cyrillic armenian hebrew arabic devanagari bengali indic thai lao georgian hangul "
    "ethiopic latin greek other latin hiragana katakana other han other hangul other han other"
).split()
_NAMES = sorted(set(SCRIPTS))
_SCRIPT_ID = np.array([_NAMES.index(name) for name in SCRIPTS])

_WORDS = re.compile(r"[^\W\d_]+")
_FAR = np.float32(-1e6)


@dataclass(frozen=True)
class Model:
    """``scores[bucket, language]``; ``allowed[script, language]``."""

    languages: tuple[str, ...]
    scores: np.ndarray
    allowed: np.ndarray


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def _trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram buckets of all words, trigrams per word, and the script of every word's first letter.

    A word of n letters has n trigrams, as it is read with a mark on either side.
    """
    marked = np.frombuffer(("\x01" + "\x01".join(words) + "\x01").encode("utf-32-le"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    first = np.cumsum(lengths + 1) - lengths
    code = marked.astype(np.uint64)
    hashed = (code[:-2] * np.uint64(0x9E3779B1) + code[1:-1]) * np.uint64(0x85EBCA77) + code[2:]
    hashed *= np.uint64(0xC2B2AE3D27D4EB4F)
    buckets = (hashed >> np.uint64(48)).astype(np.int64) % BUCKETS
    scripts = _SCRIPT_ID[np.searchsorted(SCRIPT_STARTS, marked[first], side="right") - 1]
    return buckets[ragged(first - 1, lengths)], lengths, scripts


def _letters_only(words: list[str]) -> np.ndarray:
    """Which words have a letter; the word pattern also takes other numerals."""
    return np.fromiter((any(map(str.isalpha, word)) for word in words), bool, len(words))


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task one row per language and bucket; script ids follow the trigram buckets."""
    counts: dict[str, np.ndarray] = {}
    for piece in pieces(batches):
        for text, lang in zip(texts(piece), piece.column("lang").to_pylist(), strict=True):
            if words := words_of(text):
                buckets, lengths, scripts = _trigrams(words)
                own = counts.setdefault(lang, np.zeros(BUCKETS + len(_NAMES), np.int64))
                own[:BUCKETS] += np.bincount(buckets, minlength=BUCKETS)
                own[BUCKETS:] += np.bincount(scripts, lengths, len(_NAMES)).astype(np.int64)
    for lang, own in counts.items():
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at)), pa.array(at), pa.array(own[at])], ["lang", "bucket", "n"]
        )


def train(labelled: DataFrame, max_docs: int = MAX_TRAINING_DOCS) -> Model:
    """Fit a model on about ``max_docs`` rows with text and lang, chosen by a hash of doc_id."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    share = min(1.0, max_docs / max(1, rows.count()))
    fine = 1 << 30
    picked = rows.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(fine)) < math.ceil(share * fine))
    found = (
        picked.select("text", "lang")
        .transform(map_batches, _count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    languages = tuple(sorted(found["lang"].unique()))
    counts = np.zeros((BUCKETS + len(_NAMES), len(languages)))
    counts[found["bucket"], found["lang"].map({l: i for i, l in enumerate(languages)}).astype(int)] = found["n"]
    grams, letters = counts[:BUCKETS] + 0.1, counts[BUCKETS:]
    allowed = letters >= MIN_SCRIPT_SHARE * np.maximum(1, letters.sum(axis=0))
    allowed |= ~allowed.any(axis=1, keepdims=True)
    return Model(languages, np.log(grams / grams.sum(axis=0)).astype(np.float32), allowed)


def word_scores(words: list[str], model: Model) -> np.ndarray:
    """Log likelihood of every word per language; far below the rest where the script forbids it."""
    buckets, lengths, scripts = _trigrams(words)
    first = np.cumsum(lengths) - lengths
    scores = np.add.reduceat(model.scores[buckets], first, axis=0)
    scores[~model.allowed[scripts]] = _FAR
    return scores


def viterbi(scores: np.ndarray, starts: np.ndarray, lengths: np.ndarray, switch: float) -> np.ndarray:
    """The best path of every document; ``scores[starts[i] : starts[i] + lengths[i]]`` are its words.

    All documents advance together, a word at a time, the longest first.
    """
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    steps = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")
    value = np.zeros((len(lengths), scores.shape[1]), np.float32)
    came = np.zeros(scores.shape, np.int16)  # the language of the word before
    own = np.arange(scores.shape[1], dtype=np.int16)
    for step in range(steps):
        now = value[: active[step]]
        at = starts[: active[step]] + step
        if step:
            best = now.argmax(axis=1)
            top = now[np.arange(len(now)), best][:, None] - np.float32(switch)
            came[at] = np.where(now >= top, own, best[:, None])
            np.maximum(now, top, out=now)
            now -= now.max(axis=1, keepdims=True)
        now += scores[at]
    path = np.zeros(len(scores), np.int16)
    label = np.zeros(len(lengths), np.int64)
    for step in range(steps - 1, -1, -1):
        ending = slice(active[step + 1] if step + 1 < steps else 0, active[step])
        label[ending] = value[ending].argmax(axis=1)
        at = starts[: active[step]] + step
        path[at] = label[: active[step]]
        label[: active[step]] = came[at, label[: active[step]]]
    return path


def _spans(text: str, labels: np.ndarray, languages: tuple[str, ...]) -> list[dict]:
    """Maximal spans of one language; a span reaches to where the next one begins."""
    change = np.r_[0, np.flatnonzero(np.diff(labels)) + 1]
    begins = [0]
    if len(change) > 1:
        at = [m.start() for m in _WORDS.finditer(text.lower()) if any(map(str.isalpha, m[0]))]
        begins += [min(at[i], len(text)) for i in change[1:]]
    ends = [*begins[1:], len(text)]
    return [
        {"start": b, "end": e, "lang": languages[labels[c]]} for b, e, c in zip(begins, ends, change, strict=True)
    ]


SCHEMA = "doc_id long, lang_pred string, score double, spans array<struct<start:long,end:long,lang:string>>"
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))


def _label(batches: Iterable[pa.RecordBatch], model: Model, switch: float) -> Iterator[pa.RecordBatch]:
    languages = model.languages
    for piece in pieces(batches, limit=8 * PIECE // max(8, len(languages))):
        whole = texts(piece)
        found = [words_of(text) if languages else [] for text in whole]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        words = [word for own in found for word in own]
        del found
        doc = np.repeat(np.arange(len(whole)), lengths)
        codes, unique = factorize(words)
        letters = _letters_only(unique)
        if not letters.all():
            keep = letters[codes]
            codes, doc = codes[keep], doc[keep]
            lengths = np.bincount(doc, minlength=len(whole))
        starts = np.cumsum(lengths) - lengths
        share = np.zeros((len(whole), max(1, len(languages))))
        path = np.zeros(0, np.int16)
        if len(codes):
            path = viterbi(word_scores(unique, model)[codes], starts, lengths, switch)
            sizes = np.fromiter(map(len, unique), np.int64, len(unique))[codes]
            share = np.bincount(
                doc * len(languages) + path, sizes, len(whole) * len(languages)
            ).reshape(len(whole), -1)
        total = share.sum(axis=1)
        best = share.argmax(axis=1)
        score = np.divide(share.max(axis=1), total, out=np.zeros(len(whole)), where=total > 0)
        spans = [
            _spans(text, path[s : s + n], languages) if n else []
            for text, s, n in zip(whole, starts.tolist(), lengths.tolist(), strict=True)
        ]
        named = [languages[b] if t else UNKNOWN for b, t in zip(best.tolist(), total.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), pa.array(named), pa.array(score), pa.array(spans, _SPAN)],
            ["doc_id", "lang_pred", "score", "spans"],
        )


def identify(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """doc_id, lang_pred, score and labelled spans (code points) of every row; only text is looked at."""
    return docs.select(F.col("doc_id").cast("long"), "text").transform(
        map_batches,
        lambda batches: _label(batches, model, switch), SCHEMA
    )


def _keep(batches: Iterable[pa.RecordBatch], model: Model, switch: float, min_share: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces([batch], limit=PIECE):
            slim = pa.RecordBatch.from_arrays([pa.nulls(piece.num_rows, pa.int64()), piece.column("text")], ["doc_id", "text"])
            found = pa.Table.from_batches(_label([slim], model, switch))
            known = pc.and_(pc.not_equal(found["lang_pred"], UNKNOWN), pc.greater_equal(found["score"], min_share))
            yield piece.filter(known.combine_chunks())


def keep_identified(docs: DataFrame, model: Model, min_share: float, switch: float = SWITCH) -> DataFrame:
    """The rows of docs, all columns, where one language has ``min_share`` of the letters; no shuffle."""
    return map_batches(docs, lambda batches: _keep(batches, model, switch, min_share), docs.schema)


def held_out():
    """Rows that no model learns from: crc32 of doc_id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
