"""One query per operator over its whole table, and the SQL that says the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scopewise.llm import bpe, counts, decontaminate, exact, language, near, phrases, pii, resample, suffix, suffix_tree, variants, warc

VOCABULARY_FILE = public_tokenizers.path("byte_bpe_50k.json")
RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")

RUN: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        RUN[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _covered_sql(units: str, size: int) -> str:
    """Which units (doc_id, i, w: the window that begins at i, or null) a window of a smaller document covers."""
    return f"""
    units AS ({units}),
    least AS (SELECT w, min(doc_id) AS m FROM units WHERE w IS NOT NULL GROUP BY w),
    marked AS (SELECT units.*, coalesce(m < doc_id, false) AS hit FROM units LEFT JOIN least USING (w)),
    covered AS (SELECT *, coalesce(bool_or(hit) OVER (
        PARTITION BY doc_id ORDER BY i ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW), false) AS gone FROM marked)
    """


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words_sql(text: str) -> str:
    return rf"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"


_SHINGLES_SQL = """unnest(list_transform(range(1, greatest(len(w) - 3, least(len(w), 1) + 1)),
            lambda i: array_to_string(list_slice(w, i, i + 4), ' ')))"""

_BYTES_SQL = """SELECT doc_id, i, substr(h, 2 * i + 1, 2) AS unit,
        CASE WHEN length(h) >= 2 * i + 100 THEN substr(h, 2 * i + 1, 100) END AS w
    FROM (SELECT doc_id, h, unnest(range(length(h) // 2)) AS i
          FROM (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents))"""

_WORD_WINDOWS_SQL = f"""SELECT doc_id, i, w[i] AS unit,
        CASE WHEN i + 12 <= len(w) THEN array_to_string(list_slice(w, i, i + 12), ' ') END AS w
    FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i
          FROM (SELECT doc_id, {_words_sql("coalesce(text, '')")} AS w FROM documents))"""


@query(
    f"""
    WITH {_covered_sql(_BYTES_SQL, 50)},
    edges AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM covered),
    found AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE opens) AS n_spans,
                     coalesce(string_agg(unit, '' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept FROM edges GROUP BY doc_id)
    SELECT d.doc_id, octet_length(encode(coalesce(text, '')))::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed,
           coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
    FROM documents d LEFT JOIN found USING (doc_id)
    """
)
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digest(suffix.remove_repeats(table(spark, sf_dir, "documents")))


@query(
    f"""
    WITH {_covered_sql(_WORD_WINDOWS_SQL, 13)},
    found AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
                     coalesce(string_agg(unit, ' ' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept FROM covered GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
           sha256(coalesce(kept, '')) AS kept_sha256
    FROM documents d LEFT JOIN found USING (doc_id)
    """
)
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.digest(phrases.remove_passages(table(spark, sf_dir, "documents")))


@query(
    """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
         g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
    SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.text) AS text_sha256
    FROM d JOIN g USING (text)
    """
)
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


@query()
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.where(~language.held_out()))
    return language.identify(docs, model).select(
        "doc_id", language.held_out().alias("held_out"), "lang_pred", "score"
    )


@query()
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(
        table(spark, sf_dir, "documents"), RANK_FILE
    )


@query(
    f"""
    WITH words AS (SELECT 'd' AS kind, doc_id AS id, {_words_sql(_LOWER)} AS w FROM documents
                   UNION ALL SELECT 'i', item_id, {_words_sql(_LOWER)} FROM benchmark),
    own AS (SELECT DISTINCT id, {_SHINGLES_SQL} AS shingle FROM words WHERE kind = 'i'),
    items AS (SELECT id, shingle, count(*) OVER (PARTITION BY id) AS n_item FROM own),
    lengths AS (SELECT 5 AS n UNION SELECT len(w) FROM words WHERE kind = 'i' AND len(w) BETWEEN 1 AND 4),
    shingles AS (SELECT DISTINCT id, unnest([array_to_string(list_slice(w, i, i + n - 1), ' ')
                 for i in range(1, len(w) - n + 2)]) AS shingle FROM words, lengths WHERE kind = 'd')
    SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_common, any_value(n_item) AS n_item,
           count(*) / any_value(n_item) AS containment
    FROM shingles d JOIN items i ON d.shingle = i.shingle
    GROUP BY d.id, i.id HAVING count(*) / any_value(n_item) >= 0.8
    """
)
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    g AS (SELECT html, max(page_id) AS top, sha1(html) AS hex FROM p GROUP BY html),
    digests AS (SELECT html, top, array_to_string(list_transform(range(32), lambda k: substr(
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((('0x' || substr(hex, 5 * (k // 4) + 1, 5))::INT >> (15 - 5 * (k % 4))) & 31)::INT + 1, 1)), '') AS digest FROM g)
    SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, digest AS payload_digest,
           CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> top THEN top END AS refers_to
    FROM p JOIN digests USING (html)
    """
)
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.archive_folder(spark)
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query(
    f"""
    WITH RECURSIVE words AS (SELECT doc_id, {_words_sql(_LOWER)} AS w FROM documents),
    shingles AS (SELECT DISTINCT doc_id, {_SHINGLES_SQL} AS shingle FROM words),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b
               ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (SELECT x, y FROM common JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
              WHERE 100 * c >= 85 * (s.n + t.n - c)),
    ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
    reach(doc_id, node) AS (SELECT doc_id, doc_id FROM documents UNION SELECT doc_id, y FROM reach JOIN ways ON node = x)
    SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(node) AS component_id, doc_id = min(node) AS kept
    FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
    """
)
def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.personal_data(table(spark, sf_dir, "documents")))


@query()
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), VOCABULARY_FILE).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


# The unsigned CRC-32 of the text x, bit by bit: a byte enters with the first of its eight steps.
_CRC_SQL = """xor(4294967295, list_reduce(
        list_transform(range(4 * length(hex(encode(x)))),
                       lambda i: CASE WHEN i % 8 = 0 THEN ('0x' || substr(hex(encode(x)), i // 4 + 1, 2))::BIGINT ELSE 0 END),
        lambda c, e: xor(xor(c, e) >> 1, 3988292384 * (xor(c, e) & 1)), 4294967295::BIGINT))"""

_FEATURES_SQL = f"""SELECT id, unnest(w || list_transform(range(1, len(w)), lambda i: array_to_string(w[i:i + 1], ' '))
               || list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS x
    FROM (SELECT id, list_filter(string_split_regex({_LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w"""


@query(
    f"""
    WITH found AS ({_FEATURES_SQL} FROM (SELECT doc_id AS id, text FROM documents))),
    aimed AS ({_FEATURES_SQL} FROM (SELECT item_id AS id, text FROM benchmark))),
    buckets AS (SELECT x, {_CRC_SQL} % 10000 AS b FROM (SELECT x FROM found UNION SELECT x FROM aimed)),
    s AS (SELECT b, count(*) AS s FROM found JOIN buckets USING (x) GROUP BY b),
    t AS (SELECT b, count(*) AS t FROM aimed JOIN buckets USING (x) GROUP BY b),
    gains AS (SELECT b, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM found) + 10000)::DOUBLE
        / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM aimed) + 10000)::DOUBLE)))::BIGINT AS gain
        FROM (SELECT unnest(range(10000)) AS b) LEFT JOIN s USING (b) LEFT JOIN t USING (b)),
    sums AS (SELECT id AS doc_id, count(*) AS n, sum(gain)::BIGINT AS weight
             FROM found JOIN buckets USING (x) JOIN gains USING (b) GROUP BY id),
    scored AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE)
            / 4294967296::DOUBLE)))::BIGINT AS score FROM documents LEFT JOIN sums USING (doc_id)),
    -- n words have 3 n - 3 features from two words on, so at least 20 words are at least 57 features.
    eligible AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS m
                 FROM scored WHERE n_features >= 57)
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * m // 100 THEN place END AS rank
    FROM scored LEFT JOIN eligible USING (doc_id)
    """
)
def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return resample.resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


@query()
def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.log_probabilities(table(spark, sf_dir, "documents"))


@query()
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents")).select(
        "word", "form", "root", "n", "n_near", "form_n"
    )
