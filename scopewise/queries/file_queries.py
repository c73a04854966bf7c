"""Queries that write what they derive from the tables and read it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from scopewise.functions.text import flatten_list
from scopewise.operators import digest
from scopewise.operators import provenance as V
from scopewise.operators.metrics import entity_metrics
from scopewise.plans.bundle import write_bundle, write_data_package, write_fact
from scopewise.plans.release import qualification_of_scopes, reconcile_release
from scopewise.plans.snapshots import read_provenance, read_snapshots, write_snapshots
from scopewise.queries import bindings as B
from scopewise.queries.registry import query
from scopewise.session import materialize, scratch_path
from scopewise.sources import files, tables
from scopewise.sources.sinks import write_csv, write_json_rows, write_parquet
from scopewise.spec import DEFAULT_SPEC as SPEC
from scopewise.spec import FactSpec

_TEXT_COLS = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in SPEC.required if c != "small")


@query(
    f"WITH {B.ENTITY} SELECT {_TEXT_COLS}, CASE WHEN small = 0 THEN '' ELSE CAST(small AS VARCHAR) END "
    "AS small FROM entity"
)
def q_scan_strict(spark, sf_dir):
    """A CSV with empty cells, read as text with the cells kept empty."""
    fact = B.entity(spark, sf_dir)
    path = scratch_path(spark, "strict")
    write_csv(fact.withColumn("small", F.nullif(F.col("small"), F.lit(0))), path)
    return tables.read_strict_text(spark, path).select(*SPEC.required)


@query(
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, coalesce(\"text\", '') || chr(10) || '\"' || coalesce(source, '') || '\",' AS \"text\", "
    "coalesce(lang, '') AS lang FROM documents"
)
def q_scan_quoted(spark, sf_dir):
    """Whole texts with quotes and line breaks as CSV cells, read back by many tasks per file."""
    line = F.concat(F.coalesce("text", F.lit("")), F.lit('\n"'), F.coalesce("source", F.lit("")), F.lit('",'))
    path = scratch_path(spark, "quoted")
    write_csv(B.table(spark, sf_dir, "documents").select("doc_id", line.alias("text"), "lang"), path)
    return tables.read_strict_text(spark, path)


_PART = r"""CASE WHEN regexp_full_match("text", '(?s)[\x00-\x7f\x{a0}-\x{ff}]*') THEN conv_id % 3 ELSE 0 END"""


@query(
    f"WITH t AS (SELECT *, {_PART} AS part FROM conversations) "
    "SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, "
    "CASE part WHEN 0 THEN chr(8364) || chr(937) WHEN 1 THEN chr(8364) || chr(8217) ELSE chr(129) || chr(233) END "
    "|| \"text\" AS \"text\", CASE part WHEN 0 THEN 'utf-8-sig' WHEN 1 THEN 'cp1252' ELSE 'latin-1' END AS encoding FROM t"
)
def q_scan_encoding(spark, sf_dir):
    """Texts with line breaks, stored in three encodings in one folder, told apart and read back."""
    one_byte = F.col("text").rlike(r"(?s)^[\x00-\x7f\xa0-\xff]*$")
    part = F.when(one_byte, F.col("conv_id") % 3).otherwise(0)
    # characters that only one of the encodings has: a Greek letter, a curly quote, an undefined byte
    mark = F.when(part == 0, "\u20ac\u03a9").when(part == 1, "\u20ac\u2019").otherwise("\x81\xe9")
    talks = B.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.concat(mark, "text").alias("text"), part.alias("part")
    )
    path = scratch_path(spark, "encodings")
    for value, encoding in ((0, "UTF-8"), (1, "ISO-8859-1"), (2, "ISO-8859-1")):
        rows = talks.where(F.col("part") == value).drop("part")
        if value == 1:  # Spark writes no code page 1252, but its bytes can be spelled in Latin-1
            rows = rows.withColumn("text", tables.as_cp1252_bytes(F.col("text")))
        write_csv(rows, f"{path}/{value}", encoding=encoding)
    return tables.read_lenient_rows(spark, f"{path}/*").withColumnRenamed("_encoding", "encoding")


@query(
    "SELECT CAST(c_custkey AS VARCHAR) AS source_id, c_name AS publisher, "
    "CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END AS status, "
    "row_number() OVER (ORDER BY c_custkey) + 1 AS row_no FROM customer"
)
def q_registry_scan(spark, sf_dir):
    """A registry-like CSV with blank cells, read back as numbered text."""
    customers = B.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("source_id"),
        F.col("c_name").alias("publisher"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("status"),
    )
    path = scratch_path(spark, "registry")
    # one file in the order of the keys, so that SQL can tell the line of a row
    write_csv(customers.orderBy("source_id"), path, single_file=True)
    return tables.read_registry(spark, path)


_METRICS_SQL = f"WITH {B.ENTITY}, {B.METRICS} SELECT * FROM metrics"


@query(_METRICS_SQL)
def q_sink_roundtrip(spark, sf_dir):
    """Metrics as Parquet split by scope, read back under the declared schema."""
    path = scratch_path(spark, "sink")
    write_parquet(entity_metrics(B.entity(spark, sf_dir)), path, ("scope_name",))
    return tables.read_metrics(spark, path)


@query(
    f"WITH {B.ENTITY}, {B.METRICS} SELECT scope_name, entity_code, CAST(rank_total AS BIGINT) AS rank_total, "
    "CAST(rank_total AS BIGINT) AS written_position FROM metrics"
)
def q_written_order(spark, sf_dir):
    """Where every row of written metrics stands, by file name and row of the file, beside its rank."""
    path = scratch_path(spark, "order")
    write_fact(B.entity(spark, sf_dir), path)
    found = tables.written_positions(spark, path)
    return found.select("scope_name", "entity_code", F.col("rank_total").cast("bigint"), "written_position")


def _tree_sql() -> str:
    """All nodes of the hash tree over the texts of ``documents``; up to 64**4 of them."""
    levels = [
        "n0 AS (SELECT row_number() OVER (ORDER BY p) - 1 AS i, sha256('file|' || octet_length(encode(p)) || '|' || p || '|' "
        "|| octet_length(encode(t)) || '|' || sha256(t)) AS h FROM (SELECT lang || '/' || doc_id AS p, "
        "coalesce(\"text\", '') AS t FROM documents WHERE lang IS NOT NULL))"
    ]
    for level in range(1, 5):
        levels.append(
            f"n{level} AS (SELECT i // 64 AS i, sha256('node' || string_agg(h, '' ORDER BY i)) AS h FROM n{level - 1} "
            f"WHERE (SELECT count(*) FROM n{level - 1}) > 1 GROUP BY i // 64)"
        )
    union = " UNION ALL ".join(f"SELECT {n} AS level, CAST(i AS BIGINT) AS position, h AS hash FROM n{n}" for n in range(5))
    return f"WITH {', '.join(levels)} {union}"


@query(_tree_sql())
def q_files_digest(spark, sf_dir):
    """The hash tree over all texts as files: leaves, inner nodes and the root."""
    docs = B.table(spark, sf_dir, "documents").where(F.col("lang").isNotNull())
    text = F.coalesce("text", F.lit(""))
    listed = docs.select(
        F.concat_ws("/", "lang", F.col("doc_id").cast("string")).alias("relative_path"),
        F.octet_length(text).cast("bigint").alias("size_bytes"),
        files.content_hash(text).alias("sha256"),
    )
    return digest.tree(listed).select("level", "position", "hash")


@query(_METRICS_SQL)
def q_release_reread(spark, sf_dir):
    """Metrics as CSV, re-read with text identifiers, doubles and booleans."""
    path = scratch_path(spark, "reread")
    return write_fact(B.entity(spark, sf_dir), path, SPEC, "csv")


@query(
    "SELECT CAST(doc_id AS VARCHAR) AS document, f.file_key, f.relative_path, f.size_bytes, f.sha256 FROM ("
    "SELECT doc_id, unnest([{'file_key': 'text', 'relative_path': doc_id || '/text', "
    "'size_bytes': CAST(octet_length(encode(\"text\")) AS BIGINT), 'sha256': sha256(\"text\")}, "
    "{'file_key': 'lang', 'relative_path': doc_id || '/lang', "
    "'size_bytes': CAST(octet_length(encode(lang)) AS BIGINT), 'sha256': sha256(lang)}]) AS f FROM documents)"
)
def q_manifest_rows(spark, sf_dir):
    """A manifest document per text, written as JSON, read back, one row per file."""

    def entry(part: str):
        name = F.concat_ws("/", F.col("doc_id").cast("string"), F.lit(part))
        return F.struct(
            F.lit(None).cast("string").alias("file_name"),
            name.alias("relative_path"),
            files.content_hash(F.col(part)).alias("sha256"),
            F.octet_length(part).cast("bigint").alias("size_bytes"),
        )

    entries = F.create_map(F.lit("text"), entry("text"), F.lit("lang"), entry("lang"))
    documents = B.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("document"), entries.alias("files")
    )
    path = scratch_path(spark, "manifests")
    write_json_rows(documents, path)
    schema = files.MANIFEST_SCHEMA.add("document", "string")
    return files.manifest_rows(spark.read.schema(schema).json(path), "document")


@query(
    "SELECT 'lang=' || lang || '/bucket=' || bucket || '/part.csv' AS relative_path, "
    "sum(octet_length(encode(l)))::BIGINT AS size_bytes, sha256(string_agg(l, '' ORDER BY doc_id)) AS sha256 "
    "FROM (SELECT lang, doc_id, doc_id % 16 AS bucket, doc_id || ',' || source || chr(10) AS l "
    "FROM documents WHERE lang IS NOT NULL) GROUP BY lang, bucket"
)
def q_file_inventory(spark, sf_dir):
    """Files written per language and bucket by parallel tasks, listed and hashed from outside."""
    docs = B.table(spark, sf_dir, "documents").where(F.col("lang").isNotNull()).withColumn("bucket", F.col("doc_id") % 16)
    line = F.concat_ws(",", F.col("doc_id").cast("string"), "source")
    path = scratch_path(spark, "inventory")
    # one task, and so one file, per folder
    dealt = docs.select("lang", "bucket", "doc_id", line.alias("value")).repartition("lang", "bucket")
    ordered = dealt.sortWithinPartitions("lang", "bucket", "doc_id").drop("doc_id")
    ordered.write.partitionBy("lang", "bucket").text(path)
    found = files.inventory(spark, path).where(F.col("relative_path").contains("lang="))
    # a writer chooses the names of its files
    name = F.regexp_replace("relative_path", "part-[^/]*$", "part.csv")
    return found.select(name.alias("relative_path"), "size_bytes", "sha256")


@query(
    f"WITH {B.ENTITY}, r AS (SELECT least(count(*), 10) * 2 AS n FROM entity GROUP BY scope_name) "
    "SELECT 'Data package' AS name, count(*) AS row_count, (SELECT CAST(sum(n) AS BIGINT) FROM r) AS ranking_row_count, "
    f"{len((*SPEC.required, *SPEC.derived))} AS dictionary_row_count, CAST(sum(total) AS BIGINT) AS total_total FROM entity"
)
def q_bundle_manifest(spark, sf_dir):
    """A whole data package from text to manifest; returns the manifest header.

    The number of files follows the tasks of the run and is left out.
    """
    fact = B.entity(spark, sf_dir)
    raw = fact.select(*[F.col(c).cast("string").alias(c) for c in fact.columns])
    out = scratch_path(spark, "bundle")
    header = write_bundle(raw, out, V.Source("ORDERS", "orders.parquet"))
    return header.select(
        "name", "row_count", "ranking_row_count", F.col("dictionary_row_count").cast("int"), "total_total"
    )


_SNAPSHOT = "CASE WHEN total % 2 = 0 THEN 'even' ELSE 'odd' END AS as_of"
_FIGURES = " UNION ALL ".join(
    f"SELECT as_of, '{name}' AS figure, CAST({sql} AS BIGINT) + {altered} AS published, CAST({sql} AS BIGINT) AS actual, "
    f"{altered} = 0 AS matches FROM s GROUP BY as_of"
    for name, sql, altered in (
        ("row_count", "count(*)", "0"),
        *((f"{c}_total", f"sum({c})", "0") for c in SPEC.categories),
        (f"{SPEC.total}_total", f"sum({SPEC.total})", "CASE WHEN as_of = 'odd' THEN 1 ELSE 0 END"),
    )
)


@query(f"WITH {B.ENTITY}, s AS (SELECT *, {_SNAPSHOT} FROM entity) {_FIGURES}")
def q_release_reconcile(spark, sf_dir):
    """Published figures, one of them wrong, beside those recomputed from what was written, per snapshot."""
    spec = FactSpec(snapshot_cols=("as_of",))
    even = F.col("total") % 2 == 0
    fact = B.entity(spark, sf_dir).withColumn("as_of", F.when(even, F.lit("even")).otherwise(F.lit("odd")))
    stored = write_fact(fact, scratch_path(spark, "release"), spec)
    published = V.release_totals(fact, spec).withColumn(
        "total_total", F.col("total_total") + (F.col("as_of") == "odd").cast("bigint")
    )
    return reconcile_release(stored, published, spec)


_SNAPSHOTS = """, s AS (SELECT 'first' AS as_of, * FROM entity UNION ALL
  SELECT 'second', * FROM entity WHERE scope_name <> 'ASIA' AND total > 10)
SELECT as_of, scope_name, count(*) AS row_count, CAST(sum(total) AS BIGINT) AS total,
  first(entity_name ORDER BY total DESC, entity_name, entity_code) AS leader, count(*) AS recorded_rows
FROM s GROUP BY as_of, scope_name"""


@query(f"WITH {B.ENTITY}{_SNAPSHOTS}")
def q_snapshot_table(spark, sf_dir):
    """Two snapshots in one table, the second written again with fewer scopes and rows; read per snapshot."""
    spec = FactSpec(snapshot_cols=("as_of",))
    fact = B.entity(spark, sf_dir)
    source = V.Source("ORDERS", "orders.parquet")
    out = scratch_path(spark, "snapshots")
    both = F.explode(F.array(F.lit("first"), F.lit("second"))).alias("as_of")
    write_snapshots(fact.select("*", both), out, source, spec)
    later = fact.where((F.col("scope_name") != "ASIA") & (F.col("total") > 10))
    write_snapshots(later.withColumn("as_of", F.lit("second")), out, source, spec)
    parts = [read_snapshots(spark, out, spec, as_of=name) for name in ("first", "second")]
    figures = parts[0].unionByName(parts[1]).groupBy("as_of", "scope_name").agg(
        F.count("*").alias("row_count"),
        F.sum("total").alias("total"),
        F.max(F.when(F.col("rank_total") == 1, F.col("entity_name"))).alias("leader"),
    )
    told = read_provenance(spark, out, spec).select("as_of", "scope_name", F.col("row_count").alias("recorded_rows"))
    return figures.join(told, ["as_of", "scope_name"], "full_outer")


_SUMS = ", ".join(
    f"CAST(sum({c}) AS BIGINT) AS {c}_total" for c in (*SPEC.categories, SPEC.total)
)


@query(
    f"WITH {B.ENTITY}, s AS (SELECT scope_name, count(*) AS row_count, "
    f"count(DISTINCT entity_code) AS entity_count, {_SUMS} FROM entity GROUP BY scope_name) "
    "SELECT '1.0' AS schema_version, 'ORDERS' AS source_id, 'orders.parquet' AS source_file_name, "
    "CAST(NULL AS VARCHAR) AS source_as_of_date, 'fact' AS output_name, "
    f"'{' | '.join(sorted((*SPEC.required, *SPEC.derived)))}' AS columns, "
    f"'{' | '.join(sorted(SPEC.derived))}' AS derived_columns, * FROM s"
)
def q_provenance(spark, sf_dir):
    """Provenance per scope, but for the time of the run."""
    metrics = entity_metrics(B.entity(spark, sf_dir))
    record = V.provenance(metrics, V.Source("ORDERS", "orders.parquet"), "fact")
    return record.select(
        "schema_version",
        "source_id",
        "source_file_name",
        "source_as_of_date",
        "output_name",
        flatten_list(F.col("columns")).alias("columns"),
        flatten_list(F.col("derived_columns")).alias("derived_columns"),
        "scope_name",
        "row_count",
        "entity_count",
        *[f"{c}_total" for c in (*SPEC.categories, SPEC.total)],
    )


_ENDS = ", ".join(
    f"first({col} ORDER BY {order}) AS {side}_{col}"
    for side, order in (
        ("highest", "total DESC, entity_name, entity_code"),
        ("lowest", "total, entity_name, entity_code"),
    )
    for col in ("entity_name", "entity_code", "total")
)


@query(
    f"WITH {B.ENTITY}, {B.METRICS}, again AS (SELECT scope_name FROM entity "
    "WHERE entity_code::BIGINT % 11 = 0 AND scope_name IN ('ASIA', 'EUROPE')) SELECT scope_name, count(*) AS row_count, "
    f"count(DISTINCT entity_code) AS entity_count, {_SUMS}, {_ENDS}, "
    + B.exact_round("avg(micro_share_pct + small_share_pct + medium_share_pct)", 4)
    + " AS mean_share_sum, (SELECT count(*) FROM again) AS national_conflicting_groups, "
    "(SELECT 2 * count(*) FROM again) AS national_conflicting_rows, "
    "(SELECT count(*) FROM again a WHERE a.scope_name = metrics.scope_name) AS scope_conflicting_groups, "
    "NOT EXISTS (FROM again a WHERE a.scope_name = metrics.scope_name) AS qualified, "
    "false AS publication_allowed FROM metrics GROUP BY scope_name"
)
def q_release_validation(spark, sf_dir):
    """Gate results of a source whose keys conflict in some regions."""
    fact = materialize(B.entity(spark, sf_dir), "fact")
    metrics = materialize(entity_metrics(fact), "metrics")
    again = fact.where((F.col("entity_code").cast("bigint") % 11 == 0) & F.col("scope_name").isin("ASIA", "EUROPE"))
    source = fact.unionByName(again.withColumn("total", F.col("total") + 1))
    return V.release_validation(metrics, qualification_of_scopes(source))


@query(
    f"WITH {B.ENTITY}, {B.METRICS}, v AS ("
    "SELECT 'TOP' AS ranking_group, CAST(rank_total AS BIGINT) AS p, * FROM metrics WHERE rank_total <= 10 UNION ALL "
    "SELECT 'BOTTOM', CAST(rank_total_ascending AS BIGINT), * FROM metrics WHERE rank_total_ascending <= 10) "
    "SELECT ranking_group, CAST(p AS VARCHAR) AS ranking_position, scope_name, entity_code, "
    "CAST(total AS VARCHAR) AS total FROM v"
)
def q_rankings_written(spark, sf_dir):
    """The rankings of a data package as they stand in its files."""
    metrics = materialize(entity_metrics(B.entity(spark, sf_dir)), "metrics")
    out = scratch_path(spark, "rankings")
    write_data_package(metrics, out, V.Source("ORDERS", "orders.parquet"))
    written = tables.read_strict_text(spark, f"{out}/data/rankings")
    return written.select("ranking_group", "ranking_position", "scope_name", "entity_code", "total")
