"""Projection, lookup and reconciliation over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from scopewise.operators import reconcile as K
from scopewise.operators.scoping import project_required, typed_fact
from scopewise.queries import bindings as B
from scopewise.queries.registry import query
from scopewise.sources.files import content_hash
from scopewise.spec import DEFAULT_SPEC as SPEC

_BASE = ", ".join(SPEC.required)


@query(f"WITH {B.ENTITY} SELECT {_BASE} FROM entity")
def q_project_norm(spark, sf_dir):
    """Padded headers, padded cells and an extra column, brought into shape."""
    fact = B.entity(spark, sf_dir)
    untidy = fact.select(
        F.lit("x").alias("extra"),
        *[
            F.concat(F.lit("\t"), F.col(c).cast("string"), F.lit("  ")).alias(f" {c} ")
            for c in reversed(fact.columns)
        ],
    )
    return typed_fact(project_required(untidy))


_BRANDS = ("Brand#23", "Brand#5", "Brand#12", "Brand#1", "Brand#17")


def _ordinal(column: str, values) -> str:
    cases = " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(values, 1))
    return f"CAST(CASE {column} {cases} END AS BIGINT)"


@query(
    f"SELECT p_partkey, p_brand, {_ordinal('p_brand', _BRANDS)} AS ordinal FROM part "
    f"WHERE p_brand IN {_BRANDS}"
)
def q_keyed_reorder(spark, sf_dir):
    parts = B.table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return K.keyed_reorder(parts, "p_brand", _BRANDS)


@query(
    "SELECT doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN d.doc_id IS NULL THEN 'unexpected' "
    "ELSE 'ok' END AS status FROM (SELECT DISTINCT doc_id FROM documents) d "
    "FULL OUTER JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)"
)
def q_key_reconcile(spark, sf_dir):
    return K.reconcile_keys(
        B.table(spark, sf_dir, "documents"), B.table(spark, sf_dir, "labels"), ["doc_id"]
    )


@query(
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN "
    "(SELECT c_custkey FROM customer WHERE c_acctbal > 0)"
)
def q_unknown_refs(spark, sf_dir):
    known = B.table(spark, sf_dir, "customer").where("c_acctbal > 0")
    orders = B.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return K.unknown_references(orders, "o_custkey", known, "c_custkey")


@query("SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels")
def q_intersect_keys(spark, sf_dir):
    return K.shared_keys(
        B.table(spark, sf_dir, "documents"), B.table(spark, sf_dir, "labels"), ["doc_id"]
    )


@query('SELECT doc_id, sha256("text") AS sha256 FROM documents')
def q_content_hash(spark, sf_dir):
    documents = B.table(spark, sf_dir, "documents")
    return documents.select("doc_id", content_hash(F.col("text")).alias("sha256"))


@query("""SELECT CAST(doc_id AS VARCHAR) AS relative_path,
  CASE WHEN l.doc_id IS NULL THEN 'missing'
    WHEN toxic = 1 THEN 'size_mismatch'
    WHEN quality = 0 AND regexp_matches(d."text", '[A-Z]') THEN 'checksum_mismatch' ELSE 'ok' END AS status
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def q_manifest_verify(spark, sf_dir):
    """Listed texts against received ones: some lost, longer or in lower case."""
    documents = B.table(spark, sf_dir, "documents")
    text = F.col("text")
    received = (
        F.when(F.col("toxic") == 1, F.concat(text, F.lit(".")))
        .when(F.col("quality") == 0, F.translate(text, _UPPER, _LOWER))
        .otherwise(text)
    )
    copies = documents.join(B.table(spark, sf_dir, "labels"), "doc_id").select(
        "doc_id", received.alias("text")
    )

    def listed(df):
        return df.select(
            F.col("doc_id").cast("string").alias("relative_path"),
            F.octet_length("text").cast("bigint").alias("size_bytes"),
            content_hash(F.col("text")).alias("sha256"),
        )

    return K.verify_manifest(listed(documents), listed(copies))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()
