"""Facts derived from the driver tables, in Spark and in SQL.

* entity: customers inside regions, with their orders by status as categories
* entity since 2000: the same, but many customers have no order left
* nation: nations inside regions (few entities per scope)
* world: all customers in one scope
* line key: line items, whose (order, line number) repeats
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scopewise.spec import DEFAULT_SPEC, FactSpec

SINCE = "2000-01-01"
STATUS_OF = {"micro": "F", "small": "O", "medium": "P"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _orders_by_customer(spark: SparkSession, sf_dir: str, since: str | None) -> DataFrame:
    """Counts per customer; the join then meets one row per customer."""
    orders = table(spark, sf_dir, "orders")
    if since:
        orders = orders.where(F.col("o_orderdate") >= F.lit(since).cast("timestamp"))
    status = F.col("o_orderstatus")
    return orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        *[F.count_if(status == value).alias(name) for name, value in STATUS_OF.items()],
        F.count("o_orderkey").alias("total"),
    )


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return table(spark, sf_dir, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))


def entity(spark: SparkSession, sf_dir: str, since: str | None = None) -> DataFrame:
    counts = _orders_by_customer(spark, sf_dir, since)
    joined = _customers(spark, sf_dir).join(counts, "c_custkey", "left")
    return joined.select(
        F.col("r_name").alias("scope_name"),
        F.col("r_regionkey").cast("string").alias("scope_id"),
        F.col("c_name").alias("entity_name"),
        F.col("c_custkey").cast("string").alias("entity_code"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in DEFAULT_SPEC.count_cols],
    )


def entity_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity(spark, sf_dir, SINCE)


def nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _orders_by_customer(spark, sf_dir, None)
    joined = _customers(spark, sf_dir).join(counts, "c_custkey", "left")
    return joined.groupBy(
        F.col("r_name").alias("scope_name"),
        F.col("r_regionkey").cast("string").alias("scope_id"),
        F.col("n_name").alias("entity_name"),
        F.col("n_nationkey").cast("string").alias("entity_code"),
    ).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in DEFAULT_SPEC.count_cols])


def world(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity(spark, sf_dir).withColumns({"scope_name": F.lit("WORLD"), "scope_id": F.lit("0")})


def damaged_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entity fact with blank names, repeated codes, negative counts and wrong totals."""
    code = F.col("entity_code").cast("bigint")
    return entity(spark, sf_dir).select(
        F.when(code % 31 == 0, F.lit(" \t")).otherwise(F.col("scope_name")).alias("scope_name"),
        "scope_id",
        F.when(code % 37 != 0, F.col("entity_name")).alias("entity_name"),
        F.when(code % 17 == 0, F.lit("1")).otherwise(F.col("entity_code")).alias("entity_code"),
        F.when(code % 23 != 0, F.col("medium")).alias("medium"),
        F.when(code % 19 == 0, -1 - F.col("micro")).otherwise(F.col("micro")).alias("micro"),
        "small",
        "total",
    )


DAMAGED_FACT = """t AS (SELECT CASE WHEN entity_code::BIGINT % 31 = 0 THEN '' ELSE scope_name END AS scope_name,
  scope_id, CASE WHEN entity_code::BIGINT % 37 <> 0 THEN entity_name END AS entity_name,
  CASE WHEN entity_code::BIGINT % 17 = 0 THEN '1' ELSE entity_code END AS entity_code,
  CASE WHEN entity_code::BIGINT % 23 <> 0 THEN medium END AS medium,
  CASE WHEN entity_code::BIGINT % 19 = 0 THEN -1 - micro ELSE micro END AS micro, small, total FROM entity)"""


def damaged_metrics(metrics: DataFrame) -> DataFrame:
    """Metrics that break every rule in some region; Africa stays sound."""
    scope, code = F.col("scope_name"), F.col("entity_code").cast("bigint")
    rank, share = F.col("rank_total"), F.col("scope_total_share_pct")

    def patch(name: str, condition, value):
        return F.when(condition, value).otherwise(F.col(name))

    empty = scope == "MIDDLE EAST"
    return metrics.withColumns(
        {
            "rank_total": patch("rank_total", (scope == "AMERICA") & (rank > 5), rank + 1),
            "rank_total_ascending": patch("rank_total_ascending", (scope == "ASIA") & (rank == 2), F.lit(1)),
            "micro_share_pct": patch("micro_share_pct", (scope == "ASIA") & (code % 3 == 0), F.lit(101.0)),
            "small_share_pct": patch("small_share_pct", (scope == "EUROPE") & (code % 4 == 0), F.lit(-1.0)),
            "medium_share_pct": F.when((scope != "AMERICA") | (code % 5 != 0), F.col("medium_share_pct")),
            "scope_total_share_pct": F.when(scope == "EUROPE", share / 2)
            .when(empty, F.when(rank <= 2, 0.02).otherwise(0.0))
            .otherwise(share),
            "total": patch("total", empty, F.lit(0)),
            "dominant_category": patch("dominant_category", (scope == "EUROPE") & (code % 6 == 0), F.lit("LARGE")),
            "top_10_flag": patch("top_10_flag", (scope == "ASIA") & (rank == 10), F.lit(False)),
            "bottom_10_flag": F.when((scope != "AMERICA") | (code % 7 != 0), F.col("bottom_10_flag")),
        }
    )


DAMAGED_METRICS = """damaged AS (SELECT * REPLACE (
  CASE WHEN scope_name = 'AMERICA' AND rank_total > 5 THEN rank_total + 1 ELSE rank_total END AS rank_total,
  CASE WHEN scope_name = 'ASIA' AND rank_total = 2 THEN 1 ELSE rank_total_ascending END AS rank_total_ascending,
  CASE WHEN scope_name = 'ASIA' AND entity_code::BIGINT % 3 = 0 THEN 101e0 ELSE micro_share_pct END AS micro_share_pct,
  CASE WHEN scope_name = 'EUROPE' AND entity_code::BIGINT % 4 = 0 THEN -1e0 ELSE small_share_pct END AS small_share_pct,
  CASE WHEN scope_name <> 'AMERICA' OR entity_code::BIGINT % 5 <> 0 THEN medium_share_pct END AS medium_share_pct,
  CASE WHEN scope_name = 'EUROPE' THEN scope_total_share_pct / 2
    WHEN scope_name = 'MIDDLE EAST' THEN CASE WHEN rank_total <= 2 THEN 0.02e0 ELSE 0e0 END
    ELSE scope_total_share_pct END AS scope_total_share_pct,
  CASE WHEN scope_name = 'MIDDLE EAST' THEN 0 ELSE total END AS total,
  CASE WHEN scope_name = 'EUROPE' AND entity_code::BIGINT % 6 = 0 THEN 'LARGE' ELSE dominant_category END AS dominant_category,
  CASE WHEN scope_name = 'ASIA' AND rank_total = 10 THEN false ELSE top_10_flag END AS top_10_flag,
  CASE WHEN scope_name <> 'AMERICA' OR entity_code::BIGINT % 7 <> 0 THEN bottom_10_flag END AS bottom_10_flag)
FROM metrics)"""

LINE_KEY = ("l_orderkey", "l_linenumber")
LINE_SPEC = FactSpec(scope_name="l_returnflag", entity_name="l_linestatus", scope_col="l_returnflag")


def line_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with holes in the key and in the values."""
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_suppkey") % 10 != 3, F.col("l_orderkey")).alias("l_orderkey"),
        F.nullif(F.col("l_linenumber"), F.lit(7)).alias("l_linenumber"),
        "l_returnflag",
        F.when(F.col("l_quantity") != 13, F.col("l_linestatus")).alias("l_linestatus"),
    )


def line_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as a fact whose key repeats."""
    quantity = F.col("l_quantity").cast("bigint")
    number = F.col("l_linenumber").cast("bigint")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("scope_name"),
        F.col("l_orderkey").cast("string").alias("scope_id"),
        F.col("l_linestatus").alias("entity_name"),
        F.col("l_linenumber").cast("string").alias("entity_code"),
        F.lit(0).cast("bigint").alias("medium"),
        quantity.alias("micro"),
        number.alias("small"),
        (quantity + number).alias("total"),
    )


def damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with negative counts and wrong totals in some rows."""
    rows = line_fact(spark, sf_dir)
    return rows.withColumns(
        {
            "micro": F.when(F.col("micro") == 50, F.lit(-50)).otherwise(F.col("micro")),
            "entity_name": F.when(F.col("small") != 6, F.col("entity_name")),
        }
    )


# --- the same facts in SQL ----------------------------------------------------

_COUNTS = ",\n".join(
    f"CAST(count(*) FILTER (WHERE o_orderstatus = '{STATUS_OF[c]}') AS BIGINT) AS {c}"
    for c in sorted(STATUS_OF)
)


def _place_sql(name: str, code: str, on: str) -> str:
    return f"""SELECT r_name AS scope_name, CAST(r_regionkey AS VARCHAR) AS scope_id,
  {name} AS entity_name, CAST({code} AS VARCHAR) AS entity_code,
  {_COUNTS}, CAST(count(o_orderkey) AS BIGINT) AS total
FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
LEFT JOIN orders ON o_custkey = c_custkey{on}
GROUP BY r_name, r_regionkey, {name}, {code}"""


ENTITY = f"entity AS ({_place_sql('c_name', 'c_custkey', '')})"
ENTITY_SINCE = (
    f"entity AS ({_place_sql('c_name', 'c_custkey', f" AND o_orderdate >= TIMESTAMP '{SINCE}'")})"
)
NATION = f"entity AS ({_place_sql('n_name', 'n_nationkey', '')})"
WORLD = (
    f"place AS ({_place_sql('c_name', 'c_custkey', '')}), "
    "entity AS (SELECT * REPLACE ('WORLD' AS scope_name, '0' AS scope_id) FROM place)"
)
LINES = (
    "line AS (SELECT CASE WHEN l_suppkey % 10 <> 3 THEN l_orderkey END AS l_orderkey, "
    "nullif(l_linenumber, 7) AS l_linenumber, l_returnflag, "
    "CASE WHEN l_quantity <> 13 THEN l_linestatus END AS l_linestatus FROM lineitem)"
)


def pct(numerator: str, denominator: str) -> str:
    return (
        f"CASE WHEN {denominator} = 0 THEN 0e0 ELSE round_even(CAST({numerator} AS DOUBLE)"
        f" / CAST({denominator} AS DOUBLE) * 100e0 * 10000e0, 0) / 10000e0 END"
    )


def exact_round(value: str, decimals: int) -> str:
    return f"CAST(format('{{:.{decimals}f}}', CAST({value} AS DOUBLE)) AS DOUBLE)"


def kpi_pct(numerator: str, denominator: str) -> str:
    ratio = f"CAST({numerator} AS DOUBLE) / CAST({denominator} AS DOUBLE) * 100e0"
    return f"CASE WHEN {denominator} = 0 THEN 0e0 ELSE {exact_round(ratio, 4)} END"


def ratio(numerator: str, denominator: str) -> str:
    return (
        f"CASE WHEN coalesce({denominator}, 0) = 0 THEN 0e0"
        f" ELSE CAST({numerator} AS DOUBLE) / CAST({denominator} AS DOUBLE) END"
    )


_DOMINANT = """CASE WHEN greatest(micro, small, medium) = 0 THEN 'NO_REGISTRATIONS'
  WHEN (micro = greatest(micro, small, medium))::INT + (small = greatest(micro, small, medium))::INT
     + (medium = greatest(micro, small, medium))::INT > 1 THEN 'TIE'
  WHEN micro = greatest(micro, small, medium) THEN 'MICRO'
  WHEN small = greatest(micro, small, medium) THEN 'SMALL' ELSE 'MEDIUM' END"""

METRICS = f"""ranked AS (SELECT *,
  CAST(row_number() OVER (PARTITION BY scope_name ORDER BY total DESC, entity_name, entity_code)
    AS BIGINT) AS rank_total,
  CAST(row_number() OVER (PARTITION BY scope_name ORDER BY total, entity_name, entity_code)
    AS BIGINT) AS rank_total_ascending,
  CAST(sum(total) OVER (PARTITION BY scope_name) AS BIGINT) AS scope_total,
  count(*) OVER (PARTITION BY scope_name) AS n FROM entity),
metrics AS (SELECT scope_name, scope_id, entity_name, entity_code, medium, micro, small, total,
  rank_total, rank_total_ascending,
  {pct("micro", "total")} AS micro_share_pct, {pct("small", "total")} AS small_share_pct,
  {pct("medium", "total")} AS medium_share_pct,
  {pct("total", "scope_total")} AS scope_total_share_pct,
  {_DOMINANT} AS dominant_category,
  rank_total <= least(10, n) AS top_10_flag,
  rank_total_ascending <= least(10, n) AS bottom_10_flag FROM ranked)"""
