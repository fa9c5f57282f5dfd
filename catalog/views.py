"""Adapter views: the given tables seen as deals, item details and stores.

The flat SQL runs as it stands on Spark and on the checking engine. Nulls, empty
keys, malformed texts and failed lookups (by another key) are put in by modulus,
because the given tables have none. The views keep every row of their table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEALS = """
SELECT l_orderkey AS ord1, l_linenumber AS ord2,
  CASE WHEN l_partkey % 23 = 0 THEN NULL WHEN l_partkey % 23 = 1 THEN ''
       ELSE CAST(l_partkey AS STRING) END AS item_id,
  CASE WHEN l_suppkey % 19 = 0 THEN NULL ELSE CAST(l_suppkey AS STRING) END AS store_id,
  CAST(l_extendedprice * (1 - l_discount) / l_quantity AS STRING) AS sale_price,
  CASE WHEN l_orderkey % 101 = 0 THEN 'n/a'
       ELSE CAST(l_extendedprice / l_quantity AS STRING) END AS list_price,
  CASE WHEN l_linenumber = 7 THEN NULL
       ELSE CAST(least(CAST(100 AS DOUBLE), l_discount * 1000 + 5 * (l_linenumber % 2)) AS STRING)
       END AS discount,
  CASE WHEN l_partkey % 5 = 0 THEN NULL WHEN l_partkey % 5 < 3 THEN 'Mixed'
       ELSE 'Very Positive' END AS rating_label,
  CASE WHEN l_partkey % 13 = 0 THEN NULL WHEN l_orderkey % 97 = 0 THEN 'n/a'
       ELSE CAST(l_partkey % 101 AS STRING) END AS rating_pct,
  CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot_date
FROM {lineitem}
"""

DETAILS = """
SELECT CASE WHEN p_partkey % 59 = 0 THEN concat('x', CAST(p_partkey AS STRING))
       ELSE CAST(p_partkey AS STRING) END AS item_id, p_partkey % 17 <> 0 AS success,
  CASE WHEN p_partkey % 37 = 0 THEN NULL
       WHEN p_partkey % 43 = 0 THEN concat(chr(9), p_name, ' ')
       ELSE concat('  ', p_name, ' ') END AS name,
  CASE WHEN p_partkey % 29 = 0 THEN NULL WHEN p_partkey % 10 < 6 THEN 'USD'
       WHEN p_partkey % 10 < 9 THEN 'BRL' ELSE 'EUR' END AS currency,
  CASE WHEN p_partkey % 29 = 0 THEN NULL
       ELSE CAST(round(p_retailprice * 100, 0) AS BIGINT) END AS final_minor,
  CASE WHEN p_partkey % 29 = 0 THEN NULL
       ELSE CAST(round(p_retailprice * 100, 0) AS BIGINT) + p_size * 25 END AS initial_minor,
  CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE CAST(p_size AS BIGINT) END AS ref_discount,
  p_partkey % 31 <> 0 AS has_tags,
  CASE WHEN p_partkey % 47 = 0 THEN 'x' ELSE CAST(ascii(split_part(p_name, ' ', 1)) * 1000000
       + ascii(substr(split_part(p_name, ' ', 1), 2, 1)) * 1000
       + ascii(substr(split_part(p_name, ' ', 1), 3, 1)) AS STRING) END AS tag1_id,
  CASE WHEN p_partkey % 41 = 0 THEN NULL
       ELSE concat(' ', split_part(p_name, ' ', 1)) END AS tag1_name,
  CASE WHEN p_partkey % 7 = 0 THEN CAST(ascii(split_part(p_name, ' ', 1)) * 1000000
       + ascii(substr(split_part(p_name, ' ', 1), 2, 1)) * 1000
       + ascii(substr(split_part(p_name, ' ', 1), 3, 1)) AS STRING)
       ELSE CAST(ascii(split_part(p_name, ' ', 2)) * 1000000
       + ascii(substr(split_part(p_name, ' ', 2), 2, 1)) * 1000
       + ascii(substr(split_part(p_name, ' ', 2), 3, 1)) AS STRING) END AS tag2_id,
  split_part(p_name, ' ', 2) AS tag2_name,
  p_partkey % 53 <> 0 AS has_makers,
  p_brand AS maker1,
  CASE WHEN p_partkey % 3 = 0 THEN concat(p_brand, ' ') WHEN p_partkey % 19 = 0 THEN NULL
       ELSE p_type END AS maker2
FROM {part}
"""

STORES = """
SELECT CASE WHEN s_suppkey % 11 = 0 THEN concat('x', CAST(s_suppkey AS STRING))
       ELSE CAST(s_suppkey AS STRING) END AS store_id, s_name AS store_name
FROM {supplier}
"""

RAW_STORES = """
SELECT s_suppkey - s_suppkey % 3 AS store_id, s_name AS store_name, s_suppkey AS ord1
FROM {supplier}
"""

#: Names with letters beyond ASCII, in both cases.
ACCENTED = """
SELECT CAST(p_partkey AS STRING) AS item_id,
  CASE WHEN p_partkey % 2 = 0 THEN upper(replace(p_name, 'e', 'é'))
       ELSE replace(p_name, 'e', 'é') END AS name
FROM {part}
"""


SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(DEALS, lineitem=table(spark, sf_dir, "lineitem"))


def flat_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(DETAILS, part=table(spark, sf_dir, "part"))


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat view packed into the nested shape of landed details."""
    price = F.when(
        F.col("currency").isNotNull(),
        F.struct(
            "currency",
            F.col("initial_minor").alias("initial"),
            F.col("final_minor").alias("final"),
            F.col("ref_discount").alias("discount_percent"),
        ),
    )
    tag = lambda n: F.struct(
        F.col(f"tag{n}_id").alias("id"), F.col(f"tag{n}_name").alias("description")
    )
    makers = F.when(F.col("has_makers"), F.array("maker1", "maker2")).otherwise(
        F.array().cast("array<string>")
    )
    return flat_details(spark, sf_dir).select(
        "item_id",
        "success",
        "name",
        price.alias("price"),
        F.when(F.col("has_tags"), F.array(tag(1), tag(2))).alias("tags"),
        makers.alias("makers"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(STORES, supplier=table(spark, sf_dir, "supplier"))


def accented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ACCENTED, part=table(spark, sf_dir, "part"))


def raw_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_STORES, supplier=table(spark, sf_dir, "supplier"))
