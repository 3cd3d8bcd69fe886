"""Registered queries and, next to each, the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderloom.schemas import dataset_schema
from orderloom.session import tune
from orderloom.sources.bulk import scan_bulk
from orderloom.sources.pages import scan_pages

from .fixtures import landed

QueryFunction = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFunction] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[QueryFunction], QueryFunction]:
    """Register a query under a name, by default its function's."""

    def add(function: QueryFunction) -> QueryFunction:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(tune(spark), sf_dir)

        key = name or function.__name__
        QUERIES[key] = run
        if sql:
            ORACLES[key] = sql
        return run

    return add


def bulk(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Typed scan of a fixed dataset's export."""
    return scan_bulk(spark, landed(spark, sf_dir, name), dataset_schema(name))


def pages(spark: SparkSession, sf_dir: str, name: str, schema: str) -> DataFrame:
    return scan_pages(spark, landed(spark, sf_dir, name), schema)


def utc(name: str, alias: str | None = None) -> Column:
    """An instant as wall-clock time in UTC, the session's zone."""
    return F.col(name).cast("timestamp_ntz").alias(alias or name)


# --- the exports as SQL over the flat tables ------------------------------------

ORD = """
ord AS (
  SELECT o_orderkey, 'gid://shop/Order/' || o_orderkey AS id, '#' || o_orderkey AS name,
         lower(c_name) || '@example.com' AS email, o_orderdate AS created_at,
         o_orderdate + to_days(CAST(o_orderkey % 30 AS INTEGER)) AS updated_at,
         CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 1 DAY END AS cancelled_at,
         CASE WHEN o_orderstatus = 'P' THEN 'customer' END AS cancel_reason,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total,
         CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS subtotal,
         CASE WHEN o_orderstatus <> 'P' THEN '0.00' END AS tax,
         'gid://shop/Customer/' || o_custkey AS customer_id,
         c_name, c_mktsegment, c_nationkey, o_orderstatus, o_orderpriority
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

LIN = """
lin AS (
  SELECT *, 'gid://shop/LineItem/' || concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id,
         'gid://shop/Order/' || l_orderkey AS parent_id, 'Part ' || l_partkey AS title,
         CAST(l_quantity AS INTEGER) AS quantity, 'P' || l_partkey || '-S' || l_suppkey AS sku,
         CASE WHEN l_linenumber <> 7 THEN 'gid://shop/ProductVariant/' || l_partkey || '-' || l_suppkey END AS variant_id,
         CASE WHEN l_linenumber <> 7 THEN 'S' || l_suppkey END AS variant_title,
         CASE WHEN l_linenumber <> 7 THEN 'P' || l_partkey || '-S' || l_suppkey END AS variant_sku,
         CASE WHEN l_linenumber <> 7 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS variant_price,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                            l_quantity, l_extendedprice) AS rn
  FROM lineitem)"""

TXN = """
txn AS (
  SELECT ord.id AS parent_id, i AS row_number,
         'gid://shop/Transaction/' || o_orderkey || '-' || i AS id,
         ['AUTHORIZATION', 'CAPTURE', 'REFUND'][i] AS kind, total,
         created_at + to_days(CAST(i AS INTEGER)) AS created_at
  FROM ord, generate_series(1, 3) AS g(i)
  WHERE i <= o_orderkey % 3 + 1 AND o_orderpriority NOT IN ('5-LOW', '2-HIGH'))"""

PART = """
prt AS (
  SELECT *, 'gid://shop/Product/' || p_partkey AS id, replace(p_name, ' ', '-') || '-' || p_partkey AS handle,
         ['ACTIVE', 'DRAFT', 'ARCHIVED', 'UNLISTED'][p_size % 4 + 1] AS status,
         CASE WHEN p_size % 10 = 0 THEN [] ELSE string_split(p_name, ' ') END AS tags,
         CAST(DATE '2020-01-01' + CAST(p_partkey % 365 AS INTEGER) AS TIMESTAMP) AS created_at,
         CAST(DATE '2020-01-01' + CAST(p_partkey % 365 AS INTEGER) + p_size AS TIMESTAMP) AS updated_at
  FROM part)"""

PAIR = """
pair AS (
  SELECT l_partkey, l_suppkey, count(*) AS n_lines, CAST(sum(l_quantity) AS INTEGER) AS quantity,
         CAST(CAST(max(l_extendedprice) AS DECIMAL(18,2)) AS VARCHAR) AS price, max(l_shipdate) AS shipped,
         'gid://shop/Product/' || l_partkey AS product_id,
         'gid://shop/ProductVariant/' || l_partkey || '-' || l_suppkey AS variant_id,
         'gid://shop/InventoryItem/' || l_partkey AS item_id,
         'gid://shop/InventoryLevel/' || l_partkey || '-' || l_suppkey AS level_id,
         'gid://shop/Location/' || l_suppkey AS location_id
  FROM lineitem GROUP BY l_partkey, l_suppkey)"""

PRODUCT_LINES = """
product_lines AS (
  SELECT id, NULL AS parent_id, 'Product' AS entity, status, updated_at, created_at, id AS root FROM prt
  UNION ALL SELECT variant_id, product_id, 'ProductVariant', NULL, NULL, NULL, product_id FROM pair
  UNION ALL SELECT 'gid://shop/ProductImage/' || p_partkey, id, 'ProductImage', NULL, NULL, NULL, id FROM prt
  UNION ALL SELECT 'gid://shop/Metafield/' || p_partkey || '-size', id, 'Metafield', NULL, NULL, created_at, id FROM prt
  UNION ALL SELECT 'gid://shop/Metafield/' || p_partkey || '-brand', id, 'Metafield', NULL, NULL, created_at, id FROM prt
  UNION ALL SELECT 'gid://shop/Metafield/v-' || l_partkey || '-' || l_suppkey, variant_id, 'Metafield', NULL, NULL,
                   shipped, product_id FROM pair)"""

CUST = """
cust AS (
  SELECT *, 'gid://shop/Customer/' || c_custkey AS id, lower(c_name) || '@example.com' AS email,
         CAST(DATE '2019-01-01' + CAST(c_custkey % 700 AS INTEGER) AS TIMESTAMP) AS created_at,
         CAST(DATE '2019-01-01' + CAST(c_custkey % 700 AS INTEGER) + c_nationkey AS TIMESTAMP) AS updated_at,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL
              WHEN c_acctbal < 0 THEN 'UNSUBSCRIBED' ELSE 'SUBSCRIBED' END AS consent,
         CASE WHEN c_acctbal < 0 THEN 0 WHEN c_nationkey % 2 = 0 THEN 1 ELSE 2 END AS n_addresses
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

LOC = """
loc AS (
  SELECT *, 'gid://shop/Location/' || s_suppkey AS id, s_acctbal < 0 AS outside
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"
