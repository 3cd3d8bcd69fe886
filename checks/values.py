"""Queries over scalar functions, inference and primary keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.functions import clean_name, iso_date, join_list, json_path, resolve_date, snake_text, split_list
from orderloom.operators.filters import of_entity
from orderloom.operators.keys import pk_violations as repeated_keys
from orderloom.sources.bulk import scan_bulk, scan_lines

from .fixtures import landed, table
from .registry import PAIR, LIN, ORD, PART, bulk, query, utc, with_


@query(
    """WITH e AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS anchor, CAST(o_orderkey // 8 % 40 AS INTEGER) AS n,
      o_orderkey % 8 AS form FROM orders)
    SELECT o_orderkey, CAST(CASE form WHEN 0 THEN anchor WHEN 1 THEN anchor - 1 WHEN 2 THEN anchor - n
      WHEN 3 THEN anchor - 7 * n WHEN 4 THEN anchor - to_months(n) WHEN 5 THEN anchor - to_years(n)
      WHEN 6 THEN anchor END AS DATE) AS resolved,
      CASE WHEN form = 7 THEN NULL ELSE strftime(anchor, '%Y-%m-%d') END AS anchor_text
    FROM e"""
)
def resolve_dates(spark, sf_dir):
    anchor = F.col("o_orderdate").cast("date")
    n = F.expr("o_orderkey div 8 % 40").cast("string")
    form = F.col("o_orderkey") % 8
    text = (
        F.when(form == 0, F.lit(" Now "))
        .when(form == 1, F.lit("yesterday"))
        .when(form == 2, F.concat(n, F.lit(" days ago")))
        .when(form == 3, F.concat(n, F.lit(" weeks ago")))
        .when(form == 4, F.concat(n, F.lit(" Month ago")))
        .when(form == 5, F.concat(n, F.lit(" years ago")))
        .when(form == 6, iso_date(F.col("o_orderdate")))
        .otherwise(F.lit("2024-02-30"))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        resolve_date(text, anchor, strict=False).alias("resolved"),
        F.when(form != 7, iso_date(F.col("o_orderdate"))).alias("anchor_text"),
    )


@query(
    """SELECT p_partkey, replace(replace(lower(trim(' ' || p_name || '-' || p_type || ' No ' || p_size || '  ')),
    ' ', '_'), '-', '_') AS dataset FROM part"""
)
def clean_names(spark, sf_dir):
    title = F.concat(F.lit(" "), "p_name", F.lit("-"), "p_type", F.lit(" No "), F.col("p_size").cast("string"), F.lit("  "))
    return table(spark, sf_dir, "part").select("p_partkey", clean_name(title).alias("dataset"))


@query(
    r"""WITH n AS (SELECT p_partkey, split_part(p_name, ' ', 1) || upper(left(split_part(p_name, ' ', 2), 1))
      || substr(split_part(p_name, ' ', 2), 2) || 'SKU' || left(p_type, 1) || lower(substr(p_type, 2)) || 'V' || p_size
      AS name FROM part)
    SELECT p_partkey, name, lower(regexp_replace(regexp_replace(name, '(.)([A-Z][a-z]+)', '\1_\2', 'g'),
      '([a-z0-9])([A-Z])', '\1_\2', 'g')) AS snake FROM n"""
)
def snake_names(spark, sf_dir):
    words = F.split("p_name", " ")
    name = F.concat(
        words[0], F.initcap(words[1]), F.lit("SKU"), F.initcap("p_type"), F.lit("V"), F.col("p_size").cast("string")
    )
    named = table(spark, sf_dir, "part").select("p_partkey", name.alias("name"))
    return named.withColumn("snake", snake_text(F.col("name")))


@query(
    """SELECT event_id AS n, CAST(ts AS DATE) AS day, ts AS moment, strftime(ts, '%H:%M:%S') AS clock,
    CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS amount,
    CASE WHEN event_type = 'error' THEN 'n/a' ELSE strftime(ts, '%Y-%m-%d') END AS mixed FROM events"""
)
def infer_types(spark, sf_dir):
    rows = scan_bulk(spark, landed(spark, sf_dir, "untyped"))
    return rows.select("n", "day", utc("moment"), "clock", "amount", "mixed")


@query(
    with_(ORD, LIN)
    + """SELECT id, total, c_name AS first_name, CASE WHEN o_orderpriority NOT IN ('5-LOW', '2-HIGH')
    THEN 'AUTHORIZATION' END AS first_kind FROM ord UNION ALL SELECT id, NULL, NULL, NULL FROM lin"""
)
def json_paths(spark, sf_dir):
    lines = scan_lines(spark, landed(spark, sf_dir, "order"))
    value = F.col("value")
    return lines.select(
        json_path(value, "$.id").alias("id"),
        json_path(value, "$.totalPriceSet.shopMoney.amount").alias("total"),
        json_path(value, "$.customer.firstName").alias("first_name"),
        json_path(value, "$.transactions[0].kind").alias("first_kind"),
    )


@query(
    """SELECT event_id, TRY_CAST(props ->> '$.k' AS INTEGER) AS k FROM events""", name="json_path"
)
def json_path_of_events(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", json_path(F.col("props"), "$.k").try_cast("int").alias("k"))


@query(
    with_(PART, PAIR)
    + """SELECT 'gid://shop/Metafield/' || p_partkey || '-size' AS id, CAST(p_size AS INTEGER) AS whole,
    CAST(p_size AS DOUBLE) AS real_number FROM prt
    UNION ALL SELECT 'gid://shop/Metafield/' || p_partkey || '-brand', NULL, NULL FROM prt
    UNION ALL SELECT 'gid://shop/Metafield/v-' || l_partkey || '-' || l_suppkey, CAST(n_lines AS INTEGER), CAST(n_lines AS DOUBLE)
    FROM pair"""
)
def safe_cast(spark, sf_dir):
    fields = of_entity(bulk(spark, sf_dir, "product"), "Metafield")
    return fields.select(
        "id", F.col("value").try_cast("int").alias("whole"), F.col("value").try_cast("double").alias("real_number")
    )


@query(
    with_(PART)
    + "SELECT id, array_to_string(tags, ',') AS joined, CAST(len(tags) AS INTEGER) AS n_parts FROM prt"
)
def list_join(spark, sf_dir):
    rows = of_entity(bulk(spark, sf_dir, "product"), "Product").select("id", join_list(F.col("tags")).alias("joined"))
    return rows.withColumn("n_parts", F.size(split_list(F.col("joined"))))


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY l_orderkey, l_linenumber
    HAVING count(*) > 1"""
)
def pk_violations(spark, sf_dir):
    return repeated_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
