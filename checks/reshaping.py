"""Queries over renames, nested data, child tables and relations."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.functions import gid_key, join_list
from orderloom.operators import curated, reshape
from orderloom.operators.entities import entity_types as distinct_entity_types, split_entities, write_split
from orderloom.operators.filters import date_window, of_entity
from orderloom.operators.ordinals import occurrence
from orderloom.operators.relations import attach_parent, orphans, with_children
from orderloom.session import scratch_path
from orderloom.sources import datasets
from orderloom.sources.bulk import entity_keys as key_scan, list_entity_keys, scan_lines

from .fixtures import LINE_BLOCK, LINE_ORDER, landed, table
from .registry import CUST, LIN, LOC, ORD, PAIR, PART, PRODUCT_LINES, TXN, bulk, query, utc, with_
from .scans import LEVELS_SQL, inventory_docs, level_columns, order_docs, product_docs


@query(
    with_(PART)
    + """SELECT id, p_name AS title, handle, p_brand AS vendor, p_type AS product_type, status,
    created_at, updated_at, CASE WHEN status <> 'DRAFT' THEN created_at END AS published_at,
    p_size AS total_inventory FROM prt"""
)
def rename_snake(spark, sf_dir):
    rows = of_entity(bulk(spark, sf_dir, "product"), "Product", app="shop").select(
        "id", "title", "handle", "vendor", "productType", "status",
        utc("createdAt"), utc("updatedAt"), utc("publishedAt"), "totalInventory",
    )
    return reshape.rename_snake(rows)


@query(
    with_(LOC)
    + """SELECT id,
    '{"address1":"Dock ' || s_suppkey || '","address2":null,"city":"City ' || s_nationkey || '","province":"' || r_name
    || '","country":"' || n_name || '","zip":"' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') || '","phone":null}' AS address,
    CASE WHEN outside THEN '{"id":"gid://shop/FulfillmentService/' || s_suppkey || '","serviceName":"3PL '
    || s_nationkey || '"}' END AS fulfillment_service FROM loc"""
)
def nested_to_json(spark, sf_dir):
    rows = reshape.nested_to_json(bulk(spark, sf_dir, "location"))
    return rows.select("id", "address", F.col("fulfillmentService").alias("fulfillment_service"))


@query(
    with_(ORD)
    + """SELECT id, total, 'USD' AS total_currency, subtotal, tax, '5.00' AS shipping FROM ord"""
)
def flatten_money(spark, sf_dir):
    return reshape.flatten(
        of_entity(bulk(spark, sf_dir, "order"), "Order", app="shop"),
        {
            "total": "totalPriceSet.shopMoney.amount",
            "total_currency": "totalPriceSet.shopMoney.currencyCode",
            "subtotal": "subtotalPriceSet.shopMoney.amount",
            "tax": "totalTaxSet.shopMoney.amount",
            "shipping": "totalShippingPriceSet.shopMoney.amount",
        },
        keep=["id"],
    )


@query(
    with_(ORD)
    + """SELECT id, customer_id, c_name AS first_name, c_mktsegment AS last_name, email AS customer_email,
    CAST(NULL AS VARCHAR) AS customer_phone FROM ord"""
)
def flatten_customer(spark, sf_dir):
    return reshape.flatten(
        of_entity(bulk(spark, sf_dir, "order"), "Order", app="shop"),
        {
            "customer_id": "customer.id",
            "first_name": "customer.firstName",
            "last_name": "customer.lastName",
            "customer_email": "customer.email",
            "customer_phone": "customer.phone",
        },
        keep=["id"],
    )


@query(
    with_(ORD)
    + """SELECT id AS parent_id, CASE WHEN subtotal IS NOT NULL
    THEN '{"amount":"' || subtotal || '","currencyCode":"USD"}' END AS shop_money FROM ord"""
)
def object_child(spark, sf_dir):
    return reshape.object_child(bulk(spark, sf_dir, "order"), "subtotalPriceSet")


@query(
    with_(CUST)
    + """SELECT id AS parent_id, 'gid://shop/MailingAddress/' || c_custkey || '-1' AS id, c_name AS first_name,
    c_mktsegment AS last_name, CAST(NULL AS VARCHAR) AS address1, CAST(NULL AS VARCHAR) AS address2,
    'City ' || c_nationkey AS city, r_name AS province, n_name AS country, CAST(NULL AS VARCHAR) AS zip,
    CAST(NULL AS VARCHAR) AS phone, c_name AS name, left(r_name, 2) AS province_code,
    'N' || c_nationkey AS country_code_v2 FROM cust WHERE c_acctbal >= 0"""
)
def object_child_address(spark, sf_dir):
    return reshape.object_child(bulk(spark, sf_dir, "customer"), "defaultAddress")


@query(
    with_(ORD, TXN)
    + """SELECT parent_id, row_number, id, kind, 'SUCCESS' AS status, false AS test,
    '{"shopMoney":{"amount":"' || total || '","currencyCode":"USD"}}' AS amount_set, 'manual' AS gateway,
    created_at FROM txn"""
)
def array_child_struct(spark, sf_dir):
    return reshape.array_child(bulk(spark, sf_dir, "order"), "transactions").select(
        "parent_id", "row_number", "id", "kind", "status", "test", "amount_set", "gateway", utc("created_at")
    )


@query(
    with_(CUST)
    + """SELECT id AS parent_id, n AS row_number, 'gid://shop/MailingAddress/' || c_custkey || '-' || n AS id,
    CASE n WHEN 1 THEN 'City ' ELSE 'Second ' END || c_nationkey AS city, n_name AS country
    FROM cust, generate_series(1, 2) AS g(n) WHERE n <= n_addresses"""
)
def array_child_addresses(spark, sf_dir):
    rows = reshape.array_child(bulk(spark, sf_dir, "customer"), "addresses")
    return rows.select("parent_id", "row_number", "id", "city", "country")


@query(
    with_(PART)
    + """SELECT id AS parent_id, generate_subscripts(tags, 1) AS row_number, unnest(tags) AS item FROM prt"""
)
def array_child_scalar(spark, sf_dir):
    return reshape.array_child(bulk(spark, sf_dir, "product"), "tags")


ITEMS_SQL = """SELECT parent_id AS order_id, rn AS row_number, id AS line_item_id, title, quantity, sku,
    variant_id, variant_title, variant_sku, variant_price FROM lin"""


@query(with_(LIN) + ITEMS_SQL)
def order_line_items(spark, sf_dir):
    return reshape.rename_snake(curated.order_line_items(order_docs(spark, sf_dir, "id", "lineItems")))


@query(
    with_(ORD, LIN)
    + """SELECT parent_id AS order_id, rn AS row_number, lin.id AS line_item_id, quantity,
    CAST(variant_price AS DECIMAL(18,2)) AS price, name AS order_name, created_at, total
    FROM lin JOIN ord ON lin.parent_id = ord.id"""
)
def order_items_with_header(spark, sf_dir):
    """Items of nested orders with the order's own columns: carried along with the
    exploded document, so there is no join."""
    carried = [
        F.col("name").alias("order_name"),
        utc("createdAt", "created_at"),
        F.col("totalPriceSet.shopMoney.amount").alias("total"),
    ]
    docs = order_docs(spark, sf_dir, "id", "name", "createdAt", "totalPriceSet", "lineItems")
    rows = curated.nodes(docs, "lineItems", "order_id", *carried)
    return rows.select(
        "order_id",
        "row_number",
        F.col("node.id").alias("line_item_id"),
        F.col("node.quantity").alias("quantity"),
        F.col("node.variant.price").cast("decimal(18,2)").alias("price"),
        "order_name",
        "created_at",
        "total",
    )


@query(
    with_(PART, PAIR)
    + """SELECT product_id, variant_id, 'S' || l_suppkey AS title, 'P' || l_partkey || '-S' || l_suppkey AS sku,
    price, CAST(NULL AS VARCHAR) AS compare_at_price, quantity AS inventory_quantity,
    CAST(n_lines * 0.5 AS DOUBLE) AS weight, 'KILOGRAMS' AS weight_unit FROM pair"""
)
def product_variants(spark, sf_dir):
    return reshape.rename_snake(curated.product_variants(product_docs(spark, sf_dir, "id", "variants")))


@query(LEVELS_SQL)
def inventory_levels(spark, sf_dir):
    return level_columns(curated.inventory_levels(inventory_docs(spark, sf_dir, "id", "inventoryLevels")))


@query(
    with_(ORD)
    + """SELECT id, name, email, CAST(NULL AS VARCHAR) AS phone, created_at, updated_at, created_at AS processed_at,
    cancelled_at, cancel_reason, total AS total_price, 'USD' AS total_price_currency, subtotal AS subtotal_price,
    CASE WHEN subtotal IS NOT NULL THEN 'USD' END AS subtotal_price_currency, tax AS total_tax,
    CASE WHEN tax IS NOT NULL THEN 'USD' END AS total_tax_currency, '5.00' AS total_shipping_price,
    'USD' AS total_shipping_price_currency, customer_id, c_name AS customer_first_name,
    c_mktsegment AS customer_last_name, email AS customer_email, CAST(NULL AS VARCHAR) AS customer_phone FROM ord"""
)
def order_header(spark, sf_dir):
    rows = reshape.rename_snake(curated.order_header(order_docs(spark, sf_dir, "header", "lineItems")))
    for column in ("created_at", "updated_at", "processed_at", "cancelled_at"):
        rows = rows.withColumn(column, utc(column))
    return rows


@query(
    with_(PART)
    + """SELECT id, p_name AS title, handle, CAST(NULL AS VARCHAR) AS description, p_type AS product_type,
    p_brand AS vendor, created_at, updated_at, CASE WHEN status <> 'DRAFT' THEN created_at END AS published_at,
    status, CASE WHEN len(tags) = 0 THEN '[]' ELSE '["' || array_to_string(tags, '","') || '"]' END AS tags FROM prt"""
)
def product_header(spark, sf_dir):
    rows = reshape.tidy(curated.product_header(product_docs(spark, sf_dir, "header", "variants")))
    for column in ("created_at", "updated_at", "published_at"):
        rows = rows.withColumn(column, utc(column))
    return rows


@query(
    with_(PART)
    + """SELECT 'gid://shop/InventoryItem/' || p_partkey AS id, 'P' || p_partkey AS sku, p_size % 2 = 0 AS tracked,
    created_at, updated_at, 'N' || p_size AS country_code_of_origin, CAST(NULL AS VARCHAR) AS harmonized_system_code,
    CAST(NULL AS VARCHAR) AS province_code_of_origin, p_size > 25 AS requires_shipping,
    CASE WHEN p_size % 7 <> 0 THEN CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) END AS unit_cost_amount,
    CASE WHEN p_size % 7 <> 0 THEN 'USD' END AS unit_cost_currency,
    'gid://shop/ProductVariant/' || p_partkey AS variant_id, p_type AS variant_title, 'P' || p_partkey AS variant_sku,
    CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS variant_price, id AS product_id,
    p_name AS product_title, handle AS product_handle FROM prt"""
)
def inventory_item_header(spark, sf_dir):
    rows = reshape.rename_snake(curated.inventory_item_header(inventory_docs(spark, sf_dir, "header", "inventoryLevels")))
    return rows.withColumn("created_at", utc("created_at")).withColumn("updated_at", utc("updated_at"))


@query(
    with_(PART)
    + """SELECT 'gid://shop/ProductImage/' || p_partkey AS id,
    'https://img.example.com/' || p_partkey || '.png' AS url, p_name AS alt_text, p_size + 100 AS width,
    200 AS height, id AS parent_id FROM prt"""
)
def entity_prune(spark, sf_dir):
    """Images with the columns that images have, found by the key scan."""
    keys = list_entity_keys(scan_lines(spark, landed(spark, sf_dir, "product")))
    return reshape.tidy(split_entities(bulk(spark, sf_dir, "product"), keys)["product_image"])


@query(with_(LIN) + "SELECT id, parent_id, title, quantity FROM lin")
def parent_link(spark, sf_dir):
    rows = of_entity(bulk(spark, sf_dir, "order"), "LineItem", app="shop")
    return reshape.parent_link(rows).select("id", "parent_id", "title", "quantity")


@query(
    with_(PART, PAIR)
    + """, few AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_suppkey) AS n FROM pair)
    SELECT product_id AS id, string_agg(variant_id, ',' ORDER BY n) AS first_variants
    FROM few WHERE n <= 3 GROUP BY product_id"""
)
def nested_first_n(spark, sf_dir):
    docs = curated.first_documents(product_docs(spark, sf_dir, "id", "variants"), "variants")
    lists = docs.select("id", F.col("variants.edges.node.id").alias("variant_ids")).where(
        F.col("variant_ids").isNotNull()
    )
    few = reshape.first_n(lists, "variant_ids", 3)
    return few.select("id", join_list(F.col("variant_ids")).alias("first_variants"))


@query(with_(PAIR) + "SELECT level_id AS id, 'available' AS name, quantity FROM pair")
def quantity_by_name(spark, sf_dir):
    levels = of_entity(bulk(spark, sf_dir, "inventory"), "InventoryLevel", app="shop")
    kept = reshape.named_elements(levels, "quantities", ["available"])
    return kept.select("id", F.inline("quantities"))


@query(
    with_(PART, PAIR, PRODUCT_LINES)
    + """SELECT id, entity FROM product_lines WHERE NOT (entity = 'Metafield' AND id NOT LIKE '%/v-%')
    AND root IN (SELECT id FROM prt)"""
)
def optional_sections(spark, sf_dir):
    """Products with variant metafields, without product metafields."""
    every = ["active", "draft", "archived", "unlisted"]
    kept = datasets.products(bulk(spark, sf_dir, "product"), every, variant_metafields=True)
    return kept.select("id", F.regexp_extract("id", "^gid://shop/([^/]+)/", 1).alias("entity"))


# --- relations -------------------------------------------------------------------


@query(
    with_(ORD, LIN)
    + """SELECT lin.id, parent_id, quantity, name AS order_name, total AS order_total
    FROM lin JOIN ord ON parent_id = ord.id"""
)
def parent_child_join(spark, sf_dir):
    mixed = bulk(spark, sf_dir, "order")
    items = reshape.parent_link(of_entity(mixed, "LineItem", app="shop")).select("id", "parent_id", "quantity")
    heads = reshape.flatten(
        of_entity(mixed, "Order", app="shop"), {"name": "name", "total": "totalPriceSet.shopMoney.amount"}, keep=["id"]
    )
    return attach_parent(items, heads, ["name", "total"], prefix="order_")


@query(
    with_(ORD, LIN)
    + """SELECT lin.id, parent_id, quantity FROM lin ANTI JOIN
    (SELECT id FROM ord WHERE created_at < DATE '1999-01-01') AS early ON parent_id = early.id"""
)
def orphan_children(spark, sf_dir):
    """Line items whose order is not in a partial export."""
    mixed = bulk(spark, sf_dir, "order")
    items = reshape.parent_link(of_entity(mixed, "LineItem", app="shop")).select("id", "parent_id", "quantity")
    return orphans(items, date_window(of_entity(mixed, "Order", app="shop"), "createdAt", to="1999-01-01"))


@query(
    with_(LOC, PAIR)
    + """, few AS (SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY level_id) AS n FROM pair),
    lists AS (SELECT location_id, CAST(count(*) AS INTEGER) AS n_levels,
                     string_agg(level_id || ':' || quantity, ',' ORDER BY n) AS levels
              FROM few WHERE n <= 10 GROUP BY location_id)
    SELECT id, s_name AS name, n_levels, levels FROM loc LEFT JOIN lists ON location_id = id"""
)
def location_with_levels(spark, sf_dir):
    levels = of_entity(bulk(spark, sf_dir, "inventory"), "InventoryLevel", app="shop").select(
        "id",
        F.col("location.id").alias("location_id"),
        F.filter("quantities", lambda q: q["name"] == "available")[0]["quantity"].alias("available"),
    )
    nested = with_children(
        bulk(spark, sf_dir, "location"), levels, 10, ["id"], ["id", "available"], link="location_id", name="levels"
    )
    shown = F.transform("levels", lambda e: F.concat_ws(":", e["id"], e["available"].cast("string")))
    return nested.select("id", "name", F.array_size("levels").alias("n_levels"), join_list(shown).alias("levels"))


@query(
    with_(LOC, PAIR)
    + """, hot AS (SELECT *, CASE WHEN l_partkey % 3 = 0 THEN (SELECT min(id) FROM loc) ELSE location_id END AS owner FROM pair),
    few AS (SELECT *, row_number() OVER (PARTITION BY owner ORDER BY level_id) AS n FROM hot),
    lists AS (SELECT owner, CAST(count(*) AS INTEGER) AS n_levels, string_agg(level_id, ',' ORDER BY n) AS levels
              FROM few WHERE n <= 1000 GROUP BY owner)
    SELECT id, n_levels, levels FROM loc LEFT JOIN lists ON owner = id"""
)
def hot_location_levels(spark, sf_dir):
    """The first 1,000 levels of each location; one location has a third of all levels."""
    locations = bulk(spark, sf_dir, "location").select("id")
    least = locations.agg(F.min("id")).first()[0]
    levels = of_entity(bulk(spark, sf_dir, "inventory"), "InventoryLevel", app="shop")
    part = F.regexp_extract("id", r"/(\d+)-", 1).cast("long")
    owner = F.when(part % 3 == 0, F.lit(least)).otherwise(F.col("location.id")).alias("owner")
    nested = with_children(locations, levels.select("id", owner), 1000, ["id"], ["id"], link="owner", name="levels")
    return nested.select("id", F.array_size("levels").alias("n_levels"), join_list(F.transform("levels", lambda e: e["id"])).alias("levels"))


# --- ordinals --------------------------------------------------------------------


@query(with_(LIN) + "SELECT parent_id, rn AS row_number, id, quantity FROM lin")
def child_row_number(spark, sf_dir):
    """Ordinals from the position in the list; a continued list starts at its offset."""
    docs = order_docs(spark, sf_dir, "id", "lineItems").select(
        "id", F.col("lineItems.offset").alias("first"), F.col("lineItems.edges.node").alias("items")
    )
    rows = reshape.array_child(docs, "items", first=F.col("first"))
    return rows.select("parent_id", "row_number", "id", "quantity")


@query(
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS occurrence FROM lineitem"""
)
def parent_occurrence(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER)
    numbered = occurrence(lines, ["l_orderkey"], LINE_ORDER, F.expr(LINE_BLOCK), name="occurrence")
    return numbered.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "occurrence")


# --- entities --------------------------------------------------------------------

KEYS_SQL = (
    with_(ORD, LIN)
    + """SELECT DISTINCT * FROM (
    SELECT 'Order' AS entity_type, unnest(['id', 'name', 'email', 'createdAt', 'updatedAt', 'processedAt',
        'totalPriceSet', 'subtotalPriceSet', 'totalShippingPriceSet', 'customer', 'shippingAddress']) AS key FROM ord
    UNION ALL SELECT 'Order', 'totalTaxSet' FROM ord WHERE tax IS NOT NULL
    UNION ALL SELECT 'Order', unnest(['cancelledAt', 'cancelReason']) FROM ord WHERE cancel_reason IS NOT NULL
    UNION ALL SELECT 'Order', 'billingAddress' FROM ord WHERE o_orderstatus <> 'O'
    UNION ALL SELECT 'Order', 'transactions' FROM ord WHERE o_orderpriority <> '2-HIGH'
    UNION ALL SELECT 'LineItem', unnest(['id', 'title', 'quantity', 'sku', '__parentId']) FROM lin
    UNION ALL SELECT 'LineItem', 'variant' FROM lin WHERE l_linenumber <> 7)"""
)


@query(KEYS_SQL)
def entity_keys(spark, sf_dir):
    return key_scan(scan_lines(spark, landed(spark, sf_dir, "order")))


@query(
    with_(PART, PAIR, PRODUCT_LINES) + "SELECT DISTINCT entity AS entity_type FROM product_lines"
)
def entity_types(spark, sf_dir):
    return distinct_entity_types(bulk(spark, sf_dir, "product"))


@query(
    with_(PART, PAIR, PRODUCT_LINES)
    + "SELECT id, entity AS entity_type, parent_id, status, updated_at FROM product_lines"
)
def entity_split(spark, sf_dir):
    """One folder per entity type, read back as one table."""
    path = scratch_path(spark, "split-product")
    write_split(bulk(spark, sf_dir, "product"), path)
    back = spark.read.parquet(path)
    return back.select("id", "entity_type", F.col("__parentId").alias("parent_id"), "status", utc("updatedAt", "updated_at"))


@query(
    with_(PART, PAIR, PRODUCT_LINES)
    + """SELECT id, entity AS entity_type, regexp_extract(id, '^gid://[^/]+/[^/]+/(.+)$', 1) AS key
    FROM product_lines"""
)
def gid_type(spark, sf_dir):
    from orderloom.functions import entity_type

    rows = bulk(spark, sf_dir, "product")
    return rows.select("id", entity_type(F.col("id")).alias("entity_type"), gid_key(F.col("id")).alias("key"))
