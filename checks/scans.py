"""Queries over scans and datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderloom import schemas
from orderloom.functions import entity_type, join_list
from orderloom.operators import curated
from orderloom.plans.normalise import normalise, stage
from orderloom.sources import datasets
from orderloom.sources.bulk import scan_by_entity, scan_lines
from orderloom.sources.pages import array_records, flatten_pages, scan_json_array

from .fixtures import landed
from .registry import CUST, LIN, LOC, ORD, PAIR, PART, PRODUCT_LINES, TXN, bulk, pages, query, utc, with_

CUSTOMER_PAGES = schemas.page("customers", schemas.CUSTOMER)
METAFIELD_PAGES = schemas.page("metafields", schemas.PAGED_METAFIELD)


def document_pages(spark, sf_dir, fixture, key, contract, fields):
    """Pages scanned with the fields that a query uses, or with all.  `header` stands
    for all but the entries of the connection that is named last."""
    wanted = contract
    if fields[:1] == ("header",):
        wanted = schemas.pick(contract, *[f for f in contract if f != fields[1]], f"{fields[1]}.offset")
    elif fields:
        wanted = schemas.pick(contract, *fields)
    return pages(spark, sf_dir, fixture, schemas.page(key, wanted))


def order_pages(spark, sf_dir, *fields):
    return document_pages(spark, sf_dir, "order_pages", "orders", schemas.PAGED_ORDER, fields)


def product_pages(spark, sf_dir, *fields):
    return document_pages(spark, sf_dir, "product_pages", "products", schemas.PAGED_PRODUCT, fields)


def inventory_pages(spark, sf_dir, *fields):
    return document_pages(spark, sf_dir, "inventory_pages", "inventoryItems", schemas.PAGED_INVENTORY_ITEM, fields)


def order_docs(spark, sf_dir, *fields):
    return flatten_pages(order_pages(spark, sf_dir, *fields), "orders")


def product_docs(spark, sf_dir, *fields):
    return flatten_pages(product_pages(spark, sf_dir, *fields), "products")


def inventory_docs(spark, sf_dir, *fields):
    return flatten_pages(inventory_pages(spark, sf_dir, *fields), "inventoryItems")


@query(
    with_(ORD, LIN)
    + """SELECT id, NULL AS parent_id, name, created_at, total, NULL AS title, NULL AS quantity FROM ord
    UNION ALL SELECT id, parent_id, NULL, NULL, NULL, title, quantity FROM lin"""
)
def scan_bulk_jsonl(spark, sf_dir):
    return bulk(spark, sf_dir, "order").select(
        "id",
        F.col("__parentId").alias("parent_id"),
        "name",
        utc("createdAt", "created_at"),
        F.col("totalPriceSet.shopMoney.amount").alias("total"),
        "title",
        "quantity",
    )


@query(
    with_(LIN)
    + """SELECT id, parent_id, title, quantity, sku, variant_id, variant_price FROM lin"""
)
def scan_by_entity_type(spark, sf_dir):
    parts = scan_by_entity(spark, landed(spark, sf_dir, "order"), schemas.DATASETS["order"])
    return parts["LineItem"].select(
        "id",
        F.col("__parentId").alias("parent_id"),
        "title",
        "quantity",
        "sku",
        F.col("variant.id").alias("variant_id"),
        F.col("variant.price").alias("variant_price"),
    )


CUSTOMER_SQL = (
    with_(CUST)
    + """SELECT id, c_name AS first_name, email, created_at, updated_at, consent AS marketing_state,
    CAST(n_addresses AS INTEGER) AS n_addresses,
    CASE WHEN c_acctbal >= 0 THEN 'City ' || c_nationkey END AS default_city FROM cust"""
)


def customer_columns():
    return [
        "id",
        F.col("firstName").alias("first_name"),
        "email",
        utc("createdAt", "created_at"),
        utc("updatedAt", "updated_at"),
        F.col("emailMarketingConsent.marketingState").alias("marketing_state"),
        F.array_size("addresses").alias("n_addresses"),
        F.col("defaultAddress.city").alias("default_city"),
    ]


@query(CUSTOMER_SQL, name="scan_json_array")
def scan_json_array_lines(spark, sf_dir):
    path = landed(spark, sf_dir, "customer_arrays")
    return scan_json_array(spark, path, schemas.ddl(schemas.CUSTOMER)).select(*customer_columns())


@query(CUSTOMER_SQL)
def scan_json_array_text(spark, sf_dir):
    text = scan_lines(spark, landed(spark, sf_dir, "customer_arrays"))
    return array_records(text, "value", schemas.struct(schemas.CUSTOMER)).select(*customer_columns())


@query(CUSTOMER_SQL)
def page_flatten(spark, sf_dir):
    envelopes = pages(spark, sf_dir, "customer_pages", CUSTOMER_PAGES)
    return flatten_pages(envelopes, "customers").select(*customer_columns())


@query(
    with_(ORD, LIN, TXN)
    + """, kept AS (SELECT * FROM ord WHERE updated_at >= DATE '1997-01-01' AND updated_at < DATE '1999-01-01')
    SELECT kept.id, NULL AS parent_id, name, updated_at, total,
           CAST(CASE o_orderpriority WHEN '2-HIGH' THEN NULL WHEN '5-LOW' THEN 0
                ELSE o_orderkey % 3 + 1 END AS INTEGER) AS n_transactions, NULL AS quantity
    FROM kept
    UNION ALL SELECT lin.id, lin.parent_id, NULL, NULL, NULL, NULL, quantity FROM lin SEMI JOIN kept
    ON lin.parent_id = kept.id"""
)
def orders_dataset(spark, sf_dir):
    kept = datasets.orders(bulk(spark, sf_dir, "order"), True, "1997-01-01", "1999-01-01", "updated_at", "shop")
    return kept.select(
        "id",
        F.col("__parentId").alias("parent_id"),
        "name",
        utc("updatedAt", "updated_at"),
        F.col("totalPriceSet.shopMoney.amount").alias("total"),
        F.array_size("transactions").alias("n_transactions"),
        "quantity",
    )


@query(
    with_(PART, PAIR, PRODUCT_LINES)
    + """, kept AS (SELECT id FROM prt WHERE status IN ('ACTIVE', 'DRAFT')
                    AND created_at >= DATE '2020-02-01' AND created_at < DATE '2020-10-01')
    SELECT id, parent_id, entity, status FROM product_lines
    WHERE root IN (SELECT id FROM kept) AND id NOT LIKE 'gid://shop/Metafield/v-%'"""
)
def products_dataset(spark, sf_dir):
    kept = datasets.products(
        bulk(spark, sf_dir, "product"),
        ["active", "draft"],
        product_metafields=True,
        since="2020-02-01",
        to="2020-10-01",
        field="created_at",
    )
    return kept.select(
        "id", F.col("__parentId").alias("parent_id"), entity_type(F.col("id")).alias("entity"), "status"
    )


@query(CUSTOMER_SQL + " WHERE updated_at >= DATE '2019-06-01' AND updated_at < DATE '2020-06-01'")
def customers_dataset(spark, sf_dir):
    kept = datasets.customers(bulk(spark, sf_dir, "customer"), "2019-06-01", "2020-06-01")
    return kept.select(*customer_columns())


@query(
    with_(PART, PAIR)
    + """, kept AS (SELECT * FROM prt WHERE updated_at >= DATE '2020-03-01' AND updated_at < DATE '2020-09-01')
    SELECT 'gid://shop/InventoryItem/' || p_partkey AS id, NULL AS parent_id, 'P' || p_partkey AS sku,
           p_size % 2 = 0 AS tracked, handle AS product_handle, NULL AS location_id, NULL AS available, updated_at
    FROM kept
    UNION ALL SELECT level_id, item_id, NULL, NULL, NULL, location_id, quantity, shipped FROM pair
    WHERE l_partkey IN (SELECT p_partkey FROM kept)"""
)
def inventory_dataset(spark, sf_dir):
    kept = datasets.inventory(bulk(spark, sf_dir, "inventory"), "2020-03-01", "2020-09-01")
    return kept.select(
        "id",
        F.col("__parentId").alias("parent_id"),
        "sku",
        "tracked",
        F.col("variant.product.handle").alias("product_handle"),
        F.col("location.id").alias("location_id"),
        F.filter("quantities", lambda q: q["name"] == "available")[0]["quantity"].alias("available"),
        utc("updatedAt", "updated_at"),
    )


@query(
    with_(LOC)
    + """SELECT id, s_name AS name, 'City ' || s_nationkey AS city, n_name AS country,
    s_suppkey % 5 <> 0 AS is_active, s_suppkey = 0 AS is_primary, outside AS is_fulfillment_service,
    CASE WHEN outside THEN '3PL ' || s_nationkey END AS service_name FROM loc"""
)
def locations_dataset(spark, sf_dir):
    return datasets.locations(bulk(spark, sf_dir, "location")).select(
        "id",
        "name",
        F.col("address.city").alias("city"),
        F.col("address.country").alias("country"),
        F.col("isActive").alias("is_active"),
        F.col("isPrimary").alias("is_primary"),
        F.col("isFulfillmentService").alias("is_fulfillment_service"),
        F.col("fulfillmentService.serviceName").alias("service_name"),
    )


@query(
    """SELECT 'gid://shop/Event/' || event_id AS id, ts AS created_at, props AS message, event_type AS action,
    CASE WHEN event_type <> 'error' THEN 'store' END AS app_title, user_id % 2 = 0 AS attribute_to_app,
    user_id % 2 <> 0 AS attribute_to_user, event_type = 'error' AS critical_alert
    FROM events WHERE ts >= DATE '2024-01-05' AND ts < DATE '2024-01-20'"""
)
def events_dataset(spark, sf_dir):
    return datasets.events(bulk(spark, sf_dir, "event"), "2024-01-05", "2024-01-20").select(
        "id",
        utc("createdAt", "created_at"),
        "message",
        "action",
        F.col("appTitle").alias("app_title"),
        F.col("attributeToApp").alias("attribute_to_app"),
        F.col("attributeToUser").alias("attribute_to_user"),
        F.col("criticalAlert").alias("critical_alert"),
    )


def custom_outputs(spark, sf_dir):
    name, frame, keys = datasets.custom(spark, " My Documents-1 ", landed(spark, sf_dir, "custom"))
    return normalise(stage(spark, frame, name), name, keys, promote=True)


@query(
    """SELECT 'gid://shop/Document/' || doc_id AS id, text AS body_text, n_chars AS char_count,
    '{"lang":"' || lang || '","source":"' || source || '"}' AS origin_info,
    DATE '2023-01-01' + CAST(doc_id % 400 AS INTEGER) AS issued_on,
    CAST(DATE '2023-01-01' + CAST(doc_id % 400 AS INTEGER) AS TIMESTAMP) AS created_at FROM documents"""
)
def custom_dataset(spark, sf_dir):
    table = custom_outputs(spark, sf_dir)["document"]
    return table.withColumn("created_at", utc("created_at"))


SCORES = """WITH s AS (SELECT 'gid://shop/DocumentLabel/' || doc_id AS id, 'gid://shop/Document/' || doc_id AS parent_id,
    quality, toxic, DATE '2023-01-01' + CAST(doc_id % 400 AS INTEGER) + 7 AS q_day,
    DATE '2023-01-01' + CAST(doc_id % 400 AS INTEGER) + 8 AS t_day FROM labels)
"""


@query(
    SCORES
    + """SELECT id, parent_id, '[{"name":"quality","ratedOn":"' || strftime(q_day, '%Y-%m-%d') || '","score":' || quality
    || '},{"name":"toxic","ratedOn":"' || strftime(t_day, '%Y-%m-%d') || '","score":' || toxic || '}]' AS scores FROM s"""
)
def custom_dataset_linked(spark, sf_dir):
    return custom_outputs(spark, sf_dir)["document_label"]


@query(
    SCORES
    + """SELECT id AS parent_id, CAST(1 AS BIGINT) AS row_number, 'quality' AS name, q_day AS rated_on,
    CAST(quality AS BIGINT) AS score FROM s
    UNION ALL SELECT id, 2, 'toxic', t_day, CAST(toxic AS BIGINT) FROM s"""
)
def custom_dataset_child(spark, sf_dir):
    """Dates inside the list are dates in its child table."""
    return custom_outputs(spark, sf_dir)["my_documents_1_scores"]


# --- paged -----------------------------------------------------------------------


@query(
    with_(ORD, LIN)
    + """, parts AS (SELECT parent_id, (rn - 1) // 250 AS part, count(*) AS n FROM lin GROUP BY ALL)
    SELECT id, created_at, total, COALESCE(part * 250, 0) AS first_item, CAST(n AS INTEGER) AS n_items
    FROM ord LEFT JOIN parts ON parts.parent_id = ord.id
    WHERE created_at >= DATE '1996-01-01' AND created_at < DATE '1998-01-01'"""
)
def orders_paged(spark, sf_dir):
    envelopes = order_pages(spark, sf_dir, "id", "createdAt", "totalPriceSet", "lineItems")
    docs = datasets.orders_paged(envelopes, "1996-01-01", "1997-12-31")
    return docs.select(
        "id",
        utc("createdAt", "created_at"),
        F.col("totalPriceSet.shopMoney.amount").alias("total"),
        F.col("lineItems.offset").alias("first_item"),
        F.array_size("lineItems.edges").alias("n_items"),
    )


@query(
    with_(PART, PAIR)
    + """, lists AS (SELECT product_id, CAST(count(*) AS INTEGER) AS n,
                     arg_min(location_id, l_suppkey) AS first_location FROM pair GROUP BY product_id)
    SELECT id, p_name AS title, status, array_to_string(tags, '|') AS tags, n AS n_variants, first_location,
           'https://img.example.com/' || p_partkey || '.png' AS image_url
    FROM prt LEFT JOIN lists ON product_id = id"""
)
def products_paged(spark, sf_dir):
    docs = datasets.products_paged(product_pages(spark, sf_dir, "id", "title", "status", "tags", "variants", "images"))
    first_variant = F.col("variants.edges")[0]["node"]
    return docs.select(
        "id",
        "title",
        "status",
        join_list(F.col("tags"), "|").alias("tags"),
        F.array_size("variants.edges").alias("n_variants"),
        first_variant["inventoryItem"]["inventoryLevels"]["edges"][0]["node"]["location"]["id"].alias("first_location"),
        F.col("images.edges")[0]["node"]["url"].alias("image_url"),
    )


@query(CUSTOMER_SQL)
def customers_paged(spark, sf_dir):
    envelopes = pages(spark, sf_dir, "customer_pages", CUSTOMER_PAGES)
    return datasets.customers_paged(envelopes).select(*customer_columns())


@query(
    with_(PART, PAIR)
    + """, lists AS (SELECT l_partkey, CAST(count(*) AS INTEGER) AS n FROM pair GROUP BY l_partkey)
    SELECT 'gid://shop/InventoryItem/' || p_partkey AS id, 'P' || p_partkey AS sku, p_size % 2 = 0 AS tracked,
           p_type AS variant_title, handle AS product_handle, n AS n_levels
    FROM prt LEFT JOIN lists ON l_partkey = p_partkey"""
)
def inventory_items_paged(spark, sf_dir):
    envelopes = inventory_pages(spark, sf_dir, "id", "sku", "tracked", "variant", "inventoryLevels")
    docs = datasets.inventory_items_paged(envelopes)
    return docs.select(
        "id",
        "sku",
        "tracked",
        F.col("variant.title").alias("variant_title"),
        F.col("variant.product.handle").alias("product_handle"),
        F.array_size("inventoryLevels.edges").alias("n_levels"),
    )


@query(with_(PART) + "SELECT id, p_name AS title, handle, status FROM prt WHERE status = 'DRAFT'")
def product_drafts(spark, sf_dir):
    docs = datasets.product_drafts(product_pages(spark, sf_dir, "id", "title", "handle", "status", "variants.offset"))
    return docs.select("id", "title", "handle", "status")


@query(
    with_(PART)
    + """SELECT id, p_name AS title, handle, status, created_at AS published_at FROM prt
    WHERE status = 'ARCHIVED'"""
)
def products_archived(spark, sf_dir):
    docs = datasets.products_archived(product_pages(spark, sf_dir, "id", "title", "handle", "status", "publishedAt", "variants.offset"))
    return docs.select("id", "title", "handle", "status", utc("publishedAt", "published_at"))


@query(
    with_(PART, PAIR)
    + """SELECT 'gid://shop/Metafield/v-' || l_partkey || '-' || l_suppkey AS id, 'lines' AS key,
    CAST(n_lines AS VARCHAR) AS value, variant_id AS owner_id, 'S' || l_suppkey AS owner_title,
    'P' || l_partkey || '-S' || l_suppkey AS owner_sku, id AS product_id, p_name AS product_title,
    handle AS product_handle FROM pair JOIN prt ON l_partkey = p_partkey"""
)
def metafields_by_owner(spark, sf_dir):
    found = datasets.metafields_by_owner(pages(spark, sf_dir, "metafield_pages", METAFIELD_PAGES), "ProductVariant")
    return found.select(
        "id", "key", "value", "owner_id", "owner_title", "owner_sku", "product_id", "product_title", "product_handle"
    )


PRODUCT_METAFIELDS = """
    SELECT 'gid://shop/Metafield/' || p_partkey || '-size' AS id, 'size' AS key, CAST(p_size AS VARCHAR) AS value,
           id AS owner_id, p_name AS owner_title, handle AS owner_handle FROM prt
    UNION ALL SELECT 'gid://shop/Metafield/' || p_partkey || '-brand', 'brand', p_brand, id, p_name, handle FROM prt"""


@query(with_(PART) + PRODUCT_METAFIELDS)
def metafields_of_products(spark, sf_dir):
    found = datasets.metafields_by_owner(pages(spark, sf_dir, "metafield_pages", METAFIELD_PAGES), "Product")
    return found.select("id", "key", "value", "owner_id", "owner_title", "owner_handle")


@query(
    with_(PART, PAIR)
    + f"""SELECT id, 'Product' AS owner_type, owner_id, owner_handle, NULL AS owner_sku, NULL AS product_id
    FROM ({PRODUCT_METAFIELDS})
    UNION ALL SELECT 'gid://shop/Metafield/v-' || l_partkey || '-' || l_suppkey, 'ProductVariant', variant_id, NULL,
    'P' || l_partkey || '-S' || l_suppkey, product_id FROM pair"""
)
def metafields_with_owner(spark, sf_dir):
    found = datasets.metafields_with_owner(pages(spark, sf_dir, "metafield_pages", METAFIELD_PAGES))
    return found.select("id", "owner_type", "owner_id", "owner_handle", "owner_sku", "product_id")


LEVELS_SQL = (
    with_(PAIR)
    + """SELECT item_id AS inventory_item_id, level_id, quantity AS available, location_id,
    'S' || l_suppkey AS location_name FROM pair"""
)


def level_columns(levels):
    return levels.select(
        F.col("inventoryItemId").alias("inventory_item_id"),
        F.col("levelId").alias("level_id"),
        "available",
        F.col("locationId").alias("location_id"),
        F.col("locationName").alias("location_name"),
    )


@query(LEVELS_SQL)
def inventory_levels_paged(spark, sf_dir):
    docs = datasets.inventory_items_paged(inventory_pages(spark, sf_dir, "id", "inventoryLevels"))
    return level_columns(curated.inventory_levels(docs))


# --- all parts of paged connections ------------------------------------------------


def variant_entries(docs: DataFrame) -> DataFrame:
    """Every variant in the rows of a paged dataset, with its place among its product's."""
    entries = docs.select("id", "status", "variants.offset", F.posexplode("variants.edges").alias("place", "edge"))
    place = (F.col("offset") + F.col("place") + 1).alias("place")
    return entries.select("id", "status", place, F.col("edge.node.id").alias("variant_id"), F.col("edge.node.sku").alias("sku"))


VARIANT_ENTRIES = (
    with_(PART, PAIR)
    + """SELECT product_id AS id, status, row_number() OVER (PARTITION BY l_partkey ORDER BY l_suppkey) AS place, variant_id,
    'P' || l_partkey || '-S' || l_suppkey AS sku FROM pair JOIN prt ON prt.id = product_id WHERE """
)


def all_product_pages(spark, sf_dir):
    return product_pages(spark, sf_dir, "id", "status", "variants")


@query(VARIANT_ENTRIES + "true")
def products_paged_parts(spark, sf_dir):
    """Products of any number of variants keep them all."""
    return variant_entries(datasets.products_paged(all_product_pages(spark, sf_dir), parts=True))


@query(VARIANT_ENTRIES + "status = 'DRAFT'")
def product_drafts_parts(spark, sf_dir):
    return variant_entries(datasets.product_drafts(all_product_pages(spark, sf_dir), parts=True))


@query(VARIANT_ENTRIES + "status = 'ARCHIVED'")
def products_archived_parts(spark, sf_dir):
    return variant_entries(datasets.products_archived(all_product_pages(spark, sf_dir), parts=True))


@query(
    with_(PAIR)
    + "SELECT item_id AS id, row_number() OVER (PARTITION BY l_partkey ORDER BY l_suppkey) AS place, level_id FROM pair"
)
def inventory_items_paged_parts(spark, sf_dir):
    docs = datasets.inventory_items_paged(inventory_pages(spark, sf_dir, "id", "inventoryLevels"), parts=True)
    entries = docs.select("id", "inventoryLevels.offset", F.posexplode("inventoryLevels.edges").alias("place", "edge"))
    place = (F.col("offset") + F.col("place") + 1).alias("place")
    return entries.select("id", place, F.col("edge.node.id").alias("level_id"))
