"""Queries over filters, searches and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.operators import filters
from orderloom.operators.reshape import non_empty
from orderloom.schemas import EVENT, ddl
from orderloom.sources import datasets
from orderloom.sources.bulk import scan_bulk

from .fixtures import handle, landed, table
from .registry import CUST, LIN, ORD, PAIR, PART, bulk, pages, query, utc, with_
from .scans import CUSTOMER_PAGES, CUSTOMER_SQL, customer_columns


@query(
    with_(ORD)
    + """SELECT id, updated_at, total FROM ord
    WHERE updated_at >= DATE '1996-03-01' AND updated_at < DATE '1998-03-01'"""
)
def window_half_open(spark, sf_dir):
    rows = filters.date_window(bulk(spark, sf_dir, "order"), "updatedAt", "1996-03-01", "1998-03-01")
    return rows.select("id", utc("updatedAt", "updated_at"), F.col("totalPriceSet.shopMoney.amount").alias("total"))


@query(
    with_(ORD)
    + """SELECT id, created_at, total FROM ord WHERE CAST(created_at AS DATE) BETWEEN DATE '1996-03-01'
    AND DATE '1996-12-31'"""
)
def window_closed(spark, sf_dir):
    rows = filters.date_window(bulk(spark, sf_dir, "order"), "createdAt", "1996-03-01", "1996-12-31", closed=True)
    return rows.select("id", utc("createdAt", "created_at"), F.col("totalPriceSet.shopMoney.amount").alias("total"))


@query(
    """SELECT event_id, ts, event_type FROM events WHERE ts >= DATE '2024-01-10' AND ts < DATE '2024-01-12'"""
)
def window_on_table(spark, sf_dir):
    """The window on a columnar table; both bounds reach the scan."""
    rows = filters.date_window(table(spark, sf_dir, "events"), "ts", "2024-01-10", "2024-01-12")
    return rows.select("event_id", "ts", "event_type")


@query(with_(PART) + "SELECT id, p_name AS title, status FROM prt WHERE status IN ('ACTIVE', 'UNLISTED')")
def status_in(spark, sf_dir):
    return filters.status_in(bulk(spark, sf_dir, "product"), ["Active", "unlisted"]).select("id", "title", "status")


@query(with_(LIN) + "SELECT id, title, quantity, sku FROM lin")
def entity_filter(spark, sf_dir):
    return filters.of_entity(bulk(spark, sf_dir, "order"), "LineItem", app="shop").select("id", "title", "quantity", "sku")


@query(
    with_(ORD)
    + """SELECT id, CAST(o_orderkey % 3 + 1 AS INTEGER) AS n_transactions FROM ord
    WHERE o_orderpriority NOT IN ('5-LOW', '2-HIGH')"""
)
def non_empty_list(spark, sf_dir):
    rows = non_empty(bulk(spark, sf_dir, "order"), "transactions")
    return rows.select("id", F.array_size("transactions").alias("n_transactions"))


@query(
    """SELECT 'gid://shop/Event/' || event_id AS id, event_type AS action,
    'gid://shop/' || ['Order', 'Product', 'PriceRule'][user_id % 3 + 1] || '/' || user_id AS subject
    FROM events WHERE event_type IN ('click', 'error') AND user_id % 3 IN (0, 2)"""
)
def event_type_filter(spark, sf_dir):
    log = scan_bulk(spark, landed(spark, sf_dir, "event"), ddl(EVENT, {"subject": "string"}))
    kept = datasets.events(
        log, verbs=["click", " Error"], resources=["order", "PriceRule"], resource_field="subject"
    )
    return kept.select("id", "action", "subject")


@query(
    """SELECT 'gid://shop/Event/' || event_id AS id, event_type AS action FROM events
    WHERE list_contains(string_split('view,purchase', ','), event_type)"""
)
def event_verb_list(spark, sf_dir):
    """Verbs given as one comma list."""
    log = bulk(spark, sf_dir, "event")
    return filters.event_filter(log, "view, purchase".split(",")).select("id", "action")


@query(CUSTOMER_SQL + " WHERE c_custkey = 42")
def lookup_by_id(spark, sf_dir):
    found = filters.lookup(bulk(spark, sf_dir, "customer"), "id", "gid://shop/Customer/42")
    return found.select(*customer_columns())


@query(
    with_(PART, PAIR)
    + """SELECT variant_id AS id, product_id AS parent_id, price, quantity AS inventory_quantity FROM pair
    WHERE l_partkey = 7"""
)
def lookup_children(spark, sf_dir):
    found = filters.lookup(bulk(spark, sf_dir, "product"), "__parentId", "gid://shop/Product/7")
    return filters.of_entity(found, "ProductVariant").select(
        "id", F.col("__parentId").alias("parent_id"), "price", F.col("inventoryQuantity").alias("inventory_quantity")
    )


@query(with_(PART) + "SELECT id, p_name AS title, handle FROM prt WHERE p_partkey = 7")
def lookup_by_handle(spark, sf_dir):
    """The handle is that of one part."""
    wanted = table(spark, sf_dir, "part").where("p_partkey = 7").select(handle()).first()[0]
    products = filters.of_entity(bulk(spark, sf_dir, "product"), "Product")
    return filters.lookup(products, "handle", wanted).select("id", "title", "handle")


@query(
    """SELECT 'gid://shop/Metafield/' || p_partkey || '-size' AS id, 'size' AS key, CAST(p_size AS VARCHAR) AS value
    FROM part WHERE p_partkey = 7
    UNION ALL SELECT 'gid://shop/Metafield/' || p_partkey || '-brand', 'brand', p_brand FROM part WHERE p_partkey = 7"""
)
def lookup_by_owner(spark, sf_dir):
    found = filters.lookup(bulk(spark, sf_dir, "product"), "__parentId", "gid://shop/Product/7")
    return filters.of_entity(found, "Metafield").select("id", "key", "value")


@query(
    with_(PAIR)
    + """SELECT level_id AS id, location_id, quantity AS available FROM pair WHERE item_id = 'gid://shop/InventoryItem/7'"""
)
def levels_by_item(spark, sf_dir):
    found = filters.lookup(bulk(spark, sf_dir, "inventory"), "__parentId", "gid://shop/InventoryItem/7")
    return found.select(
        "id",
        F.col("location.id").alias("location_id"),
        F.filter("quantities", lambda q: q["name"] == "available")[0]["quantity"].alias("available"),
    )


@query(
    with_(PAIR)
    + """SELECT level_id AS id, item_id AS parent_id, quantity AS available FROM pair
    WHERE location_id = 'gid://shop/Location/7'"""
)
def levels_by_location(spark, sf_dir):
    found = datasets.levels_of_location(bulk(spark, sf_dir, "inventory"), "gid://shop/Location/7")
    return found.select(
        "id",
        F.col("__parentId").alias("parent_id"),
        F.filter("quantities", lambda q: q["name"] == "available")[0]["quantity"].alias("available"),
    )


@query(
    with_(PART)
    + """SELECT id, p_name AS title, p_brand AS vendor, p_size AS total_inventory FROM prt
    WHERE p_brand IN ('Brand#2', 'Brand#7', 'Brand#17') AND p_size >= 20 AND contains(p_name, 'r')
    AND p_type <> 'SMALL'"""
)
def search_fields(spark, sf_dir):
    found = filters.search(
        filters.of_entity(bulk(spark, sf_dir, "product"), "Product"),
        [
            ("vendor", "in", ["Brand#2", "Brand#7", "Brand#17"]),
            ("totalInventory", ">=", 20),
            ("title", "contains", "r"),
            ("productType", "!=", "SMALL"),
        ],
    )
    return found.select("id", "title", "vendor", F.col("totalInventory").alias("total_inventory"))


@query(with_(CUST) + "SELECT id, email FROM cust ORDER BY id LIMIT 100")
def max_items(spark, sf_dir):
    envelopes = pages(spark, sf_dir, "customer_pages", CUSTOMER_PAGES)
    return datasets.customers_paged(envelopes, max_items=100).select("id", "email")
