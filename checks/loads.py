"""Queries over sinks, loads, streams and whole datasets."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from orderloom.functions import make_gid
from orderloom.operators import loads
from orderloom.operators.filters import STAGED_TYPE, of_entity
from orderloom.operators.keys import pk_violations, primary_key
from orderloom.operators.reshape import tidy
from orderloom.plans.normalise import normalise, normalise_fixed, stage
from orderloom.plans.paged import curate
from orderloom.plans.run import entity_counts, run_and_write, run_selected as run_datasets
from orderloom.schemas import DATASETS, dataset_schema
from orderloom.session import scratch_path, settings
from orderloom.sinks.buckets import load_all_buckets, read_buckets
from orderloom.sinks.csv import csv_lines as exact_lines, read_csv, read_csv_split, write_csv
from orderloom.sinks.manifest import manifest as manifest_of
from orderloom.sinks.outputs import load_all, remove, write_measured
from orderloom.sources import datasets
from orderloom.sources.bulk import keep_raw, scan_bulk, scan_lines, to_lines
from orderloom.sources.pages import scan_json_split
from orderloom.streaming.dataset import land_dataset, read_dataset
from orderloom.streaming.landing import land_stream, read_landed

from .fixtures import DRIFTS, LINES_PER_FILE, base_and_increment, landed, table
from .registry import CUST, LIN, LOC, ORD, PAIR, PART, PRODUCT_LINES, TXN, bulk, pages, query, utc, with_
from .scans import CUSTOMER_PAGES, inventory_docs, order_docs, product_docs

DOCUMENTS_SQL = """SELECT doc_id, text, lang, CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN NULL
    ELSE source || ', "quoted"' END AS note, n_chars FROM documents"""
DOCUMENTS_DDL = "doc_id bigint, text string, lang string, note string, n_chars bigint"


def noted_documents(spark, sf_dir):
    note = (
        F.when(F.col("doc_id") % 3 == 0, F.lit(""))
        .when(F.col("doc_id") % 3 == 2, F.concat("source", F.lit(', "quoted"')))
        .alias("note")
    )
    return table(spark, sf_dir, "documents").select("doc_id", "text", "lang", note, "n_chars")


def through_csv(spark, sf_dir, exact):
    path = scratch_path(spark, "csv")
    write_csv(noted_documents(spark, sf_dir), path, exact)
    return read_csv(spark, path, DOCUMENTS_DDL, exact)


@query(DOCUMENTS_SQL)
def csv_roundtrip(spark, sf_dir):
    return through_csv(spark, sf_dir, exact=False)


@query(DOCUMENTS_SQL)
def csv_roundtrip_exact(spark, sf_dir):
    return through_csv(spark, sf_dir, exact=True)


def small_splits(spark):
    """Settings under which the files of a check have several splits, whatever its size."""
    return settings(spark, spark__sql__files__maxPartitionBytes="256k", spark__sql__files__openCostInBytes="4k")


@query(DOCUMENTS_SQL)
def csv_split_read(spark, sf_dir):
    """One file of records that span lines, read by several tasks."""
    path, stored = scratch_path(spark, "csv"), scratch_path(spark, "csv-read")
    write_csv(noted_documents(spark, sf_dir).coalesce(1), path, exact=True)
    with small_splits(spark):
        read_csv_split(spark, path, DOCUMENTS_DDL, exact=True).write.parquet(stored)
    return spark.read.parquet(stored)


@query(DOCUMENTS_SQL)
def json_pretty_split(spark, sf_dir):
    """One pretty-printed list of objects, read by several tasks."""
    path, stored = scratch_path(spark, "pretty"), scratch_path(spark, "pretty-read")
    record = F.to_json(F.struct("*"), {"ignoreNullFields": "false", "pretty": "true"})
    number = F.row_number().over(Window.orderBy("doc_id"))  # the file's one writer sees every row anyway
    rows = noted_documents(spark, sf_dir).select(record.alias("r"), number.alias("i"), F.count("*").over(Window.partitionBy()).alias("n"))
    text = F.concat(F.when(F.col("i") == 1, F.lit("[\n")).otherwise(F.lit("")), "r", F.when(F.col("i") == F.col("n"), F.lit("\n]")).otherwise(F.lit(",")))
    rows.coalesce(1).sortWithinPartitions("i").select(text.alias("value")).write.text(path)
    with small_splits(spark):
        scan_json_split(spark, path, DOCUMENTS_DDL).write.parquet(stored)
    return spark.read.parquet(stored)


@query(
    f"""SELECT '"' || doc_id || '","' || replace(text, '"', '""') || '","' || lang || '",'
    || COALESCE('"' || replace(note, '"', '""') || '"', '') || ',"' || n_chars || '"' AS value FROM ({DOCUMENTS_SQL})"""
)
def csv_lines(spark, sf_dir):
    return exact_lines(noted_documents(spark, sf_dir))


@query(
    """WITH c AS (SELECT count(*) AS n, count(*) FILTER (event_type = 'error') AS errors FROM events)
    SELECT 'event' AS dataset, position, "column", type, "column" = 'id' AS is_key, true AS incremental,
    true AS header, n AS rows, CASE WHEN "column" = 'app_title' THEN errors ELSE 0 END AS nulls
    FROM c, (VALUES (1, 'id', 'STRING'), (2, 'created_at', 'TIMESTAMP'), (3, 'message', 'STRING'),
      (4, 'action', 'STRING'), (5, 'app_title', 'STRING'), (6, 'attribute_to_app', 'BOOLEAN'),
      (7, 'attribute_to_user', 'BOOLEAN'), (8, 'critical_alert', 'BOOLEAN')) AS v(position, "column", type)"""
)
def manifest(spark, sf_dir):
    return manifest_of(tidy(bulk(spark, sf_dir, "event")), "event", ["id"])


@query(
    with_(ORD, LIN)
    + """SELECT id, NULL AS parent_id, name, created_at, total, NULL AS title, NULL AS quantity FROM ord
    UNION ALL SELECT id, parent_id, NULL, NULL, NULL, title, quantity FROM lin"""
)
def raw_copy(spark, sf_dir):
    """The kept raw file holds every line, whole."""
    path = scratch_path(spark, "raw-order")
    keep_raw(spark, landed(spark, sf_dir, "order"), path)
    return scan_bulk(spark, path, dataset_schema("order")).select(
        "id",
        F.col("__parentId").alias("parent_id"),
        "name",
        utc("createdAt", "created_at"),
        F.col("totalPriceSet.shopMoney.amount").alias("total"),
        "title",
        F.col("quantity").cast("int").alias("quantity"),
    )


@query(
    with_(ORD, LIN)
    + """SELECT 'order' AS dataset, (SELECT count(*) FROM ord) + (SELECT count(*) FROM lin) AS items,
    true AS consistent"""
)
def throughput(spark, sf_dir):
    """Items of writing the order export as Parquet; whether the rate is theirs over the seconds."""
    figures = write_measured(bulk(spark, sf_dir, "order"), scratch_path(spark, "measured"))
    rate = figures["items"] / figures["seconds"]
    consistent = abs(figures["items_per_second"] - rate) <= 1e-6 * rate
    return spark.createDataFrame([("order", figures["items"], consistent)], "dataset string, items bigint, consistent boolean")


# --- loads -----------------------------------------------------------------------

MERGED_SQL = """
    WITH o AS (SELECT 'gid://shop/Order/' || o_orderkey AS id, o_orderdate AS created_at,
      CAST(o_totalprice AS DECIMAL(18,2)) AS total, o_orderstatus AS status,
      o_orderdate >= TIMESTAMP '1997-06-01' AS changed, strftime(o_orderdate, '%Y-%m') AS month FROM orders),
    merged AS (SELECT id, created_at, created_at + to_days(CASE WHEN changed THEN 2 ELSE 0 END) AS updated_at,
      CAST(CASE WHEN changed THEN total + 10 ELSE total END AS DECIMAL(18,2)) AS total,
      CASE WHEN changed THEN lower(status) ELSE status END AS status, month, changed FROM o)"""
COLUMNS_SQL = "SELECT id, created_at, updated_at, total, status, month FROM merged"
COLUMNS = ["id", "created_at", "updated_at", "total", "status", "month"]


def newest_first():
    return [F.col("updated_at").desc()]


@query(MERGED_SQL + COLUMNS_SQL)
def upsert_incremental(spark, sf_dir):
    base, increment = base_and_increment(spark, sf_dir)
    return loads.upsert(base, increment, ["id"], newest_first())


@query(MERGED_SQL + COLUMNS_SQL)
def upsert_partitioned(spark, sf_dir):
    """Upsert into a stored table; only the months of the increment are rewritten."""
    base, increment = base_and_increment(spark, sf_dir)
    path = scratch_path(spark, "stored-orders")
    base.hint("rebalance", F.col("month")).write.partitionBy("month").parquet(path)
    loads.upsert_partitions(spark, path, increment, ["id"], newest_first(), "month")
    return spark.read.parquet(path).select(*COLUMNS)


@query(MERGED_SQL + COLUMNS_SQL)
def upsert_versions(spark, sf_dir):
    """Base, then increment, each as a new version of the table."""
    base, increment = base_and_increment(spark, sf_dir)
    first, second = scratch_path(spark, "orders-1"), scratch_path(spark, "orders-2")
    loads.upsert_table(spark, None, base, first, ["id"], newest_first())
    loads.upsert_table(spark, first, increment, second, ["id"], newest_first())
    return spark.read.parquet(second).select(*COLUMNS)


@query(MERGED_SQL + COLUMNS_SQL)
def latest_per_key(spark, sf_dir):
    """Of the stored rows and both versions of the increment."""
    base, increment = base_and_increment(spark, sf_dir)
    return loads.latest_per_key(base.unionByName(increment), ["id"], newest_first())


@query(
    MERGED_SQL
    + """SELECT id, created_at, total FROM o WHERE created_at < TIMESTAMP '1998-01-01'
    UNION ALL SELECT id, created_at, total FROM o WHERE changed
    UNION ALL SELECT id, created_at, CAST(total + 10 AS DECIMAL(18,2)) FROM o WHERE changed"""
)
def full_load(spark, sf_dir):
    """Loading twice leaves the second load only."""
    base, increment = base_and_increment(spark, sf_dir)
    path = scratch_path(spark, "full-load")
    loads.full_load(increment, path)
    loads.full_load(base.unionByName(increment), path)
    return spark.read.parquet(path).select("id", "created_at", "total")


@query(MERGED_SQL + COLUMNS_SQL)
def stream_landing(spark, sf_dir):
    """Base and increment arrive as files; the landed state is their merge."""
    base, increment = base_and_increment(spark, sf_dir)
    source, target = scratch_path(spark, "arriving"), scratch_path(spark, "landed")
    schema = "id string, created_at timestamp_ntz, updated_at timestamp_ntz, total decimal(18,2), status string, month string"
    to_lines(base.unionByName(increment)).write.text(source)
    stream = land_stream(
        spark, source, schema, target, scratch_path(spark, "progress"), ["id"], newest_first(), files_per_batch=4
    )
    stream.awaitTermination()
    return read_landed(spark, target, ["id"], newest_first()).select(*COLUMNS)


@query(
    with_(ORD)
    + """SELECT id, name, updated_at, '{"shopMoney":{"amount":"' || total || '","currencyCode":"USD"}}' AS total_price_set
    FROM ord"""
)
def stream_orders(spark, sf_dir):
    """The mixed order export as a stream: normalised and landed batch by batch."""
    target = scratch_path(spark, "landed-orders")
    newest = [F.col("updated_at").desc()]
    stream = land_stream(
        spark,
        landed(spark, sf_dir, "order"),
        dataset_schema("order"),
        target,
        scratch_path(spark, "progress"),
        ["id"],
        newest,
        prepare=lambda batch: tidy(of_entity(batch, "Order").select("id", "name", "updatedAt", "totalPriceSet")),
        files_per_batch=1,
    )
    stream.awaitTermination()
    rows = read_landed(spark, target, ["id"], newest)
    return rows.select("id", "name", utc("updated_at"), "total_price_set")


# --- whole datasets ----------------------------------------------------------------


def normalised_orders(spark, sf_dir) -> dict[str, DataFrame]:
    return normalise_fixed(datasets.orders(bulk(spark, sf_dir, "order"), transactions=True), "order")


def contents(outputs: dict[str, DataFrame], shown: dict[str, str], dataset: str | None = None) -> DataFrame:
    """(output, entry) of every row of the outputs: their columns in `shown`, joined.
    An output that `shown` lacks gets its name alone."""
    parts = []
    for name, df in outputs.items():
        columns = [F.col(c).cast("string") for c in shown.get(name, "").split()]
        parts.append(df.select(F.lit(name).alias("output"), F.concat_ws("|", *columns).alias("entry")))
    whole = reduce(DataFrame.unionByName, parts)
    return whole if dataset is None else whole.select(F.lit(dataset).alias("dataset"), "output", "entry")


def entries(*parts: tuple[str, str, str]) -> str:
    """SQL for `contents`: output, the entry's columns, and where they come from."""
    return " UNION ALL ".join(
        f"SELECT '{output}' AS output, concat_ws('|', {columns}) AS entry FROM {source}" for output, columns, source in parts
    )


def usd(amount: str) -> str:
    """SQL for the JSON text of an amount."""
    return f"""'{{"amount":"' || {amount} || '","currencyCode":"USD"}}'"""


ORDER_SHOWN = {
    "order": "id name email cancel_reason",
    "line_item": "id parent_id title quantity sku",
    "order_total_price_set": "parent_id shop_money",
    "order_subtotal_price_set": "parent_id shop_money",
    "order_total_tax_set": "parent_id shop_money",
    "order_total_shipping_price_set": "parent_id shop_money",
    "order_customer": "parent_id id first_name last_name email",
    "order_shipping_address": "parent_id first_name city country",
    "order_billing_address": "parent_id first_name country",
    "order_transactions": "parent_id row_number id kind status gateway",
    "order_variant": "parent_id id title sku price",
}
ORDER_ENTRIES = [
    ("order", "id, name, email, cancel_reason", "ord"),
    ("line_item", "id, parent_id, title, quantity, sku", "lin"),
    ("order_total_price_set", f"id, {usd('total')}", "ord"),
    ("order_subtotal_price_set", f"id, {usd('subtotal')}", "ord"),
    ("order_total_tax_set", f"id, {usd('tax')}", "ord WHERE tax IS NOT NULL"),
    ("order_total_shipping_price_set", f"id, {usd(chr(39) + '5.00' + chr(39))}", "ord"),
    ("order_customer", "id, customer_id, c_name, c_mktsegment, email", "ord"),
    ("order_shipping_address", "id, c_name, 'City ' || c_nationkey, 'N' || c_nationkey", "ord"),
    ("order_billing_address", "id, c_name, 'N' || c_nationkey", "ord WHERE o_orderstatus <> 'O'"),
    ("order_transactions", "parent_id, row_number, id, kind, 'SUCCESS', 'manual'", "txn"),
    ("order_variant", "id, variant_id, variant_title, variant_sku, variant_price", "lin WHERE variant_id IS NOT NULL"),
]


@query(with_(ORD, LIN, TXN) + entries(*ORDER_ENTRIES))
def normalise_orders(spark, sf_dir):
    """All outputs of the order dataset, row by row."""
    staged = stage(spark, datasets.orders(bulk(spark, sf_dir, "order"), transactions=True), "order")
    return contents(normalise_fixed(staged, "order"), ORDER_SHOWN)


@query(
    with_(ORD)
    + """SELECT id, name, email, created_at, updated_at, cancelled_at, cancel_reason,
    '{"shopMoney":{"amount":"' || total || '","currencyCode":"USD"}}' AS total_price_set,
    CASE WHEN subtotal IS NULL THEN '{"shopMoney":null}'
      ELSE '{"shopMoney":{"amount":"' || subtotal || '","currencyCode":"USD"}}' END AS subtotal_price_set,
    '{"id":"' || customer_id || '","firstName":"' || c_name || '","lastName":"' || c_mktsegment || '","email":"'
      || email || '","phone":null}' AS customer FROM ord"""
)
def normalise_orders_order(spark, sf_dir):
    rows = normalised_orders(spark, sf_dir)["order"]
    return rows.select(
        "id", "name", "email", utc("created_at"), utc("updated_at"), utc("cancelled_at"), "cancel_reason",
        "total_price_set", "subtotal_price_set", "customer",
    )


@query(
    with_(LIN)
    + """SELECT id, title, quantity, sku, CASE WHEN variant_id IS NOT NULL THEN '{"id":"' || variant_id
    || '","title":"' || variant_title || '","sku":"' || variant_sku || '","price":"' || variant_price || '"}' END AS variant,
    parent_id FROM lin"""
)
def normalise_orders_line_item(spark, sf_dir):
    return normalised_orders(spark, sf_dir)["line_item"]


@query(
    with_(LIN)
    + """SELECT id AS parent_id, variant_id AS id, variant_title AS title, variant_sku AS sku, variant_price AS price
    FROM lin WHERE variant_id IS NOT NULL"""
)
def normalise_orders_variant(spark, sf_dir):
    return normalised_orders(spark, sf_dir)["order_variant"]


@query(
    with_(CUST)
    + entries(
        ("customer", "id, email, c_name, marketing", "(SELECT *, consent AS marketing FROM cust)"),
        ("media_image", "'gid://shop/MediaImage/' || n_nationkey, n_name", "nation"),
        ("customer_rest", "'note-' || n_nationkey, n_name", "nation"),
    )
)
def normalise_customers_all(spark, sf_dir):
    """Lines that a contract of one type does not name get tables of their own."""
    staged = stage(spark, scan_bulk(spark, landed(spark, sf_dir, "customer_mixed"), dataset_schema("customer")), "customer")
    outputs = normalise_fixed(staged, "customer")
    shown = {"customer": "id email first_name marketing", "media_image": "id first_name", "customer_rest": "id last_name"}
    tables = {name: outputs[name] for name in shown}
    state = F.get_json_object("email_marketing_consent", "$.marketingState")
    return contents({**tables, "customer": tables["customer"].withColumn("marketing", state)}, shown)


@query(
    with_(ORD, LIN, TXN)
    # Lines of one id in one batch are versions of each other; these differ in their numbers.
    + """, one AS (SELECT * FROM lin QUALIFY row_number() OVER (PARTITION BY id ORDER BY CAST(quantity AS VARCHAR) DESC,
      variant_price DESC) = 1) """
    + entries(*[(output, columns, rows.replace("lin", "one")) for output, columns, rows in ORDER_ENTRIES])
)
def stream_dataset(spark, sf_dir):
    """The order export as a stream that lands all its tables."""
    target = scratch_path(spark, "landed-dataset")
    land_dataset(spark, landed(spark, sf_dir, "order"), "order", target, scratch_path(spark, "progress")).awaitTermination()
    return contents(read_dataset(spark, target), ORDER_SHOWN)


PAGED_SHOWN = {
    "orders": "id name email total_price customer_id",
    "order_line_items": "order_id row_number line_item_id quantity variant_id",
    "products": "id title handle vendor status",
    "product_variants": "product_id variant_id title sku price",
    "inventory_items": "id sku variant_id product_handle",
    "inventory_levels": "inventory_item_id level_id location_id",
    "customers": "id first_name email",
}
PAGED_ENTRIES = [
    ("products", "id, p_name, handle, p_brand, status", "prt"),
    ("product_variants", "product_id, variant_id, 'S' || l_suppkey, 'P' || l_partkey || '-S' || l_suppkey, price", "pair"),
    (
        "inventory_items",
        "'gid://shop/InventoryItem/' || p_partkey, 'P' || p_partkey, 'gid://shop/ProductVariant/' || p_partkey, handle",
        "prt",
    ),
    ("inventory_levels", "item_id, level_id, location_id", "pair"),
    ("customers", "id, c_name, email", "cust"),
]


def order_entries(orders: str, lines: str) -> list[tuple[str, str, str]]:
    return [
        ("orders", "id, name, email, total, customer_id", orders),
        ("order_line_items", "parent_id, rn, id, quantity, variant_id", lines),
    ]


@query(with_(ORD, LIN, PART, PAIR, CUST) + entries(*order_entries("ord", "lin"), *PAGED_ENTRIES))
def normalise_paged(spark, sf_dir):
    """Curated tables of every paged dataset, and the plain form of one that has none."""
    envelopes = pages(spark, sf_dir, "customer_pages", CUSTOMER_PAGES)
    documents = {
        "orders": order_docs(spark, sf_dir),
        "products": product_docs(spark, sf_dir),
        "inventory_items": inventory_docs(spark, sf_dir),
        "customers": datasets.customers_paged(envelopes),
    }
    outputs = {}
    for name, docs in documents.items():
        # The nested JSON is parsed once for all tables that are cut from it.
        outputs |= curate(stage(spark, docs, name).drop(STAGED_TYPE), name)
    return contents(outputs, PAGED_SHOWN)


@query(
    with_(ORD, LIN, CUST, PART, PAIR, PRODUCT_LINES, LOC)
    + """SELECT 'order' AS output, count(*) AS rows FROM ord UNION ALL SELECT 'line_item', count(*) FROM lin
    UNION ALL SELECT 'customer', count(*) FROM cust UNION ALL SELECT 'inventory_item', count(*) FROM prt
    UNION ALL SELECT 'inventory_level', count(*) FROM pair UNION ALL SELECT 'location', count(*) FROM loc
    UNION ALL SELECT 'event', count(*) FROM events
    UNION ALL SELECT CASE entity WHEN 'ProductVariant' THEN 'product_variant' WHEN 'ProductImage' THEN 'product_image'
      ELSE lower(entity) END, count(*) FROM product_lines GROUP BY ALL"""
)
def row_counts(spark, sf_dir):
    counts = [entity_counts(bulk(spark, sf_dir, dataset)) for dataset in DATASETS]
    return reduce(DataFrame.unionByName, counts)


SELECTED_SHOWN = {
    "product": {
        "product": "id status",
        "product_variant": "id parent_id",
        "product_image": "id parent_id",
        "product_tags": "parent_id row_number item",
    },
    "customer": {
        "customer": "id first_name email",
        "customer_email_marketing_consent": "parent_id marketing_state",
        "customer_default_address": "parent_id city",
        "customer_addresses": "parent_id row_number",
    },
    "event": {"event": "id action message"},
    "my_documents": {
        "document": "id",
        "document_label": "id",
        "my_documents_origin_info": "parent_id",
        "my_documents_scores": "parent_id row_number",
    },
}
SELECTED_ENTRIES = {
    "product": [
        ("product", "id, status", "kept WHERE entity = 'Product'"),
        ("product_variant", "id, parent_id", "kept WHERE entity = 'ProductVariant'"),
        ("product_image", "id, parent_id", "kept WHERE entity = 'ProductImage'"),
        (
            "product_tags",
            "id, i, tags[i]",
            "(SELECT id, tags, unnest(range(1, len(tags) + 1)) AS i FROM prt WHERE status IN ('ACTIVE', 'ARCHIVED'))",
        ),
    ],
    "customer": [
        ("customer", "id, c_name, email", "cust"),
        ("customer_email_marketing_consent", "id, consent", "cust WHERE consent IS NOT NULL"),
        ("customer_default_address", "id, 'City ' || c_nationkey", "cust WHERE c_acctbal >= 0"),
        ("customer_addresses", "id, i", "(SELECT id, unnest(range(1, n_addresses + 1)) AS i FROM cust)"),
    ],
    "event": [("event", "'gid://shop/Event/' || event_id, event_type, props", "events")],
    "my_documents": [
        ("document", "'gid://shop/Document/' || doc_id", "documents"),
        ("document_label", "'gid://shop/DocumentLabel/' || doc_id", "labels"),
        ("my_documents_origin_info", "'gid://shop/Document/' || doc_id", "documents"),
        ("my_documents_scores", "'gid://shop/DocumentLabel/' || doc_id, i", "(SELECT doc_id, unnest([1, 2]) AS i FROM labels)"),
    ],
}


def of_datasets(parts: dict[str, list[tuple[str, str, str]]]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS dataset, * FROM ({entries(*own)})" for name, own in parts.items())


def contents_of_run(results, shown) -> DataFrame:
    return reduce(DataFrame.unionByName, [contents(outputs, shown[name], name) for name, outputs in results.items()])


@query(
    with_(ORD, LIN, CUST, PART, PAIR, PRODUCT_LINES)
    + """, kept AS (SELECT * FROM product_lines WHERE entity <> 'Metafield'
                    AND root IN (SELECT id FROM prt WHERE status IN ('ACTIVE', 'ARCHIVED'))) """
    + of_datasets(SELECTED_ENTRIES)
)
def run_selected(spark, sf_dir):
    """A selection of datasets, a custom one among them: every row of every output."""
    results = run_datasets(
        spark,
        lambda name: landed(spark, sf_dir, name),
        ["customers", "products_archived", "products"],
        events=True,
        custom={"My Documents": landed(spark, sf_dir, "custom")},
    )
    # The contract's metafields were not wanted, so their tables are empty.
    return contents_of_run(results, SELECTED_SHOWN)


def windowed_entries(parts):
    """Order entries of the orders in `kept`, with all their lines."""
    windowed = []
    for output, columns, source in parts:
        source = source.replace("ord", "kept", 1) if source.startswith("ord") else source
        if source.startswith(("lin", "txn")):
            link = "WHERE" if "WHERE" not in source else "AND"
            source = f"{source} {link} parent_id IN (SELECT id FROM kept)"
        windowed.append((output, columns, source))
    return windowed


WINDOWED = windowed_entries([part for part in ORDER_ENTRIES if part[0] != "order_transactions"])


@query(
    with_(ORD, LIN)
    + """, kept AS (SELECT * FROM ord WHERE created_at >= DATE '1997-05-10' AND created_at < DATE '2024-01-20') """
    + of_datasets(
        {
            "order": WINDOWED,
            "event": [
                (
                    "event",
                    "'gid://shop/Event/' || event_id, event_type, props",
                    "events WHERE event_type = 'click' AND user_id % 3 IN (0, 2) AND ts >= DATE '1997-05-10' AND ts < DATE '2024-01-20'",
                )
            ],
        }
    )
)
def run_windowed(spark, sf_dir):
    """Orders of a window given in relative dates, and some events."""
    results = run_datasets(
        spark,
        lambda name: landed(spark, sf_dir, name),
        ["orders"],
        events=True,
        since="60 weeks ago",
        to="2024-01-20",
        field="created_at",
        verbs="click, none",
        resources=["Order", "PriceRule"],
        anchor=date(1998, 7, 4),
    )
    return contents_of_run(results, {"order": ORDER_SHOWN, "event": {"event": "id action message"}})


def loaded(spark, sf_dir, flags, windows, **options) -> dict[str, DataFrame]:
    """The tables after loading windows of datasets one after the other."""
    current, names = None, {}
    for since, to in windows:
        old = [] if current is None else [current]
        results = run_datasets(spark, lambda name: landed(spark, sf_dir, options.get(name, name)), flags, since=since, to=to, staged=old)
        outputs = {name: df for tables in results.values() for name, df in tables.items()}
        version = scratch_path(spark, "version")
        load_all(spark, outputs, current, version)
        current, names = version, list(outputs)
        for path in old:  # staged copies and the version before
            remove(spark, path)
    return {name: spark.read.parquet(f"{current}/{name}") for name in names}


@query(with_(ORD, LIN, TXN) + entries(*ORDER_ENTRIES))
def load_incremental(spark, sf_dir):
    """Two overlapping windows loaded one after the other give every row once."""
    windows = [(None, "1999-01-01"), ("1998-06-01", None)]
    return contents(loaded(spark, sf_dir, ["orders", "order_transactions"], windows), ORDER_SHOWN)


@query(
    with_(ORD, LIN, TXN)
    # A table has a key once; of equally new rows the one with the greatest text.
    + """, one AS (SELECT * FROM lin QUALIFY row_number() OVER (PARTITION BY id ORDER BY CAST(quantity AS VARCHAR) DESC,
      variant_price DESC) = 1),
    dearest AS (SELECT * FROM lin QUALIFY row_number() OVER (PARTITION BY id ORDER BY variant_price DESC) = 1) """
    + entries(
        *[
            (output, columns, rows.replace("lin", "dearest" if output == "order_variant" else "one"))
            for output, columns, rows in ORDER_ENTRIES
        ]
    )
)
def load_bucketed(spark, sf_dir):
    """The same into tables in buckets, of which a load reads and writes what it touches."""
    root = scratch_path(spark, "buckets")
    names: dict = {}
    for since, to in [(None, "1999-01-01"), ("1998-06-01", None)]:
        kept: list[str] = []
        flags = ["orders", "order_transactions"]
        results = run_datasets(spark, lambda name: landed(spark, sf_dir, name), flags, since=since, to=to, staged=kept)
        names = load_all_buckets(spark, {name: df for tables in results.values() for name, df in tables.items()}, root)
        for path in kept:
            remove(spark, path)
    return contents({name: read_buckets(spark, f"{root}/{name}") for name in names}, ORDER_SHOWN)


@query(
    """WITH e AS (SELECT *, strftime(ts, '%Y-%m-%d') AS day, CASE WHEN event_id % 3 = 0 THEN 0 WHEN event_id % 3 = 1 THEN 1
      ELSE 2 END AS part FROM events)
    SELECT 'gid://shop/Event/' || event_id AS id, CASE WHEN part = 1 AND event_type = 'error' THEN 'soon' ELSE day END AS due,
      CASE part WHEN 0 THEN floor(value) WHEN 1 THEN CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) END AS amount,
      CASE WHEN part = 0 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) ELSE ts END AS moment,
      CASE WHEN part = 2 THEN CAST(ts AS DATE) END AS seen,
      CASE part WHEN 1 THEN CAST(event_id AS VARCHAR) WHEN 2 THEN '{"kind":"' || event_type || '"}' END AS extra FROM e"""
)
def load_type_change(spark, sf_dir):
    """Three exports whose inferred types differ, loaded one after the other."""
    current = None
    for part in range(DRIFTS):
        name, frame, keys = datasets.custom(spark, "drift", landed(spark, sf_dir, f"drift_{part}"))
        version = scratch_path(spark, "version")
        load_all(spark, normalise(stage(spark, frame, name), name, keys, children=False, promote=True), current, version)
        current = version
    return spark.read.parquet(f"{current}/drift").select("id", "due", "amount", utc("moment"), "seen", "extra")


PAGED_FOLDERS = {
    "inventory_items": "inventory_pages",
    "products_legacy": "product_pages",
    "orders_legacy": "order_pages",
    "customers_legacy": "customer_pages",
}


@query(with_(ORD, LIN, PART, PAIR, CUST) + entries(*order_entries("ord", "lin"), *PAGED_ENTRIES))
def load_incremental_paged(spark, sf_dir):
    """Overlapping windows of all paged datasets: loading rows again changes nothing."""
    windows = [(None, "1998-12-31"), ("1998-06-01", None)]
    return contents(loaded(spark, sf_dir, PAGED_FOLDERS, windows, **PAGED_FOLDERS), PAGED_SHOWN)


@query(
    with_(ORD, LIN, PART, PAIR, CUST)
    + """, kept AS (SELECT * FROM ord WHERE created_at >= DATE '1997-01-01' AND created_at < DATE '1999-01-01') """
    + entries(*order_entries("kept", "lin WHERE parent_id IN (SELECT id FROM kept)"), *PAGED_ENTRIES)
)
def run_paged(spark, sf_dir):
    """All paged datasets by their flags, orders in a closed window."""
    results = run_datasets(
        spark, lambda flag: landed(spark, sf_dir, PAGED_FOLDERS[flag]), PAGED_FOLDERS, since="1997-01-01", to="1998-12-31"
    )
    return contents({name: df for outputs in results.values() for name, df in outputs.items()}, PAGED_SHOWN)


@query(
    with_(LIN)
    + """, repeated AS (SELECT count(*) FILTER (n > 1) AS lines, count(*) FILTER (n_variants > 1) AS variants
      FROM (SELECT id, count(*) AS n, count(variant_id) AS n_variants FROM lin GROUP BY id))
    SELECT output, key, CASE output WHEN 'line_item' THEN lines WHEN 'order_variant' THEN variants ELSE 0 END AS violations
    FROM (VALUES ('order', 'id'), ('line_item', 'parent_id,id'), ('order_total_price_set', 'parent_id'),
      ('order_subtotal_price_set', 'parent_id'), ('order_total_tax_set', 'parent_id'),
      ('order_total_shipping_price_set', 'parent_id'), ('order_customer', 'parent_id'),
      ('order_shipping_address', 'parent_id'), ('order_billing_address', 'parent_id'),
      ('order_transactions', 'parent_id,row_number'), ('order_variant', 'parent_id')) AS v(output, key), repeated"""
)
def primary_keys(spark, sf_dir):
    """The key of every output of the order dataset, and how many of its values repeat."""
    staged = stage(spark, datasets.orders(bulk(spark, sf_dir, "order"), transactions=True), "order")
    parts = []
    for name, df in normalise_fixed(staged, "order").items():
        key = primary_key(name, df)
        repeated = pk_violations(df, key).agg(F.count(F.lit(1)).alias("violations"))
        parts.append(repeated.select(F.lit(name).alias("output"), F.lit(",".join(key)).alias("key"), "violations"))
    return reduce(DataFrame.unionByName, parts)


@query(
    with_(PART, PAIR, PRODUCT_LINES)
    + """SELECT CASE entity WHEN 'ProductVariant' THEN 'product_variant' WHEN 'ProductImage' THEN 'product_image'
      ELSE lower(entity) END AS output, concat_ws('|', id, parent_id) AS entry FROM product_lines
    UNION ALL SELECT 'media_image', concat_ws('|', 'gid://shop/MediaImage/' || p_partkey, id) FROM prt
    UNION ALL SELECT 'product_rest', 'plain-' || p_partkey FROM prt"""
)
def normalise_products_all(spark, sf_dir):
    """An export with a type that the contract lacks and with plain ids: no line is lost."""
    parts = table(spark, sf_dir, "part")
    owner = make_gid("Product", F.col("p_partkey"))
    images = parts.select(make_gid("MediaImage", F.col("p_partkey")).alias("id"), owner.alias("__parentId"))
    plain = parts.select(F.concat(F.lit("plain-"), "p_partkey").alias("id"), F.lit(None).cast("string").alias("__parentId"))
    path = scratch_path(spark, "mixed-product")
    lines = scan_lines(spark, landed(spark, sf_dir, "product")).unionByName(to_lines(images)).unionByName(to_lines(plain))
    lines.write.option("compression", "gzip").option("maxRecordsPerFile", LINES_PER_FILE).text(path)
    outputs = normalise_fixed(stage(spark, scan_bulk(spark, path, dataset_schema("product")), "product"), "product")
    tables = ["product", "product_variant", "product_image", "metafield", "media_image", "product_rest"]
    shown = dict.fromkeys(tables, "id parent_id") | {"product": "id"}
    return contents({name: outputs[name] for name in tables}, shown)


@query(
    with_(LOC)
    + """SELECT 'location' AS output, count(*) AS items, 'id' AS key, true AS timed FROM loc
    UNION ALL SELECT 'location_address', count(*), 'parent_id', true FROM loc
    UNION ALL SELECT 'location_fulfillment_service', count(*), 'parent_id', true FROM loc WHERE outside HAVING count(*) > 0
    UNION ALL SELECT 'event', count(*), 'id', true FROM events"""
)
def run_written(spark, sf_dir):
    """Run and write: figures of each output, read back with its manifest."""
    folder = scratch_path(spark, "written")
    figures = run_and_write(spark, folder, lambda name: landed(spark, sf_dir, name), ["locations"], events=True)
    rows = []
    for dataset, outputs in figures.items():
        for name, own in outputs.items():
            if own is None:
                continue
            columns = spark.read.json(f"{folder}/{dataset}/{name}.manifest")
            key = [r["column"] for r in columns.where("is_key").orderBy("position").select("column").collect()]
            items = spark.read.parquet(f"{folder}/{dataset}/{name}").count()
            rows.append((name, items, ",".join(key), own["items"] == items and own["seconds"] > 0))
    return spark.createDataFrame(rows, "output string, items bigint, key string, timed boolean")


@query("SELECT 'event' AS output, count(*) AS rows FROM events HAVING count(*) < 0")
def empty_dataset(spark, sf_dir):
    """A run whose window is before all events leaves no output."""
    folder = scratch_path(spark, "nothing")
    figures = run_and_write(spark, folder, lambda name: landed(spark, sf_dir, name), [], events=True, to="1990-01-01")
    rows = [(name, own["items"]) for outputs in figures.values() for name, own in outputs.items() if own is not None]
    return spark.createDataFrame(rows, "output string, rows bigint")
