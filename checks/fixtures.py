"""Nested exports and pages, derived from the flat tables by Spark.

Everything here is a DataFrame over whole tables.  Lists that Spark has to
gather (line items of an order, levels of an item) are built in documents of
bounded size; short lists (transactions, addresses, tags) are made from columns
of one row.  Rows are shuffled as the columns of the tables: what a document says
of them is written out when its page is complete.  So its columns are functions of
`at`, which finds a table's column: in a frame, or in a row of a list.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderloom.functions import make_gid
from orderloom.operators.relations import nest_by_page
from orderloom.session import scratch_path
from orderloom.sources.bulk import to_lines

PAGE_SIZE = 50
# Lines of one file of an export, less where lines are long.
LINES_PER_FILE = 1_000_000
LONG_LINES = {"custom": 50_000, "customer_arrays": 10_000, "customer_pages": 10_000, "order_pages": 2_000,
              "product_pages": 500, "inventory_pages": 500}
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
# Monotone in the line order and in the supplier order: a hot order or part is
# sorted in blocks.  Line numbers are few, so part keys divide an order further.
LINE_BLOCK = "struct(l_linenumber, l_partkey div 256)"
PAIR_BLOCK = "l_suppkey div 4096"


At = Callable[[str], Column]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_landed: dict[tuple[str, str, str], str] = {}


def landed(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Folder with the JSON lines of a fixture, written once per application.

    The lines repeat their field names, so they are compressed, and well even at the fastest
    level; the default one takes half of all the time of the export.  A compressed file is
    read by one task; a file has a bounded number of lines.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _landed:
        path = scratch_path(spark, f"export-{name}")
        writer = EXPORTS[name](spark, sf_dir).write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
        writer.option("maxRecordsPerFile", LONG_LINES.get(name, LINES_PER_FILE)).text(path)
        _landed[key] = path
    return _landed[key]


# --- small column helpers ----------------------------------------------------


def money(amount: Column) -> Column:
    return F.struct(
        F.struct(
            amount.cast("decimal(18,2)").cast("string").alias("amount"), F.lit("USD").alias("currencyCode")
        ).alias("shopMoney")
    )


def instant(when: Column) -> Column:
    return F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def plus_days(when: Column, days: Column) -> Column:
    return when + F.make_dt_interval(days.cast("int"))


def text(value: Column) -> Column:
    return value.cast("string")


def day_after(base: str, days: Column) -> Column:
    return F.date_add(F.lit(base).cast("date"), days.cast("int"))


def numbered(frames: list[DataFrame]) -> list[DataFrame]:
    """Documents of `nest_by_page`, numbered for their pages."""
    return [docs.withColumn("page_part", F.coalesce("part", F.lit(0))).drop("part") for docs in frames]


def connection(at: At, columns: Callable[[At], list[Column]]) -> Column:
    """A document's part of its connection; `columns` gives those of an entry."""
    edges = F.transform(at("edges"), lambda e: F.struct(F.struct(*columns(e["node"].getField)).alias("node")))
    return F.struct(F.coalesce(at("offset"), F.lit(0)).alias("offset"), edges.alias("edges"))


def lines_of(*frames: DataFrame) -> DataFrame:
    """Several entities as the lines of one export."""
    return reduce(DataFrame.unionAll, [to_lines(f) for f in frames])


# --- orders ------------------------------------------------------------------


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").drop("c_acctbal")
    return o.join(c, o["o_custkey"] == c["c_custkey"]).drop("c_custkey")


def order_columns(at: At = F.col, transactions: bool = True) -> list[Column]:
    status, priority = at("o_orderstatus"), at("o_orderpriority")
    total = money(at("o_totalprice"))
    email = F.concat(F.lower(at("c_name")), F.lit("@example.com"))
    created = at("o_orderdate")
    country = F.concat(F.lit("N"), text(at("c_nationkey")))
    kinds = F.array(F.lit("AUTHORIZATION"), F.lit("CAPTURE"), F.lit("REFUND"))
    steps = F.sequence(F.lit(1), (at("o_orderkey") % 3 + 1).cast("int"))
    transaction = F.transform(
        steps,
        lambda i: F.struct(
            make_gid("Transaction", at("o_orderkey"), i).alias("id"),
            F.element_at(kinds, i).alias("kind"),
            F.lit("SUCCESS").alias("status"),
            F.lit(False).alias("test"),
            total.alias("amountSet"),
            F.lit("manual").alias("gateway"),
            instant(plus_days(created, i)).alias("createdAt"),
        ),
    )
    columns = [
        make_gid("Order", at("o_orderkey")).alias("id"),
        F.concat(F.lit("#"), text(at("o_orderkey"))).alias("name"),
        email.alias("email"),
        F.lit(None).cast("string").alias("phone"),
        instant(created).alias("createdAt"),
        instant(plus_days(created, at("o_orderkey") % 30)).alias("updatedAt"),
        instant(created).alias("processedAt"),
        F.when(status == "P", instant(plus_days(created, F.lit(1)))).alias("cancelledAt"),
        F.when(status == "P", F.lit("customer")).alias("cancelReason"),
        total.alias("totalPriceSet"),
        F.when(priority == "5-LOW", F.struct(F.lit(None).cast("struct<amount:string,currencyCode:string>").alias("shopMoney")))
        .otherwise(total)
        .alias("subtotalPriceSet"),
        F.when(status != "P", money(F.lit(0))).alias("totalTaxSet"),
        money(F.lit(5)).alias("totalShippingPriceSet"),
        F.struct(
            make_gid("Customer", at("o_custkey")).alias("id"),
            at("c_name").alias("firstName"),
            at("c_mktsegment").alias("lastName"),
            email.alias("email"),
        ).alias("customer"),
        F.struct(
            at("c_name").alias("firstName"),
            F.concat(F.lit("City "), text(at("c_nationkey"))).alias("city"),
            country.alias("country"),
        ).alias("shippingAddress"),
        F.when(status != "O", F.struct(at("c_name").alias("firstName"), country.alias("country"))).alias(
            "billingAddress"
        ),
    ]
    if transactions:
        columns.append(
            F.when(priority == "5-LOW", F.slice(transaction, 1, 0))
            .when(priority != "2-HIGH", transaction)
            .alias("transactions")
        )
    return columns


def line_item_columns(at: At = F.col, order: Column | None = None) -> list[Column]:
    order = at("l_orderkey") if order is None else order
    sku = F.concat(F.lit("P"), text(at("l_partkey")), F.lit("-S"), text(at("l_suppkey")))
    return [
        make_gid("LineItem", order, *[at(c) for c in ("l_linenumber", "l_partkey", "l_suppkey")]).alias("id"),
        F.concat(F.lit("Part "), text(at("l_partkey"))).alias("title"),
        at("l_quantity").cast("int").alias("quantity"),
        sku.alias("sku"),
        F.when(
            at("l_linenumber") != 7,
            F.struct(
                make_gid("ProductVariant", at("l_partkey"), at("l_suppkey")).alias("id"),
                F.concat(F.lit("S"), text(at("l_suppkey"))).alias("title"),
                sku.alias("sku"),
                at("l_extendedprice").cast("decimal(18,2)").cast("string").alias("price"),
            ),
        ).alias("variant"),
    ]


def line_item_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        *line_item_columns(), make_gid("Order", F.col("l_orderkey")).alias("__parentId")
    )


def order_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_of(order_rows(spark, sf_dir).select(*order_columns()), line_item_rows(spark, sf_dir))


def order_documents(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Orders with their line items in documents, as rows of the tables; `page` and
    `page_part` say where a document goes."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER)
    orders = order_rows(spark, sf_dir)
    return numbered(nest_by_page(orders, lines, "o_orderkey", "l_orderkey", LINE_ORDER, F.expr(LINE_BLOCK), PAGE_SIZE))


def order_node(at: At) -> Column:
    return F.struct(
        *order_columns(at, transactions=False),
        connection(at, lambda item: line_item_columns(item, at("o_orderkey"))).alias("lineItems"),
    )


# --- products ----------------------------------------------------------------


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part and supplier pairs with their line count, quantity, price and last shipping."""
    return pairs_of(table(spark, sf_dir, "lineitem"))


def pairs_of(lines: DataFrame, *also: str) -> DataFrame:
    return lines.groupBy(*also, "l_partkey", "l_suppkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
        F.max("l_extendedprice").alias("price"),
        F.max("l_shipdate").alias("shipped"),
    )


def part_documents(spark: SparkSession, sf_dir: str, *values: str) -> list[DataFrame]:
    """Parts with these values of their pairs in documents, as rows of the tables."""

    def shape(lines: DataFrame, *also: str) -> DataFrame:
        return pairs_of(lines, *also).select(*also, "l_partkey", "l_suppkey", *values)

    part, lines = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem")
    return numbered(nest_by_page(part, lines, "p_partkey", "l_partkey", ["l_suppkey"], F.expr(PAIR_BLOCK), PAGE_SIZE, shape))


def handle(at: At = F.col) -> Column:
    return F.concat(F.translate(at("p_name"), " ", "-"), F.lit("-"), text(at("p_partkey")))


def part_created(at: At = F.col) -> Column:
    return day_after("2020-01-01", at("p_partkey") % 365)


def part_updated(at: At = F.col) -> Column:
    return F.date_add(part_created(at), at("p_size"))


def part_status(at: At = F.col) -> Column:
    statuses = F.array(*[F.lit(s) for s in ("ACTIVE", "DRAFT", "ARCHIVED", "UNLISTED")])
    return F.element_at(statuses, at("p_size") % 4 + 1)


def product_columns(at: At = F.col) -> list[Column]:
    return [
        make_gid("Product", at("p_partkey")).alias("id"),
        at("p_name").alias("title"),
        handle(at).alias("handle"),
        at("p_brand").alias("vendor"),
        at("p_type").alias("productType"),
        F.when(at("p_size") % 10 == 0, F.array().cast("array<string>"))
        .otherwise(F.split(at("p_name"), " "))
        .alias("tags"),
        part_status(at).alias("status"),
        instant(part_created(at)).alias("createdAt"),
        instant(part_updated(at)).alias("updatedAt"),
        F.when(part_status(at) != "DRAFT", instant(part_created(at))).alias("publishedAt"),
        at("p_size").alias("totalInventory"),
    ]


def variant_columns(at: At = F.col, part: Column | None = None) -> list[Column]:
    part = at("l_partkey") if part is None else part
    return [
        make_gid("ProductVariant", part, at("l_suppkey")).alias("id"),
        F.concat(F.lit("S"), text(at("l_suppkey"))).alias("title"),
        F.concat(F.lit("P"), text(part), F.lit("-S"), text(at("l_suppkey"))).alias("sku"),
        at("price").cast("decimal(18,2)").cast("string").alias("price"),
        at("quantity").cast("int").alias("inventoryQuantity"),
    ]


def image_columns(at: At = F.col) -> list[Column]:
    return [
        make_gid("ProductImage", at("p_partkey")).alias("id"),
        F.concat(F.lit("https://img.example.com/"), text(at("p_partkey")), F.lit(".png")).alias("url"),
        at("p_name").alias("altText"),
        (at("p_size") + 100).alias("width"),
        F.lit(200).alias("height"),
    ]


def product_metafield(key: str, value: Column, kind: str, at: At = F.col) -> list[Column]:
    return [
        make_gid("Metafield", at("p_partkey"), F.lit(key)).alias("id"),
        F.lit("spec").alias("namespace"),
        F.lit(key).alias("key"),
        value.alias("value"),
        F.lit(kind).alias("type"),
        instant(part_created(at)).alias("createdAt"),
    ]


def variant_metafield(at: At = F.col) -> list[Column]:
    return [
        make_gid("Metafield", F.lit("v"), at("l_partkey"), at("l_suppkey")).alias("id"),
        F.lit("stock").alias("namespace"),
        F.lit("lines").alias("key"),
        text(at("n_lines")).alias("value"),
        F.lit("number_integer").alias("type"),
        instant(at("shipped")).alias("createdAt"),
    ]


def product_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, pair = table(spark, sf_dir, "part"), pairs(spark, sf_dir)
    product = make_gid("Product", F.col("p_partkey")).alias("__parentId")
    variant = make_gid("ProductVariant", F.col("l_partkey"), F.col("l_suppkey")).alias("__parentId")
    return lines_of(
        part.select(*product_columns()),
        pair.select(*variant_columns(), make_gid("Product", F.col("l_partkey")).alias("__parentId")),
        part.select(*image_columns(), product),
        part.select(*product_metafield("size", text(F.col("p_size")), "number_integer"), product),
        part.select(*product_metafield("brand", F.col("p_brand"), "single_line_text_field"), product),
        pair.select(*variant_metafield(), variant),
    )


def product_documents(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Products with their variants in documents."""
    return part_documents(spark, sf_dir, "n_lines", "quantity", "price")


def product_node(at: At) -> Column:
    def variant(pair: At) -> list[Column]:
        level = F.struct(
            F.struct(
                F.struct(
                    make_gid("Location", pair("l_suppkey")).alias("id"),
                    F.concat(F.lit("S"), text(pair("l_suppkey"))).alias("name"),
                ).alias("location")
            ).alias("node")
        )
        item = F.struct(
            make_gid("InventoryItem", at("p_partkey")).alias("id"),
            F.struct(F.array(level).alias("edges")).alias("inventoryLevels"),
        )
        return [
            *variant_columns(pair, at("p_partkey")),
            (pair("n_lines") * 0.5).cast("string").alias("weight"),
            F.lit("KILOGRAMS").alias("weightUnit"),
            item.alias("inventoryItem"),
        ]

    images = F.struct(F.array(F.struct(F.struct(*image_columns(at)).alias("node"))).alias("edges"))
    return F.struct(*product_columns(at), connection(at, variant).alias("variants"), images.alias("images"))


def metafield_documents(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Metafields of products and variants, as rows of the tables; `field` is their key."""
    part, pair = table(spark, sf_dir, "part"), pairs(spark, sf_dir).select("l_partkey", "l_suppkey", "n_lines", "shipped")
    by_part = part.select("p_partkey", "p_name", "p_brand", "p_size")
    own = by_part.select("*", F.explode(F.array(F.lit("size"), F.lit("brand"))).alias("field"), F.lit(0).alias("page_part"))
    # A part's suppliers are paged too, so no page grows with a hot part.
    of_variants = pair.join(by_part.select("p_partkey", "p_name"), pair["l_partkey"] == F.col("p_partkey")).select(
        "*", F.lit("lines").alias("field"), (F.col("l_suppkey") + 1).alias("page_part")
    )
    docs = own.unionByName(of_variants, allowMissingColumns=True)
    return [docs.withColumn("page", F.expr(f"p_partkey div {PAGE_SIZE}"))]


def metafield_node(at: At) -> Column:
    product = [
        make_gid("Product", at("p_partkey")).alias("id"),
        at("p_name").alias("title"),
        handle(at).alias("handle"),
    ]
    owner = "struct<id:string,title:string,handle:string,sku:string,product:struct<id:string,title:string,handle:string>>"
    none = F.lit(None).cast("string")
    no_product = F.lit(None).cast("struct<id:string,title:string,handle:string>")
    of_product = F.struct(*product, none.alias("sku"), no_product.alias("product")).cast(owner).alias("owner")
    sku = F.concat(F.lit("P"), text(at("l_partkey")), F.lit("-S"), text(at("l_suppkey")))
    of_variant = (
        F.struct(
            make_gid("ProductVariant", at("l_partkey"), at("l_suppkey")).alias("id"),
            F.concat(F.lit("S"), text(at("l_suppkey"))).alias("title"),
            none.alias("handle"),
            sku.alias("sku"),
            F.struct(*product).alias("product"),
        )
        .cast(owner)
        .alias("owner")
    )
    size = F.struct(*product_metafield("size", text(at("p_size")), "number_integer", at), of_product)
    brand = F.struct(*product_metafield("brand", at("p_brand"), "single_line_text_field", at), of_product)
    lines = F.struct(*variant_metafield(at), of_variant)
    return F.when(at("field") == "lines", lines).when(at("field") == "size", size).otherwise(brand)


# --- customers, inventory, locations, events -----------------------------------


def customer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    joined = c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
    return joined.drop("n_nationkey", "n_regionkey", "r_regionkey")


def customer_columns(at: At = F.col) -> list[Column]:
    created = day_after("2019-01-01", at("c_custkey") % 700)
    nation = text(at("c_nationkey"))

    def address(number: int, town: str) -> Column:
        return F.struct(
            make_gid("MailingAddress", at("c_custkey"), F.lit(number)).alias("id"),
            at("c_name").alias("firstName"),
            at("c_mktsegment").alias("lastName"),
            F.concat(F.lit(town), nation).alias("city"),
            at("r_name").alias("province"),
            at("n_name").alias("country"),
            at("c_name").alias("name"),
            F.substring(at("r_name"), 1, 2).alias("provinceCode"),
            F.concat(F.lit("N"), nation).alias("countryCodeV2"),
        )

    home, second = address(1, "City "), address(2, "Second ")
    in_debt = at("c_acctbal") < 0
    return [
        make_gid("Customer", at("c_custkey")).alias("id"),
        at("c_name").alias("firstName"),
        at("c_mktsegment").alias("lastName"),
        F.concat(F.lower(at("c_name")), F.lit("@example.com")).alias("email"),
        instant(created).alias("createdAt"),
        instant(F.date_add(created, at("c_nationkey"))).alias("updatedAt"),
        F.when(
            at("c_mktsegment") != "MACHINERY",
            F.struct(
                F.when(in_debt, F.lit("UNSUBSCRIBED")).otherwise(F.lit("SUBSCRIBED")).alias("marketingState"),
                F.lit("SINGLE_OPT_IN").alias("marketingOptInLevel"),
            ),
        ).alias("emailMarketingConsent"),
        F.when(~in_debt, home).alias("defaultAddress"),
        F.when(in_debt, F.slice(F.array(home), 1, 0))
        .when(at("c_nationkey") % 2 == 0, F.array(home))
        .otherwise(F.array(home, second))
        .alias("addresses"),
    ]


def customer_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_of(customer_rows(spark, sf_dir).select(*customer_columns()))


def item_columns(at: At = F.col, price: bool = False) -> list[Column]:
    sku = F.concat(F.lit("P"), text(at("p_partkey")))
    variant = [
        make_gid("ProductVariant", at("p_partkey")).alias("id"),
        at("p_type").alias("title"),
        sku.alias("sku"),
        F.struct(
            make_gid("Product", at("p_partkey")).alias("id"),
            at("p_name").alias("title"),
            handle(at).alias("handle"),
        ).alias("product"),
    ]
    if price:
        variant.append(at("p_retailprice").cast("decimal(18,2)").cast("string").alias("price"))
    return [
        make_gid("InventoryItem", at("p_partkey")).alias("id"),
        sku.alias("sku"),
        (at("p_size") % 2 == 0).alias("tracked"),
        instant(part_created(at)).alias("createdAt"),
        instant(part_updated(at)).alias("updatedAt"),
        F.struct(*variant).alias("variant"),
    ]


def level_columns(at: At = F.col, part: Column | None = None) -> list[Column]:
    part = at("l_partkey") if part is None else part

    def amount(name: str, value: str) -> Column:
        return F.struct(F.lit(name).alias("name"), at(value).cast("int").alias("quantity"))

    return [
        make_gid("InventoryLevel", part, at("l_suppkey")).alias("id"),
        F.array(amount("available", "quantity"), amount("on_hand", "n_lines")).alias("quantities"),
        F.struct(
            make_gid("Location", at("l_suppkey")).alias("id"),
            F.concat(F.lit("S"), text(at("l_suppkey"))).alias("name"),
            (at("l_suppkey") % 5 != 0).alias("isActive"),
        ).alias("location"),
        instant(at("shipped")).alias("updatedAt"),
    ]


def inventory_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_of(
        table(spark, sf_dir, "part").select(*item_columns()),
        pairs(spark, sf_dir).select(
            *level_columns(), make_gid("InventoryItem", F.col("l_partkey")).alias("__parentId")
        ),
    )


def inventory_documents(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Inventory items with their levels in documents."""
    return part_documents(spark, sf_dir, "n_lines", "quantity", "shipped")


def inventory_node(at: At) -> Column:
    def level(pair: At) -> list[Column]:
        return [*level_columns(pair, at("p_partkey")), text(pair("quantity")).alias("available")]

    cost = F.struct(
        at("p_retailprice").cast("decimal(18,2)").cast("string").alias("amount"), F.lit("USD").alias("currencyCode")
    )
    return F.struct(
        *item_columns(at, price=True),
        F.concat(F.lit("N"), text(at("p_size"))).alias("countryCodeOfOrigin"),
        (at("p_size") > 25).alias("requiresShipping"),
        F.when(at("p_size") % 7 != 0, cost).alias("unitCost"),
        connection(at, level).alias("inventoryLevels"),
    )


def location_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    joined = s.join(n, s["s_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
    outside = F.col("s_acctbal") < 0
    key = text(F.col("s_suppkey"))
    nation = text(F.col("s_nationkey"))
    return joined.select(
        make_gid("Location", F.col("s_suppkey")).alias("id"),
        F.col("s_name").alias("name"),
        F.struct(
            F.concat(F.lit("Dock "), key).alias("address1"),
            F.concat(F.lit("City "), nation).alias("city"),
            F.col("r_name").alias("province"),
            F.col("n_name").alias("country"),
            F.lpad(key, 9, "0").alias("zip"),
        ).alias("address"),
        (F.col("s_suppkey") % 5 != 0).alias("isActive"),
        (F.col("s_suppkey") == 0).alias("isPrimary"),
        outside.alias("isFulfillmentService"),
        F.when(
            outside,
            F.struct(
                make_gid("FulfillmentService", F.col("s_suppkey")).alias("id"),
                F.concat(F.lit("3PL "), nation).alias("serviceName"),
            ),
        ).alias("fulfillmentService"),
    )


def location_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_of(location_rows(spark, sf_dir))


def event_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    subject = F.element_at(
        F.array(*[F.lit(s) for s in ("Order", "Product", "PriceRule")]), (F.col("user_id") % 3 + 1).cast("int")
    )
    return lines_of(
        e.select(
            make_gid("Event", F.col("event_id")).alias("id"),
            instant(F.col("ts")).alias("createdAt"),
            F.col("props").alias("message"),
            kind.alias("action"),
            F.when(kind != "error", F.lit("store")).alias("appTitle"),
            (F.col("user_id") % 2 == 0).alias("attributeToApp"),
            (F.col("user_id") % 2 != 0).alias("attributeToUser"),
            (kind == "error").alias("criticalAlert"),
            F.concat(F.lit("gid://shop/"), subject, F.lit("/"), text(F.col("user_id"))).alias("subject"),
        )
    )


# --- a custom export, untyped values -------------------------------------------


def custom_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with linked labels: an export that no contract describes."""
    d, l = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    day = day_after("2023-01-01", F.col("doc_id") % 400)

    def score(name: str, days: int) -> Column:
        return F.struct(
            F.lit(name).alias("name"), F.col(name).alias("score"), text(F.date_add(day, days)).alias("ratedOn")
        )

    return lines_of(
        d.select(
            make_gid("Document", F.col("doc_id")).alias("id"),
            F.col("text").alias("bodyText"),
            F.col("n_chars").alias("charCount"),
            F.struct("lang", "source").alias("originInfo"),
            text(day).alias("issuedOn"),
            instant(day).alias("createdAt"),
        ),
        l.select(
            make_gid("DocumentLabel", F.col("doc_id")).alias("id"),
            F.array(score("quality", 7), score("toxic", 8)).alias("scores"),
            make_gid("Document", F.col("doc_id")).alias("__parentId"),
        ),
    )


def untyped_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose values are all text, for the promotion of types."""
    e = table(spark, sf_dir, "events")
    return lines_of(
        e.select(
            F.col("event_id").alias("n"),
            F.date_format("ts", "yyyy-MM-dd").alias("day"),
            instant(F.col("ts")).alias("moment"),
            F.date_format("ts", "HH:mm:ss").alias("clock"),
            F.col("value").cast("decimal(18,2)").cast("string").alias("amount"),
            F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("mixed"),
        )
    )


DRIFTS = 3


def drift_export(spark: SparkSession, sf_dir: str, part: int) -> DataFrame:
    """Events in three exports whose inferred types differ; every tenth event of an export
    is in the one before it too, older.  `due` is a date, then also text; `amount` whole,
    then fractional, then null; `moment` a date, then an instant; `seen` null until the
    last, a date; `extra` absent, a number, an object."""
    e = table(spark, sf_dir, "events")
    n, kind = F.col("event_id"), F.col("event_type")
    own = e.where((n % DRIFTS == part) | ((n % 10 == 0) & (n % DRIFTS == part + 1)))
    day = F.date_format("ts", "yyyy-MM-dd")
    due = F.when(kind == "error", F.lit("soon")).otherwise(day) if part == 1 else day
    amounts = [F.floor("value"), F.col("value").cast("decimal(18,2)").cast("double"), F.lit(None).cast("double")]
    extras = [None, n, F.struct(kind.alias("kind"))]
    columns = [
        make_gid("Event", n).alias("id"),
        due.alias("due"),
        amounts[part].alias("amount"),
        (instant(F.col("ts")) if part else day).alias("moment"),
        (day if part == 2 else F.lit(None).cast("string")).alias("seen"),
        F.concat(F.lit(f"202{part}-01-01T00:00:00Z")).alias("updatedAt"),
    ]
    return own.select(*columns, *[x.alias("extra") for x in extras[part : part + 1] if x is not None]).select(
        to_json_line("id", "due", "amount", "moment", "seen", "updatedAt", *(["extra"] if part else []))
    )


def to_json_line(*columns: str) -> Column:
    """A line with all fields, null ones too."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value")


def mixed_customer_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, and lines that their contract does not name: images with an id of another
    type, and notes without a global id."""
    n = table(spark, sf_dir, "nation")
    images = n.select(make_gid("MediaImage", F.col("n_nationkey")).alias("id"), F.col("n_name").alias("firstName"))
    notes = n.select(F.concat(F.lit("note-"), F.col("n_nationkey").cast("string")).alias("id"), F.col("n_name").alias("lastName"))
    return customer_export(spark, sf_dir).unionAll(lines_of(images, notes))


# --- pages -----------------------------------------------------------------------


def page_lines(frames: list[DataFrame], name: str, node: Callable[[At], Column]) -> DataFrame:
    """Page envelopes of at most PAGE_SIZE keys and one part each: keys are unique
    within a part, so a page is bounded whatever the data.  `node` gives a document of
    a row.  Each frame has pages of its own."""
    return reduce(DataFrame.unionAll, [pages_of(docs, name, node) for docs in frames])


def pages_of(docs: DataFrame, name: str, node: Callable[[At], Column]) -> DataFrame:
    row = F.struct(*[F.col(c) for c in docs.columns if c not in ("page", "page_part")])
    pages = docs.select("page", "page_part", row.alias("row")).groupBy("page", "page_part").agg(F.collect_list("row").alias("rows"))
    edges = F.transform("rows", lambda r: F.struct(node(r.getField).alias("node")))
    cursor = F.concat_ws("-", text(F.col("page")), text(F.col("page_part")))
    info = F.struct(F.lit(True).alias("hasNextPage"), cursor.alias("endCursor"))
    page = F.struct(info.alias("pageInfo"), edges.alias("edges"))
    return pages.select(F.to_json(F.struct(page.alias(name))).alias("value"))


def customer_documents(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [customer_rows(spark, sf_dir).withColumns({"page": F.expr(f"c_custkey div {PAGE_SIZE}"), "page_part": F.lit(0)})]


def customer_node(at: At) -> Column:
    return F.struct(*customer_columns(at))


def customer_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as JSON arrays, one array of at most PAGE_SIZE records per line."""
    arrays = (
        customer_rows(spark, sf_dir)
        .groupBy(F.expr(f"c_custkey div {PAGE_SIZE}").alias("page"))
        .agg(F.collect_list(F.struct("*")).alias("rows"))
    )
    return arrays.select(F.to_json(F.transform("rows", lambda r: customer_node(r.getField))).alias("value"))


# --- increments ------------------------------------------------------------------


def base_and_increment(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders before 1998 as the stored table; orders from June 1997 as increment,
    each in two versions: an older one, and the latest with a changed price."""
    o = table(spark, sf_dir, "orders").select(
        make_gid("Order", F.col("o_orderkey")).alias("id"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total"),
        F.col("o_orderstatus").alias("status"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
    )
    base = o.where(F.col("created_at") < F.lit("1998-01-01").cast("timestamp_ntz"))
    recent = o.where(F.col("created_at") >= F.lit("1997-06-01").cast("timestamp_ntz"))
    older = recent.withColumn("updated_at", plus_days(F.col("created_at"), F.lit(1)))
    newest = (
        recent.withColumn("updated_at", plus_days(F.col("created_at"), F.lit(2)))
        .withColumn("total", (F.col("total") + 10).cast("decimal(18,2)"))
        .withColumn("status", F.lower("status"))
    )
    return base, older.unionByName(newest)


EXPORTS = {
    "order": order_export,
    "product": product_export,
    "customer": customer_export,
    "inventory": inventory_export,
    "location": location_export,
    "event": event_export,
    "custom": custom_export,
    "untyped": untyped_export,
    "customer_mixed": mixed_customer_export,
    **{f"drift_{i}": lambda s, d, i=i: drift_export(s, d, i) for i in range(DRIFTS)},
    "customer_arrays": customer_arrays,
    "order_pages": lambda s, d: page_lines(order_documents(s, d), "orders", order_node),
    "product_pages": lambda s, d: page_lines(product_documents(s, d), "products", product_node),
    "customer_pages": lambda s, d: page_lines(customer_documents(s, d), "customers", customer_node),
    "inventory_pages": lambda s, d: page_lines(inventory_documents(s, d), "inventoryItems", inventory_node),
    "metafield_pages": lambda s, d: page_lines(metafield_documents(s, d), "metafields", metafield_node),
}
