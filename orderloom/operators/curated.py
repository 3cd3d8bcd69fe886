"""Flat tables cut from nested documents (the paged form).

An owner with more connection entries than one document holds is continued in
further documents; the owner's own row is taken from the first of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .reshape import flatten

# --- fixed values: output columns of each table, name -> path in the document --
ORDER_PLAIN = ["id", "name", "email", "phone", "createdAt", "updatedAt", "processedAt", "cancelledAt", "cancelReason"]
ORDER_NESTED = {
    "totalPrice": "totalPriceSet.shopMoney.amount",
    "totalPriceCurrency": "totalPriceSet.shopMoney.currencyCode",
    "subtotalPrice": "subtotalPriceSet.shopMoney.amount",
    "subtotalPriceCurrency": "subtotalPriceSet.shopMoney.currencyCode",
    "totalTax": "totalTaxSet.shopMoney.amount",
    "totalTaxCurrency": "totalTaxSet.shopMoney.currencyCode",
    "totalShippingPrice": "totalShippingPriceSet.shopMoney.amount",
    "totalShippingPriceCurrency": "totalShippingPriceSet.shopMoney.currencyCode",
    "customerId": "customer.id",
    "customerFirstName": "customer.firstName",
    "customerLastName": "customer.lastName",
    "customerEmail": "customer.email",
    "customerPhone": "customer.phone",
}
PRODUCT_PLAIN = [
    "id", "title", "handle", "description", "productType", "vendor",
    "createdAt", "updatedAt", "publishedAt", "status", "tags",
]
VARIANT_PLAIN = ["title", "sku", "price", "compareAtPrice"]
ITEM_PLAIN = [
    "id", "sku", "tracked", "createdAt", "updatedAt", "countryCodeOfOrigin",
    "harmonizedSystemCode", "provinceCodeOfOrigin", "requiresShipping",
]
ITEM_NESTED = {
    "unitCostAmount": "unitCost.amount",
    "unitCostCurrency": "unitCost.currencyCode",
    "variantId": "variant.id",
    "variantTitle": "variant.title",
    "variantSku": "variant.sku",
    "variantPrice": "variant.price",
    "productId": "variant.product.id",
    "productTitle": "variant.product.title",
    "productHandle": "variant.product.handle",
}
# --- end of fixed values ----------------------------------------------------


def first_documents(docs: DataFrame, connection: str) -> DataFrame:
    return docs.where(F.coalesce(F.col(f"{connection}.offset"), F.lit(0)) == 0)


def nodes(docs: DataFrame, connection: str, owner: str, *carried: Column) -> DataFrame:
    """One row per connection entry: owner id, ordinal in the owner, `node`."""
    exploded = docs.select(
        F.col("id").alias(owner),
        F.coalesce(F.col(f"{connection}.offset"), F.lit(0)).alias("__start"),
        *carried,
        F.posexplode(F.col(f"{connection}.edges")).alias("__position", "__edge"),
    )
    return exploded.withColumn("row_number", F.col("__start") + F.col("__position") + 1).withColumn(
        "node", F.col("__edge.node")
    )


def order_header(docs: DataFrame) -> DataFrame:
    return flatten(first_documents(docs, "lineItems"), ORDER_NESTED, keep=ORDER_PLAIN)


def order_line_items(docs: DataFrame) -> DataFrame:
    return nodes(docs, "lineItems", "orderId").select(
        "orderId",
        "row_number",
        F.col("node.id").alias("lineItemId"),
        F.col("node.title").alias("title"),
        F.col("node.quantity").cast("int").alias("quantity"),
        F.col("node.sku").alias("sku"),
        F.col("node.variant.id").alias("variantId"),
        F.col("node.variant.title").alias("variantTitle"),
        F.col("node.variant.sku").alias("variantSku"),
        F.col("node.variant.price").alias("variantPrice"),
    )


def product_header(docs: DataFrame) -> DataFrame:
    return first_documents(docs, "variants").select(*PRODUCT_PLAIN)


def product_variants(docs: DataFrame) -> DataFrame:
    return nodes(docs, "variants", "productId").select(
        "productId",
        F.col("node.id").alias("variantId"),
        *[F.col(f"node.{f}").alias(f) for f in VARIANT_PLAIN],
        F.col("node.inventoryQuantity").cast("int").alias("inventoryQuantity"),
        F.col("node.weight").try_cast("double").alias("weight"),
        F.col("node.weightUnit").alias("weightUnit"),
    )


def inventory_item_header(docs: DataFrame) -> DataFrame:
    return flatten(first_documents(docs, "inventoryLevels"), ITEM_NESTED, keep=ITEM_PLAIN)


def inventory_levels(docs: DataFrame) -> DataFrame:
    return nodes(docs, "inventoryLevels", "inventoryItemId").select(
        "inventoryItemId",
        F.col("node.id").alias("levelId"),
        F.col("node.available").try_cast("int").alias("available"),
        F.col("node.location.id").alias("locationId"),
        F.col("node.location.name").alias("locationName"),
    )
