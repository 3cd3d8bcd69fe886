"""Tables of the paged datasets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..operators import curated
from ..operators.filters import STAGED_TYPE
from ..operators.reshape import tidy
from ..sources import datasets
from ..sources.pages import flatten_pages, scan_pages
from .normalise import stage

# Dataset -> output -> how it is cut from the nested documents.
CURATED = {
    "orders": {"orders": curated.order_header, "order_line_items": curated.order_line_items},
    "products": {"products": curated.product_header, "product_variants": curated.product_variants},
    "inventory_items": {
        "inventory_items": curated.inventory_item_header,
        "inventory_levels": curated.inventory_levels,
    },
}


def curate(docs: DataFrame, name: str) -> dict[str, DataFrame]:
    """Curated tables where a dataset has them; otherwise its documents, tidied."""
    cuts = CURATED.get(name)
    if cuts is None:
        return {name: tidy(docs)}
    return {output: tidy(cut(docs)) for output, cut in cuts.items()}


# --- fixed values: flags of the paged datasets, with page key and dataset ---
PAGED_FLAGS = {
    "inventory_items": ("inventoryItems", "inventory_items"),
    "products_legacy": ("products", "products"),
    "orders_legacy": ("orders", "orders"),
    "customers_legacy": ("customers", "customers"),
}
# --- end of fixed values ----------------------------------------------------

NODES = {
    "orders": schemas.PAGED_ORDER,
    "products": schemas.PAGED_PRODUCT,
    "inventoryItems": schemas.PAGED_INVENTORY_ITEM,
    "customers": schemas.CUSTOMER,
}


def paged_outputs(
    spark: SparkSession,
    paths: Callable[[str], str],
    flag: str,
    since: str | None = None,
    to: str | None = None,
    staged: list[str] | None = None,
) -> dict[str, DataFrame]:
    """Outputs of a paged dataset from its landed pages, by its flag.  Only orders
    are windowed: created in a closed window of days.

    The documents are staged: a scan of nested JSON parses all of it for every
    output, a scan of nested Parquet reads the fields that an output has.
    """
    key, name = PAGED_FLAGS[flag]
    pages = scan_pages(spark, paths(flag), schemas.page(key, NODES[key]))
    docs = datasets.orders_paged(pages, since, to) if name == "orders" else flatten_pages(pages, key)
    return curate(stage(spark, docs, name, staged).drop(STAGED_TYPE), name)
