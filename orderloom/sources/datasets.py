"""The datasets: a scanned export, its sections, its filters.

Every function takes a scanned frame and returns a frame of the same shape, so
the normaliser works on any of them.  A window or status filter selects the
root entities; rows linked to them follow their root.  `app` is the app part of
the ids; given, entity tests reach the scan as prefixes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import dataset_name, entity_type, is_entity
from ..operators.curated import first_documents
from ..operators.filters import STAGED_TYPE, cap, date_window, event_filter, lookup, of_entity, status_in
from ..operators.relations import linked_to
from ..operators.reshape import drop_sections
from .bulk import list_entity_keys, scan_inferred, scan_lines, typed_scan
from .pages import flatten_pages

# --- fixed values: window fields by parameter name --------------------------
WINDOW_FIELDS = {"updated_at": "updatedAt", "created_at": "createdAt"}
# --- end of fixed values ----------------------------------------------------


def windowed(
    mixed: DataFrame, root: str, since: str | None, to: str | None, field: str, app: str | None, depth: int = 0
) -> DataFrame:
    """Root rows in the window with their linked rows; no window, no join."""
    if since is None and to is None:
        return mixed
    roots = date_window(of_entity(mixed, root, app=app), WINDOW_FIELDS[field], since, to)
    return linked_to(mixed, roots, depth, stored=STAGED_TYPE in mixed.columns) if depth else roots


def orders(
    bulk: DataFrame,
    transactions: bool = False,
    since: str | None = None,
    to: str | None = None,
    field: str = "updated_at",
    app: str | None = None,
) -> DataFrame:
    """Orders and their line items, with transactions if wanted."""
    return windowed(drop_sections(bulk, transactions=transactions), "Order", since, to, field, app, depth=1)


def products(
    bulk: DataFrame,
    statuses: list[str],
    product_metafields: bool = False,
    variant_metafields: bool = False,
    since: str | None = None,
    to: str | None = None,
    field: str = "updated_at",
    app: str | None = None,
) -> DataFrame:
    """Products of the given statuses with variants, images and wanted metafields."""
    for owner, wanted in (("Product", product_metafields), ("ProductVariant", variant_metafields)):
        if not wanted:
            unwanted = is_entity(F.col("id"), "Metafield", app) & is_entity(F.col("__parentId"), owner, app)
            bulk = bulk.where(~F.coalesce(unwanted, F.lit(False)))
    roots = status_in(of_entity(bulk, "Product", app=app), statuses)
    roots = date_window(roots, WINDOW_FIELDS[field], since, to)
    return linked_to(bulk, roots, depth=2, stored=STAGED_TYPE in bulk.columns)


def customers(
    bulk: DataFrame,
    since: str | None = None,
    to: str | None = None,
    field: str = "updated_at",
    app: str | None = None,
) -> DataFrame:
    return windowed(bulk, "Customer", since, to, field, app)


def inventory(
    bulk: DataFrame,
    since: str | None = None,
    to: str | None = None,
    field: str = "updated_at",
    app: str | None = None,
) -> DataFrame:
    """Inventory items with their levels per location."""
    return windowed(bulk, "InventoryItem", since, to, field, app, depth=1)


def locations(bulk: DataFrame) -> DataFrame:
    """Always complete."""
    return bulk


def events(
    bulk: DataFrame,
    since: str | None = None,
    to: str | None = None,
    verbs: list[str] | None = None,
    resources: list[str] | None = None,
    resource_field: str = "subject",
) -> DataFrame:
    """Activity log, windowed on its creation time only."""
    return event_filter(
        date_window(bulk, "createdAt", since, to), verbs, resources, resource_field=resource_field
    )


def custom(
    spark: SparkSession, title: str, path: str, schema: str | None = None, staged: list[str] | None = None
) -> tuple[str, DataFrame, dict[str, list[str]]]:
    """Any other export: its cleaned name, its frame and the keys of its entities.

    Without a schema the types are inferred, from records parsed once and staged (the
    folder is added to `staged`).  An object whose keys are data should be read as a map:
    give a schema then.
    """
    name = dataset_name(title)
    if not name:
        raise ValueError("a custom dataset needs a name")
    if schema:
        return name, typed_scan(spark, path, schema), list_entity_keys(scan_lines(spark, path))
    return name, *scan_inferred(spark, path, staged)


def orders_paged(
    pages: DataFrame, since: str | None = None, to: str | None = None, max_items: int | None = None
) -> DataFrame:
    """Nested order documents created in a closed window of days.  An order may go on
    in further documents; `max_items` counts orders, the first by id."""
    docs = date_window(flatten_pages(pages, "orders"), "createdAt", since, to, closed=True)
    if max_items is None:
        return docs
    few = cap(first_documents(docs, "lineItems"), max_items, "id").select(F.col("id").alias("__key"))
    return docs.join(few, docs["id"] == few["__key"], "left_semi")


def owners_paged(pages: DataFrame, key: str, connection: str, max_items: int | None, parts: bool) -> DataFrame:
    """A row per owner with the first of its connection's documents, or with `parts` a row
    for each document, so that the rows together have all entries.  `max_items` counts
    owners, the first by id."""
    docs = flatten_pages(pages, key)
    firsts = cap(first_documents(docs, connection), max_items, "id")
    if not parts:
        return firsts
    if max_items is None:
        return docs
    few = firsts.select(F.col("id").alias("__key"))
    return docs.join(few, docs["id"] == few["__key"], "left_semi")


def products_paged(pages: DataFrame, max_items: int | None = None, parts: bool = False) -> DataFrame:
    """A row per product with its first variants, or a row for each part of them."""
    return owners_paged(pages, "products", "variants", max_items, parts)


def customers_paged(pages: DataFrame, max_items: int | None = None) -> DataFrame:
    return flatten_pages(pages, "customers", max_items, ["id"])


def inventory_items_paged(pages: DataFrame, max_items: int | None = None, parts: bool = False) -> DataFrame:
    """A row per item with its first levels, or a row for each part of them."""
    return owners_paged(pages, "inventoryItems", "inventoryLevels", max_items, parts)


def product_drafts(pages: DataFrame, parts: bool = False) -> DataFrame:
    return status_in(products_paged(pages, parts=parts), ["draft"])


def products_archived(pages: DataFrame, parts: bool = False) -> DataFrame:
    return status_in(products_paged(pages, parts=parts), ["archived"])


# --- fixed values: owner columns by owner type, name -> path below `owner` ---
METAFIELD_OWNERS = {
    "Product": {"owner_id": "id", "owner_title": "title", "owner_handle": "handle"},
    "ProductVariant": {
        "owner_id": "id",
        "owner_title": "title",
        "owner_sku": "sku",
        "product_id": "product.id",
        "product_title": "product.title",
        "product_handle": "product.handle",
    },
}
# --- end of fixed values ----------------------------------------------------


def metafields_by_owner(pages: DataFrame, owner: str) -> DataFrame:
    """Metafields of one owner type with the columns that this type has."""
    nodes = flatten_pages(pages, "metafields")
    plain = [c for c in nodes.columns if c != "owner"]
    columns = [F.col(f"owner.{path}").alias(name) for name, path in METAFIELD_OWNERS[owner].items()]
    return of_entity(nodes, owner, field="owner.id").select(*plain, *columns)


def metafields_with_owner(pages: DataFrame) -> DataFrame:
    """All metafields; an owner column is filled only for owners of its type."""
    nodes = flatten_pages(pages, "metafields")
    kind = entity_type(F.col("owner.id"))
    names: dict[str, list] = {}
    for owner, columns in METAFIELD_OWNERS.items():
        for name, path in columns.items():
            names.setdefault(name, []).append(F.when(kind == owner, F.col(f"owner.{path}")))
    plain = [c for c in nodes.columns if c != "owner"]
    return nodes.select(*plain, kind.alias("owner_type"), *[F.coalesce(*v).alias(k) for k, v in names.items()])


def levels_of_location(levels: DataFrame, location_id: str) -> DataFrame:
    """Inventory levels at one location."""
    return lookup(levels, "location.id", location_id)
