"""Field contracts of the exported entities and of the landed pages.

A contract is a dict `field -> Spark type` per entity.  A bulk file mixes the
entities of one dataset, so its scan schema is the merge of their contracts.
"""

from __future__ import annotations

# --- fixed values: field names and nesting of the exported entities ---------
MONEY = "struct<shopMoney:struct<amount:string,currencyCode:string>>"

ADDRESS = (
    "struct<firstName:string,lastName:string,address1:string,address2:string,city:string,"
    "province:string,country:string,zip:string,phone:string>"
)

FULL_ADDRESS = (
    "struct<id:string,firstName:string,lastName:string,address1:string,address2:string,city:string,"
    "province:string,country:string,zip:string,phone:string,name:string,provinceCode:string,"
    "countryCodeV2:string>"
)

TRANSACTION = (
    f"struct<id:string,kind:string,status:string,test:boolean,amountSet:{MONEY},gateway:string,"
    "createdAt:timestamp,processedAt:timestamp,errorCode:string,authorizationCode:string,"
    "authorizationExpiresAt:timestamp>"
)

ORDER = {
    "id": "string",
    "name": "string",
    "email": "string",
    "phone": "string",
    "createdAt": "timestamp",
    "updatedAt": "timestamp",
    "processedAt": "timestamp",
    "cancelledAt": "timestamp",
    "cancelReason": "string",
    "totalPriceSet": MONEY,
    "subtotalPriceSet": MONEY,
    "totalTaxSet": MONEY,
    "totalShippingPriceSet": MONEY,
    "customer": "struct<id:string,firstName:string,lastName:string,email:string,phone:string>",
    "shippingAddress": ADDRESS,
    "billingAddress": ADDRESS,
}

ORDER_TRANSACTIONS = {"transactions": f"array<{TRANSACTION}>"}

LINE_ITEM = {
    "id": "string",
    "title": "string",
    "quantity": "int",
    "sku": "string",
    "variant": "struct<id:string,title:string,sku:string,price:string>",
    "__parentId": "string",
}

PRODUCT = {
    "id": "string",
    "title": "string",
    "handle": "string",
    "description": "string",
    "vendor": "string",
    "productType": "string",
    "tags": "array<string>",
    "status": "string",
    "createdAt": "timestamp",
    "updatedAt": "timestamp",
    "publishedAt": "timestamp",
    "totalInventory": "int",
}

PRODUCT_VARIANT = {
    "id": "string",
    "title": "string",
    "sku": "string",
    "barcode": "string",
    "price": "string",
    "compareAtPrice": "string",
    "inventoryQuantity": "int",
    "__parentId": "string",
}

PRODUCT_IMAGE = {
    "id": "string",
    "url": "string",
    "altText": "string",
    "width": "int",
    "height": "int",
    "__parentId": "string",
}

METAFIELD = {
    "id": "string",
    "namespace": "string",
    "key": "string",
    "value": "string",
    "type": "string",
    "description": "string",
    "createdAt": "timestamp",
    "updatedAt": "timestamp",
    "__parentId": "string",
}

CUSTOMER = {
    "id": "string",
    "firstName": "string",
    "lastName": "string",
    "email": "string",
    "phone": "string",
    "createdAt": "timestamp",
    "updatedAt": "timestamp",
    "emailMarketingConsent": "struct<marketingState:string,marketingOptInLevel:string>",
    "defaultAddress": FULL_ADDRESS,
    "addresses": f"array<{FULL_ADDRESS}>",
}

INVENTORY_ITEM = {
    "id": "string",
    "sku": "string",
    "tracked": "boolean",
    "createdAt": "timestamp",
    "updatedAt": "timestamp",
    "variant": (
        "struct<id:string,title:string,sku:string,product:struct<id:string,title:string,handle:string>>"
    ),
}

INVENTORY_LEVEL = {
    "id": "string",
    "quantities": "array<struct<name:string,quantity:int>>",
    "location": "struct<id:string,name:string,isActive:boolean>",
    "updatedAt": "timestamp",
    "__parentId": "string",
}

LOCATION = {
    "id": "string",
    "name": "string",
    "address": (
        "struct<address1:string,address2:string,city:string,province:string,country:string,"
        "zip:string,phone:string>"
    ),
    "isActive": "boolean",
    "isPrimary": "boolean",
    "isFulfillmentService": "boolean",
    "fulfillmentService": "struct<id:string,serviceName:string>",
}

EVENT = {
    "id": "string",
    "createdAt": "timestamp",
    "message": "string",
    "action": "string",
    "appTitle": "string",
    "attributeToApp": "boolean",
    "attributeToUser": "boolean",
    "criticalAlert": "boolean",
}

# The resource an event is about; exports carry it only when asked for.
EVENT_SUBJECT = {"subject": "string"}

# Dataset -> entity -> contract, in output order.
DATASETS = {
    "order": {"Order": {**ORDER, **ORDER_TRANSACTIONS}, "LineItem": LINE_ITEM},
    "product": {
        "Product": PRODUCT,
        "ProductVariant": PRODUCT_VARIANT,
        "ProductImage": PRODUCT_IMAGE,
        "Metafield": METAFIELD,
    },
    "customer": {"Customer": CUSTOMER},
    "inventory": {"InventoryItem": INVENTORY_ITEM, "InventoryLevel": INVENTORY_LEVEL},
    "location": {"Location": LOCATION},
    "event": {"Event": EVENT},
}

# --- fixed values: primary keys by output name ------------------------------
PRIMARY_KEYS = {
    "order": ["id"],
    "order_legacy": ["id"],
    "product": ["id"],
    "product_legacy": ["id"],
    "customer": ["id"],
    "customer_legacy": ["id"],
    "inventory": ["id"],
    "inventory_item": ["id"],
    "inventory_level": ["parent_id", "id"],
    "location": ["id"],
    "event": ["id"],
    "order_line_items": ["order_id", "row_number"],
    "product_variants": ["product_id", "variant_id"],
    "inventory_levels": ["inventory_item_id", "level_id"],
}
# --- end of fixed values ----------------------------------------------------

PAGE_INFO = "struct<hasNextPage:boolean,hasPreviousPage:boolean,startCursor:string,endCursor:string>"


def ddl(*contracts: dict[str, str]) -> str:
    """Merge contracts into one schema string, fields in order of first appearance."""
    merged: dict[str, str] = {}
    for contract in contracts:
        for field, kind in contract.items():
            if merged.setdefault(field, kind) != kind:
                raise ValueError(f"field {field} has two shapes; scan by entity instead")
    return ", ".join(f"`{field}` {kind}" for field, kind in merged.items())


def struct(contract: dict[str, str]) -> str:
    return "struct<" + ",".join(f"`{field}`:{kind}" for field, kind in contract.items()) + ">"


def dataset_schema(name: str) -> str:
    """Scan schema of a fixed dataset's bulk file."""
    return ddl(*DATASETS[name].values())


def connection(contract: dict[str, str]) -> str:
    """A nested connection.  `offset` is the ordinal before the first edge: an
    owner with more edges than one document carries is continued in further
    documents, each with its own offset."""
    return f"struct<`offset`:bigint,edges:array<struct<node:{struct(contract)}>>>"


def pick(contract: dict[str, str], *fields: str) -> dict[str, str]:
    """Part of a contract.  A JSON scan parses every field of its schema, nested
    ones too, so a job that needs few fields should scan with few.  `name.offset`
    picks of a connection only what tells an owner's first document from others."""
    picked = {}
    for field in fields:
        name, _, part = field.partition(".")
        if part not in ("", "offset"):
            raise ValueError(f"can't pick {field}")
        picked[name] = "struct<`offset`:bigint>" if part else contract[name]
    return picked


def without_parent(contract: dict[str, str]) -> dict[str, str]:
    return {field: kind for field, kind in contract.items() if field != "__parentId"}


def page(key: str, contract: dict[str, str]) -> str:
    """Scan schema of landed page envelopes: one page per line."""
    return f"`{key}` struct<pageInfo:{PAGE_INFO},edges:array<struct<node:{struct(contract)}>>>"


PAGED_ORDER = {**ORDER, "lineItems": connection(without_parent(LINE_ITEM))}

PAGED_VARIANT = {
    **without_parent(PRODUCT_VARIANT),
    "weight": "string",
    "weightUnit": "string",
    "inventoryItem": (
        "struct<id:string,inventoryLevels:struct<edges:array<struct<node:"
        "struct<location:struct<id:string,name:string>>>>>>"
    ),
}

PAGED_PRODUCT = {
    **PRODUCT,
    "variants": connection(PAGED_VARIANT),
    "images": f"struct<edges:array<struct<node:{struct(without_parent(PRODUCT_IMAGE))}>>>",
}

PAGED_LEVEL = {**without_parent(INVENTORY_LEVEL), "available": "string"}

PAGED_INVENTORY_ITEM = {
    **INVENTORY_ITEM,
    "variant": (
        "struct<id:string,title:string,sku:string,price:string,"
        "product:struct<id:string,title:string,handle:string>>"
    ),
    "countryCodeOfOrigin": "string",
    "harmonizedSystemCode": "string",
    "provinceCodeOfOrigin": "string",
    "requiresShipping": "boolean",
    "unitCost": "struct<amount:string,currencyCode:string>",
    "inventoryLevels": connection(PAGED_LEVEL),
}

PAGED_METAFIELD = {
    **without_parent(METAFIELD),
    "owner": (
        "struct<id:string,title:string,handle:string,sku:string,"
        "product:struct<id:string,title:string,handle:string>>"
    ),
}
