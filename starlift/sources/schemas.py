"""Entities of the landing layer: column types and keys."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and types of the nine extracts. Columns of a file that
# are not listed here are read as text.
COLUMN_TYPES = {
    "brands": "brand_id long, brand_name string",
    "categories": "category_id long, category_name string",
    "customers": "customer_id long, first_name string, last_name string",
    "products": (
        "product_id long, product_name string, brand_id long, category_id long, model_year long, list_price double"
    ),
    "staffs": (
        "staff_id long, first_name string, last_name string, email string, phone string, "
        "active long, store_id long, manager_id string"
    ),
    "stores": (
        "store_id long, store_name string, phone string, email string, "
        "street string, city string, state string, zip_code long"
    ),
    "order_items": (
        "order_id long, item_id long, product_id long, quantity long, list_price double, discount double"
    ),
    "orders": "order_id long, customer_id long, order_date date, store_id long, staff_id long",
    "stocks": "store_id long, product_id long, quantity long",
}

ENTITIES = tuple(COLUMN_TYPES)

# Merge key of each entity that is loaded by insert-only merge.
KEYS = {
    "brands": "brand_id",
    "categories": "category_id",
    "customers": "customer_id",
    "products": "product_id",
    "staffs": "staff_id",
    "stores": "store_id",
}

# Columns the later layers need; a file without them is refused.
REQUIRED = {
    "brands": ("brand_id", "brand_name"),
    "categories": ("category_id", "category_name"),
    "customers": ("customer_id", "first_name", "last_name"),
    "products": ("product_id", "product_name", "brand_id", "category_id"),
    "staffs": ("staff_id", "first_name", "last_name"),
    "stores": ("store_id", "store_name"),
    "order_items": ("order_id", "item_id", "product_id", "quantity", "list_price", "discount"),
    "orders": ("order_id", "customer_id", "order_date", "store_id", "staff_id"),
    "stocks": ("store_id", "product_id", "quantity"),
}


def schema_for(entity: str, header: list[str], types: str | None = None) -> T.StructType:
    """The schema of a file with this header, in the file's column order."""
    missing = [column for column in REQUIRED.get(entity, ()) if column not in header]
    if missing:
        raise ValueError(f"{entity}: columns missing from the file: {', '.join(missing)}")
    declared = T.StructType.fromDDL(types or COLUMN_TYPES.get(entity, "")) if types or entity in COLUMN_TYPES else []
    known = {field.name: field.dataType for field in declared}
    return T.StructType([T.StructField(column, known.get(column, T.StringType())) for column in header])
