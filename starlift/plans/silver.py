"""Silver layer: sales joined flat, stocks stamped with their day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlift.functions.expressions import full_name

# Columns of silver.order_sales, in order.
ORDER_SALES_COLUMNS = (
    "product_id",
    "product_name",
    "brand_name",
    "category_name",
    "customer_id",
    "customer_name",
    "staff_id",
    "staff_name",
    "store_id",
    "store_name",
    "order_id",
    "item_id",
    "order_date",
    "quantity",
    "list_price",
    "discount",
)


def order_sales(
    order_items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    brands: DataFrame,
    categories: DataFrame,
    customers: DataFrame,
    staffs: DataFrame,
    stores: DataFrame,
    name_separator: str = " ",
    products_first: bool = False,
) -> DataFrame:
    """One row per order line with everything known about it; unmatched parts are NULL.

    Left joins let the two branches be built first, each at its own grain: buyers,
    staff and stores meet the orders, brands and categories meet the products. The
    order lines, by far the most rows, then go through two joins instead of seven.
    While they are shuffled by order, the product branch finishes, so AQE knows its true
    size: it is broadcast under the threshold, and shuffled with hot products split
    beyond it. ``list_price`` is the order line's.

    ``products_first`` is for a load of all lines, which no watermark thins: product text is
    shorter than what an order brings along, and rows that end in the order of their orders
    repeat that from one to the next, so they take less when they are gathered by month.
    """
    order_side = (
        orders.select(
            F.col("order_id").alias("_order_id"),
            F.col("customer_id").alias("_customer_id"),
            F.col("staff_id").alias("_staff_id"),
            F.col("store_id").alias("_store_id"),
            "order_date",
        )
        .join(
            stores.select("store_id", "store_name"),
            F.col("_store_id") == F.col("store_id"),
            "left",
        )
        .join(
            staffs.select("staff_id", full_name("first_name", "last_name", name_separator).alias("staff_name")),
            F.col("_staff_id") == F.col("staff_id"),
            "left",
        )
        .join(
            customers.select(
                "customer_id", full_name("first_name", "last_name", name_separator).alias("customer_name")
            ),
            F.col("_customer_id") == F.col("customer_id"),
            "left",
        )
        .drop("_customer_id", "_staff_id", "_store_id")
    )
    product_side = (
        products.select("product_id", "product_name", "brand_id", "category_id")
        .join(
            brands.select(F.col("brand_id").alias("_brand_id"), "brand_name"),
            F.col("brand_id") == F.col("_brand_id"),
            "left",
        )
        .join(
            categories.select(F.col("category_id").alias("_category_id"), "category_name"),
            F.col("category_id") == F.col("_category_id"),
            "left",
        )
        .select("product_id", "product_name", "brand_name", "category_name")
    )
    lines = order_items.select(
        "order_id", "item_id", F.col("product_id").alias("_product_id"), "quantity", "list_price", "discount"
    )
    # Orders first: the shuffle by order then carries no product text, and a watermark
    # on order_date thins the lines before the products are looked up.
    joins = [
        (order_side, F.col("order_id") == F.col("_order_id")),
        (product_side, F.col("_product_id") == F.col("product_id")),
    ]
    for side, same in reversed(joins) if products_first else joins:
        lines = lines.join(side, same, "left")
    return lines.select(*ORDER_SALES_COLUMNS)
