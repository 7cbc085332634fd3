"""The nine entities over the given parquet tables, and earlier load states of them.

An order's staff and store are derived from its customer, a product's category id
from the digest of its type, and a store's stock of a product is the quantity sold
there. Nothing is sampled or cut: every entity covers its whole tables.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlift.functions.calendar import calendar
from starlift.plans import silver

# Fixed values of the derived load states: the day of the earlier load, the category
# and the region that joined after it, and the day of the load itself.
CUTOFF = date(1999, 12, 31)
LATER_CATEGORY = "PROMO"
LATER_REGION = "ASIA"
AS_OF = date(2001, 12, 31)
DAY_BEFORE = date(2001, 12, 30)

# Columns of the given tables, so that no job runs just to learn them.
TABLE_TYPES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
}


class Entities:
    """Lazy frames of the entities under one folder of parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLE_TYPES[name]).parquet(f"{self.folder}/{name}.parquet")

    @property
    def brands(self) -> DataFrame:
        part = self.table("part")
        return part.select(self._brand_id().alias("brand_id"), F.col("p_brand").alias("brand_name")).distinct()

    @property
    def categories(self) -> DataFrame:
        part = self.table("part")
        return part.select(self._category_id().alias("category_id"), F.col("p_type").alias("category_name")).distinct()

    @property
    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            self._brand_id().alias("brand_id"),
            self._category_id().alias("category_id"),
            F.col("p_retailprice").alias("list_price"),
        )

    @property
    def customers(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("first_name"),
            F.col("c_mktsegment").alias("last_name"),
        )

    @property
    def staffs(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("staff_id"),
            F.col("s_name").alias("first_name"),
            F.col("s_nationkey").cast("string").alias("last_name"),
        )

    @property
    def stores(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").cast("long").alias("store_id"), F.col("n_name").alias("store_name")
        )

    @property
    def orders(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            (F.col("o_custkey") % 10).alias("staff_id"),
            (F.col("o_custkey") % 25).alias("store_id"),
            F.col("o_orderdate").alias("order_date"),
        )

    @property
    def order_items(self) -> DataFrame:
        return self._items(self.table("lineitem"))

    @property
    def stocks(self) -> DataFrame:
        items = self.table("lineitem").select("l_orderkey", F.col("l_partkey").alias("product_id"), "l_quantity")
        orders = self.orders.select("order_id", "store_id")
        return (
            items.join(orders, F.col("l_orderkey") == F.col("order_id"))
            .groupBy("store_id", "product_id")
            .agg(F.sum(F.col("l_quantity").cast("long")).alias("quantity"))
        )

    @property
    def orders_loaded(self) -> DataFrame:
        """Bronze orders after the earlier load."""
        return self.orders.filter(F.col("order_date") <= F.lit(CUTOFF))

    @property
    def items_loaded(self) -> DataFrame:
        """Bronze order lines after the earlier load: those shipped by then."""
        return self._items(self.table("lineitem").filter(F.col("l_shipdate") <= F.lit(CUTOFF)))

    def order_sales(
        self, name_separator: str = " ", orders: DataFrame | None = None, products_first: bool = False
    ) -> DataFrame:
        return silver.order_sales(
            order_items=self.order_items,
            orders=self.orders if orders is None else orders,
            products=self.products,
            brands=self.brands,
            categories=self.categories,
            customers=self.customers,
            staffs=self.staffs,
            stores=self.stores,
            name_separator=name_separator,
            products_first=products_first,
        )

    @property
    def later_stores(self) -> DataFrame:
        """Stores of the region that joined after the earlier load."""
        region = self.table("region").filter(F.col("r_name") == LATER_REGION)
        return (
            self.table("nation")
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")
            .select(F.col("n_nationkey").cast("long").alias("store_id"))
        )

    def earlier_sales(self, order_sales: DataFrame) -> DataFrame:
        """The sales known at the earlier load: without the later region and category."""
        return order_sales.filter(F.col("category_name") != LATER_CATEGORY).join(
            self.later_stores, "store_id", "left_anti"
        )

    @property
    def dim_date(self) -> DataFrame:
        """The calendar over the whole years of the orders."""
        return calendar(
            self.table("orders").agg(
                F.trunc(F.min("o_orderdate").cast("date"), "year").alias("first_day"),
                F.date_sub(F.add_months(F.trunc(F.max("o_orderdate").cast("date"), "year"), 12), 1).alias("last_day"),
            )
        )

    @staticmethod
    def _brand_id():
        return F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("")).cast("long")

    @staticmethod
    def _category_id():
        """The whole digest of the type, its halves folded into 63 bits."""
        halves = [F.conv(F.substring(F.md5("p_type"), at, 16), 16, -10).cast("long") for at in (1, 17)]
        return halves[0].bitwiseXOR(halves[1]).bitwiseAND(F.lit((1 << 63) - 1))

    @staticmethod
    def _items(lineitem: DataFrame) -> DataFrame:
        return lineitem.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").cast("long").alias("item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("long").alias("quantity"),
            F.col("l_extendedprice").alias("list_price"),
            F.col("l_discount").alias("discount"),
        )
