"""The same results in SQL, over the raw tables."""

from __future__ import annotations

CUTOFF = "DATE '1999-12-31'"
AS_OF = "DATE '2001-12-31'"
DAY_BEFORE = "DATE '2001-12-30'"

BRANDS = "SELECT DISTINCT CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS brand_id, p_brand AS brand_name FROM part"
CATEGORY_ID = (
    "CAST(xor(CAST('0x' || substr(md5(p_type), 1, 16) AS UBIGINT), CAST('0x' || substr(md5(p_type), 17, 16) AS UBIGINT)) "
    "& 9223372036854775807 AS BIGINT)"
)
CATEGORIES = f"SELECT DISTINCT {CATEGORY_ID} AS category_id, p_type AS category_name FROM part"
PRODUCTS = f"""
    SELECT p_partkey AS product_id, p_name AS product_name,
           CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS brand_id,
           {CATEGORY_ID} AS category_id, p_retailprice AS list_price
    FROM part"""
CUSTOMERS = "SELECT c_custkey AS customer_id, c_name AS first_name, c_mktsegment AS last_name FROM customer"
STAFFS = "SELECT s_suppkey AS staff_id, s_name AS first_name, CAST(s_nationkey AS VARCHAR) AS last_name FROM supplier"
STORES = "SELECT CAST(n_nationkey AS BIGINT) AS store_id, n_name AS store_name FROM nation"
LATER_STORES = (
    "SELECT CAST(n_nationkey AS BIGINT) FROM nation "
    "WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name = 'ASIA')"
)
ORDERS = """
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_custkey % 10 AS staff_id,
           o_custkey % 25 AS store_id, o_orderdate AS order_date
    FROM orders"""
ITEM_COLUMNS = """
    l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS item_id, l_partkey AS product_id,
    CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice AS list_price, l_discount AS discount"""
ITEMS = f"SELECT {ITEM_COLUMNS} FROM lineitem"
STOCKS = """
    SELECT o_custkey % 25 AS store_id, l_partkey AS product_id,
           CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    GROUP BY ALL"""


def _sales(separator: str = " ", orders: str = ORDERS) -> str:
    """Order lines with all their lookups, straight from the raw tables."""
    return f"""
    SELECT p.p_partkey AS product_id, p.p_name AS product_name, p.p_brand AS brand_name, p.p_type AS category_name,
           c.c_custkey AS customer_id, c.c_name || '{separator}' || c.c_mktsegment AS customer_name,
           s.s_suppkey AS staff_id, s.s_name || '{separator}' || CAST(s.s_nationkey AS VARCHAR) AS staff_name,
           CAST(n.n_nationkey AS BIGINT) AS store_id, n.n_name AS store_name,
           i.l_orderkey AS order_id, CAST(i.l_linenumber AS BIGINT) AS item_id, o.order_date,
           CAST(i.l_quantity AS BIGINT) AS quantity, i.l_extendedprice AS list_price, i.l_discount AS discount
    FROM lineitem i
    LEFT JOIN ({orders}) o ON o.order_id = i.l_orderkey
    LEFT JOIN part p ON p.p_partkey = i.l_partkey
    LEFT JOIN customer c ON c.c_custkey = o.customer_id
    LEFT JOIN supplier s ON s.s_suppkey = o.staff_id
    LEFT JOIN nation n ON n.n_nationkey = o.store_id"""


SALES = _sales()
ORPHAN_SALES = _sales(orders=f"SELECT * FROM ({ORDERS}) WHERE order_date <= {CUTOFF}")
RENAMED_SALES = f"""
    SELECT * REPLACE (
        CASE WHEN order_date <= {CUTOFF} THEN lower(customer_name) ELSE customer_name END AS customer_name)
    FROM ({SALES})"""
EARLIER_SALES = f"""
    SELECT * FROM sales WHERE category_name <> 'PROMO' AND store_id NOT IN ({LATER_STORES})"""
CALENDAR = """
    SELECT row_number() OVER (ORDER BY day) AS date_sk, CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_id,
           day AS date, year(day) AS year, month(day) AS month, day(day) AS day
    FROM (SELECT unnest(generate_series(
              date_trunc('year', min(o_orderdate)),
              date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
              INTERVAL 1 DAY)) AS day
          FROM orders)"""

# Table -> key column, id column, attribute columns.
DIMS = {
    "dim_products": ("product_sk", "product_id", "product_name, brand_name, category_name"),
    "dim_customers": ("customer_sk", "customer_id", "customer_name"),
    "dim_staffs": ("staff_sk", "staff_id", "staff_name"),
    "dim_stores": ("store_sk", "store_id", "store_name"),
}


def _dim(table: str, sales: str, as_of: str = AS_OF) -> str:
    sk, key, attributes = DIMS[table]
    return f"""
    SELECT row_number() OVER (ORDER BY {key} NULLS LAST, {attributes}) AS {sk}, {key}, {attributes},
           {as_of} AS data_criacao_registro
    FROM (SELECT DISTINCT {key}, {attributes} FROM {sales})"""


def _with_dims(source: str, sales: str = SALES) -> str:
    """CTEs: sales, earlier_sales, the dimensions over ``source``, the calendar."""
    dims = ", ".join(f"{table} AS ({_dim(table, source)})" for table in DIMS)
    return f"WITH sales AS ({sales}), earlier_sales AS ({EARLIER_SALES}), {dims}, dim_date AS ({CALENDAR})"


FACT_SALES = f"""
    SELECT product_sk, customer_sk, staff_sk, store_sk, date_sk, item_id, order_id, order_date,
           quantity, list_price, discount, {AS_OF} AS data_criacao_registro
    FROM sales
    LEFT JOIN dim_products USING (product_id)
    LEFT JOIN dim_customers USING (customer_id)
    LEFT JOIN dim_staffs USING (staff_id)
    LEFT JOIN dim_stores USING (store_id)
    LEFT JOIN dim_date ON date_id = CAST(strftime(order_date, '%Y%m%d') AS INTEGER)"""


def _fact_stocks(snapshot: str) -> str:
    return f"""
    SELECT product_sk, store_sk, date_sk, quantity, {AS_OF} AS data_criacao_registro
    FROM ({snapshot})
    LEFT JOIN dim_products USING (product_id)
    LEFT JOIN dim_stores USING (store_id)
    LEFT JOIN dim_date ON date_id = CAST(strftime(dt_stock, '%Y%m%d') AS INTEGER)"""


def _merge(columns: str, now: str, key: str, name: str, known: str) -> str:
    """The stored rows, with names as they were, and the rows whose key is not stored."""
    stored = columns.replace(name, f"lower({name}) AS {name}")
    return f"""
    WITH now AS ({now}), stored AS (SELECT {stored} FROM now WHERE {known})
    SELECT {columns} FROM stored
    UNION ALL
    SELECT {columns} FROM now WHERE {key} NOT IN (SELECT {key} FROM stored)"""


def _two_runs_counts(snapshots: int) -> str:
    """Rows per table after two extracts and a repeated day."""

    def one(layer: str, table: str, rows: str, times: int = 1) -> str:
        return f"SELECT '{layer}' AS layer, '{table}' AS table_name, {times} * count(*) AS n_rows FROM ({rows})"

    parts = [_bronze_counts(), one("silver", "order_sales", ITEMS), one("silver", "stocks_snapshot", STOCKS, snapshots)]
    for table, (_, key, attributes) in DIMS.items():
        parts.append(one("gold", table, f"SELECT DISTINCT {key}, {attributes} FROM ({SALES})"))
    parts.append(one("gold", "dim_date", CALENDAR))
    parts.append(one("gold", "fact_sales", ITEMS))
    parts.append(one("gold", "fato_stocks", STOCKS, snapshots))
    return " UNION ALL ".join(parts)


def _bronze_counts() -> str:
    tables = {
        "brands": BRANDS,
        "categories": CATEGORIES,
        "customers": CUSTOMERS,
        "products": PRODUCTS,
        "staffs": STAFFS,
        "stores": STORES,
        "order_items": ITEMS,
        "orders": ORDERS,
        "stocks": STOCKS,
    }
    return " UNION ALL ".join(
        f"SELECT 'bronze' AS layer, '{table}' AS table_name, count(*) AS n_rows FROM ({rows})"
        for table, rows in tables.items()
    )


def _stored() -> dict[str, str]:
    """The tables after two extracts and a repeated day: members of the second extract
    follow the stored keys, and every row has the day that loaded it."""
    ctes = [
        f"sales AS (SELECT * REPLACE (CAST(order_date AS DATE) AS order_date) FROM ({SALES}))",
        f"early AS (SELECT * FROM sales WHERE order_date <= {CUTOFF})",
        f"dim_date AS ({CALENDAR})",
    ]
    for table, (sk, key, attributes) in DIMS.items():
        ctes.append(f"first_{table} AS ({_dim(table, 'early', DAY_BEFORE)})")
        ctes.append(f"""{table} AS (
            SELECT * FROM first_{table}
            UNION ALL
            SELECT (SELECT max({sk}) FROM first_{table}) + row_number() OVER (ORDER BY {key}, {attributes}) AS {sk},
                   {key}, {attributes}, {AS_OF} AS data_criacao_registro
            FROM (SELECT DISTINCT {key}, {attributes} FROM sales)
            WHERE {key} NOT IN (SELECT {key} FROM first_{table}))""")
    begin = "WITH " + ", ".join(ctes)
    loaded = f"CASE WHEN order_date <= {CUTOFF} THEN {DAY_BEFORE} ELSE {AS_OF} END"
    days = f"SELECT *, {DAY_BEFORE} AS dt_stock FROM ({STOCKS}) UNION ALL SELECT *, {AS_OF} AS dt_stock FROM ({STOCKS})"
    sql = {f"stored_{table}": f"{begin} SELECT * FROM {table}" for table in DIMS}
    return sql | {
        "stored_orders": f"SELECT * REPLACE (CAST(order_date AS DATE) AS order_date) FROM ({ORDERS})",
        "stored_order_sales": f"{begin} SELECT * FROM sales",
        "stored_stocks_snapshot": days,
        "stored_fact_sales": f"{begin} SELECT * REPLACE ({loaded} AS data_criacao_registro) FROM ({FACT_SALES})",
        "stored_fato_stocks": f"{begin} {_fact_stocks(days)}",
    }


def oracle() -> dict[str, str]:
    snapshot = f"SELECT *, {AS_OF} AS dt_stock FROM ({STOCKS})"
    sql = {
        "csv_roundtrip_products": f"""
            SELECT p.product_id, p.product_name || ', "' || part.p_size || '"' AS product_name,
                   p.brand_id, p.category_id, p.list_price
            FROM ({PRODUCTS}) p JOIN part ON p_partkey = product_id""",
        "csv_null_marker_staffs": f"""
            SELECT *, CASE WHEN last_name = '0' THEN 'NULL' ELSE last_name END AS manager_id,
                   nullif(last_name, '0') AS marked_id
            FROM ({STAFFS})""",
        "bronze_full_load": ITEMS,
        "bronze_full_load_counts": _bronze_counts(),
        "bronze_merge_brands": _merge(
            "brand_id, brand_name", BRANDS, "brand_id", "brand_name", "brand_name <> 'Brand#13'"
        ),
        "bronze_merge_categories": _merge(
            "category_id, category_name", CATEGORIES, "category_id", "category_name", "category_name <> 'PROMO'"
        ),
        "bronze_merge_customers": _merge(
            "customer_id, first_name, last_name", CUSTOMERS, "customer_id", "first_name", "last_name <> 'HOUSEHOLD'"
        ),
        "bronze_merge_products": _merge(
            "product_id, product_name, brand_id, category_id, list_price",
            PRODUCTS,
            "product_id",
            "product_name",
            "product_id NOT IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO')",
        ),
        "bronze_merge_staffs": _merge(
            "staff_id, first_name, last_name",
            STAFFS,
            "staff_id",
            "first_name",
            f"CAST(last_name AS BIGINT) NOT IN ({LATER_STORES})",
        ),
        "bronze_merge_stores": _merge(
            "store_id, store_name", STORES, "store_id", "store_name", f"store_id NOT IN ({LATER_STORES})"
        ),
        "bronze_order_items_new": f"""
            WITH arrived AS ({ITEMS}),
                 stored AS (SELECT {ITEM_COLUMNS} FROM lineitem WHERE l_shipdate <= {CUTOFF})
            SELECT * FROM arrived a
            WHERE NOT EXISTS (SELECT 1 FROM stored s
                              WHERE s.order_id = a.order_id AND s.product_id IS NOT DISTINCT FROM a.product_id)""",
        "bronze_order_items_new_by_item": f"""
            WITH arrived AS ({ITEMS}),
                 stored AS (SELECT {ITEM_COLUMNS} FROM lineitem WHERE l_shipdate <= {CUTOFF})
            SELECT * FROM arrived a
            WHERE NOT EXISTS (SELECT 1 FROM stored s
                              WHERE s.order_id = a.order_id AND s.item_id IS NOT DISTINCT FROM a.item_id)""",
        "bronze_orders_new": f"""
            WITH arrived AS ({ORDERS})
            SELECT * FROM arrived
            WHERE order_date > (SELECT max(order_date) FROM arrived WHERE order_date <= {CUTOFF})""",
        "bronze_stocks_refresh": STOCKS,
        "silver_order_sales_full": SALES,
        "silver_order_sales_nosep": _sales(separator=""),
        "silver_order_sales_incremental": f"""
            WITH sales AS ({SALES})
            SELECT * FROM sales
            WHERE order_date > (SELECT max(order_date) FROM sales WHERE order_date <= {CUTOFF})""",
        "silver_order_sales_late": f"""
            WITH sales AS ({SALES}),
                 stored AS (SELECT l_orderkey, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                            WHERE l_shipdate <= {CUTOFF} AND o_orderdate <= {CUTOFF})
            SELECT * FROM sales
            WHERE order_date > {CUTOFF} - INTERVAL 90 DAY
              AND (order_date > {CUTOFF}
                   OR NOT EXISTS (SELECT 1 FROM stored WHERE l_orderkey = order_id AND l_linenumber = item_id))""",
        "silver_order_sales_orphans": ORPHAN_SALES,
        "silver_undated_target": f"""
            WITH sales AS ({ORPHAN_SALES})
            SELECT * FROM sales
            WHERE order_date IS NOT NULL
               OR (order_id, item_id) NOT IN (SELECT (l_orderkey, CAST(l_linenumber AS BIGINT)) FROM lineitem
                                              WHERE l_shipdate <= {CUTOFF})""",
        "silver_stocks_snapshot": snapshot,
        "gold_dim_date": CALENDAR,
        "gold_fact_sales": f"{_with_dims('sales')} {FACT_SALES}",
        "gold_fact_sales_incremental": f"""{_with_dims('sales')} {FACT_SALES}
            WHERE order_date > (SELECT max(order_date) FROM sales WHERE order_date <= {CUTOFF})""",
        "gold_fact_sales_orphans": f"{_with_dims('earlier_sales')} {FACT_SALES}",
        "gold_fact_sales_renamed": f"{_with_dims('sales', RENAMED_SALES)} {FACT_SALES}",
        "gold_dim_customers_orphans": f"WITH sales AS ({ORPHAN_SALES}) {_dim('dim_customers', 'sales')}",
        "gold_fact_stocks": f"{_with_dims('sales')} {_fact_stocks(snapshot)}",
        "gold_fact_stocks_unsold": f"{_with_dims('earlier_sales')} {_fact_stocks(snapshot)}",
        "gold_fact_stocks_incremental": f"""
            {_with_dims('sales').replace(' AS (', ' AS MATERIALIZED (')},
            snapshots AS MATERIALIZED (SELECT *, unnest([{DAY_BEFORE}, {AS_OF}]) AS dt_stock FROM ({STOCKS})),
            stored AS MATERIALIZED (SELECT max(dt_stock) AS day FROM snapshots WHERE dt_stock <= {DAY_BEFORE})
            {_fact_stocks("SELECT snapshots.* FROM snapshots, stored WHERE dt_stock > day")}""",
        "gold_repeated_members": f"""
            WITH sales AS MATERIALIZED ({RENAMED_SALES})
            """
        + " UNION ALL ".join(
            f"""SELECT '{table}' AS dimension, count(*) AS n_ids, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_members FROM (
                SELECT {key}, count(*) AS n FROM (SELECT DISTINCT {key}, {attributes} FROM sales) GROUP BY {key} HAVING count(*) > 1)"""
            for table, (_, key, attributes) in DIMS.items()
        ),
        "serve_sales_by_category": f"""
            SELECT CAST(year(order_date) AS BIGINT) AS year, category_name, count(*) AS n_lines,
                   CAST(sum(quantity) AS BIGINT) AS quantity
            FROM ({SALES}) WHERE year(order_date) BETWEEN 1997 AND 1998 GROUP BY ALL""",
        "serve_sales": f"""
            SELECT * REPLACE (CAST(order_date AS DATE) AS order_date), year(order_date) AS year,
                   month(order_date) AS month, day(order_date) AS day
            FROM ({SALES})""",
        "serve_gold_table": f"WITH sales AS ({SALES}) {_dim('dim_products', 'sales')}",
        "incremental_empty_target": "SELECT 'none' AS rule, 0 AS n_rows UNION ALL SELECT 'all', count(*) FROM orders",
        "not_in_null_member": f"""
            SELECT 'true' AS null_aware, 0 AS n_rows
            UNION ALL
            SELECT 'false', count(DISTINCT customer_id) FROM ({SALES})
            WHERE customer_id NOT IN (SELECT customer_id FROM ({SALES})
                                      WHERE order_date < {CUTOFF} - INTERVAL 54 MONTH)""",
        "table_exists_and_count": """
            SELECT 'false' AS existed, 'true' AS exists_now, count(*) AS n_rows,
                   CAST(5 AS BIGINT) AS n_preview, 'true' AS up_to_date
            FROM orders""",
        "pipeline_two_runs": _two_runs_counts(snapshots=2),
        "pipeline_two_runs_parity": _two_runs_counts(snapshots=3),
    }
    sql |= _stored()
    for table, (sk, key, attributes) in DIMS.items():
        columns = f"{key}, {attributes}"
        ctes = f"""
            WITH sales AS ({SALES}), earlier_sales AS ({EARLIER_SALES}),
                 existing AS ({_dim(table, 'earlier_sales', DAY_BEFORE)}),
                 ranked AS ({_dim(table, 'sales')}),
                 added AS (SELECT * FROM ranked WHERE {key} NOT IN (SELECT {key} FROM existing))"""
        sql[f"gold_{table}"] = f"WITH sales AS ({SALES}) {_dim(table, 'sales')}"
        sql[f"gold_{table}_new_rank"] = f"{ctes} SELECT * FROM added"
        sql[f"gold_{table}_new_offset"] = f"""{ctes}
            SELECT (SELECT max({sk}) FROM existing) + row_number() OVER (ORDER BY {columns}) AS {sk},
                   {columns}, data_criacao_registro
            FROM added"""
    return sql
