"""SQL that another engine runs on the same test tables, keyed like the queries.

Written from the semantics, independently of the plans: joins come before
aggregates, counts are distinct counts, and windows are plain comparisons.
"""

from __future__ import annotations

from martflow.operators.tables import month_start
from martflow.registry.queries import (
    PRODUCT_AFTER,
    PRODUCT_SNAPSHOT,
    REGISTERED_AFTER,
    REPLACED_FROM,
    SALES_DAY,
    SALES_DAY_BEFORE,
    SNAPSHOT_DAY,
    VISIT_DAY,
    VISIT_NOON,
)

SALES = """
sales AS (
  SELECT o_orderkey AS sales_id, o_custkey AS customer_id, CAST(c_nationkey AS BIGINT) AS ship_to,
         CAST(o_orderdate AS DATE) AS order_date, CAST(o_totalprice AS DECIMAL(18,2)) AS total
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
)"""

LINES = """
sale_product AS (
  SELECT l_orderkey AS sales_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS subtotal,
         CAST(round(l_discount * 50, 1) AS DECIMAL(4,1)) AS ratings
  FROM lineitem
)"""

WEB_VISIT = "web_visit AS (SELECT user_id AS customer_id, ts AS time_visit FROM events)"

TIME_COLUMNS = """
  CAST(strftime(date, '%Y%m%d') AS INTEGER) AS time_key,
  CAST(day(date) AS INTEGER) AS day_of_month,
  CAST((day(date) - 1) // 7 + 1 AS INTEGER) AS week_of_month,
  CAST(month(date) AS INTEGER) AS month,
  CAST(year(date) AS INTEGER) AS year,
  CAST(quarter(date) AS INTEGER) AS quarter_of_year,
  date"""

DIM_TIME = f"""
dim_time AS (
  SELECT {TIME_COLUMNS}
  FROM (SELECT CAST((SELECT min(o_orderdate) FROM orders) AS DATE) + CAST(i AS INTEGER) AS date
        FROM range(0, 3651) AS r(i)) AS days
)"""

DIM_CUSTOMER = """
dim_customer AS (
  SELECT c_custkey AS customer_key, c_name AS name, c_mktsegment AS segment, registered,
         CAST(NULL AS VARCHAR) AS sex, CAST(floor(c_acctbal) AS INTEGER) AS points
  FROM customer LEFT JOIN (
    SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS registered FROM orders GROUP BY o_custkey
  ) AS first_order ON c_custkey = o_custkey
)"""

# Ratings are averaged over the joined rows, one group per product.
DIM_PRODUCT = """
dim_product AS (
  SELECT p_partkey AS product_key, p_type AS category, p_brand AS subcategory, p_name AS product_name,
         CAST(round(CAST(CAST(sum(sp.ratings) AS DOUBLE) / count(sp.ratings) AS DECIMAL(18,10)), 2) AS DOUBLE)
           AS ratings
  FROM part LEFT JOIN sale_product sp ON p_partkey = sp.product_id
  GROUP BY p_partkey, p_type, p_brand, p_name
),
product_registered AS (
  SELECT p_partkey AS product_key, CAST(min(l_shipdate) AS DATE) AS registered
  FROM part LEFT JOIN lineitem ON p_partkey = l_partkey GROUP BY p_partkey
)"""

DIM_LOCATION = """
dim_location AS (
  SELECT CAST(n_nationkey AS BIGINT) AS location_key, n_name AS country, CAST(NULL AS VARCHAR) AS city,
         CAST(NULL AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS postal_code, r_name AS region
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
)"""


PLACES = """
places AS (
  SELECT c_custkey AS location_key, n_name AS country, r_name AS region, CAST(c_custkey * 7919 % 100000 AS VARCHAR) AS digits
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
)"""


def fct_sales(window: str = "TRUE", name: str = "fct_sales") -> str:
    return f"""
{name} AS (
  SELECT s.customer_id AS customer_key, s.ship_to AS location_key, sp.product_id AS product_key, t.time_key,
         CAST(coalesce(sum(sp.quantity), 0) AS BIGINT) AS quantity,
         CAST(coalesce(sum(sp.subtotal), 0) AS DOUBLE) AS sales
  FROM sale_product sp JOIN sales s ON sp.sales_id = s.sales_id
  LEFT JOIN dim_time t ON s.order_date = t.date
  WHERE {window} AND s.customer_id IS NOT NULL AND s.ship_to IS NOT NULL
    AND sp.product_id IS NOT NULL AND s.order_date IS NOT NULL
  GROUP BY s.customer_id, s.ship_to, sp.product_id, s.order_date, t.time_key
)"""


def visits(window: str = "TRUE", name: str = "visits") -> str:
    return f"""
{name} AS (
  SELECT customer_id AS customer_key, count(customer_id) AS visits
  FROM web_visit WHERE {window} GROUP BY customer_id
)"""


def daily_orders(window: str = "TRUE", name: str = "daily_orders") -> str:
    return f"""
{name} AS (
  SELECT customer_id, ship_to, order_date, count(*) AS orders, coalesce(sum(total), 0) AS total
  FROM sales
  WHERE {window} AND customer_id IS NOT NULL AND ship_to IS NOT NULL AND order_date IS NOT NULL
  GROUP BY customer_id, ship_to, order_date
)"""


def marketing(days: str = "daily_orders", name: str = "fct_marketing") -> str:
    return f"""
{name} AS (
  SELECT c.customer_key, d.ship_to AS location_key, t.time_key,
         CAST(d.orders AS DOUBLE) / nullif(CAST(v.visits AS DOUBLE), 0) AS conversion_rate,
         CAST(d.total AS DOUBLE) / nullif(CAST(d.orders AS DOUBLE), 0) AS avg_purchase_value
  FROM dim_customer c
  LEFT JOIN visits v ON c.customer_key = v.customer_key
  LEFT JOIN {days} d ON c.customer_key = d.customer_id
  LEFT JOIN dim_time t ON d.order_date = t.date
)"""


def with_tables(*tables: str, select: str) -> str:
    return f"WITH {', '.join(tables)}\n{select}"


SALES_BASE = (SALES, LINES, DIM_TIME)
MARKETING_BASE = (SALES, WEB_VISIT, DIM_TIME, DIM_CUSTOMER, visits())
WHOLE_MARKETING = (*MARKETING_BASE, daily_orders(), marketing())
SINCE = f"s.order_date >= DATE '{SALES_DAY}'"
AS_OF = f"s.order_date <= DATE '{SALES_DAY}'"


# --- upserts: an UPDATE and an INSERT ... NOT IN, spelled as a union --------------

CUSTOMER_CHANGE = (
    DIM_CUSTOMER,
    f"target AS (SELECT * FROM dim_customer WHERE registered <= DATE '{SNAPSHOT_DAY}')",
    f"""source AS (
  SELECT customer_key, upper(name) AS name, nullif(segment, 'BUILDING') AS segment, registered, sex,
         points + 100 AS points
  FROM dim_customer WHERE registered > DATE '{REGISTERED_AFTER}'
)""",
)
PRODUCT_CHANGE = (
    LINES,
    DIM_PRODUCT,
    f"""target AS (
  SELECT dim_product.* FROM dim_product JOIN product_registered USING (product_key)
  WHERE registered <= DATE '{PRODUCT_SNAPSHOT}'
)""",
    f"""source AS (
  SELECT dim_product.* REPLACE (
    upper(product_name) AS product_name, CASE WHEN category <> 'ECONOMY' THEN ratings END AS ratings)
  FROM dim_product JOIN product_registered USING (product_key)
  WHERE registered > DATE '{PRODUCT_AFTER}'
)""",
)
LOCATION_CHANGE = (
    DIM_LOCATION,
    "target AS (SELECT * FROM dim_location WHERE region <> 'ASIA')",
    """source AS (
  SELECT * REPLACE (lower(country) AS country, nullif(region, 'EUROPE') AS region)
  FROM dim_location WHERE region <> 'AFRICA'
)""",
)
TIME_CHANGE = (
    DIM_TIME,
    "target AS (SELECT * FROM dim_time)",
    f"""source AS (
  SELECT * REPLACE (CAST(week(date) AS INTEGER) AS week_of_month)
  FROM (SELECT {TIME_COLUMNS}
        FROM (SELECT CAST((SELECT max(o_orderdate) FROM orders) AS DATE) + CAST(i AS INTEGER) AS date
              FROM range(0, 3651) AS r(i)) AS days) AS rolled
)""",
)


def upserted(tables: tuple[str, ...], key: str) -> str:
    return with_tables(
        *tables,
        select=f"""
SELECT source.*, CASE WHEN {key} IN (SELECT {key} FROM target) THEN 'updated' ELSE 'inserted' END AS change
FROM source
UNION ALL
SELECT target.*, 'kept' FROM target WHERE {key} NOT IN (SELECT {key} FROM source)""",
    )


def counted(tables: tuple[str, ...], key: str, dimension: str) -> str:
    return "SELECT * FROM (" + with_tables(
        *tables,
        select=f"""
SELECT '{dimension}' AS dimension,
  (SELECT count(*) FROM source WHERE {key} IN (SELECT {key} FROM target)) AS updated_count,
  (SELECT count(*) FROM source WHERE {key} NOT IN (SELECT {key} FROM target)) AS inserted_count,
  (SELECT count(*) FROM target WHERE {key} NOT IN (SELECT {key} FROM source)) AS kept_count""",
    ) + ")"


# --- checks -------------------------------------------------------------------------

ALL_TABLES = (
    SALES,
    LINES,
    WEB_VISIT,
    DIM_TIME,
    DIM_CUSTOMER,
    DIM_PRODUCT,
    DIM_LOCATION,
    visits(),
    daily_orders(),
    fct_sales(),
    marketing(),
)

FOREIGN_KEYS = [
    ("fct_sales", "customer_key", "dim_customer"),
    ("fct_sales", "location_key", "dim_location"),
    ("fct_sales", "product_key", "dim_product"),
    ("fct_sales", "time_key", "dim_time"),
    ("fct_marketing", "customer_key", "dim_customer"),
    ("fct_marketing", "location_key", "dim_location"),
    ("fct_marketing", "time_key", "dim_time"),
]


def _fk(fact: str, column: str, dimension: str) -> str:
    return f"""
SELECT '{fact}' AS fact, '{column}' AS "column", '{dimension}' AS dimension, count({column}) AS checked_rows,
       count({column}) FILTER (WHERE NOT EXISTS (SELECT 1 FROM {dimension} d WHERE d.{column} = f.{column}))
         AS orphan_rows
FROM {fact} f"""


def _missing(table: str, columns: list[str], count_name: str = "missing_rows") -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS checked_rows, count(*) - count({c}) AS {count_name} FROM {table}"""
        for c in columns
    )


def _format(table: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS checked_rows,
       count(*) FILTER (WHERE NOT regexp_matches({c}, '{p}')) AS bad_rows FROM {table}"""
        for c, p in rules.items()
    )


def _suite_row(table: str, check: str, column: str, failed: str, frm: str, checked: str = "count(*)") -> str:
    return f"""
SELECT '{table}' AS "table", '{check}' AS "check", '{column}' AS "column",
       CAST({checked} AS BIGINT) AS checked_rows, CAST({failed} AS BIGINT) AS failed_rows, ({failed}) = 0 AS passed
FROM {frm}"""


def _suite() -> str:
    keys = {
        "dim_time": "time_key",
        "dim_customer": "customer_key",
        "dim_product": "product_key",
        "dim_location": "location_key",
    }
    required = {
        "dim_time": ["time_key", "date"],
        "dim_customer": ["customer_key", "name", "segment"],
        "dim_product": ["product_key", "product_name"],
        "dim_location": ["location_key", "country", "region"],
        "fct_sales": ["customer_key", "location_key", "product_key", "time_key", "quantity", "sales"],
        "fct_marketing": ["customer_key", "location_key", "time_key"],
    }
    formats = [
        ("dim_location", "postal_code", "^[0-9]{5}$"),
        ("dim_customer", "name", "\\S"),
        ("dim_product", "product_name", "\\S"),
    ]
    rows = [
        _suite_row(t, "duplicates", "*", f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {t}))", t)
        for t in ("fct_sales", "fct_marketing")
    ]
    rows += [_suite_row(t, "unique", k, f"count(*) - count(DISTINCT {k})", t) for t, k in keys.items()]
    rows += [_suite_row(t, "missing", c, f"count(*) - count({c})", t) for t, cs in required.items() for c in cs]
    rows += [
        _suite_row(t, "format", c, f"count(*) FILTER (WHERE NOT regexp_matches({c}, '{p}'))", t)
        for t, c, p in formats
    ]
    rows.append(
        _suite_row("dim_time", "complete", "date", "date_diff('day', min(date), max(date)) + 1 - count(*)", "dim_time")
    )
    rows += [
        _suite_row(
            f,
            "foreign_key",
            c,
            f"count({c}) FILTER (WHERE {c} NOT IN (SELECT {c} FROM {d}))",
            f,
            checked=f"count({c})",
        )
        for f, c, d in FOREIGN_KEYS
    ]
    rows += [
        _suite_row(
            "fct_sales",
            "reconciled",
            mart,
            f"""(SELECT CAST(coalesce(sum(CAST({line} AS DECIMAL(18,2))), 0)
       <> (SELECT coalesce(sum(CAST({mart} AS DECIMAL(18,2))), 0) FROM fct_sales) AS INTEGER) FROM sale_product)""",
            "sale_product",
        )
        for line, mart in (("quantity", "quantity"), ("subtotal", "sales"))
    ]
    return " UNION ALL ".join(rows)


def oracle_sql() -> dict[str, str]:
    whole_sales = with_tables(*SALES_BASE, fct_sales(), select="SELECT * FROM fct_sales")
    whole_visits = with_tables(WEB_VISIT, visits(), select="SELECT * FROM visits")
    whole_marketing = with_tables(*WHOLE_MARKETING, select="SELECT * FROM fct_marketing")
    # Lines summed per order and product first, orders described by their day's key.
    order_totals = """order_totals AS (
  SELECT sales_id, product_id, sum(quantity) AS quantity, sum(subtotal) AS subtotal
  FROM sale_product GROUP BY sales_id, product_id
)"""
    described_orders = """described_orders AS (
  SELECT sales_id, customer_id, ship_to, (SELECT time_key FROM dim_time WHERE date = order_date) AS time_key FROM sales
)"""
    product_totals = """
SELECT customer_id AS customer_key, ship_to AS location_key, product_id AS product_key, {keys}
       CAST(sum(quantity) AS BIGINT) AS quantity, CAST(sum(subtotal) AS DOUBLE) AS sales
FROM order_totals LEFT JOIN {orders} USING (sales_id)
GROUP BY customer_id, ship_to, product_id {more}"""
    by_place = """
SELECT {columns}, CAST(sum(quantity) AS BIGINT) AS quantity, CAST(sum(subtotal) AS DOUBLE) AS sales
FROM sale_product JOIN sales USING (sales_id) LEFT JOIN dim_location ON ship_to = location_key
GROUP BY {columns}"""
    return {
        "dim_time": with_tables(DIM_TIME, select="SELECT * FROM dim_time"),
        "calendar_iso_week": with_tables(
            DIM_TIME, select="SELECT time_key, CAST(week(date) AS INTEGER) AS iso_week, date FROM dim_time"
        ),
        "dim_customer": with_tables(DIM_CUSTOMER, select="SELECT * FROM dim_customer"),
        "dim_customer_since": with_tables(
            DIM_CUSTOMER, select=f"SELECT * FROM dim_customer WHERE registered > DATE '{REGISTERED_AFTER}'"
        ),
        "dim_product": with_tables(LINES, DIM_PRODUCT, select="SELECT * FROM dim_product"),
        "dim_product_since": with_tables(
            LINES,
            DIM_PRODUCT,
            select=f"""SELECT dim_product.* FROM dim_product JOIN product_registered USING (product_key)
WHERE registered > DATE '{PRODUCT_AFTER}'""",
        ),
        "dim_location": with_tables(DIM_LOCATION, select="SELECT * FROM dim_location"),
        "sales_scan": with_tables(SALES, select="SELECT * REPLACE (CAST(total AS DOUBLE) AS total) FROM sales"),
        "sale_product_scan": with_tables(
            LINES,
            select="""SELECT * REPLACE (CAST(subtotal AS DOUBLE) AS subtotal, CAST(ratings AS DOUBLE) AS ratings)
FROM sale_product""",
        ),
        "sale_product_since": with_tables(
            SALES,
            LINES,
            select=f"""SELECT * REPLACE (CAST(subtotal AS DOUBLE) AS subtotal, CAST(ratings AS DOUBLE) AS ratings)
FROM sale_product WHERE sales_id IN (SELECT sales_id FROM sales WHERE order_date >= DATE '{SALES_DAY}')""",
        ),
        "fct_sales": whole_sales,
        "fct_sales_since": with_tables(*SALES_BASE, fct_sales(SINCE), select="SELECT * FROM fct_sales"),
        "fct_sales_as_of": with_tables(*SALES_BASE, fct_sales(AS_OF), select="SELECT * FROM fct_sales"),
        "fct_sales_sql": with_tables(
            *SALES_BASE,
            order_totals,
            described_orders,
            select=product_totals.format(keys="time_key,", orders="described_orders", more=", time_key"),
        ),
        "sales_with_product": with_tables(
            SALES, LINES, order_totals, select=product_totals.format(keys="", orders="sales", more="")
        ),
        "visits": whole_visits,
        "visits_since": with_tables(
            WEB_VISIT, visits(f"time_visit >= TIMESTAMP '{VISIT_DAY}'"), select="SELECT * FROM visits"
        ),
        "visits_as_of": with_tables(
            WEB_VISIT, visits(f"time_visit <= TIMESTAMP '{VISIT_DAY}'"), select="SELECT * FROM visits"
        ),
        "orders_by_customer_day": with_tables(
            SALES, daily_orders(), select="SELECT * REPLACE (CAST(total AS DOUBLE) AS total) FROM daily_orders"
        ),
        "fct_marketing": whole_marketing,
        "fct_marketing_since": with_tables(
            *MARKETING_BASE,
            daily_orders(f"order_date >= DATE '{SALES_DAY}'"),
            marketing(),
            select="SELECT * FROM fct_marketing",
        ),
        "scd1_customer": upserted(CUSTOMER_CHANGE, "customer_key"),
        "scd1_product": upserted(PRODUCT_CHANGE, "product_key"),
        "scd1_location": upserted(LOCATION_CHANGE, "location_key"),
        "scd1_time": upserted(TIME_CHANGE, "time_key"),
        "scd1_counts": " UNION ALL ".join(
            [
                counted(CUSTOMER_CHANGE, "customer_key", "dim_customer"),
                counted(PRODUCT_CHANGE, "product_key", "dim_product"),
                counted(LOCATION_CHANGE, "location_key", "dim_location"),
                counted(TIME_CHANGE, "time_key", "dim_time"),
            ]
        ),
        "fact_append_sales": whole_sales,
        "fact_append_marketing": with_tables(
            *MARKETING_BASE,
            daily_orders(f"order_date <= DATE '{SALES_DAY_BEFORE}'", "early_orders"),
            daily_orders(f"order_date >= DATE '{SALES_DAY}'", "late_orders"),
            marketing("early_orders", "early"),
            marketing("late_orders", "late"),
            select="SELECT * FROM early UNION ALL SELECT * FROM late",
        ),
        "fact_replace_window": whole_sales,
        "fact_replace_marketing": whole_marketing,
        "upsert_customer": f"""SELECT * EXCLUDE (change) FROM ({upserted(CUSTOMER_CHANGE, "customer_key")})""",
        "load_mart": with_tables(
            *ALL_TABLES,
            select="""SELECT 'dim_time' AS "table", count(*) AS rows, CAST(sum(time_key) AS DOUBLE) AS total FROM dim_time
UNION ALL SELECT 'dim_customer', count(*), CAST(sum(points) AS DOUBLE) FROM dim_customer
UNION ALL SELECT 'dim_product', count(*), CAST(sum(product_key) AS DOUBLE) FROM dim_product
UNION ALL SELECT 'dim_location', count(*), CAST(sum(location_key) AS DOUBLE) FROM dim_location
UNION ALL SELECT 'fct_sales', count(*), CAST(sum(CAST(sales AS DECIMAL(18,2))) AS DOUBLE) FROM fct_sales
UNION ALL SELECT 'fct_marketing', count(*), CAST(count(conversion_rate) AS DOUBLE) FROM fct_marketing""",
        ),
        "dim_product_incremental": with_tables(LINES, DIM_PRODUCT, select="SELECT * FROM dim_product"),
        "visits_from_days": with_tables(
            WEB_VISIT, visits(f"time_visit >= TIMESTAMP '{VISIT_DAY}'"), select="SELECT * FROM visits"
        ),
        "visits_from_days_as_of": with_tables(
            WEB_VISIT, visits(f"time_visit <= TIMESTAMP '{VISIT_NOON}'"), select="SELECT * FROM visits"
        ),
        "check_difference": with_tables(
            *SALES_BASE,
            fct_sales(),
            select="""SELECT customer_key, location_key, product_key, time_key,
       CASE customer_key % 97 WHEN 0 THEN 'lost' WHEN 1 THEN 'doubled' ELSE 'changed' END AS difference,
       count(*) AS expected_rows, count(*) * (CASE customer_key % 97 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 1 END) AS found_rows,
       CASE WHEN customer_key % 97 = 2 THEN 'quantity' END AS columns
FROM fct_sales WHERE customer_key % 97 IN (0, 1, 2)
GROUP BY customer_key, location_key, product_key, time_key""",
        ),
        "dim_location_repaired": with_tables(
            PLACES,
            select="""SELECT location_key, country, CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS state,
       CASE WHEN location_key % 50 <> 10 THEN lpad(digits, 5, '0') END AS postal_code, region
FROM places WHERE location_key % 50 NOT IN (7, 8, 9)""",
        ),
        "dim_location_rejected": with_tables(
            PLACES,
            select="""SELECT 'failed' AS outcome, 'country known' AS rule, count(*) AS rows FROM places WHERE location_key % 50 = 9
UNION ALL SELECT 'failed', 'postal_code format', count(*) FROM places WHERE location_key % 50 IN (7, 8)
UNION ALL SELECT 'repaired', 'postal_code format', count(*) FROM places WHERE location_key % 50 NOT IN (7, 8, 10)""",
        ),
        "load_mart_audited": with_tables(
            *SALES_BASE,
            fct_sales(),
            f"""planted AS (
  SELECT DISTINCT CASE WHEN sales_id % 100 = 0 THEN -customer_id - 1 ELSE customer_id END AS customer_key,
         ship_to, product_id, order_date
  FROM sale_product JOIN sales USING (sales_id)
  WHERE order_date >= DATE '{month_start(REPLACED_FROM)}' AND customer_id IS NOT NULL AND ship_to IS NOT NULL
    AND product_id IS NOT NULL
)""",
            select="""SELECT 'fct_sales' AS "table", 'rows' AS "check", 'sales' AS "column", count(*) AS checked_rows,
       count(*) FILTER (customer_key < 0) AS failed_rows, CAST(sum(CAST(sales AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM fct_sales
UNION ALL
SELECT 'fct_sales', 'foreign_key', 'customer_key', count(*), count(*) FILTER (customer_key < 0), NULL FROM planted""",
        ),
        "handoff_sales": whole_sales,
        "csv_round_trip": whole_sales,
        "bulk_load": whole_marketing,
        "indexed_csv_visits": whole_visits,
        "read_or_build": whole_visits,
        "check_duplicates": with_tables(
            LINES,
            select="""SELECT sales_id, product_id, quantity, count(*) AS copies FROM sale_product
GROUP BY sales_id, product_id, quantity HAVING count(*) > 1""",
        ),
        "check_unique": """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
        "check_missing": with_tables(
            *WHOLE_MARKETING,
            select=_missing(
                "fct_marketing",
                ["customer_key", "location_key", "time_key", "conversion_rate", "avg_purchase_value"],
            ),
        ),
        "check_format": with_tables(
            LINES,
            DIM_PRODUCT,
            select=_format(
                "dim_product", {"subcategory": "^Brand#[0-9]{2}$", "product_name": "^[a-z]+ [a-z]+$"}
            ),
        ),
        "check_format_rows": with_tables(
            LINES,
            DIM_PRODUCT,
            select="SELECT * FROM dim_product WHERE NOT regexp_matches(subcategory, '^Brand#[0-9]{2}$')",
        ),
        "check_completeness": """
SELECT 'order without lines' AS finding, o_orderkey AS key FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
UNION ALL
SELECT 'customer without visits', c_custkey FROM customer
WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)""",
        "check_reconciliation": with_tables(
            *SALES_BASE,
            fct_sales(),
            """totals AS (
  SELECT 'quantity' AS measure, (SELECT CAST(sum(quantity) AS DOUBLE) FROM sale_product) AS source_value,
         (SELECT CAST(sum(quantity) AS DOUBLE) FROM fct_sales) AS mart_value
  UNION ALL
  SELECT 'sales', (SELECT CAST(sum(subtotal) AS DOUBLE) FROM sale_product),
         (SELECT CAST(sum(CAST(sales AS DECIMAL(18,2))) AS DOUBLE) FROM fct_sales)
  UNION ALL
  SELECT 'rows', (SELECT CAST(count(*) AS DOUBLE) FROM fct_sales), (SELECT CAST(count(*) AS DOUBLE) FROM fct_sales)
)""",
            select="SELECT *, mart_value - source_value AS difference FROM totals",
        ),
        "check_calendar": """
SELECT day AS missing_date FROM (
  SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS day FROM orders
) WHERE day NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderdate IS NOT NULL)""",
        "check_fk": with_tables(*ALL_TABLES, select=" UNION ALL ".join(_fk(*fk) for fk in FOREIGN_KEYS)),
        "check_fk_orphans": with_tables(
            *SALES_BASE,
            fct_sales(),
            DIM_CUSTOMER,
            select=f"""
SELECT customer_key, count(*) AS fact_rows FROM fct_sales
WHERE customer_key NOT IN (SELECT customer_key FROM dim_customer WHERE registered <= DATE '{SNAPSHOT_DAY}')
GROUP BY customer_key""",
        ),
        "check_suite": with_tables(*ALL_TABLES, select=_suite()),
        "report_sales_by_region": with_tables(
            SALES, LINES, DIM_LOCATION, select=by_place.format(columns="region")
        ),
        "report_sales_by_country": with_tables(
            SALES, LINES, DIM_LOCATION, select=by_place.format(columns="region, country")
        ),
        "report_customers_by_sex": with_tables(
            DIM_CUSTOMER, select="SELECT sex, count(*) AS customers FROM dim_customer GROUP BY sex"
        ),
        "report_sales_by_segment": with_tables(
            SALES,
            LINES,
            DIM_CUSTOMER,
            select="""
SELECT segment, count(DISTINCT customer_id) AS customers, CAST(sum(quantity) AS BIGINT) AS quantity,
       CAST(sum(subtotal) AS DOUBLE) AS sales
FROM sale_product JOIN sales USING (sales_id) LEFT JOIN dim_customer ON customer_id = customer_key
GROUP BY segment""",
        ),
        "report_retention": with_tables(
            WEB_VISIT,
            """first_week AS (
  SELECT customer_id, CAST(date_trunc('week', min(time_visit)) AS DATE) AS cohort_week
  FROM web_visit WHERE customer_id IS NOT NULL GROUP BY customer_id
)""",
            """active AS (
  SELECT cohort_week, customer_id,
         CAST(date_diff('day', cohort_week, CAST(date_trunc('week', time_visit) AS DATE)) // 7 AS INTEGER)
           AS week_offset
  FROM web_visit JOIN first_week USING (customer_id)
)""",
            select="""
SELECT a.cohort_week, a.week_offset, count(DISTINCT a.customer_id) AS customers,
       CAST(count(DISTINCT a.customer_id) AS DOUBLE)
         / (SELECT count(*) FROM first_week f WHERE f.cohort_week = a.cohort_week) AS retention
FROM active a GROUP BY a.cohort_week, a.week_offset""",
        ),
    }
