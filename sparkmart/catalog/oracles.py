"""Reference answers: for each registered query, SQL over the driver tables.

Written independently of the Spark plans, in the most direct form. Shared steps are common
table expressions, pulled in by name.
"""

from __future__ import annotations

import re

DAY = "CAST(strftime({0}, '%Y%m%d') AS BIGINT)"


def day(column: str) -> str:
    return DAY.format(column)


_CTE: dict[str, str] = {
    "sales_log": f"""
        SELECT 'SO-' || l_orderkey AS order_number, CAST(l_linenumber AS BIGINT) AS order_line_item,
               {day('o_orderdate')} AS order_date_key, {day('l_shipdate')} AS stock_date_key,
               l_partkey AS product_key,
               CASE WHEN l_orderkey % 50 <> 0 THEN o_custkey END AS customer_key,
               CAST(c_nationkey AS BIGINT) AS territory_key,
               CAST(l_quantity AS BIGINT) + CASE WHEN v.op = 3 THEN 1 ELSE 0 END AS order_quantity,
               v.op AS op,
               lpad(lower(to_hex({day('l_shipdate')})), 20, '0') AS lsn,
               lpad(lower(to_hex(l_partkey)), 10, '0') || lpad(lower(to_hex(l_suppkey)), 10, '0')
                 AS seqval
        FROM lineitem
        JOIN orders ON o_orderkey = l_orderkey
        JOIN customer ON c_custkey = o_custkey
        JOIN (VALUES ('R', 1), ('N', 2), ('A', 3), ('A', 4)) v(flag, op) ON v.flag = l_returnflag""",
    "latest": """
        SELECT *, op = 1 AS is_deleted FROM sales_log WHERE op <> 3
        QUALIFY row_number() OVER (PARTITION BY order_number, order_line_item
                                   ORDER BY lsn DESC, seqval DESC, op DESC) = 1""",
    "latest_baseline": """
        SELECT *, op = 1 AS is_deleted FROM sales_log WHERE op <> 3 AND stock_date_key <= 19971231
        QUALIFY row_number() OVER (PARTITION BY order_number, order_line_item
                                   ORDER BY lsn DESC, seqval DESC, op DESC) = 1""",
    "latest_increment": """
        SELECT *, op = 1 AS is_deleted FROM sales_log WHERE op <> 3 AND stock_date_key > 19971231
        QUALIFY row_number() OVER (PARTITION BY order_number, order_line_item
                                   ORDER BY lsn DESC, seqval DESC, op DESC) = 1""",
    "checkpoint": "SELECT max(lsn) AS lsn FROM sales_log WHERE stock_date_key <= 19971231",
    "staged_products": """
        SELECT CASE WHEN p_partkey % 101 <> 100 THEN p_partkey END AS product_key,
               CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT) * 1000
                 + ascii(p_type) + length(p_type) AS product_subcategory_key,
               'SKU-' || p_partkey AS product_sku,
               CASE WHEN p_partkey % 83 = 82 THEN ' ' ELSE p_name END AS product_name,
               split_part(p_name, ' ', 2) AS model_name,
               p_name || ' by ' || p_brand AS product_description,
               split_part(p_name, ' ', 1) AS product_color,
               CASE p_size % 4 WHEN 0 THEN '0' WHEN 1 THEN 'M' WHEN 2 THEN CAST(p_size AS VARCHAR)
                 ELSE 'XL' END AS product_size,
               CASE p_partkey % 5 WHEN 0 THEN 'U' WHEN 1 THEN 'W' WHEN 2 THEN 'M' WHEN 3 THEN '0'
                 END AS product_style,
               CASE WHEN p_partkey % 89 <> 88
                 THEN CAST(round(p_retailprice * 100) AS BIGINT) * (p_partkey % 11 + 1) // 10
                 END AS cost_cents,
               CASE WHEN p_partkey % 97 = 96 THEN NULL WHEN p_partkey % 79 = 78 THEN -100
                 ELSE CAST(round(p_retailprice * 100) AS BIGINT) END AS price_cents
        FROM part""",
    "judged_products": """
        SELECT *, CASE
            WHEN product_key IS NULL THEN 'missing_key'
            WHEN product_name IS NULL OR trim(product_name) = '' THEN 'blank_name'
            WHEN price_cents IS NULL THEN 'missing_price'
            WHEN price_cents <= 0 THEN 'non_positive_price'
            WHEN cost_cents IS NULL THEN 'missing_cost'
            WHEN cost_cents > price_cents THEN 'cost_above_price' END AS error_reason
        FROM staged_products""",
    "observations": """
        SELECT j.* REPLACE (
                 CASE WHEN product_key % 3 = 0 AND d.day >= DATE '1997-07-01'
                   THEN price_cents * 110 // 100 ELSE price_cents END AS price_cents,
                 CASE WHEN product_key % 5 = 0 AND d.day >= DATE '1999-07-01'
                   THEN cost_cents * 90 // 100 ELSE cost_cents END AS cost_cents),
               d.day AS observed_on
        FROM judged_products j,
             (VALUES (DATE '1995-01-01'), (DATE '1997-07-01'), (DATE '1999-07-01')) d(day)
        WHERE error_reason IS NULL
          AND NOT (d.day = DATE '1999-07-01' AND coalesce(TRY_CAST(product_size AS INTEGER) > 40, FALSE))""",
    "observed_changes": """
        SELECT *, row_number() OVER w AS rn, lag(price_cents) OVER w AS last_price,
               lag(cost_cents) OVER w AS last_cost
        FROM observations WINDOW w AS (PARTITION BY product_key ORDER BY observed_on)""",
    "history": """
        SELECT *, md5(product_key || '~' || strftime(observed_on, '%Y-%m-%d')) AS version_key,
               observed_on AS valid_from,
               lead(observed_on) OVER (PARTITION BY product_key ORDER BY observed_on) AS valid_to
        FROM observed_changes
        WHERE rn = 1 OR price_cents IS DISTINCT FROM last_price OR cost_cents IS DISTINCT FROM last_cost""",
    "categories": "SELECT DISTINCT ascii(p_type) + length(p_type) AS product_category_key, "
    "p_type AS category_name FROM part",
    "subcategories": """
        SELECT DISTINCT CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT) * 1000
                 + ascii(p_type) + length(p_type) AS product_subcategory_key,
               p_brand || ' ' || p_type AS subcategory_name,
               ascii(p_type) + length(p_type) AS product_category_key
        FROM part""",
    "product_codes": """
        SELECT product_sku, nullif(product_size, '0') AS product_size,
               CASE WHEN product_size IN ('S', 'M', 'L', 'XL') THEN 'Clothing'
                    WHEN regexp_full_match(product_size, ' *[0-9]+ *')
                         AND TRY_CAST(trim(product_size) AS INTEGER) > 0 THEN 'Frame (cm)'
                    ELSE 'No Size' END AS product_size_type,
               CASE WHEN product_style = 'U' THEN 'Unisex' WHEN product_style = 'W' THEN 'Women'
                    WHEN product_style = 'M' THEN 'Men'
                    WHEN product_style = '0' OR product_style IS NULL THEN 'N/A'
                    ELSE product_style END AS product_style
        FROM staged_products""",
    "dim_products": f"""
        SELECT h.version_key AS product_scd_key, h.product_key, h.product_subcategory_key,
               s.subcategory_name, c.product_category_key, c.category_name, h.product_sku,
               h.product_name, h.model_name, h.product_description, h.product_color,
               k.product_size, k.product_size_type, k.product_style, h.cost_cents, h.price_cents,
               {day('h.valid_from')} AS updated_key,
               CASE WHEN h.valid_from = min(h.valid_from) OVER (PARTITION BY h.product_key)
                 THEN 19000101 ELSE {day('h.valid_from')} END AS valid_from_key,
               {day('h.valid_to')} AS valid_to_key
        FROM history h
        JOIN product_codes k ON k.product_sku = h.product_sku
        LEFT JOIN subcategories s ON s.product_subcategory_key = h.product_subcategory_key
        LEFT JOIN categories c ON c.product_category_key = s.product_category_key
        UNION ALL
        SELECT '-1', -1, NULL, NULL, NULL, NULL, NULL, 'Unknown', NULL, NULL, NULL, NULL,
               'No Size', 'N/A', 0, 0, 19000101, 19000101, NULL""",
    "staged_customers": """
        SELECT c_custkey AS customer_key,
               CASE c_custkey % 3 WHEN 0 THEN 'MR.' WHEN 1 THEN 'MS.' END AS prefix,
               split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
               DATE '1940-01-01' + CAST(c_custkey % 20000 AS INTEGER) AS birth_date,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'S' WHEN 'AUTOMOBILE' THEN 'M'
                 WHEN 'MACHINERY' THEN 'D' WHEN 'HOUSEHOLD' THEN 'W' ELSE 'X' END AS marital_status,
               CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END AS gender,
               lower(replace(c_name, '#', '.')) || '@example.com' AS email_address,
               CAST(c_acctbal AS DECIMAL(18,2)) AS yearly_income,
               c_custkey % 6 AS total_children,
               upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS education_level,
               lower(c_mktsegment) AS occupation,
               CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_acctbal < 5000 THEN 'N' ELSE 'Y' END
                 AS home_owner
        FROM customer""",
    "decoded_customers": """
        SELECT * EXCLUDE (home_owner) REPLACE (
                 CASE marital_status WHEN 'S' THEN 'Single' WHEN 'M' THEN 'Married'
                   WHEN 'D' THEN 'Divorced' WHEN 'W' THEN 'Widowed' ELSE 'N/A' END AS marital_status,
                 CASE gender WHEN 'M' THEN 'Male' WHEN 'F' THEN 'Female' ELSE 'N/A' END AS gender),
               coalesce(home_owner = 'Y', FALSE) AS is_home_owner
        FROM staged_customers""",
    "arrived_customers": "SELECT * FROM decoded_customers WHERE yearly_income >= 0",
    "dim_customers": """
        SELECT *, FALSE AS is_inferred FROM arrived_customers
        UNION ALL
        SELECT DISTINCT customer_key, 'N/A', 'Pending', 'Pending', DATE '1900-01-01', 'N/A', 'N/A',
               'unknown@example.com', CAST(0 AS DECIMAL(18,2)), 0, 'N/A', 'N/A', FALSE, TRUE
        FROM sales_log
        WHERE customer_key IS NOT NULL
          AND customer_key NOT IN (SELECT customer_key FROM arrived_customers)
        UNION ALL
        SELECT -1, 'N/A', 'Guest', 'Unknown', DATE '1900-01-01', 'N/A', 'N/A', 'guest@example.com',
               CAST(0 AS DECIMAL(18,2)), 0, 'N/A', 'N/A', FALSE, FALSE""",
    "staged_territories": """
        SELECT CAST(n_nationkey AS BIGINT) AS sales_territory_key, n_name AS region,
               r_name AS country, r_name AS continent
        FROM nation JOIN region ON r_regionkey = n_regionkey""",
    "arrived_territories": "SELECT * FROM staged_territories WHERE country <> 'MIDDLE EAST'",
    "dim_territories": """
        SELECT sales_territory_key AS territory_key, region, country, continent, FALSE AS is_inferred
        FROM arrived_territories
        UNION ALL
        SELECT DISTINCT territory_key, 'N/A', 'N/A', 'N/A', TRUE FROM sales_log
        WHERE territory_key NOT IN (SELECT sales_territory_key FROM arrived_territories)
        UNION ALL
        SELECT -1, 'N/A', 'N/A', 'N/A', FALSE""",
    "spine": """
        SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS full_date
        FROM (SELECT least(min(o_orderdate), min(l_shipdate)) AS lo,
                     greatest(max(o_orderdate), max(l_shipdate)) AS hi
              FROM lineitem JOIN orders ON o_orderkey = l_orderkey)""",
    "dim_calendar": f"""
        SELECT {day('full_date')} AS date_key, full_date, year(full_date) AS year,
               quarter(full_date) AS quarter,
               'Q' || quarter(full_date) || '-' || year(full_date) AS quarter_name,
               month(full_date) AS month, strftime(full_date, '%b') AS month_name,
               strftime(full_date, '%Y-%m') AS year_month, day(full_date) AS day_of_month,
               week(full_date) AS week_of_year, strftime(full_date, '%a') AS day_name,
               dayofweek(full_date) AS day_of_week,
               strftime(full_date, '%a') IN ('Sat', 'Sun') AS is_weekend
        FROM spine""",
    "staged_returns": """
        SELECT stock_date_key AS return_date_key, territory_key, product_key,
               sum(order_quantity) AS return_quantity
        FROM sales_log WHERE op = 1 GROUP BY ALL""",
    "staged_sales": """
        SELECT order_number, order_line_item, order_date_key, stock_date_key, product_key,
               customer_key, territory_key, order_quantity
        FROM latest_baseline WHERE NOT is_deleted""",
    "current_sales": """
        SELECT l.* FROM latest l WHERE NOT (l.is_deleted AND l.stock_date_key <= 19971231)""",
    "fct_sales": """
        SELECT s.order_number, s.order_line_item, s.order_date_key, s.stock_date_key,
               coalesce(p.product_scd_key, '-1') AS product_scd_key, s.product_key,
               coalesce(s.customer_key, -1) AS customer_key,
               coalesce(s.territory_key, -1) AS territory_key, s.order_quantity, s.is_deleted,
               CASE WHEN s.stock_date_key <= 19971231 THEN (SELECT lsn FROM checkpoint) ELSE s.lsn END
                 AS lsn,
               CASE WHEN s.stock_date_key <= 19971231 THEN repeat('0', 20) ELSE s.seqval END AS seqval
        FROM current_sales s
        LEFT JOIN dim_products p ON p.product_key = s.product_key
             AND s.order_date_key >= p.valid_from_key
             AND (s.order_date_key < p.valid_to_key OR p.valid_to_key IS NULL)""",
    "fct_replayed": """
        SELECT s.order_number, s.order_line_item, s.order_date_key, s.stock_date_key,
               coalesce(p.product_scd_key, '-1') AS product_scd_key, s.product_key,
               coalesce(s.customer_key, -1) AS customer_key,
               coalesce(s.territory_key, -1) AS territory_key, s.order_quantity, s.is_deleted,
               s.lsn, s.seqval
        FROM latest s
        LEFT JOIN dim_products p ON p.product_key = s.product_key
             AND s.order_date_key >= p.valid_from_key
             AND (s.order_date_key < p.valid_to_key OR p.valid_to_key IS NULL)""",
    "event_changes": """
        SELECT user_id, event_type, ts, row_number() OVER w AS rn, lag(event_type) OVER w AS last_type
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)""",
}


def _needed(text: str, found: list[str]) -> None:
    for name in _CTE:
        if name not in found and re.search(rf"\b{name}\b", text):
            _needed(_CTE[name], found)
            found.append(name)


def sql(body: str) -> str:
    """``body`` preceded by the common table expressions it mentions, in order."""
    found: list[str] = []
    _needed(body, found)
    if not found:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({_CTE[n]})" for n in found) + "\n" + body


def rows(columns: str, source: str) -> str:
    """Select ``columns`` from ``source``, each given as ``name`` or ``name:type``."""
    picked = []
    for item in columns.split():
        name, _, kind = item.partition(":")
        picked.append(f"CAST({name} AS {kind}) AS {name}" if kind else name)
    return sql(f"SELECT {', '.join(picked)} FROM {source}")


_SALE = (
    "order_number order_line_item:bigint order_date_key:bigint stock_date_key:bigint "
    "product_key:bigint customer_key:bigint territory_key:bigint order_quantity:bigint"
)
_FACT = (
    "order_number order_line_item:bigint order_date_key:bigint stock_date_key:bigint "
    "product_scd_key product_key:bigint customer_key:bigint territory_key:bigint "
    "order_quantity:bigint is_deleted lsn seqval"
)
_PRODUCT = (
    "product_key:bigint product_subcategory_key:bigint product_sku product_name model_name "
    "product_description product_color product_size product_style"
)
_CUSTOMER = (
    "customer_key:bigint prefix first_name last_name birth_date:varchar marital_status gender "
    "email_address yearly_income:double total_children:bigint education_level occupation"
)
_DIM_PRODUCT = (
    "product_scd_key product_key:bigint product_subcategory_key:bigint subcategory_name "
    "product_category_key:bigint category_name product_sku product_name model_name "
    "product_description product_color product_size product_size_type product_style "
    "product_cost product_price updated_key:bigint valid_from_key:bigint valid_to_key:bigint"
)
_HISTORY = f"{_PRODUCT} product_cost product_price version_key updated_at valid_from:varchar valid_to:varchar"


def _priced(source: str) -> str:
    return (
        f"(SELECT *, cost_cents / 100.0::DOUBLE AS product_cost, "
        f"price_cents / 100.0::DOUBLE AS product_price FROM {source})"
    )


def _check(name: str, failures: str, severity: str = "error", warn: int = 0, fail: int | None = 0) -> str:
    """The outcome row of one check, given a query that counts its violations."""
    status = f"WHEN f > {warn} THEN 'warn' ELSE 'pass' END"
    if fail is not None:
        status = f"WHEN f > {fail} THEN 'fail' {status}"
    return (
        f"SELECT '{name}' AS name, '{severity}' AS severity, CAST(f AS BIGINT) AS failures, "
        f"CASE {status} AS status FROM ({failures}) AS counted(f)"
    )


def _staging_rows() -> str:
    """One row per check of the staged tables."""
    tables = {
        "sales": ("staged_sales", "order_number order_line_item order_date_key product_key customer_key"),
        "sales_log": ("latest", "order_number order_line_item op is_deleted"),
        "customers": ("staged_customers", "customer_key"),
        "territories": ("staged_territories", "sales_territory_key"),
        "returns": ("staged_returns", "return_date_key product_key territory_key"),
        "product_categories": ("categories", "product_category_key category_name"),
        "product_subcategories": (
            "subcategories", "product_subcategory_key subcategory_name product_category_key",
        ),
        "date_spine": ("dim_calendar", "full_date"),
    }
    unique = {
        "customers": "customer_key",
        "territories": "sales_territory_key",
        "product_categories": "product_category_key category_name",
        "product_subcategories": "product_subcategory_key",
        "date_spine": "full_date",
    }
    parts = [
        _check(f"staged_{name}.{c}.not_null", f"SELECT count(*) FROM {source} WHERE {c} IS NULL")
        for name, (source, columns) in tables.items()
        for c in columns.split()
    ]
    parts += [
        _check(
            f"staged_{name}.{c}.unique",
            f"SELECT count(*) FROM (SELECT {c} FROM {tables[name][0]} GROUP BY {c} HAVING count(*) > 1)",
        )
        for name, columns in unique.items()
        for c in columns.split()
    ]
    parts += [
        _check(
            "staged_products.product_key.not_null",
            "SELECT count(*) FROM staged_products WHERE product_key IS NULL",
            "warn", 0, None,
        ),
        _check(
            "staged_sales_log.op.accepted_values",
            "SELECT count(*) FROM latest WHERE op NOT IN (1, 2, 3, 4)",
        ),
        _check(
            "staged_product_subcategories.product_category_key.relationship",
            "SELECT count(*) FROM subcategories WHERE product_category_key NOT IN "
            "(SELECT product_category_key FROM categories)",
        ),
        _check("staged_loads.load_id.not_null", "SELECT 0"),
        _check("staged_loads.status.not_null", "SELECT 0"),
    ]
    return "\nUNION ALL\n".join(parts)


def _check_rows() -> str:
    """One row per check of the star schema, spelled out check by check."""
    tables = {
        "dim_calendar": "date_key full_date year quarter month day_of_month is_weekend",
        "dim_customers": "customer_key email_address birth_date is_home_owner",
        "dim_products": "product_scd_key product_key product_name cost_cents price_cents valid_from_key",
        "dim_territories": "territory_key region country continent",
        "staged_returns": "return_date_key territory_key product_key return_quantity",
        "fct_sales": "order_number order_line_item order_date_key stock_date_key customer_key "
        "product_scd_key product_key territory_key order_quantity is_deleted",
    }
    shown = {"staged_returns": "fct_returns"}
    money = {"cost_cents": "product_cost", "price_cents": "product_price"}
    parts: list[str] = []

    def add(*check) -> None:
        parts.append(_check(*check))

    for table, columns in tables.items():
        for c in columns.split():
            add(
                f"{shown.get(table, table)}.{money.get(c, c)}.not_null",
                f"SELECT count(*) FROM {table} WHERE {c} IS NULL",
            )
    for table, column, values, severity in (
        ("dim_calendar", "quarter", "1, 2, 3, 4", "error"),
        ("dim_calendar", "month", "1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12", "error"),
        ("dim_customers", "marital_status", "'Single', 'Married', 'Divorced', 'Widowed', 'N/A'", "warn"),
        ("dim_customers", "gender", "'Male', 'Female', 'N/A'", "warn"),
        ("dim_products", "product_size_type", "'Clothing', 'Frame (cm)', 'No Size'", "error"),
        ("dim_products", "product_style", "'Unisex', 'Women', 'Men', 'N/A'", "error"),
    ):
        add(
            f"{table}.{column}.accepted_values",
            f"SELECT count(*) FROM {table} WHERE {column} NOT IN ({values})",
            severity,
            0,
            0 if severity == "error" else None,
        )
    for name, table, column in (
        ("dim_calendar.date_key.unique", "dim_calendar", "date_key"),
        ("dim_calendar.full_date.unique", "dim_calendar", "full_date"),
        ("dim_customers.customer_key.unique", "dim_customers", "customer_key"),
        ("dim_territories.territory_key.unique", "dim_territories", "territory_key"),
        ("dim_products.version_key_unique", "dim_products", "product_scd_key"),
    ):
        add(
            name,
            f"SELECT count(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL "
            f"GROUP BY {column} HAVING count(*) > 1)",
        )
    for table, column, parent, key in (
        ("staged_returns", "return_date_key", "dim_calendar", "date_key"),
        ("staged_returns", "territory_key", "dim_territories", "territory_key"),
        ("staged_returns", "product_key", "dim_products", "product_key"),
        ("fct_sales", "order_date_key", "dim_calendar", "date_key"),
        ("fct_sales", "stock_date_key", "dim_calendar", "date_key"),
        ("fct_sales", "customer_key", "dim_customers", "customer_key"),
        ("fct_sales", "product_scd_key", "dim_products", "product_scd_key"),
        ("fct_sales", "territory_key", "dim_territories", "territory_key"),
    ):
        add(
            f"{shown.get(table, table)}.{column}.relationship",
            f"SELECT count(*) FROM {table} WHERE {column} NOT IN (SELECT {key} FROM {parent})",
        )
    add(
        "dim_products.no_overlap",
        "SELECT count(*) FROM (SELECT valid_to_key, lead(valid_from_key) OVER (PARTITION BY "
        "product_key ORDER BY valid_from_key, valid_to_key NULLS LAST) AS nxt FROM dim_products) "
        "WHERE nxt < valid_to_key",
    )
    add(
        "dim_products.positive_margin",
        "SELECT count(*) FROM dim_products WHERE price_cents < cost_cents",
    )
    add(
        "dim_customers.future_birth_date",
        "SELECT count(*) FROM dim_customers WHERE birth_date >= DATE '2001-08-02'",
        "warn",
        0,
        None,
    )
    live = "(SELECT * FROM fct_sales WHERE NOT is_deleted)"
    add("fct_returns.after_first_order", f"SELECT count(*) FROM ({_EARLY_RETURNS.format(sales=live)})", "warn", 0, 50)
    add(
        "fct_sales.fresh",
        f"SELECT count(*) FROM (SELECT max(order_date_key) AS k FROM {live}) "
        "WHERE k IS NULL OR k < 20010801",
    )
    add(
        "fct_sales.volume",
        "SELECT count(*) FROM (SELECT coalesce(max(CASE WHEN k = 20010801 THEN n END), 0) AS y, "
        "avg(CASE WHEN k < 20010801 THEN n END) AS a FROM (SELECT order_date_key AS k, count(*) AS n "
        f"FROM {live} WHERE order_date_key BETWEEN 20010725 AND 20010801 GROUP BY 1)) "
        "WHERE a IS NULL OR y < a * 0.3",
    )
    return "\nUNION ALL\n".join(parts)


_EARLY_RETURNS = (  # of the sales given
    "SELECT r.product_key, first_return_date_key, first_order_date_key "
    "FROM (SELECT product_key, min(return_date_key) AS first_return_date_key FROM staged_returns "
    "GROUP BY 1) r "
    "JOIN (SELECT product_key, min(order_date_key) AS first_order_date_key FROM {sales} GROUP BY 1) s "
    "ON r.product_key = s.product_key WHERE first_return_date_key < first_order_date_key"
)


def build() -> dict[str, str]:
    """Oracle SQL by query name."""
    o: dict[str, str] = {}

    # Sources and loads.
    o["s1_csv_directory_load"] = " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, {key}::BIGINT AS key, "
        f"'a \"b\", ' || {text} || chr(10) || '-' AS text, count(*) OVER () AS row_count FROM {table}"
        for table, key, text in (
            ("customer", "c_custkey", "c_name"),
            ("nation", "n_nationkey", "n_name"),
            ("orders", "o_orderkey", "o_orderpriority"),
        )
    )
    o["s2_date_coercion"] = (
        f"SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN {day('o_orderdate')} END AS order_day "
        "FROM orders"
    )
    o["s3_read_source"] = (
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"
    )
    o["s4_replace_load"] = "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0"
    o["s5_append_load"] = sql(
        "SELECT CASE WHEN stock_date_key <= 19971231 THEN '001' ELSE '002' END AS load_id, "
        "count(*) AS row_count, sum(order_quantity)::BIGINT AS quantity FROM sales_log GROUP BY 1"
    )
    o["s6_read_since"] = rows(f"{_SALE} op:bigint lsn seqval", "sales_log WHERE stock_date_key > 19971231")
    o["s7_checkpoint"] = sql("SELECT 'sales' AS source, lsn, 'baseline' AS load_id FROM checkpoint")
    o["s8_load_once"] = (
        "SELECT CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'first' ELSE 'second' END AS load_id, "
        "strftime(ts, '%Y-%m-%d') AS archive, count(*) AS row_count FROM events GROUP BY ALL"
    )
    o["s9_load_audit"] = sql(
        "SELECT load_id, schema_name, 'loaded' AS status, row_count, 64::BIGINT AS hash_length, "
        "schema_name <> 'products' AS same_schema, 3::BIGINT AS hashes "
        "FROM (VALUES ('day1'), ('day2')) d(load_id), ("
        "SELECT 'customers' AS schema_name, count(*) AS row_count FROM staged_customers UNION ALL "
        "SELECT 'products', count(*) FROM staged_products UNION ALL "
        "SELECT 'returns', count(*) FROM staged_returns)"
    )
    o["s13_date_spine"] = rows("full_date:varchar", "spine")
    current = (
        "(SELECT order_number, order_line_item, order_date_key, stock_date_key, product_key, "
        "customer_key, territory_key, order_quantity FROM latest WHERE NOT is_deleted)"
    )
    same_key = "o.order_number = n.order_number AND o.order_line_item = n.order_line_item"
    o["s14_snapshot_diff"] = sql(
        f"""SELECT 1::BIGINT AS op, o.* FROM staged_sales o ANTI JOIN {current} n ON {same_key}
        UNION ALL SELECT 2, n.* FROM {current} n ANTI JOIN staged_sales o ON {same_key}
        UNION ALL SELECT 3, o.* FROM staged_sales o JOIN {current} n ON {same_key}
                  WHERE o IS DISTINCT FROM n
        UNION ALL SELECT 4, n.* FROM staged_sales o JOIN {current} n ON {same_key}
                  WHERE o IS DISTINCT FROM n"""
    )
    o["s14_stored_snapshot_diff"] = o["s14_snapshot_diff"]

    # Staging and expressions.
    o["p1_staged_customers"] = rows(f"{_CUSTOMER} home_owner", "staged_customers")
    o["p1_staged_products"] = rows(f"{_PRODUCT} product_cost product_price", _priced("staged_products"))
    o["p1_staged_product_categories"] = rows("product_category_key:bigint category_name", "categories")
    o["p1_staged_product_subcategories"] = rows(
        "product_subcategory_key:bigint subcategory_name product_category_key:bigint", "subcategories"
    )
    o["p1_staged_territories"] = rows("sales_territory_key region country continent", "staged_territories")
    o["p1_staged_returns"] = rows(
        "return_date_key territory_key product_key return_quantity:bigint", "staged_returns"
    )
    o["p1_staged_sales"] = rows(_SALE, "staged_sales")
    o["p1_staged_sales_log"] = rows(f"{_SALE} op:bigint lsn seqval", "sales_log")
    o["p5_decode_customers"] = rows("customer_key marital_status gender is_home_owner", "decoded_customers")
    o["p6_p7_product_codes"] = rows("product_sku product_size product_size_type product_style", "product_codes")
    o["f1_date_key"] = f"SELECT o_orderkey, {day('o_orderdate')} AS order_day FROM orders"
    o["f15_binary_position"] = (
        "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, "
        "lpad(lower(to_hex(l_orderkey)), 20, '0') AS position FROM lineitem"
    )
    o["t2_job_checks"] = sql(
        f"SELECT * FROM ({_check_rows()}) "
        "WHERE name LIKE 'fct_sales.%' OR name = 'fct_returns.after_first_order'"
    )
    o["t2_job_calendar"] = rows("full_date:varchar", "spine")
    o["t2_job_customers"] = sql(
        "SELECT customer_key, FALSE AS is_inferred FROM staged_customers UNION ALL SELECT -1, FALSE"
    )
    o["f14_version_id"] = sql(
        "SELECT product_key, strftime(observed_on, '%Y-%m-%d') AS observed_on, "
        "md5(product_key || '~' || strftime(observed_on, '%Y-%m-%d')) AS version_key FROM observations"
    )

    # Joins.
    asof = sql(
        """SELECT s.order_number, s.order_line_item, s.op::BIGINT AS op, s.lsn, s.seqval, p.product_scd_key
        FROM sales_log s LEFT JOIN dim_products p ON p.product_key = s.product_key
             AND s.order_date_key >= p.valid_from_key
             AND (s.order_date_key < p.valid_to_key OR p.valid_to_key IS NULL)"""
    )
    o["j1_asof_join"] = asof
    o["j1_asof_join_salted"] = asof
    o["j1_asof_join_merged"] = asof
    o["j2_flatten_categories"] = sql(
        "SELECT product_subcategory_key, subcategory_name, c.product_category_key::BIGINT AS "
        "product_category_key, category_name FROM subcategories s LEFT JOIN categories c "
        "ON c.product_category_key = s.product_category_key"
    )

    # Warehouse operators.
    o["m1_latest_state"] = rows(f"{_SALE} op:bigint lsn seqval is_deleted", "latest")
    o["m2_upsert"] = rows(_FACT, "fct_sales")
    o["m2_upsert_hard_delete"] = rows(_FACT, "fct_sales WHERE NOT is_deleted")
    o["m3_dim_calendar"] = rows(
        "date_key:bigint full_date:varchar year:bigint quarter:bigint quarter_name month:bigint month_name "
        "year_month day_of_month:bigint week_of_year:bigint day_name day_of_week:bigint is_weekend",
        "dim_calendar",
    )
    history = rows(
        _HISTORY.replace("updated_at", "updated_at:varchar"),
        "(SELECT *, valid_from AS updated_at FROM " + _priced("history") + ")",
    )
    o["m4_scd2_from_history"] = history
    o["m4_scd2_apply"] = history
    events = sql(
        """SELECT user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS valid_from,
               strftime(lead(ts) OVER (PARTITION BY user_id ORDER BY ts), '%Y-%m-%d %H:%M:%S.%f')
                 AS valid_to
        FROM event_changes WHERE rn = 1 OR event_type IS DISTINCT FROM last_type"""
    )
    o["m4_scd2_events"] = events
    o["m4_scd2_events_split"] = events
    o["m5_inferred_members"] = sql(
        "SELECT 'customer' AS dimension, customer_key AS member_key FROM dim_customers WHERE is_inferred "
        "UNION ALL SELECT 'territory', territory_key FROM dim_territories WHERE is_inferred"
    )
    o["m6_accepted_products"] = rows(
        f"{_PRODUCT} product_cost product_price", _priced("judged_products") + " WHERE error_reason IS NULL"
    )
    o["m6_quarantined_products"] = rows(
        f"{_PRODUCT} product_cost product_price error_reason quarantined_at",
        "(SELECT *, '1995-01-01 00:00:00' AS quarantined_at FROM "
        + _priced("judged_products") + " WHERE error_reason IS NOT NULL)",
    )
    o["m7_repair_keys"] = sql(
        "SELECT order_number, order_line_item, coalesce(customer_key, -1) AS customer_key FROM current_sales"
    )
    o["m7_repair_stored_fact"] = sql(
        "SELECT order_number, order_line_item, coalesce(customer_key, -1) AS customer_key, "
        "is_deleted, lsn FROM latest"
    )
    o["m8_dim_products"] = rows(_DIM_PRODUCT, _priced("dim_products"))
    o["m9_sales_base"] = sql(
        """SELECT s.order_number, s.order_line_item, s.order_date_key, s.stock_date_key,
               coalesce(p.product_scd_key, '-1') AS product_scd_key, s.product_key,
               coalesce(s.customer_key, -1) AS customer_key, s.territory_key, s.order_quantity,
               FALSE AS is_deleted, (SELECT lsn FROM checkpoint) AS lsn, repeat('0', 20) AS seqval
        FROM staged_sales s LEFT JOIN dim_products p ON p.product_key = s.product_key
             AND s.order_date_key >= p.valid_from_key
             AND (s.order_date_key < p.valid_to_key OR p.valid_to_key IS NULL)"""
    )
    o["m10_sales_increment"] = sql(
        """SELECT s.order_number, s.order_line_item, s.order_date_key, s.stock_date_key,
               coalesce(p.product_scd_key, '-1') AS product_scd_key, s.product_key,
               coalesce(s.customer_key, -1) AS customer_key, s.territory_key, s.order_quantity,
               s.is_deleted, s.lsn, s.seqval
        FROM latest_increment s LEFT JOIN dim_products p ON p.product_key = s.product_key
             AND s.order_date_key >= p.valid_from_key
             AND (s.order_date_key < p.valid_to_key OR p.valid_to_key IS NULL)"""
    )
    o["m11_dim_customers"] = rows(f"{_CUSTOMER} is_home_owner is_inferred", "dim_customers")
    o["m11_dim_territories"] = rows("territory_key region country continent is_inferred", "dim_territories")
    o["m12_fct_returns"] = o["p1_staged_returns"]

    # Checks.
    o["q0_column_checks"] = sql(
        "SELECT 'products.' || name AS name, 'error' AS severity, failures, "
        "CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status FROM ("
        + " UNION ALL ".join(
            f"SELECT '{shown}.not_null' AS name, count(*) AS failures FROM staged_products WHERE {c} IS NULL"
            for c, shown in (
                ("product_key", "product_key"),
                ("product_name", "product_name"),
                ("product_style", "product_style"),
                ("cost_cents", "product_cost"),
                ("price_cents", "product_price"),
            )
        )
        + " UNION ALL SELECT 'product_size.accepted_values', count(*) FROM staged_products "
        "WHERE product_size NOT IN ('0', 'M', 'XL'))"
    )
    o["q0_staging_checks"] = sql(_staging_rows())
    o["q0b_duplicates"] = (
        "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, count(*) AS occurrences FROM lineitem "
        "GROUP BY ALL HAVING count(*) > 1"
    )
    o["q1_scd2_overlaps"] = sql(
        """SELECT * FROM (
             SELECT product_key, valid_from_key, valid_to_key, lead(valid_from_key) OVER (
                      PARTITION BY product_key ORDER BY valid_from_key, valid_to_key NULLS LAST
                    ) AS next_valid_from
             FROM (SELECT * REPLACE (CASE WHEN valid_to_key IS NOT NULL THEN 19980101::BIGINT END AS valid_to_key)
                   FROM dim_products))
           WHERE next_valid_from < valid_to_key"""
    )
    o["q2_future_birth_date"] = rows(
        "customer_key birth_date:varchar", "dim_customers WHERE birth_date >= DATE '1942-01-01'"
    )
    o["q3_duplicate_versions"] = sql(
        "SELECT product_key, count(*) AS occurrences FROM dim_products GROUP BY 1 HAVING count(*) > 1"
    )
    o["q4_orphans"] = sql(
        "SELECT product_key, count(*) AS violations FROM staged_returns "
        "WHERE product_key NOT IN (SELECT product_key FROM dim_products) GROUP BY 1"
    )
    o["q5_returned_before_ordered"] = sql(_EARLY_RETURNS.format(sales="fct_sales"))
    o["q6_stale"] = sql(
        "SELECT latest_day_key FROM (SELECT max(order_date_key) AS latest_day_key FROM fct_sales) "
        "WHERE latest_day_key < 20010902"
    )
    volume = (
        "SELECT yesterday_rows, usual_rows, yesterday_rows / nullif(usual_rows, 0) * 100 AS "
        "percentage_of_normal FROM (SELECT coalesce(max(CASE WHEN d = DATE '{y}' THEN n END), 0) AS "
        "yesterday_rows, avg(CASE WHEN d < DATE '{y}' THEN n END) AS usual_rows FROM ("
        "SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events "
        "WHERE CAST(ts AS DATE) BETWEEN DATE '{y}' - 7 AND DATE '{y}' GROUP BY 1))"
    )
    o["q7_volume_stats"] = volume.format(y="2024-01-30")
    o["q7_volume_anomaly"] = (
        "SELECT * FROM (" + volume.format(y="2024-02-02") + ") "
        "WHERE usual_rows IS NULL OR yesterday_rows < usual_rows * 0.3"
    )
    o["q8_negative_margin"] = rows(
        "product_sku product_price product_cost", _priced("staged_products") + " WHERE price_cents < cost_cents"
    )
    o["q9_all_checks"] = sql(_check_rows())
    o["q10_gated_fact_checks"] = sql(
        "SELECT * FROM (" + _check_rows() + ") WHERE name LIKE 'fct_sales.%' "
        "AND name NOT IN ('fct_sales.fresh', 'fct_sales.volume')"
    )

    # Business questions.
    o["a1_gross_revenue"] = sql(
        "SELECT count(DISTINCT order_number) AS orders, sum(order_quantity)::BIGINT AS all_quantity, "
        "sum(order_quantity * price_cents)::BIGINT / 100.0::DOUBLE AS revenue "
        "FROM fct_sales s LEFT JOIN dim_products p ON p.product_scd_key = s.product_scd_key "
        "WHERE NOT is_deleted"
    )
    o["a1_gross_revenue_per_version"] = sql(
        "SELECT count(DISTINCT order_number) AS orders, sum(order_quantity)::BIGINT AS all_quantity, "
        "sum(order_quantity * price_cents)::BIGINT / 100.0::DOUBLE AS revenue "
        "FROM fct_sales s LEFT JOIN dim_products p ON p.product_key = s.product_key"
    )
    o["a2_revenue_by_category"] = sql(
        "SELECT category_name, count(DISTINCT order_number) AS orders, "
        "sum(order_quantity)::BIGINT AS units_sold, "
        "sum(order_quantity * price_cents)::BIGINT / 100.0::DOUBLE AS revenue "
        "FROM fct_sales s LEFT JOIN dim_products p ON p.product_scd_key = s.product_scd_key "
        "WHERE NOT is_deleted GROUP BY 1 ORDER BY revenue DESC, 1"
    )
    o["a4_returned_quantity"] = sql(
        "SELECT count(*) AS return_records, min(full_date)::VARCHAR AS min_date, "
        "max(full_date)::VARCHAR AS max_date, sum(return_quantity)::BIGINT AS total_quantity_return "
        "FROM staged_returns LEFT JOIN dim_calendar ON date_key = return_date_key"
    )
    o["a5_products_by_color"] = sql(
        """SELECT product_color, count(*) AS version_count, count(DISTINCT product_key) AS product_count,
               ((2 * sum(price_cents)::BIGINT + count(*)) // (2 * count(*))) / 100.0::DOUBLE AS avg_price,
               ((20000 * count(DISTINCT product_key) + any_value(total)) // (2 * any_value(total)))
                 / 100.0::DOUBLE AS pct
        FROM dim_products, (SELECT count(DISTINCT product_key) AS total FROM dim_products
                            WHERE product_scd_key <> '-1')
        WHERE product_scd_key <> '-1' GROUP BY product_color"""
    )
    o["a6_margin_by_subcategory"] = sql(
        "SELECT subcategory_name, count(*) AS sales_lines, sum(order_quantity)::BIGINT AS total_quantity, "
        "sum(order_quantity * (price_cents - cost_cents))::BIGINT / 100.0::DOUBLE AS gross_margin "
        "FROM fct_sales s LEFT JOIN dim_products p ON p.product_scd_key = s.product_scd_key "
        "WHERE NOT is_deleted GROUP BY 1 ORDER BY gross_margin DESC, 1"
    )

    o["a7_revenue_trend"] = sql(
        """SELECT strftime(month, '%Y-%m-%d') AS month, units, cents / 100.0::DOUBLE AS revenue,
               (cents - lag(cents) OVER w) / 100.0::DOUBLE AS month_over_month,
               round((cents / 100.0::DOUBLE / nullif(lag(cents) OVER w / 100.0::DOUBLE, 0) - 1) * 100, 2)
                 AS month_over_month_pct,
               (cents - lag(cents, 12) OVER w) / 100.0::DOUBLE AS year_over_year,
               round((cents / 100.0::DOUBLE / nullif(lag(cents, 12) OVER w / 100.0::DOUBLE, 0) - 1) * 100, 2)
                 AS year_over_year_pct
        FROM (SELECT month, coalesce(units, 0) AS units, coalesce(cents, 0) AS cents
              FROM (SELECT unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH))::DATE AS month
                    FROM (SELECT strptime((order_date_key // 100)::BIGINT || '01', '%Y%m%d') AS m
                          FROM fct_sales WHERE NOT is_deleted))
              LEFT JOIN (
                SELECT strptime((order_date_key // 100)::BIGINT || '01', '%Y%m%d')::DATE AS month,
                       sum(order_quantity)::BIGINT AS units,
                       sum(order_quantity * price_cents)::BIGINT AS cents
                FROM fct_sales s LEFT JOIN dim_products p ON p.product_scd_key = s.product_scd_key
                WHERE NOT is_deleted GROUP BY 1) USING (month))
        WINDOW w AS (ORDER BY month)"""
    )
    o["a8_customer_segments"] = sql(
        """SELECT customer_key, recency_days, frequency, value,
               ntile(5) OVER (ORDER BY recency_days DESC, customer_key) AS recency_score,
               ntile(5) OVER (ORDER BY frequency, customer_key) AS frequency_score,
               ntile(5) OVER (ORDER BY value, customer_key) AS value_score
        FROM (SELECT customer_key, date_diff('day', strptime(max(order_date_key)::BIGINT::VARCHAR,
                       '%Y%m%d')::DATE, DATE '2001-08-02') AS recency_days,
                     count(DISTINCT order_number) AS frequency,
                     coalesce(sum(order_quantity * price_cents), 0)::BIGINT / 100.0::DOUBLE AS value
              FROM fct_sales s LEFT JOIN dim_products p ON p.product_scd_key = s.product_scd_key
              WHERE NOT is_deleted AND customer_key <> -1 GROUP BY 1)"""
    )

    # Streaming and jobs.
    o["t3_compacted_increments"] = rows(_FACT, "fct_replayed WHERE NOT is_deleted")
    o["t1_cdc_stream"] = rows(_FACT, "fct_replayed")
    o["t2_warehouse_jobs"] = rows(_FACT, "fct_sales")
    o["t3_out_of_order_increments"] = rows(_FACT, "fct_replayed")
    return o
