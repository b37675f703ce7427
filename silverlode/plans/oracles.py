"""The registered queries in SQL, written against the same Parquet tables.

The relations below build on one another; ``_with`` puts those a statement uses in front of it.
"""

from __future__ import annotations

import re

RELATIONS: dict[str, str] = {}
ORACLES: dict[str, str] = {}

RELATIONS["silver_orders"] = """
    SELECT order_id, customer_key, status_code, order_date, approved_date, shipped_date, delivered_date,
           estimated_delivery_date,
           CAST(date_diff('day', order_date, delivered_date) AS INTEGER) AS days_to_deliver,
           delivered_date <= estimated_delivery_date AS delivered_on_time
    FROM (
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_key,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'processing' END AS status_code,
               o_orderdate AS order_date,
               o_orderdate + INTERVAL 1 HOUR AS approved_date,
               o_orderdate + INTERVAL 2 DAY AS shipped_date,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate + to_days(CAST(o_orderkey % 60 AS INTEGER)) END AS delivered_date,
               o_orderdate + INTERVAL 45 DAY AS estimated_delivery_date
        FROM orders
        WHERE o_orderkey IS NOT NULL AND o_custkey IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_custkey) = 1
    )
"""

RELATIONS["silver_customers"] = """
    SELECT CAST(c_custkey AS VARCHAR) AS customer_key, c_name AS customer_id,
           upper(left(n_name, 1)) || lower(substr(n_name, 2)) AS city,
           upper(r_name) AS state_code,
           lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip_prefix
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE c_custkey IS NOT NULL AND c_name IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY c_name) = 1
"""

RELATIONS["raw_lines"] = """
    SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
           CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
           strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS shipping_limit_date,
           l_extendedprice AS price, l_quantity AS freight_value
    FROM lineitem
"""

RELATIONS["silver_items"] = """
    SELECT order_id, order_item_id, product_id AS product_key, seller_id,
           CAST(shipping_limit_date AS TIMESTAMP) AS shipping_deadline,
           CAST(price AS DECIMAL(10,2)) AS item_price_brl,
           CAST(freight_value AS DECIMAL(10,2)) AS freight_cost_brl,
           CAST(CAST(price AS DECIMAL(10,2)) + CAST(freight_value AS DECIMAL(10,2)) AS DECIMAL(10,2)) AS total_item_cost_brl
    FROM raw_lines
    WHERE order_id IS NOT NULL AND product_id IS NOT NULL AND CAST(price AS DECIMAL(10,2)) >= 0
"""

RELATIONS["silver_reviews"] = """
    SELECT CAST(event_id AS VARCHAR) AS review_id, CAST(event_id // 3 * 4 AS VARCHAR) AS order_id,
           CAST(event_id % 5 + 1 AS INTEGER) AS rating, nullif(trim(text, ' '), '') AS review_text,
           date_trunc('second', ts) AS review_date
    FROM events LEFT JOIN documents ON event_id = doc_id
    WHERE event_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY event_id % 5, text, ts) = 1
"""

RELATIONS["silver_rates"] = """
    SELECT 'USD' AS base_currency,
           upper(CASE event_type WHEN 'purchase' THEN 'brl' ELSE event_type END) AS target_currency,
           CAST(value + 1 AS DECIMAL(18,6)) AS rate, ts AS rate_timestamp, ts AS captured_at
    FROM events
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, CAST(value + 1 AS DECIMAL(18,6)) DESC) = 1
"""

RELATIONS["brl_rate"] = """
    SELECT rate AS brl_per_usd, captured_at AS rate_date
    FROM silver_rates WHERE target_currency = 'BRL' ORDER BY captured_at DESC NULLS FIRST LIMIT 1
"""

RELATIONS["labels_by_customer"] = """
    SELECT customer_key, count(order_id) AS total_orders, min(order_date) AS first_order_date, max(order_date) AS last_order_date,
           datesub('day', max(order_date), (SELECT max(order_date) FROM silver_orders)) AS days_since_last_order,
           datesub('day', min(order_date), max(order_date)) AS customer_lifetime_days,
           CAST(coalesce(datesub('day', max(order_date), (SELECT max(order_date) FROM silver_orders)) >= 180, false) AS INTEGER) AS churned
    FROM silver_orders GROUP BY customer_key
"""

RELATIONS["orders_by_customer"] = """
    SELECT customer_key, count(order_id) AS total_orders, avg(days_to_deliver) AS avg_days_to_deliver,
           count(*) FILTER (WHERE NOT delivered_on_time) AS late_delivery_count,
           count(*) FILTER (WHERE NOT delivered_on_time) / count(order_id) AS late_delivery_rate
    FROM silver_orders GROUP BY customer_key
"""

RELATIONS["spend_by_customer"] = """
    SELECT customer_key, CAST(sum(total_item_cost_brl) AS DOUBLE) AS total_spend,
           CAST(sum(total_item_cost_brl) AS DOUBLE) / count(total_item_cost_brl) AS avg_order_value
    FROM silver_items JOIN silver_orders USING (order_id) GROUP BY customer_key
"""

RELATIONS["reviews_by_customer"] = """
    SELECT customer_key, avg(rating) AS avg_rating, count(review_id) AS review_count
    FROM silver_reviews JOIN silver_orders USING (order_id) GROUP BY customer_key
"""

RELATIONS["payment_by_customer"] = """
    SELECT customer_key, payment_type AS primary_payment_type
    FROM (
        SELECT customer_key, o_orderpriority AS payment_type, count(*) AS n
        FROM orders JOIN silver_orders ON CAST(o_orderkey AS VARCHAR) = order_id
        WHERE o_orderpriority IS NOT NULL
        GROUP BY ALL
    )
    QUALIFY row_number() OVER (PARTITION BY customer_key ORDER BY n DESC, payment_type) = 1
"""

RELATIONS["assembled"] = """
    SELECT *
    FROM (SELECT * EXCLUDE (total_orders, first_order_date, last_order_date) FROM labels_by_customer)
    LEFT JOIN orders_by_customer USING (customer_key)
    LEFT JOIN spend_by_customer USING (customer_key)
    LEFT JOIN reviews_by_customer USING (customer_key)
    LEFT JOIN payment_by_customer USING (customer_key)
    LEFT JOIN (SELECT DISTINCT customer_key, state_code FROM silver_customers) USING (customer_key)
"""

# The lower and upper middle value; their mean is the median.
RELATIONS["middle_days"] = """
    SELECT avg(avg_days_to_deliver) AS median_days
    FROM (
        SELECT avg_days_to_deliver, row_number() OVER (ORDER BY avg_days_to_deliver) AS nth, count(*) OVER () AS n
        FROM orders_by_customer WHERE avg_days_to_deliver IS NOT NULL
    )
    WHERE nth IN ((n + 1) // 2, (n + 2) // 2)
"""

RELATIONS["scored"] = """
    SELECT customer_key, churned, late_delivery_rate AS p, CAST(late_delivery_rate > 0.3 AS INTEGER) AS predicted
    FROM orders_by_customer JOIN (SELECT customer_key, churned FROM labels_by_customer) USING (customer_key)
"""

RELATIONS["churn_score_table"] = """
    SELECT customer_key, round_even(p, 4) AS churn_score,
           CASE WHEN p > 0 AND p <= 0.3 THEN 'low' WHEN p > 0.3 AND p <= 0.6 THEN 'medium' WHEN p > 0.6 AND p <= 1 THEN 'high' END AS churn_risk,
           predicted AS predicted_churn, churned AS actual_churned
    FROM scored
"""

RELATIONS["customer_dimension"] = """
    SELECT c.*, coalesce(s.churn_score, 0.0) AS churn_score, coalesce(s.churn_risk, 'unknown') AS churn_risk,
           coalesce(s.predicted_churn = 1, false) AS predicted_churn,
           CASE s.churn_risk WHEN 'high' THEN 'At Risk' WHEN 'medium' THEN 'Watch' WHEN 'low' THEN 'Loyal' ELSE 'Unknown' END AS customer_segment
    FROM silver_customers c LEFT JOIN churn_score_table s USING (customer_key)
"""

_CALENDAR = """
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS TIMESTAMP) AS full_date,
           CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
           rpad(monthname(d), 9, ' ') AS month_name, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
           CAST(isodow(d) AS INTEGER) AS day_of_week, rpad(dayname(d), 9, ' ') AS day_name,
           isodow(d) IN (6, 7) AS is_weekend, 'Q' || quarter(d) AS quarter_label, strftime(d, '%Y-%m') AS year_month
    FROM (SELECT CAST(unnest(generate_series({first}, {last}, INTERVAL 1 DAY)) AS DATE) AS d FROM {source})
"""
RELATIONS["order_span"] = "SELECT min(order_date) AS first_day, max(order_date) AS last_day FROM silver_orders"
RELATIONS["calendar"] = _CALENDAR.format(first="first_day", last="last_day", source="order_span")

RELATIONS["annotated"] = """
    SELECT review_id, CASE WHEN rating >= 4 THEN 'positive' WHEN rating <= 2 THEN 'negative' ELSE 'neutral' END AS sentiment_label,
           rating / 10 AS annotation_confidence, CASE WHEN rating % 2 = 1 THEN 'delivery' ELSE 'other' END AS primary_topic,
           rating = 3 AS needs_human_review
    FROM silver_reviews WHERE review_text IS NOT NULL
"""

_FACT_LINES = """
    SELECT order_id, customer_key, product_key, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key,
           order_item_id, status_code, order_date, delivered_date, days_to_deliver, delivered_on_time,
           item_price_brl, freight_cost_brl, total_item_cost_brl AS total_amount_brl,
           round(CAST(item_price_brl AS DOUBLE) / CAST(brl_per_usd AS DOUBLE), 2) AS item_price_usd,
           round(CAST(freight_cost_brl AS DOUBLE) / CAST(brl_per_usd AS DOUBLE), 2) AS freight_cost_usd,
           round(CAST(total_item_cost_brl AS DOUBLE) / CAST(brl_per_usd AS DOUBLE), 2) AS total_amount_usd,
           brl_per_usd AS exchange_rate_used, rating AS review_rating,
           {sentiment} AS sentiment_label, {topic} AS review_topic
    FROM silver_items JOIN silver_orders USING (order_id)
    LEFT JOIN {reviews} USING (order_id)
    CROSS JOIN brl_rate
"""

RELATIONS["first_reviews"] = """
    SELECT order_id, rating, sentiment_label, primary_topic
    FROM silver_reviews LEFT JOIN annotated USING (review_id)
    QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY review_date NULLS LAST, review_id) = 1
"""

RELATIONS["fact_lines"] = _FACT_LINES.format(
    sentiment="CAST(NULL AS VARCHAR)", topic="CAST(NULL AS VARCHAR)", reviews="silver_reviews"
)
RELATIONS["single_review_lines"] = _FACT_LINES.format(sentiment="sentiment_label", topic="primary_topic", reviews="first_reviews")

_NUMBERED = """
    SELECT row_number() OVER (ORDER BY {columns}) AS fact_id,
           * REPLACE (CAST(item_price_brl AS DOUBLE) AS item_price_brl, CAST(freight_cost_brl AS DOUBLE) AS freight_cost_brl,
                      CAST(total_amount_brl AS DOUBLE) AS total_amount_brl, CAST(exchange_rate_used AS DOUBLE) AS exchange_rate_used)
    FROM {lines}
"""
_FACT_ORDER = ", ".join(
    f"{c} NULLS FIRST"
    for c in (
        "order_id", "order_item_id", "customer_key", "product_key", "date_key", "status_code", "order_date",
        "delivered_date", "days_to_deliver", "delivered_on_time", "item_price_brl", "freight_cost_brl",
        "total_amount_brl", "item_price_usd", "freight_cost_usd", "total_amount_usd", "exchange_rate_used",
        "review_rating", "sentiment_label", "review_topic",
    )
)

RELATIONS["fact"] = _NUMBERED.format(columns=_FACT_ORDER, lines="fact_lines")

# Answers of every shape, see the query registry.
RELATIONS["answers"] = """
    SELECT event_id, event_id % 5 AS shape, CAST(event_id // 2 AS VARCHAR) AS review_id,
           CASE WHEN value > 20 THEN 'positive' ELSE 'negative' END AS sentiment_label,
           event_id % 100 / 100 AS annotation_confidence, 'other' AS primary_topic, false AS needs_human_review
    FROM events
"""
RELATIONS["last_answers"] = """
    SELECT review_id, sentiment_label, annotation_confidence, primary_topic, needs_human_review
    FROM answers WHERE shape IN (0, 1)
    QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY event_id DESC) = 1
"""

RELATIONS["stage_log"] = """
    SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS stage,
           CASE event_type WHEN 'error' THEN 'failed' ELSE 'success' END AS status, event_id AS rows_processed,
           value AS duration_seconds, props AS extra_metrics,
           CASE event_type WHEN 'error' THEN 'event ' || event_id END AS error_message, ts AS created_at
    FROM events
"""

RELATIONS["snapshots"] = """
    SELECT base_currency, target_currency, CAST(exchange_rate AS DOUBLE) AS exchange_rate,
           date_trunc('second', ts) AS rate_timestamp, ts AS fetched_at
    FROM (
        SELECT 'USD' AS base_currency, unnest(json_keys(props)) AS target_currency,
               unnest([json_extract_string(props, '$.' || k) for k in json_keys(props)]) AS exchange_rate, ts
        FROM events
        UNION ALL
        SELECT 'USD', upper(event_type), CAST(value AS VARCHAR), ts FROM events
    )
"""


def _check(table: str, check: str, passed: str, checked: str, violations: str, message: str, source: str) -> str:
    return (
        f"SELECT '{table}' AS \"table\", '{check}' AS \"check\", {passed} AS passed, CAST({checked} AS BIGINT) AS checked, "
        f"CAST({violations} AS BIGINT) AS violations, {message} AS message FROM {source}"
    )


def _no_nulls(table: str, column: str, source: str) -> str:
    bad = f"count(*) FILTER (WHERE {column} IS NULL)"
    message = f"CASE WHEN {bad} = 0 THEN 'no nulls in ''{column}''' ELSE format('{{:,}}', {bad}) || ' nulls in ''{column}''' END"
    return _check(table, f"{column} has no nulls", f"{bad} = 0", "count(*)", bad, message, source)


def _unique(table: str, column: str, source: str) -> str:
    bad = f"(count({column}) - count(DISTINCT {column}))"
    message = f"CASE WHEN {bad} = 0 THEN '''{column}'' is unique' ELSE format('{{:,}}', {bad}) || ' duplicate values in ''{column}''' END"
    return _check(table, f"{column} is unique", f"{bad} = 0", f"count({column})", bad, message, source)


def _between(table: str, column: str, low: int, high: int, mostly: float, source: str, name: str | None = None) -> str:
    value = f"CAST({column} AS DOUBLE)"
    bad = f"count(*) FILTER (WHERE {value} < {low} OR {value} > {high})"
    rate = f"{bad} / nullif(count({column}), 0)"
    passed = f"coalesce({rate} <= {1 - mostly!r}, true)"
    message = (
        f"CASE WHEN {passed} AND count({column}) = 0 THEN '''{column}'' holds no numbers to check' "
        f"WHEN {passed} THEN '''{column}'' is between {low} and {high}' "
        f"ELSE format('{{:,}}', {bad}) || ' values in ''{column}'' outside [{low}, {high}], ' "
        f"|| format('{{:.1f}}', 100 * ({rate})) || '% of the values' END"
    )
    return _check(table, name or f"{column} is between {low:,} and {high:,}", passed, f"count({column})", bad, message, source)


def _values_in(table: str, column: str, allowed: tuple, source: str, name: str | None = None) -> str:
    listed = ", ".join(repr(v) for v in allowed)
    outside = f"{column} NOT IN ({listed})"
    bad = f"count(*) FILTER (WHERE {outside})"
    sample = (
        f"(SELECT string_agg(CAST(v AS VARCHAR), ', ' ORDER BY v) FROM "
        f"(SELECT DISTINCT {column} AS v FROM {source} WHERE {outside} ORDER BY v LIMIT 5))"
    )
    message = (
        f"CASE WHEN {bad} = 0 THEN '''{column}'' holds only allowed values' "
        f"ELSE format('{{:,}}', {bad}) || ' values in ''{column}'' not allowed, such as: ' || {sample} END"
    )
    return _check(table, name or f"{column} only contains known values", f"{bad} = 0", f"count({column})", bad, message, source)


def _rows(table: str, low: int, high: int, source: str, name: str) -> str:
    passed = f"count(*) BETWEEN {low} AND {high}"
    message = (
        f"'row count ' || format('{{:,}}', count(*)) || CASE WHEN {passed} THEN ' is within' ELSE ' is outside' END "
        f"|| ' [{low:,}, {high:,}]'"
    )
    return _check(table, name, passed, "count(*)", "0", message, source)


_ORDERS_SUITE = [
    _no_nulls("orders", "order_id", "silver_orders"),
    _no_nulls("orders", "customer_key", "silver_orders"),
    _no_nulls("orders", "order_date", "silver_orders"),
    _values_in(
        "orders", "status_code",
        ("delivered", "shipped", "canceled", "unavailable", "invoiced", "processing", "created", "approved"), "silver_orders",
    ),
    _between("orders", "days_to_deliver", 0, 365, 0.99, "silver_orders"),
    _rows("orders", 50_000, 200_000, "silver_orders", "orders table has expected row count"),
    _unique("orders", "order_id", "silver_orders"),
]
_ITEMS_SUITE = [
    _no_nulls("order_items", "order_id", "silver_items"),
    _no_nulls("order_items", "product_key", "silver_items"),
    _between("order_items", "item_price_brl", 0, 10_000, 0.999, "silver_items"),
    _between("order_items", "freight_cost_brl", 0, 5_000, 0.999, "silver_items", "freight_cost_brl is not negative"),
    _between("order_items", "total_item_cost_brl", 0, 15_000, 0.999, "silver_items", "total_item_cost_brl is not negative"),
]
_REVIEWS_SUITE = [
    _no_nulls("reviews", "review_id", "silver_reviews"),
    _no_nulls("reviews", "order_id", "silver_reviews"),
    _values_in("reviews", "rating", (1, 2, 3, 4, 5), "silver_reviews", "rating is 1 to 5 only"),
    _between("reviews", "rating", 1, 5, 1.0, "silver_reviews"),
]

_ALL = " UNION ALL "
RELATIONS["all_checks"] = _ALL.join(_ORDERS_SUITE + _ITEMS_SUITE + _REVIEWS_SUITE)


def _with(statement: str) -> str:
    """Put the relations a statement uses, directly or through others, in front of it."""
    used: set[str] = set()

    def visit(text: str) -> None:
        for name in RELATIONS:
            if name not in used and re.search(rf"\b{name}\b", text):
                used.add(name)
                visit(RELATIONS[name])

    visit(statement)
    chain = ", ".join(f"{name} AS ({RELATIONS[name]})" for name in RELATIONS if name in used)
    return f"WITH {chain} {statement}" if chain else statement


def _oracle(name: str, statement: str) -> None:
    ORACLES[name] = _with(statement)


_ITEM_COLUMNS = (
    "* REPLACE (CAST(item_price_brl AS DOUBLE) AS item_price_brl, CAST(freight_cost_brl AS DOUBLE) AS freight_cost_brl, "
    "CAST(total_item_cost_brl AS DOUBLE) AS total_item_cost_brl)"
)

_oracle("csv_scan", "SELECT * FROM raw_lines")
_oracle(
    "csv_scan_text",
    """SELECT CAST(event_id AS VARCHAR) AS review_id, CAST(event_id // 3 * 4 AS VARCHAR) AS order_id,
              CAST(event_id % 5 + 1 AS INTEGER) AS review_score, md5(text) AS text_md5
       FROM events LEFT JOIN documents ON event_id = doc_id""",
)
_oracle("rate_snapshots", "SELECT * FROM snapshots")
_oracle(
    "rate_history_check",
    """SELECT count(*) AS total_rows, count(DISTINCT target_currency) AS currencies, min(fetched_at) AS first_fetch,
              max(fetched_at) AS latest_fetch FROM snapshots""",
)
_oracle(
    "rate_history_appended",
    """SELECT CAST(CAST(fetched_at AS DATE) AS TIMESTAMP) AS fetch_date, 2 * count(*) AS n, count(DISTINCT target_currency) AS currencies
       FROM snapshots GROUP BY 1""",
)
_oracle(
    "rate_feed",
    """SELECT base_currency, target_currency, count(*) AS n, min(CAST(exchange_rate AS DOUBLE)) AS lowest,
              max(CAST(exchange_rate AS DOUBLE)) AS highest, max(rate_timestamp) AS newest
       FROM snapshots GROUP BY 1, 2""",
)
_oracle(
    "rate_sample",
    """SELECT 'usd' AS base_currency, 'BRL' AS target_currency, value + 1 AS exchange_rate, ts AS rate_timestamp, ts AS fetched_at
       FROM events WHERE event_type = 'purchase'""",
)
_PROFILED = {
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    ],
}
_oracle(
    "table_profile",
    _ALL.join(
        f"SELECT {i} AS position, '{c}' AS \"column\", count(*) AS row_count, count(*) - count({c}) AS null_count FROM {table}"
        for table, columns in _PROFILED.items()
        for i, c in enumerate(columns)
    ),
)

_oracle(
    "dedup_lines",
    """SELECT * FROM raw_lines QUALIFY row_number() OVER (
           PARTITION BY order_id ORDER BY order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value) = 1""",
)
RELATIONS["first_lines"] = """
    SELECT order_id, seller_id
    FROM (SELECT * REPLACE (CASE WHEN seller_id <> '3' THEN seller_id END AS seller_id) FROM raw_lines)
    QUALIFY row_number() OVER (PARTITION BY order_id
        ORDER BY order_item_id, product_id, seller_id NULLS FIRST, shipping_limit_date, price, freight_value) = 1
"""
_oracle(
    "cleaning_losses",
    """SELECT (SELECT count(*) FROM raw_lines) AS rows_read, (SELECT count(*) FROM raw_lines) - count(*) AS duplicates_removed,
              count(*) - count(seller_id) AS nulls_dropped, count(seller_id) AS rows_kept
       FROM first_lines""",
)
_oracle("silver_orders", "SELECT * FROM silver_orders")
_oracle("silver_customers", "SELECT * FROM silver_customers")
_oracle("silver_order_items", f"SELECT {_ITEM_COLUMNS} FROM silver_items")
_oracle("silver_reviews", "SELECT *, CAST(NULL AS VARCHAR) AS sentiment_label FROM silver_reviews")
_oracle("silver_exchange_rates", "SELECT * REPLACE (CAST(rate AS DOUBLE) AS rate) FROM silver_rates")
_oracle(
    "silver_rejects",
    """SELECT (SELECT count(*) FROM part) + count(*) AS n, count(l_shipdate) AS parsed, max(l_shipdate) AS newest FROM lineitem""",
)
_oracle("mapped_orders", "SELECT * EXCLUDE (days_to_deliver, delivered_on_time) FROM silver_orders")

_SILVER_COLUMNS = {
    ("orders", "silver_orders"): [
        "order_id", "customer_key", "status_code", "order_date", "approved_date", "shipped_date", "delivered_date",
        "estimated_delivery_date", "days_to_deliver", "delivered_on_time",
    ],
    ("customers", "silver_customers"): ["customer_key", "customer_id", "city", "state_code", "zip_prefix"],
    ("order_items", "silver_items"): [
        "order_id", "order_item_id", "product_key", "seller_id", "shipping_deadline", "item_price_brl",
        "freight_cost_brl", "total_item_cost_brl",
    ],
    ("reviews", "silver_reviews"): ["review_id", "order_id", "rating", "review_text", "review_date"],
    ("exchange_rates", "silver_rates"): ["base_currency", "target_currency", "rate", "rate_timestamp", "captured_at"],
}
_oracle(
    "mapping_conformance",
    _ALL.join(
        f"SELECT '{table}' AS \"table\", '{c}' AS target_col, count(*) - count({c}) AS null_count, CAST(NULL AS VARCHAR) AS problem FROM {source}"
        for (table, source), columns in _SILVER_COLUMNS.items()
        for c in columns
    )
    + " UNION ALL SELECT 'reviews', 'sentiment_label', count(*), NULL FROM silver_reviews",
)

_oracle("quality_orders", _ALL.join(_ORDERS_SUITE))
_oracle("quality_order_items", _ALL.join(_ITEMS_SUITE))
_oracle("quality_reviews", _ALL.join(_REVIEWS_SUITE))
_oracle(
    "quality_failures",
    _ALL.join(
        [
            _unique("order_items", "order_id", "silver_items"),
            _values_in("order_items", "seller_id", ("1", "2", "3"), "silver_items"),
            _between("order_items", "freight_cost_brl", 5, 20, 0.5, "silver_items"),
            _rows("order_items", 1, 10, "silver_items", "table has expected row count"),
            "SELECT 'order_items', 'no_such_column has no nulls', false, NULL, NULL, 'column ''no_such_column'' not found'",
        ]
    ),
)
_oracle(
    "quality_summary",
    """SELECT "table", count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE NOT passed) AS failed,
              count(*) AS total, bool_and(passed) AS success FROM all_checks GROUP BY 1""",
)
_oracle(
    "quality_overall",
    """SELECT count(*) FILTER (WHERE passed) AS checks_passed, count(*) AS checks_total, bool_and(passed) AS success FROM all_checks""",
)
RELATIONS["product_dimension"] = """
    SELECT CAST(p_partkey AS VARCHAR) AS product_key, coalesce(p_type, 'unknown') AS category_name, p_size * 200 AS weight_grams,
           p_size AS length_cm, p_size + 1 AS height_cm, p_size + 2 AS width_cm,
           CASE WHEN p_size * 200 <= 500 THEN 'light' WHEN p_size * 200 <= 5000 THEN 'medium' ELSE 'heavy' END AS weight_category
    FROM part WHERE p_partkey IS NOT NULL
"""
_oracle(
    "quality_gold",
    _ALL.join(
        [
            _unique("dim_customer", "customer_key", "customer_dimension"),
            _no_nulls("dim_customer", "customer_key", "customer_dimension"),
            _unique("dim_product", "product_key", "product_dimension"),
            _no_nulls("dim_product", "product_key", "product_dimension"),
            _unique("dim_date", "date_key", "calendar"),
            _no_nulls("dim_date", "date_key", "calendar"),
            _unique("fact_orders", "fact_id", "fact"),
            _no_nulls("fact_orders", "fact_id", "fact"),
            _no_nulls("fact_orders", "customer_key", "fact"),
            _no_nulls("fact_orders", "date_key", "fact"),
            _no_nulls("fact_orders", "total_amount_usd", "fact"),
        ]
    ),
)

_oracle("churn_labels", "SELECT * FROM labels_by_customer")
_oracle("order_features", "SELECT * FROM orders_by_customer")
_oracle("spend_features", "SELECT * FROM spend_by_customer")
_oracle("review_features", "SELECT * FROM reviews_by_customer")
_oracle("primary_payment", "SELECT * FROM payment_by_customer")
_oracle("customer_location", "SELECT DISTINCT customer_key, state_code FROM silver_customers")
_oracle(
    "category_codes",
    "SELECT p_brand, CAST(row_number() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT p_brand FROM part)",
)
_oracle(
    "long_category_codes",
    "SELECT c_name, CAST(row_number() OVER (ORDER BY c_name) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT c_name FROM customer)",
)
_oracle("delivery_median", "SELECT median_days FROM middle_days")
_oracle(
    "feature_store",
    """SELECT customer_key, churned, days_since_last_order, customer_lifetime_days, total_orders,
              coalesce(avg_days_to_deliver, median_days) AS avg_days_to_deliver, late_delivery_count, late_delivery_rate,
              coalesce(total_spend, 0) AS total_spend, coalesce(avg_order_value, 0) AS avg_order_value,
              coalesce(avg_rating, 3.0) AS avg_rating, coalesce(review_count, 0) AS review_count,
              primary_payment_type, state_code,
              CAST(CASE WHEN primary_payment_type IS NULL THEN -1
                   ELSE dense_rank() OVER (ORDER BY primary_payment_type NULLS LAST) - 1 END AS INTEGER) AS payment_type_encoded,
              CAST(CASE WHEN state_code IS NULL THEN -1
                   ELSE dense_rank() OVER (ORDER BY state_code NULLS LAST) - 1 END AS INTEGER) AS state_encoded
       FROM assembled CROSS JOIN middle_days""",
)

_oracle(
    "training_split",
    """SELECT customer_key, churned,
              row_number() OVER (PARTITION BY churned ORDER BY h, customer_key)
                  <= round(0.2 * count(*) OVER (PARTITION BY churned)) AS is_test
       FROM (SELECT customer_key, churned, CAST('0x' || left(md5(customer_key || '#42'), 8) AS BIGINT) AS h FROM labels_by_customer)""",
)
_oracle(
    "class_weights",
    """SELECT churned, count(*) AS n_class, sum(count(*)) OVER () / (2 * count(*)) AS weight FROM labels_by_customer GROUP BY churned""",
)
_oracle("risk_tiers", "SELECT * FROM churn_score_table")
_oracle(
    "risk_distribution",
    """SELECT * FROM (SELECT churn_risk, count(*) AS customers, count(*) / sum(count(*)) OVER () AS share
       FROM churn_score_table GROUP BY churn_risk) WHERE churn_risk IS NOT NULL""",
)
_oracle("model_accuracy", "SELECT avg(CAST(churned = predicted AS INTEGER)) AS accuracy FROM scored")
_oracle(
    "model_auc",
    """SELECT count(*) AS n,
              round((sum(r) FILTER (WHERE churned = 1) - count(*) FILTER (WHERE churned = 1) * (count(*) FILTER (WHERE churned = 1) + 1) / 2)
                  / (count(*) FILTER (WHERE churned = 1) * count(*) FILTER (WHERE churned = 0)), 9) AS auc_roc
       FROM (SELECT churned, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2 AS r FROM scored)""",
)
RELATIONS["per_class"] = """
    SELECT c, tp / nullif(tp + fp, 0) AS precision, tp / nullif(tp + fn, 0) AS recall,
           2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)) AS f1_score, tp + fn AS support
    FROM (
        SELECT c, count(*) FILTER (WHERE churned = c AND predicted = c) AS tp, count(*) FILTER (WHERE churned <> c AND predicted = c) AS fp,
               count(*) FILTER (WHERE churned = c AND predicted <> c) AS fn
        FROM scored CROSS JOIN (VALUES (0), (1)) classes(c) GROUP BY c
    )
"""
_oracle(
    "class_report",
    """SELECT CASE c WHEN 0 THEN 'Active' ELSE 'Churned' END AS class, coalesce(precision, 0) AS precision,
              coalesce(recall, 0) AS recall, coalesce(f1_score, 0) AS f1_score, support FROM per_class
       UNION ALL SELECT 'accuracy', NULL, NULL, avg(CAST(churned = predicted AS INTEGER)), count(*) FROM scored
       UNION ALL SELECT 'macro avg', sum(precision) / 2, sum(recall) / 2, sum(f1_score) / 2, sum(support)::BIGINT FROM per_class
       UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
              sum(f1_score * support) / sum(support), sum(support)::BIGINT FROM per_class""",
)

_oracle("stg_orders", "SELECT * FROM silver_orders WHERE order_date IS NOT NULL")
_oracle("stg_customers", "SELECT * FROM silver_customers")
_oracle("stg_order_items", f"SELECT {_ITEM_COLUMNS} FROM silver_items")
_oracle(
    "stg_reviews",
    """SELECT review_id, order_id, rating, review_text, review_date, sentiment_label, annotation_confidence, primary_topic
       FROM silver_reviews LEFT JOIN annotated USING (review_id)""",
)
_oracle("stg_products", "SELECT * EXCLUDE (weight_category) FROM product_dimension")
_oracle(
    "stg_exchange_rates",
    "SELECT CAST(brl_per_usd AS DOUBLE) AS brl_per_usd, 1.0 / CAST(brl_per_usd AS DOUBLE) AS usd_per_brl, rate_date FROM brl_rate",
)
_oracle(
    "stg_churn_scores",
    "SELECT customer_key, churn_score, churn_risk, coalesce(predicted_churn = 1, false) AS predicted_churn FROM churn_score_table",
)
_oracle("dim_customer", "SELECT * FROM customer_dimension")
_oracle("dim_product", "SELECT * FROM product_dimension")
_oracle("dim_date", "SELECT * FROM calendar")
_FIRST, _LAST = "TIMESTAMP '2016-01-01'", "TIMESTAMP '2019-12-31'"
_oracle("dim_date_fixed", _CALENDAR.format(first=_FIRST, last=_LAST, source="(SELECT 1)"))
_oracle("dim_date_built", _CALENDAR.format(first=f"least(first_day, {_FIRST})", last=f"greatest(last_day, {_LAST})", source="order_span"))
_oracle("fact_orders", "SELECT * FROM fact")
_oracle("fact_orders_one_review", _NUMBERED.format(columns=_FACT_ORDER, lines="single_review_lines"))
_oracle(
    "fact_lines_salted",
    """SELECT status_code, count(*) AS n, CAST(sum(total_amount_brl) AS DOUBLE) AS brl, CAST(sum(review_rating) AS BIGINT) AS stars
       FROM fact_lines GROUP BY status_code""",
)

_oracle(
    "annotation_queue",
    """SELECT review_id, order_id, rating, CAST(length(review_text) AS INTEGER) AS chars FROM silver_reviews
       WHERE review_text IS NOT NULL ORDER BY review_id LIMIT 500""",
)


def _prompt_sql() -> str:
    from ..operators.annotate import INSTRUCTIONS

    head = INSTRUCTIONS.replace("'", "''")
    return f"""
        SELECT batch_id, CAST(count(*) AS INTEGER) AS batch_size,
               md5('{head}' || string_agg(chr(10) || 'Review ' || place || ':' || chr(10) || '  review_id: ' || review_id || chr(10)
                   || '  rating: ' || rating || chr(10) || '  text: ' || review_text || chr(10), '' ORDER BY place)) AS prompt_md5
        FROM (
            SELECT *, (nth - 1) // 10 AS batch_id, (nth - 1) % 10 + 1 AS place
            FROM (SELECT *, row_number() OVER (ORDER BY review_id) AS nth FROM silver_reviews WHERE review_text IS NOT NULL)
        )
        GROUP BY batch_id"""


_oracle("annotation_prompts", _prompt_sql())
_oracle(
    "annotation_resumed",
    f"""SELECT batch_id, batch_size, CAST(CASE WHEN prompt_md5 < '8' THEN 2 ELSE 1 END AS INTEGER) AS attempts, prompt_md5 >= '4' AS answered
        FROM ({_prompt_sql()})""",
)
_oracle(
    "annotation_dead_letters",
    f"""SELECT batch_id, batch_size, CAST(2 AS INTEGER) AS attempts, 'RuntimeError: refused' AS error
        FROM ({_prompt_sql()}) WHERE prompt_md5 < '4'""",
)
_oracle("annotation_results", "SELECT * FROM annotated")
_oracle(
    "parsed_responses",
    """SELECT event_id AS batch_id, review_id, sentiment_label, annotation_confidence, primary_topic, needs_human_review
       FROM answers WHERE shape IN (0, 1)""",
)
_oracle(
    "response_problems",
    """SELECT CASE shape WHEN 3 THEN 'response is not JSON' END AS error, CASE shape WHEN 2 THEN 'response holds no list' END AS warning,
              count(*) AS n FROM answers GROUP BY 1, 2""",
)
_UPSERTED = "SELECT * FROM last_answers UNION ALL SELECT * FROM annotated WHERE review_id NOT IN (SELECT review_id FROM last_answers)"
_oracle("annotation_state", _UPSERTED)
_oracle("annotation_upsert", _UPSERTED)
_oracle(
    "annotation_summary",
    """SELECT CAST(count(*) AS BIGINT) AS reviews_processed, count(*) FILTER (WHERE shape = 3) AS batches_with_errors,
              count(*) FILTER (WHERE shape = 2) AS batches_without_list, count(*) FILTER (WHERE shape IN (0, 1)) AS annotations_saved,
              count(*) FILTER (WHERE shape IN (0, 1) AND review_id IN (SELECT review_id FROM annotated)) AS matched,
              count(*) FILTER (WHERE shape IN (0, 1) AND review_id NOT IN (SELECT review_id FROM annotated)) AS unmatched,
              count(*) FILTER (WHERE shape IN (0, 1)) / count(*) AS success_rate
       FROM answers""",
)
_oracle(
    "annotation_checks",
    _ALL.join(
        [
            _no_nulls("annotations", "review_id", "last_answers"),
            _values_in("annotations", "sentiment_label", ("positive", "neutral", "negative"), "last_answers"),
            _values_in(
                "annotations", "primary_topic",
                ("delivery", "product_quality", "pricing", "customer_service", "packaging", "other"), "last_answers",
            ),
            _between("annotations", "annotation_confidence", 0, 1, 1.0, "last_answers"),
        ]
    ),
)
_oracle(
    "top_annotations",
    """SELECT rating, sentiment_label, annotation_confidence, primary_topic, left(review_text, 80) AS preview
       FROM silver_reviews JOIN annotated USING (review_id) ORDER BY annotation_confidence DESC NULLS FIRST, review_id LIMIT 10""",
)

_oracle(
    "recent_runs",
    """SELECT run_id, stage, status, rows_processed, round(duration_seconds, 1) AS duration_s, extra_metrics, error_message, created_at
       FROM stage_log ORDER BY created_at DESC NULLS FIRST, run_id, stage LIMIT 10""",
)
RELATIONS["runs"] = """
    SELECT run_id, min(created_at) AS run_start, max(created_at) AS run_end, count(*) AS total_stages,
           count(*) FILTER (WHERE status = 'success') AS passed, count(*) FILTER (WHERE status = 'failed') AS failed,
           CAST(sum(rows_processed) AS BIGINT) AS total_rows,
           CAST(round(sum(CAST(duration_seconds AS DECIMAL(18,6))), 1) AS DOUBLE) AS total_duration_s
    FROM stage_log GROUP BY run_id
"""
_oracle("run_summary", "SELECT * FROM runs")
_oracle("latest_runs", "SELECT * FROM runs ORDER BY run_start DESC NULLS FIRST, run_id LIMIT 5")
_oracle(
    "layer_health",
    """SELECT 'bronze.raw_orders' AS "table", count(*) AS row_count, 'ok' AS status, CAST(NULL AS TIMESTAMP) AS newest FROM orders
       UNION ALL SELECT 'silver.orders', count(*), 'ok', max(order_date) FROM silver_orders
       UNION ALL SELECT 'silver.empty', count(*), 'empty', NULL FROM silver_items WHERE item_price_brl < 0
       UNION ALL SELECT 'gold.none', 0, 'missing', NULL""",
)
_oracle(
    "run_model_summary",
    """SELECT run_id, status, rows_processed % 100 / 100 AS auc_roc, CAST(0.5 AS DOUBLE) AS accuracy FROM stage_log
       WHERE run_id = '7' AND stage = 'view'""",
)

_oracle("churn_scores", "SELECT customer_key, churned AS actual_churned, true AS is_probability, true AS tier_agrees, true AS class_agrees FROM labels_by_customer")
_oracle(
    "churn_evaluation",
    """SELECT sum(n)::BIGINT AS customers, sum(CAST(round(0.2 * n) AS BIGINT))::BIGINT AS held_out, true AS high_accuracy, true AS high_auc_roc
       FROM (SELECT count(*) AS n FROM labels_by_customer GROUP BY churned)""",
)
_oracle("feature_importance", "SELECT 'days_since_last_order' AS first_feature, count(*) AS inputs, 1.0::DOUBLE AS total FROM range(11)")
_oracle("model_saved_and_loaded", "SELECT count(*) AS customers FROM labels_by_customer")
_oracle(
    "rate_rejects",
    """SELECT CASE event_id % 7 WHEN 3 THEN 'BRL' WHEN 5 THEN 'BRL' END AS target_currency,
              CASE event_id % 7 WHEN 1 THEN 'not JSON' WHEN 2 THEN 'no rates' WHEN 3 THEN 'rate is not a number: much'
                   WHEN 4 THEN 'no timestamp' WHEN 5 THEN 'rate is not a number: null' ELSE 'no payload' END AS reason, count(*) AS n
       FROM events WHERE event_id % 7 <> 0 GROUP BY ALL""",
)
_oracle(
    "rates_read_in_spite",
    """SELECT target_currency, count(*) AS n, sum(rate) AS total
       FROM (SELECT 'BRL' AS target_currency, CASE WHEN event_id % 7 = 0 THEN event_id END::DOUBLE AS rate FROM events WHERE event_id % 7 IN (0, 3, 5)
             UNION ALL SELECT 'EUR', 0.5 FROM events WHERE event_id % 7 = 3
             UNION ALL SELECT 'JPY', 150 FROM events WHERE event_id % 7 = 5)
       GROUP BY 1""",
)
_oracle(
    "csv_rejects",
    """SELECT l_orderkey || ',' || l_linenumber || ',a,b' AS line, count(*) AS n FROM lineitem WHERE l_orderkey % 7 = 0 GROUP BY 1""",
)
_oracle(
    "csv_read_in_spite",
    """SELECT CASE WHEN l_orderkey % 5 <> 0 THEN 'a' END AS comment, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS orders
       FROM lineitem WHERE l_orderkey % 7 <> 0 GROUP BY 1""",
)
_oracle(
    "response_trailing_text",
    """SELECT CASE WHEN event_id % 5 < 4 THEN 'response is not JSON' END AS error, count(*) AS n,
              CAST(sum(CASE WHEN event_id % 5 = 4 THEN 1 ELSE 0 END) AS BIGINT) AS items FROM events GROUP BY 1""",
)
_TABLE_COUNTS = (
    ("raw_orders", "orders"), ("raw_customers", "customer"), ("raw_order_items", "lineitem"),
    ("raw_products", "part"), ("raw_reviews", "events"), ("raw_payments", "orders"),
)
_oracle(
    "csv_tables_loaded",
    " UNION ALL ".join(f"SELECT '{name}' AS \"table\", count(*) AS loaded, count(*) AS stored FROM {source}" for name, source in _TABLE_COUNTS)
    + " UNION ALL SELECT 'raw_nothing', NULL, NULL",
)
_STATUS = "SELECT '{name}' AS \"table\", 'success' AS status, ({rows}) AS rows, ({read}) AS rows_read, ({removed}) AS duplicates_removed, ({dropped}) AS nulls_dropped"
_oracle(
    "silver_build_status",
    " UNION ALL ".join(
        _STATUS.format(name=name, rows=rows, read=read, removed=removed, dropped=dropped)
        for name, rows, read, removed, dropped in (
            ("orders", "SELECT count(*) FROM silver_orders", "SELECT count(*) FROM orders", "SELECT count(*) - count(DISTINCT o_orderkey) FROM orders", "SELECT 0"),
            ("customers", "SELECT count(*) FROM silver_customers", "SELECT 2 * count(*) FROM customer", "SELECT count(*) FROM customer", "SELECT 0"),
            ("order_items", "SELECT count(*) FROM silver_items", "SELECT count(*) FROM lineitem", "SELECT 0", "SELECT 0"),
            ("reviews", "SELECT count(*) FROM silver_reviews WHERE CAST(review_id AS BIGINT) % 5 <> 0", "SELECT count(*) FROM events", "SELECT 0",
             "SELECT count(*) FROM silver_reviews WHERE CAST(review_id AS BIGINT) % 5 = 0"),
            ("exchange_rates", "SELECT count(*) FROM silver_rates", "SELECT count(*) FROM events", "SELECT 0", "SELECT 0"),
        )
    ).replace("SELECT 0)", "SELECT 0::BIGINT)"),
)
_oracle(
    "quality_gate",
    """SELECT count(*) FILTER (WHERE passed) AS checks_passed, count(*) AS checks_total, NOT bool_and(passed) AS stopped FROM all_checks""",
)
_oracle(
    "layer_tables",
    """SELECT 'feature_store' AS name, count(*) AS n, sum(total_orders)::BIGINT AS total FROM labels_by_customer
       UNION ALL SELECT 'churn_scores', count(*), sum(actual_churned)::BIGINT FROM churn_score_table
       UNION ALL SELECT 'tiered_scores', count(*), sum(predicted_churn)::BIGINT FROM churn_score_table WHERE churn_risk IS NOT NULL
       UNION ALL SELECT 'sample', 3, 0""",
)
_oracle("annotations_waiting", "SELECT review_id, rating FROM silver_reviews WHERE review_text IS NOT NULL AND CAST(review_id AS BIGINT) % 2 = 1")
_oracle(
    "metrics_recorded",
    """SELECT 'count_orders' AS stage, 'success' AS status, count(*) AS rows_processed, true AS timed, NULL::BOOLEAN AS told FROM orders
       UNION ALL SELECT 'count_parts', 'failed', count(*), true, true FROM part
       UNION ALL SELECT 'note', 'success', count(*), true, NULL FROM nation""",
)
_oracle(
    "whole_run",
    """SELECT stage, 'success' AS status, n AS rows_processed FROM (
           SELECT 'ingestion_csv' AS stage, (SELECT 2 * count(*) FROM orders) + (SELECT count(*) FROM customer) + (SELECT count(*) FROM lineitem)
                  + (SELECT count(*) FROM part) + (SELECT count(*) FROM events) AS n
           UNION ALL SELECT 'ingestion_api', 2
           UNION ALL SELECT 'spark_etl', (SELECT count(*) FROM silver_orders) + (SELECT count(*) FROM silver_customers)
                  + (SELECT count(*) FROM silver_items) + (SELECT count(*) FROM silver_reviews) + 2
           UNION ALL SELECT 'data_quality', 3
           UNION ALL SELECT 'feature_engineering', (SELECT count(*) FROM labels_by_customer)
           UNION ALL SELECT 'churn_model', (SELECT count(*) FROM labels_by_customer)
           UNION ALL SELECT 'restore_annotation_columns', 0
           UNION ALL SELECT 'gold_layer', (SELECT count(*) FROM silver_items JOIN silver_orders USING (order_id) LEFT JOIN silver_reviews USING (order_id)))""",
)
_oracle(
    "table_refreshed",
    "SELECT l_returnflag, count(*) AS n, sum(CAST(l_quantity AS DOUBLE)) AS pieces FROM lineitem WHERE l_quantity >= 2 GROUP BY l_returnflag",
)
