"""DuckDB statements for the registered queries, over the same sample tables."""

_SILVER = """
raw_customers AS (
    SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
           CAST(CASE WHEN c_custkey % 5 = 4 THEN c_custkey - 1 ELSE c_custkey END AS VARCHAR) AS customer_unique_id,
           CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 10000 + c_custkey % 90000 END AS zip,
           c_mktsegment AS customer_city, n_name AS customer_state, c_custkey < 15 AS copied
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
),
customers AS (
    SELECT DISTINCT customer_id, customer_unique_id, CAST(COALESCE(zip, 0) AS INTEGER) AS customer_zip_code_prefix,
           customer_city, customer_state
    FROM (SELECT * FROM raw_customers UNION ALL SELECT * FROM raw_customers WHERE copied)
),
products AS (
    SELECT CAST(p_partkey AS VARCHAR) AS product_id,
           CASE WHEN p_partkey % 50 = 0 THEN 'unlabeled' ELSE p_type END AS product_category_name,
           CAST(p_size * 100 AS INTEGER) AS product_weight_g, CAST(p_size + 10 AS INTEGER) AS product_length_cm,
           CAST(p_size + 5 AS INTEGER) AS product_height_cm, CAST(p_size + 10 AS INTEGER) AS product_width_cm
    FROM part
),
bought AS (
    SELECT o_orderkey AS k, o_custkey,
           CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' WHEN 'P' THEN 'canceled' END AS status,
           o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS bought_at
    FROM orders
),
promised AS (
    SELECT *, bought_at + to_days(CAST(10 + k % 11 AS INTEGER)) AS estimated FROM bought
),
raw_orders AS (
    SELECT CAST(k AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id, status AS order_status,
           bought_at AS order_purchase_timestamp,
           CASE WHEN status <> 'canceled' THEN bought_at + to_minutes(CAST(5 + k % 176 AS INTEGER)) END AS order_approved_at,
           CASE WHEN status IN ('delivered', 'shipped')
                THEN bought_at + to_days(CAST(1 + k % 3 AS INTEGER)) END AS order_delivered_carrier_date,
           CASE WHEN status = 'delivered'
                THEN estimated + to_days(CAST(k * 7 % 23 % 14 - 5 AS INTEGER)) + to_hours(CAST(k % 7 AS INTEGER))
                END AS order_delivered_customer_date,
           estimated AS order_estimated_delivery_date, k < 25 AS copied
    FROM promised
),
one_order AS (
    SELECT DISTINCT * EXCLUDE (copied)
    FROM (SELECT * FROM raw_orders UNION ALL SELECT * FROM raw_orders WHERE copied)
),
clean_orders AS (
    SELECT *,
           date_diff('microsecond', order_purchase_timestamp, order_delivered_customer_date) / 8.64e10
               AS actual_delivery_days,
           date_diff('microsecond', order_purchase_timestamp, order_estimated_delivery_date) / 8.64e10
               AS estimated_delivery_days,
           CASE WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 1 ELSE 0 END AS is_delayed,
           CAST(year(order_purchase_timestamp) AS INTEGER) AS order_year,
           CAST(month(order_purchase_timestamp) AS INTEGER) AS order_month
    FROM one_order
),
raw_items AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
           CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
           l_shipdate AS shipping_limit_date, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
           CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS freight_value
    FROM lineitem
),
items AS (SELECT * FROM raw_items),
raw_payments AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS order_id, 1 AS payment_sequential, o_orderpriority AS payment_type,
           CAST(1 + o_orderkey % 10 AS INTEGER) AS payment_installments,
           CAST(CASE WHEN o_orderkey % 997 = 0 THEN -50
                     WHEN o_orderkey % 991 = 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) * 25
                     ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS payment_value
    FROM orders WHERE o_orderstatus <> 'P'
),
payments AS (SELECT * FROM raw_payments WHERE payment_value >= 0),
paid AS (SELECT order_id, SUM(payment_value) AS order_payment FROM payments GROUP BY order_id)
"""

_GOLD = """,
dim_customers AS (
    SELECT *, row_number() OVER (ORDER BY customer_id) AS customer_key FROM customers
),
dim_products AS (
    SELECT *, CAST(product_length_cm AS BIGINT) * product_height_cm * product_width_cm AS product_volume_cm3,
           row_number() OVER (ORDER BY product_id) AS product_key
    FROM products
),
goods AS (
    SELECT order_id, COUNT(*) AS line_count, SUM(price + freight_value) AS goods_value FROM items GROUP BY order_id
),
lines AS (
    SELECT o.*, i.* EXCLUDE (order_id), g.line_count, g.goods_value, p.order_payment,
           CAST(COALESCE(p.order_payment, i.price + i.freight_value) AS DECIMAL(18,2)) AS payment_value,
           CAST(COALESCE(CAST(p.order_payment AS DOUBLE) * CAST(i.price + i.freight_value AS DOUBLE)
                             / CAST(g.goods_value AS DOUBLE),
                         CAST(i.price + i.freight_value AS DOUBLE)) AS DOUBLE) AS payment_allocated,
           CAST(year(order_purchase_timestamp) * 10000 + month(order_purchase_timestamp) * 100
                + day(order_purchase_timestamp) AS INTEGER) AS date_key
    FROM clean_orders o JOIN items i USING (order_id) JOIN goods g USING (order_id) LEFT JOIN paid p USING (order_id)
),
star AS (
    SELECT l.*, c.customer_state, c.customer_city, c.customer_key, d.product_category_name, d.product_key
    FROM lines l LEFT JOIN dim_customers c USING (customer_id) LEFT JOIN dim_products d USING (product_id)
)
"""

_RFM = """,
person AS (
    SELECT c.customer_unique_id, MAX(o.order_purchase_timestamp) AS last_purchase,
           CAST(COUNT(DISTINCT o.order_id) AS BIGINT) AS frequency_orders, SUM(p.order_payment) AS spend
    FROM clean_orders o JOIN customers c USING (customer_id) LEFT JOIN paid p USING (order_id)
    GROUP BY c.customer_unique_id
),
base AS (
    SELECT customer_unique_id,
           CAST(floor(date_diff('microsecond', last_purchase,
               (SELECT MAX(order_purchase_timestamp) + INTERVAL 1 DAY FROM clean_orders)) / 8.64e10) AS INTEGER)
               AS recency_days,
           frequency_orders, CAST(COALESCE(spend, 0) AS DOUBLE) AS monetary_spend
    FROM person
),
placed AS (
    SELECT *, COUNT(*) OVER () AS n,
           row_number() OVER (ORDER BY frequency_orders, customer_unique_id) AS f_place,
           row_number() OVER (ORDER BY monetary_spend, customer_unique_id) AS m_place
    FROM base
),
cuts AS (
    SELECT quantile_cont(CAST(recency_days AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(recency_days AS DOUBLE), 0.5) AS q2,
           quantile_cont(CAST(recency_days AS DOUBLE), 0.75) AS q3
    FROM base
),
scored AS (
    SELECT customer_unique_id, recency_days, frequency_orders, monetary_spend,
           CASE WHEN recency_days <= q1 THEN 4 WHEN recency_days <= q2 THEN 3 WHEN recency_days <= q3 THEN 2 ELSE 1 END
               AS r_score,
           CAST(greatest(1, (4 * (f_place - 1) + n - 2) // (n - 1)) AS INTEGER) AS f_score,
           CAST(greatest(1, (4 * (m_place - 1) + n - 2) // (n - 1)) AS INTEGER) AS m_score
    FROM placed, cuts
),
features AS (
    SELECT *, CAST(r_score AS VARCHAR) || f_score || m_score AS rfm_combined_score,
           CASE WHEN r_score >= 3 THEN
                    CASE WHEN f_score >= 3 AND m_score >= 3 THEN 'Champions'
                         WHEN f_score >= 2 THEN 'Loyal Customers' ELSE 'Recent Customers' END
                WHEN f_score >= 3 THEN 'At Risk' ELSE 'Hibernating' END AS customer_segment
    FROM scored
)
"""


def _monthly(revenue, per, previous, with_average=True):
    average = "ROUND(CAST(revenue AS DOUBLE) / units, 2) AS avg_order_value," if with_average else ""
    return f"""
    , monthly AS (
        SELECT order_year, order_month, COUNT(DISTINCT order_id) AS total_orders,
               {revenue} AS revenue, {per} AS units
        FROM lines WHERE order_status <> 'canceled' GROUP BY order_year, order_month
    ), lagged AS (
        SELECT *, {previous} AS base, LAG({previous}) OVER (ORDER BY order_year, order_month) AS previous FROM monthly
    )
    SELECT order_year, order_month, total_orders, ROUND(CAST(revenue AS DOUBLE), 2) AS total_revenue, {average}
           ROUND(previous, 2) AS prev_month_revenue,
           ROUND((base - previous) / nullif(previous, 0) * 100, 2) AS mom_growth_pct
    FROM lagged
    """


_ROUNDED = "ROUND(CAST(revenue AS DOUBLE), 2)"
_PLAIN = "CAST(revenue AS DOUBLE)"

_ORDER_ONCE = """(SELECT DISTINCT ON (order_id) * FROM lines)"""

_SLA = """
    SELECT customer_state, CAST(COUNT(order_id) AS BIGINT) AS total_deliveries,
           ROUND(CAST(SUM(CAST(ROUND(actual_delivery_days * 8.64e10) AS BIGINT)) AS DOUBLE)
                 / COUNT(actual_delivery_days) / 8.64e10, 1) AS avg_delivery_days,
           CAST(SUM(is_delayed) AS BIGINT) AS delayed_orders,
           ROUND(CAST(SUM(is_delayed) AS DOUBLE) / COUNT(order_id) * 100, 2) AS delay_pct,
           ROUND(CAST(SUM(freight_value) AS DOUBLE) / COUNT(order_id), 2) AS avg_freight
    FROM star WHERE order_status = 'delivered'
    GROUP BY customer_state HAVING COUNT(order_id) >= 20
"""


def _gmv(where):
    return f"""
    SELECT order_year, order_month, CAST(SUM(payment_value) AS DOUBLE) AS payment_value,
           order_year || '-' || lpad(CAST(order_month AS VARCHAR), 2, '0') AS period
    FROM lines {where} GROUP BY order_year, order_month
    """


def _kpis(where, scope):
    return f"""
    SELECT CAST(SUM(payment_value) AS DOUBLE) AS gmv, COUNT(DISTINCT order_id) AS total_orders,
           CAST(SUM(payment_value) AS DOUBLE) / COUNT(DISTINCT order_id) AS aov,
           (1 - CAST(SUM(is_delayed) FILTER (order_status = 'delivered') AS DOUBLE)
                / COUNT(*) FILTER (order_status = 'delivered')) * 100 AS on_time_pct,
           CAST(SUM(is_delayed) AS BIGINT) AS delayed_lines,
           1 - CAST(SUM(is_delayed) AS DOUBLE) / COUNT(DISTINCT order_id) AS on_time_rate_per_order,
           (1 - CAST(COUNT(DISTINCT order_id) FILTER (is_delayed = 1) AS DOUBLE) / COUNT(DISTINCT order_id)) * 100
               AS on_time_pct_orders
    FROM {scope} {where}
    """


def _ntile(r_order, f_order, m_order):
    return f"""
    , dated AS (
        SELECT customer_unique_id, frequency_orders, CAST(spend AS DOUBLE) AS monetary_spend,
               CAST(date_diff('day', CAST(last_purchase AS DATE),
                    (SELECT CAST(MAX(order_purchase_timestamp) AS DATE) + 1 FROM clean_orders)) AS INTEGER)
                   AS recency_days
        FROM person
    ), tiled AS (
        SELECT *, CAST(NTILE(4) OVER (ORDER BY recency_days {r_order}, customer_unique_id) AS INTEGER) AS r_score,
               CAST(NTILE(4) OVER (ORDER BY frequency_orders {f_order}, customer_unique_id) AS INTEGER) AS f_score,
               CAST(NTILE(4) OVER (ORDER BY monetary_spend {m_order}, customer_unique_id) AS INTEGER) AS m_score
        FROM dated
    )
    SELECT *, CAST(r_score AS VARCHAR) || f_score || m_score AS rfm_score,
           CASE WHEN r_score <= 2 THEN 'At Risk' WHEN f_score >= 3 THEN 'Champions'
                WHEN f_score = 2 THEN 'Loyal Customers' ELSE 'Standard' END AS segment
    FROM tiled
    """


_BOUNDS = """
    , quartiles AS (
        SELECT quantile_cont(CAST(payment_value AS DOUBLE), 0.25) AS q1,
               quantile_cont(CAST(payment_value AS DOUBLE), 0.75) AS q3 FROM payments
    ), bounds AS (
        SELECT q1, q3, greatest(0.0::DOUBLE, q1 - 1.5::DOUBLE * (q3 - q1)) AS low,
               q3 + 1.5::DOUBLE * (q3 - q1) AS high FROM quartiles
    )
"""

_NULL_TEST = "'Primary Key Null Rate (order_id)'"
_UNIQUE_TEST = "'Order ID Uniqueness'"
_OUTLIER_TEST = "'Payment Value Statistical Outlier Profile (IQR)'"
_SLA_TEST = "'Delivery SLA Statistical Distribution'"

_QUALITY = _BOUNDS + f"""
    , o AS (
        SELECT COUNT(*) AS total, COUNT(*) - COUNT(order_id) AS nulls, COUNT(DISTINCT order_id) AS ids,
               CAST(SUM(CAST(ROUND(actual_delivery_days * 8.64e10) AS BIGINT)) AS DOUBLE)
                   / COUNT(actual_delivery_days) / 8.64e10 AS mean_days,
               stddev_samp(actual_delivery_days) AS std, quantile_cont(actual_delivery_days, 0.95) AS p95,
               SUM(is_delayed) AS delayed
        FROM clean_orders
    ), p AS (
        SELECT COUNT(*) AS total, COUNT(*) FILTER (CAST(payment_value AS DOUBLE) < low
                                                   OR CAST(payment_value AS DOUBLE) > high) AS outliers
        FROM payments, bounds
    )
    SELECT {_NULL_TEST} AS test, 'null_count' AS metric, CAST(nulls AS DOUBLE) AS value, nulls = 0 AS passed FROM o
    UNION ALL SELECT {_NULL_TEST}, 'null_rate', CAST(nulls AS DOUBLE) / total, nulls = 0 FROM o
    UNION ALL SELECT {_UNIQUE_TEST}, 'total_records', CAST(total AS DOUBLE), ids = total FROM o
    UNION ALL SELECT {_UNIQUE_TEST}, 'unique_records', CAST(ids AS DOUBLE), ids = total FROM o
    UNION ALL SELECT {_SLA_TEST}, 'mean_delivery_days', ROUND(mean_days, 2), mean_days < 25 FROM o
    UNION ALL SELECT {_SLA_TEST}, 'std_dev_delivery_days', ROUND(std, 2), mean_days < 25 FROM o
    UNION ALL SELECT {_SLA_TEST}, 'p95_delivery_days', ROUND(p95, 2), mean_days < 25 FROM o
    UNION ALL SELECT {_SLA_TEST}, 'delayed_orders_count', CAST(delayed AS DOUBLE), mean_days < 25 FROM o
    UNION ALL SELECT {_SLA_TEST}, 'delayed_orders_rate', CAST(delayed AS DOUBLE) / total, mean_days < 25 FROM o
    UNION ALL SELECT {_OUTLIER_TEST}, 'q1_25th_percentile', ROUND(q1, 2), true FROM bounds
    UNION ALL SELECT {_OUTLIER_TEST}, 'q3_75th_percentile', ROUND(q3, 2), true FROM bounds
    UNION ALL SELECT {_OUTLIER_TEST}, 'iqr', ROUND(q3 - q1, 2), true FROM bounds
    UNION ALL SELECT {_OUTLIER_TEST}, 'statistical_upper_bound', ROUND(high, 2), true FROM bounds
    UNION ALL SELECT {_OUTLIER_TEST}, 'outlier_count', CAST(outliers AS DOUBLE), true FROM p
    UNION ALL SELECT {_OUTLIER_TEST}, 'outlier_percentage', CAST(outliers AS DOUBLE) / total, true FROM p
"""

_HISTOGRAM = """
    , delivered AS (
        SELECT actual_delivery_days AS days FROM lines
        WHERE order_status = 'delivered' AND actual_delivery_days IS NOT NULL
    ), span AS (
        SELECT MIN(days) AS low, MAX(days) AS high,
               CAST(SUM(CAST(ROUND(days * 8.64e10) AS BIGINT)) AS DOUBLE) / COUNT(*) / 8.64e10 AS mean_days
        FROM delivered
    ), counted AS (
        SELECT CAST(least(floor((days - low) / (high - low) * 20), 19) AS INTEGER) + 1 AS bin, COUNT(*) AS lines
        FROM delivered, span GROUP BY 1
    )
    SELECT CAST(b.bin AS INTEGER) AS bin, low + (high - low) / 20 * (b.bin - 1) AS from_days,
           low + (high - low) / 20 * b.bin AS to_days, COALESCE(lines, 0) AS lines, mean_days
    FROM span, range(1, 21) AS b(bin) LEFT JOIN counted c ON c.bin = b.bin
"""

_DRIFT_BINS = range(10)
_DRIFT = f"""
    , valued AS (
        SELECT order_year, order_month, order_payment, CAST(order_payment AS DOUBLE) AS v
        FROM clean_orders LEFT JOIN paid USING (order_id)
    ), first_month AS (SELECT MIN(order_year * 12 + order_month) AS m FROM valued),
    cuts10 AS (
        SELECT quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS c FROM valued
        WHERE order_year * 12 + order_month = (SELECT m FROM first_month)
    ), binned AS (
        SELECT valued.*, CASE WHEN v IS NOT NULL THEN {' + '.join(f"CAST(v > c[{i}] AS INTEGER)" for i in range(1, 10))} END AS bin FROM valued, cuts10
    ), per_month AS (
        SELECT order_year, order_month, COUNT(*) AS row_count, COUNT(v) AS n, SUM(order_payment) AS total,
               stddev_samp(v) AS std,
               {', '.join(f"greatest(CAST(COUNT(*) FILTER (bin = {i}) AS DOUBLE) / COUNT(v), 1e-6) AS p{i}" for i in _DRIFT_BINS)}
        FROM binned GROUP BY order_year, order_month
    ), baseline AS (
        SELECT {', '.join(f"p{i} AS q{i}" for i in _DRIFT_BINS)} FROM per_month
        WHERE order_year * 12 + order_month = (SELECT m FROM first_month)
    )
    SELECT order_year, order_month, row_count, ROUND(CAST(total AS DOUBLE) / n, 4) AS mean, ROUND(std, 4) AS std_dev,
           ROUND(1 - CAST(n AS DOUBLE) / row_count, 6) AS null_rate,
           ROUND({' + '.join(f"(p{i} - q{i}) * ln(p{i} / q{i})" for i in _DRIFT_BINS)}, 6) AS psi
    FROM per_month, baseline
"""

_COHORTS = """
    , active AS (
        SELECT DISTINCT customer_unique_id, order_year * 12 + order_month - 1 AS month
        FROM clean_orders JOIN customers USING (customer_id)
    ), started AS (
        SELECT *, MIN(month) OVER (PARTITION BY customer_unique_id) AS first FROM active
    ), counted AS (
        SELECT first, month - first AS since, COUNT(*) AS customers FROM started GROUP BY 1, 2
    ), sized AS (SELECT first, customers AS cohort_size FROM counted WHERE since = 0)
    SELECT CAST(first // 12 AS INTEGER) AS cohort_year, CAST(first % 12 + 1 AS INTEGER) AS cohort_month,
           CAST(since AS INTEGER) AS months_since, customers, cohort_size,
           ROUND(CAST(customers AS DOUBLE) / cohort_size * 100, 2) AS retention_pct
    FROM counted JOIN sized USING (first)
"""

_STREAM = """
    SELECT date_trunc('hour', ts) AS window_start, event_type, COUNT(*) AS events,
           CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS revenue
    FROM (SELECT DISTINCT event_id, ts, event_type, value FROM events)
    GROUP BY 1, 2
    HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT MAX(ts) - INTERVAL 1 HOUR FROM events)
"""

_SESSIONS = """
    WITH arrived AS (SELECT DISTINCT event_id, ts, user_id, value FROM events),
    marked AS (
        SELECT *, CASE WHEN ts - LAG(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE
                       THEN 0 ELSE 1 END AS opens FROM arrived
    ), numbered AS (
        SELECT *, SUM(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS place FROM marked
    )
    SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 30 MINUTE AS session_end, COUNT(*) AS events,
           CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS revenue
    FROM numbered GROUP BY user_id, place
    HAVING MAX(ts) + INTERVAL 30 MINUTE <= (SELECT MAX(ts) - INTERVAL 1 HOUR FROM events)
"""

_ITEM_COLUMNS = """order_id, order_item_id, product_id, seller_id, shipping_limit_date,
    CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value"""
_ORDER_COLUMNS = """order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at,
    order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date,
    actual_delivery_days, estimated_delivery_days, is_delayed, order_year, order_month"""
_PAYMENT_COLUMNS = """order_id, payment_sequential, payment_type, payment_installments,
    CAST(payment_value AS DOUBLE) AS payment_value"""

_SILVER_QUERIES = {
    "silver_customers": "SELECT * FROM customers",
    "silver_products": "SELECT * FROM products",
    "silver_orders": f"SELECT {_ORDER_COLUMNS} FROM clean_orders",
    "bronze_csv_roundtrip": f"SELECT {_ORDER_COLUMNS} FROM clean_orders",
    "bronze_json_roundtrip": "SELECT * FROM customers",
    "silver_orders_whole_days": """
        SELECT order_id,
               CAST(date_diff('day', CAST(order_purchase_timestamp AS DATE), CAST(order_delivered_customer_date AS DATE))
                    AS DOUBLE) AS actual_delivery_days,
               CAST(date_diff('day', CAST(order_purchase_timestamp AS DATE), CAST(order_estimated_delivery_date AS DATE))
                    AS DOUBLE) AS estimated_delivery_days, is_delayed
        FROM clean_orders""",
    "silver_customers_from_text": """
        SELECT customer_id, customer_unique_id, customer_city, customer_state,
               CASE WHEN CAST(customer_id AS INTEGER) % 11 = 0 THEN 0 ELSE customer_zip_code_prefix END
                   AS customer_zip_code_prefix FROM customers""",
    "silver_products_from_text": """
        SELECT * EXCLUDE (product_weight_g),
               CASE WHEN CAST(product_id AS INTEGER) % 13 <> 0 THEN CAST(product_weight_g AS DOUBLE) END AS product_weight_g
        FROM products""",
    "silver_orders_from_text": f"""
        SELECT {_ORDER_COLUMNS} FROM (SELECT * REPLACE (
            CASE WHEN CAST(order_id AS INTEGER) % 17 <> 0 THEN order_approved_at END AS order_approved_at)
        FROM clean_orders)""",
    "silver_order_items_from_text": f"""
        SELECT {_ITEM_COLUMNS} FROM (SELECT * REPLACE (
            CASE WHEN CAST(order_id AS INTEGER) % 101 <> 0 THEN price END AS price) FROM items)""",
    "silver_payments_from_text": f"SELECT {_PAYMENT_COLUMNS} FROM payments WHERE CAST(order_id AS INTEGER) % 89 <> 0",
    "rejected_values": """
        SELECT 'customers' AS table_name, '{"customer_id":"' || customer_id || '"}' AS key,
               'customer_zip_code_prefix' AS column_name, 'unknown' AS raw_text, 'no int' AS reason
        FROM (SELECT * FROM raw_customers UNION ALL SELECT * FROM raw_customers WHERE copied)
        WHERE CAST(customer_id AS INTEGER) % 11 = 0
        UNION ALL SELECT 'products', '{"product_id":"' || product_id || '"}', 'product_weight_g', 'heavy', 'no int'
        FROM products WHERE CAST(product_id AS INTEGER) % 13 = 0
        UNION ALL SELECT 'orders', '{"order_id":"' || order_id || '"}', 'order_approved_at', 'soon', 'no timestamp_ntz'
        FROM (SELECT * FROM raw_orders UNION ALL SELECT * FROM raw_orders WHERE copied)
        WHERE CAST(order_id AS INTEGER) % 17 = 0
        UNION ALL SELECT 'order_items', '{"order_id":"' || order_id || '","order_item_id":"' || order_item_id || '"}',
               'price', 'free', 'no decimal(18,2)'
        FROM raw_items WHERE CAST(order_id AS INTEGER) % 101 = 0
        UNION ALL SELECT 'order_payments', '{"order_id":"' || order_id || '","payment_sequential":"1"}',
               'payment_value', CASE WHEN CAST(order_id AS INTEGER) % 89 = 0 THEN 'abc' ELSE '-50.00' END,
               CASE WHEN CAST(order_id AS INTEGER) % 89 = 0 THEN 'no decimal(18,2)' ELSE 'negative' END
        FROM raw_payments WHERE CAST(order_id AS INTEGER) % 89 = 0 OR payment_value < 0""",
    "bronze_newest_version": """
        SELECT order_id, customer_id,
               CASE WHEN CAST(order_id AS INTEGER) % 10 = 3 THEN 'shipped' ELSE order_status END AS order_status
        FROM clean_orders""",
    "sql_error_texts": """
        SELECT 'counts' AS statement, (SELECT COUNT(DISTINCT order_status) FROM clean_orders) AS row_count,
               CAST(NULL AS VARCHAR) AS condition
        UNION ALL SELECT 'division', 0, 'DIVIDE_BY_ZERO' UNION ALL SELECT 'cast', 0, 'CAST_INVALID_INPUT'
        UNION ALL SELECT 'column', 0, 'UNRESOLVED_COLUMN' UNION ALL SELECT 'table', 0, 'TABLE_OR_VIEW_NOT_FOUND'
        UNION ALL SELECT 'syntax', 0, 'PARSE_SYNTAX_ERROR'""",
    "quality_document": _QUALITY.replace("SELECT 'Primary Key", ", report AS (SELECT 'Primary Key", 1) + """)
        SELECT (SELECT CASE WHEN bool_and(passed) THEN 'PASSED' ELSE 'FAILED' END FROM report) AS status, test, metric,
               CASE WHEN metric = 'null_rate' THEN printf('%.4f%%', value * 100)
                    WHEN metric IN ('outlier_percentage', 'delayed_orders_rate') THEN printf('%.2f%%', value * 100)
                    WHEN metric LIKE '%count' OR metric LIKE '%records' THEN CAST(CAST(value AS BIGINT) AS VARCHAR)
                    ELSE CAST(value AS VARCHAR) END AS shown, passed
        FROM report""",
    "gate_verdict": _QUALITY.replace("SELECT 'Primary Key", ", report AS (SELECT 'Primary Key", 1) + """)
        , tests AS (SELECT test, bool_and(passed) AS passed FROM report GROUP BY test)
        SELECT CASE WHEN bool_and(passed) THEN 'PASSED' ELSE 'FAILED' END AS status, COUNT(*) AS tests,
               COUNT(*) FILTER (NOT passed) AS failed,
               COALESCE(string_agg(test, ', ' ORDER BY test) FILTER (NOT passed), '') AS failed_tests
        FROM tests""",
    "silver_order_items": f"SELECT {_ITEM_COLUMNS} FROM items",
    "silver_payments": f"SELECT {_PAYMENT_COLUMNS} FROM payments",
    "table_audit": """
        SELECT 'customers' AS table_name, 'bronze' AS layer,
               (SELECT COUNT(*) + COUNT(*) FILTER (copied) FROM raw_customers) AS row_count
        UNION ALL SELECT 'customers', 'silver', (SELECT COUNT(*) FROM customers)
        UNION ALL SELECT 'products', 'bronze', (SELECT COUNT(*) FROM part)
        UNION ALL SELECT 'products', 'silver', (SELECT COUNT(*) FROM products)
        UNION ALL SELECT 'orders', 'bronze', (SELECT COUNT(*) + COUNT(*) FILTER (copied) FROM raw_orders)
        UNION ALL SELECT 'orders', 'silver', (SELECT COUNT(*) FROM clean_orders)
        UNION ALL SELECT 'order_items', 'bronze', (SELECT COUNT(*) FROM raw_items)
        UNION ALL SELECT 'order_items', 'silver', (SELECT COUNT(*) FROM items)
        UNION ALL SELECT 'order_payments', 'bronze', (SELECT COUNT(*) FROM raw_payments)
        UNION ALL SELECT 'order_payments', 'silver', (SELECT COUNT(*) FROM payments)""",
    "dim_date": """
        , span AS (
            SELECT CAST(MIN(order_purchase_timestamp) AS DATE) AS first, MAX(order_purchase_timestamp) AS last
            FROM clean_orders
        ), days AS (
            SELECT CAST(unnest(generate_series(CAST(first AS TIMESTAMP),
                   CASE WHEN last = date_trunc('day', last) THEN last
                        ELSE CAST(CAST(last AS DATE) + 1 AS TIMESTAMP) END, INTERVAL 1 DAY)) AS DATE) AS full_date
            FROM span
        )
        SELECT full_date, CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key,
               CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
               CAST(month(full_date) AS INTEGER) AS month, monthname(full_date) AS month_name,
               CAST(day(full_date) AS INTEGER) AS day, dayname(full_date) AS day_of_week,
               CASE WHEN isodow(full_date) >= 6 THEN 1 ELSE 0 END AS is_weekend
        FROM days""",
    "state_options": """
        SELECT DISTINCT customer_state FROM customers WHERE customer_state IS NOT NULL
        ORDER BY customer_state LIMIT 5""",
    "cohort_retention": _COHORTS,
    "quality_report": _QUALITY,
    "outlier_tagging": _BOUNDS + f"""
        SELECT {_PAYMENT_COLUMNS},
               CASE WHEN CAST(payment_value AS DOUBLE) < low OR CAST(payment_value AS DOUBLE) > high
                    THEN 1 ELSE 0 END AS is_outlier,
               low AS lower_bound, high AS upper_bound
        FROM payments, bounds""",
    "drift_report": _DRIFT,
}

_GOLD_QUERIES = {
    "dim_customers": "SELECT * FROM dim_customers",
    "dim_products": "SELECT * FROM dim_products",
    "fact_orders": """
        SELECT order_id, customer_key, product_key, date_key, order_status, CAST(price AS DOUBLE) AS price,
               CAST(freight_value AS DOUBLE) AS freight_value, CAST(payment_value AS DOUBLE) AS payment_value,
               payment_allocated, actual_delivery_days, estimated_delivery_days, is_delayed, order_year, order_month
        FROM star""",
    "fact_orders_bucketed": """
        SELECT order_id, customer_key, product_key, date_key, order_status, CAST(price AS DOUBLE) AS price,
               CAST(freight_value AS DOUBLE) AS freight_value, CAST(payment_value AS DOUBLE) AS payment_value,
               payment_allocated, actual_delivery_days, estimated_delivery_days, is_delayed, order_year, order_month
        FROM star""",
    "external_table_sql": """
        SELECT order_year, order_month, COUNT(*) AS lines, CAST(SUM(price) AS DOUBLE) AS price
        FROM star WHERE order_month IN (4, 5, 6) GROUP BY order_year, order_month""",
    "fact_orders_denormalised": f"""
        SELECT {_ORDER_COLUMNS}, order_item_id, product_id, seller_id, shipping_limit_date,
               CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value,
               CAST(order_payment AS DOUBLE) AS total_payment, customer_city, customer_state, product_category_name
        FROM star""",
    "fact_by_calendar": """
        SELECT CAST(order_year AS INTEGER) AS year, CAST(quarter(order_purchase_timestamp) AS INTEGER) AS quarter,
               CAST(isodow(order_purchase_timestamp) >= 6 AS INTEGER) AS is_weekend,
               COUNT(DISTINCT order_id) AS orders, COUNT(*) AS lines, CAST(SUM(payment_value) AS DOUBLE) AS revenue
        FROM lines GROUP BY 1, 2, 3""",
    "star_sql_on_views": """
        SELECT customer_city, product_category_name, CAST(SUM(payment_value) AS DOUBLE) AS revenue,
               COUNT(*) AS line_count
        FROM star WHERE order_status <> 'canceled' GROUP BY customer_city, product_category_name""",
    "mom_revenue": _monthly("SUM(payment_value)", "COUNT(*)", _ROUNDED),
    "mom_revenue_unrounded": _monthly("SUM(payment_value)", "COUNT(*)", _PLAIN, with_average=False),
    "mom_revenue_order_grain": _monthly(
        "SUM(COALESCE(order_payment, goods_value)) FILTER (place = 1)", "COUNT(DISTINCT order_id)",
        _ROUNDED,
    ).replace("FROM lines", "FROM (SELECT *, row_number() OVER (PARTITION BY order_id) AS place FROM lines)"),
    "monthly_gmv": _gmv(""),
    "monthly_gmv_not_canceled": _gmv("WHERE order_status <> 'canceled'"),
    "top_categories_per_state": """
        , sold AS (
            SELECT customer_state, product_category_name, SUM(payment_value) AS revenue, COUNT(*) AS items_sold
            FROM star WHERE customer_key IS NOT NULL AND product_key IS NOT NULL GROUP BY 1, 2
        ), ranked AS (
            SELECT *, dense_rank() OVER (PARTITION BY customer_state ORDER BY revenue DESC) AS place FROM sold
        )
        SELECT customer_state, CAST(place AS INTEGER) AS rank_in_state, product_category_name,
               CAST(revenue AS DOUBLE) AS category_revenue, items_sold
        FROM ranked WHERE place <= 3""",
    "top_categories": """
        SELECT product_category_name, CAST(SUM(payment_value) AS DOUBLE) AS payment_value
        FROM star WHERE product_category_name IS NOT NULL GROUP BY 1
        ORDER BY payment_value DESC, product_category_name LIMIT 8""",
    "delivery_sla_by_state": _SLA,
    "delivery_sla_worst_states": _SLA + " ORDER BY delay_pct DESC, customer_state LIMIT 5",
    "delay_rate_by_state": """
        SELECT customer_state, CAST(COUNT(order_id) AS BIGINT) AS total, CAST(SUM(is_delayed) AS BIGINT) AS delayed,
               CAST(SUM(is_delayed) AS DOUBLE) / COUNT(order_id) * 100 AS delay_rate
        FROM star WHERE order_status = 'delivered' GROUP BY customer_state""",
    "executive_kpis": _kpis("", "lines"),
    "executive_kpis_sliced": _kpis(
        """WHERE customer_state IN ('NATION_1', 'NATION_2', 'NATION_3')
           AND product_category_name IN ('ECONOMY', 'PROMO')""", "star"),
    "executive_kpis_cube_sliced": _kpis(
        """WHERE product_category_name IN ('ECONOMY', 'STANDARD') AND order_year IN (1996, 1998, 2000)
           AND order_status IN ('delivered', 'shipped')""", "star"),
    "monthly_gmv_sliced": """
        SELECT order_year, order_month, CAST(SUM(payment_value) AS DOUBLE) AS payment_value,
               order_year || '-' || lpad(CAST(order_month AS VARCHAR), 2, '0') AS period,
               COUNT(DISTINCT order_id) AS total_orders
        FROM star WHERE customer_state IN ('NATION_0', 'NATION_7') AND order_status <> 'canceled'
             AND product_category_name IN ('ECONOMY', 'PROMO', 'unlabeled')
        GROUP BY order_year, order_month""",
    "delay_rate_by_state_sliced": """
        SELECT customer_state, CAST(COUNT(order_id) AS BIGINT) AS total, CAST(SUM(is_delayed) AS BIGINT) AS delayed,
               CAST(SUM(is_delayed) AS DOUBLE) / COUNT(order_id) * 100 AS delay_rate
        FROM star WHERE order_status = 'delivered' AND order_year IN (1997, 1998) AND order_month IN (1, 2, 3, 12)
             AND product_category_name IN ('SMALL', 'MEDIUM', 'LARGE')
        GROUP BY customer_state""",
    "top_categories_sliced": """
        SELECT product_category_name, CAST(SUM(payment_value) AS DOUBLE) AS payment_value,
               COUNT(DISTINCT order_id) AS total_orders
        FROM star WHERE customer_state IN ('NATION_1', 'NATION_2', 'NATION_3') AND order_month IN (6, 7)
             AND order_status = 'delivered' AND product_category_name IS NOT NULL
        GROUP BY 1 ORDER BY payment_value DESC, product_category_name LIMIT 8""",
    "status_share": """
        SELECT order_status, COUNT(*) AS lines,
               ROUND(CAST(COUNT(*) AS DOUBLE) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE) * 100, 1) AS share_pct
        FROM lines GROUP BY order_status""",
    "on_time_counts": """
        SELECT CASE WHEN is_delayed = 1 THEN 'Delayed' ELSE 'On Time' END AS delivery, COUNT(*) AS lines
        FROM lines WHERE order_status = 'delivered' GROUP BY 1""",
    "delivery_histogram": _HISTOGRAM,
}

_RFM_QUERIES = {
    "rfm_base": "SELECT * FROM base",
    "rfm_features": "SELECT * FROM features",
    "rfm_features_ntile": _ntile("DESC", "ASC", "ASC NULLS FIRST"),
    "rfm_features_ntile_one_is_best": _ntile("ASC", "DESC", "DESC NULLS LAST"),
    "segment_summary": """
        SELECT customer_segment, COUNT(*) AS customer_count,
               ROUND(CAST(SUM(recency_days) AS DOUBLE) / COUNT(*), 1) AS avg_recency_days,
               ROUND(CAST(SUM(frequency_orders) AS DOUBLE) / COUNT(*), 2) AS avg_orders,
               CAST(SUM(CAST(monetary_spend AS DECIMAL(28,2))) AS DOUBLE) AS total_segment_revenue,
               ROUND(CAST(SUM(CAST(monetary_spend AS DECIMAL(28,2))) AS DOUBLE) / COUNT(*), 2) AS avg_clv
        FROM features GROUP BY customer_segment""",
    "segment_counts": "SELECT customer_segment, COUNT(*) AS count FROM features GROUP BY customer_segment",
    "rfm_scatter_sample": """
        SELECT customer_unique_id, customer_segment, recency_days, monetary_spend FROM features
        WHERE monetary_spend < (SELECT quantile_cont(monetary_spend, 0.98) FROM features)""",
    "at_risk_top_spenders": """
        SELECT customer_unique_id, recency_days, frequency_orders, monetary_spend FROM features
        WHERE customer_segment = 'At Risk' ORDER BY monetary_spend DESC, customer_unique_id LIMIT 10""",
    "customer_feature_preview": "SELECT * FROM features ORDER BY customer_unique_id LIMIT 100",
}


def oracle_sql():
    """Statement per query name."""
    statements = {name: f"WITH {_SILVER} {tail}" for name, tail in _SILVER_QUERIES.items()}
    statements.update({name: f"WITH {_SILVER} {_GOLD} {tail}" for name, tail in _GOLD_QUERIES.items()})
    statements.update({name: f"WITH {_SILVER} {_RFM} {tail}" for name, tail in _RFM_QUERIES.items()})
    statements["stream_dedup_revenue"] = _STREAM
    statements["stream_session_revenue"] = _SESSIONS
    return statements
