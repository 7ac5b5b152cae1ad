"""Entry points: one flagship query, all registered queries, and their SQL counterparts."""

from __future__ import annotations

import datetime
import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import sample_oracles  # noqa: E402
from tallylake.operators.shared_tables import new_path  # noqa: E402
from tallylake.plans import analytics, cube, gold, lakehouse, quality, rejects, rfm, silver  # noqa: E402
from tallylake.schemas import KEYS  # noqa: E402
from tallylake.sources import sample_tables as sample  # noqa: E402
from tallylake.sources.bronze import land, newest_versions, read_bronze  # noqa: E402
from tallylake.sources.tables import (  # noqa: E402
    audit_counts, create_gold_tables, read_json_report, register_views, run_sql, write_json_report, write_table,
)
from tallylake.streaming import landing  # noqa: E402

try:  # the training-text operators and their pipeline can be left out of an installation
    import corpus_pipeline
    from tallylake.llm import oracles as llm_oracles
    from tallylake.llm import queries as llm_queries
except ImportError:  # also where a package that only they need is missing
    corpus_pipeline = llm_oracles = llm_queries = None


class _Retail:
    """Silver and Gold tables over the sample tables of one folder, each built when it is asked for."""

    def __init__(self, spark, sf_dir):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, table, **options):
        return getattr(sample, f"raw_{table}")(self.spark, self.sf_dir, **options)

    @property
    def customers(self):
        return silver.clean_customers(self.raw("customers"))

    @property
    def products(self):
        return silver.clean_products(self.raw("products"))

    @property
    def orders(self):
        return silver.clean_orders(self.raw("orders"))

    @property
    def items(self):
        return silver.clean_order_items(self.raw("order_items"))

    @property
    def payments(self):
        return silver.clean_payments(self.raw("order_payments"))

    @property
    def dim_customers(self):
        return gold.dim_customers(self.customers)

    @property
    def dim_products(self):
        return gold.dim_products(self.products)

    @property
    def dim_date(self):
        return gold.dim_date(self.orders)

    @property
    def fact(self):
        return gold.fact_orders(self.orders, self.items, self.payments, self.dim_customers, self.dim_products)

    @property
    def lines(self):
        """Order lines with natural keys: what the line questions need, without building surrogate keys."""
        return gold.order_lines(self.orders, self.items, self.payments)

    @property
    def totals(self):
        return gold.order_totals(self.orders, self.items, self.payments)

    def cells(self, **slicers):
        """A slice of the stored cube."""
        built = cube.sales_cube(self.orders, self.items, self.payments, self.customers, self.products)
        return cube.sliced(cube.store_cube(built, new_path(self.spark, "sales-cube")), **slicers)

    @property
    def features(self):
        return rfm.rfm_features(self.orders, self.customers, self.payments)

    def features_ntile(self, best_is_four):
        return rfm.rfm_features_ntile(self.orders, self.customers, self.payments, best_is_four=best_is_four)


def _scatter(t):
    features = t.features
    (p98,) = quality.percentiles(features, {"monetary_spend": [0.98]})["monetary_spend"]
    return analytics.rfm_scatter_sample(features, p98)


def _sliced_kpis(t):
    lines = analytics.enriched_lines(t.lines, t.customers, t.products, "customer_id", "product_id")
    chosen = analytics.select_lines(lines, states=["NATION_1", "NATION_2", "NATION_3"], categories=["ECONOMY", "PROMO"])
    return analytics.executive_kpis(analytics.totals_from_lines(chosen))


def _calendar(t):
    orders = t.orders.withColumn("date_key", gold.date_key(F.col("order_purchase_timestamp")))
    return analytics.fact_by_calendar(gold.order_totals(orders, t.items, t.payments), t.dim_date)


def _drift(t):
    payments = gold.payment_totals(t.payments)
    return quality.drift_report(t.orders.join(payments, "order_id", "left"), "order_payment")


def _audit(t):
    clean = {"customers": t.customers, "products": t.products, "orders": t.orders,
             "order_items": t.items, "order_payments": t.payments}
    stages = {(name, "bronze"): t.raw(name) for name in clean}
    stages.update({(name, "silver"): df for name, df in clean.items()})
    return audit_counts(stages)


# Each join meets rows that are already summed per its key and the remaining groups.
_STAR_SQL = """
WITH bought AS (
    SELECT customer_key, product_key, SUM(payment_value) AS revenue, COUNT(*) AS line_count
    FROM fact_orders WHERE order_status <> 'canceled'
    GROUP BY customer_key, product_key
), per_city AS (
    SELECT customer_city, product_key, SUM(revenue) AS revenue, SUM(line_count) AS line_count
    FROM bought JOIN dim_customers USING (customer_key)
    GROUP BY customer_city, product_key
)
SELECT customer_city, product_category_name,
       CAST(SUM(revenue) AS DOUBLE) AS revenue, SUM(line_count) AS line_count
FROM per_city JOIN dim_products USING (product_key)
GROUP BY customer_city, product_category_name
"""


def _star_sql(t):
    customers, products = t.dim_customers, t.dim_products
    fact = gold.fact_orders(t.orders, t.items, t.payments, customers, products)
    register_views({"fact_orders": fact, "dim_customers": customers, "dim_products": products})
    result, error = run_sql(t.spark, _STAR_SQL)
    if error:
        raise ValueError(error)
    return result


def _events(t):
    path = f"{t.sf_dir}/events.parquet"
    table = t.spark.read.parquet(path)
    reader = t.spark.readStream.schema(table.schema)
    if any(f.rstrip("/").endswith("/events.parquet") for f in table.inputFiles()):  # one file, not a folder of parts
        return reader.option("pathGlobFilter", "events.parquet").parquet(t.sf_dir)
    return reader.parquet(path)


def _stream(t):
    """Revenue by window of the events that have arrived; windows still open at the end are not reported yet."""
    return landing.read_available(landing.windowed_revenue(_events(t)), "stream-revenue")


def _sessions(t):
    """User sessions that no event can extend any more, through an idempotent upsert per micro-batch."""
    path = new_path(t.spark, "sessions")
    return landing.upsert_available(landing.session_revenue(_events(t)), path, new_path(t.spark, "sessions-progress"))


def _newest(t):
    """Orders landed on two dates, the second with corrections of some and without most others."""
    first = t.raw("orders", as_text=True)
    key = F.col("order_id").cast("int")
    second = first.where(key % 10 == 3).withColumn("order_status", F.lit("shipped"))
    bronze = new_path(t.spark, "bronze")
    for day, rows in ((1, first), (2, second)):
        source = new_path(t.spark, "raw-files")
        rows.write.option("header", True).csv(f"{source}/orders_raw.csv")
        land(t.spark, source, bronze, datetime.date(2026, 1, day))
    return newest_versions(t.spark, bronze, "orders", KEYS["orders"]).select("order_id", "customer_id", "order_status")


_RAW_TABLES = ["customers", "products", "orders", "order_items", "order_payments"]


def _text(t, table):
    return sample.raw_text(t.spark, t.sf_dir, table)


def _rejects(t):
    return rejects.all_rejects({table: _text(t, table) for table in _RAW_TABLES}).drop("place")


def _document(t):
    """The quality report as a JSON document, written, read back against its schema, and laid out by line."""
    path = new_path(t.spark, "quality-document")
    write_json_report(quality.report_document(quality.quality_report(t.orders, t.payments)), path)
    return quality.document_lines(read_json_report(t.spark, path, quality.document_schema()))


def _new_database(t):
    name = f"lake_{uuid.uuid4().hex}"
    t.spark.sql(f"CREATE DATABASE {name} LOCATION '{new_path(t.spark, name)}'")
    return name


def _bucketed_fact(t):
    tables = lakehouse.store_order_tables(
        t.orders, t.items, t.payments, _new_database(t), new_path(t.spark, "silver-bucketed"), 8
    )
    return gold.fact_orders(*tables.values(), t.dim_customers, t.dim_products, bucketed=True)


# Quarters are known to the calendar only: the fact's partitions are pruned by the join, while the statement runs.
EXTERNAL_SQL = """
SELECT f.order_year, f.order_month, COUNT(*) AS lines, CAST(SUM(f.price) AS DOUBLE) AS price
FROM {0}.fact_orders f JOIN (
    SELECT DISTINCT year, month FROM {0}.dim_date WHERE quarter = 2 AND day_of_week = 'Sunday'
) d ON f.order_year = d.year AND f.order_month = d.month
GROUP BY f.order_year, f.order_month
"""


def _external(t):
    """Gold tables written by partition, declared as external tables, their partitions repaired, then asked in SQL."""
    path, database = new_path(t.spark, "gold"), _new_database(t)
    write_table(t.fact, f"{path}/fact_orders", ["order_year", "order_month"])
    write_table(t.dim_date, f"{path}/dim_date")
    create_gold_tables(t.spark, path, database, ["fact_orders", "dim_date"])
    return t.spark.sql(EXTERNAL_SQL.format(database))


def _sql_errors(t):
    """What ad-hoc statements over a view come back with: rows, or the condition of an error, also one of a row."""
    t.orders.createOrReplaceTempView("checked_orders")
    statements = {
        "counts": "SELECT order_status, COUNT(*) FROM checked_orders GROUP BY order_status ORDER BY 2",
        "division": "SELECT 1 / (order_year - order_year) FROM checked_orders",
        "cast": "SELECT CAST(order_status AS INT) FROM checked_orders",
        "column": "SELECT nothing FROM checked_orders",
        "table": "SELECT * FROM no_such_table",
        "syntax": "SELEC order_id FROM checked_orders",
    }
    found = []
    for name, text in statements.items():
        result, error = run_sql(t.spark, text)
        condition = error and error.split(":")[0].split(".")[0]
        found.append((name, 0 if error else result.count(), condition))
    return t.spark.createDataFrame(found, "statement string, row_count long, condition string")


def _landed(t, table, fmt, changed):
    """A raw table written as files, its first rows once more with a changed value after the others, and landed."""
    raw = t.raw(table, as_text=True) if table == "orders" else t.raw(table)
    key = KEYS[table][0]
    first = raw.dropDuplicates([key])
    later = first.where(F.col(key).cast("int") < 500).withColumn(changed, F.lit("later"))
    source, bronze = new_path(t.spark, "raw-files"), new_path(t.spark, "bronze")
    rows = first.unionByName(later).select([F.col(c).cast("string") for c in first.columns])
    rows.write.option("header", True).format(fmt).save(f"{source}/{table}_raw.{fmt}")
    land(t.spark, source, bronze)
    return read_bronze(t.spark, bronze, table, fmt)


_QUERIES = {
    "bronze_csv_roundtrip": lambda t: silver.clean_orders(_landed(t, "orders", "csv", "order_status")),
    "bronze_json_roundtrip": lambda t: silver.clean_customers(_landed(t, "customers", "json", "customer_city")),
    "silver_customers": lambda t: t.customers,
    "silver_products": lambda t: t.products,
    "silver_orders": lambda t: silver.clean_orders(t.raw("orders", as_text=True)),
    "silver_orders_whole_days": lambda t: silver.clean_orders(t.raw("orders"), whole_days=True).select(
        "order_id", F.col("actual_delivery_days").cast("double"), F.col("estimated_delivery_days").cast("double"),
        "is_delayed",
    ),
    "silver_customers_from_text": lambda t: silver.clean_customers(_text(t, "customers")),
    "silver_products_from_text": lambda t: silver.clean_products(_text(t, "products")).withColumn(
        "product_weight_g", F.col("product_weight_g").cast("double")
    ),
    "silver_orders_from_text": lambda t: silver.clean_orders(_text(t, "orders")),
    "silver_order_items_from_text": lambda t: silver.clean_order_items(_text(t, "order_items")),
    "silver_payments_from_text": lambda t: silver.clean_payments(_text(t, "order_payments")),
    "rejected_values": _rejects,
    "bronze_newest_version": _newest,
    "silver_order_items": lambda t: t.items,
    "silver_payments": lambda t: t.payments,
    "table_audit": _audit,
    "dim_customers": lambda t: t.dim_customers,
    "dim_products": lambda t: t.dim_products,
    "dim_date": lambda t: t.dim_date,
    "fact_orders": lambda t: t.fact,
    "fact_orders_denormalised": lambda t: gold.fact_orders_denormalised(
        t.orders, t.items, t.payments, t.customers, t.products
    ),
    "fact_orders_bucketed": _bucketed_fact,
    "external_table_sql": _external,
    "sql_error_texts": _sql_errors,
    "fact_by_calendar": _calendar,
    "star_sql_on_views": _star_sql,
    "rfm_base": lambda t: rfm.rfm_base(t.orders, t.customers, t.payments),
    "rfm_features": lambda t: t.features,
    "rfm_features_ntile": lambda t: t.features_ntile(True),
    "rfm_features_ntile_one_is_best": lambda t: t.features_ntile(False),
    "segment_summary": lambda t: analytics.segment_summary(t.features),
    "segment_counts": lambda t: analytics.segment_counts(t.features),
    "rfm_scatter_sample": _scatter,
    "at_risk_top_spenders": lambda t: analytics.at_risk_top_spenders(t.features),
    "customer_feature_preview": lambda t: analytics.preview(t.features),
    "mom_revenue": lambda t: analytics.mom_revenue(t.totals),
    "mom_revenue_unrounded": lambda t: analytics.mom_revenue_unrounded(t.totals),
    "mom_revenue_order_grain": lambda t: analytics.mom_revenue_order_grain(t.totals),
    "monthly_gmv": lambda t: analytics.monthly_gmv(t.totals),
    "monthly_gmv_not_canceled": lambda t: analytics.monthly_gmv(t.totals, canceled=False),
    "top_categories_per_state": lambda t: analytics.top_categories_per_state(
        t.lines, t.customers, t.products, 3, "customer_id", "product_id"
    ),
    "top_categories": lambda t: analytics.top_categories(t.lines, t.products, 8, "product_id"),
    "delivery_sla_by_state": lambda t: analytics.delivery_sla_by_state(t.totals, t.customers, "customer_id"),
    "delivery_sla_worst_states": lambda t: analytics.delivery_sla_by_state(
        t.totals, t.customers, "customer_id", worst=5
    ),
    "delay_rate_by_state": lambda t: analytics.delay_rate_by_state(t.totals, t.customers, "customer_id"),
    "executive_kpis": lambda t: analytics.executive_kpis(t.totals),
    "executive_kpis_sliced": _sliced_kpis,
    "executive_kpis_cube_sliced": lambda t: cube.cube_kpis(
        t.cells(categories=["ECONOMY", "STANDARD"], years=[1996, 1998, 2000], statuses=["delivered", "shipped"])
    ),
    "monthly_gmv_sliced": lambda t: cube.cube_monthly_gmv(
        t.cells(states=["NATION_0", "NATION_7"], categories=["ECONOMY", "PROMO", "unlabeled"]), canceled=False
    ),
    "delay_rate_by_state_sliced": lambda t: cube.cube_delay_rate_by_state(
        t.cells(years=[1997, 1998], months=[1, 2, 3, 12], categories=["SMALL", "MEDIUM", "LARGE"])
    ),
    "top_categories_sliced": lambda t: cube.cube_top_categories(
        t.cells(states=["NATION_1", "NATION_2", "NATION_3"], months=[6, 7], statuses=["delivered"]), 8
    ),
    "state_options": lambda t: analytics.filter_options(t.customers, "customer_state", 5),
    "status_share": lambda t: analytics.status_share(t.totals),
    "on_time_counts": lambda t: analytics.on_time_counts(t.totals),
    "delivery_histogram": lambda t: analytics.delivery_histogram(t.totals),
    "cohort_retention": lambda t: analytics.cohort_retention(t.orders, t.customers),
    "quality_report": lambda t: quality.quality_report(t.orders, t.payments),
    "quality_document": _document,
    "gate_verdict": lambda t: quality.gate_verdict(quality.quality_report(t.orders, t.payments)),
    "outlier_tagging": lambda t: quality.tag_outliers(t.payments, "payment_value"),
    "drift_report": _drift,
    "stream_dedup_revenue": _stream,
    "stream_session_revenue": _sessions,
}


def _plain(df):
    """Decimals as doubles, so that both engines report the same column types."""
    return df.withColumns({c: F.col(c).cast("double") for c, dtype in df.dtypes if dtype.startswith("decimal")})


def _query(build):
    return lambda spark, sf_dir: _plain(build(_Retail(spark, sf_dir)))


def entry(spark: SparkSession) -> DataFrame:
    """Month-over-month revenue on the smallest sample."""
    return queries()["mom_revenue"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: _query(build) for name, build in _QUERIES.items()}
    if llm_queries:
        found |= llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    found = sample_oracles.oracle_sql()
    if llm_oracles:
        found |= llm_oracles.ORACLES
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
