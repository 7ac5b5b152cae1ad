"""From raw files to reports, one layer after the other. Each layer is written before the next one reads it."""

from tallylake.operators.dedup import POSITION, split_null_keys
from tallylake.plans import analytics, gold, quality, rfm, silver
from tallylake.schemas import KEYS, PARTITIONS
from tallylake.sources.bronze import land, read_bronze
from tallylake.sources.tables import (
    Counted,
    gold_tables,
    read_table,
    write_csv_report,
    write_json_report,
    write_bucketed,
    write_table,
)

_CLEAN = {
    "customers": silver.clean_customers,
    "products": silver.clean_products,
    "orders": silver.clean_orders,
    "order_items": silver.clean_order_items,
    "order_payments": silver.clean_payments,
}


def build_silver(spark, bronze, silver_path, fmt="csv", on=None, quarantine=False):
    """Clean every table of one Bronze date and write it. Returns the rows read and written, counted in that pass.

    With quarantine, rows with a null in their key are kept out of Silver and written, raw, to <table>_quarantine.
    """
    counted = Counted()
    for table, clean in _CLEAN.items():
        raw = read_bronze(spark, bronze, table, fmt, on)
        if quarantine:
            raw, broken = split_null_keys(raw, KEYS[table])
            broken = counted.watch(broken, table, "bronze")
            write_table(broken.drop(POSITION), f"{silver_path}/{table}_quarantine")
        raw = counted.watch(raw, table, "bronze")
        partition_by = ["order_year", "order_month"] if table == "orders" else ()
        write_table(counted.watch(clean(raw), table, "silver"), f"{silver_path}/{table}", partition_by)
    return counted.frame(spark)


def store_order_tables(orders, items, payments, database, path, buckets, rows_per_bucket=1_000_000):
    """Orders, lines and payments as catalog tables bucketed by order_id: {name: DataFrame}.

    One task sorts and joins a whole bucket. Where the largest table would put more than rows_per_bucket rows in one on
    average, all tables get more than the given number of buckets, the same for each, so that they still meet.
    """
    tables = {"orders": orders, "order_items": items, "order_payments": payments}
    largest = max(df.count() for df in tables.values())
    buckets = max(buckets, -(-largest // rows_per_bucket))
    return {
        name: write_bucketed(df, f"{database}.{name}", f"{path}/{name}", ["order_id"], buckets)
        for name, df in tables.items()
    }


def silver_tables(spark, silver_path):
    return {table: read_table(spark, f"{silver_path}/{table}") for table in _CLEAN}


def build_gold(spark, silver_path, gold_path):
    """Write dimensions first, so that the fact looks its keys up in stored tables, then the fact and the features."""
    s = silver_tables(spark, silver_path)
    customers, orders, items, payments = s["customers"], s["orders"], s["order_items"], s["order_payments"]
    write_table(gold.dim_customers(customers), f"{gold_path}/dim_customers")
    write_table(gold.dim_products(s["products"]), f"{gold_path}/dim_products")
    write_table(gold.dim_date(orders), f"{gold_path}/dim_date")
    dims = gold_tables(spark, gold_path, ["dim_customers", "dim_products"])
    fact = gold.fact_orders(orders, items, payments, dims["dim_customers"], dims["dim_products"])
    write_table(fact, f"{gold_path}/fact_orders", PARTITIONS["fact_orders"])
    features = rfm.rfm_features(orders, customers, payments)
    write_table(features, f"{gold_path}/features_customer_rfm")


def build_reports(spark, gold_path, reports):
    g = gold_tables(spark, gold_path)
    totals = gold.totals_from_fact(g["fact_orders"])
    write_csv_report(analytics.mom_revenue(totals), f"{reports}/mom_revenue_growth.csv")
    write_csv_report(analytics.segment_summary(g["features_customer_rfm"]), f"{reports}/rfm_segments.csv")
    worst = analytics.delivery_sla_by_state(totals, g["dim_customers"], worst=5)
    write_csv_report(worst, f"{reports}/delivery_sla_by_state.csv")
    best = analytics.top_categories_per_state(g["fact_orders"], g["dim_customers"], g["dim_products"])
    write_csv_report(best, f"{reports}/top_categories_per_state.csv")


def run_lakehouse(spark, source, lake, on=None, fmt="csv", fail_on_error=False, quarantine=False):
    """Land, clean, audit, model and report. Returns the folders of the layers and the verdict of the gate."""
    paths = {layer: f"{lake}/{layer}" for layer in ("bronze", "silver", "gold", "reports")}
    land(spark, source, paths["bronze"], on)
    counts = build_silver(spark, paths["bronze"], paths["silver"], fmt, on, quarantine)
    clean = silver_tables(spark, paths["silver"])
    write_csv_report(counts, f"{paths['reports']}/row_counts.csv")
    report = quality.quality_report(clean["orders"], clean["order_payments"])
    write_json_report(quality.report_document(report), f"{paths['reports']}/data_quality_report.json")
    passed = quality.check_gate(report, fail_on_error)
    build_gold(spark, paths["silver"], paths["gold"])
    build_reports(spark, paths["gold"], paths["reports"])
    return {**paths, "passed": passed}
