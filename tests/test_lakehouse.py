import datetime

import pytest

from tallylake.plans import analytics, gold, quality
from tallylake.plans.lakehouse import build_silver, run_lakehouse
from tallylake.sources import sample_tables
from tallylake.sources.tables import (
    create_gold_tables,
    gold_tables,
    read_table,
    register_views,
    run_sql,
    write_table,
)
from tests.frames import rows

SF_DIR = "/root/testdata/sf0.001"
ON = datetime.date(2026, 1, 2)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Raw CSV files written from the sample tables, taken through the whole lake."""
    base = tmp_path_factory.mktemp("lake")
    for name in ("customers", "products", "orders", "order_items", "order_payments"):
        options = {"as_text": True} if name == "orders" else {}
        raw = getattr(sample_tables, f"raw_{name}")(spark, SF_DIR, **options)
        raw.coalesce(2).write.option("header", True).csv(f"{base}/raw/{name}_raw.csv")
    return run_lakehouse(spark, f"{base}/raw", str(base), ON)


def test_row_counts_and_verdict(spark, lake):
    assert lake["passed"]
    counts = {(r[0], r[1]): int(r[2]) for r in
              spark.read.option("header", True).csv(f"{lake['reports']}/row_counts.csv").collect()}
    assert counts["orders", "bronze"] == 1525 and counts["orders", "silver"] == 1500
    assert counts["customers", "bronze"] == 165 and counts["customers", "silver"] == 150
    assert counts["order_payments", "bronze"] > counts["order_payments", "silver"]
    g = gold_tables(spark, lake["gold"])
    assert g["fact_orders"].count() == counts["order_items", "silver"]
    assert g["dim_customers"].agg({"customer_key": "max"}).first()[0] == 150


def test_fact_is_partitioned_and_pruned(spark, lake):
    fact = read_table(spark, f"{lake['gold']}/fact_orders")
    one = fact.where("order_year = 1996 and order_month = 3 and order_status = 'delivered'").select("price")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_year" in plan
    assert "PushedFilters: [IsNotNull(order_status), EqualTo(order_status,delivered)]" in plan
    assert "ReadSchema: struct<order_status:string,price:decimal(18,2)>" in plan


def test_views_and_functions_agree(spark, lake):
    g = gold_tables(spark, lake["gold"])
    register_views(g)
    lines, error = run_sql(spark, "SELECT order_status, COUNT(*) AS n FROM fact_orders GROUP BY order_status")
    assert error is None
    counts = {r.order_status: r.n for r in lines.collect()}
    assert sum(counts.values()) == g["fact_orders"].count()
    months = analytics.mom_revenue(gold.totals_from_fact(g["fact_orders"])).collect()
    sold = {r.order_id for r in g["fact_orders"].where("order_status <> 'canceled'").select("order_id").collect()}
    assert sum(m.total_orders for m in months) == len(sold)
    assert [m.prev_month_revenue for m in months[1:]] == [m.total_revenue for m in months[:-1]]
    top = analytics.top_categories_per_state(g["fact_orders"], g["dim_customers"], g["dim_products"]).collect()
    assert {r.rank_in_state for r in top} <= {1, 2, 3}
    assert sum(r.items_sold for r in top) <= sum(counts.values())
    assert run_sql(spark, "SELECT nothing FROM fact_orders")[1]


def test_order_grain_revenue_adds_up_to_the_payments(spark, lake):
    g = gold_tables(spark, lake["gold"])
    fact = g["fact_orders"]
    allocated = fact.agg({"payment_allocated": "sum"}).first()[0]
    once = gold.totals_from_fact(fact).agg({"order_revenue": "sum"}).first()[0]
    assert allocated == pytest.approx(float(once))
    payments = read_table(spark, f"{lake['silver']}/order_payments")
    paid = fact.select("order_id").distinct().join(gold.payment_totals(payments), "order_id", "left")
    unpaid = fact.join(paid.where("order_payment is null"), "order_id").selectExpr("sum(price + freight_value)").first()[0]
    assert float(once) == pytest.approx(float(paid.agg({"order_payment": "sum"}).first()[0] + unpaid))


def test_features_partition_the_people(spark, lake):
    g = gold_tables(spark, lake["gold"])
    features = g["features_customer_rfm"]
    summary = analytics.segment_summary(features).collect()
    assert sum(r["customer_count"] for r in summary) == features.count()
    assert features.select("customer_unique_id").distinct().count() == features.count()


def test_sql_errors_come_back_as_text(spark, lake):
    result, error = run_sql(spark, "SELECT nothing FROM nowhere")
    assert result is None and "nowhere" in error
    assert run_sql(spark, "SELEC 1")[0] is None


def test_external_tables(spark, lake):
    create_gold_tables(spark, lake["gold"], "lake_test")
    create_gold_tables(spark, lake["gold"], "lake_test")
    try:
        assert spark.table("lake_test.fact_orders").count() == read_table(spark, f"{lake['gold']}/fact_orders").count()
        assert spark.sql("SHOW PARTITIONS lake_test.fact_orders").count() > 12
        for name, df in gold_tables(spark, lake["gold"]).items():
            assert sorted(spark.table(f"lake_test.{name}").columns) == sorted(df.columns)
            assert spark.table(f"lake_test.{name}").exceptAll(df.select(*spark.table(f"lake_test.{name}").columns)).count() == 0
    finally:
        spark.sql("DROP DATABASE lake_test CASCADE")


def test_reports_have_headers(spark, lake):
    for name, column in {"mom_revenue_growth": "mom_growth_pct", "rfm_segments": "avg_clv",
                         "delivery_sla_by_state": "delay_pct", "top_categories_per_state": "items_sold"}.items():
        report = spark.read.option("header", True).csv(f"{lake['reports']}/{name}.csv")
        assert column in report.columns and report.count() > 0
    assert spark.read.json(f"{lake['reports']}/data_quality_report.json").first()["status"] == "PASSED"


def test_rewrite_of_one_partition_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 2024), (2, 2025)], "v int, order_year int")
    write_table(df, path, ["order_year"])
    write_table(spark.createDataFrame([(9, 2025)], "v int, order_year int"), path, ["order_year"], replace_all=False)
    assert rows(read_table(spark, path), "v", "order_year") == [(1, 2024), (9, 2025)]
    write_table(spark.createDataFrame([(7, 2025)], "v int, order_year int"), path, ["order_year"])
    assert rows(read_table(spark, path), "v") == [(7,)]


def test_rebalance_splits_a_month_with_most_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.shuffle.partitions": "8"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df = spark.range(0, 200000, 1, 8).selectExpr("uuid() as v", "if(id % 10 < 9, 1, 2) as order_month")
        write_table(df, path, ["order_month"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "order_month=1").glob("*.parquet"))) > 4


def test_gate_can_stop_the_run(spark, tmp_path):
    raw = tmp_path / "raw"
    for name in ("customers", "products", "order_items", "order_payments"):
        df = getattr(sample_tables, f"raw_{name}")(spark, SF_DIR).coalesce(1)
        df.write.option("header", True).csv(f"{raw}/{name}_raw.csv")
    orders = sample_tables.raw_orders(spark, SF_DIR, as_text=True)
    slow = orders.withColumn("order_delivered_customer_date", orders["order_estimated_delivery_date"]).withColumn(
        "order_purchase_timestamp", orders["order_purchase_timestamp"].substr(1, 0)
    )
    slow.coalesce(1).write.option("header", True).csv(f"{raw}/orders_raw.csv")
    with pytest.raises(quality.QualityGateError):
        run_lakehouse(spark, str(raw), str(tmp_path), ON, fail_on_error=True)


def test_quarantine_keeps_null_keys_out_of_silver(spark, tmp_path):
    day = tmp_path / "bronze" / "year=2026" / "month=01" / "day=02"
    day.mkdir(parents=True)
    header = {
        "customers": "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n",
        "products": "product_id,product_category_name,product_weight_g,product_length_cm,product_height_cm,product_width_cm\n",
        "orders": "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
                  "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n",
        "order_items": "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n",
        "order_payments": "order_id,payment_sequential,payment_type,payment_installments,payment_value\n",
    }
    for table, text in header.items():
        body = "o1,c1,shipped,,,,,\n,c2,shipped,,,,,\n" if table == "orders" else ""
        (day / f"{table}_raw.csv").write_text(text + body)
    for quarantine, kept in ((False, 2), (True, 1)):
        silver = str(tmp_path / f"silver-{quarantine}")
        build_silver(spark, str(tmp_path / "bronze"), silver, quarantine=quarantine)
        assert read_table(spark, f"{silver}/orders").count() == kept
    assert rows(read_table(spark, f"{silver}/orders_quarantine"), "order_id", "customer_id") == [(None, "c2")]
