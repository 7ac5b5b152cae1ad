"""Bucketed tables, pruning by a join, counts while writing, rejects, report documents, newest versions, SQL errors."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entries
from tallylake.plans import analytics, gold, lakehouse, quality, rejects, silver
from tallylake.sources.bronze import land, newest_versions, read_raw
from tallylake.sources.tables import CORRUPT, audit_counts, read_json_report, read_table, run_sql, write_json_report
from tests.frames import item, order, payment, rows, table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def retail(spark):
    return entries._Retail(spark, SF_DIR)


def plan_of(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_order_tables_join_without_an_exchange(spark, retail, tmp_path):
    spark.sql("CREATE DATABASE bucket_test")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = lakehouse.store_order_tables(retail.orders, retail.items, retail.payments, "bucket_test", str(tmp_path), 4)
        totals = gold.order_totals(*tables.values())
        assert "Exchange" not in plan_of(totals)
        keys = ["order_id", "line_count", "line_revenue", "order_revenue"]
        assert rows(totals, *keys) == rows(gold.order_totals(retail.orders, retail.items, retail.payments), *keys)
        lines = gold.order_lines(*tables.values(), allocate=True, bucketed=True)
        assert "Exchange" not in plan_of(lines)
        assert lines.count() == retail.items.join(retail.orders, "order_id").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE bucket_test CASCADE")


def test_buckets_grow_with_the_rows(spark, retail, tmp_path):
    spark.sql("CREATE DATABASE grown_buckets")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        n = retail.items.count()
        tables = lakehouse.store_order_tables(
            retail.orders, retail.items, retail.payments, "grown_buckets", str(tmp_path), 2, rows_per_bucket=n // 6
        )
        for name in tables:
            described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED grown_buckets.{name}").collect()}
            assert int(described["Num Buckets"]) == -(-n // (n // 6))
        lines = gold.order_lines(*tables.values(), allocate=True, bucketed=True)
        assert "Exchange" not in plan_of(lines)
        assert lines.count() == retail.items.join(retail.orders, "order_id").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE grown_buckets CASCADE")


def test_a_hot_order_does_not_hold_the_lines_together(spark):
    """A third of the lines in one order: the join splits its partition when told that it is large."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        n = 120_000
        hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("o"), F.col("id") % 5000))
        items = spark.range(n).select(hot.alias("order_id"), F.sha1(F.col("id").cast("string")).alias("product_id"),
                                      F.lit(2).cast("decimal(18,2)").alias("price"),
                                      F.lit(1).cast("decimal(18,2)").alias("freight_value"))
        orders = items.select("order_id").distinct().withColumn("note", F.repeat(F.lit("x"), 20))
        payments = spark.createDataFrame([("hot", 5)], "order_id string, payment_value int")
        lines = gold.order_lines(orders, items, payments.withColumn("payment_value", F.col("payment_value").cast("decimal(18,2)")))
        by_task = lines.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)), F.max("product_id"))  # ids are read
        sizes = [r[1] for r in by_task.collect()]
        assert sum(sizes) == n and len(sizes) > 1
        assert "SortMergeJoin(skew=true)" in by_task._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_external_fact_is_pruned_by_the_join(spark, retail):
    found = entries._external(retail)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString().lower()
    assert {r.order_month for r in found.collect()} == {4, 5, 6}


def test_counts_come_from_the_writing_pass(spark, retail, tmp_path):
    raw = {}
    for name in ("customers", "products", "orders", "order_items", "order_payments"):
        options = {"as_text": True} if name == "orders" else {}
        raw[name] = retail.raw(name, **options)
        keyless = raw[name].where("false") if name != "customers" else raw[name].limit(3).withColumn(
            "customer_id", F.lit(None).cast("string"))
        raw[name] = raw[name].unionByName(keyless)
        raw[name].write.option("header", True).csv(f"{tmp_path}/raw/{name}_raw.csv")
    land(spark, f"{tmp_path}/raw", f"{tmp_path}/bronze")
    for quarantine in (False, True):
        counts = lakehouse.build_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver", quarantine=quarantine)
        stages = {(name, "bronze"): df for name, df in raw.items()}
        stages |= {(name, "silver"): read_table(spark, f"{tmp_path}/silver/{name}") for name in raw}
        assert rows(counts, "*") == rows(audit_counts(stages), "*")


def test_rejects_name_the_place_the_text_and_the_reason(spark, tmp_path):
    path = tmp_path / "order_payments_raw.csv"
    path.write_text("order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
                    "a,1,card,2,10.5\nb,x,card,,abc\n,1,card,1,-3\n")
    raw = read_raw(spark, str(path), "order_payments")
    found = rejects.rejected_values(raw, "order_payments").collect()
    told = sorted((r.key, r.column_name, r.raw_text, r.reason) for r in found)
    b, c = '{"order_id":"b","payment_sequential":"x"}', '{"payment_sequential":"1"}'
    assert told == sorted([(b, "payment_sequential", "x", "no int"), (b, "payment_value", "abc", "no decimal(18,2)"),
                           (c, "order_id", None, "missing key"), (c, "payment_value", "-3", "negative")], key=repr)
    places = [json.loads(r.place) for r in found if r.column_name == "payment_value"]
    assert all(p["_source_file"].endswith("order_payments_raw.csv") for p in places)
    assert len({p["_source_row"] for p in places}) == 2
    kept = silver.clean_payments(raw)
    assert rows(kept, "order_id") == [("a",)]


def test_a_document_that_does_not_fit_keeps_its_text(spark, retail, tmp_path):
    path = str(tmp_path / "reports")
    write_json_report(quality.report_document(quality.quality_report(retail.orders, retail.payments)), path)
    (tmp_path / "reports" / "broken.json").write_text('{"status": "PASSED", "tests": [{"name": ')
    read = read_json_report(spark, path, quality.document_schema()).cache()
    assert read.where(F.col(CORRUPT).isNotNull()).count() == 1
    lines = quality.document_lines(read).collect()
    shown = {r.metric: r.shown for r in lines}
    assert shown["null_rate"] == "0.0000%" and shown["null_count"] == "0" and len(lines) == 15
    assert {r.status for r in lines} == {"PASSED"}


def test_gate_verdict_names_the_failed_tests(spark, retail):
    report = quality.quality_report(retail.orders.unionByName(retail.orders), retail.payments)
    assert quality.gate_verdict(report).first().asDict() == {
        "status": "FAILED", "tests": 4, "failed": 1, "failed_tests": quality.UNIQUE_TEST}


def test_newest_version_wins_and_missing_days_lose_nothing(spark, tmp_path):
    header = "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
    days = ["a,u,1,old,SP\nb,u,1,kept,SP\n", "a,u,1,new,SP\na,u,1,newest,SP\nc,u,1,c,SP\n", "c,u,1,late,SP\n"]
    for day, text in enumerate(days, 1):
        folder = tmp_path / f"raw{day}"
        folder.mkdir()
        (folder / "customers_raw.csv").write_text(header + text)
        land(spark, str(folder), str(tmp_path / "bronze"), datetime.date(2026, 1, day))
    found = newest_versions(spark, str(tmp_path / "bronze"), "customers", ["customer_id"])
    assert rows(found, "customer_id", "customer_city") == [("a", "newest"), ("b", "kept"), ("c", "late")]
    since = newest_versions(spark, str(tmp_path / "bronze"), "customers", ["customer_id"], since=datetime.date(2026, 1, 3))
    assert rows(since, "customer_id", "customer_city") == [("c", "late")]
    with pytest.raises(FileNotFoundError):
        newest_versions(spark, str(tmp_path / "bronze"), "customers", ["customer_id"], since=datetime.date(2027, 1, 1))


def test_errors_of_rows_come_back_as_text(spark):
    result, error = run_sql(spark, "SELECT 1/0")
    assert result is None and error.startswith("DIVIDE_BY_ZERO")
    result, error = run_sql(spark, "SELECT id, id AS id FROM range(5) ORDER BY id DESC")
    assert error is None and [tuple(r) for r in result.collect()] == [(i, i) for i in (4, 3, 2, 1, 0)]
    assert run_sql(spark, "SELECT * FROM range(3) WHERE id > 5")[0].count() == 0


def test_orders_without_a_time_come_last_and_keep_no_calendar_day(spark):
    orders = silver.clean_orders(table(spark, "orders", [order("a"), order("b", at=None), order("c", at="2025-02-01 00:00:00")]))
    items = silver.clean_order_items(table(spark, "order_items", [item(o, price=p) for o, p in (("a", 10), ("b", 7), ("c", 20))]))
    payments = silver.clean_payments(table(spark, "order_payments", [payment("none", 1)]))
    months = analytics.mom_revenue(gold.order_totals(orders, items, payments)).collect()
    assert [(m.order_year, m.order_month, m.total_revenue, m.prev_month_revenue) for m in months] == [
        (2025, 1, 11.0, None), (2025, 2, 21.0, 11.0), (None, None, 8.0, 21.0)]
    keyed = gold.order_totals(orders.withColumn("date_key", gold.date_key(F.col("order_purchase_timestamp"))), items, payments)
    days = analytics.fact_by_calendar(keyed, gold.dim_date(orders)).collect()
    assert sorted((d.year or 0, d.quarter or 0, d.orders, d.revenue) for d in days) == [(0, 0, 1, 8.0), (2025, 1, 1, 11.0), (2025, 1, 1, 21.0)]


def test_whole_days_count_midnights(spark):
    raw = table(spark, "orders", [order("a", at="2025-01-01 23:00:00", arrived="2025-01-03 01:00:00", promised="2025-01-01 23:30:00")])
    assert rows(silver.clean_orders(raw, whole_days=True), "actual_delivery_days", "estimated_delivery_days") == [(2, 0)]
    assert rows(silver.clean_orders(raw).selectExpr("round(actual_delivery_days, 6) d"), "d") == [(1.083333,)]


def test_a_blank_is_no_missing_value(spark, tmp_path):
    path = tmp_path / "customers_raw.csv"
    path.write_text("customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\na,u,1, ,NA\n")
    assert rows(read_raw(spark, str(path), "customers"), "customer_city", "customer_state") == [(" ", None)]
