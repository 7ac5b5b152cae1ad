import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallylake.operators import ranking
from tallylake.plans import quality, silver
from tallylake.sources.tables import read_json_report, write_json_report
from tests.frames import order, payment, rows, table


def tables(spark, orders, payments):
    return (
        silver.clean_orders(table(spark, "orders", orders)),
        silver.clean_payments(table(spark, "order_payments", payments)),
    )


@pytest.fixture(scope="module")
def sample(spark):
    orders = [
        order(f"o{i}", arrived=f"2025-01-{11 + i:02d} 10:00:00", promised="2025-01-15 00:00:00") for i in range(8)
    ] + [order("late", status="shipped")]
    values = [10, 20, 30, 40, 50, 60, 70, 5000]
    return tables(spark, orders, [payment(f"o{i}", v) for i, v in enumerate(values)])


def metrics(report):
    return {r["metric"]: (r["value"], r["passed"]) for r in report.collect()}


@pytest.mark.parametrize("most", [1000, 2])
def test_report(sample, monkeypatch, most):
    monkeypatch.setattr(ranking, "MOST_VALUES", most)
    got = metrics(quality.quality_report(*sample))
    q1, q3 = np.percentile([10, 20, 30, 40, 50, 60, 70, 5000], [25, 75])
    days = np.arange(1, 9)
    assert got["null_count"] == (0, True) and got["total_records"] == got["unique_records"] == (9, True)
    assert got["q1_25th_percentile"][0] == q1 and got["q3_75th_percentile"][0] == q3
    assert got["statistical_upper_bound"][0] == round(q3 + 1.5 * (q3 - q1), 2)
    assert got["outlier_count"][0] == 1 and got["outlier_percentage"][0] == 0.125
    assert got["mean_delivery_days"] == (4.5, True)
    assert got["std_dev_delivery_days"][0] == round(float(np.std(days, ddof=1)), 2)
    assert got["p95_delivery_days"][0] == round(float(np.percentile(days, 95)), 2)
    assert got["delayed_orders_count"][0] == 4
    assert got["delayed_orders_rate"][0] == pytest.approx(4 / 9)


def test_document(spark, sample, tmp_path):
    path = str(tmp_path / "report.json")
    write_json_report(quality.report_document(quality.quality_report(*sample), "2026-01-01T00:00:00"), path)
    document = json.loads(next((tmp_path / "report.json").glob("part-*")).read_text())
    assert (document["status"], document["timestamp"]) == ("PASSED", "2026-01-01T00:00:00")
    null_test, unique_test, outlier_test, sla_test = document["tests"]
    assert null_test == {"name": quality.NULL_TEST, "null_count": 0, "null_rate": "0.0000%", "passed": True}
    assert unique_test == {"name": quality.UNIQUE_TEST, "total_records": 9, "unique_records": 9, "passed": True}
    assert outlier_test["outlier_percentage"] == "12.50%" and outlier_test["outlier_count"] == 1
    assert sla_test["delayed_orders_rate"] == "44.44%"
    assert read_json_report(spark, path).select("status").first()[0] == "PASSED"


def test_empty_tables_report_rows(spark):
    report = quality.quality_report(*tables(spark, [], []))
    assert report.count() == 15
    assert quality.report_document(report).first()["status"] == "FAILED"


def test_gate(spark, sample):
    good = quality.quality_report(*sample)
    assert quality.check_gate(good, fail_on_error=True)
    orders, payments = sample
    doubled = quality.quality_report(orders.unionByName(orders), payments)
    assert not quality.check_gate(doubled)
    with pytest.raises(quality.QualityGateError, match="Uniqueness"):
        quality.check_gate(doubled, fail_on_error=True)


def test_null_keys_fail_the_report(spark, sample):
    orders, payments = sample
    broken = orders.withColumn("order_id", F.when(F.col("order_id") != "late", F.col("order_id")))
    got = metrics(quality.quality_report(broken, payments))
    assert got["null_count"] == (1, False) and got["unique_records"] == (8, False)


def test_tags_and_approximate_bounds(sample):
    _, payments = sample
    tagged = quality.tag_outliers(payments, "payment_value")
    assert rows(tagged.where("is_outlier = 1").selectExpr("cast(payment_value as double) v"), "v") == [(5000.0,)]
    q1, q3, low, high = quality.outlier_bounds(payments, "payment_value", approx=True)
    assert low == 0.0 and q1 <= q3 < high


def test_drift(spark):
    months = [(2025, 1, float(v)) for v in range(100)] + [(2025, 2, float(v)) for v in range(100)]
    months += [(2025, 3, float(v + 90)) for v in range(100)] + [(2025, 3, None)] * 100 + [(2025, 4, None)]
    df = spark.createDataFrame(months, "order_year int, order_month int, v double")
    got = {r["order_month"]: r for r in quality.drift_report(df, "v").collect()}
    assert got[1]["psi"] == 0 and got[2]["psi"] == 0
    assert got[3]["psi"] > 5 and got[3]["null_rate"] == 0.5 and got[3]["mean"] == 139.5
    assert got[4]["psi"] is None and got[4]["null_rate"] == 1
    shifted = {r["order_month"]: r["psi"] for r in quality.drift_report(df, "v", baseline=(2025, 3)).collect()}
    assert shifted[3] == 0 and shifted[1] > 1
