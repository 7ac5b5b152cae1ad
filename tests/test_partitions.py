"""Results do not depend on the number of shuffle partitions, the time zone, or on how brackets are narrowed."""

import pytest

import __spark_entry__ as entries
from tallylake.operators import ranking
from tallylake.plans import rfm
from tests.frames import rows

SF_DIR = "/root/testdata/sf0.001"
NAMES = ["mom_revenue", "delivery_sla_by_state", "top_categories_per_state", "quality_report", "rfm_features", "silver_orders"]


@pytest.mark.parametrize("name", NAMES)
def test_partition_count_and_time_zone(spark, name):
    results = []
    for partitions, zone in (("1", "UTC"), ("4", "America/Sao_Paulo"), ("200", "Asia/Kolkata")):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            results.append(rows(entries.queries()[name](spark, SF_DIR), "*"))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert results[0] == results[1] == results[2]


def test_narrowed_brackets_give_the_same_features(spark, monkeypatch):
    retail = entries._Retail(spark, SF_DIR)
    tables = (retail.orders, retail.customers, retail.payments)
    plain = rows(rfm.rfm_features(*tables), "*")
    monkeypatch.setattr(ranking, "MOST_VALUES", 3)
    assert rows(rfm.rfm_features(*tables), "*") == plain
