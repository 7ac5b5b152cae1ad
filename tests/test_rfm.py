import itertools

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallylake.operators import ranking
from tallylake.plans import rfm, silver
from tests.frames import customer, order, payment, table, ts


def expected_segment(r, f, m):
    if r >= 3:
        return "Champions" if f >= 3 and m >= 3 else "Loyal Customers" if f >= 2 else "Recent Customers"
    return "At Risk" if f >= 3 else "Hibernating"


def test_all_score_triples(spark):
    triples = list(itertools.product(range(1, 5), repeat=3))
    df = spark.createDataFrame(triples, "r int, f int, m int")
    got = df.withColumn("segment", rfm.segment(F.col("r"), F.col("f"), F.col("m"))).collect()
    assert {(x["r"], x["f"], x["m"]): x["segment"] for x in got} == {t: expected_segment(*t) for t in triples}


def people(spark, n):
    """n persons; person i has 1 + i % 3 orders over two customer ids; person 0 has a canceled, unpaid order only."""
    customers, orders, payments = [], [], []
    for i in range(n):
        customers += [customer(f"c{i:03d}a", f"u{i:03d}"), customer(f"c{i:03d}b", f"u{i:03d}")]
        for j in range(1 if i == 0 else 1 + i % 3):
            oid = f"o{i:03d}{j}"
            day = 1 + (i * 7 + j) % 27
            orders.append(order(oid, f"c{i:03d}{'ab'[j % 2]}", "canceled" if i == 0 else "delivered",
                                f"2025-03-{day:02d} 0{i % 10}:00:00"))
            if i:
                payments.append(payment(oid, 10 + i % 5))
    return (
        silver.clean_orders(table(spark, "orders", orders)),
        silver.clean_customers(table(spark, "customers", customers)),
        silver.clean_payments(table(spark, "order_payments", payments)),
    )


@pytest.mark.parametrize("most", [1000, 3])
def test_features_of_made_up_people(spark, monkeypatch, most):
    """45 people: the first buckets by position hold 12, 11, 11 and 11; scores never fall as their value rises."""
    monkeypatch.setattr(ranking, "MOST_VALUES", most)
    found = rfm.rfm_features(*people(spark, 45)).toPandas().set_index("customer_unique_id")
    assert len(found) == 45
    for i in (1, 2, 3, 44):
        person = found.loc[f"u{i:03d}"]
        assert person["frequency_orders"] == 1 + i % 3
        assert person["monetary_spend"] == (1 + i % 3) * (10 + i % 5)
    assert found.loc["u000", "monetary_spend"] == 0
    for score, value in (("f_score", "frequency_orders"), ("m_score", "monetary_spend")):
        assert found[score].value_counts().sort_index().tolist() == [12, 11, 11, 11]
        ordered = found.reset_index().sort_values([value, "customer_unique_id"])
        assert ordered[score].is_monotonic_increasing
    by_age = found.sort_values("recency_days")
    assert by_age["r_score"].is_monotonic_decreasing
    assert (by_age.groupby("recency_days")["r_score"].nunique() == 1).all()
    for person in found.itertuples():
        scores = (person.r_score, person.f_score, person.m_score)
        assert person.customer_segment == expected_segment(*scores)
    assert "Promising" not in set(found["customer_segment"])


def test_newest_person_has_recency_one_and_snapshot_can_be_set(spark):
    tables = people(spark, 5)
    assert rfm.rfm_base(*tables).agg(F.min("recency_days")).first()[0] == 1
    fixed = rfm.rfm_base(*tables, snapshot=F.lit(ts("2026-01-01")).cast("timestamp_ntz"))
    assert fixed.agg(F.min("recency_days")).first()[0] > 270


def test_single_person(spark):
    features = rfm.rfm_features(*people(spark, 1)).collect()
    assert [(f["f_score"], f["m_score"], f["r_score"]) for f in features] == [(1, 1, 4)]


def test_ntile_directions(spark):
    tables = people(spark, 8)
    best_four = rfm.rfm_features_ntile(*tables).toPandas().set_index("customer_unique_id")
    best_one = rfm.rfm_features_ntile(*tables, best_is_four=False).toPandas().set_index("customer_unique_id")
    newest = best_four["recency_days"].idxmin()
    assert best_four.loc[newest, "r_score"] == 4 and best_one.loc[newest, "r_score"] == 1
    assert pd.isna(best_four.loc["u000", "monetary_spend"])
    assert best_four.loc["u000", "m_score"] == 1 and best_one.loc["u000", "m_score"] == 4
    for frame in (best_four, best_one):
        assert frame["m_score"].value_counts().to_dict() == {1: 2, 2: 2, 3: 2, 4: 2}
