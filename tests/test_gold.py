import datetime

import pytest
from pyspark.sql import functions as F

from tallylake.plans import analytics, gold, silver
from tests.frames import customer, item, order, payment, product, rows, table


def build(spark, orders, items, payments):
    customers = gold.dim_customers(silver.clean_customers(table(spark, "customers", [customer("c2"), customer("c1")])))
    products = gold.dim_products(silver.clean_products(table(spark, "products", [product("p2"), product("p1")])))
    return gold.fact_orders(
        silver.clean_orders(table(spark, "orders", orders)),
        silver.clean_order_items(table(spark, "order_items", items)),
        silver.clean_payments(table(spark, "order_payments", payments)),
        customers, products,
    )


ORDERS = [order("o1"), order("o2", "c2", at=None), order("o3", "nobody", status="canceled"), order("o4")]
ITEMS = [item("o1", 1, "p1", 10, 2), item("o1", 2, "p2", 20, 4), item("o1", 3, "p1", 30, 6), item("o2", 1, "p9", 5, 1),
         item("o3", 1, "p2", 7, 1), item("o9", 1)]
PAYMENTS = [payment("o1", 40, 1), payment("o1", 50, 2), payment("o2", -50)]


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_fact(spark, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        check_fact(build(spark, ORDERS, ITEMS, PAYMENTS))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def check_fact(fact):
    got = rows(
        fact.select("order_id", "customer_key", "product_key", "date_key", F.col("payment_value").cast("double"),
                    F.round("payment_allocated", 6)), "*"
    )
    assert got == sorted([
        ("o1", 1, 1, 20250110, 90.0, 15.0), ("o1", 1, 2, 20250110, 90.0, 30.0), ("o1", 1, 1, 20250110, 90.0, 45.0),
        ("o2", 2, None, 0, 6.0, 6.0),
        ("o3", None, 2, 20250110, 8.0, 8.0),
    ], key=repr)


def test_order_totals_agree_with_the_fact(spark):
    fact = build(spark, ORDERS, ITEMS, PAYMENTS)
    direct = gold.order_totals(
        silver.clean_orders(table(spark, "orders", ORDERS)),
        silver.clean_order_items(table(spark, "order_items", ITEMS)),
        silver.clean_payments(table(spark, "order_payments", PAYMENTS)),
    )
    columns = ["order_id", "line_count", "goods_value", "freight_value", "line_revenue", "order_revenue"]
    assert rows(gold.totals_from_fact(fact), *columns) == rows(direct, *columns)


def test_free_goods_share_the_payment_by_line(spark):
    fact = build(spark, [order("o1")], [item("o1", 1, "p1", 0, 0), item("o1", 2, "p1", 0, 0)], [payment("o1", 9)])
    assert rows(fact, "payment_allocated") == [(4.5,), (4.5,)]


@pytest.mark.parametrize("last,days", [("2025-01-03 00:00:00", 3), ("2025-01-03 10:00:00", 4)])
def test_dim_date_ends(spark, last, days):
    orders = table(spark, "orders", [order("a", at="2025-01-01 23:00:00"), order("b", at=last)])
    dates = gold.dim_date(orders).orderBy("full_date").collect()
    assert len(dates) == days
    assert dates[0]["full_date"] == datetime.date(2025, 1, 1)
    assert (dates[0]["day_of_week"], dates[0]["month_name"], dates[0]["is_weekend"]) == ("Wednesday", "January", 0)
    if days == 4:
        assert (dates[3]["day_of_week"], dates[3]["is_weekend"], dates[3]["date_key"]) == ("Saturday", 1, 20250104)


def test_dim_date_of_no_orders(spark):
    assert gold.dim_date(table(spark, "orders", [])).count() == 0


def test_keys_are_dense_and_in_order(spark):
    customers = silver.clean_customers(table(spark, "customers", [customer(f"c{i}") for i in range(60)]))
    keyed = rows(gold.dim_customers(customers), "customer_id", "customer_key")
    assert keyed == sorted((c, i) for i, c in enumerate(sorted(f"c{i}" for i in range(60)), 1))


def test_volume_does_not_overflow(spark):
    products = silver.clean_products(table(spark, "products", [product("p", size=2_000)]))
    assert gold.dim_products(products).first()["product_volume_cm3"] == 8_000_000_000


def test_denormalised_fact(spark):
    fact = gold.fact_orders_denormalised(
        silver.clean_orders(table(spark, "orders", ORDERS)),
        silver.clean_order_items(table(spark, "order_items", ITEMS)),
        silver.clean_payments(table(spark, "order_payments", PAYMENTS)),
        silver.clean_customers(table(spark, "customers", [customer("c1", state="RJ")])),
        silver.clean_products(table(spark, "products", [product("p1", "books")])),
    )
    got = rows(fact.withColumn("t", F.col("total_payment").cast("double")), "order_id", "order_item_id", "t",
               "customer_state", "product_category_name")
    assert got == sorted([
        ("o1", 1, 90.0, "RJ", "books"), ("o1", 2, 90.0, "RJ", None), ("o1", 3, 90.0, "RJ", "books"),
        ("o2", 1, None, None, None), ("o3", 1, None, None, None),
    ], key=repr)


def months(spark, amounts):
    """Order totals with one order per month of 2025 and the given payments."""
    orders = [order(f"o{m}", at=f"2025-{m:02d}-05 00:00:00") for m in range(1, len(amounts) + 1)]
    return gold.order_totals(
        silver.clean_orders(table(spark, "orders", orders)),
        silver.clean_order_items(table(spark, "order_items", [item(o["order_id"]) for o in orders])),
        silver.clean_payments(table(spark, "order_payments",
                                    [payment(o["order_id"], a) for o, a in zip(orders, amounts)])),
    )


def test_growth_without_a_previous_month_or_with_a_zero_one(spark):
    got = analytics.mom_revenue(months(spark, [10.0, 0.0, 5.0, 7.5])).collect()
    assert [r["prev_month_revenue"] for r in got] == [None, 10.0, 0.0, 5.0]
    assert [r["mom_growth_pct"] for r in got] == [None, -100.0, None, 50.0]
    assert analytics.mom_revenue(months(spark, [3.0])).first()["mom_growth_pct"] is None


def test_states_need_twenty_lines(spark):
    orders = [order(f"a{i}", "c1", arrived="2025-01-20 10:00:00", promised="2025-01-19 00:00:00") for i in range(19)]
    orders += [order(f"b{i}", "c2", arrived="2025-01-20 10:00:00", promised="2025-01-21 00:00:00") for i in range(20)]
    totals = gold.order_totals(
        silver.clean_orders(table(spark, "orders", orders)),
        silver.clean_order_items(table(spark, "order_items", [item(o["order_id"]) for o in orders])),
        silver.clean_payments(table(spark, "order_payments", [])),
    )
    customers = table(spark, "customers", [customer("c1", state="BA"), customer("c2", state="CE")])
    got = analytics.delivery_sla_by_state(totals, customers, "customer_id")
    assert rows(got, *got.columns) == [("CE", 20, 10.0, 0, 0.0, 1.0)]
    rates = analytics.delay_rate_by_state(totals, customers, "customer_id")
    assert rows(rates, *rates.columns) == [("BA", 19, 19, 100.0), ("CE", 20, 0, 0.0)]


def test_kpis_of_nothing(spark):
    kpis = analytics.executive_kpis(months(spark, [])).first().asDict()
    assert (kpis["gmv"], kpis["total_orders"], kpis["aov"], kpis["on_time_pct"]) == (0.0, 0, 0.0, 100.0)


def test_histogram_of_one_value_and_of_nothing(spark):
    orders = [order("a", arrived="2025-01-20 10:00:00", promised="2025-01-21 00:00:00")]
    totals = gold.order_totals(
        silver.clean_orders(table(spark, "orders", orders)),
        silver.clean_order_items(table(spark, "order_items", [item("a")])),
        silver.clean_payments(table(spark, "order_payments", [])),
    )
    bins = analytics.delivery_histogram(totals).where("lines > 0").collect()
    assert [(b["bin"], b["lines"], b["mean_days"]) for b in bins] == [(11, 1, 10.0)]
    assert analytics.delivery_histogram(totals.where("false")).agg(F.sum("lines")).first()[0] == 0


def test_mean_days_of_more_lines_than_a_bigint_of_microseconds_holds(spark):
    """Twenty million lines of twenty days each are more than 2**63 microseconds."""
    totals = spark.createDataFrame(
        [("c1", "delivered", 10.0, 10_000_000, 0, 1.0), ("c1", "delivered", 30.0, 10_000_000, 1, 1.0)],
        "customer_id string, order_status string, actual_delivery_days double, line_count long, is_delayed int,"
        " freight_value double",
    )
    bins = analytics.delivery_histogram(totals).where("lines > 0")
    assert rows(bins, "bin", "lines", "mean_days") == [(1, 10_000_000, 20.0), (20, 10_000_000, 20.0)]
    customers = table(spark, "customers", [customer("c1", state="BA")])
    sla = analytics.delivery_sla_by_state(totals, customers, "customer_id")
    assert rows(sla, "customer_state", "total_deliveries", "avg_delivery_days") == [("BA", 20_000_000, 20.0)]


def test_empty_slicer_does_not_filter(spark):
    df = table(spark, "customers", [customer("c1", state="RJ"), customer("c2", state="SP")])
    assert analytics.select_lines(df, states=[]).count() == 2
    assert analytics.select_lines(df, states=["SP"]).count() == 1
    assert rows(analytics.filter_options(df, "customer_state", 1), "customer_state") == [("RJ",)]


def test_rank_ties_share_a_place(spark):
    orders = [order("o1")]
    items = [item("o1", n, p) for n, p in enumerate(["p1", "p2", "p3", "p4"], 1)]
    lines = gold.order_lines(
        silver.clean_orders(table(spark, "orders", orders)),
        silver.clean_order_items(table(spark, "order_items", items + [item("o1", 5, "p4")])),
        silver.clean_payments(table(spark, "order_payments", [payment("o1", 10)])),
    )
    products = table(spark, "products", [product(f"p{i}", f"cat{i}") for i in range(1, 5)])
    customers = table(spark, "customers", [customer("c1")])
    got = analytics.top_categories_per_state(lines, customers, products, 2, "customer_id", "product_id")
    assert [(r["rank_in_state"], r["product_category_name"]) for r in got.collect()] == [
        (1, "cat4"), (2, "cat1"), (2, "cat2"), (2, "cat3")
    ]
    best = analytics.top_categories(lines, products, 2, "product_id")
    assert rows(best, *best.columns) == [("cat1", 10.0), ("cat4", 20.0)]
