"""Every choice of slicers gives the same answer from the cube as from the lines themselves."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entries
from tallylake.plans import analytics, cube, gold, silver
from tests.frames import customer, item, order, payment, product, rows, table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    t = entries._Retail(spark, SF_DIR)
    path = str(tmp_path_factory.mktemp("cube"))
    stored = cube.store_cube(cube.sales_cube(t.orders, t.items, t.payments, t.customers, t.products), path)
    lines = analytics.enriched_lines(t.lines, t.customers, t.products, "customer_id", "product_id")
    return stored.cache(), lines.cache(), path


def choices(lines):
    rng = random.Random(3)
    values = {
        name: sorted(r[0] for r in lines.select(column).distinct().collect() if r[0] is not None)
        for name, column in zip(["states", "years", "months", "categories", "statuses"], cube.SLICERS[:1] + [
            "order_year", "order_month", "product_category_name", "order_status"])
    }
    yield {}
    yield {"states": [], "years": [1900]}
    for _ in range(6):
        yield {k: rng.sample(v, rng.randint(1, len(v))) for k, v in values.items() if rng.random() < 0.6}


def test_any_slice_equals_the_lines(both):
    cells, lines, _ = both
    for slicers in choices(lines):
        part, chosen = cube.sliced(cells, **slicers), analytics.select_lines(lines, **slicers)
        totals = analytics.totals_from_lines(chosen)
        assert rows(cube.cube_kpis(part), "*") == rows(analytics.executive_kpis(totals), "*"), slicers
        months = rows(cube.cube_monthly_gmv(part).drop("total_orders"), "*")
        assert months == rows(analytics.monthly_gmv(totals), "*"), slicers
        state = chosen.where("order_status = 'delivered' and customer_state is not null").groupBy("customer_state")
        rates = state.agg(F.count(F.lit(1)).alias("total"), F.sum("is_delayed").alias("delayed"))
        assert rows(cube.cube_delay_rate_by_state(part).drop("delay_rate"), "*") == rows(rates, "*"), slicers
        best = chosen.groupBy("product_category_name").agg(
            F.sum("payment_value").cast("double").alias("payment_value"), F.count_distinct("order_id").alias("n"))
        assert rows(cube.cube_top_categories(part, 100), "*") == rows(best, "*"), slicers


def test_orders_in_two_categories_count_once(spark):
    orders = silver.clean_orders(table(spark, "orders", [order("o1"), order("o2", at=None), order("o3", "nobody")]))
    items = silver.clean_order_items(table(spark, "order_items", [
        item("o1", 1, "p1"), item("o1", 2, "p2"), item("o1", 3, "p1"), item("o2", 1, "p2"), item("o3", 1, "none")]))
    payments = silver.clean_payments(table(spark, "order_payments", [payment("o1", 40)]))
    customers = silver.clean_customers(table(spark, "customers", [customer("c1")]))
    products = silver.clean_products(table(spark, "products", [product("p1", "a"), product("p2", "b")]))
    cells = cube.sales_cube(orders, items, payments, customers, products)
    (kpis,) = cube.cube_kpis(cells).collect()
    assert (kpis.total_orders, kpis.gmv) == (3, 142.0)
    (kpis,) = cube.cube_kpis(cube.sliced(cells, categories=["a", "b"])).collect()
    assert (kpis.total_orders, kpis.gmv) == (2, 131.0)
    (kpis,) = cube.cube_kpis(cube.sliced(cells, categories=["a"])).collect()
    assert (kpis.total_orders, kpis.gmv) == (1, 80.0)
    assert rows(cube.cube_monthly_gmv(cells), "period", "total_orders") == [("2025-01", 2)]
    assert gold.order_totals(orders, items, payments).count() == 3


def test_a_slice_of_years_reads_only_their_files(spark, both):
    part = cube.sliced(spark.read.parquet(both[2]), years=[1998, 1999])
    assert "order_year" in part._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
