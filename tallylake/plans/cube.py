"""A stored cube behind the dashboard: any choice of its slicers is answered from sums and order bitmaps.

Lines are summed per state, year, month, category and status. Sums of a slice add up, distinct orders don't: an order
with lines of two categories is in two cells. So each cell holds its orders as bitmaps over dense order numbers, a row per
32,768 numbers, and a slice ORs them. Orders are numbered by period, state and status: the orders of a cell lie close
together and fill few bitmaps.
"""

from pyspark.sql import functions as F

from tallylake.functions.expressions import period_label, ratio
from tallylake.operators.ranking import sorted_numbers
from tallylake.plans.analytics import kpi_row, select_lines
from tallylake.plans.gold import order_lines
from tallylake.sources.tables import read_table, write_table

SLICERS = ["customer_state", "order_year", "order_month", "product_category_name", "order_status"]
_SUMS = ["lines", "delayed_lines", "revenue"]


def sales_cube(orders, items, payments, customers, products):
    """(slicers, bucket, lines, delayed_lines, revenue, orders, delayed_orders): one row per cell and bitmap bucket."""
    places = customers.select("customer_id", "customer_state")
    placed = orders.select("order_id", "customer_id", "order_status", "is_delayed", "order_year", "order_month").join(
        places, "customer_id", "left"
    )
    by_cell = ["order_year", "order_month", "customer_state", "order_status", "order_id"]
    numbered = sorted_numbers(placed.drop("customer_id"), by_cell, "number")
    chosen = items.select("order_id", "product_id", "price", "freight_value")
    lines = order_lines(numbered, chosen, payments).join(
        products.select("product_id", "product_category_name"), "product_id", "left"
    )
    position = F.bitmap_bit_position("number")
    delayed = F.col("is_delayed") == 1
    return lines.groupBy(*SLICERS, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(delayed).alias("delayed_lines"),
        F.sum("payment_value").cast("decimal(38,2)").alias("revenue"),
        F.bitmap_construct_agg(position).alias("orders"),
        F.bitmap_construct_agg(F.when(delayed, position)).alias("delayed_orders"),
    )


def store_cube(cube, path):
    """Write the cube by year, so that a slice of years reads only these, and read it back."""
    write_table(cube, path, ["order_year"])
    return read_table(cube.sparkSession, path).select(*cube.columns)


def sliced(cube, **slicers):
    """The cells of a choice: states, years, months, categories, statuses; one that is None or empty does not filter."""
    return select_lines(cube, **slicers)


def _orders_of(cells, *by):
    """Sums and distinct orders of cells per group: bitmaps are merged per bucket, then counted."""
    delivered = F.col("order_status") == "delivered"
    merged = cells.groupBy(*by, "bucket").agg(
        *[F.sum(c).alias(c) for c in _SUMS],
        F.sum(F.when(delivered, F.col("lines"))).alias("delivered_lines"),
        F.sum(F.when(delivered, F.col("delayed_lines"))).alias("delayed_delivered"),
        F.bitmap_count(F.bitmap_or_agg("orders")).alias("total_orders"),
        F.bitmap_count(F.bitmap_or_agg("delayed_orders")).alias("delayed_once"),
    )
    sums = [c for c in merged.columns if c not in (*by, "bucket")]
    return merged.groupBy(*by).agg(*[F.sum(c).alias(c) for c in sums])


def cube_kpis(cells):
    """executive_kpis of a slice."""
    sums = _orders_of(cells).withColumnsRenamed({"revenue": "gmv", "delayed_lines": "delayed"})
    return kpi_row(sums.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("total_orders", "delayed_once")}))


def cube_monthly_gmv(cells, canceled=True):
    """monthly_gmv of a slice, with its distinct orders."""
    chosen = cells if canceled else cells.where(_not_canceled())
    return (
        _orders_of(chosen.where(F.col("order_year").isNotNull()), "order_year", "order_month")
        .select(
            "order_year", "order_month", F.col("revenue").cast("double").alias("payment_value"),
            period_label(F.col("order_year"), F.col("order_month")).alias("period"), "total_orders",
        )
        .orderBy("order_year", "order_month")
    )


def _not_canceled():
    return F.col("order_status").isNull() | (F.col("order_status") != "canceled")


def cube_delay_rate_by_state(cells):
    """delay_rate_by_state of a slice."""
    known = cells.where((F.col("order_status") == "delivered") & F.col("customer_state").isNotNull())
    return (
        known.groupBy("customer_state").agg(F.sum("lines").alias("total"), F.sum("delayed_lines").alias("delayed"))
        .withColumn("delay_rate", ratio(F.col("delayed"), F.col("total")) * 100)
    )


def cube_top_categories(cells, n=8):
    """top_categories of a slice, with the distinct orders of each category."""
    known = cells.where(F.col("product_category_name").isNotNull())
    return (
        _orders_of(known, "product_category_name")
        .select("product_category_name", F.col("revenue").cast("double").alias("payment_value"), "total_orders")
        .orderBy(F.desc("payment_value"), "product_category_name")
        .limit(n)
    )
