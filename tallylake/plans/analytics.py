"""Business questions over Gold.

Functions over orders take order_totals / totals_from_fact (one row per order with line_count, line_revenue,
freight_value, ...). Counting lines or summing payments per line then means summing per-order totals, so no question
shuffles lines and an order with very many lines is one row. Sums run over decimals and whole microseconds: the
result does not depend on how the data is partitioned.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallylake.functions.expressions import MICROS_PER_DAY, days_as_micros, period_label, ratio, round_dp
from tallylake.operators.shared_tables import materialize


def _lines():
    return F.col("line_count")


def _not_canceled():
    return F.col("order_status") != "canceled"


def _delivered():
    return F.col("order_status") == "delivered"


def _month_order():
    """Orders without a readable time form a last month of their own, which precedes none."""
    return [F.asc_nulls_last("order_year"), F.asc_nulls_last("order_month")]


def _months():
    """One row per calendar month reaches this window."""
    return Window.orderBy(*_month_order())


def select_lines(df, states=None, years=None, months=None, categories=None, statuses=None):
    """Dashboard slicers. A slicer that is None or empty does not filter."""
    slicers = {
        "customer_state": states, "order_year": years, "order_month": months,
        "product_category_name": categories, "order_status": statuses,
    }
    for column, chosen in slicers.items():
        if chosen:
            df = df.where(F.col(column).isin(list(chosen)))
    return df


def _monthly(totals, revenue, per):
    return (
        totals.where(_not_canceled())
        .groupBy("order_year", "order_month")
        .agg(F.count("order_id").alias("total_orders"), F.sum(revenue).alias("revenue"), F.sum(per).alias("units"))
    )


def _with_growth(monthly, exact):
    """Previous month and growth; exact compares unrounded revenue, else the revenue rounded to cents."""
    base = F.col("revenue").cast("double") if exact else round_dp(F.col("revenue"), 2)
    previous = F.lag("base", 1).over(_months())
    growth = F.when(F.col("previous") != 0, (F.col("base") - F.col("previous")) / F.col("previous") * 100)
    return (
        monthly.withColumn("base", base)
        .withColumn("previous", previous)
        .select(
            "order_year",
            "order_month",
            "total_orders",
            round_dp(F.col("revenue"), 2).alias("total_revenue"),
            round_dp(ratio(F.col("revenue"), F.col("units")), 2).alias("avg_order_value"),
            round_dp(F.col("previous"), 2).alias("prev_month_revenue"),
            round_dp(growth, 2).alias("mom_growth_pct"),
        )
        .orderBy(*_month_order())
    )


def mom_revenue(totals):
    """Orders, revenue, average line payment, previous month and growth % per month, without canceled orders.

    An order's payment counts once per line, as the fact's payment_value does.
    """
    return _with_growth(_monthly(totals, "line_revenue", "line_count"), exact=False)


def mom_revenue_unrounded(totals):
    """mom_revenue with the growth taken from unrounded revenue and without the average."""
    return _with_growth(_monthly(totals, "line_revenue", "line_count"), exact=True).drop("avg_order_value")


def mom_revenue_order_grain(totals):
    """mom_revenue with each payment counted once, so that the average is per order."""
    return _with_growth(_monthly(totals, "order_revenue", F.lit(1)), exact=False)


def monthly_gmv(totals, canceled=True):
    """Revenue per month with a YYYY-MM label; canceled=False leaves canceled orders out."""
    chosen = totals if canceled else totals.where(F.col("order_status").isNull() | _not_canceled())
    return (
        chosen.where(F.col("order_year").isNotNull())
        .groupBy("order_year", "order_month")
        .agg(F.sum("line_revenue").cast("double").alias("payment_value"))
        .withColumn("period", period_label(F.col("order_year"), F.col("order_month")))
        .orderBy("order_year", "order_month")
    )


def delivery_sla_by_state(totals, customers, key="customer_key", min_lines=20, worst=None):
    """Lines delivered, average days, delayed lines and share, average freight per state, worst share first.

    States with fewer than min_lines lines are left out; worst keeps that many states. Orders are summed per
    customer before the join, so a customer with very many orders is one row in it.
    """
    with_days = F.when(F.col("actual_delivery_days").isNotNull(), _lines())
    per_customer = (
        totals.where(_delivered())
        .groupBy(key)
        .agg(
            F.sum(_lines()).alias("lines"),
            F.sum(with_days).alias("lines_with_days"),
            F.sum(days_as_micros(F.col("actual_delivery_days")) * _lines()).alias("micros"),
            F.sum(F.col("is_delayed") * _lines()).alias("delayed"),
            F.sum("freight_value").alias("freight"),
        )
    )
    per_state = (
        per_customer.join(customers.select(key, "customer_state"), key)
        .groupBy("customer_state")
        .agg(*[F.sum(c).alias(c) for c in ("lines", "lines_with_days", "micros", "delayed", "freight")])
        .where(F.col("lines") >= min_lines)
        .select(
            "customer_state",
            F.col("lines").alias("total_deliveries"),
            round_dp(ratio(F.col("micros"), F.col("lines_with_days")) / MICROS_PER_DAY, 1).alias("avg_delivery_days"),
            F.col("delayed").alias("delayed_orders"),
            round_dp(ratio(F.col("delayed"), F.col("lines")) * 100, 2).alias("delay_pct"),
            round_dp(ratio(F.col("freight"), F.col("lines")), 2).alias("avg_freight"),
        )
        .orderBy(F.desc("delay_pct"), "customer_state")
    )
    return per_state if worst is None else per_state.limit(worst)


def delay_rate_by_state(totals, customers, key="customer_key"):
    """Delivered lines, delayed lines and delay rate in percent per state."""
    per_customer = (
        totals.where(_delivered())
        .groupBy(key)
        .agg(F.sum(_lines()).alias("total"), F.sum(F.col("is_delayed") * _lines()).alias("delayed"))
    )
    return (
        per_customer.join(customers.select(key, "customer_state"), key, "left")
        .where(F.col("customer_state").isNotNull())
        .groupBy("customer_state")
        .agg(F.sum("total").alias("total"), F.sum("delayed").alias("delayed"))
        .withColumn("delay_rate", ratio(F.col("delayed"), F.col("total")) * 100)
    )


def top_categories_per_state(lines, customers, products, k=3, customer_key="customer_key", product_key="product_key"):
    """The k best ranks of product categories by revenue in each state; ties share a rank.

    Lines are summed per (customer, product) before they meet the products, per (customer, category) before they meet
    the customers.
    """
    sums = lambda df, *by: df.groupBy(*by).agg(
        F.sum("revenue").alias("revenue"), F.sum("items_sold").alias("items_sold")
    )
    sold = lines.select(
        customer_key, product_key, F.col("payment_value").alias("revenue"), F.lit(1).cast("bigint").alias("items_sold")
    )
    per_product = sums(sold, customer_key, product_key)
    categories = products.select(product_key, "product_category_name")
    per_customer = sums(per_product.join(categories, product_key), customer_key, "product_category_name")
    per_state = (
        per_customer.join(customers.select(customer_key, "customer_state"), customer_key)
        .groupBy("customer_state", "product_category_name")
        .agg(F.sum("revenue").alias("revenue"), F.sum("items_sold").alias("items_sold"))
    )
    rank = F.dense_rank().over(Window.partitionBy("customer_state").orderBy(F.desc("revenue")))
    return (
        per_state.withColumn("rank_in_state", rank)
        .where(F.col("rank_in_state") <= k)
        .select(
            "customer_state",
            "rank_in_state",
            "product_category_name",
            F.col("revenue").cast("double").alias("category_revenue"),
            "items_sold",
        )
        .orderBy("customer_state", "rank_in_state", "product_category_name")
    )


def top_categories(lines, products, n=8, key="product_key"):
    """The n product categories with the highest revenue. Lines are summed per product before the join."""
    per_product = lines.groupBy(key).agg(F.sum("payment_value").alias("revenue"))
    return (
        per_product.join(products.select(key, "product_category_name"), key, "left")
        .where(F.col("product_category_name").isNotNull())
        .groupBy("product_category_name")
        .agg(F.sum("revenue").cast("double").alias("payment_value"))
        .orderBy(F.desc("payment_value"), "product_category_name")
        .limit(n)
    )


def enriched_lines(lines, customers, products, customer_key="customer_key", product_key="product_key"):
    """Lines left-joined with the customer's state and city and the product's category: the dashboard's base."""
    places = customers.select(customer_key, "customer_state", "customer_city")
    categories = products.select(product_key, "product_category_name")
    return lines.join(places, customer_key, "left").join(categories, product_key, "left")


def executive_kpis(totals):
    """One row: revenue, orders, average order value, and on-time rates over three different bases.

    on_time_pct counts delivered lines (100 if none); on_time_rate_per_order sets delayed lines against distinct orders
    and can be negative; on_time_pct_orders counts each order once.
    """
    delivered_lines = F.sum(F.when(_delivered(), _lines()).otherwise(0))
    delayed_delivered = F.sum(F.when(_delivered(), F.col("is_delayed") * _lines()).otherwise(0))
    sums = totals.agg(
        F.sum("line_revenue").alias("gmv"),
        F.count("order_id").alias("total_orders"),
        delivered_lines.alias("delivered_lines"),
        delayed_delivered.alias("delayed_delivered"),
        F.sum(F.col("is_delayed") * _lines()).alias("delayed"),
        F.sum("is_delayed").alias("delayed_once"),
    )
    return kpi_row(sums)


def kpi_row(sums):
    """The key figures from gmv, total_orders, delivered_lines, delayed_delivered, delayed and delayed_once."""
    orders, delayed = F.col("total_orders"), F.coalesce("delayed", F.lit(0))
    return sums.select(
        F.coalesce(F.col("gmv").cast("double"), F.lit(0.0)).alias("gmv"),
        "total_orders",
        F.coalesce(ratio(F.col("gmv"), orders), F.lit(0.0)).alias("aov"),
        F.coalesce(
            (1 - ratio(F.col("delayed_delivered"), F.col("delivered_lines"))) * 100, F.lit(100.0)
        ).alias("on_time_pct"),
        delayed.alias("delayed_lines"),
        (1 - F.coalesce(ratio(delayed, orders), F.lit(0.0))).alias("on_time_rate_per_order"),
        ((1 - F.coalesce(ratio(F.col("delayed_once"), orders), F.lit(0.0))) * 100).alias("on_time_pct_orders"),
    )


def totals_from_lines(lines):
    """Order totals of selected enriched lines (after slicing by state, period or category)."""
    return lines.groupBy(
        "order_id", "order_status", "is_delayed", "actual_delivery_days", "order_year", "order_month"
    ).agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum("payment_value").cast("decimal(38,2)").alias("line_revenue"),
        F.sum("freight_value").alias("freight_value"),
    )


def status_share(totals):
    """Lines per order status and their share in percent. One row per status reaches the window."""
    counts = totals.where(F.col("order_status").isNotNull()).groupBy("order_status").agg(F.sum(_lines()).alias("lines"))
    whole = F.sum("lines").over(Window.partitionBy())
    return counts.withColumn("share_pct", round_dp(ratio(F.col("lines"), whole) * 100, 1)).orderBy(
        F.desc("lines"), "order_status"
    )


def on_time_counts(totals):
    """Delivered lines on time and delayed."""
    label = F.when(F.col("is_delayed") == 1, "Delayed").otherwise("On Time")
    return (
        totals.where(_delivered()).groupBy(label.alias("delivery")).agg(F.sum(_lines()).alias("lines"))
        .orderBy(F.desc("lines"), "delivery")
    )


def delivery_histogram(totals, bins=20):
    """Delivered lines per equal-width bin of delivery days, empty bins included, and the mean over all bins."""
    days = F.col("actual_delivery_days")
    delivered = totals.where(_delivered() & days.isNotNull()).groupBy(days).agg(F.sum(_lines()).alias("lines"))
    # The distinct durations are read twice: for their range, then per bin.
    delivered = materialize(delivered, "durations")
    low, high, micros, lines = delivered.agg(
        F.min(days), F.max(days), F.sum(days_as_micros(days) * F.col("lines")), F.sum("lines")
    ).first()
    if lines is None:
        low, high, mean = 0.0, 1.0, None
    else:
        mean = float(micros) / float(lines) / MICROS_PER_DAY
        if low == high:
            low, high = low - 0.5, high + 0.5
    bin_number = F.least(F.floor((days - low) / F.lit(high - low) * bins), F.lit(bins - 1)).cast("int") + 1
    counts = delivered.groupBy(bin_number.alias("bin")).agg(F.sum("lines").alias("lines"))
    width = F.lit(high - low) / bins
    all_bins = totals.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return all_bins.join(counts, "bin", "left").select(
        "bin",
        (F.lit(low) + width * (F.col("bin") - 1)).alias("from_days"),
        (F.lit(low) + width * F.col("bin")).alias("to_days"),
        F.coalesce("lines", F.lit(0)).cast("bigint").alias("lines"),
        F.lit(mean).cast("double").alias("mean_days"),
    )


def fact_by_calendar(totals, dates):
    """Orders, lines and revenue by quarter and weekend flag, through the date dimension's key.

    Orders without a readable time (date_key 0) have no calendar day: their group has null columns.
    """
    per_day = totals.groupBy("date_key").agg(
        F.count("order_id").alias("orders"), F.sum(_lines()).alias("lines"), F.sum("line_revenue").alias("revenue")
    )
    return (
        per_day.join(dates.select("date_key", "year", "quarter", "is_weekend"), "date_key", "left")
        .groupBy("year", "quarter", "is_weekend")
        .agg(
            F.sum("orders").alias("orders"),
            F.sum("lines").alias("lines"),
            F.sum("revenue").cast("double").alias("revenue"),
        )
    )


def segment_summary(features):
    """People, average recency and orders, revenue and average spend per segment, highest revenue first."""
    people = F.count("customer_unique_id")

    def average(column, places):
        return round_dp(ratio(F.sum(column), F.count(column)), places)

    return (
        features.groupBy("customer_segment")
        .agg(
            people.alias("customer_count"),
            average("recency_days", 1).alias("avg_recency_days"),
            average("frequency_orders", 2).alias("avg_orders"),
            F.sum("monetary_spend").cast("double").alias("total_segment_revenue"),
            average("monetary_spend", 2).alias("avg_clv"),
        )
        .orderBy(F.desc("total_segment_revenue"), "customer_segment")
    )


def segment_counts(features):
    """People per segment, largest first."""
    return (
        features.groupBy("customer_segment").agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "customer_segment")
    )


def rfm_scatter_sample(features, p98):
    """People whose spend lies below the given bound, with the columns of the recency/spend chart."""
    return features.where(F.col("monetary_spend").cast("double") < p98).select(
        "customer_unique_id", "customer_segment", "recency_days", "monetary_spend"
    )


def at_risk_top_spenders(features, n=10):
    """The n people of segment At Risk with the highest spend."""
    return (
        features.where(F.col("customer_segment") == "At Risk")
        .orderBy(F.desc("monetary_spend"), "customer_unique_id")
        .limit(n)
        .select("customer_unique_id", "recency_days", "frequency_orders", "monetary_spend")
    )


def preview(features, n=100):
    """The first n rows of the feature table by person."""
    return features.orderBy("customer_unique_id").limit(n)


def filter_options(df, column, n=None):
    """Distinct values of a slicer in order; n keeps the first n."""
    values = df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)
    return values if n is None else values.limit(n)


def cohort_retention(orders, customers):
    """People per first-order month and months since, and their share of the cohort.

    A person's set of order months is bounded by the calendar and is merged before the shuffle.
    """
    month = (F.col("order_year") * 12 + F.col("order_month") - 1).alias("month")
    people = customers.where(F.col("customer_unique_id").isNotNull()).select("customer_id", "customer_unique_id")
    active = (
        orders.where(F.col("order_year").isNotNull())
        .select("customer_id", month)
        .distinct()
        .join(people, "customer_id")
        .groupBy("customer_unique_id")
        .agg(F.collect_set("month").alias("months"))
    )
    first = F.array_min("months")
    counts = (
        active.select(first.alias("first"), F.explode("months").alias("month"))
        .groupBy("first", (F.col("month") - F.col("first")).alias("months_since"))
        .agg(F.count(F.lit(1)).alias("customers"))
    )
    # One row per pair of months reaches this window.
    size = F.max(F.when(F.col("months_since") == 0, F.col("customers"))).over(Window.partitionBy("first"))
    return counts.withColumn("cohort_size", size).select(
        F.floor(F.col("first") / 12).cast("int").alias("cohort_year"),
        (F.col("first") % 12 + 1).cast("int").alias("cohort_month"),
        F.col("months_since").cast("int").alias("months_since"),
        "customers",
        "cohort_size",
        round_dp(ratio(F.col("customers"), F.col("cohort_size")) * 100, 2).alias("retention_pct"),
    )
