"""Bronze to Silver: typed, deduplicated, valid rows."""

from pyspark.sql import functions as F

from tallylake.functions.expressions import as_type, days_between
from tallylake.operators.dedup import POSITION, first_per_key
from tallylake.schemas import KEYS, ORDER_TIMESTAMPS, RAW


def _typed(raw, table):
    """Cast every raw column to its Silver type; columns outside the table are kept as they are."""
    types = RAW[table]
    return raw.select(*[as_type(F.col(c), types[c]).alias(c) if c in types else c for c in raw.columns])


def clean_customers(raw, order_by=()):
    """First row per customer_id, zip code 0 where missing."""
    unique = _typed(first_per_key(raw, KEYS["customers"], order_by), "customers")
    return unique.withColumn(
        "customer_zip_code_prefix", F.coalesce("customer_zip_code_prefix", F.lit(0))
    ).select(*RAW["customers"])


def clean_products(raw):
    """Every product, category 'unlabeled' where missing."""
    return (
        _typed(raw, "products")
        .withColumn("product_category_name", F.coalesce("product_category_name", F.lit("unlabeled")))
        .select(*RAW["products"])
    )


def clean_orders(raw, order_by=(), whole_days=False):
    """First row per order_id with parsed timestamps, delivery durations, delay flag and partition columns.

    Durations are elapsed days with their fraction, or with whole_days the number of calendar days in between.
    """
    between = days_between if not whole_days else lambda start, end: F.date_diff(end, start)
    orders = _typed(first_per_key(raw, KEYS["orders"], order_by), "orders").select(*RAW["orders"])
    bought, arrived, promised = (
        F.col(c)
        for c in (ORDER_TIMESTAMPS[0], "order_delivered_customer_date", "order_estimated_delivery_date")
    )
    return orders.withColumns(
        {
            "actual_delivery_days": between(bought, arrived),
            "estimated_delivery_days": between(bought, promised),
            "is_delayed": F.when(arrived > promised, 1).otherwise(0),
            "order_year": F.year(bought),
            "order_month": F.month(bought),
        }
    )


def clean_order_items(raw):
    """Typed lines; every row stays."""
    return _typed(raw.drop(POSITION), "order_items").select(*RAW["order_items"])


def clean_payments(raw):
    """Payments with a value of zero or more; negative, missing and unreadable values are dropped."""
    typed = _typed(raw.drop(POSITION), "order_payments").select(*RAW["order_payments"])
    return typed.where(F.col("payment_value") >= 0)
