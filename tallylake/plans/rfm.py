"""Recency, frequency and monetary value per person, quartile scores and segments."""

import sys

from pyspark.sql import functions as F

from tallylake.functions.expressions import MICROS_PER_DAY, micros_between
from tallylake.operators.ranking import bucket_by_position, equal_width_positions, ntile_positions
from tallylake.operators.shared_tables import materialize
from tallylake.plans.gold import payment_totals
from tallylake.schemas import GOLD


def _bought():
    return F.col("order_purchase_timestamp")


def _per_person(orders, customers, payments):
    """Last purchase, orders and spend per person; spend is null when none of the orders was paid.

    orders has one row per order_id, so counts add up. They are summed per customer before the join, which leaves
    one row per customer on both sides however many orders one customer has.
    """
    per_customer = (
        orders.join(payment_totals(payments), "order_id", "left")
        .groupBy("customer_id")
        .agg(
            F.max(_bought()).alias("last_purchase"),
            F.count("order_id").alias("order_count"),
            F.sum("order_payment").alias("spend"),
        )
    )
    people = customers.where(F.col("customer_unique_id").isNotNull()).select("customer_id", "customer_unique_id")
    return (
        per_customer.join(people, "customer_id")
        .groupBy("customer_unique_id")
        .agg(
            F.max("last_purchase").alias("last_purchase"),
            F.sum("order_count").alias("frequency_orders"),
            F.sum("spend").cast("decimal(28,2)").alias("spend"),
        )
    )


def rfm_base(orders, customers, payments, snapshot=None):
    """Whole days since the last purchase, number of orders and total spend per person.

    The snapshot is a timestamp column or literal; by default one day after the newest order of all.
    """
    if snapshot is None:
        snapshot = orders.agg((F.max(_bought()) + F.expr("INTERVAL 1 DAY")).alias("snapshot")).scalar()
    days = F.floor(micros_between(F.col("last_purchase"), snapshot) / F.lit(float(MICROS_PER_DAY)))
    return _per_person(orders, customers, payments).select(
        "customer_unique_id",
        days.cast("int").alias("recency_days"),
        "frequency_orders",
        F.coalesce("spend", F.lit(0)).cast("decimal(28,2)").alias("monetary_spend"),
    )


def segment(r, f, m):
    """Segment of a score triple; the first rule that holds wins."""
    return (
        F.when((r >= 3) & (f >= 3) & (m >= 3), "Champions")
        .when((r >= 3) & (f >= 2), "Loyal Customers")
        .when(r >= 3, "Recent Customers")
        .when((r <= 2) & (f >= 3), "At Risk")
        .when((r <= 2) & (f <= 2), "Hibernating")
        .otherwise("Promising")
    )


def four_way_segment(r, f):
    """The coarser rule set of the NTILE variant."""
    return (
        F.when((r >= 3) & (f >= 3), "Champions")
        .when((r >= 3) & (f >= 2), "Loyal Customers")
        .when(r <= 2, "At Risk")
        .otherwise("Standard")
    )


def _code():
    return F.concat(*[F.col(c).cast("string") for c in ("r_score", "f_score", "m_score")])


def rfm_features(orders, customers, payments, snapshot=None):
    """RFM features with scores 1..4 (4 is best), their code and the segment of each person.

    Recency is cut at its quartile values; frequency and spend at quartile positions in the order (value, person),
    so equal values may fall on both sides of a cut. The base is written once because several passes read it.
    """
    base = materialize(rfm_base(orders, customers, payments, snapshot), "rfm")
    person = F.col("customer_unique_id")
    by_position = {"f_score": (F.col("frequency_orders"), person), "m_score": (F.col("monetary_spend"), person)}
    quartiles = {"recency_days": [0.25, 0.5, 0.75]}
    scored, found = bucket_by_position(base, by_position, equal_width_positions, [1, 2, 3, 4], quartiles)
    low, middle, high = (F.lit(q).cast("double") for q in found["recency_days"])
    recency = F.col("recency_days")
    r_score = F.when(recency <= low, 4).when(recency <= middle, 3).when(recency <= high, 2).otherwise(1)
    return (
        scored.withColumn("r_score", r_score)
        .withColumn("rfm_combined_score", _code())
        .withColumn("customer_segment", segment(F.col("r_score"), F.col("f_score"), F.col("m_score")))
        .select(*GOLD["features_customer_rfm"])
    )


def rfm_features_ntile(orders, customers, payments, snapshot=None, best_is_four=True):
    """RFM features scored by NTILE(4) with the four-way segments. Equal values are put in order by person.

    Recency counts calendar days up to the snapshot date, by default the day after the newest order; spend is null
    for a person without any payment. With best_is_four=False the tiles run the other way (newest, most frequent and
    highest spender get 1) while the segment rules still read a high score as good.
    """
    if snapshot is None:
        snapshot = orders.agg(F.date_add(F.to_date(F.max(_bought())), 1).alias("snapshot")).scalar()
    people = _per_person(orders, customers, payments).select(
        "customer_unique_id",
        F.date_diff(snapshot, F.col("last_purchase")).alias("recency_days"),
        "frequency_orders",
        F.col("spend").alias("monetary_spend"),
    )
    base = materialize(people, "rfm-ntile")

    def order(value, descending):
        # Persons without a value come first in ascending and last in descending order.
        number = -F.col(value).cast("double") if descending else F.col(value).cast("double")
        missing = sys.float_info.max if descending else -sys.float_info.max
        return F.coalesce(number, F.lit(missing)), F.col("customer_unique_id")

    orders_of = {
        "r_score": order("recency_days", best_is_four),
        "f_score": order("frequency_orders", not best_is_four),
        "m_score": order("monetary_spend", not best_is_four),
    }
    scored, _ = bucket_by_position(base, orders_of, ntile_positions, [1, 2, 3, 4])
    return scored.withColumn("rfm_score", _code()).withColumn(
        "segment", four_way_segment(F.col("r_score"), F.col("f_score"))
    )
