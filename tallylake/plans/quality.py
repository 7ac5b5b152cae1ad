"""Quality report, gate, outlier tags and drift."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallylake.functions.expressions import MICROS_PER_DAY, days_as_micros, percent_text, ratio, round_dp
from tallylake.operators.ranking import exact_percentiles
from tallylake.operators.shared_tables import materialize

# The names of the four tests in the report.
NULL_TEST = "Primary Key Null Rate (order_id)"
UNIQUE_TEST = "Order ID Uniqueness"
OUTLIER_TEST = "Payment Value Statistical Outlier Profile (IQR)"
SLA_TEST = "Delivery SLA Statistical Distribution"

MAX_MEAN_DELIVERY_DAYS = 25.0
_QUARTILES = [0.25, 0.75]


class QualityGateError(Exception):
    """A quality test failed and the caller asked to stop on failure."""


def percentiles(df, columns, approx=False):
    """{column: [float, ...]} for {column: fractions}: exact percentiles, or with approx those of approxQuantile."""
    if not approx:
        return exact_percentiles(df, columns)
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return {c: doubles.approxQuantile(c, f, 0.001) or [None] * len(f) for c, f in columns.items()}


def outlier_bounds(df, column, **options):
    """(q1, q3, lower, upper) by the 1.5 IQR rule, lower not below zero; four None without values."""
    return _bounds(*percentiles(df, {column: _QUARTILES}, **options)[column])


def _bounds(q1, q3):
    if q1 is None:
        return None, None, None, None
    spread = 1.5 * (q3 - q1)
    return q1, q3, max(0.0, q1 - spread), q3 + spread


def _is_outlier(column, low, high):
    value = F.col(column).cast("double")
    return (value < F.lit(low).cast("double")) | (value > F.lit(high).cast("double"))


def tag_outliers(df, column, **options):
    """Add is_outlier (0/1) and the bounds it was judged by."""
    _, _, low, high = outlier_bounds(df, column, **options)
    return df.withColumns(
        {
            "is_outlier": F.when(_is_outlier(column, low, high), 1).otherwise(0),
            "lower_bound": F.lit(low).cast("double"),
            "upper_bound": F.lit(high).cast("double"),
        }
    )


def _rows(df, passed, metrics):
    """Turn one row of metrics into (test, metric, value, passed) rows. metrics: [(test, metric, column)]."""
    entries = [
        F.struct(
            F.lit(test).alias("test"),
            F.lit(metric).alias("metric"),
            column.cast("double").alias("value"),
            passed[test].alias("passed"),
        )
        for test, metric, column in metrics
    ]
    return df.select(F.inline(F.array(*entries)))


def quality_report(orders, payments, **options):
    """The four quality tests as rows (test, metric, value, passed). One aggregate pass per table plus percentiles.

    Both tables' percentiles come from the same two passes over their values, one above the other.
    """
    durations = orders.select("actual_delivery_days", F.lit(None).cast("double").alias("payment_value"))
    amounts = payments.select(F.lit(None).cast("double"), F.col("payment_value").cast("double"))
    wanted = {"actual_delivery_days": [0.95], "payment_value": _QUARTILES}
    found = percentiles(durations.unionAll(amounts), wanted, **options)
    (p95,), (q1, q3, low, high) = found["actual_delivery_days"], _bounds(*found["payment_value"])
    days = F.col("actual_delivery_days")
    order_stats = orders.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("order_id").isNull()).alias("nulls"),
        F.count_distinct("order_id").alias("distinct_ids"),
        F.sum(days_as_micros(days)).alias("micros"),
        F.count(days).alias("delivered"),
        F.stddev_samp(days).alias("std"),
        F.coalesce(F.sum("is_delayed"), F.lit(0)).alias("delayed"),
    )
    mean_days = ratio(F.col("micros"), F.col("delivered")) / MICROS_PER_DAY
    total = F.col("total")
    order_rows = _rows(
        order_stats,
        {
            NULL_TEST: F.col("nulls") == 0,
            UNIQUE_TEST: F.col("distinct_ids") == total,
            SLA_TEST: F.coalesce(mean_days < MAX_MEAN_DELIVERY_DAYS, F.lit(False)),
        },
        [
            (NULL_TEST, "null_count", F.col("nulls")),
            (NULL_TEST, "null_rate", ratio(F.col("nulls"), total)),
            (UNIQUE_TEST, "total_records", total),
            (UNIQUE_TEST, "unique_records", F.col("distinct_ids")),
            (SLA_TEST, "mean_delivery_days", round_dp(mean_days, 2)),
            (SLA_TEST, "std_dev_delivery_days", round_dp(F.col("std"), 2)),
            (SLA_TEST, "p95_delivery_days", round_dp(F.lit(p95), 2)),
            (SLA_TEST, "delayed_orders_count", F.col("delayed")),
            (SLA_TEST, "delayed_orders_rate", ratio(F.col("delayed"), total)),
        ],
    )
    payment_stats = payments.agg(
        F.count("payment_value").alias("total"),
        F.count_if(_is_outlier("payment_value", low, high)).alias("outliers"),
    )
    spread = None if q1 is None else q3 - q1
    payment_rows = _rows(
        payment_stats,
        {OUTLIER_TEST: F.lit(True)},
        [
            (OUTLIER_TEST, "q1_25th_percentile", round_dp(F.lit(q1), 2)),
            (OUTLIER_TEST, "q3_75th_percentile", round_dp(F.lit(q3), 2)),
            (OUTLIER_TEST, "iqr", round_dp(F.lit(spread), 2)),
            (OUTLIER_TEST, "statistical_upper_bound", round_dp(F.lit(high), 2)),
            (OUTLIER_TEST, "outlier_count", F.col("outliers")),
            (OUTLIER_TEST, "outlier_percentage", ratio(F.col("outliers"), total)),
        ],
    )
    return order_rows.unionByName(payment_rows)


# Test -> metric -> how the document shows it: a count, a number, or a percent text with so many decimals.
_SHOWN = {
    NULL_TEST: {"null_count": "count", "null_rate": 4},
    UNIQUE_TEST: {"total_records": "count", "unique_records": "count"},
    OUTLIER_TEST: {
        "q1_25th_percentile": "number", "q3_75th_percentile": "number", "iqr": "number",
        "statistical_upper_bound": "number", "outlier_count": "count", "outlier_percentage": 2,
    },
    SLA_TEST: {
        "mean_delivery_days": "number", "std_dev_delivery_days": "number", "p95_delivery_days": "number",
        "delayed_orders_count": "count", "delayed_orders_rate": 2,
    },
}


def _shown(metric, kind):
    value = F.max(F.when(F.col("metric") == metric, F.col("value")))
    if kind == "number":
        return value
    return value.cast("bigint") if kind == "count" else percent_text(value, kind)


def report_document(report, timestamp=None):
    """The report as one row (timestamp, status, tests); a test's foreign metrics are null, which JSON leaves out."""
    kinds = {metric: kind for metrics in _SHOWN.values() for metric, kind in metrics.items()}
    values = {metric: _shown(metric, kind) for metric, kind in kinds.items()}
    verdicts = {test: F.bool_and(F.when(F.col("test") == test, F.col("passed"))) for test in _SHOWN}
    summary = report.agg(
        F.bool_and("passed").alias("all_passed"),
        *[value.alias(metric) for metric, value in values.items()],
        *[verdict.alias(test) for test, verdict in verdicts.items()],
    )
    tests = [
        F.struct(
            F.lit(test).alias("name"),
            *[F.when(F.lit(metric in metrics), F.col(metric)).alias(metric) for metric in kinds],
            F.col(f"`{test}`").alias("passed"),
        )
        for test, metrics in _SHOWN.items()
    ]
    written = F.current_timestamp() if timestamp is None else F.lit(timestamp)
    return summary.select(
        written.cast("string").alias("timestamp"),
        F.when(F.col("all_passed"), "PASSED").otherwise("FAILED").alias("status"),
        F.array(*tests).alias("tests"),
    )


def document_schema():
    """The schema of a stored report document; percentages are texts."""
    kinds = {metric: kind for metrics in _SHOWN.values() for metric, kind in metrics.items()}
    types = {"count": "bigint", "number": "double"}
    metrics = ", ".join(f"{metric}: {types.get(kind, 'string')}" for metric, kind in kinds.items())
    return f"timestamp string, status string, tests array<struct<name: string, {metrics}, passed: boolean>>"


def document_lines(document):
    """(status, test, metric, shown, passed) of stored documents: each metric that a test has, as the document shows it."""
    kinds = {metric for metrics in _SHOWN.values() for metric in metrics}
    tests = document.select("status", F.explode("tests").alias("t"))
    shown = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"t.{m}").cast("string").alias("shown")) for m in sorted(kinds)])
    lines = tests.select("status", F.col("t.name").alias("test"), F.col("t.passed").alias("passed"), F.inline(shown))
    return lines.where(F.col("shown").isNotNull())


def gate_verdict(report):
    """One row: status, number of tests and of failed ones, and the failed ones' names."""
    tests = report.groupBy("test").agg(F.bool_and("passed").alias("passed"))
    failed = F.sort_array(F.collect_list(F.when(~F.col("passed"), F.col("test"))))  # one row per test
    return tests.agg(
        F.when(F.bool_and("passed"), "PASSED").otherwise("FAILED").alias("status"),
        F.count(F.lit(1)).alias("tests"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.array_join(failed, ", ").alias("failed_tests"),
    )


def check_gate(report, fail_on_error=False):
    """True when every test passed. With fail_on_error a failure raises instead."""
    failed = [row["test"] for row in report.where(~F.col("passed")).select("test").distinct().collect()]
    if failed and fail_on_error:
        raise QualityGateError(", ".join(sorted(failed)))
    return not failed


_BINS = 10


def drift_report(df, column, baseline=None, **options):
    """Rows, mean, deviation, null rate and population stability index of a column per order month.

    The index compares the month's shares of the decile bins of the baseline month, by default the first one; an
    empty bin counts as 1e-6. Months are summed in one aggregate; only month rows go further.
    """
    # Read three times below: the first month, the baseline's deciles, the months.
    dated = materialize(df.where(F.col("order_year").isNotNull()).select("order_year", "order_month", column), "drift")
    if baseline is None:
        first = dated.agg(F.min(F.struct("order_year", "order_month")).alias("m")).first()["m"]
        baseline = (first[0], first[1]) if first else (0, 0)
    year, month = baseline
    in_baseline = (F.col("order_year") == year) & (F.col("order_month") == month)
    cuts = percentiles(dated.where(in_baseline), {column: [i / _BINS for i in range(1, _BINS)]}, **options)[column]
    value = F.col(column).cast("double")
    bin_number = F.lit(_BINS - 1)
    for i, cut in reversed(list(enumerate(cuts))):
        bin_number = F.when(value <= F.lit(cut).cast("double"), i).otherwise(bin_number)
    binned = dated.withColumn("bin", F.when(value.isNotNull(), bin_number))
    monthly = binned.groupBy("order_year", "order_month").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count(value).alias("n"),
        F.sum(column).alias("total"),
        F.stddev_samp(value).alias("std"),
        *[F.count_if(F.col("bin") == i).alias(f"b{i}") for i in range(_BINS)],
    )
    floor = F.lit(1e-6)
    shares = monthly.withColumns({f"p{i}": F.greatest(ratio(F.col(f"b{i}"), F.col("n")), floor) for i in range(_BINS)})
    # One row per month reaches this window.
    months = Window.partitionBy()
    bases = {f"q{i}": F.max(F.when(in_baseline, F.col(f"p{i}"))).over(months) for i in range(_BINS)}
    terms = [(F.col(f"p{i}") - F.col(f"q{i}")) * F.log(F.col(f"p{i}") / F.col(f"q{i}")) for i in range(_BINS)]
    psi = sum(terms[1:], terms[0])
    return shares.withColumns(bases).select(
        "order_year",
        "order_month",
        "row_count",
        round_dp(ratio(F.col("total"), F.col("n")), 4).alias("mean"),
        round_dp(F.col("std"), 4).alias("std_dev"),
        round_dp(1 - ratio(F.col("n"), F.col("row_count")), 6).alias("null_rate"),
        round_dp(F.when(F.col("n") > 0, psi), 6).alias("psi"),
    )
