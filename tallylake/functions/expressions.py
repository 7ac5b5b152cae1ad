"""Column expressions shared by the plans. All are built-in Spark functions."""

from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000

# The texts that pandas reads as missing in a CSV field, besides the empty field.
MISSING_TEXT = [
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def missing_to_null(column):
    return F.when(~column.isin(MISSING_TEXT), column)


def as_type(column, dtype):
    """Cast that yields null for a bad value, whatever the ANSI setting."""
    if dtype == "int":
        # Through double, so that "1310", "01310" and "1310.0" all read as 1310.
        return column.try_cast("double").try_cast("int")
    return column.try_cast(dtype)


def micros_between(start, end):
    return F.timestamp_diff("MICROSECOND", start, end)


def days_between(start, end):
    """Elapsed days with their fraction."""
    return micros_between(start, end) / F.lit(float(MICROS_PER_DAY))


def days_as_micros(days):
    """Whole microseconds of a day count: a decimal, so sums of it are exact in any order and of any number of rows."""
    return F.round(days * F.lit(float(MICROS_PER_DAY))).cast("bigint").cast("decimal(38,0)")


def round_dp(column, places):
    """Round a double half away from zero after scaling, as SQL engines on binary doubles do."""
    scale = F.lit(float(10**places))
    return F.round(column.cast("double") * scale) / scale


def ratio(numerator, denominator):
    """numerator / denominator as double; null when the denominator is zero or null."""
    bottom = denominator.cast("double")
    return F.when(bottom != 0, numerator.cast("double") / bottom)


def date_key(timestamp):
    """yyyymmdd as int; 0 for a missing date."""
    key = F.year(timestamp) * 10000 + F.month(timestamp) * 100 + F.day(timestamp)
    return F.coalesce(key, F.lit(0)).cast("int")


def period_label(year, month):
    return F.format_string("%d-%02d", year, month)


def percent_text(rate, places):
    return F.format_string(f"%.{places}f%%", rate * 100)
