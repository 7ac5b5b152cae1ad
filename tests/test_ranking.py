import bisect

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallylake.operators import ranking
from tallylake.operators.ranking import (
    bucket_by_position,
    equal_width_positions,
    exact_percentiles,
    global_row_number,
    ntile_positions,
    values_at,
)


@pytest.fixture(scope="module")
def skewed(spark):
    """2000 rows; a third share one value."""
    value = F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(500)))
    return spark.range(2000).select(F.sha1(F.col("id").cast("string")).alias("id"), value.alias("value")).cache()


@pytest.fixture(params=["plain", "narrowed", "missed"])
def passes(request, monkeypatch):
    """As it is; with a pass that narrows brackets; with sketches and brackets so poor that places are missed."""
    if request.param != "plain":
        monkeypatch.setattr(ranking, "MOST_VALUES", 5)
    if request.param == "missed":
        monkeypatch.setattr(ranking, "SKETCH_K", 8)
        monkeypatch.setattr(ranking, "MARGIN", 1e-9)
        monkeypatch.setattr(ranking, "MOST_VALUES", 300)


@pytest.mark.parametrize("prefix", ["", "person-of-a-long-name-"])
def test_global_row_number(spark, skewed, prefix):
    named = skewed.select(F.concat(F.lit(prefix), "id").alias("id"))
    got = global_row_number(named, "id", "rank").toPandas().sort_values("rank")
    assert got["rank"].tolist() == list(range(1, 2001))
    assert got["id"].is_monotonic_increasing


def test_global_row_number_of_odd_keys(spark):
    for keys in ([], ["a"], ["", None, "b"], ["é", "z", "a", "ab", "abc", "abcd", "ab\u4e2d"]):
        got = global_row_number(spark.createDataFrame([(k,) for k in keys], "k string"), "k", "n").collect()
        assert sorted((r.n, r.k) for r in got) == list(enumerate(sorted(keys, key=lambda k: (k or "").encode() if k is not None else b"" ), 1)) or None in keys
        assert sorted(r.n for r in got) == list(range(1, len(keys) + 1))
    assert {r.k: r.n for r in got} == {"a": 1, "ab": 2, "abc": 3, "abcd": 4, "ab\u4e2d": 5, "z": 6, "é": 7}


def test_row_numbers_need_no_single_task_sort(spark, skewed):
    plan = global_row_number(skewed.select("id"), "id", "rank")._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [row_number" in line]
    assert windows and all("_head" in line for line in windows)


@pytest.mark.parametrize("fraction", [0.0, 0.25, 0.333, 0.5, 0.95, 0.98, 1.0])
def test_exact_percentiles(skewed, passes, fraction):
    values = skewed.toPandas()["value"]
    got = exact_percentiles(skewed, {"value": [fraction]})["value"][0]
    assert got == pytest.approx(np.percentile(values, fraction * 100))


def test_percentiles_of_nothing(spark):
    empty = spark.createDataFrame([(None, 1.0)], "v double, w double")
    assert exact_percentiles(empty, {"v": [0.25, 0.75], "w": [0.5]}) == {"v": [None, None], "w": [1.0]}


def test_values_between_heavy_ends(spark, passes):
    """Two values hold nearly all rows; the place lies among the few between them, or at their edges."""
    values = [1.0] * 700 + [1 + i / 100 for i in range(1, 41)] + [2.0] * 700
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    for place in (0, 699, 700, 720, 739, 740, 1439):
        value, before, ties, n = values_at(df, {"x": (F.col("v"), lambda _: place)})[0]["x"]
        assert (value, before, ties, n) == (values[place], values.index(values[place]), values.count(values[place]), 1440)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 50])
def test_positions_match_quantile_cut_and_ntile(spark, n):
    df = spark.range(n).select((F.col("id") % 3).alias("value"), F.format_string("%03d", "id").alias("id"))
    order = (F.col("value"), F.col("id"))
    got, _ = bucket_by_position(df, {"cut": order}, equal_width_positions, [1, 2, 3, 4])
    got, _ = bucket_by_position(got, {"tile": order}, ntile_positions, [1, 2, 3, 4])
    got = got.toPandas().sort_values(["value", "id"])
    ends = [1 + (n - 1) * quarter // 4 for quarter in (1, 2, 3)] + [n]
    assert got["cut"].tolist() == [bisect.bisect_left(ends, place) + 1 for place in range(1, n + 1)]
    size, extra = divmod(n, 4)
    tiles = [t for t in range(1, 5) for _ in range(size + (t <= extra))]
    assert got["tile"].tolist() == tiles


@pytest.mark.parametrize("prefix", ["", "a prefix longer than six bytes "])
def test_ties_are_cut_by_text(spark, passes, prefix):
    """All rows tie in the number; texts differ after twenty bytes only, or by length."""
    texts = [f"{prefix}{'k' * 20}{i:03d}" for i in range(90)] + [f"{prefix}k", f"{prefix}{'k' * 20}"]
    df = spark.createDataFrame([(5, t) for t in texts], "n int, t string").repartition(3)
    got, found = bucket_by_position(df, {"tile": (F.col("n"), F.col("t"))}, ntile_positions, [1, 2, 3, 4], {"n": [0.5]})
    ordered = [r.tile for r in sorted(got.collect(), key=lambda r: r.t)]
    assert ordered == [t for t in (1, 2, 3, 4) for _ in range(23)] and found == {"n": [5.0]}
