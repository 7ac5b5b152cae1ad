"""Places in a global order and exact percentiles without sorting a table, in the same way for every size of it.

Mergeable quantile sketches (KLL) bracket the wanted places. A pass then counts the rows below each bracket exactly and
the rows of each value inside it; where a bracket could hold too many values for that, passes narrow it first. Running
counts give the value at the place. Rows that tie there are told apart by the next column, in the same manner.

Sketches only choose what is counted; results come from counts, and a bracket that misses its place is widened. The
driver gets a sketch's quantiles and at most MOST_VALUES values per place.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallylake.operators.shared_tables import materialize

#: Size parameter of the sketches, and the ranks on each side of a place that a bracket spans: ten standard errors.
SKETCH_K = 4096
MARGIN = 0.005
#: Steps between the quantiles that are read from a sketch.
GRID = 1000
#: Values inside a bracket that are counted one by one.
MOST_VALUES = 20_000
#: Bytes of a text that make one number, and that group rows to be numbered.
_NUMBER_BYTES = 6
_HEAD_BYTES = 3


@dataclass
class _Search:
    """The search for one place: the value and the rows below it, once known, else the open interval that holds it."""

    place: int
    low: float = -math.inf
    high: float = math.inf
    below: int = 0
    rows: int = 0
    quantiles: list | None = None
    value: float | None = None
    ties: int = 0

    def bracket(self):
        """A closed bracket around the place by the sketch's quantiles; without a sketch, the whole interval."""
        if self.quantiles is None:
            return self.low, self.high
        rank = self.place - self.below
        low = math.floor((rank / self.rows - MARGIN) * GRID)
        high = math.ceil(((rank + 1) / self.rows + MARGIN) * GRID)
        return self.quantiles[max(0, low)], self.quantiles[min(GRID, high)]

    def settle(self, below, counts):
        """Take the value from counts of a bracket's values in order; False where the place lies outside them."""
        if below > self.place:
            return False
        for value, n in counts:
            if below + n > self.place:
                self.value, self.below, self.ties = value, below, n
                return True
            below += n
        return False


def _quantiles(column):
    grid = F.from_json(F.lit(str([i / GRID for i in range(GRID + 1)])), "array<double>")  # one literal for the planner
    return F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(column, F.lit(SKETCH_K)), grid)


def _narrow(df, columns, searches, brackets):
    """One pass: counts around the ends of the brackets, and sketches of what lies strictly between them."""
    sums = []
    for i, s in enumerate(searches):
        x, (low, high) = columns[i].cast("double"), brackets[i]
        between = F.when((x > low) & (x < high), x)
        sums += [F.count_if((x > s.low) & (x < low)), F.count_if(x == low), F.count(between),
                 F.count_if(x == high) if high > low else F.lit(0), F.when(F.count(between) > 0, _quantiles(between))]
    row = df.agg(*[c.alias(f"c{i}") for i, c in enumerate(sums)]).first()
    for i, s in enumerate(searches):
        less, lows, middle, highs, quantiles = row[5 * i:5 * i + 5]
        low, high = brackets[i]
        start = s.below + less
        if start <= s.place < start + lows:
            s.value, s.below, s.ties = low, start, lows
        elif start + lows <= s.place < start + lows + middle:
            s.low, s.high, s.below, s.rows, s.quantiles = low, high, start + lows, middle, quantiles
        elif start + lows + middle <= s.place < start + lows + middle + highs:
            s.value, s.below, s.ties = high, start + lows + middle, highs
        elif s.place < start:
            s.high, s.rows, s.quantiles = low, less, None
        else:
            end = start + lows + middle + highs
            s.low, s.rows, s.below, s.quantiles = high, s.rows - (end - s.below), end, None


def _count(df, columns, searches, brackets):
    """One pass: rows below each bracket and rows per value inside, of which the driver gets a bounded number."""
    entries = []
    for i, s in enumerate(searches):
        x, (low, high) = columns[i].cast("double"), brackets[i]
        entry = F.struct(F.lit(i).alias("i"), F.when(x >= low, x).alias("v"))
        entries.append(F.when((x > s.low) & (x <= high), entry))
    rows = df.select(F.explode(F.array(*entries)).alias("e")).where("e is not null")
    counts = {i: {} for i in range(len(searches))}
    for i, v, n in rows.groupBy("e.i", "e.v").agg(F.count(F.lit(1))).collect():
        counts[i][v] = n
    return [(s.below + counts[i].pop(None, 0), sorted(counts[i].items())) for i, s in enumerate(searches)]


def values_at(df, wanted, extra=()):
    """{name: (value, rows of smaller values, rows of the value, number of values)} at 0-based places, and a row of extra.

    wanted: {name: (numeric column, f)}; f(number of values) is the place. Nulls have no place, infinite values are not allowed; None without values.
    Values are told apart as doubles. extra: aggregates that the first pass takes along.
    """
    names, columns = list(wanted), [wanted[n][0] for n in wanted]
    same = {str(c): c for c in columns}  # places of one column share its sketch
    first = [a for c in same.values() for a in (F.count(c), F.when(F.count(c) > 0, _quantiles(c.cast("double"))))]
    row = df.agg(*[c.alias(f"c{i}") for i, c in enumerate([*first, *extra])]).first()
    sketched = {key: row[2 * i:2 * i + 2] for i, key in enumerate(same)}
    totals, quantiles = zip(*[sketched[str(c)] for c in columns])
    searches = {}
    for i, name in enumerate(names):
        if totals[i]:
            place = min(max(0, wanted[name][1](totals[i])), totals[i] - 1)
            searches[i] = _Search(place, rows=totals[i], quantiles=quantiles[i])
    while open_ones := [i for i, s in searches.items() if s.value is None]:
        chosen, of = [searches[i] for i in open_ones], [columns[i] for i in open_ones]
        brackets = [s.bracket() for s in chosen]
        if any(2 * (MARGIN + 1 / GRID) * s.rows > MOST_VALUES for s in chosen):
            _narrow(df, of, chosen, brackets)
            continue
        for s, (below, counts) in zip(chosen, _count(df, of, chosen, brackets)):
            if not s.settle(below, counts):  # the sketch was wrong by ten standard errors: count the whole interval
                s.quantiles = None
    found = {}
    for i, name in enumerate(names):
        s = searches.get(i)
        found[name] = (s.value, s.below, s.ties, totals[i]) if s else None
    return found, row[len(first):]


def _percentile_places(columns):
    return {
        (c, f, end): (F.col(c), lambda n, f=f, whole=whole: whole((n - 1) * f))
        for c, fractions in columns.items() for f in fractions
        for end, whole in (("low", math.floor), ("high", math.ceil))
    }


def _interpolated(columns, found):
    def percentile(c, f):
        if found[c, f, "low"] is None:
            return None
        low, high, spot = found[c, f, "low"][0], found[c, f, "high"][0], (found[c, f, "low"][3] - 1) * f
        return low if low == high else low + (high - low) * (spot - math.floor(spot))

    return {c: [percentile(c, f) for f in fractions] for c, fractions in columns.items()}


def exact_percentiles(df, columns):
    """{column: [float, ...]} of exact linearly interpolated percentiles for {column: fractions}; None without values.

    The exact counterpart of DataFrame.approxQuantile. All columns share their passes.
    """
    return _interpolated(columns, values_at(df, _percentile_places(columns))[0])


def _shared_head(low, high):
    """Hex digits that two hex texts, and so all texts between them, begin with."""
    pairs = zip(low or "", high or "")
    return next((i for i, (a, b) in enumerate(pairs) if a != b), min(len(low or ""), len(high or "")))


def _text_number(column, skip):
    """A whole number that grows with a text, from six of its bytes after the first skip hex digits."""
    size = 2 * _NUMBER_BYTES
    return F.conv(F.rpad(F.substring(F.hex(column), skip + 1, size), size, "0"), 16, 10).cast("double")


def bucket_by_position(df, orders, last_positions, labels, percentiles=None):
    """(df with labels by place, exact percentiles); orders: {name of the label: (numeric column, text column)}.

    Number (not null) and text together identify a row; their order has no ties. last_positions(n) lists the 0-based
    place of the last row of each label but the final one. Only those rows are looked up; a label is a comparison with
    them, so that no row is ranked or moved. The percentiles, as of exact_percentiles, share the passes.
    """
    percentiles = percentiles or {}
    cuts = {(o, i): orders[o] for o in orders for i in range(len(labels) - 1)}
    wanted = {key: (number, lambda n, i=key[1]: last_positions(n)[i]) for key, (number, _) in cuts.items()}
    ends = [F.hex(e(text)) for _, text in orders.values() for e in (F.min, F.max)]
    found, texts = values_at(df, wanted | _percentile_places(percentiles), ends)
    skip = {o: _shared_head(*texts[2 * k:2 * k + 2]) for k, o in enumerate(orders)}
    bounds, rest, group = {}, {}, {}
    for (o, i), (number, text) in cuts.items():
        hit = found[o, i]
        if hit is None or last_positions(hit[3])[i] < 0:
            bounds[o, i] = F.lit(False)
            continue
        value, before, ties, n = hit
        x = number.cast("double")
        bounds[o, i], left = x < value, last_positions(n)[i] - before
        rest[o, i], group[o, i] = (left, ties), x == value
    while rest:  # rows that tie so far; six more bytes of the text tell them apart
        done = {key for key, (left, ties) in rest.items() if left + 1 == ties}
        for key in done:
            bounds[key] |= group.pop(key)
            del rest[key]
        if not rest:
            break
        numbers = {key: _text_number(cuts[key][1], skip[key[0]]) for key in rest}
        tied = {key: (F.when(group[key], numbers[key]), lambda _, r=rest[key][0]: r) for key in rest}
        for key, (value, before, ties, _) in values_at(df, tied)[0].items():
            bounds[key] |= group[key] & (numbers[key] < value)
            group[key] &= numbers[key] == value
            rest[key] = (rest[key][0] - before, ties)
        skip = {o: n + 2 * _NUMBER_BYTES for o, n in skip.items()}
    made = {}
    for o in orders:
        made[o] = F.lit(labels[-1])
        for i in reversed(range(len(labels) - 1)):
            made[o] = F.when(bounds[o, i], F.lit(labels[i])).otherwise(made[o])
    return df.withColumns(made), _interpolated(percentiles, found)


def global_row_number(df, key, name):
    """Add name = 1..n in the order of a text column that identifies a row; a null comes first.

    Rows are numbered inside groups of the text's bytes after those that all share, and the rows of earlier groups are
    added. Three bytes of digits make about a thousand groups. One lazy plan: nothing runs before it is asked for.
    """
    ends = df.agg(F.hex(F.min(key)).alias("low"), F.hex(F.max(key)).alias("high"))
    size = F.coalesce(F.least(F.length("low"), F.length("high")), F.lit(0))
    same = lambda i: F.substring("low", 1, i) == F.substring("high", 1, i)
    shared = F.when(size > 0, F.size(F.filter(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), same))).otherwise(0)
    start = ends.select(shared.alias("n")).scalar()
    head = F.coalesce(F.substring(F.hex(key), start + 1, F.lit(2 * _HEAD_BYTES)), F.lit(""))
    grouped = df.withColumn("_head", head)
    earlier = Window.orderBy("_head").rowsBetween(Window.unboundedPreceding, -1)  # a row per group
    counts = grouped.groupBy("_head").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_head", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    numbered = grouped.withColumn("_place", F.row_number().over(Window.partitionBy("_head").orderBy(key)))
    place = (F.col("_before") + F.col("_place")).cast("bigint")
    return numbered.join(offsets, "_head").select(*df.columns, place.alias(name))


def sorted_numbers(df, order, name):
    """Add name = 0..n-1 in the order of columns that identify a row.

    Rows are sorted over ranges and stored once with their place in the range; the rows of earlier ranges are added.
    """
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # the low bits count within a partition
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranges = materialize(ranges.withColumns({"_part": F.spark_partition_id(), "_place": place}), "sorted")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    counts = ranges.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    numbered = ranges.join(F.broadcast(offsets), "_part")  # as many rows as the sort has ranges
    return numbered.select(*df.columns, (F.col("_before") + F.col("_place")).alias(name))


def equal_width_positions(n, buckets=4):
    """Last place of each bucket but the final one when positions 1..n are cut at their linear quantiles."""
    return [(s * (n - 1)) // buckets for s in range(1, buckets)]


def ntile_positions(n, buckets=4):
    """Last place of each bucket but the final one under NTILE(buckets)."""
    size, extra = divmod(n, buckets)
    return [s * size + min(s, extra) - 1 for s in range(1, buckets)]
