"""Mixing sources to target weights: weighted fair queueing over virtual finish times, by built-in functions alone.

Every document queues in its source, in a shuffled order that is a hash of its id and text, `most` times over. It ends
at virtual time (words of the source up to its end) / (the source's target). The copies of all sources are sorted by
that time over ranges, and the sort is cut where the words served reach the budget.

No group is summed in one task: a source is cut into buckets of the hash, totals of the buckets give the words before
each, and the running sum is taken inside a bucket. Texts are read once and never shuffled.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallylake.llm.arrow_columns import without
from tallylake.llm.storage import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Rows that a bucket of all sources together, and a range of the sort, hold about.
ROWS_A_TASK = 65_536
_RESULTS = ["size", "source_size", "target", "taken"]
_KEY = ["finish", "turn", "served"]


def _light(docs, text, source, ident, seed, keep_text):
    """One short row per document: its columns as c0, c1, ..., its source as a key that sorts null last, size, hash."""
    kept = without(docs, _RESULTS)
    names = [c for c in docs.columns if c.lower() not in _RESULTS]
    columns = {f"c{i}": name for i, name in enumerate(names) if keep_text or name.lower() != text.lower()}
    body = F.col(f"`{text}`").cast("string")
    key = F.coalesce(F.concat(F.lit("0"), F.col(f"`{source}`").cast("string")), F.lit("1"))
    rows = docs.select(
        *[kept[int(c[1:])].alias(c) for c in columns],
        key.alias("key"),
        F.coalesce(F.regexp_count(body, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(f"`{ident}`"), body).alias("dealt"),
        F.col(f"`{ident}`").alias("ident"),
    )
    return stored(rows, "mix-sizes"), columns


def _numbered(df, order):
    """df with number = 0, 1, ... in the order of a column: a range sort, stored, and the rows before each range."""
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # the low bits count within a partition
    ranges = df.repartitionByRange(order).sortWithinPartitions(order)
    ranges = stored(ranges.withColumns({"part": F.spark_partition_id(), "place": place}), "mix-sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    counts = ranges.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return ranges.join(counts, "part").withColumn("number", F.col("before") + F.col("place")).select(*df.columns, "number")


def _targets(sources, weights, share, most):
    """sources (key, source_size) with turn, target: share of all words by weight, none above most times its own.

    What stands above its cap goes back to the others by weight, round after round, until the capped ones stay the
    same; a round is one sum over the sources, of which the driver gets three numbers.
    """
    turn = F.col("number")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), F.pmod(turn, F.lit(len(weights))).cast("int"))
    ranked = _numbered(sources, "key").select(
        "key", "source_size", turn.alias("turn"), weight.cast("double").alias("weight"),
        (F.col("source_size") * most).alias("cap"),
    )
    ranked = stored(ranked, "mix-weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    budget, level, capped = share * total, 0.0, -1
    while True:
        above = F.col("cap") <= F.lit(level) * F.col("weight")
        n, taken, rest = ranked.agg(
            F.count_if(above), F.sum(F.when(above, F.col("cap"))), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if n == capped or not rest:
            break
        capped, level = n, (budget - (taken or 0)) / rest
    held = F.col("cap") <= F.lit(level) * F.col("weight")
    target = F.when(held, F.col("cap").cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return ranked.select("key", "source_size", "turn", target.alias("target")), budget


def _tasks(spark, rows):
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_A_TASK))


def _queued(light, sources, rows):
    """light with its source's turn, size and target, and served: the words of its source up to its own end."""
    buckets = _tasks(light.sparkSession, rows)
    bucket = F.pmod(F.shiftrightunsigned("dealt", 20), F.lit(buckets)).alias("bucket")
    dealt = light.select("*", bucket)
    earlier = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("key", "bucket").agg(F.sum("size").alias("total"))
    totals = totals.select("key", "bucket", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))
    totals = totals.join(sources, "key")
    upto = Window.partitionBy("key", "bucket").orderBy("dealt", "ident", "size")
    running = F.sum("size").over(upto.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        dealt.withColumn("running", running)
        .join(totals, ["key", "bucket"])
        .withColumn("served", F.col("before") + F.col("running"))
        .drop("running", "before", "bucket", "key", "dealt", "ident")
    )


def _finish(served):
    return F.try_divide(served.cast("double"), F.col("target"))


def _copies(queued, most):
    """A row per document and repeat, with the repeat's words served and virtual finish time. Empty ones take no turn."""
    again = F.explode(F.sequence(F.lit(0), F.lit(most - 1)))
    rows = queued.where("size > 0").withColumn("again", again)
    served = F.col("served") + F.col("again") * F.col("source_size")
    return rows.withColumn("served", served).withColumn("finish", _finish(F.col("served")))


def _last_taken(copies, budget, rows):
    """(finish, turn, served) of the last copy within the budget: that whose middle word is, in the global sort."""
    ranges = _tasks(copies.sparkSession, rows)
    sort = copies.select(*_KEY, "size").repartitionByRange(ranges, *_KEY).sortWithinPartitions(*_KEY)
    sort = stored(sort.withColumn("part", F.spark_partition_id()), "mix-order")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    parts = sort.groupBy("part").agg(F.sum("size").alias("total"))
    parts = parts.select("part", "total", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("before"))
    placed = sort.join(parts, "part").withColumn("key", F.struct(*_KEY))
    end = F.col("before") + F.col("total")
    whole = placed.where(end <= budget).agg(F.max("key").alias("key"))
    cut = placed.where((F.col("before") < budget) & (end > budget))  # rows of one range
    running = F.sum("size").over(Window.partitionBy("part").orderBy(*_KEY).rowsBetween(Window.unboundedPreceding, 0))
    cut = cut.withColumn("upto", F.col("before") + running).where(F.col("upto") - F.col("size") / 2 <= budget)
    return whole.unionAll(cut.agg(F.max("key").alias("key"))).agg(F.max("key")).first()[0]


def _planned(docs, weights, share, most, text, source, ident, seed, keep_text):
    light, columns = _light(docs, text, source, ident, seed, keep_text)
    rows = light.count()
    sizes = light.groupBy("key").agg(F.sum("size").alias("source_size"))
    sources, budget = _targets(sizes, weights, share, most)
    queued = stored(_queued(light, stored(sources, "mix-targets"), rows), "mix-queue")
    return queued, columns, _last_taken(_copies(queued, most), budget, rows * most)


def _within(last, finish, served):
    """True for copies that end no later than the last one taken."""
    if last is None:
        return F.lit(False)
    copy = F.struct(finish.alias("finish"), F.col("turn").alias("turn"), served.alias("served"))
    return copy <= F.struct(*[F.lit(last[k]).alias(k) for k in _KEY])


def mix(docs, weights=(3, 1, 2), share=1.5, most=2, text="text", source="source", ident="doc_id", seed=13):
    """docs without their text, with size, source_size, target and taken (words that the mix takes, repeats counted).

    Sources, sorted by code point with null as the last one, have the weights in turn. Their targets share `share`
    times all words by weight; one stops at `most` times its source's words and the rest goes to the others. Documents
    are taken whole, 0 to `most` times; every source ends within about a document of its target.

    Null and empty texts have size 0 and take part with 0 words; a null id is an id like others. Rows that agree in
    id, text and source are interchangeable: which of them is taken is not defined, how many are is. An empty table
    gives an empty table. Very long texts count whole. Columns that bear a new name are replaced, all others kept.
    Ties in virtual time go to the source that sorts first. Reruns, and other partitions, give the same result.
    """
    queued, columns, last = _planned(docs, weights, share, most, text, source, ident, seed, False)
    served = [F.col("served") + i * F.col("source_size") for i in range(most)]
    repeats = sum(F.when(_within(last, _finish(s), s), 1).otherwise(0) for s in served)
    taken = F.when(F.col("size") > 0, F.col("size") * repeats).otherwise(0).cast("long")
    return queued.select(
        *[F.col(c).alias(name) for c, name in columns.items()], "size", "source_size", "target", taken.alias("taken")
    )


def mixed_documents(docs, weights=(3, 1, 2), share=1.5, most=2, text="text", source="source", ident="doc_id", seed=13):
    """The mix itself: a row of docs per copy taken, in the order of virtual finish times (a global range sort)."""
    queued, columns, last = _planned(docs, weights, share, most, text, source, ident, seed, True)
    taken = _copies(queued, most).where(_within(last, F.col("finish"), F.col("served"))).orderBy(*_KEY)
    return taken.select(*[F.col(c).alias(name) for c, name in columns.items()])
