"""Periodic runs of words: stretches that repeat with a smallest period, found in tiles per octave of periods.

A run of period q is a stretch of places i with word i = word i + q, and that stretch is at least as long as q. So
boundaries at a stride of half an octave's least stretch hit it twice, and at the first of them at least a stride of
words matches. Each octave has tiles of its own scale. In a tile, the Z-function from a boundary tells for every lag of
the octave how far the words match to the right; a second one, over reversed words, how far to the left. Both end at
the tile's halo: what a tile finds are fragments, which are shuffled by document and period and stitched there.
"""

import itertools
import secrets

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.llm.arrow_columns import steps
from tallylake.llm.storage import stored

MIN_LENGTH = 12
#: Words between two tiles of a short octave; the tiles of a longer one have four times its least period.
TILE_WORDS = 4096
#: Tiles of documents with more words than this become rows of their own and are spread over tasks.
SPREAD_WORDS = 65_536

_FRAGMENT = "array<struct<period:int,first:long,last:long>>"
_RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def octaves(n):
    """(least period, period after the last, least stretch) for all runs of n words.

    Periods below 8 go together: by MIN_LENGTH their stretches have at least 6 places.
    """
    low, high, stretch = 1, 8, 6
    while n >= max(MIN_LENGTH, 2 * low):
        yield low, high, stretch
        low, high, stretch = high, 2 * high, high


def tiles(n):
    """(octave, first boundary, boundary after the last, first word, word after the last) of all tiles of n words."""
    for octave in octaves(n):
        low, high, stretch = octave
        stride = stretch // 2
        body = max(TILE_WORDS, 4 * high) // stride * stride
        for start in range(0, n - low, body):
            end = start + body
            yield octave, start, end, max(0, start - stride), min(n, end + 2 * stride + high)


def z_function(s):
    """Length of the common prefix of s and s[i:], for every i; 0 for i = 0."""
    n, left, right = len(s), 0, 0
    z = [0] * n
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def _shorter(q):
    """1, and q divided by each of its primes: a shorter period that divides q divides one of these."""
    if q > 1:
        yield 1
    rest, p = q, 2
    while p * p <= rest:
        if rest % p == 0:
            yield q // p
            while rest % p == 0:
                rest //= p
        p += 1
    if 1 < rest < q:
        yield q // rest


def _live(words, octave, first, last, stride):
    """Boundaries of a tile from which three words match at some lag of the octave, and those lags: (place, lag)."""
    low, high, _ = octave
    mixed = words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    grams = np.full(len(words) + high + stride, np.uint64(0))
    if len(words) >= 3:
        grams[:len(words) - 2] = mixed[:-2] + (mixed[1:-1] >> np.uint64(7)) * np.uint64(3) + (mixed[2:] >> np.uint64(13))
    places = np.arange(first, min(last, len(words) - low - 2), stride)
    if not len(places):
        return []
    at, step = grams[first:], grams.itemsize
    lags = np.lib.stride_tricks.as_strided(at[low:], (len(places), high - low), (stride * step, step), writeable=False)
    row, lag = np.nonzero(lags == grams[places][:, None])
    return zip(places[row].tolist(), (lag + low).tolist())


def solve_tile(words, octave, first, last):
    """Fragments (period, first, last) of a tile: places whose words recur one period on, counted in the tile.

    words: numbers of the tile's words, halo included; first and last: its boundaries. Overlapping fragments of the
    tile are joined. Periods that repeat a shorter one are left to that one.
    """
    _, high, stretch = octave
    stride = stretch // 2
    found, numbers = {}, None
    for place, group in itertools.groupby(_live(words, octave, first, last, stride), lambda x: x[0]):
        numbers = words.tolist() if numbers is None else numbers
        ahead, behind = z_function(numbers[place:place + high + 2 * stride]), None
        for _, q in group:
            right = min(ahead[q], 2 * stride) if q < len(ahead) else 0
            if right < stride or any(ahead[p] >= q - p for p in _shorter(q)):
                continue
            stretches = found.setdefault(q, [])
            if stretches and stretches[-1][1] >= place:
                stretches[-1][1] = max(stretches[-1][1], place + right)
                continue
            if behind is None:  # the words before the place, then all up to the furthest lag, both from their ends
                start, end = max(0, place - stride), min(len(numbers), place + high - 1)
                behind = z_function(numbers[start:place][::-1] + [-1] + numbers[start:end][::-1])
            stretches.append([place - behind[place - start + 1 + end - place - q], place + right])
    return [(q, a, b) for q, pairs in found.items() for a, b in pairs]


def _solve(words, tile):
    octave, first, last, start, end = tile
    return [(q, a + start, b + start) for q, a, b in solve_tile(words[start:end], octave, first - start, last - start)]


def _numbers(words):
    index = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(index.__getitem__, words), np.int32, len(words))


def collapse(words, runs):
    """words without those that repeat a run's first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return list(itertools.compress(words, (np.cumsum(change[:-1]) == 0).tolist()))


class _Documents:
    """Splits documents, solves the tiles of most of them, and tells what is final, what waits, what is spread."""

    def __init__(self, finish, spread):
        self.finish, self.spread, self.name, self.n = finish, spread, secrets.token_hex(8), 0

    def take(self, text):
        """(results or None, key, words, fragments, tiles) of a document."""
        words = (text or b"").split()
        numbers = _numbers(words)
        if len(words) > self.spread:
            self.n += 1
            return None, f"{self.name}-{self.n}", words, [], tiles(len(words)), numbers
        found = [fragment for tile in tiles(len(words)) for fragment in _solve(numbers, tile)]
        if not found:
            return self.finish(words, []), None, None, None, (), None
        self.n += 1
        return None, f"{self.name}-{self.n}", words, found, (), None


def _rows(columns, schema):
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    arrays = [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow)]
    return pa.RecordBatch.from_arrays(arrays, schema=arrow)


def _first_pass(kept, fields, schema, finish, spread):
    empty = [None] * len(fields)

    def run(batches):
        documents = _Documents(finish, spread)
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for start, size in steps(texts):
                part, out = batch.slice(start, size), []
                for text in part.column("text").cast(pa.binary()).to_pylist():
                    results, key, words, fragments, to_do, numbers = documents.take(text)
                    out.append((*(results or empty), key, None if words is None else b" ".join(words), fragments, None))
                    for octave, first, last, begin, end in to_do:
                        tile = (*octave, first, last, begin, numbers[begin:end].tobytes())
                        nulls = [[None]] * (len(kept) + len(fields))
                        yield _rows([*nulls, [key], [None], [None], [tile]], schema)
                yield _rows([*[part.column(i) for i in range(len(kept))], *zip(*out)], schema)

    return run


def _solve_spread(batches):
    for batch in batches:
        for row in batch.to_pylist():
            t = row["tile"]
            octave, begin = (t["low"], t["high"], t["stretch"]), t["begin"]
            words = np.frombuffer(t["numbers"], np.int32)
            found = solve_tile(words, octave, t["first"] - begin, t["last"] - begin)
            columns = list(zip(*[(row["key"], q, a + begin, b + begin) for q, a, b in found])) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int64(), pa.int64()))],
                ["key", "period", "first", "last"],
            )


def _stitched(fragments):
    """Runs of each document, by start and period, from fragments that touch or overlap."""
    order = Window.partitionBy("key", "period").orderBy("first", "last")
    before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col("first") <= before, 0).otherwise(1)
    island = F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    marked = fragments.withColumn("new", new).withColumn("island", island)
    whole = marked.groupBy("key", "period", "island").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    stretch, period = F.col("last") - F.col("first"), F.col("period").cast("long")
    valid = whole.where(stretch >= F.greatest(period, F.lit(MIN_LENGTH) - period))
    run = F.struct(F.col("first").alias("start"), period.alias("period"), (stretch + period).alias("length"))
    return valid.groupBy("key").agg(F.sort_array(F.collect_list(run)).alias("runs"))


def _last_pass(kept, schema, finish):
    def run(batches):
        for batch in batches:
            for start, size in steps(batch.column("words")):
                part = batch.slice(start, size)
                out = [
                    finish(words.split(), [(r["start"], r["length"], r["period"]) for r in runs or ()])
                    for words, runs in zip(part.column("words").to_pylist(), part.column("runs").to_pylist())
                ]
                yield _rows([*[part.column(i) for i in range(len(kept))], *zip(*out)], schema)

    return run


def _runs_and_text(words, runs):
    return runs, b" ".join(collapse(words, runs)).decode()


#: What periodic_runs adds by default: the runs of a text, and the text without their repeats.
RUNS_AND_TEXT = [T.StructField("runs", T.ArrayType(_RUN)), T.StructField("collapsed", T.StringType())]


def periodic_runs(docs, text="text", finish=_runs_and_text, fields=RUNS_AND_TEXT, spread=SPREAD_WORDS,
                  keep_text=True):
    """docs, with keep_text=False without their text, with new columns made from the periodic runs of their words; by default runs and collapsed.

    Words lie between the six ASCII spaces and are numbered from 0. A run (start, length, period) is a stretch of at
    least MIN_LENGTH words and two of its smallest periods that no neighbouring word extends. collapsed holds the words
    that no run contains after its first period, joined by one space. finish(words, runs) -> values of fields may make
    other columns; words are bytes, runs are sorted by start, then period.

    Null and empty texts have no words, no runs and an empty collapsed text. Texts are taken whole: the tiles of one
    with more than `spread` words are spread over tasks. Repeated rows and null ids are separate rows. An empty table
    gives an empty table. Columns that bear a new name are replaced, all others pass.
    """
    names = {f.name.lower() for f in fields} | (set() if keep_text else {text.lower()})
    given = [f for f in docs.schema if f.name.lower() not in names]
    kept = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(given)]
    made = [T.StructField(f"f{i}", f.dataType) for i, f in enumerate(fields)]
    tile = "struct<low:int,high:int,stretch:int,first:long,last:long,begin:long,numbers:binary>"
    waiting = T.StructType.fromDDL(f"key string, words binary, fragments {_FRAGMENT}, tile {tile}")
    schema = T.StructType([*kept, *made, *waiting.fields])
    columns = [F.col(f"`{f.name}`").alias(k.name) for f, k in zip(given, kept)]
    base = docs.select(*columns, F.col(f"`{text}`").cast("string").alias("text"))
    done = stored(base.mapInArrow(_first_pass(kept, made, schema, finish, spread), schema), "runs-found")

    row = "key string, period int, first long, last long"
    spread_tiles = done.where("tile is not null").select("key", "tile").repartition("key", "tile.first", "tile.low")
    own = done.where("words is not null").select("key", F.inline("fragments"))
    runs = _stitched(own.unionByName(spread_tiles.mapInArrow(_solve_spread, row)))
    open_docs = done.where("words is not null").select(*[k.name for k in kept], "key", "words")
    last = open_docs.join(runs, "key", "left").select(*[k.name for k in kept], "words", "runs")
    result = T.StructType([*kept, *made])
    closed = last.mapInArrow(_last_pass(kept, result, finish), result)
    whole = done.where("key is null").select(*[f.name for f in result]).unionByName(closed)
    return whole.select(*[F.col(f.name).alias(g.name) for f, g in zip(result, [*given, *fields])])
