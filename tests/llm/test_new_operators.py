"""Hilbert order, hard negatives, periodic runs and the fair mix against brute force."""

import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallylake.llm import fair_mix, hard_negatives, periodic_runs, queries
from tallylake.llm.hilbert import curve_keys

SF_DIR = "/root/testdata/sf0.001"


def split(text):
    return (text or "").translate(dict.fromkeys(map(ord, "\t\n\x0b\f\r"), " ")).split(" ")


def words_of(text):
    return [w for w in split(text) if w]


# ---------------------------------------------------------------- Hilbert order


@pytest.mark.parametrize("axes, bits", [(2, 4), (3, 3), (5, 2), (1, 5), (2, 1)])
def test_neighbours_on_the_curve_are_neighbours_in_space(axes, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
    keys = [k.tobytes() for k in curve_keys(cells, bits)]
    order = sorted(range(len(cells)), key=keys.__getitem__)
    assert len(set(keys)) == len(cells)
    assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()


# ---------------------------------------------------------------- hard negatives


def brute_negatives(rows, anchors, scale=256, k=5, low=80, high=100):
    def number(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(scale * x) for x in v]

    taking = [(i, label, number(v)) for i, v, label in rows if label is not None and i is not None]
    taking = [r for r in taking if r[2] is not None]
    out = []
    for a, label, v in [r for r in taking if anchors(r[0])]:
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, other, w in taking)
        positives = [(i, -s) for s, i, other in scored if other == label and i != a][:k]
        for p, best in positives:
            inside = [(i, -s) for s, i, other in scored if other != label and low * best <= -100 * s <= high * best][:k]
            out += [(a, p, rank, i, best, s) for rank, (i, s) in enumerate(inside, 1)]
    return sorted(out)


def negatives(spark, rows, parts=3):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(parts)
    table = table.selectExpr("*", "1 AS place", "'x' AS v", "2 AS box")
    found = hard_negatives.hard_negatives(table, F.col("vec_id") % 10 == 0)
    return sorted(tuple(r) for r in found.collect())


def vectors(n, size, seed, spread=1.0):
    rng = random.Random(seed)
    return [(i, [float(np.float32(rng.gauss(0.1, spread))) for _ in range(size)], rng.randrange(4)) for i in range(n)]


@pytest.mark.parametrize("block, files", [(512, 256), (7, 2)])
def test_hard_negatives(spark, monkeypatch, block, files):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(hard_negatives, "FILE_BLOCKS", files)
    monkeypatch.setattr(hard_negatives, "ANCHORS_A_STEP", 4)
    rows = vectors(200, 6, 1, 0.3)
    rows += [(300 + i, [0.5] * 6, i % 3) for i in range(60)]  # one common vector, under several labels
    rows += [(10, None, 1), (20, [1.0] * 6, None), (None, [1.0] * 6, 1), (30, [float("nan")] * 6, 1),
             (40, [None] + [1.0] * 5, 1), (50, [float("inf")] * 6, 2), (400, [0.5, 0.25], 1), (410, [], 2)]
    rows = [r for r in rows if r[0] not in (10, 20, 30, 40, 50) or len(r[1] or []) != 6 or r[1] in ([1.0] * 6,)] + rows[-8:]
    expected = brute_negatives(rows, lambda i: i % 10 == 0)
    assert expected and negatives(spark, rows) == expected


def test_hard_negatives_of_repeated_rows_and_wide_values(spark):
    rows = vectors(40, 3, 2)
    rows += rows[5:15]
    assert negatives(spark, rows) == brute_negatives(rows, lambda i: i % 10 == 0)
    wide = [(i, [x * 2.0**18 for x in v], label) for i, v, label in vectors(60, 3, 3)]
    assert negatives(spark, wide) == brute_negatives(wide, lambda i: i % 10 == 0)


def test_hard_negatives_of_empty_tables(spark):
    assert negatives(spark, []) == []
    assert negatives(spark, [(10, [], 1), (11, [], 1), (12, [], 2)]) == [(10, 11, 1, 12, 0, 0)]
    assert negatives(spark, [(11, [1.0], 1)]) == []


def test_bounds_leave_far_blocks_unread(spark, monkeypatch):
    """Rows in far clusters: the scan opens few of the blocks, and the result is that of brute force."""
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 8)
    rng = random.Random(4)
    centres = [[rng.choice([-3.0, 3.0]) for _ in range(8)] for _ in range(12)]
    rows = [(i, [c + rng.gauss(0, 0.05) for c in centres[i // 16]], i % 2) for i in range(192)]
    grid_rows = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    taking = hard_negatives.quantised(grid_rows, "vec_id", "embedding", "label", 256)
    grid = hard_negatives.Grid(taking)
    blocks = hard_negatives._on_curve(taking, grid, 1).toArrow().combine_chunks().to_batches()
    pieces = list(hard_negatives._pieces(blocks, 8))
    boxes = [hard_negatives._box(hard_negatives._vectors(p.column("v"), grid), p.column("label").to_numpy()) for p in pieces]
    boxes = hard_negatives.Boxes(np.concatenate(boxes).tobytes(), 8)
    anchor = hard_negatives._vectors(pieces[0].column("v"), grid)[:1].astype(np.int64)
    low, high = boxes.bounds(anchor, np.float64)
    scores = np.concatenate([hard_negatives._vectors(p.column("v"), grid) @ anchor[0] for p in pieces])
    assert (np.repeat(low[0], 8) <= scores).all() and (scores <= np.repeat(high[0], 8)).all()
    assert (high[0] >= np.sort(scores)[-5]).sum() <= len(pieces) // 4
    assert negatives(spark, rows) == brute_negatives(rows, lambda i: i % 10 == 0)


def test_op11(spark):
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
            for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in queries.QUERIES["op11_hard_negatives"](spark, SF_DIR).collect())
    assert got == brute_negatives(rows, lambda i: i % 100 == 0)


# ---------------------------------------------------------------- periodic runs


def brute_runs(words):
    """(start, length, period), checked straight from the definition."""
    found, seen = [], set()
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(12, 2 * q) and (start, length) not in seen:  # the same stretch has a smaller period
                seen.add((start, length))
                found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapse(words, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in dropped]


def random_words(rng):
    words = [rng.choice("abc") for _ in range(rng.randrange(0, 60))]
    for _ in range(rng.randrange(4)):
        root = [rng.choice("abcdefgh") for _ in range(rng.choice([1, 2, 3, 5, 6, 7, 8, 9, 15, 16, 17, 31, 33, 40, 64]))]
        repeat = (root * 12)[:rng.randrange(len(root), 4 * len(root) + 14)]
        at = rng.randrange(len(words) + 1)
        words[at:at] = repeat
    return words


@pytest.mark.parametrize("tile_words", [4096, 16])
def test_runs_of_random_words(monkeypatch, tile_words):
    monkeypatch.setattr(periodic_runs, "TILE_WORDS", tile_words)
    rng = random.Random(tile_words)
    for _ in range(400):
        words = random_words(rng)
        numbers = periodic_runs._numbers(words)
        pieces = {}
        for tile in periodic_runs.tiles(len(words)):
            for q, a, b in periodic_runs._solve(numbers, tile):
                pieces.setdefault(q, []).append((a, b))
        runs = []
        for q, found in pieces.items():
            whole = []
            for a, b in sorted(found):
                if whole and a <= whole[-1][1]:
                    whole[-1][1] = max(whole[-1][1], b)
                else:
                    whole.append([a, b])
            runs += [(a, b - a + q, q) for a, b in whole if b - a >= max(q, 12 - q)]
        assert sorted(runs, key=lambda r: (r[0], r[2])) == brute_runs(words), words


def test_z_function():
    s = [0, 0, 1, 0, 0, 1, 0, 0, 0]
    assert periodic_runs.z_function(s)[1:] == [
        next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(1, len(s))
    ]


@pytest.mark.parametrize("spread, tile_words", [(65_536, 4096), (20, 16)])
def test_periodic_runs(spark, monkeypatch, spread, tile_words):
    monkeypatch.setattr(periodic_runs, "TILE_WORDS", tile_words)
    rng = random.Random(7)
    texts = [" ".join(random_words(rng)) for _ in range(60)]
    texts += [None, "", " \n\t", "a " * 500, "x\ty\n" * 300, texts[0], texts[0], "    é 中 " * 20]
    texts += [" ".join(f"w{i % 700}" for i in range(5000))]
    rows = [(i if i % 5 else None, t, "mine") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, KEY string").selectExpr("*", "1 AS `a.b`", "2 AS words")
    got = periodic_runs.periodic_runs(docs.repartition(3), spread=spread)
    assert got.columns == [*docs.columns, "runs", "collapsed"]
    found = sorted(((r.doc_id, r.text, r.KEY, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()), key=repr)
    expected = []
    for ident, text, mine in rows:
        words = words_of(text)
        runs = brute_runs(words)
        expected.append((ident, text, mine, runs, " ".join(brute_collapse(words, runs))))
    assert found == sorted(expected, key=repr)
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


def test_op12(spark):
    expected = []
    for row in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect():
        words = words_of(row.text)
        h, n = zlib.crc32(str(row.doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = brute_runs(words)
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        figures = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        expected.append((row.doc_id, len(runs), *figures, sha(listed), sha(" ".join(brute_collapse(words, runs)))))
    got = sorted(tuple(r) for r in queries.QUERIES["op12_periodic_runs"](spark, SF_DIR).collect())
    assert got == sorted(expected) and any(r[1] for r in got)


# ---------------------------------------------------------------- fair mix


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """{source: target} by handing the excess back round after round."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, capped = share * sum(sizes.values()), set()
    while True:
        free = budget - sum(most * sizes[s] for s in capped)
        rest = sum(weight[s] for s in order if s not in capped)
        target = {s: most * sizes[s] if s in capped else free * weight[s] / rest for s in order}
        above = {s for s in order if target[s] > most * sizes[s]}
        if not above:
            return target
        capped |= above


def check_mix(rows, result):
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(words_of(text))
    target, taken, largest = brute_targets(sizes), dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    plain = sorted((i, len(words_of(t)), sizes[s]) for i, t, s in rows)
    assert sorted((r["doc_id"], r["size"], r["source_size"]) for r in result) == plain
    source = {i: s for i, _, s in rows}
    for r in result:
        s = source[r["doc_id"]]
        assert r["target"] == pytest.approx(target[s], rel=1e-12)
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[s], largest[s] = taken[s] + r["taken"], max(largest[s], r["size"])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 2 * max(largest.values())
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= max(largest.values())


def test_fair_mix(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, "w " * rng.randrange(1, 40), rng.choice(["big"] * 8 + ["a", "B", "é", "z", None])) for i in range(900)]
    rows += [(1000, None, "a"), (1001, "", "empty"), (1002, " \n", None), (1003, "v " * 400, "one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs = docs.selectExpr("*", "'mine' AS served", "1 AS TARGET", "2 AS `a.b`", "3 AS key")
    result = fair_mix.mix(docs.repartition(3))
    assert result.columns == ["doc_id", "source", "served", "a.b", "key", "size", "source_size", "target", "taken"]
    first = sorted(result.drop("a.b").collect())
    check_mix(rows, [r.asDict() for r in first])
    assert {r["served"] for r in first} == {"mine"}
    monkeypatch.setattr(fair_mix, "ROWS_A_TASK", 50)  # many buckets of a source, many ranges
    again = fair_mix.mix(docs.repartition(7)).collect()
    check_mix(rows, [r.asDict() for r in again])
    assert sorted(fair_mix.mix(docs.repartition(4)).drop("a.b").collect()) == sorted(
        fair_mix.mix(docs.coalesce(1)).drop("a.b").collect())


def test_fair_mix_of_odd_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert fair_mix.mix(docs).count() == 0
    empty = spark.createDataFrame([(1, None, None), (2, "", "a")], docs.schema)
    assert sorted(tuple(r) for r in fair_mix.mix(empty).select("doc_id", "size", "target", "taken").collect()) == [
        (1, 0, 0.0, 0), (2, 0, 0.0, 0)]
    repeated = spark.createDataFrame([(None, "a b c", "s")] * 40 + [(7, "x", "t")] * 40, docs.schema)
    got = fair_mix.mix(repeated).groupBy("source").agg(F.sum("taken"), F.first("target")).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == {"s": (pytest.approx(180, abs=3), 180.0), "t": (pytest.approx(60, abs=3), 60.0)}


def test_mixed_documents_follow_the_plan_and_interleave(spark):
    rows = [(i, f"w{i} x", "abc"[i % 3]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = {r.doc_id: r.taken // r["size"] for r in fair_mix.mix(docs).collect()}
    mixed = fair_mix.mixed_documents(docs).collect()
    counts = dict.fromkeys(plan, 0)
    for r in mixed:
        counts[r.doc_id] += 1
        assert r.text == f"w{r.doc_id} x"
    assert counts == plan
    head = [r.source for r in mixed[:60]]  # weights 3, 1, 2; a is capped at two thirds of its share
    assert 10 <= head.count("b") <= 20 and head.count("a") > head.count("b") < head.count("c")


def test_op13(spark):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    check_mix(rows, [r.asDict() for r in queries.QUERIES["op13_fair_mix"](spark, SF_DIR).collect()])
