"""Near duplicates: a Jaccard join of word-shingle sets by PartEnum signatures.

Sets are compared within size bands. For a band of sizes up to r, two sets of Jaccard similarity >= 0.8 differ in at
most k = 2r/9 shingles. The domain of shingles is cut into n1 parts of 3 subparts each; a signature is the content of
2 of the 3 subparts of one part, under one of the 3 choices. As k differences can't reach 2 into each of n1 > k/2 parts,
such sets share a signature. n1 is larger than needed, so that they share one that holds a rare shingle; signatures
without one (made of passages that many documents repeat, or empty) are left out. A set for which that isn't certain
("thin": too few parts hold rare shingles in two subparts) gives all its signatures with content, and where even that is
not certain ("bare") all; only thin sets need to meet by frequent shingles, only bare ones by empty parts. Any list of frequent shingles gives the same links: a good one only keeps unlike sets from meeting.
"""

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.llm import storage
from tallylake.llm.arrow_columns import add_columns, spare_prefix, steps
from tallylake.llm.components import connected_components

SHINGLE = 5
#: Least similarity as a fraction: 100 * intersection >= 80 * union.
PERCENT = 80
#: Growth of the size bands; signature rows that one task groups.
BAND_GROWTH, BUCKET_ROWS = 1.5, 2_000_000
#: Frequent shingles that are known to all tasks (8 bytes each), and in how many steps of texts one must repeat.
FREQUENT, LEAST_STEPS = 1 << 17, 3
#: Rounds in which groups are compared with one member; what is then still apart is compared by its rarest shingles.
STAR_ROUNDS = 2
#: Up to so many nodes are sent to all tasks to choose sets by; of more, the sets are shuffled.
SENT_NODES = 300_000
#: 64-bit words of a set's parity bits.
PARITY_WORDS = 8

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x):
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


#: A multiplier with its inverse modulo 2^64, a number for each byte, and the bytes that separate words.
_STEP = 0xD1342543DE82EF95
_BACK = pow(_STEP, -1, 1 << 64)
_BYTES = _mix(np.arange(1, 257, dtype=np.uint64) * _M1)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


@lru_cache(maxsize=64)
def _powers(base, count):
    """The powers 0 to count - 1 of a number modulo 2^64."""
    steps = np.full(count, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def _word_hashes(text):
    """64-bit hashes of the words of a text, in order: differences of one running sum over its bytes, scaled back.

    Long texts are taken as a whole too: the tables of powers are as long as the longest text, in powers of two.
    """
    data = np.frombuffer(text.encode().lower(), np.uint8)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    if not len(edges):
        return np.zeros(0, np.uint64)
    room = 1 << max(16, len(data).bit_length())
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * _powers(_STEP, room)[: len(data)], out=total[1:])
    start, end = edges[::2], edges[1::2]
    return _mix((total[end] - total[start]) * _powers(_BACK, room)[start])


def shingle_set(text):
    """Sorted distinct 64-bit shingle hashes of a text: 5 words each, or all words of a shorter text as one."""
    if not text:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        h = _word_hashes(text)
        if not len(h):
            return h
        size = min(SHINGLE, len(h))
        total = np.full(len(h) - size + 1, size, np.uint64)
        for i in range(size):
            total = total * _M1 + h[i : i + len(total)]
        return _distinct(_mix(total))


def _distinct(numbers):
    """Sorted distinct numbers."""
    numbers = np.sort(numbers)
    return numbers[np.append(True, numbers[1:] != numbers[:-1])[: len(numbers)]]


def _key(found):
    return hashlib.md5(found.tobytes()).digest() if len(found) else None


@lru_cache(maxsize=1)
def bands():
    """(least size, largest size, most differences k, parts n1) of each band; sets under 4 shingles only link if equal."""
    out, low = [], 4
    while low < 1 << 40:
        high = max(low + 1, int(low * BAND_GROWTH))
        k = 2 * high * (100 - PERCENT) // (100 + PERCENT)
        out.append((low, high, k, k // 2 + 2 + -(-k // 16)))
        low = high + 1
    return out


def _signatures(sets, band, frequent):
    """(set number, signature) arrays of some sets for one band."""
    _, _, k, parts = bands()[band]
    shingles = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    with np.errstate(over="ignore"):
        place = _mix(shingles + np.uint64(band + 1) * _M1)
        cell = owner * (parts * 3) + (place % np.uint64(parts * 3)).astype(np.int64)
        shape = (len(sets), parts, 3)
        content = np.zeros(len(sets) * parts * 3, np.uint64)
        np.add.at(content, cell, _mix(place ^ _M3))
        rare = _absent(shingles, frequent)
        content = content.reshape(shape)
        filled = np.bincount(cell, minlength=content.size).reshape(shape) > 0
        lit = np.bincount(cell[rare], minlength=content.size).reshape(shape) > 0
        # A set of n shingles links with sizes up to n * 100 / PERCENT, which bounds its own number of differences.
        n = np.array([len(s) for s in sets])
        most = np.minimum(k, (n + n * 100 // PERCENT) * (100 - PERCENT) // (100 + PERCENT))
        thin, bare = [((x.sum(axis=2) >= 2).sum(axis=1) <= most // 2)[:, None] for x in (lit, filled)]
        numbers, found = [], []
        part = np.arange(parts, dtype=np.uint64) + np.uint64(band << 40)
        for left_out in range(3):
            a, b = [j for j in range(3) if j != left_out]
            value = _mix(_mix(content[:, :, a] + part * _M1 + np.uint64(left_out)) + content[:, :, b] * _M2)
            emit = lit[:, :, a] | lit[:, :, b] | (thin & (filled[:, :, a] | filled[:, :, b])) | bare
            numbers.append(np.nonzero(emit)[0])
            found.append(value[emit])
    return np.concatenate(numbers), np.concatenate(found)


def _absent(numbers, known):
    """Which numbers are not in a sorted array."""
    if not len(known):
        return np.ones(len(numbers), bool)
    return known[np.minimum(np.searchsorted(known, numbers), len(known) - 1)] != numbers


def all_signatures(sets, frequent=np.zeros(0, np.uint64)):
    """(set number, signature) arrays. A set gives those of its own band, and of the next if it may link into it."""
    table = bands()
    lows = np.array([b[0] for b in table])
    sizes = np.array([len(s) for s in sets], np.int64)
    own = np.searchsorted(lows, sizes, "right") - 1
    wanted = {}
    for i, (n, band) in enumerate(zip(sizes.tolist(), own.tolist(), strict=True)):
        if n >= 4:
            wanted.setdefault(band, []).append(i)
            if n * 100 // PERCENT > table[band][1]:
                wanted.setdefault(band + 1, []).append(i)
    pairs = []
    for band, members in wanted.items():
        number, signature = _signatures([sets[i] for i in members], band, frequent)
        pairs.append((np.array(members)[number], signature))
    if not pairs:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])


def _describe(texts):
    """Sizes and keys of sets; with the first of a step, the shingles that several different sets of the step have."""
    found = [shingle_set(t) for t in texts]
    keys = [_key(s) for s in found]
    different = list({k: s for k, s in zip(keys, found) if k}.values())
    repeated = [None] * len(texts)
    if len(different) > 1:
        every = np.sort(np.concatenate(different))
        repeated[0] = _distinct(every[1:][every[1:] == every[:-1]]).astype("<u8").tobytes()
    return [len(s) for s in found], keys, repeated


def _frequent(info):
    """The shingles that most steps of texts repeat: a list of bounded length, sorted."""
    def run(batches):
        for batch in batches:
            for value in batch.column("repeated"):
                yield pa.RecordBatch.from_pydict({"shingle": pa.array(np.frombuffer(value.as_buffer(), "<i8"))})

    counts = info.where("repeated is not null").select("repeated").mapInArrow(run, "shingle long").groupBy("shingle").count()
    top = counts.where(F.col("count") >= LEAST_STEPS).orderBy(F.desc("count"), "shingle").limit(FREQUENT)
    return np.sort(np.array([r.shingle for r in top.select("shingle").collect()], np.int64).view(np.uint64))


def _signature_rows(docs, buckets, frequent):
    """Signatures of all sets, gathered per bucket of signatures: (bucket, alone, signatures, owners, nodes).

    What a step of texts holds twice is reported at once (alone = false) and goes on as one entry, so a signature that
    very many sets share reaches its bucket once a step.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        for batch in batches:
            for start, size in steps(batch.column("text"), 4_000_000):
                sets = {}
                for t in batch.column("text").slice(start, size).to_pylist():
                    s = shingle_set(t)
                    if len(s) >= 4:
                        sets.setdefault(_key(s), s)
                keys = list(sets)
                for lot in range(0, len(keys), 60_000):
                    chosen = keys[lot : lot + 60_000]
                    yield from _pack(chosen, [sets[k] for k in chosen], buckets, shared.value)

    schema = "bucket int, alone boolean, signatures binary, owners binary, nodes binary"
    return docs.select("text").where("text is not null").mapInArrow(run, schema)


def _pack(keys, sets, buckets, frequent):
    owner, signature = all_signatures(sets, frequent)
    order = np.argsort(signature)
    owner, signature = owner[order], signature[order]
    first = np.ones(len(signature), bool)
    first[1:] = signature[1:] != signature[:-1]
    run = np.cumsum(first) - 1
    shared = np.bincount(run)[run] > 1 if len(run) else first
    keys = np.array([np.frombuffer(k, "<u8") for k in keys]).reshape(-1, 2)
    rows = {n: [] for n in ("bucket", "alone", "signatures", "owners", "nodes")}
    for alone, chosen in ((True, first), (False, shared)):
        # Entries that are reported at once needn't meet others: they are dealt out by node.
        s, o = signature[chosen], owner[chosen]
        bucket = ((s if alone else keys[o, 0]) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket * len(keys) + o)
        s, o, bucket = s[order], o[order], bucket[order]
        cuts = (np.flatnonzero(np.diff(bucket)) + 1).tolist()
        for at, to in zip([0, *cuts], [*cuts, len(s)]) if len(s) else ():
            new = np.append(True, o[at + 1 : to] != o[at : to - 1])
            rows["bucket"].append(int(bucket[at]))
            rows["alone"].append(alone)
            rows["signatures"].append(_six_bytes(s[at:to]))
            rows["owners"].append((np.cumsum(new) - 1).astype("<u2").tobytes())
            rows["nodes"].append(keys[o[at:to][new]].astype("<u8").tobytes())
    types = [pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types, strict=True)], list(rows))


def _six_bytes(numbers):
    """The upper 48 bits; the lower ones chose the bucket, and a chance meeting is found out when sets are compared."""
    return (numbers >> np.uint64(16)).astype("<u8").view("u1").reshape(-1, 8)[:, :6].tobytes()


def _from_six(data):
    out = np.zeros((len(data) // 6, 8), "u1")
    out[:, :6] = np.frombuffer(data, "u1").reshape(-1, 6)
    return out.view("<u8").ravel()


def _shared(table):
    """Of one bucket: (signature, node) where several nodes have the signature."""
    bucket = table.column("bucket")[0].as_py()
    parts = {True: [], False: []}
    for alone, s, o, n in zip(*[table.column(c).to_pylist() for c in ("alone", "signatures", "owners", "nodes")]):
        nodes = np.frombuffer(n, "<u8").reshape(-1, 2)
        parts[alone].append((_from_six(s), nodes[np.frombuffer(o, "<u2")]))
    out = list(parts[False])
    if parts[True]:
        s, n = np.concatenate([p[0] for p in parts[True]]), np.concatenate([p[1] for p in parts[True]])
        # Most signatures are of one node: only the others need their nodes in order.
        order = np.argsort(s)
        s, n = s[order], n[order]
        run = np.cumsum(np.append(True, s[1:] != s[:-1])) - 1
        many = np.bincount(run)[run] > 1
        s, n = s[many], n[many]
        order = np.lexsort((n[:, 1], n[:, 0], s))
        s, n = s[order], n[order]
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]) | (n[1:] != n[:-1]).any(axis=1)
        s, n = s[new], n[new]
        run = np.cumsum(np.append(True, s[1:] != s[:-1])[: len(s)]) - 1
        many = np.bincount(run)[run] > 1 if len(run) else new
        out.append((s[many], n[many]))
    s, n = np.concatenate([p[0] for p in out]), np.concatenate([p[1] for p in out])
    # Signatures of different buckets must differ as numbers too.
    with np.errstate(over="ignore"):
        s = _mix(s)
    nodes = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(n), [None, pa.py_buffer(n.astype("<u8").tobytes())])
    return pa.table({"signature": pa.array(s.view("<i8")), "node": nodes.cast(pa.binary())})


#: Least intersection of linked sets of n_a and n_b shingles; what of two sets' parity bits differs at most.
_COMMON = f"(({PERCENT} * (n_a + n_b) + {99 + PERCENT}) div {100 + PERCENT})"
_WORDS = [f"w{i}" for i in range(PARITY_WORDS)]
_ALIKE = " + ".join(f"bit_count({w}_a ^ {w}_b)" for w in _WORDS) + f" <= n_a + n_b - 2 * {_COMMON}"


def _only(sets, nodes):
    """The sets of some nodes, given as a stored column of their name; the others aren't shuffled if the nodes are few."""
    few = nodes.count() <= SENT_NODES
    return sets.join((F.broadcast(nodes) if few else nodes).toDF("node"), "node", "left_semi")


def _verified(pairs, sets, parities):
    """Those of the pairs (a, b) of nodes whose sets are similar enough: first by parity bits, then by shingles."""
    for side in ("a", "b"):
        pairs = pairs.join(parities.toDF(side, f"n_{side}", *[f"{w}_{side}" for w in _WORDS]), side)
    pairs = storage.stored(pairs.where(_ALIKE).select("a", "b"), "links")
    nodes = storage.stored(pairs.select("a").union(pairs.select("b")).distinct(), "links")
    sets = storage.stored(_only(sets, nodes), "links")
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                both = np.concatenate([x, y])
                both.sort()
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * common >= PERCENT * (len(both) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))

    return pairs.join(one, "a").join(two, "b").select("a", "b", "set_a", "set_b").mapInArrow(run, "a binary, b binary")


def _prefix_matches(apart, sets, parities, frequent, buckets):
    """Pairs (a, b) of different components that could link, of the nodes (node, component, n) of apart.

    A node's shingles stand in one order for all: first those that one component alone has, which can't join two, then
    by the number of nodes that have them, the frequent ones last. Linked sets share one of the first
    n - ceil(0.8 n) + 1, at places that leave enough shingles behind; few unlike sets do. Shingles that only one
    component has never leave their bucket, and the frequent ones need no bucket to be known as shared. A set's parity
    bits (for each class of shingles, whether it holds an odd number of them) differ in at most as many places as the
    sets in shingles, so most of the unlike sets that still meet are told apart without their shingles.
    """
    spark = apart.sparkSession
    shared, often = spark.sparkContext.broadcast(frequent), 2**31 - 1

    def deal(batches):
        for batch in batches:
            for start, size in steps(batch.column("shingles"), 8_000_000):
                lot = batch.slice(start, size)
                found = [np.frombuffer(v.as_buffer(), "<u8") for v in lot.column("shingles")]
                shingle = np.concatenate(found)
                owner = np.repeat(np.arange(size), [len(f) for f in found])
                bucket = (_mix(shingle) % np.uint64(buckets)).astype(np.int64)
                # Frequent shingles needn't meet: they are dealt out by node, in rows of their own.
                by_node = np.array([int.from_bytes(k[:8], "little") % buckets for k in lot.column("nodes").to_pylist()])
                known = ~_absent(shingle, shared.value)
                bucket[known] = buckets + by_node[owner[known]]
                order = np.lexsort((owner, bucket))
                shingle, owner, bucket = shingle[order], owner[order], bucket[order]
                at = np.append(0, np.flatnonzero(np.diff(bucket)) + 1)
                rows = [(int(bucket[i]), shingle[i:j], owner[i:j]) for i, j in zip(at, [*at[1:], len(bucket)])]
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([b % buckets for b, _, _ in rows], pa.int32()),
                    "often": [b >= buckets for b, _, _ in rows],
                    "shingles": [s.tobytes() for _, s, _ in rows],
                    "owners": [_renumbered(o)[0].tobytes() for _, _, o in rows],
                    **{c: [np.array(lot.column(c).take(pa.array(_renumbered(o)[1])).to_pylist(), kind).tobytes()
                           for _, _, o in rows] for c, kind in (("nodes", "S16"), ("components", "<i8"), ("sizes", "<i8"))},
                })

    def meet(table):
        parts = []
        for often_too, s, o, nodes, c, n in zip(*[table.column(x).to_pylist() for x in names[1:]]):
            s, o = np.frombuffer(s, "<u8"), np.frombuffer(o, "<u4")
            parts.append((s, np.frombuffer(nodes, "V16")[o], np.frombuffer(c, "<i8")[o], np.frombuffer(n, "<i8")[o],
                          np.full(len(s), often if often_too else 0, np.int64)))
        s, node, c, n, held = [np.concatenate(x) for x in zip(*parts)]
        order = np.argsort(s)
        s, node, c, n, held = s[order], node[order], c[order], n[order], held[order]
        first = np.append(True, s[1:] != s[:-1])
        starts, run = np.flatnonzero(first), np.cumsum(first) - 1
        several = np.minimum.reduceat(c, starts) != np.maximum.reduceat(c, starts)
        keep = several[run] | (held > 0)
        held = np.where(held > 0, held, np.bincount(run)[run])[keep]
        node = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(held), [None, pa.py_buffer(node[keep].tobytes())])
        return pa.table({"shingle": s[keep].view("<i8"), "node": node.cast(pa.binary()), "component": c[keep],
                         "n": n[keep], "held": held})

    names = ["bucket", "often", "shingles", "owners", "nodes", "components", "sizes"]
    given = apart.select(F.col("node").alias("nodes"), F.xxhash64("component").alias("components"), F.col("n").alias("sizes"))
    dealt = given.join(_only(sets, apart.select("node").toDF("own")), F.expr("node = nodes")).select("shingles", "nodes", "components", "sizes").mapInArrow(
        deal, "bucket int, often boolean, shingles binary, owners binary, nodes binary, components binary, sizes binary"
    )
    met = dealt.groupBy("bucket").applyInArrow(meet, "shingle long, node binary, component long, n long, held long")
    met = met.groupBy("node", "component", "n").agg(F.array_sort(F.collect_list(F.struct("held", "shingle"))).alias("own"))
    least = f"(({PERCENT} * n + 99) div 100)"
    met = met.join(parities.drop("n"), "node")
    met = met.withColumn("alone", F.col("n") - F.size("own")).withColumn("prefix", F.expr(f"cast(n - {least} + 1 - alone as int)"))
    places = met.where("prefix > 0").select(
        "node", "component", "n", "alone", *_WORDS, F.posexplode(F.expr("slice(own, 1, prefix)")).alias("j", "s")
    )
    left = (F.col("n") - F.col("alone") - F.col("j")).alias("left")
    places = places.select(F.col("s.shingle").alias("shingle"), "node", "component", "n", left, *_WORDS)
    places = storage.stored(places, "links")
    joining = places.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    every, places = places, storage.stored(
        places.join(joining.where("low <> high").select("shingle"), "shingle", "left_semi"), "links"
    )
    storage.discarded(every)
    one, two = [
        places.toDF("shingle", side, f"component_{side}", f"n_{side}", f"left_{side}", *[f"{w}_{side}" for w in _WORDS])
        for side in ("a", "b")
    ]
    near = one.join(two, "shingle").where(f"a < b and component_a <> component_b and least(left_a, left_b) >= {_COMMON}")
    return near.where(_ALIKE).select("a", "b")


def _parities(sets):
    """(node, n, w0, w1, ...): the size and the parity bits of every set."""
    def run(batches):
        for batch in batches:
            found = [np.frombuffer(v.as_buffer(), "<u8") >> np.uint64(48) for v in batch.column("shingles")]
            odd = [np.bincount((f % (64 * PARITY_WORDS)).astype(np.int64), minlength=64 * PARITY_WORDS) % 2 for f in found]
            bits = np.packbits(np.array(odd, bool).reshape(len(odd), -1), axis=1).view("<i8").reshape(len(odd), -1)
            sizes = pa.array([len(f) for f in found], pa.int64())
            yield pa.RecordBatch.from_pydict({"node": batch.column("node"), "n": sizes, **{f"w{i}": w for i, w in enumerate(bits.T.copy())}})

    return sets.mapInArrow(run, "node binary, n long, " + ", ".join(f"{w} long" for w in _WORDS))


def _renumbered(owner):
    """(place of each entry's owner among the different owners, those) of ascending owners."""
    new = np.append(True, owner[1:] != owner[:-1])
    return (np.cumsum(new) - 1).astype("<u4"), owner[new]


def _links(members, sets, frequent, buckets):
    """(node, component) of the nodes that link with others; candidates are the nodes that share a signature.

    In a round, every group of a signature whose nodes lie in several components is compared with one of its members,
    another one each round. Near copies in large groups thus come together at a cost linear in the group. What is in
    groups of several components after STAR_ROUNDS is compared as _prefix_matches says.
    """
    spark = members.sparkSession
    parities = storage.stored(_parities(sets), "links")
    done = spark.createDataFrame([], "a binary, b binary")
    groups = spark.createDataFrame([], "node binary, component binary")
    fits = F.expr(f"100 * least(n_a, n_b) >= {PERCENT} * greatest(n_a, n_b)")
    for turn in range(STAR_ROUNDS + 1):
        at = members.join(groups, "node", "left") if turn else members.withColumn("component", F.col("node"))
        # One exchange serves the grouping and the join with its result.
        at = at.withColumn("component", F.coalesce("component", "node")).repartition("signature")
        # The node with the least scrambled number; the scrambling changes each round.
        order = F.struct(F.xxhash64("node", F.lit(turn)), "node", "component", "n")
        centre = at.groupBy("signature").agg(
            F.min(order).alias("c"), F.min("component").alias("low"), F.max("component").alias("high")
        ).where("low <> high")
        if turn < STAR_ROUNDS:
            centre = centre.select(
                "signature", F.col("c.node").alias("b"), F.col("c.component").alias("component_b"), F.col("c.n").alias("n_b")
            )
            near = at.withColumnRenamed("n", "n_a").join(centre, "signature").where("component <> component_b").where(fits)
            near = near.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b"))
        else:
            apart = at.join(centre.select("signature"), "signature", "left_semi").select("node", "component", "n").distinct()
            near = _prefix_matches(storage.stored(apart, "links"), sets, parities, frequent, buckets)
        pairs = storage.stored(near.distinct().join(done, ["a", "b"], "left_anti"), "links")
        found = storage.stored(_verified(pairs, sets, parities), "links")
        groups = connected_components(found.union(groups.select(F.col("node").alias("a"), F.col("component").alias("b"))))
        done = done.union(pairs)
    return groups


def near_duplicates(docs, doc_id="doc_id", text="text"):
    """One row per document: doc_id, n_shingles, component_id (least doc_id it is linked to, over any number of links).

    Words are runs of anything but the six ASCII spaces, A-Z in lower case; a set holds a document's distinct 5-word
    shingles, or all its words as one if they are fewer. Two documents link if 100 * intersection >= 80 * union. Null
    and empty texts have no shingles and link with nothing. Equal texts and repeated rows link, ties can't occur: the
    component is the least id. A null doc_id doesn't name a component; a document linked only with such ones, or with
    none, has its own id. An empty table gives an empty table; other columns are not read.

    Sets are told apart by 128-bit keys, shingles by 64-bit hashes.
    """
    return near_duplicate_classes(docs, doc_id, text).select("doc_id", "n_shingles", "component_id")


def text_key(text):
    """What tells the texts of one doc_id apart: 128 bits, null for a null text."""
    return F.unhex(F.md5(text))


def near_duplicate_classes(docs, doc_id="doc_id", text="text"):
    """The rows of near_duplicates with text_key and class: the key of the row's near-duplicate class.

    Unlike component_id, which repeated or null ids can lend to unlike texts, class names one class alone; it is null
    for texts without shingles.
    """
    docs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    fields = list(T.StructType.fromDDL("n_shingles long, node binary, repeated binary"))
    info = add_columns(docs, lambda: _describe, fields, ("text",)).withColumn("text_key", text_key("text")).drop("text")
    info = storage.stored(info, "near-duplicates")
    classes = storage.stored(
        info.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first"), F.first("n_shingles").alias("n")),
        "near-duplicates",
    )
    total = classes.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-int(total * 0.7) // BUCKET_ROWS))
    frequent = _frequent(info)
    rows = _signature_rows(docs, buckets, frequent)
    shared = rows.groupBy("bucket").applyInArrow(_shared, "signature long, node binary")
    members = storage.stored(shared.join(classes.select("node", "n"), "node"), "near-duplicates")
    wanted = storage.stored(members.select("node").distinct().join(classes, "node").select("node", "first"), "near-duplicates")
    texts = docs.join(wanted.select(F.col("first").alias("_first")).distinct(), F.expr("doc_id <=> _first"), "left_semi")

    def to_sets(texts):
        found = [shingle_set(t) for t in texts]
        return [_key(s) for s in found], [s.astype("<u8").tobytes() for s in found]

    sets = add_columns(texts, lambda: to_sets, [T.StructField("node", T.BinaryType()), T.StructField("shingles", T.BinaryType())])
    sets = sets.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"]).select("node", "shingles")
    groups = _links(members, storage.stored(sets, "near-duplicates"), frequent, buckets)
    labelled = classes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = labelled.groupBy("component").agg(F.min("first").alias("component_id"))
    named = labelled.join(least, "component").select("node", "component_id", F.col("component").alias("class"))
    named = storage.stored(named, "near-duplicates")
    return info.join(named, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "text_key", "class"
    )


def least_of_classes(docs, doc_id="doc_id", text="text"):
    """One row of each near-duplicate class, that with the least (doc_id, text), null ids last, and all rows of texts
    without shingles. Of rows equal in both, any one. Ids needn't be unique: only a row's own class decides."""
    found = near_duplicate_classes(docs, doc_id, text).where("class is not null")
    # As a struct, the id of a class can be null and is still the least there is.
    found = found.withColumn("id", F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id"))
    found = storage.stored(found.select("id", "text_key", "class"), "near-duplicates")
    least = found.groupBy("class").agg(F.min("id").alias("id"))
    prefix = spare_prefix(docs)
    own_id, own_key, own_class, own_row = [prefix + name for name in ("id", "key", "class", "row")]
    chosen = found.join(least, ["class", "id"]).select(
        F.col("id.doc_id").alias(own_id), F.col("text_key").alias(own_key), F.col("class").alias(own_class)
    ).distinct()
    columns = [F.col(f"`{c}`") for c in docs.columns]
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col(own_id)) & (text_key(F.col(f"`{text}`")) == F.col(own_key))
    rows = docs.join(chosen, same).groupBy(own_class).agg(F.min_by(F.struct(*columns), F.col(f"`{text}`")).alias(own_row))
    # Not in the join: whatever has no word is in no class.
    bare = F.translate(F.coalesce(F.col(f"`{text}`"), F.lit("")), " \t\n\x0b\f\r", "") == ""
    return rows.select(f"{own_row}.*").union(docs.where(bare).select(*columns))
