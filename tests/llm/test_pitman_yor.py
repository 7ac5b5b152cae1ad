import collections
import glob
import math
import os
import random

import numpy as np
import xxhash

from tallylake.llm import pitman_yor as py
from tallylake.llm import storage


def _pairs(text):
    words = [*(text or "").encode().lower().split(), b" end"]
    words = [xxhash.xxh64_intdigest(w) for w in words]
    return list(zip([int(py.END), *words], words))


def test_scores_come_from_the_restaurants_of_real_contexts(spark):
    """Hot and rare words and contexts mixed: every preceding word has its own counts, the probabilities of a context
    add up to one, and the scores of all texts follow from the sampled tables."""
    rng = random.Random(8)
    rare = [f"rare{i}" for i in range(1500)]
    texts = [" ".join(rng.choice(rare) if rng.random() < 0.6 else rng.choice(["the", "of", "hot"]) for _ in range(30))
             for _ in range(250)] + [None, "never seen words", "THE of"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    model, (hot, counts, p_hot), kept = py._sample(docs, 8, 0)
    seen = collections.Counter(p for i, t in enumerate(texts) if not py.is_held_out(i) for p in _pairs(t))
    assert 3 < len(hot) < 100 and len({u for u, _ in seen}) > 1000
    rows = collections.defaultdict(list)
    for r in sorted(kept.collect(), key=lambda r: (r.kind, r.part)):
        rows[r.bucket, r.kind].append(r)
    customers, tables, root = {}, [collections.Counter(), collections.Counter()], [{}, {}]
    for (bucket, kind), (r, *_) in list(rows.items()):
        if kind != "state":
            continue
        words, follow = np.frombuffer(r.c, "<u8"), np.frombuffer(r.d, "<u4")
        contexts = np.repeat(np.frombuffer(r.a, "<u8"), np.frombuffer(r.b, "<u4"))
        keys = list(zip(contexts.tolist(), words[follow].tolist()))
        assert not set(keys) & set(customers)
        customers |= dict(zip(keys, np.frombuffer(r.e, "<i8").tolist()))
        for at in range(2):
            tables[at].update(dict(zip(keys, np.frombuffer(rows[bucket, f"tables{at}"][0].a, "<u4").tolist())))
            answers = rows[bucket, f"answer{at}"]
            both = zip(*[py._cat([a[x] for a in answers], "<f8").tolist() for x in "ab"])
            for w, seats in zip(words.tolist(), both):
                assert root[at].setdefault(w, seats) == seats
    assert {k: n for k, n in customers.items() if n} == dict(seen)
    vocabulary = {w for _, w in seen}
    assert (model.n_words, model.n_tokens) == (len(vocabulary), sum(seen.values()))
    total_c, total_t = collections.Counter(), [collections.Counter(), collections.Counter()]
    for (u, w), n in seen.items():
        total_c[u] += n
        for at in range(2):
            assert 1 <= tables[at][u, w] <= n
            total_t[at][u] += tables[at][u, w]
    of_word = [collections.Counter(), collections.Counter()]
    for at in range(2):
        for (_, w), n in tables[at].items():
            of_word[at][w] += n
        assert all(root[at][w][0] == of_word[at][w] for w in vocabulary)

    def probability(u, w):
        out = 0
        for at in range(2):
            c, t = root[at].get(w, (0, 0))
            every_c, every_t = [sum(root[at][v][x] for v in vocabulary) for x in (0, 1)] if at not in sums else sums[at]
            sums[at] = every_c, every_t
            base = max(c - py.ROOT_DISCOUNT * t, 0) + (py.ROOT_STRENGTH + py.ROOT_DISCOUNT * every_t) / (len(vocabulary) + 1)
            base /= py.ROOT_STRENGTH + every_c
            own = seen.get((u, w), 0) - py.DISCOUNT * tables[at].get((u, w), 0)
            out += (own + (py.STRENGTH + py.DISCOUNT * total_t[at][u]) * base) / (py.STRENGTH + total_c[u])
        return out / 2

    sums = {}
    rare_context = next(u for u in total_c if u not in set(hot.tolist()))
    for u in [*hot[:3].tolist(), rare_context, 12345]:
        assert abs(sum(probability(u, w) for w in vocabulary) + probability(u, 1) - 1) < 1e-9
    got = {r.doc_id: r for r in py.language_scores(docs).collect()}
    assert len(got) == len(texts) and any(r.n_known < r.n_tokens for r in got.values())
    words = collections.Counter()
    for (_, w), n in seen.items():
        words[w] += n
    model, (hot, counts, p_hot), kept = py._sample(docs, py.LEAST_BUCKETS, 0)
    assert dict(zip(hot.tolist(), counts.tolist())) == {w: words[w] for w in hot.tolist()}
    for i, t in enumerate(texts):
        pairs = _pairs(t)
        base = sum(math.log10((words[w] + 1) / (sum(seen.values()) + len(vocabulary) + 1)) for _, w in pairs)
        assert got[i].n_tokens == len(pairs) and got[i].n_known == sum(w in vocabulary for _, w in pairs)
        assert abs(got[i].base_score - base) < 1e-6
    # The same sampling again, with 8 buckets, and its scores against the formula.
    values = kept8(spark, docs)
    for i, t in enumerate(texts):
        assert abs(values[i] - sum(math.log10(probability(u, w)) for u, w in _pairs(t))) < 1e-6


def kept8(spark, docs):
    """Scores by the seatings of 8 buckets."""
    model, hot_table, kept = py._sample(docs, 8, 0)
    values = kept.union(py._score_rows(docs, 8, hot_table)).groupBy("bucket").applyInArrow(
        lambda table: py._score_bucket(table, 8, model), py._SCHEMA
    )
    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return {r.doc_id: r.score for r in values.groupBy("part").applyInArrow(lambda t: py._sum_step(t, model), out).collect()}


def test_scoring_leaves_nothing_on_the_disk_but_the_scores(spark):
    """The messages of the rounds and the seatings go when no later round reads them, and scores are whole in parts."""
    docs = spark.createDataFrame([(i % 50, f"some words {i % 9} and more") for i in range(200)] + [(None, None)], "doc_id long, text string")
    root = storage.shared_root(spark).removeprefix("file://")
    before = set(glob.glob(f"{root}/*"))
    got = py.language_scores(docs)
    left = [n for f in set(glob.glob(f"{root}/*")) - before for n in glob.glob(f"{f}/**", recursive=True) if os.path.isfile(n)]
    assert left and {tuple(spark.read.parquet(n).columns) for n in left if n.endswith(".parquet")} == {tuple(got.columns)}
    assert not [n for n in left if n.endswith(".arrow")]
    assert sorted(r.doc_id for r in got.where("doc_id is not null").collect()) == sorted(i % 50 for i in range(200))
    assert got.where("doc_id is null").count() == 1
