import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallylake.llm import (
    components, decontamination, jaccard_join, pitman_yor, quality_model, quality_rules, storage, toxicity, warc,
)


def test_decontamination(spark):
    item = " ".join(f"w{i}" for i in range(12))
    bench = spark.createDataFrame([(1, item), (2, "Short One"), (None, "q r s"), (3, None), (1, item)], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "x " + item + " y"), (2, "a SHORT-one b short one"), (3, None), (4, " ".join(item.split()[:9])), (5, "p q r s")],
        "doc_id long, text string",
    )
    expected = [(1, 14, 12, ["1"]), (2, 6, 4, ["2"]), (3, 0, 0, []), (4, 9, 0, []), (5, 4, 3, [""])]
    for size in (500_000, 2):  # one block, and several
        got = decontamination.contamination(docs, bench, block_words=size).orderBy("doc_id").collect()
        assert [(r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in got] == expected
        assert [r.contaminated for r in got] == [True, True, False, False, True]
    assert decontamination.contamination(docs, bench.limit(0)).where("contaminated").count() == 0


def brute_components(texts):
    sets = {}
    for d, t in texts:
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(5)
    shared = [f"s{i}" for i in range(30)]
    rows = [(0, None), (1, ""), (2, "one two"), (3, "ONE two"), (4, "one two three")]
    for family in range(25):
        words = [f"f{family}w{rng.randrange(400)}" for _ in range(rng.choice([6, 9, 20, 60, 150, 400]))]
        if family % 3 == 0:
            words[len(words) // 2 : 0] = shared
        for _ in range(rng.choice([1, 2, 6])):
            copy = list(words)
            for _ in range(rng.randrange(0, max(2, len(words) // 40))):
                copy[rng.randrange(len(copy))] = f"edit{rng.random()}"
            rows.append((len(rows), " ".join(copy)))
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)


@pytest.mark.parametrize("least_steps", [1, 99])
def test_rarest_shingles_find_all_links_alone(spark, monkeypatch, least_steps):
    """Without a star round, and with or without a list of frequent shingles, borderline copies link as in brute force."""
    monkeypatch.setattr(jaccard_join, "STAR_ROUNDS", 0)
    monkeypatch.setattr(jaccard_join, "LEAST_STEPS", least_steps)
    rng = random.Random(6)
    base, passage = [[f"{x}{i}" for i in range(n)] for x, n in (("b", 120), ("p", 60))]
    rows = []
    for i in range(120):
        words = list(base) if i % 2 else [f"u{i}w{j}" for j in range(20)] + passage
        for _ in range(rng.randrange(6) if i % 2 else 0):
            words[rng.randrange(len(words))] = f"edit{rng.random()}"
        rows.append((i, " ".join(words)))
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    expected = brute_components(rows)
    assert 2 < len({c for _, c in expected.values()}) < 120
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.component for r in components.connected_components(edges).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_quality_rules(spark, odd_docs):
    text = "a b c d e f a b c d e # f g\nsame line\nsame line\n \n"
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    got = quality_rules.judge(docs).orderBy("doc_id").collect()
    assert (got[0].n_words, got[0].n_symbols, got[0].n_dup_lines, got[0].n_repeat_words) == (18, 1, 1, 10)
    assert got[0].base_failed and [r.kept for r in got[1:]] == [False, False]
    clashing = odd_docs.selectExpr("*", "4 AS _words", "5 AS _text", "6 AS _n", "7 AS __places")
    judged = quality_rules.judge(clashing)
    assert [c for c in clashing.columns if c not in judged.columns] == [] and judged.count() == odd_docs.count()
    assert [tuple(r) for r in judged.select("_words", "_text", "_n", "__places").distinct().collect()] == [(4, 5, 6, 7)]


def test_a_text_without_stop_words_fails_by_that_rule_alone(spark):
    words = [f"granite{i}" for i in range(19)]
    texts = [" ".join(words + ["river"]), " ".join(words + ["The"]), " ".join(words)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.kept for r in quality_rules.judge(docs).orderBy("doc_id").collect()] == [False, True, True]
    others = [r for r in quality_rules.RULES if r.measure != "stop_word_pct"]
    assert [r.kept for r in quality_rules.judge(docs, others).orderBy("doc_id").collect()] == [True] * 3


def test_quality_model_finds_junk(spark):
    rng = random.Random(2)
    clean = [" ".join(rng.choice("the of and rivers stones towers quiet walked under".split()) for _ in range(80)).replace(
        " the ", ". The ") for _ in range(60)]
    junk = [" ".join(w + "$$$" for w in c.split()) for c in clean[:6]] + ["BUY!! NOW!! " * 40] * 3 + [None, ""]
    docs = spark.createDataFrame(list(enumerate(clean + junk)), "doc_id long, text string")
    got = {r.doc_id: r.accepted for r in quality_model.classify(docs).collect()}
    assert all(got[i] for i in range(60)) and not any(got[i] for i in range(60, 69))
    assert quality_model.classify(docs.limit(0)).count() == 0


def _patterns(rates, abstains, shares, n, seed):
    """(patterns of votes, kinds of the documents) of labellers with known rates of bad votes by kind."""
    rng = np.random.default_rng(seed)
    kind = rng.choice(len(shares), n, p=shares)
    bad, silent = rng.random((n, len(abstains))) < np.array(rates)[kind], rng.random((n, len(abstains))) < np.array(abstains)
    return ["".join("0" if s else "-" if b else "+" for s, b in zip(*row)) for row in zip(silent, bad)], kind


@pytest.mark.parametrize("seed", range(3))
def test_label_model_finds_known_accuracies(seed):
    good, first, second = [.02, .03, .01, .02, .3, .05], [.9, .7, .02, .05, .35, .4], [.05, .03, .8, .85, .3, .4]
    votes, kind = _patterns([good, first, second], [.1, .2, 0, .3, .1, .1], [.8, .12, .08], 20_000, seed)
    model = quality_model.label_model(list(collections.Counter(votes).items()))
    assert {(0, 1), (2, 3)} <= set(model.pairs) and abs(model.share - .8) < .02
    assert np.abs(np.array(model.false_alarms) - good).max() < .02
    bad = (.12 * np.array(first) + .08 * np.array(second)) / .2
    assert np.abs(np.array(model.detections) - bad).max() < .05
    assert np.abs(np.array(model.accuracies()) - (.8 * (1 - np.array(good)) + .2 * bad)).max() < .02
    right = np.mean([(model.posterior[v] >= .5) == (k == 0) for v, k in zip(votes, kind)])
    any_bad_vote = np.mean([("-" not in v) == (k == 0) for v, k in zip(votes, kind)])
    assert right > .93 > .75 > any_bad_vote  # the fifth labeller's bad votes alone convince nobody
    halves = [(p, n // 2 + odd * (n % 2)) for p, n in collections.Counter(votes).items() for odd in (0, 1)]
    assert quality_model.label_model(halves).false_alarms == model.false_alarms


def test_label_model_of_few_votes():
    assert quality_model.label_model([]).posterior == {}
    silent = quality_model.label_model([("000", 7)])
    assert silent.posterior["000"] == pytest.approx(silent.share)
    assert quality_model.label_model([("+++", 90), ("---", 10)]).posterior["---"] < .01


@pytest.mark.parametrize("categories", [(), ("insult", "contempt")])
def test_toxicity_chain(spark, categories):
    rng = random.Random(3)
    words = [f"plain{i}" for i in range(200)]
    texts = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(300)]
    kind = [("", "you blockhead, you blockhead", "loathsome rubbish", "blockhead, loathsome")[max(0, i % 10 - 6)] for i in range(300)]
    texts = [f"{t} {k}" for t, k in zip(texts, kind)]
    docs = spark.createDataFrame([*enumerate(texts), (900, None), (901, ""), (5, texts[5])], "doc_id long, text string")
    docs = docs.withColumns({"IS_TOXIC": F.lit("x"), "_id": F.lit(1), "_label": F.lit(2)})
    marks = [(i, "blockhead" in k, "loathsome" in k, int(bool(k))) for i, k in enumerate(kind[:200])]
    labels = spark.createDataFrame(marks + [(None, None, None, 1), (7, None, None, None)],
                                   "doc_id long, insult boolean, contempt boolean, toxic int")
    found = toxicity.toxicity(docs, labels, categories=categories)
    got = {r.doc_id: r for r in found.collect()}
    assert [got[i].is_toxic for i in range(300)] == [bool(k) for k in kind]
    assert not got[900].is_toxic and not got[901].is_toxic and got[900]._id == 1 and found.count() == 303
    if categories:
        assert [got[i].p_insult > .5 for i in range(300)] == ["blockhead" in k for k in kind]
        assert [got[i].p_contempt > .5 for i in range(300)] == ["loathsome" in k for k in kind]
    else:  # the kinds are found from the words alone
        likely = [max(range(3), key=lambda j, i=i: got[i][f"p_kind_{j + 1}"]) for i in range(300)]
        assert {len({x for x, k in zip(likely, kind) if k == text}) for text in set(kind) - {""}} == {1}
        assert len({x for x, k in zip(likely, kind) if k}) > 1
    assert toxicity.toxicity(docs, labels.limit(0), categories=categories).where("p_toxic = 0.5").count() == 303
    assert toxicity.toxicity(docs.limit(0), labels, categories=categories).count() == 0


def test_language_scores_sum_to_one(spark):
    texts = ["the cat sat", "the dog sat", "a cat ran", None, "the cat sat on unknown"] * 8
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = pitman_yor.language_scores(docs).collect()
    assert len(got) == 40 and {r.train_tokens for r in got} == {
        sum(len((texts[i] or "").split()) + 1 for i in range(40) if not pitman_yor.is_held_out(i))
    }
    assert all(r.score < 0 and r.score > r.base_score * 1.5 for r in got if r.n_tokens > 2)
    # The probabilities of all known words and of the unknown one add up to one after any class.
    model, (words, counts, p) = pitman_yor._fit(docs.select("doc_id", "text"), 64)
    assert len(words) == model.n_words  # all are hot here
    base = 1 / (model.n_words + 1)
    for c in range(0, 256, 51):
        unknown = 0
        for s in range(len(model.tables)):
            customers, tables = model.root[s]
            top = (pitman_yor.ROOT_STRENGTH + pitman_yor.ROOT_DISCOUNT * tables) * base / (pitman_yor.ROOT_STRENGTH + customers)
            unknown += (pitman_yor.STRENGTH + pitman_yor.DISCOUNT * model.tables[s][c]) * top / (
                pitman_yor.STRENGTH + model.customers[c])
        assert abs(p[:, c].sum() + unknown / len(model.tables) - 1) < 1e-9
    assert pitman_yor.language_scores(docs.limit(0)).count() == 0


def test_warc(spark, tmp_path):
    rows = [(3, "http://x/\r\ny", "<p>é</p>"), (1, None, "<p>é</p>"), (2, "u", None), (7, "u", ""), (None, "n", "only"), (9, "z", "k" * 200_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = warc.write_warc(pages, storage.new_folder(spark, "warc"))
    got = {r.source_id: r for r in warc.read_warc(spark, folder).collect()}
    assert got["3"].record_type == "revisit" and got["3"].refers_to_source_id == "1" and got["3"].payload is None
    assert got["3"].refers_to == got["1"].record_id and got["3"].payload_bytes == 9
    assert got["7"].refers_to_source_id == "2" and got["2"].record_type == "response"
    assert bytes(got["9"].payload) == b"k" * 200_000 and got["9"].payload_digest == warc.digest(b"k" * 200_000)
    responses = warc.read_warc(spark, folder, payload=False).where("record_type = 'response' and payload_digest is not null")
    assert collections.Counter(r.payload is None for r in responses.collect()) == {True: 4}
    import gzip

    plain = [warc._record(i, "u", b"body%d" % i, None, "1970-01-01T00:00:00Z") for i in range(3)]
    (tmp_path / "a.warc").write_bytes(b"".join(plain))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, plain)))
    foreign = warc.read_warc(spark, str(tmp_path)).collect()
    assert sorted(bytes(r.payload) for r in foreign) == sorted([b"body0", b"body1", b"body2"] * 2)
    empty = warc.write_warc(pages.limit(0), storage.new_folder(spark, "warc"))
    assert warc.read_warc(spark, empty).count() == 0


def test_sets_are_not_shuffled_to_choose_a_few(spark, monkeypatch):
    """Few nodes go to all tasks, however small tables Spark itself would send; many are joined as usual."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    sets = storage.stored(spark.range(50).selectExpr("cast(cast(id AS string) AS binary) AS node", "id AS shingles"), "test")
    nodes = storage.stored(sets.where("shingles % 7 = 0").select(F.col("node").alias("a")), "test")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most, join in ((7, "SortMergeJoin"), (8, "BroadcastHashJoin")):
            monkeypatch.setattr(jaccard_join, "SENT_NODES", most)
            chosen = jaccard_join._only(sets, nodes)
            assert join in chosen._jdf.queryExecution().executedPlan().toString()
            assert sorted(r.shingles for r in chosen.collect()) == list(range(0, 50, 7))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_components_leave_one_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "shared_root", lambda spark: str(tmp_path))
    edges = spark.range(40).selectExpr("id AS a", "id + 1 AS b")
    got = {r.node: r.component for r in components.connected_components(edges).collect()}
    assert got == dict.fromkeys(range(41), 0)
    assert len(list(tmp_path.iterdir())) == 1
