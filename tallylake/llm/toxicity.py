"""Toxicity by a classifier chain over hashed words.

Categories are predicted one after the other, toxic as a whole last. Each is a logistic model over the shares of a text's
words that fall into hash buckets; it also sees the probabilities of the categories before it. In training those come
from models that did not see the document (out of fold), so that later models learn how far to trust them.

The labels may name categories. Where they don't, the earlier categories are kinds of toxic documents: clusters by the
words that tell toxic training documents from others.
"""

import re
from collections import Counter
from itertools import chain

import numpy as np
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.llm.arrow_columns import add_columns, without
from tallylake.llm.linear import fit_logistic, sigmoid

#: Labelled documents (about) that are learned from, hash buckets, words kept for a model, and folds.
SAMPLE, BUCKETS, KEPT, FOLDS = 16_000, 1 << 18, 200, 4
#: Kinds of toxic documents where labels name no categories.
KINDS = 3
#: Lengths of the word beginnings that count as features.
STEMS = (4, 5, 6)
#: A bucket with this share of a text's words has half its full value; the values are stored in 16 bits.
HALF_SHARE, FULL = 0.02, 65_535
RIDGE, THRESHOLD = 0.05, 0.5

_WORD = re.compile(r"[^\W\d_]+")


def buckets_of(word):
    """Hash buckets of a word and of its first letters, which inflected forms share."""
    parts = {word, *[word[:n] + "-" for n in STEMS if n <= len(word)]}
    return tuple({xxhash.xxh32_intdigest(p) % BUCKETS for p in parts})


class _Remembered(dict):
    """word -> find(word), for the last 100,000 words or so."""

    def __init__(self, find):
        super().__init__()
        self.find = find

    def __missing__(self, word):
        if len(self) > 100_000:
            self.clear()
        value = self[word] = self.find(word)
        return value


def _words(text):
    return Counter(_WORD.findall(text.lower())) if text else Counter()


def _values(shares):
    return shares / (shares + HALF_SHARE)


def word_features(text, find):
    """(sorted hash buckets of a text's words and their beginnings, their values in 16 bits)."""
    counts = _words(text)
    found = list(map(find, counts))
    flat = np.fromiter(chain.from_iterable(found), np.int32)
    buckets, place = np.unique(flat, return_inverse=True)
    times = np.repeat(np.fromiter(counts.values(), np.int64, len(counts)), list(map(len, found)))
    shares = np.bincount(place, weights=times, minlength=len(buckets)) / max(1, counts.total())
    return buckets, np.round(_values(shares) * FULL).astype("<u2")


def dense(rows, buckets):
    """Values of some buckets (sorted) in rows of (buckets, values in 16 bits)."""
    x = np.zeros((len(rows), len(buckets)))
    for i, (places, values) in enumerate(rows):
        at = np.searchsorted(buckets, places)
        there = at < len(buckets)
        there[there] = buckets[at[there]] == places[there]
        x[i, at[there]] = values[there] / FULL
    return x


class Link:
    """One model of the chain: the buckets it looks at, their weights, and those of earlier categories."""

    def __init__(self, rows, earlier, target):
        self.buckets = screen(rows, target)
        self.weights = fit_logistic(np.hstack([dense(rows, self.buckets), earlier]), target, ridge=RIDGE)

    def predict(self, values, earlier):
        """Probabilities; values(buckets): the texts' values of some buckets."""
        x = np.hstack([values(self.buckets), earlier])
        return sigmoid(x @ self.weights[:-1] + self.weights[-1])


def screen(rows, target):
    """The buckets whose presence differs most between the classes, by chi-square; at most KEPT."""
    n, positive = len(rows), target.sum()
    if not n or positive in (0, n):
        return np.zeros(0, np.int64)
    there, hit = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for at in range(0, n, 1000):
        part = [r[0] for r in rows[at : at + 1000]]
        flat, of_rows = np.concatenate(part), np.repeat(target[at : at + 1000], list(map(len, part)))
        there += np.bincount(flat, minlength=BUCKETS)
        hit += np.bincount(flat, weights=of_rows, minlength=BUCKETS)
    expected = there * positive / n
    spread = np.maximum(expected * (1 - positive / n) * (1 - there / n), 1e-9)
    chi = np.where(there >= 3, (hit - expected) ** 2 / spread, 0)
    best = np.lexsort((np.arange(BUCKETS), -chi))[:KEPT]
    return np.sort(best[chi[best] > 20])


def kinds(rows, toxic, rounds=20):
    """0/1 for each of KINDS kinds of toxic documents, by size: clusters by the direction of their values of the buckets
    that tell them from others. A document without such a bucket is of no kind."""
    out = np.zeros((len(rows), KINDS))
    places = np.flatnonzero(toxic)
    x = dense([rows[i] for i in places], screen(rows, toxic))
    length = np.linalg.norm(x, axis=1)
    places, x = places[length > 0], x[length > 0] / length[length > 0, None]
    if not len(x):
        return out
    centres = x[:1]
    while len(centres) < KINDS:  # the document least like the centres so far
        centres = np.vstack([centres, x[(x @ centres.T).max(axis=1).argmin()]])
    for _ in range(rounds):
        which = (x @ centres.T).argmax(axis=1)
        sums = np.stack([x[which == k].sum(axis=0) for k in range(KINDS)])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    order = np.argsort(-np.bincount(which, minlength=KINDS), kind="stable")
    out[places, np.argsort(order)[which]] = 1
    return out


def fit_chain(rows, targets, folds):
    """Links for rows of (buckets, values), targets (rows x categories) and each row's fold."""
    earlier, links = np.zeros((len(rows), 0)), []
    for c in range(targets.shape[1]):
        target = targets[:, c].astype(float)
        links.append(Link(rows, earlier, target))
        out = np.zeros(len(rows))
        for fold in range(FOLDS) if c + 1 < targets.shape[1] else ():
            test, train = np.flatnonzero(folds == fold), np.flatnonzero(folds != fold)
            if len(test) and len(train):
                part = Link([rows[i] for i in train], earlier[train], target[train])
                out[test] = part.predict(lambda b, test=test: dense([rows[i] for i in test], b), earlier[test])
        earlier = np.column_stack([earlier, out])
    return links


def predict_chain(links, values, n):
    """Probabilities of n texts for each category; values(buckets): the texts' values of some buckets."""
    found = np.zeros((n, 0))
    for link in links:
        found = np.column_stack([found, link.predict(values, found)])
    return found


class Scorer:
    """Probabilities of texts by a chain. Only words that fall into a bucket of some link are looked at."""

    def __init__(self, links):
        self.links = links
        self.buckets = np.unique(np.concatenate([link.buckets for link in links]))
        places = dict(zip(self.buckets.tolist(), range(len(self.buckets)), strict=True))
        self.known = _Remembered(lambda w: tuple(places[b] for b in buckets_of(w) if b in places))

    def __call__(self, texts):
        x = np.zeros((len(texts), len(self.buckets)))
        for row, text in zip(x, texts, strict=True):
            counts = _words(text)
            for word, n in counts.items():
                for place in self.known[word]:
                    row[place] += n
            row /= max(1, counts.total())
        x = np.round(_values(x) * FULL) / FULL
        found = predict_chain(self.links, lambda b: x[:, np.searchsorted(self.buckets, b)], len(texts))
        return list(found.T.tolist()) if len(texts) else [[] for _ in self.links]


def fit(docs, labels, doc_id="doc_id", text="text", label="toxic", categories=(), sample=SAMPLE):
    """The chain, learned from about `sample` labelled documents, chosen by a hash of their id; at most twice as many.

    categories: label columns that come before `label` in the chain; without any, kinds of toxic documents are found. A
    document labelled twice has what one label says. Null ids and null `label`s are left out, other null labels say no.
    """
    names = [*categories, label]
    marks = [(F.col(f"`{c}`").cast("double") != 0).alias(f"_label{i}") for i, c in enumerate(names)]
    marks = labels.select(F.col(f"`{doc_id}`").alias("_id"), *marks).dropna(subset=["_id", f"_label{len(names) - 1}"])
    marks = marks.groupBy("_id").agg(*[F.max(f"_label{i}").alias(f"_label{i}") for i in range(len(names))])
    marks = marks.withColumn("_h", F.xxhash64("_id"))
    share = min(1.0, sample / max(1, marks.count()))
    marks = marks.where(F.pmod("_h", F.lit(1 << 20)) < int(share * (1 << 20)) + 1).orderBy("_h").limit(2 * sample)
    plain = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("text"))
    # The limit bounds what is broadcast: 2 * sample ids.
    labelled = plain.join(F.broadcast(marks), "_id")

    def make():
        known = _Remembered(buckets_of)

        def run(texts):
            found = [word_features(t, known.__getitem__) for t in texts]
            return [b.astype("<i4").tobytes() for b, _ in found], [v.tobytes() for _, v in found]

        return run

    rows = add_columns(labelled, make, list(T.StructType.fromDDL("x binary, v binary")))
    y = F.array(*[F.coalesce(f"_label{i}", F.lit(False)).cast("int") for i in range(len(names))]).alias("y")
    rows = rows.select("_h", "x", "v", y).orderBy("_h", "x").limit(2 * sample).collect()
    x = [(np.frombuffer(r.x, "<i4"), np.frombuffer(r.v, "<u2")) for r in rows]
    targets = np.array([r.y for r in rows], float).reshape(-1, len(names))
    if not categories:
        targets = np.hstack([kinds(x, targets[:, 0]), targets])
    return fit_chain(x, targets, np.array([r._h % FOLDS for r in rows], int))


def predict(docs, links, text="text", categories=(), threshold=THRESHOLD):
    """docs with a probability for each category of the chain (p_kind_1 and so on, or p_ and the names of the categories,
    and p_toxic) and is_toxic."""
    names = [f"p_{c}" for c in (*(categories or [f"kind_{i + 1}" for i in range(KINDS)]), "toxic")]
    fields = [T.StructField(n, T.DoubleType()) for n in names]
    scored = add_columns(docs.select(*without(docs, ["is_toxic"])), lambda: Scorer(links), fields, (text,))
    return scored.withColumn("is_toxic", F.col("p_toxic") >= threshold)


def toxicity(docs, labels, doc_id="doc_id", text="text", label="toxic", categories=()):
    """docs with a probability for each category, p_toxic and is_toxic, by a chain learned from labels (see fit, predict).

    Null and empty texts have no words and get the models' base probabilities; very long texts are read whole, their
    words counted. Without labels, or with one class only, all probabilities are that of the class (one half without
    any). Equal texts get equal results, repeated rows included; an empty table gives an empty table; columns that bear a
    new name are replaced, others stay.
    """
    links = fit(docs, labels, doc_id, text, label, categories)
    return predict(docs, links, text, categories)
