"""A quality classifier without labels: heuristic labellers, their accuracies by EM, and a hashed linear scorer.

Each labeller votes good (+), bad (-) or abstains (0). Votes are independent given the kind of document, and
abstaining says nothing. The labellers overlap: every fault they look for is seen by two of them at least, and that two
agree is what tells a fault from a labeller's error. So bad documents are of several kinds, one for each pair of labellers
that agree beyond chance; EM finds the shares of the good documents and of the kinds, and each labeller's rate of bad
votes in each, from the counts of vote patterns.
The posterior of each pattern is the soft label of its documents. A logistic model over hashed word shapes and binned
measures learns these labels on a bounded sample and scores all documents.
"""

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.llm.arrow_columns import add_columns, without
from tallylake.llm.linear import fit_logistic, sigmoid

#: Documents (about) that the scorer learns from, and its hash buckets.
SAMPLE, BUCKETS = 8_000, 512
#: Weak prior of a labeller's rates, whatever the number of documents: one bad and one good vote in either class.
PRIOR_VOTES = 1.0
#: The start of EM is this far from certain.
DOUBT = 0.02
#: Two labellers overlap where the correlation of their bad votes is above this.
OVERLAP = 0.1
#: Documents with a lower probability of being good are rejected.
THRESHOLD = 0.5

_UPPER = bytes(range(65, 91))
_LETTER = bytes([*range(65, 91), *range(97, 123)])
_SYMBOL = b"#*$%&|<>@^~_=+\\{}[]"
_SHAPE = bytes(
    88 if 65 <= b <= 90 else 120 if 97 <= b <= 122 or b >= 128 else 57 if 48 <= b <= 57 else b for b in range(256)
)

#: measure, bad if below, bad if above, good from, good to; fewer words than the last number: abstain.
LABELLERS = (
    ("symbols", None, 0.08, 0.0, 0.02, 5),
    ("capitals", None, 0.40, 0.0, 0.15, 5),
    ("repeats", None, 0.20, 0.0, 0.05, 5),
    ("top_word", None, 0.25, 0.0, 0.15, 20),
    ("shouts", None, 0.30, 0.0, 0.05, 5),
    ("bare_marks", None, 0.20, 0.0, 0.02, 5),
    ("sentence", None, 80.0, 2.0, 40.0, 40),
    ("words", 1, None, 20, None, 0),
    ("symbol_runs", None, 0.20, 0.0, 0.05, 5),
    ("echoes", None, 0.20, 0.0, 0.06, 5),
)
#: Bins of each measure among the features; the hashed shapes of words come after them.
BINS = 16
_SYMBOL_RUN = re.compile(rb"([!-/:-@\[-`{-~])\1\1")


class _Shapes(dict):
    """word -> bucket of its shape: runs of one kind of character count as two, the first 12 characters of that count."""

    def __missing__(self, word):
        if len(self) > 200_000:
            self.clear()
        shape, out = word.translate(_SHAPE), bytearray()
        for b in shape:
            if len(out) < 2 or out[-1] != b or out[-2] != b:
                out.append(b)
        value = self[word] = xxhash.xxh32_intdigest(bytes(out[:12])) % (BUCKETS - BINS * len(LABELLERS)) + BINS * len(LABELLERS)
        return value


def measures(text):
    """(measures by name, words) of a text."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    size = max(1, len(raw))
    letters = len(raw) - len(raw.translate(None, _LETTER))
    marks = Counter(w for w in words if len(w) == 1 and not w.isalnum())
    top = Counter(words).most_common(1)
    ends = raw.count(b".") + raw.count(b"!") + raw.count(b"?") + raw.count("。".encode())
    found = {
        "symbols": (len(raw) - len(raw.translate(None, _SYMBOL))) / size,
        "capitals": (len(raw) - len(raw.translate(None, _UPPER))) / max(1, letters),
        "repeats": sum(a == b for a, b in zip(words, words[1:])) / max(1, n),
        "top_word": top[0][1] / n if n else 0.0,
        "shouts": raw.count(b"!!") / max(1, n),
        "bare_marks": sum(marks.values()) / max(1, n),
        "sentence": n / max(1, ends),
        "words": float(n),
        "symbol_runs": len(_SYMBOL_RUN.findall(raw)) / max(1, n),
        "echoes": sum(a == b for a, b in zip(words, words[2:])) / max(1, n),
    }
    return found, words


def vote(found):
    """One vote a labeller, as text of the signs +, - and 0."""
    out = []
    for name, below, above, low, high, least in LABELLERS:
        x = found[name]
        if found["words"] < least:
            out.append("0")
        elif (below is not None and x < below) or (above is not None and x > above):
            out.append("-")
        else:
            out.append("+" if x >= low and (high is None or x <= high) else "0")
    return "".join(out)


@dataclass
class LabelModel:
    """What EM found: the share of good documents, each labeller's rate of bad votes among the good and among all bad
    documents, the pairs of labellers whose agreement the kinds of bad documents started from (names are their places in
    LABELLERS), and the probability of a good document for each pattern of votes."""

    share: float = 0.5
    false_alarms: list = field(default_factory=list)
    detections: list = field(default_factory=list)
    pairs: list = field(default_factory=list)
    posterior: dict = field(default_factory=dict)

    def accuracies(self):
        """Each labeller's share of right votes, if it voted on every document."""
        return [self.share * (1 - f) + (1 - self.share) * d for f, d in zip(self.false_alarms, self.detections, strict=True)]


def overlapping_pairs(counts, bad, voted):
    """Each labeller with the one whose bad votes agree best with its own, by their correlation over the documents that
    both vote on, if that is above OVERLAP."""
    both = voted.T @ (counts[:, None] * voted)
    agreed = bad.T @ (counts[:, None] * bad)
    own = bad.T @ (counts[:, None] * voted)  # bad votes of the first among the documents that both vote on
    n = np.maximum(both, 1)
    spread = np.sqrt(own * (n - own) * own.T * (n - own.T))
    correlation = np.where(spread > 0, (agreed * n - own * own.T) / np.maximum(spread, 1e-9), 0)
    np.fill_diagonal(correlation, 0)
    best = correlation.argmax(axis=1)
    return sorted({(min(i, j), max(i, j)) for i, j in enumerate(best.tolist()) if correlation[i, j] > OVERLAP})


def label_model(patterns, rounds=500):
    """The LabelModel of (pattern, count) pairs, by EM.

    A kind of bad documents starts as those that both labellers of a pair call bad; what no pair agrees on starts as good.
    Without a pair there is one kind, which starts as the documents with a bad vote. Rates are smoothed by PRIOR_VOTES
    votes of either sort, shares by one document. A pattern of abstentions alone has the share of good documents.
    """
    if not patterns:
        return LabelModel()
    counted = Counter()
    for pattern, n in patterns:
        counted[pattern] += n
    names = sorted(counted)
    counts = np.array([counted[p] for p in names], float)
    bad, fine = [np.array([[c == sign for c in p] for p in names], float) for sign in "-+"]
    pairs = overlapping_pairs(counts, bad, bad + fine)
    kinds = [bad[:, i] * bad[:, j] for i, j in pairs] or [bad.any(axis=1).astype(float)]
    belief = np.stack([1 - np.max(kinds, axis=0), *kinds], axis=1)
    belief = DOUBT + belief / belief.sum(axis=1, keepdims=True)
    belief /= belief.sum(axis=1, keepdims=True)
    for _ in range(rounds):
        weight = counts[:, None] * belief
        share = (weight.sum(axis=0) + 1) / (counts.sum() + belief.shape[1])
        no, yes = weight.T @ bad + PRIOR_VOTES, weight.T @ fine + PRIOR_VOTES
        rates = no / (no + yes)
        logs = np.log(share) + bad @ np.log(rates).T + fine @ np.log1p(-rates).T
        before, belief = belief, np.exp(logs - np.logaddexp.reduce(logs, axis=1, keepdims=True))
        if np.abs(belief - before).max() < 1e-9:
            break
    detections = share[1:] @ rates[1:] / share[1:].sum()
    posterior = dict(zip(names, belief[:, 0].tolist(), strict=True))
    return LabelModel(float(share[0]), rates[0].tolist(), detections.tolist(), pairs, posterior)


def features(found, words, shapes):
    """Hashed features of a document: bins of its measures, and the shares of its words' shapes."""
    x = np.zeros(BUCKETS)
    for i, (name, *_) in enumerate(LABELLERS):
        scaled = found[name] if name in ("words", "sentence") else found[name] * 1000
        x[i * BINS + min(BINS - 1, int(np.log2(1 + scaled)))] = 1
    if words:
        places = np.fromiter(map(shapes.__getitem__, words), np.int64, len(words))
        x += np.bincount(places, minlength=BUCKETS) / len(words)
    return x


def _hashable(docs):
    """The columns that the engine can hash: all but maps and variants."""
    return [F.col(f"`{f.name}`") for f in docs.schema if not re.search(r"map<|variant", f.dataType.simpleString())]


def fit(docs, text="text", sample=SAMPLE):
    """Weights of the scorer and the LabelModel, from all documents' votes and a sample's features.

    Vote patterns are counted over all documents; there are at most 3 to the power of the labellers of them. The scorer
    learns from about `sample` documents, chosen by a hash of the row, at most twice as many.
    """
    plain = docs.select(F.col(f"`{text}`").alias("text"), F.xxhash64(*_hashable(docs)).alias("h"))
    fields = [T.StructField("votes", T.StringType())]
    voted = add_columns(plain, lambda: lambda texts: [[vote(measures(t)[0]) for t in texts]], fields).drop("text")
    counts = [(r.votes, r["count"]) for r in voted.groupBy("votes").count().collect()]
    labels = label_model(counts)
    total = sum(n for _, n in counts)
    chosen = plain.where(F.pmod("h", F.lit(1 << 20)) < int(min(1.0, sample / max(1, total)) * (1 << 20)) + 1)

    def make():
        shapes = _Shapes()

        def run(texts):
            rows = [measures(t) for t in texts]
            return [vote(f) for f, _ in rows], [features(f, w, shapes).astype("<f4").tobytes() for f, w in rows]

        return run

    fields = [T.StructField("votes", T.StringType()), T.StructField("x", T.BinaryType())]
    rows = add_columns(chosen, make, fields).select("h", "votes", "x").orderBy("h").limit(2 * sample).collect()
    x = np.array([np.frombuffer(r.x, "<f4") for r in rows], float).reshape(-1, BUCKETS)
    return fit_logistic(x, np.array([labels.posterior[r.votes] for r in rows]), ridge=0.1), labels


def score(docs, weights, text="text", threshold=THRESHOLD):
    """docs with quality_score (probability of a good document) and accepted (score >= threshold)."""
    def make():
        shapes = _Shapes()

        def run(texts):
            x = np.array([features(*measures(t), shapes) for t in texts]).reshape(-1, BUCKETS)
            return [sigmoid(x @ weights[:-1] + weights[-1]).tolist()]

        return run

    scored = add_columns(docs.select(*without(docs, ["accepted"])), make,
                         [T.StructField("quality_score", T.DoubleType())], (text,))
    return scored.withColumn("accepted", F.col("quality_score") >= threshold)


def classify(docs, text="text"):
    """docs with quality_score and accepted, from a model fitted to them.

    Null and empty texts have no words, which the labellers call bad. Equal texts get equal scores, repeated rows
    included. An empty table gives an empty table. Columns named quality_score or accepted are replaced, others stay.
    """
    weights, _ = fit(docs.select(*[F.col(f"`{c}`") for c in docs.columns]), text)
    return score(docs, weights, text)
