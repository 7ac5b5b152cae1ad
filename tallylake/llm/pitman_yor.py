"""Language-model scores by a hierarchical Pitman-Yor model.

Each preceding word has a restaurant of its own; all of them share the root restaurant as parent, whose base measure is
uniform over the training words and one unknown. A token is a customer of its context's restaurant, a table there is a
customer of the root. The seating of each dish is sampled in blocks of a Gibbs sweep: all customers of a word in a
restaurant sit down anew, one after the other, given the other tables. Predictive probabilities are averaged over the
sweeps after the first.

Pairs (word before, word) are dealt out to buckets by context, those of hot contexts by the word too; the tables of hot
contexts are summed on the driver after each sweep. Each sweep sends the tables of every word to the root, dealt out by
word, and gets the root's seating back: no number is estimated from a part. The seatings are stored, a file for each
bucket that its task reads again, and the scores read the very ones that the totals were summed from. Only messages are
shuffled. What a later round doesn't read is removed, and the texts are scored in PARTS parts, one after the other, so
that the disk never holds all that the scores exchange.
"""

import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.llm import storage
from tallylake.llm.arrow_columns import steps

SWEEPS = 3
#: Discount and strength of the context restaurants and of the root.
DISCOUNT, STRENGTH, ROOT_DISCOUNT, ROOT_STRENGTH = 0.8, 1.0, 0.5, 1.0
#: Every fold of this remainder is held out of training.
FOLDS, HELD_OUT = 7, 2
#: Characters of text for one bucket of words, and the fewest buckets.
BUCKET_CHARS, LEAST_BUCKETS = 40_000_000, 64
#: Words with a larger share of the tokens are hot; there are less than 1/share. They are counted in a part of the texts
#: of about SAMPLE_CHARS characters, of a 64th at least.
HOT_SHARE, SAMPLE_CHARS = 1 / 1000, 50_000_000
#: Slots for the restaurants of hot contexts, at least.
SLOTS = 256
#: Parts of the texts that are scored one after the other.
PARTS = 3
#: Up to so many customers sit down one by one; later ones in groups of 5 % of those seated.
ONE_BY_ONE = 64

END = np.uint64(xxhash.xxh64_intdigest(b" end"))


def is_held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


def _tokens(texts):
    """(word hashes, hashes of the words before them, document numbers) of the tokens of some texts, an end after each."""
    words, sizes = [], []
    for t in texts:
        ws = t.encode().lower().split() if t else []
        words.append(np.fromiter(map(xxhash.xxh64_intdigest, ws), np.uint64, len(ws)))
        words.append(np.array([END]))
        sizes.append(len(ws) + 1)
    words = np.concatenate(words) if words else np.zeros(0, np.uint64)
    before = np.concatenate([np.array([END]), words[:-1]]) if len(words) else words
    return words, before, np.repeat(np.arange(len(sizes)), sizes)


def _steps(batches):
    """(step number, documents' ids, word hashes, words before, document numbers) of a task's texts."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 24
    for batch in batches:
        for start, size in steps(batch.column("text"), 4_000_000):
            for lot in range(start, start + size, 60_000):
                part = batch.slice(lot, min(60_000, start + size - lot))
                yield number, part.column("doc_id").to_pylist(), *_tokens(part.column("text").to_pylist())
                number += 1


def _table(rows):
    """Rows (bucket, kind, part, up to five arrays) as an Arrow table; all exchanges have this form."""
    blobs = [[r[3 + i].tobytes() if len(r) > 3 + i else b"" for r in rows] for i in range(5)]
    first = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int32(), pa.string(), pa.int64()))]
    return pa.table([*first, *[pa.array(b, pa.binary()) for b in blobs]], names=["bucket", "kind", "part", *"abcde"])


_SCHEMA = "bucket int, kind string, part long, a binary, b binary, c binary, d binary, e binary"


def _put(folder, name, row):
    """A bucket's row as a file beside the tables that are exchanged."""
    storage.commit_table(f"{folder}/{name}", f"{row[0]:07d}.arrow", _table([row]))


def _get(folder, bucket, names):
    """A bucket's rows that _put wrote; names: {name: their kind from now on}."""
    found = [storage.read_table(f"{folder}/{name}", f"{bucket:07d}.arrow") for name in names]
    return pa.concat_tables([
        t.set_column(1, "kind", pa.array([kind] * len(t), pa.string())) for t, kind in zip(found, names.values(), strict=True)
    ])


def _beside(table, folder, names):
    """A group's table with its bucket's rows from the files."""
    own = _get(folder, _bucket_of(table), names)
    return pa.concat_tables([table.select(own.column_names).cast(own.schema), own])


def _rows(table, *kinds):
    """The rows of some kinds by (kind, part): lists of (part, five blobs)."""
    found = sorted(zip(*[table.column(c).to_pylist() for c in ("kind", "part", *"abcde")]), key=lambda r: r[:2])
    return [[r[1:] for r in found if r[0] == kind] for kind in kinds]


def _cat(blobs, kind):
    return np.concatenate([np.zeros(0, kind), *[np.frombuffer(b, kind) for b in blobs]])


def _place(values, wanted):
    """(place of each wanted number among sorted values, whether it is there)."""
    if not len(values):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
    return at, values[at] == wanted


def _distinct_pairs(words, before):
    """Distinct (word before, word) in order, and the place of each token's pair."""
    distinct, place = np.unique(words, return_inverse=True)
    contexts, of_context = np.unique(before, return_inverse=True) if len(before) else (distinct, place)
    n = max(1, len(distinct))
    pairs, which = np.unique(of_context * n + place, return_inverse=True)
    return contexts[pairs // n], distinct[pairs % n], which


def _dealt(contexts, words, hot, buckets):
    """(bucket, places) of pairs: by context, those of hot contexts by the word too."""
    number = contexts >> np.uint64(8)
    split = _place(hot, contexts)[1]
    number[split] ^= words[split] >> np.uint64(16)
    bucket = (number % np.uint64(buckets)).astype(np.int64)
    # Sorted in one or two passes over the bytes if the numbers are short.
    order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
    for places in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else ():
        yield int(bucket[places[0]]), places


def _runs(contexts):
    """Equal neighbours once, and how many there are."""
    starts = np.flatnonzero(np.append(True, contexts[1:] != contexts[:-1])[: len(contexts)])
    return contexts[starts], np.diff(np.append(starts, len(contexts))).astype("<u4")


def _hot_words(docs, size):
    """Frequent words, sorted, counted in a part of the texts. Any list gives right results: a good one spreads the work."""
    part = docs.where(F.expr(f"pmod(xxhash64(text), {1 + min(63, int(size) // SAMPLE_CHARS)}) = 0"))

    def run(batches):
        for _, _, words, _, _ in _steps(batches):
            distinct, n = np.unique(words, return_counts=True)
            # What is rarer than half the share in every step is rarer in all.
            kept = n >= HOT_SHARE / 2 * len(words)
            columns = [distinct[kept].view("<i8"), n[kept], np.full(kept.sum(), 0)]
            columns = [np.append(c, x) for c, x in zip(columns, (0, 0, len(words)))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["word", "n", "all"])

    counted = part.mapInArrow(run, "word long, n long, all long")
    total = counted.agg(F.sum("all")).first()[0] or 0
    found = counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= max(1.0, HOT_SHARE * total)).collect()
    return np.sort(np.array([r.word for r in found], np.int64).view(np.uint64))


def _count_rows(docs, buckets, hot):
    """Training counts of pairs, summed per step of texts; pairs of held-out texts alone count 0."""
    def run(batches):
        for step, ids, words, before, number in _steps(batches):
            train = ~np.array([is_held_out(d) for d in ids], bool)[number]
            contexts, follow, which = _distinct_pairs(words, before)
            n = np.bincount(which, weights=train, minlength=len(follow)).astype("<u4")
            rows = [(b, "count", step, *_runs(contexts[at]), follow[at], n[at]) for b, at in _dealt(contexts, follow, hot, buckets)]
            yield from _table(rows).to_batches()

    return docs.mapInArrow(run, _SCHEMA)


def seat(customers, new_table, discount, rng):
    """Tables after the customers of each dish sat down in turn; new_table: weight of opening one."""
    order = np.argsort(-customers, kind="stable")
    c, a = customers[order], new_table[order]
    t = np.minimum(c, 1).astype(float)
    i = 1
    while len(c) and c[0] > i:
        m = int(np.searchsorted(-c, -i, "left"))  # those with more than i customers
        p = a[:m] / (a[:m] + i - discount * t[:m])
        if i < ONE_BY_ONE:
            t[:m] += rng.random(m) < p
            i += 1
        else:
            group = i // 20
            t[:m] += rng.binomial(np.minimum(group, c[:m] - i).astype(np.int64), p)
            i += group
    out = np.empty(len(c))
    out[order] = t
    return out


def root(customers, tables, all_customers, all_tables, base):
    top = np.maximum(customers - ROOT_DISCOUNT * tables, 0) + (ROOT_STRENGTH + ROOT_DISCOUNT * all_tables) * base
    return top / (ROOT_STRENGTH + all_customers)


class Seating:
    """One bucket's pairs: sorted contexts, words by (their bucket, number), and customers of each pair in order."""

    def __init__(self, table, buckets):
        (counts,), (state,) = _rows(table, "count"), _rows(table, "state")
        if state:
            (_, contexts, repeats, words, follow, customers), = state
            self.contexts, self.words = np.frombuffer(contexts, "<u8"), np.frombuffer(words, "<u8")
            self.repeats, self.follow = np.frombuffer(repeats, "<u4"), np.frombuffer(follow, "<u4").astype(np.int64)
            self.context = np.repeat(np.arange(len(self.contexts)), self.repeats)
            self.customers = np.frombuffer(customers, "<i8")
        else:
            context = np.repeat(_cat([r[1] for r in counts], "<u8"), _cat([r[2] for r in counts], "<u4"))
            follow, n = _cat([r[3] for r in counts], "<u8"), _cat([r[4] for r in counts], "<u4")
            self.contexts, context = np.unique(context, return_inverse=True)
            words, follow = np.unique(follow, return_inverse=True)
            order = np.argsort(_word_bucket(words, buckets), kind="stable")
            self.words = words[order]
            key, place = np.unique(context * len(words) + np.argsort(order)[follow], return_inverse=True)
            self.context, self.follow = key // len(words), key % len(words)
            self.repeats = np.bincount(self.context).astype("<u4")
            self.customers = np.bincount(place, weights=n).astype("<i8")

    def row(self, bucket):
        return bucket, "state", 0, self.contexts, self.repeats, self.words, self.follow.astype("<u4"), self.customers

    def by_context(self, numbers, hot, hot_sums):
        """Sums of pairs' numbers over whole contexts; those of hot contexts, which lie in many buckets, are given."""
        sums = np.bincount(self.context, weights=numbers, minlength=len(self.contexts))
        at, there = _place(hot, self.contexts)
        sums[there] = hot_sums[at[there]]
        return sums

    def find(self, contexts, words):
        """Places of pairs that are there."""
        order = np.argsort(self.words)
        word = order[np.searchsorted(self.words[order], words)]
        key = self.context * len(self.words) + self.follow
        return np.searchsorted(key, np.searchsorted(self.contexts, contexts) * len(self.words) + word)

    def messages(self, bucket, buckets, tables, hot):
        """Sums of the tables by word for the root; sums of the hot contexts, and their tables of hot words."""
        sums = np.bincount(self.follow, weights=tables, minlength=len(self.words))
        counts = np.bincount(self.follow, weights=self.customers, minlength=len(self.words))
        at, there = _place(hot, self.contexts)
        here = there[self.context]
        slot = at[self.context[here]]
        customers = np.bincount(slot, weights=self.customers[here], minlength=len(hot))
        of_word, is_hot = _place(hot, self.words[self.follow[here]])
        cells = np.stack([slot, of_word, self.customers[here], tables[here]]).astype("<f8")[:, is_hot]
        out = [(bucket, "hot", 0, np.bincount(slot, weights=tables[here], minlength=len(hot)), customers, cells)]
        own = _word_bucket(self.words, buckets)
        for places in np.split(np.arange(len(own)), np.flatnonzero(np.diff(own)) + 1) if len(own) else ():
            out.append((int(own[places[0]]), "word", bucket, self.words[places], sums[places], counts[places]))
        return out


def _word_bucket(words, buckets):
    return ((words >> np.uint64(24)) % np.uint64(buckets)).astype(np.int64)


def _bucket_of(table):
    return table.column("bucket")[0].as_py()


def _answers(table, kind):
    """(customers, tables, training counts) at the root of a seating's words."""
    answers, = _rows(table, kind)
    return [_cat([r[i] for r in answers], "<f8") for i in (1, 2, 3)]


class Model:
    """The exact totals; restaurants of hot contexts in SLOTS slots, of which the last are empty restaurants."""

    def __init__(self, hot):
        self.hot, self.n_words, self.n_tokens = hot, 0, 0
        self.slots = max(SLOTS, len(hot))
        self.customers, self.tables, self.root, self.cells = np.zeros(self.slots), [], [], []

    def take(self, stored):
        """The totals of a round: (tables of the hot contexts, [customers, tables] at the root, hot words)."""
        sums = np.zeros((2, self.slots))
        cells = []
        for r in stored.where("kind = 'hot'").select("a", "b", "c").collect():
            sums[:, : len(self.hot)] += np.frombuffer(r.a, "<f8"), np.frombuffer(r.b, "<f8")
            cells.append(np.frombuffer(r.c, "<f8").reshape(4, -1))
        self.customers = sums[1]
        return sums[0], np.concatenate([np.zeros((4, 0)), *cells], axis=1)

    def hot_table(self, totals_of_hot, cells_of_samples):
        """(hashes, counts, probabilities by slot) of the hot words."""
        p = np.zeros((len(self.hot), self.slots))
        counts = np.zeros(len(self.hot))
        for at, (of_words, cells) in enumerate(zip(totals_of_hot, cells_of_samples)):
            customers, tables = np.zeros(len(self.hot)), np.zeros(len(self.hot))
            place = of_words[0].astype(np.int64)
            counts[place], customers[place], tables[place] = of_words[1:]
            base = root(customers, tables, *self.root[at], 1 / (self.n_words + 1))
            own = np.zeros_like(p)
            own[cells[1].astype(np.int64), cells[0].astype(np.int64)] = cells[2] - DISCOUNT * cells[3]
            weight = STRENGTH + DISCOUNT * self.tables[at]
            p += (own + weight * base[:, None]) / (STRENGTH + self.customers)
        return self.hot, counts, p / max(1, len(self.root))


def _root_round(turn, totals, hot):
    """Root customers of every word, seated anew but in the first round, and answers to the buckets that have them."""
    def run(table):
        bucket, (rows,) = _bucket_of(table), _rows(table, "word")
        words, at = np.unique(_cat([r[1] for r in rows], "<u8"), return_inverse=True)
        customers, n = [np.bincount(at, _cat([r[i] for r in rows], "<f8"), len(words)) for i in (2, 3)]
        tables = np.minimum(customers, 1)
        if turn:
            weight = (ROOT_STRENGTH + ROOT_DISCOUNT * totals[3]) / (totals[0] + 1)
            rng = np.random.default_rng([1, turn, bucket])
            tables = seat(customers.astype(np.int64), np.full(len(words), weight), ROOT_DISCOUNT, rng)
        ends = np.cumsum([len(r[1]) // 8 for r in rows])
        out = [(r[0], "answer", bucket, customers[x], tables[x], n[x]) for r, x in zip(rows, np.split(at, ends[:-1]))]
        slot, is_hot = _place(hot, words)
        sums = np.array([np.count_nonzero(n), n.sum(), customers.sum(), tables.sum()], "<f8")
        return _table([*out, (bucket, "sums", 0, sums, np.stack([slot, n, customers, tables]).astype("<f8")[:, is_hot])])

    return run


def _kept_answers(bucket, answers):
    return bucket, "answer", 0, *answers


def _sweep(turn, totals, hot, hot_tables, buckets, folder):
    """New seatings of all pairs, given the tables of the round before."""
    def run(table):
        bucket, answers = _bucket_of(table), _answers(table, "answer")
        if turn > 1:
            _put(folder, f"answer{turn}", _kept_answers(bucket, answers))
        table = _get(folder, bucket, {"state": "state", f"tables{turn}": "tables"})
        s, ((before,),) = Seating(table, buckets), _rows(table, "tables")
        customers, tables, _ = answers
        p = root(customers, tables, totals[2], totals[3], 1 / (totals[0] + 1))[s.follow]
        per = s.by_context(np.frombuffer(before[1], "<u4"), hot, hot_tables)[s.context]
        rng = np.random.default_rng([0, turn, bucket])
        t = seat(s.customers, (STRENGTH + DISCOUNT * per) * p, DISCOUNT, rng)
        _put(folder, f"tables{turn + 1}", (bucket, "tables", 0, t.astype("<u4")))
        return _table(s.messages(bucket, buckets, t, hot))

    return run


def _seatings(docs, buckets, size):
    """The model, its table of hot words, the folder of the seatings, and the names in it that scores are averaged over."""
    hot = _hot_words(docs, size)
    model, folder = Model(hot), storage.new_folder(docs.sparkSession, "language-seatings")

    def begin(table):
        bucket, s = _bucket_of(table), Seating(table, buckets)
        t = np.minimum(s.customers, 1)
        _put(folder, "state", s.row(bucket))
        _put(folder, "tables0", (bucket, "tables", 0, t.astype("<u4")))
        return _table(s.messages(bucket, buckets, t, hot))

    def keep(table):
        bucket = _bucket_of(table)
        _put(folder, f"answer{SWEEPS}", _kept_answers(bucket, _answers(table, "answer")))
        return _table([])

    now = storage.stored(_count_rows(docs, buckets, hot).groupBy("bucket").applyInArrow(begin, _SCHEMA), "language-scores")
    names, of_words, of_cells, totals = {"state": "state"}, [], [], None
    for turn in range(SWEEPS + 1):
        hot_tables, cells = model.take(now)
        run = _root_round(turn, totals, hot)
        answers = storage.stored(now.where("kind = 'word'").groupBy("bucket").applyInArrow(run, _SCHEMA), "language-scores")
        storage.discarded(now)
        sums = answers.where("kind = 'sums'").select("a", "b").collect()
        totals = sum((np.frombuffer(r.a, "<f8") for r in sums), np.zeros(4))
        if turn > 1:
            names |= {f"tables{turn}": f"tables{len(of_cells)}", f"answer{turn}": f"answer{len(of_cells)}"}
            model.tables.append(hot_tables)
            model.root.append(totals[2:])
            of_words.append(np.concatenate([np.zeros((4, 0)), *[np.frombuffer(r.b, "<f8").reshape(4, -1) for r in sums]], axis=1))
            of_cells.append(cells)
        run = _sweep(turn, totals, hot, hot_tables, buckets, folder) if turn < SWEEPS else keep
        now = storage.stored(answers.where("kind = 'answer'").groupBy("bucket").applyInArrow(run, _SCHEMA), "language-scores")
        storage.discarded(answers)
        if turn < 2:
            storage.removed(f"{folder}/tables{turn}")
    storage.discarded(now)
    model.n_words, model.n_tokens = totals[:2]
    return model, model.hot_table(of_words, of_cells), folder, names


def _sample(docs, buckets, size):
    """The model, its table of hot words, and the rows of the seatings that the scores are averaged over."""
    model, hot_table, folder, names = _seatings(docs, buckets, size)
    there = storage.list_files(f"{folder}/state", (".arrow",))
    numbers = [(int(uri.rpartition("/")[2].removesuffix(".arrow")),) for uri, _ in there]

    def run(batches):
        for batch in batches:
            for bucket in batch.column("bucket").to_pylist():
                yield from _get(folder, bucket, names).to_batches()

    return model, hot_table, docs.sparkSession.createDataFrame(numbers, "bucket int").mapInArrow(run, _SCHEMA)


def _fit(docs, buckets):
    """The model, and the tables of hot words: (hashes, counts, probabilities by slot)."""
    return _sample(docs, buckets, 0)[:2]


def _score_rows(docs, buckets, hot_table):
    """Per step of texts: its documents with the sums of their hot words after hot words, and the other pairs by bucket."""
    shared = docs.sparkSession.sparkContext.broadcast(hot_table)

    def run(batches):
        hot, counts, probability = shared.value
        logs, log_counts = np.log10(probability), np.log10(counts + 1)
        for step, ids, words, before, number in _steps(batches):
            (w, w_hot), (u, u_hot), n = _place(hot, words), _place(hot, before), len(ids)
            here = w_hot & u_hot
            w, u, who = w[here], u[here], number[here]
            contexts, follow, which = _distinct_pairs(words[~here], before[~here])
            rank, done, rows = np.zeros(len(follow), "<u4"), 0, []
            for bucket, at in _dealt(contexts, follow, hot, buckets):
                rank[at] = np.arange(done, done + len(at))
                done += len(at)
                rows.append((bucket, "ask", step, *_runs(contexts[at]), follow[at]))
            names = pa.array(ids, pa.int64()).fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").view("u1")
            rows.append((
                buckets + (step + (step >> 24)) % buckets, "docs", step, np.append(names, np.array([d is None for d in ids], "u1")),
                np.append(np.bincount(number, minlength=n), np.bincount(number[~here], minlength=n)).astype("<u4"), rank[which],
                np.append(np.bincount(who, log_counts[w], n), np.bincount(who, logs[w, u], n)).astype("<f8"),
                np.bincount(who, counts[w] > 0, n).astype("<u4"),
            ))
            yield from _table(rows).to_batches()

    return docs.mapInArrow(run, _SCHEMA)


def _score_bucket(table, buckets, model):
    """Of one bucket: (log10 probability, training count of the word) of the pairs that steps ask for."""
    bucket = _bucket_of(table)
    if bucket >= buckets:
        return table
    asked, = _rows(table, "ask")
    if not asked:
        return _table([])
    s = Seating(table, buckets)
    total = np.zeros(len(s.customers))
    customers = s.by_context(s.customers, model.hot, model.customers)[s.context]
    for at in range(len(model.root)):
        (sample,), = _rows(table, f"tables{at}")
        t = np.frombuffer(sample[1], "<u4")
        *seats, counts = _answers(table, f"answer{at}")
        p = root(*seats, *model.root[at], 1 / (model.n_words + 1))[s.follow]
        per = s.by_context(t, model.hot, model.tables[at])[s.context]
        total += (s.customers - DISCOUNT * t + (STRENGTH + DISCOUNT * per) * p) / (STRENGTH + customers)
    logs = np.log10(total / len(model.root))
    contexts = np.repeat(_cat([r[1] for r in asked], "<u8"), _cat([r[2] for r in asked], "<u4"))
    places = s.find(contexts, _cat([r[3] for r in asked], "<u8"))
    ends = np.cumsum([len(r[3]) // 8 for r in asked])
    return _table([(bucket, "value", r[0], logs[x], counts[s.follow[x]].astype("<i8"))
                   for r, x in zip(asked, np.split(places, ends[:-1]))])


def _sum_step(table, model):
    """All sums of the documents of one step."""
    (row,), = _rows(table, "docs")
    _, docs, sizes, rank, sums, known = row
    n = len(docs) // 9
    ids = pa.array(np.frombuffer(docs, "<i8", n), mask=np.frombuffer(docs, "u1", n, 8 * n).astype(bool))
    tokens, others = np.frombuffer(sizes, "<u4").astype(np.int64).reshape(2, n)
    values = sorted(r for r in zip(*[table.column(c).to_pylist() for c in ("bucket", "kind", "a", "b")]) if r[1] == "value")
    rank, who = np.frombuffer(rank, "<u4"), np.repeat(np.arange(n), others)
    logs, counts = _cat([v[2] for v in values], "<f8")[rank], _cat([v[3] for v in values], "<i8")[rank]
    base, score = np.frombuffer(sums, "<f8").reshape(2, n)
    base = base + np.bincount(who, np.log10(counts + 1.0), n) - tokens * np.log10(model.n_tokens + model.n_words + 1)
    known = np.frombuffer(known, "<u4") + np.bincount(who, counts > 0, n).astype(np.int64)
    return pa.table({
        "doc_id": ids, "held_out": [is_held_out(d) for d in ids.to_pylist()], "n_tokens": tokens, "n_known": known,
        "train_tokens": np.full(n, int(model.n_tokens)), "base_score": base, "score": score + np.bincount(who, logs, n),
    })


def language_scores(docs, doc_id="doc_id", text="text"):
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are runs of anything but the six ASCII spaces, A-Z in lower case, and an end after each text (null and empty
    texts have the end alone; it follows every text, so the first word of a text comes after an end). Documents whose
    crc32(doc_id as text) mod FOLDS is HELD_OUT are not learned from; a null doc_id counts as an empty text there.
    base_score: sum of log10((c + 1) / (N + V + 1)); score: log10 probability of the tokens under the model. Repeated
    rows are learned from and scored each; equal texts have equal scores. An empty table gives an empty table. Other
    columns are not read.

    Sampling is seeded by bucket and sweep. Words are told apart by 64-bit hashes.
    """
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    size = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-int(size) // BUCKET_CHARS))
    model, hot_table, folder, names = _seatings(docs, buckets, size)

    def score(table):
        asked = _bucket_of(table) < buckets
        return _score_bucket(_beside(table, folder, names) if asked else table, buckets, model)

    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    scored = []
    for part in range(PARTS):
        chosen = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(PARTS)) == part)
        values = _score_rows(chosen, buckets, hot_table).groupBy("bucket").applyInArrow(score, _SCHEMA)
        scored.append(storage.stored(values.groupBy("part").applyInArrow(lambda table: _sum_step(table, model), out), "language-scores"))
    storage.removed(folder)
    return reduce(DataFrame.union, scored)
