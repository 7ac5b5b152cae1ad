"""Which documents hold passages of a benchmark: a prefix-filtered join of word windows."""

from collections import Counter

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.llm import storage
from tallylake.llm.arrow_columns import add_columns, spare_prefix

#: Words in an item window, and in the shingles that make it up.
WINDOW, SHINGLE = 10, 3
#: Benchmark words that are held in memory at once; a larger benchmark is joined in several blocks.
BLOCK_WORDS = 500_000

# A-Z in lower case; digits, a-z and all bytes of other letters as they are; the rest parts words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text):
    return text.encode().translate(_WORD_BYTES).split() if text else []


def _shingles(ws, size):
    return zip(*[ws[i:] for i in range(size)]) if size > 1 else zip(ws)


class Block:
    """The windows of some benchmark items, and how they are found.

    A window is contained in a document only if all its shingles are, in its order. At containment 1 the prefix filter
    needs one shingle per window: the rarest one. prefix maps it to the places it has in windows, (offset, length).
    """

    def __init__(self, items, window=WINDOW, shingle=SHINGLE):
        self.windows, self.places = {}, {}
        for item, text in items:
            ws = words(text)
            n = min(window, len(ws))
            for start in range(len(ws) - n + 1 if n else 0):
                self.windows.setdefault(tuple(ws[start : start + n]), set()).add(item)
        self.shingle = shingle
        self.sizes = {min(shingle, len(w)) for w in self.windows}
        self.all = {s for w in self.windows for s in _shingles(w, min(shingle, len(w)))}
        self.lengths = {len(w) for w in self.windows}

    def count(self, ws):
        """Occurrences of the block's shingles in a document."""
        found = Counter()
        for size in self.sizes:
            if not self.all.isdisjoint(_shingles(ws, size)):
                found.update(s for s in _shingles(ws, size) if s in self.all)
        return found

    def choose(self, counts):
        """Order each window's shingles by rarity and take the first as its prefix."""
        self.places = {}
        for w in self.windows:
            size = min(self.shingle, len(w))
            rank, offset = min((counts.get(s, 0), s, i) for i, s in enumerate(_shingles(w, size)))[1:]
            self.places.setdefault(rank, set()).add((offset, len(w)))
        return self

    def match(self, ws):
        """Spans [start, end) of windows that occur in a document, and their items."""
        spans, items = set(), set()
        for size in self.sizes:
            if self.places.keys().isdisjoint(_shingles(ws, size)):
                continue
            for at, s in enumerate(_shingles(ws, size)):
                for offset, n in self.places.get(s, ()):
                    start = at - offset  # the window's place follows from the shingle's; it must lie in the text
                    if start >= 0 and start + n <= len(ws):
                        hit = self.windows.get(tuple(ws[start : start + n]))
                        if hit:
                            spans.add((start, start + n))
                            items |= hit
        return spans, items


def _merge(spans):
    out = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def _blocks(benchmark, item_id, text, block_words):
    """Collected blocks of benchmark rows, each of about block_words words or one item."""
    items = benchmark.select(
        F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("item"), F.col(f"`{text}`").alias("text")
    ).where("text is not null").distinct()
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-size // (6 * block_words)))
    for b in range(n):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b) if n > 1 else items
        yield n, [(r.item, r.text) for r in part.collect()]


def _count_shingles(docs, block, text):
    """Occurrences in all documents of the block's shingles; at most one number for each of them."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        found = Counter()
        for batch in batches:
            for t in batch.column("text"):
                found.update(shared.value.count(words(t.as_py())))
        import pyarrow as pa

        rows = [(b" ".join(s), n) for s, n in found.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64())], ["shingle", "n"]
        )

    counted = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "shingle binary, n long")
    rows = counted.groupBy("shingle").agg(F.sum("n").alias("n")).collect()
    return {tuple(bytes(r.shingle).split(b" ")): r.n for r in rows}


def contamination(docs, benchmark, item_id="item_id", text="text", block_words=BLOCK_WORDS, benchmark_text="text"):
    """docs with n_words, hit_spans (maximal runs of hit words, [start, end) in words), n_hit (words in them), item_ids
    (sorted strings: items of which a window occurs) and contaminated (n_hit > 0).

    Words are runs of digits, letters a-z after lower-casing A-Z, and characters beyond ASCII. A window is WINDOW
    consecutive words of an item, or a shorter item as a whole; a document word is hit if an occurrence of a window
    covers it. Null and empty texts have no words, on either side; a null item_id counts as the item "". Repeated items
    count once, repeated documents are all marked. An empty benchmark hits nothing. The result doesn't depend on
    block_words. Columns that bear a new name are replaced, others stay.

    A block of the benchmark is broadcast; its size is bounded by block_words (and its longest item), whatever the
    benchmark's size. Further blocks work on the stored result of those before.
    """
    fields = T.StructType.fromDDL("n_words long, hit_spans array<array<int>>, item_ids array<string>")
    spans, items = [spare_prefix(docs) + name for name in ("spans_so_far", "items_so_far")]
    marked = None
    for _, rows in _blocks(benchmark, item_id, benchmark_text, block_words):
        block = Block(rows)
        block.choose(_count_shingles(docs, block, text))
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def make(shared=shared):
            def run(texts, old_spans=None, old_items=None):
                n_words, all_spans, all_items = [], [], []
                for i, t in enumerate(texts):
                    ws = words(t)
                    found, hit = shared.value.match(ws)
                    if old_spans:
                        found |= set(map(tuple, old_spans[i]))
                        hit |= set(old_items[i])
                    n_words.append(len(ws))
                    all_spans.append(_merge(found))
                    all_items.append(sorted(hit))
                return n_words, all_spans, all_items

            return run

        if marked is None:
            marked = add_columns(docs, make, list(fields), (text,))
        else:
            marked = storage.stored(marked, "decontamination")
            before = marked.withColumnsRenamed({"hit_spans": spans, "item_ids": items})
            marked = add_columns(before, make, list(fields), (text, spans, items))
            marked = marked.drop(spans, items)
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda acc, s: acc + s[1] - s[0])
    return marked.withColumns({"n_hit": n_hit}).withColumn("contaminated", F.col("n_hit") > 0)
