"""Token counts of texts by rank-synchronous merging of ragged arrays."""

from functools import lru_cache

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.llm import byte_bpe
from tallylake.llm.arrow_columns import add_columns

NO_RANK = np.iinfo(np.int64).max


class RankMerger:
    """Counts the symbols that remain of byte strings when all merges are done."""

    def __init__(self, bpe):
        pairs = np.array([(a * bpe.size + b, rank, ab) for rank, (a, b, ab) in enumerate(bpe.merges)], dtype=np.int64)
        pairs = pairs.reshape(-1, 3)[np.argsort(pairs.reshape(-1, 3)[:, 0])]
        self.keys, self.ranks, self.made = pairs[:, 0], pairs[:, 1], pairs[:, 2]
        self.size = bpe.size
        self.byte_ids = np.array(bpe.byte_ids, dtype=np.int64)

    def count(self, words):
        """Symbols left of each byte string.

        All strings stand end to end in one array of symbols. In each round every string finds the lowest rank among
        its neighbouring pairs and merges all its occurrences, left to right where they overlap. A string without a
        ranked pair is done and leaves the array.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        counts = sizes.copy()
        which = np.flatnonzero(sizes > 1)
        symbols = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        symbols = symbols[np.repeat(sizes > 1, sizes)]
        sizes = sizes[which]
        while len(which) and len(self.keys):
            starts = np.cumsum(sizes) - sizes
            last = np.zeros(len(symbols), bool)
            last[starts + sizes - 1] = True
            pair = symbols * self.size
            pair[:-1] += symbols[1:]
            place = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
            rank = np.where((self.keys[place] == pair) & ~last, self.ranks[place], NO_RANK)
            lowest = np.minimum.reduceat(rank, starts)
            hit = (rank == np.repeat(lowest, sizes)) & (rank != NO_RANK)
            hit &= self._every_other(hit)
            symbols = np.where(hit, self.made[place], symbols)
            gone = np.zeros(len(symbols), bool)
            gone[1:] = hit[:-1]
            sizes = sizes - np.add.reduceat(hit.astype(np.int64), starts)
            counts[which] = sizes
            live = (lowest != NO_RANK) & (sizes > 1)
            owner = np.repeat(live, np.diff(np.append(starts, len(gone))))
            symbols = symbols[owner & ~gone]
            which, sizes = which[live], sizes[live]
        return counts

    @staticmethod
    def _every_other(hit):
        """Of neighbouring hits (one pair overlapping itself) the first, third, ..."""
        at = np.arange(len(hit))
        before = np.maximum.accumulate(np.where(hit, -1, at))
        return (at - before) % 2 == 1


@lru_cache(maxsize=2)
def _counter(path):
    bpe = byte_bpe.load(path)
    merger = RankMerger(bpe)
    cache = byte_bpe.PieceCache(lambda words: merger.count([w.encode() for w in words]).tolist(), sum)

    def count(texts):
        cut = [bpe.segments(t or "") for t in texts]
        cut = [list(map(byte_bpe.pieces, segments[::2])) for segments in cut]
        cache.learn([p for segments in cut for p in segments])
        bare, spaced = cache.bare.__getitem__, cache.spaced.__getitem__
        return [
            sum(bare(first) + sum(map(spaced, rest)) for first, rest in segments) + len(segments) - 1
            for segments in cut
        ]

    return count


def token_counts(docs, path, limit=512, text="text"):
    """docs with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit).

    path: a byte-level BPE file of the tokenizers library, present on every machine. Counts are those of its encode
    without added special tokens; special strings inside a text count as one. Null and empty texts have 0 tokens. Rows
    are independent: repeated rows and ties get equal counts. An empty table gives an empty table; other columns stay,
    except those named n_bytes, n_tokens or over_limit, which are replaced.
    """
    def make():
        count = _counter(path)
        return lambda texts: [count(texts)]

    counted = add_columns(docs, make, [T.StructField("n_tokens", T.LongType())], (text,))
    return counted.withColumns({
        "n_bytes": F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long"),
        "over_limit": F.col("n_tokens") > limit,
    })
