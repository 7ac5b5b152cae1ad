"""BPE encoding by a tokenization automaton built from the merges, and decoding by its arc labels."""

from array import array
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

from tallylake.llm import byte_bpe
from tallylake.llm.arrow_columns import add_columns


class Automaton:
    """Deterministic automaton over tokens that accepts exactly the BPE tokenizations of all byte strings.

    It starts as one state with an arc for each byte and takes in the merges one after the other, by this gadget for
    (u, v): the state that u leads to is copied without its v arc, u now leads to the copy, and wherever u could be
    read, uv can be read as well and leads to where v leads. All arcs of one token thus share their target, so a state
    is known by its parent and the one arc it lost. An arc that a state lost also keeps out the later tokens that begin
    with it. States are numbered in preorder of that tree; what lost token x is then, for each x, a list of disjoint
    ranges of states, and a transition is a binary search per left part of the token.
    """

    def __init__(self, bpe):
        self.ids, size = bpe.ids, bpe.size
        self.left, made, target = [-1] * size, [0] * size, [0] * size
        parent, lost, born = [-1], [-1], [0]
        for time, (u, v, uv) in enumerate(bpe.merges, 1):
            state = target[u]
            if not self._reads(state, v, parent, lost, born, made):
                continue  # u is never followed by v, so the pair never meets
            parent.append(state)
            lost.append(v)
            born.append(time)
            self.left[uv], made[uv] = u, time
            target[uv], target[u] = target[v], len(parent) - 1
        number, end = self._preorder(parent)
        self.made, self.born = made, {}
        self.start, self.end = {}, {}
        for state in sorted(range(1, len(parent)), key=number.__getitem__):
            x = lost[state]
            self.start.setdefault(x, []).append(number[state])
            self.end.setdefault(x, []).append(end[state])
            self.born.setdefault(x, []).append(born[state])
        self.target = [number[s] for s in target]
        self.size, self.n_states = size, len(parent)
        self.known = {}
        self.sizes = self._sizes()

    def _sizes(self):
        """Lengths of the tokens that a place may begin with, longest first, by its next four bytes or fewer."""
        found = {}
        for token in self.ids:
            for n in range(1, min(len(token), 4) + 1):
                found.setdefault(token[:n], set())
            found[token[:4]].add(len(token))
        for key, sizes in found.items():
            sizes.update(n for n in range(1, len(key)) if key[:n] in self.ids)
        return {key: tuple(sorted(sizes, reverse=True)) for key, sizes in found.items()}

    def _reads(self, state, token, parent, lost, born, made):
        """Whether a state of the unfinished automaton has an arc for a token."""
        after = {}
        later = None
        while token >= 0:
            after[token] = born[-1] + 1 if later is None else made[later]
            later, token = token, self.left[token]
        while state > 0:
            if after.get(lost[state], -1) >= born[state]:
                return False
            state = parent[state]
        return True

    @staticmethod
    def _preorder(parent):
        children = [[] for _ in parent]
        for s in range(1, len(parent)):
            children[parent[s]].append(s)
        number, end, stack, n = [0] * len(parent), [0] * len(parent), [0], 0
        order = []
        while stack:
            s = stack.pop()
            number[s] = n
            n += 1
            order.append(s)
            stack.extend(children[s])
        for s in reversed(order):
            end[s] = max([number[s] + 1, *[end[c] for c in children[s]]])
        return number, end

    def reads(self, state, token):
        """Whether a state has an arc for a token; its target is self.target[token]."""
        x, later = token, -1
        while x >= 0:
            starts = self.start.get(x)
            if starts:
                i = bisect_right(starts, state) - 1
                if i >= 0 and state < self.end[x][i] and (later < 0 or self.made[later] >= self.born[x][i]):
                    return False
            later, x = x, self.left[x]
        return True

    def encode(self, word):
        """Ids of a byte string: the one path of the automaton that spells it.

        Longest arcs are tried first. Each prefix has one path only, so a place from which the end can't be reached is
        left for good, and the work is bounded by length times the longest token.
        """
        ids, sizes, known, target = self.ids, self.sizes, self.known, self.target
        n, at, state, most, path, out, dead = len(word), 0, 0, len(word), [], [], None
        while at < n:
            head = word[at : at + 4]
            while head not in sizes:
                head = head[:-1]
            for size in sizes[head]:
                if size > most:
                    continue
                token = ids.get(word[at : at + size])
                if token is not None and (dead is None or at + size not in dead):
                    key = state * self.size + token
                    reads = known.get(key)
                    if reads is None:
                        reads = known[key] = self.reads(state, token)
                    if reads:
                        break
            else:
                size = 0
            if size:
                path.append((at, state, size))
                out.append(token)
                at += size
                state = target[token]
                most = n - at
            else:
                dead = dead or set()
                dead.add(at)
                at, state, size = path.pop()
                out.pop()
                most = size - 1
        return tuple(out)


@lru_cache(maxsize=2)
def automaton(path):
    return Automaton(byte_bpe.load(path))


class _Encoder:
    """Ids of Arrow arrays of texts; forgets what it has learned when its task ends."""

    def __init__(self, path):
        self.machine = automaton(path)
        self.table = byte_bpe.PieceTable(byte_bpe.load(path), self._solve, np.int32, 400_000, 24_000_000)

    def _solve(self, words):
        if len(self.machine.known) > 300_000:
            self.machine.known.clear()
        return [array("i", self.machine.encode(w.encode())).tobytes() for w in words]

    def __call__(self, texts):
        ids, ends = self.table.encode(texts)
        return [pa.LargeListArray.from_arrays(ends, pa.array(ids))]

    def close(self):
        self.table.clear()
        self.machine.known.clear()


def encode(docs, path, text="text", ids="token_ids"):
    """docs with a column of token ids, as the tokenizers library gives them without added special tokens.

    path: a byte-level BPE file of that library, present on every machine. Special strings inside a text become their
    id. Null and empty texts have no ids (an empty array). Equal texts get equal ids; an empty table gives an empty
    table; other columns stay, one that bears the new name is replaced.
    """
    field = T.StructField(ids, T.ArrayType(T.IntegerType(), False))
    return add_columns(docs, lambda: _Encoder(path), [field], (text,), arrays=True)


def decode(docs, path, ids="token_ids", text="decoded"):
    """docs with the text that a column of ids spells, special strings included; broken UTF-8 becomes U+FFFD.

    A null array decodes to an empty text. Ids outside the vocabulary raise IndexError.
    """
    def make():
        labels = byte_bpe.LabelTable(byte_bpe.load(path).labels())
        return lambda rows: [labels.decode(rows)]

    return add_columns(docs, make, [T.StructField(text, T.StringType())], (ids,), arrays=True)
