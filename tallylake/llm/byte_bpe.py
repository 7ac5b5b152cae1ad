"""What a byte-level BPE tokenizer file says, and how its texts fall into pre-tokens."""

import gc
import json
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# Fixed values of the byte-level pre-tokenizer: its pattern, and the bytes that stand for themselves in the file.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]

#: One-character pre-tokens that often end a piece.
MARKS = frozenset(".,;:!?)|")
PRE_TOKEN = regex.compile(PATTERN)
LOOSE_SPACE = regex.compile(r" (?:\s|\Z)")
OPENING_SPACE = regex.compile(r" (?=\S)")


class ByteBpe:
    """Vocabulary, merges and special strings of a tokenizers file of kind byte-level BPE.

    Files whose settings the operators don't follow (normalizer, prefix space, dropout, several pairs that make the
    same token, ...) raise ValueError.
    """

    def __init__(self, path):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback",
                           "ignore_merges") if model.get(k)]
        if spec.get("normalizer") or odd or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space"):
            raise ValueError(f"{path}: not a plain byte-level BPE file ({odd})")
        rest = [b for b in range(256) if b not in PLAIN_BYTES]
        byte = {chr(b): b for b in PLAIN_BYTES} | {chr(256 + i): b for i, b in enumerate(rest)}
        spell = lambda token: bytes(byte[c] for c in token)
        vocab = model["vocab"]
        self.ids = {spell(t): i for t, i in vocab.items() if all(c in byte for c in t)}
        self.byte_ids = [self.ids[bytes([b])] for b in range(256)]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        if len({m[2] for m in self.merges}) < len(self.merges):
            raise ValueError(f"{path}: two merges make the same token")
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec.get("added_tokens", [])):
            raise ValueError(f"{path}: special strings with their own spacing rules")
        self.size = max([*vocab.values(), *self.specials.values()]) + 1
        longest_first = sorted(self.specials, key=lambda s: (-len(s), s))
        self.special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None

    def labels(self):
        """Bytes of every id; of a special id, its string."""
        out = [b""] * self.size
        for token, i in self.ids.items():
            out[i] = token
        for text, i in self.specials.items():
            out[i] = text.encode()
        return out

    def segments(self, text):
        """Ordinary text at even places, special strings at odd ones."""
        return self.special.split(text) if self.special else [text]


@lru_cache(maxsize=4)
def load(path):
    return ByteBpe(path)


def pieces(segment):
    """(first, others): a segment cut at each space that opens a word; the others have lost that space.

    Such a space always starts a pre-token, and the piece before it ends one, so pieces can be encoded on their own and
    remembered: words repeat, whole texts don't.
    """
    found = OPENING_SPACE.split(segment) if LOOSE_SPACE.search(segment) else segment.split(" ")
    return found[0], found[1:]


class Remembered(dict):
    """piece -> result of a bounded number of recent pieces; the generation before is kept aside and taken from."""

    def __init__(self, most=500_000, most_chars=10_000_000):
        super().__init__()
        self.most, self.most_chars = most, most_chars
        self.chars, self.older = 0, {}

    def put(self, pieces, results):
        for piece, result in zip(pieces, results, strict=True):
            self[piece] = result
            self.chars += len(piece)

    def make_room(self):
        if len(self) > self.most or self.chars > self.most_chars:
            self.older = dict(self)
            self.clear()
            self.chars = 0

    def unknown(self, pieces):
        """Those of a set of pieces that are not known; what the older generation knows is taken over."""
        new = pieces.difference(self)
        if self.older and new:
            seen = new.intersection(self.older)
            self.put(seen, map(self.older.__getitem__, seen))
            new -= seen
        return new


class PieceCache:
    """Results for pieces, without (bare) and with their space (spaced), from solve(pre-tokens).

    join(results of a piece's pre-tokens) makes the piece's result.
    """

    def __init__(self, solve, join, most=500_000, most_chars=10_000_000):
        self.solve, self.join = solve, join
        self.bare, self.spaced, self.tokens = [Remembered(m, most_chars) for m in (50_000, most, 100_000)]
        gc.set_threshold(500_000)  # large dictionaries of strings hold no cycles; searching them often costs time

    def learn(self, cut):
        """Make every piece of the pairs from pieces() known."""
        for known in (self.bare, self.spaced, self.tokens):
            known.make_room()
        spaced, tokens, join = self.spaced, self.tokens, self.join
        firsts = self.bare.unknown({first for first, _ in cut})
        others = spaced.unknown(set(chain.from_iterable(rest for _, rest in cut)))
        # A space and letters are one pre-token, letters and a mark two: no need to run the pattern.
        words = [p for p in others if p.isalpha()]
        marked = [p for p in others if p[-1:] in MARKS and p[:-1].isalpha()]
        spaced.put(words, map(join, zip(self.solve([" " + p for p in words]))))
        others.difference_update(words, marked)
        rest = [(self.bare, p, PRE_TOKEN.findall(p)) for p in firsts]
        rest += [(spaced, p, PRE_TOKEN.findall(" " + p)) for p in others]
        rest += [(spaced, p, (" " + p[:-1], p[-1])) for p in marked]
        unknown = list(tokens.unknown({t for _, _, ts in rest for t in ts}))
        tokens.put(unknown, self.solve(unknown))
        token = tokens.__getitem__
        for known, piece, ts in rest:
            known.put((piece,), (join(list(map(token, ts))),))


def _pre_tokens(piece, spaced):
    """Pre-tokens of a piece, with its space if it has lost one."""
    if not spaced:
        return PRE_TOKEN.findall(piece)
    if piece.isalpha():  # a space and letters are one pre-token, letters and a mark two: no need to run the pattern
        return (" " + piece,)
    if piece[-1:] in MARKS and piece[:-1].isalpha():
        return " " + piece[:-1], piece[-1]
    return PRE_TOKEN.findall(" " + piece)


class PieceTable:
    """Ids of whole columns of texts. Texts are cut into words, and equal words found, by Arrow; only words that are new
    are solved, one by one; the ids of all words are then gathered by numpy.

    solve(pre-tokens) gives each one's ids as bytes of numbers of the type kind. When the table holds more than
    most_words of them or most_bytes of ids and words, it forgets all but those that came up in several columns.
    """

    def __init__(self, bpe, solve, kind, most_words=200_000, most_bytes=12_000_000):
        self.bpe, self.solve, self.kind = bpe, solve, np.dtype(kind)
        self.most_words, self.most_bytes = most_words, most_bytes
        self.clear()

    def clear(self):
        self.slot = {True: {}, False: {}}  # of words without and with their space
        self.special, self.tokens = {}, {}
        self.size, self.start = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.uses = np.zeros(1 << 12, np.int64)
        self.ids, self.n_slots, self.n_ids, self.bytes = np.zeros(1 << 14, self.kind), 0, 0, 0

    def forget(self):
        """Keep at most half of what the table may hold: the words that came up most often."""
        uses, slots, size, start, ids = self.uses, self.slot, self.size, self.start, self.ids
        often = np.sort(uses[:self.n_slots])[::-1]
        least = max(2, int(often[min(self.most_words // 2, len(often) - 1)]) + 1)
        self.clear()
        for spaced, known in slots.items():
            kept = [(word, s) for word, s in known.items() if uses[s] >= least]
            new = self._add([ids[start[s]:start[s] + size[s]].tobytes() for _, s in kept])
            self.slot[spaced] = {word: s for (word, _), s in zip(kept, new)}
            self.bytes += sum(len(word) for word, _ in kept)
        self.bytes += self.n_ids * self.kind.itemsize
        if self.bytes > self.most_bytes // 2:
            self.clear()

    def _add(self, results):
        """Slots of new entries, whose ids are given as bytes."""
        sizes = np.fromiter(map(len, results), np.int64, len(results)) // self.kind.itemsize
        new = np.frombuffer(b"".join(results), self.kind)
        first, n, end = self.n_slots, self.n_slots + len(sizes), self.n_ids + len(new)
        if n > len(self.size):
            self.size, self.start, self.uses = (np.resize(a, 2 * n) for a in (self.size, self.start, self.uses))
        self.uses[first:n] = 0
        if end > len(self.ids):
            self.ids = np.resize(self.ids, 2 * end)
        self.size[first:n] = sizes
        self.start[first:n] = self.n_ids + np.cumsum(sizes) - sizes
        self.ids[self.n_ids:end] = new
        self.n_slots, self.n_ids = n, end
        return range(first, n)

    def _slots(self, pieces, spaced):
        known = self.slot[spaced]
        found = list(map(known.get, pieces))
        places = [i for i, s in enumerate(found) if s is None]
        if not places:
            return found
        new = list(dict.fromkeys(map(pieces.__getitem__, places)))
        results = self._solved(new, spaced)
        slots = dict(zip(new, self._add(results), strict=True))
        known.update(slots)
        self.bytes += sum(map(len, new)) + sum(map(len, results))
        for i in places:
            found[i] = slots[pieces[i]]
        return found

    def _solved(self, new, spaced):
        """Ids of new words as bytes. Words of letters are solved as they are, others by their pre-tokens: of these,
        most are words that the table knows, or punctuation that came before."""
        single, cut = [], {}
        for i, p in enumerate(new):
            if spaced and p.isalpha():
                single.append(i)
            else:
                cut[i] = _pre_tokens(p, spaced)
        results = [b""] * len(new)
        for i, ids in zip(single, self.solve([" " + new[i] for i in single]), strict=True):
            results[i] = ids
        fresh = {new[i]: results[i] for i in single} if cut else {}
        words, tokens, unknown = self.slot[True], self.tokens, {}
        if len(tokens) > 50_000:
            tokens.clear()
        for token in {t for ts in cut.values() for t in ts}:
            if token in tokens:
                continue
            ids = fresh.get(token[1:]) if token[0] == " " else None
            if ids is None and token[0] == " " and (slot := words.get(token[1:])) is not None:
                ids = self.ids[self.start[slot]:self.start[slot] + self.size[slot]].tobytes()
            unknown[token] = ids
        missing = [t for t, ids in unknown.items() if ids is None]
        solved = dict(zip(missing, self.solve(missing), strict=True))
        tokens.update((t, ids) for t, ids in solved.items() if len(t) < 20)
        unknown.update(solved)
        for i, ts in cut.items():
            results[i] = b"".join([unknown[t] if t in unknown else tokens[t] for t in ts])
        return results

    def _special_slot(self, text):
        if text not in self.special:
            self.special[text] = self._add([np.array([self.bpe.specials[text]], self.kind).tobytes()])[0]
        return self.special[text]

    def _loose(self, texts):
        """Texts in which a space does not just open a word, or which hold a special string."""
        # White space as the tokenizer's pattern has it, of which this library's own class knows the ASCII part only.
        odd = pc.match_substring_regex(texts, r" (?:[\s\pZ\x0b\x1c-\x1f\x{85}]|\z)")
        for special in self.bpe.specials:
            odd = pc.or_(odd, pc.match_substring(texts, special))
        return odd

    def _cut(self, text):
        """Slots of a loose text."""
        out = []
        for i, segment in enumerate(self.bpe.segments(text)):
            if i % 2:
                out.append(self._special_slot(segment))
            else:
                first, others = pieces(segment)
                out += self._slots([first], False)
                out += self._slots(others, True)
        return np.array(out, np.int64)

    def encode(self, texts):
        """(ids of all texts end to end, places where each text's ids end, after a 0) of an Arrow array of texts."""
        if self.n_slots > self.most_words or self.bytes > self.most_bytes:
            self.forget()
        texts = pc.fill_null(texts, "")
        loose = self._loose(texts)
        words = pc.split_pattern(texts.filter(pc.invert(loose)), " ")
        offsets = words.offsets.to_numpy().astype(np.int64) - words.offsets[0].as_py()
        flat = words.flatten().dictionary_encode()
        firsts = flat.take(pa.array(offsets[:-1])).cast(pa.string()).to_pylist()
        distinct = np.array(self._slots(flat.dictionary.to_pylist(), True), np.int64)
        self.uses[distinct] += 1
        slots = distinct[flat.indices.to_numpy()] if len(flat) else np.zeros(0, np.int64)
        slots[offsets[:-1]] = self._slots(firsts, False)
        if pc.any(loose).as_py():
            plain = iter(np.split(slots, offsets[1:-1]))
            parts = [self._cut(t.as_py()) if odd else next(plain) for t, odd in zip(texts, loose.to_pylist())]
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            slots = np.concatenate(parts)
        sizes = self.size[slots]
        ends = np.cumsum(sizes)
        places = np.repeat(self.start[slots] - (ends - sizes), sizes)
        places += np.arange(len(places))
        return self.ids[places], np.concatenate([[0], ends])[offsets]


class LabelTable:
    """Texts that ids spell: the labels' bytes, end to end, gathered by numpy."""

    def __init__(self, labels):
        self.size = np.fromiter(map(len, labels), np.int64, len(labels))
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(labels), np.uint8)

    def decode(self, rows):
        """Arrow array of texts of an Arrow array of lists of ids; null is empty, broken UTF-8 becomes U+FFFD."""
        rows = pc.fill_null(rows, pa.scalar([], rows.type))
        offsets = rows.offsets.to_numpy().astype(np.int64) - rows.offsets[0].as_py()
        ids = rows.flatten().to_numpy()
        if len(ids) and ids.min() < 0:
            raise IndexError("a negative id")
        sizes = self.size[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        places = np.arange(ends[-1]) + np.repeat(self.start[ids] - ends[:-1], sizes)
        data = pa.py_buffer(self.bytes[places].tobytes())
        cuts = pa.py_buffer(ends[offsets].astype(np.int64).tobytes())
        raw = pa.Array.from_buffers(pa.large_binary(), len(rows), [None, cuts, data])
        try:
            return raw.cast(pa.large_string())
        except pa.ArrowInvalid:
            return pa.array([b.decode("utf-8", "replace") for b in raw.to_pylist()], pa.large_string())
