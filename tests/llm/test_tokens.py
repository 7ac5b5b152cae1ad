import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallylake.llm import bpe_automaton, byte_bpe, storage, token_counts, token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER, TABLE = bpe_automaton._Encoder(PATH), token_files._library_encoder(PATH)


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\t\r abcdeT'hs1290!?-_|éßжÉ中 　\x1c\x85", max_size=60))
def test_texts_are_encoded_as_by_the_library(text):
    expected = ids(text)
    (found,) = ENCODER(pa.array([text, None, text]))
    assert found.to_pylist() == [expected, [], expected]
    assert byte_bpe.LabelTable(byte_bpe.load(PATH).labels()).decode(found).to_pylist() == [text, "", text]
    assert token_counts._counter(PATH)([text]) == [len(expected)]
    assert TABLE.encode(pa.array([text]))[0].tolist() == expected


def test_a_full_table_keeps_what_comes_up_often():
    table = byte_bpe.PieceTable(byte_bpe.load(PATH), lambda words: [np.array(ids(w), "i4").tobytes() for w in words], "i4", 40)
    rng = np.random.default_rng(1)
    for i in range(30):
        texts = [" ".join([f"common{j}" for j in range(9)] + [f"rare{x}" for x in rng.integers(0, 10**6, 12)]) for _ in range(3)]
        found, ends = table.encode(pa.array(texts))
        assert [found[a:b].tolist() for a, b in zip(ends, ends[1:])] == [ids(t) for t in texts]
        assert i < 3 or "common5" in table.slot[True]
    assert table.n_slots < 200


def test_automaton_reads_one_path_per_word():
    machine = bpe_automaton.automaton(PATH)
    assert machine.n_states <= 1 + 50_000
    assert machine.encode(b"") == ()
    assert machine.encode(b"a" * 5000) == tuple(ids("a" * 5000))


def test_odd_documents(spark, odd_docs):
    texts = [(r.doc_id, r.text) for r in odd_docs.collect()]
    counted = token_counts.token_counts(odd_docs, PATH)
    assert [c.lower() for c in counted.columns].count("n_tokens") == 1 and "a.b" in counted.columns
    assert [(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in counted.collect()] == [
        (d, len((t or "").encode()), len(ids(t)), len(ids(t)) > 512) for d, t in texts
    ]
    both = bpe_automaton.decode(bpe_automaton.encode(odd_docs, PATH), PATH).collect()
    assert [(r.token_ids, r.decoded) for r in both] == [(ids(t), t or "") for _, t in texts]
    empty = odd_docs.limit(0)
    assert token_counts.token_counts(empty, PATH).count() == 0
    assert bpe_automaton.encode(empty, PATH).count() == 0


def test_token_files_round_trip(spark, odd_docs):
    folder = token_files.write_tokens(odd_docs, PATH, storage.new_folder(spark, "tokens"))
    got = token_files.read_tokens(spark, folder, ["token_ids", "ids_crc32"]).orderBy("start").collect()
    texts = {}
    for r in odd_docs.collect():
        texts.setdefault(r.doc_id, r.text)
    assert [r.doc_id for r in got] == sorted([r.doc_id for r in odd_docs.collect()], key=lambda d: (d is not None, d))
    start = 0
    for r in got:
        expected = ids(texts[r.doc_id]) + [0]
        assert (r.start, r.n_tokens, r.token_ids) == (start, len(expected), expected)
        assert r.ids_crc32 == zlib.crc32(np.array(expected, "<u4").tobytes())
        start += len(expected)
    none = token_files.write_tokens(odd_docs.limit(0), PATH, storage.new_folder(spark, "tokens"))
    assert token_files.read_tokens(spark, none).count() == 0


@pytest.mark.parametrize("bits", [1, 3, 16, 17, 31])
def test_packing(bits):
    numbers = np.random.default_rng(bits).integers(0, 1 << bits, 5000).astype(np.uint32)
    packed = token_files.pack(numbers, bits)
    assert len(packed) == -(-5000 // 64) * 8 * bits
    assert token_files.unpack(packed, bits)[:5000].tolist() == numbers.tolist()


def test_pieces_join_to_the_text():
    text = "a  b\n c  \n d "
    first, rest = byte_bpe.pieces(text)
    assert " ".join([first, *rest]) == text


def test_known_words_are_looked_up_once_a_column():
    class Counted(dict):
        lookups = 0

        def get(self, key):
            self.lookups += 1
            return super().get(key)

        def __getitem__(self, key):
            self.lookups += 1
            return super().__getitem__(key)

    table = byte_bpe.PieceTable(byte_bpe.load(PATH), lambda words: [np.array(ids(w), "i4").tobytes() for w in words], "i4")
    words = [f"word{chr(97 + i % 26)}{'x' * (i // 26)}".replace("0", "") for i in range(80)]
    table.encode(pa.array(["start " + " ".join(words)]))
    table.slot[True] = known = Counted(table.slot[True])
    text = "start " + " ".join([*words, "newcomer", *words, "newcomer"])
    found, ends = table.encode(pa.array([text, text]))
    assert [found[a:b].tolist() for a, b in zip(ends, ends[1:])] == [ids(text)] * 2
    assert known.lookups <= len(words) + 2
