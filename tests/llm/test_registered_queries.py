"""Registered queries without SQL, over a small sample, against brute force."""

import hashlib
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallylake.llm import queries, quality_rules, toxicity
from tests.llm.test_documents import brute_components

SF_DIR = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def split(text):
    return (text or "").translate(dict.fromkeys(map(ord, "\t\n\x0b\f\r"), " ")).split(" ")


@pytest.fixture(scope="module")
def texts(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]


def rows(spark, name):
    return sorted((tuple(r) for r in queries.QUERIES[name](spark, SF_DIR).collect()), key=str)


def test_op1_token_counts(spark, texts):
    n = [(d, len((t or "").encode()), len(LIBRARY.encode(t or "", add_special_tokens=False).ids)) for d, t in texts]
    assert rows(spark, "op1_token_counts") == sorted([(*r, r[2] > 512) for r in n], key=str)


def test_op5_jaccard_join(spark, texts):
    assert rows(spark, "op5_jaccard_join") == sorted([(d, *x) for d, x in brute_components(texts).items()], key=str)


def test_op8_bpe_automaton(spark, texts):
    ids = [(d, t or "", LIBRARY.encode(t or "", add_special_tokens=False).ids) for d, t in texts]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert rows(spark, "op8_bpe_automaton") == sorted([(d, len(i), sha(",".join(map(str, i))), sha(t)) for d, t, i in ids], key=str)


def judged(text):
    """(words, their characters, symbols, repeated lines, words in repeated windows, base_failed, kept) of a text."""
    words, body = [w for w in split(text) if w], text or ""
    lines = [x for x in body.split("\n") if any(split(x))]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = {w for w in windows if windows.count(w) > 1} if len(set(windows)) < len(windows) else set()
    repeated = len({i + j for i, w in enumerate(windows) if w in twice for j in range(5)})
    chars, symbols = sum(map(len, words)), sum(c in quality_rules.SYMBOLS for c in body)
    dup, n = len(lines) - len(set(lines)), len(words)
    failed = n < 10 or 100 * repeated > 20 * n
    kept = not failed and 2 <= chars / n <= 20 and 10 * symbols <= chars and 100 * dup <= 90 * len(lines)
    kept = kept and 100 * sum(len(w) > 40 for w in words) <= 30 * n
    kept = kept and (n < 20 or 100 * sum(w.lower() in quality_rules.STOP_WORDS for w in words) >= n)
    return n, chars, symbols, dup, repeated, failed, kept


def brute_windows(text, sizes=None):
    """Windows of 10 words of a benchmark item, or the item where it is shorter; of a document those of some sizes."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    sizes = sizes or ({min(10, len(words))} if words else ())
    return {tuple(words[i : i + n]) for n in sizes for i in range(len(words) - n + 1)}


def test_op10_quality_rules(spark, texts):
    assert rows(spark, "op10_quality_rules") == sorted([(d, *judged(t)) for d, t in texts], key=str)


def _labelled(spark, name, sf_dir):
    """Rows of a query with the labels of their documents."""
    found = queries.QUERIES[name](spark, sf_dir)
    return found.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").collect()


def test_op3_rejects_what_is_labelled_low_and_nothing_else(spark):
    found = _labelled(spark, "op3_quality_model", "/root/testdata/sf0.01")
    low = [r.accepted for r in found if r.quality == 0]
    assert len(low) > 50 and sum(low) <= 0.05 * len(low)
    assert all(r.accepted for r in found if r.quality == 1)


def test_op9_finds_toxic_documents_that_it_did_not_learn_from(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").withColumn("half", F.pmod(F.xxhash64("doc_id"), F.lit(2)))
    held_out = labels.where("half = 1")
    docs = docs.join(labels.select("doc_id"), "doc_id")
    found = toxicity.toxicity(docs, labels.where("half = 0").drop("half")).join(held_out, "doc_id").collect()
    toxic = [r.is_toxic for r in found if r.toxic]
    clean = [r.is_toxic for r in found if not r.toxic]
    assert len(toxic) > 150 and sum(toxic) >= 0.9 * len(toxic)
    assert sum(clean) <= 0.005 * len(clean)
