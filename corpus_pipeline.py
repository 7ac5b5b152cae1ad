"""The training-text pipeline: documents through five stages, each stored before the next reads it.

Rejected by the quality classifier, then by the quality rules: gone. Near duplicates: the row with the least (doc_id,
text) of each class stays, also where ids repeat or are null. Documents that hold a benchmark window are gone. What is
left is encoded and decoded again.
"""

import public_tokenizers
from pyspark.sql import functions as F

from tallylake.llm import bpe_automaton, decontamination, jaccard_join, quality_model, quality_rules, storage
from tallylake.llm.shipping import ship

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

#: The stages hold a classifier, set similarity and a tokenizer: SQL can't express their rows.
ORACLE_SQL = None


def _kept(docs, judge, condition):
    """The rows of docs that meet a condition on what judge(docs, doc_id, text) adds to them.

    The judge sees the columns under names that no operator uses, so it replaces none of them.
    """
    plain = docs.toDF(*[f"document_column_{i}" for i in range(len(docs.columns))])
    place = {c: plain.columns[i] for i, c in enumerate(docs.columns)}
    return judge(plain, place["doc_id"], place["text"]).where(condition).select(*plain.columns).toDF(*docs.columns)


def accept_quality(spark, docs, sf_dir):
    """Documents that the quality classifier accepts, with all their columns, whatever those are called.

    Null and empty texts have no words, which the labellers call bad. Equal rows share their fate; no documents give none.
    """
    ship(spark)
    return _kept(docs, lambda plain, doc_id, text: quality_model.classify(plain, text), "accepted")


def apply_rules(spark, docs, sf_dir):
    """Documents that the quality rules keep, with all their columns, whatever those are called.

    Null and empty texts fail. Equal rows share their fate; no documents give none. The verdict is stored before it
    filters: pushed below the projection, the filter would repeat all its expressions.
    """
    def judged(plain, doc_id, text):
        verdict = quality_rules.judge(plain, text=text).select(*plain.columns, "kept")
        return storage.stored(verdict, "quality-rules")

    return _kept(docs, judged, "kept")


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each class of near duplicates, that with the least (doc_id, text), and all without shingles.

    Null and empty texts have no shingles and stay. Of rows equal in id and text one stays. Columns may have any names.
    """
    ship(spark)
    return jaccard_join.least_of_classes(docs)


def drop_benchmark_passages(spark, docs, sf_dir):
    """Documents without a window of a benchmark item, with all their columns, whatever those are called.

    Null and empty texts have no words and stay. An empty benchmark drops nothing.
    """
    ship(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _kept(
        docs, lambda plain, doc_id, text: decontamination.contamination(plain, benchmark, text=text), "not contaminated"
    )


def encode_and_decode(spark, docs, sf_dir):
    """The documents with token_ids, n_tokens and decoded, which replace columns of these names; all others stay.

    A null text has no tokens, like an empty one. The ids are stored before they are decoded: otherwise every task would
    hold two Python workers, each with the tokenizer's tables, at the same time.
    """
    ship(spark)
    encoded = storage.stored(bpe_automaton.encode(docs, TOKENIZER), "pipeline-ids")
    both = bpe_automaton.decode(encoded, TOKENIZER)
    return both.withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [
    ("quality classifier", accept_quality),
    ("quality rules", apply_rules),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_passages),
    ("BPE encoding and decoding", encode_and_decode),
]


def run(spark, sf_dir):
    """All stages over the documents of a folder; each stage's result is stored in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = storage.stored(stage(spark, docs, sf_dir), f"pipeline-{name.split()[0]}")
    return docs
