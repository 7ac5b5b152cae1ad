import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_documents import brute_components
from tests.llm.test_registered_queries import brute_windows, judged

SF_DIR = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
CLASHES = ("accepted quality_score kept base_failed contaminated N_WORDS hit_spans _kept _id _class _key _row _words _text "
           "_lines _n _windows _places __id document_column_0 n_shingles component_id text_key class h votes").split()


def _text(name, last="end"):
    return " ".join(f"{name}{i}" for i in range(60)) + " " + last


def test_near_duplicates_with_null_and_repeated_ids(spark):
    rows = [
        (None, _text("a"), "x"), (None, _text("b"), "x"), (None, _text("b"), "x"), (None, None, "x"), (None, " ", "x"),
        (3, _text("c"), "x"), (5, _text("c", "other"), "x"), (5, _text("d"), "x"), (None, _text("c", "third"), "x"),
        (6, _text("e", "z"), "x"), (6, _text("e", "y"), "x"), (7, "", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = corpus_pipeline.drop_near_duplicates(spark, docs, None)
    assert got.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in got.collect()]
    expected = [(None, _text("a")), (None, _text("b")), (None, None), (None, " "), (3, _text("c")), (5, _text("d")),
                (6, _text("e", "y")), (7, "")]
    assert sorted(kept, key=str) == sorted(expected, key=str)
    assert corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), None).count() == 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:4])
def test_a_stage_keeps_whole_rows_whatever_their_columns_are_called(spark, name, stage):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    wide = docs.select("*", *[F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")).alias(c) for c in CLASHES])
    wide = wide.withColumn("a.b", F.create_map(F.lit(1), F.col("doc_id")))
    got = stage(spark, wide, SF_DIR)
    assert got.schema.names == wide.schema.names
    given = {r.doc_id: r for r in wide.collect()}
    rows = got.collect()
    assert 0 < len(rows) < len(given) and all(r == given[r.doc_id] for r in rows)
    assert {r.doc_id for r in rows} == {r.doc_id for r in stage(spark, docs, SF_DIR).select("doc_id").collect()}
    assert stage(spark, wide.limit(0), SF_DIR).count() == 0


def test_encoding_and_decoding_do_not_share_a_task(spark, odd_docs):
    """Each pass over Arrow batches has a Python worker of its own in every task: two of them double the memory."""
    both = corpus_pipeline.encode_and_decode(spark, odd_docs, None)
    assert both._jdf.queryExecution().executedPlan().toString().count("MapInArrow ") == 1
    texts = [(r.doc_id, r.text) for r in odd_docs.collect()]
    expected = [(d, t, LIBRARY.encode(t or "", add_special_tokens=False).ids, t or "") for d, t in texts]
    assert [c.lower() for c in both.columns].count("n_tokens") == 1 and "a.b" in both.columns
    got = [(r.doc_id, r.text, r.token_ids, r.decoded) for r in both.collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert all(r.n_tokens == len(r.token_ids) for r in both.collect())


def test_run_is_the_stages_one_after_the_other(spark):
    """All rows of run() against brute force, but for the classifier, whose verdict on each document is taken as it is."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    accepted = [(r.doc_id, r.text) for r in corpus_pipeline.accept_quality(spark, docs, SF_DIR).collect()]
    ruled = [(d, t) for d, t in accepted if judged(t)[-1]]
    components = brute_components(ruled)
    alone = [(d, t) for d, t in ruled if components[d][1] == d]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    windows = {w for _, t in items for w in brute_windows(t)}
    clean = [(d, t) for d, t in alone if not windows & brute_windows(t, {len(w) for w in windows})]
    expected = [(d, LIBRARY.encode(t, add_special_tokens=False).ids, t) for d, t in clean]
    got = corpus_pipeline.run(spark, SF_DIR)
    assert set(docs.columns) < set(got.columns)
    assert sorted((r.doc_id, r.token_ids, r.decoded) for r in got.collect()) == sorted(expected)
    assert len(docs.collect()) > len(accepted) > len(ruled) > len(alone) > len(clean) > 0
