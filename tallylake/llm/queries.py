"""Registered queries of the operators, over whole tables with production parameters, and DuckDB statements for them."""

import hashlib

import public_tokenizers
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.llm import (
    bpe_automaton, decontamination, fair_mix, hard_negatives, jaccard_join, periodic_runs, pitman_yor, quality_model,
    quality_rules, storage, token_counts, token_files, toxicity, warc,
)
from tallylake.llm.shipping import ship

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark, sf_dir, name):
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, TOKENIZER).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op2_decontamination(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.contamination(docs, _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated",
    )


def op3_quality_model(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_model.classify(docs).select("doc_id", "quality_score", "accepted")


def op4_token_files(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    folder = token_files.write_tokens(docs, TOKENIZER, storage.new_folder(spark, "token-files"))
    return token_files.read_tokens(spark, folder, ["ids_crc32"])


def op5_jaccard_join(spark, sf_dir):
    return jaccard_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_warc(spark, sf_dir):
    folder = warc.write_warc(_table(spark, sf_dir, "pages"), storage.new_folder(spark, "warc"))
    records = warc.read_warc(spark, folder, payload=False).where(F.col("record_type").isin("response", "revisit"))
    return records.select(
        F.col("source_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to_source_id").cast("long").alias("refers_to"),
    )


def op7_pitman_yor(spark, sf_dir):
    return pitman_yor.language_scores(_table(spark, sf_dir, "documents"))


def op8_bpe_automaton(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe_automaton.encode(docs, TOKENIZER).select("doc_id", "token_ids")
    both = bpe_automaton.decode(ids, TOKENIZER)
    return both.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.toxicity(docs, _table(spark, sf_dir, "labels"))
    return found.select("doc_id", *[f"p_kind_{i + 1}" for i in range(toxicity.KINDS)], "p_toxic", "is_toxic")


def op10_quality_rules(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_hard_negatives(spark, sf_dir):
    rows = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def repeated_tail(text, ident):
    """The text, in a tenth of the ids with its words from some place on replaced by repeats of the first of them."""
    h = F.crc32(ident.cast("string"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    g = F.floor(h / 10)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    cycle = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    repeated = F.concat(F.slice(words, F.lit(1), a), F.slice(cycle, F.lit(1), n - a))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(repeated, " ")).otherwise(text)


def runs_digest(words, runs):
    """Number of runs, the longest one (least start, then period, of equal ones), digests of all runs and of the rest."""
    longest = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    listed = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
    kept = b" ".join(periodic_runs.collapse(words, runs))
    figures = (*longest, 1000 * longest[1] // longest[2]) if longest else (None,) * 4
    return (len(runs), *figures, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


_DIGEST = [T.StructField(name, T.LongType()) for name in ("n_runs", "start", "length", "period", "exponent_milli")]
_DIGEST += [T.StructField(name, T.StringType()) for name in ("runs_sha256", "collapsed_sha256")]


def op12_periodic_runs(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("text", repeated_tail(F.col("text"), F.col("doc_id")))
    found = periodic_runs.periodic_runs(docs, finish=runs_digest, fields=_DIGEST, keep_text=False)
    return found.select("doc_id", *[f.name for f in _DIGEST])


def op13_fair_mix(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return fair_mix.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_decontamination": op2_decontamination,
    "op3_quality_model": op3_quality_model,
    "op4_token_files": op4_token_files,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_warc": op6_warc,
    "op7_pitman_yor": op7_pitman_yor,
    "op8_bpe_automaton": op8_bpe_automaton,
    "op9_toxicity": op9_toxicity,
    "op10_quality_rules": op10_quality_rules,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_fair_mix": op13_fair_mix,
}
