"""Registered queries of the subpackage: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from martflow.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def public_tokenizer(name: str) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_counts(spark, sf_dir):
    """Tokens of every document under the 32k sentencepiece model."""
    from martflow.llm.tokens import Tokenizer, token_counts
    return token_counts(read_table(spark, sf_dir, "documents"), Tokenizer(public_tokenizer("piece_bpe_32k.model")))


@query
def op2_suffix_dedup(spark, sf_dir):
    """Bytes of every document in strings of 100 bytes that start earlier too."""
    from martflow.llm.repeats import without_repeats
    return without_repeats(read_table(spark, sf_dir, "documents"))


@query
def op3_pii(spark, sf_dir):
    """Personal data in every document."""
    from martflow.llm.pii import joined, personal_data
    rows = personal_data(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["order"] < 4)
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return rows.select("doc_id", *map(count, ("email", "ip", "card", "phone")), F.sha2(joined(base), 256).alias("base_sha256"),
                       joined(F.col("spans")).alias("spans"))


@query
def op4_quality_rules(spark, sf_dir):
    """Statistics and verdict of every document."""
    from martflow.llm.quality import judged
    return judged(read_table(spark, sf_dir, "documents"))


@query
def op5_simhash_near_dedup(spark, sf_dir):
    """Fingerprint and near-duplicate group of every document."""
    from martflow.llm.simhash import near_duplicates
    rows = near_duplicates(read_table(spark, sf_dir, "documents"), shingle=4, distance=4)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op6_mixing(spark, sf_dir):
    """The mixture of all documents, sources weighted by the root of their size."""
    from martflow.llm.mixing import mixed
    rows = mixed(read_table(spark, sf_dir, "documents"))
    return rows.select("doc.doc_id", "doc.source", "doc.text", "replica", "shuffle_key")


@query
def op7_toxicity(spark, sf_dir):
    """Toxicity of every document, learnt from labels that aren't held out."""
    from martflow.llm.toxicity import toxicity
    return toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op8_decontamination(spark, sf_dir):
    """Benchmark passages in every document."""
    from martflow.llm.decontaminate import contamination
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query
def op9_lm_scoring(spark, sf_dir):
    """Loss of every document under English against all documents."""
    from martflow.llm import language_model as lm
    docs = read_table(spark, sf_dir, "documents")
    return lm.cross_entropies(docs, F.col("lang") == "en")


@query
def op10_url_filter(spark, sf_dir):
    """Verdict on every page's URL."""
    from martflow.llm.url_filter import judged
    return judged(read_table(spark, sf_dir, "pages"))


@query
def op11_vector_codes(spark, sf_dir):
    """Code and error of every vector under codebooks of 8 parts and 16 entries."""
    from martflow.llm.vector_codes import listed, vector_codes
    rows, codebooks = vector_codes(read_table(spark, sf_dir, "embeddings"))
    return rows.select("vec_id", "code", "error", "label_error", F.sha2(F.lit(listed(codebooks)), 256).alias("codebooks_sha256"))


@query
def op12_periodic_runs(spark, sf_dir):
    """Periodic runs of words in every document, one in ten with a planted period."""
    from martflow.llm.runs import periodic_runs, with_planted_periods
    rows = periodic_runs(with_planted_periods(read_table(spark, sf_dir, "documents")))
    rows = rows.withColumn("best", F.array_min(F.expr("transform(runs, r -> struct(-r.length as n, r.start as start, r.period as period))")))
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), (-F.col("best.n")).alias("length"),
        F.col("best.period").alias("period"), F.expr("(-1000 * best.n) div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op13_language_id(spark, sf_dir):
    """Language of every document, learnt from those that aren't held out."""
    from martflow.llm.language import languages
    return languages(read_table(spark, sf_dir, "documents"))


@query
def pipeline(spark, sf_dir):
    """The corpus pipeline: quality, near-duplicates, decontamination, personal data, mixture."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
