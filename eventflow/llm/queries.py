"""The registered queries of this subpackage: thin uses of its operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.llm import oracles
from eventflow.llm.common import fold, read_table
from eventflow.llm.decontaminate import contamination
from eventflow.llm.exact_dedup import label_copies
from eventflow.llm.html import extract
from eventflow.llm.lexical import search
from eventflow.llm.licenses import scan
from eventflow.llm.lm import fit, read_corpus, score
from eventflow.llm.packing import pack
from eventflow.llm.pii import KINDS, personal_data
from eventflow.llm.quality import ACCEPT, fit_quality, labelled_sample, score_quality
from eventflow.llm.simhash import near_duplicates
from eventflow.llm.swaps import pack_whole
from eventflow.llm.toxicity import fit_toxicity, score_toxicity
from eventflow.llm.variants import spelling_variants

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    if hasattr(oracles, build.__name__.upper()):
        ORACLE_SQL[build.__name__] = getattr(oracles, build.__name__.upper())
    return build


@query
def op1_packing(spark, sf_dir):
    """Packing of all documents into sequences of 1024 tokens."""
    return pack(read_table(spark, sf_dir, "documents"))


@query
def op2_pii(spark, sf_dir):
    """Personal data in all documents."""
    def written(column):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    found = personal_data(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *map(number, KINDS), F.sha2(written("base").cast("binary"), 256).alias("base_sha256"), written("spans").alias("spans")
    )


@query
def op3_lm_scoring(spark, sf_dir):
    """Likelihood of all documents, learned from nine tenths of them."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    training = fold("doc_id", 10) != 0
    corpus = read_corpus(docs, training)
    scored = score(docs, fit(docs, training, corpus), corpus)
    return scored.select(
        "doc_id", (fold("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known",
        F.lit(corpus.tokens).cast("bigint").alias("train_tokens"), "base_score", "score",
    )


@query
def op4_toxicity(spark, sf_dir):
    """Toxicity of all documents, learned from four fifths of the labels."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    training = fold("doc_id", 5) != 0
    weights = fit_toxicity(labelled_sample(docs, read_table(spark, sf_dir, "labels"), "toxic", training))
    return score_toxicity(docs, weights).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op5_simhash(spark, sf_dir):
    """SimHash classes of all documents."""
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


@query
def op6_decontamination(spark, sf_dir):
    """Benchmark passages in all documents."""
    found = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def quality_weights(spark, sf_dir, docs):
    training = fold("doc_id", 4) != 2
    return fit_quality(labelled_sample(docs, read_table(spark, sf_dir, "labels"), "quality", training))


@query
def op7_quality(spark, sf_dir):
    """Quality of all documents, learned from three quarters of the labels."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, quality_weights(spark, sf_dir, docs))
    return scored.select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), F.col("quality_score").alias("score"),
        (F.col("quality_score") >= ACCEPT).cast("int").alias("predicted"),
    )


@query
def op8_licenses(spark, sf_dir):
    """Licences of all documents."""
    return scan(read_table(spark, sf_dir, "documents")).select(
        "doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses")
    )


@query
def op9_html(spark, sf_dir):
    """Main text of all pages."""
    return extract(read_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op10_exact_dedup(spark, sf_dir):
    """Groups of equal documents, and which of each stays."""
    found = label_copies(read_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("keep_id"), F.col("group_size").cast("bigint").alias("group_size"), "kept",
        F.col("digest").alias("text_sha256"),
    )


@query
def op11_lexical_search(spark, sf_dir):
    """The best documents of all for each benchmark item."""
    found = search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("item_id", "rank", "doc_id", "score")


@query
def op12_spelling_variants(spark, sf_dir):
    """The words of all documents, each with the word it is a spelling variant of."""
    return spelling_variants(read_table(spark, sf_dir, "documents"))


@query
def op13_swap_packing(spark, sf_dir):
    """Packing of all documents, whole where they fit, into few sequences of 2048 tokens."""
    return pack_whole(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
