"""The queries of this subpackage over the given tables, and their SQL counterparts."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.llm.alignment import align_tokenizers
from flowgauge.llm.hyperplane_dedup import near_duplicate_vectors
from flowgauge.llm.labelled import held_out
from flowgauge.llm.mixing import mixing_plan
from flowgauge.llm.near_dedup import near_duplicates
from flowgauge.llm.oracles import (
    mixing_sql,
    near_duplicates_sql,
    near_vectors_sql,
    quote_threads_sql,
    topk_sql,
    vector_codes_sql,
)
from flowgauge.llm.packing import pack_documents
from flowgauge.llm.partition_search import nearest_neighbours
from flowgauge.llm.quality import fit_quality, quality_scores
from flowgauge.llm.quote_threads import quote_threads
from flowgauge.llm.tables import table
from flowgauge.llm.threshold_search import exact_topk
from flowgauge.llm.token_orc import read_tokens, token_index, write_tokens
from flowgauge.llm.toxicity import fit_toxicity, toxicity_scores
from flowgauge.llm.url_filter import fit_urls, judge_urls, labelled_by_words
from flowgauge.llm.vector_codes import code_vectors
from flowgauge.session import scratch_path

#: Fixed values of the URL query: rules, and words of hosts that count as labelled spam.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
SPAM_WORDS = ["spam", "pills", "casino", "bets", "adult", "ads"]


def op1_super_minhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate groups of all documents: three words a shingle, similarity 0.85."""
    return near_duplicates(table(spark, sf, "documents"), width=3, percent=85)


def op2_hyperplane_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate groups of all vectors: cosine 0.9."""
    return near_duplicate_vectors(table(spark, sf, "embeddings"), cosine=0.9)


def op3_lexical_url_trees(spark: SparkSession, sf: str) -> DataFrame:
    """Every page's URL judged by rules, and by boosted trees where no rule fits; one host in five is not learned from."""
    pages = table(spark, sf, "pages")
    labelled = labelled_by_words(pages, SPAM_WORDS)
    model = fit_urls(labelled.where(~held_out_host()))
    return judge_urls(pages, URL_RULES, model).withColumn("held_out", held_out_host())


def held_out_host() -> Column:
    """One host in five, by its CRC-32: a site is learned from as a whole or not at all."""
    return F.crc32(F.col("host").cast("binary")) % 5 == 0


def op4_systematic_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """What a mix of 150% of all words takes of every document; sources weigh 3, 1, 2 in turn."""
    plan = mixing_plan(table(spark, sf, "documents"), weights=(3, 1, 2), share=1.5, most=2.0)
    row = F.explode(F.sequence(F.lit(1).cast("long"), "rows")).alias("_row")
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return plan.select("doc_id", "size", "source_size", "target", taken, row).drop("_row")


def op5_orc_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """All documents encoded to ORC files by id, and what the files hold of each."""
    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_index(read_tokens(spark, path))


def op6_quote_threads(spark: SparkSession, sf: str) -> DataFrame:
    """All messages in the order of replies, without quotes; a message that answers none has parent -1."""
    threads = quote_threads(table(spark, sf, "conversations"))
    return threads.withColumn("parent_turn", F.coalesce("parent_turn", F.lit(-1)))


def op7_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    """All documents packed into sequences of 2,048 tokens."""
    return pack_documents(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048)


def op8_string_kernel_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity of every document by a string-kernel support vector machine."""
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    return _judged(toxicity_scores(docs, fit_toxicity(docs, labels)), 0.5)


def op9_threshold_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 best of all vectors for every twentieth, by integer inner product."""
    return exact_topk(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op10_additive_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Quality of every document by a generalised additive model with pairwise interactions."""
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    return _judged(quality_scores(docs, fit_quality(docs, labels)), 0.3)


def op11_gnat_codes(spark: SparkSession, sf: str) -> DataFrame:
    """All vectors as codes of 16 parts, with codebooks of 64 entries moved twice."""
    return code_vectors(table(spark, sf, "embeddings"), parts=16, entries=64, rounds=2, scale=256)


def op12_window_alignment(spark: SparkSession, sf: str) -> DataFrame:
    """How the tokens of two tokenizers overlap in every document, and how common its links are in all of them."""
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align_tokenizers(table(spark, sf, "documents"), *paths).documents


def op13_learned_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """The 10 nearest of all vectors for every hundredth, found in the parts that a classifier routes it to."""
    return nearest_neighbours(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def _judged(scores: DataFrame, threshold: float) -> DataFrame:
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    return scores.select("doc_id", held_out().alias("held_out"), "score", predicted)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_super_minhash_dedup,
        op2_hyperplane_dedup,
        op3_lexical_url_trees,
        op4_systematic_mixing,
        op5_orc_tokens,
        op6_quote_threads,
        op7_best_fit_packing,
        op8_string_kernel_toxicity,
        op9_threshold_topk,
        op10_additive_quality,
        op11_gnat_codes,
        op12_window_alignment,
        op13_learned_partitions,
    )
}

ORACLES: dict[str, str] = {
    "op1_super_minhash_dedup": near_duplicates_sql(3, 85),
    "op2_hyperplane_dedup": near_vectors_sql(0.9),
    "op4_systematic_mixing": mixing_sql((3, 1, 2), 1.5, 2.0, 7),
    "op6_quote_threads": quote_threads_sql(),
    "op9_threshold_topk": topk_sql(20, 20, 64),
    "op11_gnat_codes": vector_codes_sql(16, 64, 2, 256),
}
