"""The corpus pipeline: documents in, tokens of the clean, distinct, masked documents out.

Every stage takes (spark, docs, sf_dir) and works on all rows it is given; all but the last return the
columns of documents. Rows with null ids or texts pass the filters: nothing speaks against them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cofferline.llm import bpe, decontaminate, jaccard, pii, toxicity
from cofferline.llm.common import stored, table
from cofferline.llm.queries import held_out

NEAR_WORDS, NEAR_PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; labels of the held-out fifth are not learnt."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.fit(docs, labels.filter(~held_out()))
    scored = toxicity.score_toxicity(docs, model, toxicity="_toxicity")
    return scored.filter(F.col("_toxicity.score") < 0.5).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of linked documents, the one with the smallest doc_id."""
    return jaccard.drop_near_copies(docs, NEAR_WORDS, NEAR_PERCENT)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words repeat the benchmark."""
    judged = decontaminate.find_benchmark(docs, table(spark, sf_dir, "benchmark"), found="_found")
    return judged.filter(~decontaminate.contaminated("_found")).select(docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars follows the text."""
    masked = pii.redact(pii.find_pii(docs, pii.fit(docs), spans="_spans"), spans="_spans")
    changed = F.size("_spans") > 0
    n_chars = F.when(changed, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", n_chars).select(docs.columns)


def encode_and_check(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether they decode to its text; a null text decodes to nothing."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.byte_bpe_round_trip(docs, ranks, public_tokenizers.PATTERN, coded="_coded")
    same = F.col("_coded.decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    n_tokens = F.size("_coded.ids").cast("bigint").alias("n_tokens")
    return coded.select("doc_id", "lang", "source", n_tokens, "_coded.ids", same.alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark),
    ("pii", mask_personal_data),
    ("byte_bpe", encode_and_check),
]

#: No SQL can express the first, fourth and fifth stage; a test holds the rows against a plain restatement.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; each result is stored before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
