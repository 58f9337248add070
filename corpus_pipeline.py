"""The training-data pipeline: named stages over the documents table, in the order of `STAGES`.

Each stage takes what its predecessor kept, as (spark, docs, sf_dir), and returns a DataFrame; all but the last
return the columns of the documents. `sf_dir` is the folder of the other tables. The results of `run` have no
SQL form: the stages rest on a fitted model, hashed sketches and a vocabulary. `tests/llm/test_corpus_pipeline.py`
holds them against plain versions.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import bpe, contamination, near, pii, toxicity
from millrace.llm.common import content_key, fresh, prepare, stored, table

RANKS = "byte_bpe_multi_50k.tiktoken"


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 by a model fitted on the labelled ones among them."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(model.score(F.col("text")) < 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the least id."""
    return near.deduplicate(docs, size=5, threshold=0.8)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without ten consecutive words (or a whole shorter item) of any benchmark item."""
    key = fresh("key")
    text_key = F.concat_ws(":", *content_key(F.col("text")))
    found = contamination.decontaminate(
        docs.select(text_key.alias("key"), "text"), table(spark, sf_dir, "benchmark"), window=10, id_col="key"
    )
    hit = stored(found.where("n_hit > 0").select(F.col("key").alias(key)).distinct(), "contaminated")
    return docs.withColumn(key, text_key).join(hit, key, "left_anti").select(*docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data replaced by its kind; `n_chars` is that of the new text."""
    clean = docs.withColumn("text", pii.redacted(F.col("text")))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of the text, with the hash of what they decode to."""
    # After four other stages the executors' heaps are grown; a small batch is held several times over (text, ids, bytes).
    prepare(spark, 2 << 20)
    tokenizer = bpe.Tokenizer(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    rows = docs.withColumn("ids", tokenizer.encode(F.col("text")))
    return rows.withColumns(
        {
            "n_tokens": F.floor(F.length("ids") / 4),
            "ids_sha256": F.sha2("ids", 256),
            "decoded_sha256": F.sha2(tokenizer.decode(F.col("ids")), 256),
        }
    ).drop("text")


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("byte_bpe", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result is written to the shared folder and read back before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
