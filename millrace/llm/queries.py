"""The registered queries of this subpackage: thin uses of its operators on the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import bpe, contamination, licenses, lm, lzprint, merkle, near, pii, quality, rules, spelling, substrings, toxicity
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


RANKS = "byte_bpe_multi_50k.tiktoken"


@query
def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = bpe.Tokenizer(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    rows = bpe.round_trip(table(spark, folder, "documents"), tokenizer)
    return rows.select(
        "doc_id",
        F.floor(F.length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    rows = contamination.decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op3_substrings(spark: SparkSession, folder: str) -> DataFrame:
    rows = substrings.remove_repeats(table(spark, folder, "documents"), 35)
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near.near_duplicates(table(spark, folder, "documents"), size=5, threshold=0.8)


@query
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    scored = docs.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), model.score(F.col("text")).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = table(spark, folder, "documents").select("doc_id", pii.spans(F.col("text")).alias("found"))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["base"])
    return found.select(
        "doc_id",
        *(count(kind) for kind in pii.KINDS),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
    )


@query
def op7_lzprint(spark: SparkSession, folder: str) -> DataFrame:
    rows = lzprint.compare_with_next(table(spark, folder, "documents"))
    prints = ("fingerprint", "edited_fingerprint", "near_edited", "near_next")
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), *prints)


@query
def op8_lm(spark: SparkSession, folder: str) -> DataFrame:
    return lm.differences(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(table(spark, folder, "documents"), licenses.notices(spark))
    return found.select(
        "doc_id",
        F.size("matches").cast("bigint").alias("n_matches"),
        F.array_join(F.transform("matches", lambda m: m["template"]), ",").alias("licenses"),
        F.coalesce(F.round(F.array_max(F.transform("matches", lambda m: m["containment"])), 6), F.lit(0.0)).alias(
            "best_containment"
        ),
    )


ORACLE["op9_licenses"] = licenses.SQL


@query
def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Grades: 0 poor, 1 good but toxic, 2 good. Held-out rows are not learnt from."""
    docs = table(spark, folder, "documents")
    held_out = toxicity.held_out(F.col("doc_id"))
    grade = F.col("quality") * (2 - F.coalesce("toxic", F.lit(0)))
    ratings = table(spark, folder, "labels").where(~held_out).select("doc_id", grade.alias("grade"))
    model = quality.fit(docs, ratings, grades=3)
    found = docs.select("doc_id", held_out.alias("held_out"), model.tails(F.col("text")).alias("tails"))
    return found.select(
        "doc_id",
        "held_out",
        quality.expected_grade(F.col("tails")).alias("expected_grade"),
        F.get("tails", F.lit(0)).alias("tail_probability"),
        (F.get("tails", F.lit(0)) >= 0.5).alias("keep"),
    )


@query
def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.group(spelling.vocabulary(table(spark, folder, "documents")))


ORACLE["op11_spelling"] = spelling.SQL


LEAF = ["doc_id", "source", "lang", "n_chars", "text"]


@query
def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    marked = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    tampered = F.when(marked, F.try_add("n_chars", F.lit(1))).otherwise(F.col("n_chars"))
    shown = merkle.leaf([tampered if name == "n_chars" else F.col(name) for name in LEAF])
    rows = merkle.build(docs, LEAF, carry={"shown": shown}).proofs()
    folded = merkle.refold(F.col("item.shown"), F.col("path"))
    rows = rows.select(
        F.col("item.id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        merkle.path_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


ORACLE["op12_merkle"] = merkle.SQL


@query
def op13_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Held-out rows are not learnt from."""
    docs = table(spark, folder, "documents")
    held_out = toxicity.held_out(F.col("doc_id"))
    learned = rules.fit(docs, table(spark, folder, "labels").where(~held_out))
    found = docs.select("doc_id", held_out.alias("held_out"), rules.statistics(F.col("text")).alias("stats"))
    stats = F.col("stats")
    rule = learned.decided_by(rules.features(stats))
    found = found.select(
        "doc_id",
        "held_out",
        *(stats[name].alias(name) for name in rules.COUNTS[:5]),
        rules.base_failed(stats).alias("base_failed"),
        rule.cast("bigint").alias("rule"),
    )
    return found.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
