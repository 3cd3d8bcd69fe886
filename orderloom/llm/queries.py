"""The registered queries of this package: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import oracles, quality_classifier, toxicity
from .alignment import align, with_pair_counts
from .decontamination import contamination
from .language_id import identify, learn
from .mixing import mixed_counts
from .periodic_runs import periodic_runs
from .quality_rules import risk_controlled
from .samples import fold
from .scratch import staged
from .sharding import shard_plan
from .simhash import near_duplicate_groups
from .substring_dedup import remove_repeats
from .token_counts import count_tokens
from .token_files import read_tokens, write_tokens

TOKENIZER = "byte_bpe_50k.json"
OTHER_TOKENIZER = "piece_bpe_32k.model"
CONTEXT_TOKENS = 512
END_ID = 2
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(folds: int, out: int):
    """Whether a document is kept from learning; a null id is not."""
    return F.coalesce(fold("doc_id", folds) == out, F.lit(False)).alias("held_out")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document, through a cache that starts empty."""
    import public_tokenizers

    counts = count_tokens(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path(TOKENIZER),
        scratch_path(spark, "token-cache"),
        ["doc_id"],
    )
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > CONTEXT_TOKENS).alias("over_limit"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often a mix of weighted sources takes every document."""
    mixed = mixed_counts(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document."""
    scores = toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out=(3, 1))
    return scores.select("doc_id", held_out(3, 1), "score", "predicted", "threshold", "rejected")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark spans of 10 words in every document."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"], span=10)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint and near-duplicate group of every document."""
    groups = near_duplicate_groups(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    digits = F.lower(F.lpad(F.hex("simhash"), 16, "0"))
    return groups.select("doc_id", digits.alias("fingerprint"), "component_id")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of every document, and whether rules with controlled risk keep it."""
    return risk_controlled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = table(spark, sf_dir, "documents")
    identifier = learn(docs.filter(fold("doc_id", 4) != 2))
    guess = staged(docs.select("doc_id", held_out(4, 2), identify(spark, identifier).alias("guess")), "languages")
    return guess.select("doc_id", "held_out", F.col("guess.lang").alias("lang_pred"), "guess.score", "guess.bits", "guess.rejected")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of repeated spans of 35 words."""
    cut = remove_repeats(table(spark, sf_dir, "documents"), ["doc_id"], width=35)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in eight shards of nearly equal bytes."""
    plan = shard_plan(table(spark, sf_dir, "documents"), shards=8)
    return plan.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document."""
    scores = quality_classifier.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out=(4, 2))
    return scores.select("doc_id", held_out(4, 2), "score", "predicted")


def repeated_tail(doc_id: str, text: str):
    """A text as it is or, where h = crc32(doc_id) is a multiple of 10, its words with
    those from word a on, a = floor(h / 10) % n, replaced by repeats of the first p of
    them, p = 1 + floor((n - a) / (3 + floor(h / 10) % 8))."""
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n, g = F.size(words).cast("long"), F.floor(h / 10)
    a = g % F.nullif(n, F.lit(0))
    p = 1 + F.floor((n - a) / (3 + g % 8))
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, (a + 1).cast("int"), p.cast("int")), times)), 1, (n - a).cast("int"))
    head = F.slice(words, 1, a.cast("int"))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(F.concat(head, tail), " ")).otherwise(F.col(text))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", repeated_tail("doc_id", "text").alias("text"))
    found = periodic_runs(docs, ["doc_id"], min_length=6, min_periods=4)
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "strongest.start", "strongest.length", "strongest.period",
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and ids, as read back from its token files."""
    import public_tokenizers

    path = scratch_path(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), END_ID, path, ["doc_id"])
    return read_tokens(spark, path, with_ids=False)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How two tokenizers' tokens of every document overlap."""
    import public_tokenizers

    paths = public_tokenizers.path(TOKENIZER), public_tokenizers.path(OTHER_TOKENIZER)
    aligned = align(table(spark, sf_dir, "documents"), *paths, ["doc_id"])
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    kept = aligned.select(
        "doc_id", F.monotonically_increasing_id().alias("row"), "n_a", "n_b", "n_groups", "n_links", digest, "a_ids", "b_ids"
    )
    return with_pair_counts(staged(kept, "aligned"), *paths, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_mixing": op2_mixing,
    "op3_toxicity": op3_toxicity,
    "op4_decontamination": op4_decontamination,
    "op5_simhash": op5_simhash,
    "op6_quality_rules": op6_quality_rules,
    "op7_language_id": op7_language_id,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_sharding": op9_sharding,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_token_files": op12_token_files,
    "op13_alignment": op13_alignment,
}

ORACLES: dict[str, str] = {
    "op4_decontamination": oracles.DECONTAMINATION,
    "op8_substring_dedup": oracles.SUBSTRING_DEDUP,
}
