"""Token counts through a digest cache.

The cache is a Parquet table of (tokenizer, digest, n_tokens): the digest of the
tokenizer's files and settings, and that of the text.  Counting joins the digests of
all texts to it, encodes one text per digest that it lacks, and appends the counts.
A text is normalised as the tokenizer's input is, so only null becomes empty: any
other change could change the count.  Normalisers that belong to a tokenizer run
inside it.

One text per missing digest moves to the encoding tasks, gathered before the
shuffle; the lookup moves digests alone.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .keys import utf8_bytes
from .scratch import BATCH, BATCH_BYTES, CLEANUP, setting

CACHE_SCHEMA = "digest binary, n_tokens long, tokenizer string"
# Texts are encoded in runs of about so many characters.
RUN_CHARS = 1 << 20

# How byte-level BPE files write bytes as characters, and the pattern
# that cuts texts before the merges.
PRINTABLE = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary."""
    rest = [b for b in range(256) if b not in set(PRINTABLE)]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(rest)}


def merge_ranks(spec: dict) -> dict[bytes, int] | None:
    """The vocabulary of a tokenizer file as merge ranks, if it is plain byte-level BPE
    whose ids follow its merges; these have a faster encoder with equal results."""
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE"
        and cut.get("type") == "ByteLevel"
        and cut.get("use_regex", True)
        and not cut.get("add_prefix_space")
        and not spec.get("normalizer")
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and all(t["special"] and not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in spec["added_tokens"])
    )
    if not plain:
        return None
    vocabulary, special = model["vocab"], {t["content"] for t in spec["added_tokens"]}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if any(vocabulary[a + b] != 256 + i for i, (a, b) in enumerate(merges)):
        return None
    to_byte = byte_characters()
    return {bytes(to_byte[c] for c in token): rank for token, rank in vocabulary.items() if token not in special}


def encoder(name: str, data: bytes) -> Callable[[list[str]], list[int]]:
    """Token counts of texts under a tokenizer file: .json or .model."""
    if name.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_proto=data)
        return lambda texts: [len(ids) for ids in pieces.encode(texts, num_threads=1)]
    spec = json.loads(data)
    ranks = merge_ranks(spec)

    @functools.cache
    def library():
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_buffer(data)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    def by_library(text: str) -> int:
        return len(library().encode_batch([text], add_special_tokens=False)[0])

    if ranks is None:
        return lambda texts: [by_library(t) for t in texts]
    import tiktoken

    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    encoding = tiktoken.Encoding("own", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def fast(text: str) -> int:
        # Its pattern gives up on runs of about a million spaces; the library does not.
        try:
            return len(encoding.encode(text, allowed_special="all"))
        except ValueError:
            return by_library(text)

    return lambda texts: [fast(t) for t in texts]


def tokenizer_digest(name: str, data: bytes) -> str:
    """Names a tokenizer's version: its file's content and kind."""
    return hashlib.sha256(name.rpartition(".")[2].encode() + b"\0" + data).hexdigest()


class TokenCache:
    """Stored counts below a folder that all executors reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def read(self, tokenizer: str) -> DataFrame:
        """(digest, n_tokens), each digest once; runs that wrote one at the same time agree."""
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        files = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        stored = (
            self.spark.read.schema(CACHE_SCHEMA).parquet(self.path)
            if files.exists(folder)
            else self.spark.createDataFrame([], CACHE_SCHEMA)
        )
        # Grouped by a second column too: so this shuffle is none that a join on the digest could
        # use as its own, and adaptive execution can split a digest that very many rows have.
        apart = F.xxhash64("digest").alias("apart")
        counts = stored.filter(F.col("tokenizer") == tokenizer).groupBy("digest", apart).agg(F.max("n_tokens").alias("n_tokens"))
        return counts.select("digest", "n_tokens")

    def append(self, counts: DataFrame, tokenizer: str) -> None:
        with setting(self.spark, CLEANUP, "true"), setting(self.spark, BATCH, BATCH_BYTES):
            counts.select("digest", "n_tokens", F.lit(tokenizer).alias("tokenizer")).write.mode("append").partitionBy(
                "tokenizer"
            ).option("compression", "zstd").parquet(self.path)


def count_tokens(
    docs: DataFrame, tokenizer_path: str, cache_path: str, keys: list[str], text: str = "text"
) -> DataFrame:
    """Returns `keys`, digest, n_bytes (UTF-8) and n_tokens of every row's whole text.

    No begin or end tokens are added; strings of special tokens inside a text count as
    the library's default has them.  Null counts as empty: 0 tokens.  Copies share one
    entry of the cache.  Repeated rows stay; no rows give no rows; other columns are
    not read.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, "rb") as file:
        data = file.read()
    version = tokenizer_digest(tokenizer_path, data)
    shared = spark.sparkContext.broadcast((tokenizer_path, data))  # one file of a few MB
    whole = F.coalesce(F.col(text), F.lit(""))
    digest = F.unhex(F.sha2(whole, 256)).alias("digest")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = None
        for batch in batches:
            counts = counts or encoder(*shared.value)
            texts, numbers, run, held = batch.column("text"), [], [], 0
            for value in texts:
                run.append(value.as_py())
                held += len(run[-1])
                if held >= RUN_CHARS:
                    numbers += counts(run)
                    run, held = [], 0
            numbers += counts(run)
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(numbers, pa.int64())], names=["digest", "n_tokens"])

    cache = TokenCache(spark, cache_path)
    distinct = docs.select(digest, whole.alias("text")).groupBy("digest").agg(F.first("text").alias("text"))
    misses = distinct.join(cache.read(version), "digest", "left_anti")
    cache.append(misses.mapInArrow(encode, "digest binary, n_tokens long"), version)
    rows = docs.select(*keys, digest, utf8_bytes(text).alias("n_bytes"))
    return rows.join(cache.read(version), "digest").select(*keys, "digest", "n_bytes", "n_tokens")
