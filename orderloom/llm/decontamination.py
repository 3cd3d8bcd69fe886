"""Benchmark decontamination by winnowing, in DataFrame functions alone.

A document's fingerprints are the smallest k-gram hash of every window of w k-grams
in a row, with its place.  Two spans of k + w - 1 equal words have a window in common
and with it a fingerprint, so no shared span of that length is missed: with k = 5 and
w = 6, none of 10 words.  Fingerprints of documents are joined to those of the
benchmark; around each hit, the spans of 10 words that hold it are compared with the
items' spans by a second, wider hash, which extends hits to all their words.

An item of n < 10 words is one span of n words, for which winnowing has k = n, w = 1:
every n-gram of the documents is looked up.  That is done only for the lengths that
occur, in the same pass.

Documents are tokenised once, for the fingerprints of all lengths, which are stored;
then only texts with a hit are read again.  The benchmark's tables and the keys of hit
texts are stored first, so their measured size decides whether Spark broadcasts them;
beyond its threshold the joins shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .keys import TEXT_KEY, text_key
from .scratch import staged

SPAN = 10
K = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str) -> Column:
    """Lower-case runs of letters, digits and characters beyond ASCII; null has none."""
    return F.coalesce(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def starts(n: Column, width: int) -> Column:
    """Where windows of `width` of n begin, from 0."""
    return F.when(n >= width, F.sequence(F.lit(0), (n - width).cast("int"))).otherwise(F.array().cast("array<int>"))


def grams(hashes: str, width: int) -> Column:
    """The hash of every `width` word hashes in a row."""
    h = F.col(hashes)
    return F.transform(starts(F.size(h), width), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(width)]))


def winnow(hashes: str, width: int) -> Column:
    """The distinct values among the smallest of every `width` hashes in a row.  Fewer
    hashes than that are one window."""
    h = F.col(hashes)
    last = F.greatest(F.size(h) - width, F.lit(0))
    windows = F.when(F.size(h) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    # Elements are taken one by one: a slice would copy the whole array each time.
    return F.array_distinct(F.transform(windows, lambda i: F.least(*[F.get(h, i + j) for j in range(width)])))


def span_key(tokens: str, at: Column, width: int) -> list[Column]:
    """128 bits of hash of `width` words from `at`, as s1 and s2; places beyond the end
    count for nothing."""
    span = [F.get(F.col(tokens), at + j) for j in range(width)]
    return [F.xxhash64(*span).alias("s1"), F.xxhash64(F.lit(1), *span).alias("s2")]


def item_spans(benchmark: DataFrame, item_id: str, text: str, span: int) -> DataFrame:
    """(item_id, width, span, s1, s2) of every item's spans, span as an array of words."""
    items = benchmark.select(F.col(item_id).alias("item_id"), words(text).alias("w")).filter("size(w) > 0")
    width = F.least(F.size("w"), F.lit(span))
    at = F.explode(F.sequence(F.lit(0), F.size("w") - width))
    rows = items.select("item_id", "w", width.alias("width"), at.alias("at"))
    own = F.transform(F.sequence(F.lit(0), F.col("width") - 1), lambda j: F.get("w", F.col("at") + j))
    return rows.select("item_id", "width", own.alias("span")).select(
        "item_id", "width", "span", *span_key("span", F.lit(0), span)
    )


def word_hashes(tokens: str) -> Column:
    return F.transform(tokens, lambda x: F.xxhash64(x)).alias("h")


def gram_of(width: int, span: int, k: int) -> tuple[int, int]:
    """The length of the grams that stand for a span, and how many of them make a window."""
    return (k, span - k + 1) if width == span else (width, 1)


def fingerprints(hashed: DataFrame, widths: list[int], span: int, k: int, *keep: str) -> DataFrame:
    """`keep` and prints, an array of (width, hash): each text's winnowed grams for spans of
    every width, from its word hashes `h`."""
    names = {width: f"g{width}" for width in widths}
    sizes = {width: gram_of(width, span, k) for width in widths}
    grammed = hashed.select(*keep, *[(grams("h", sizes[w][0]) if sizes[w][0] > 1 else F.col("h")).alias(names[w]) for w in widths])
    picked = [winnow(names[w], sizes[w][1]) if sizes[w][1] > 1 else F.array_distinct(names[w]) for w in widths]
    marked = [with_width(p, w) for w, p in zip(widths, picked)]
    return grammed.select(*keep, F.concat(*marked).alias("prints"))


def with_width(hashes: Column, width: int) -> Column:
    return F.transform(hashes, lambda x: F.struct(F.lit(width).alias("width"), x.alias("hash")))


def placed(hashes: Column, width: int) -> Column:
    return F.transform(hashes, lambda x, i: F.struct(F.lit(width).alias("width"), i.alias("at"), x.alias("hash")))


def keyed_spans(tokens: str, candidates: str, width: int) -> Column:
    """The candidates of a width that fit into the text, with the keys of their spans."""
    fits = F.filter(candidates, lambda c: (c["width"] == width) & (c["at"] + width <= F.size(tokens)))
    return F.transform(fits, lambda c: F.struct(c["width"].alias("width"), c["at"].alias("at"), *span_key(tokens, c["at"], width)))


def printed(docs: DataFrame, spans: DataFrame, text: str, span: int, k: int, *keep: str) -> tuple[list[int], DataFrame]:
    """The lengths of the benchmark's spans, and (`keep`, text keys, n_words, prints) of every
    row, stored; `spans` as `item_spans`, stored."""
    widths = sorted(r[0] for r in spans.select("width").distinct().collect())  # `span` at most
    tokenized = docs.select(*keep, *text_key(text), words(text).alias("w"))
    hashed = tokenized.select(*keep, *TEXT_KEY, F.size("w").cast("long").alias("n_words"), word_hashes("w"))
    if not widths:
        none = F.array().cast("array<struct<width:int,hash:bigint>>").alias("prints")
        return widths, staged(hashed.select(*keep, *TEXT_KEY, "n_words", none), "prints")
    return widths, staged(fingerprints(hashed, widths, span, k, *keep, *TEXT_KEY, "n_words"), "prints")


def shared_spans(docs: DataFrame, prints: DataFrame, spans: DataFrame, widths: list[int], text: str, span: int, k: int) -> DataFrame:
    """(text keys, at, width, s1, s2) of the benchmark's spans in each distinct text that
    has any; `prints` and `widths` as `printed`."""
    hashed = spans.select("width", word_hashes("span"))
    own = [fingerprints(hashed.filter(F.col("width") == w), [w], span, k).select(F.explode("prints").alias("p")) for w in widths]
    wanted = staged(reduce(DataFrame.unionAll, own).select("p.*").distinct(), "fingerprints")
    found = prints.select(*TEXT_KEY, F.explode("prints").alias("p")).select(*TEXT_KEY, "p.*")
    hits = staged(found.join(wanted, ["width", "hash"], "left_semi").distinct(), "hits")

    # One text for each key that has a hit.
    keys = staged(hits.select(*TEXT_KEY).distinct(), "hit-keys")
    texts = docs.select(*text_key(text), F.col(text).alias("text")).join(keys, list(TEXT_KEY), "left_semi")
    once = texts.groupBy(*TEXT_KEY).agg(F.first("text").alias("text"))
    tokenized = staged(once.select(*TEXT_KEY, words("text").alias("w")), "hit-texts")

    grammed = tokenized.select(*TEXT_KEY, word_hashes("w"))
    sizes = {w: gram_of(w, span, k)[0] for w in widths}
    by_width = [placed(grams("h", sizes[w]) if sizes[w] > 1 else F.col("h"), w) for w in widths]
    places = grammed.select(*TEXT_KEY, F.explode_outer(F.concat(*by_width)).alias("g")).select(*TEXT_KEY, "g.*")
    places = places.join(hits, [*TEXT_KEY, "width", "hash"], "left_semi")
    # Extend: all spans that hold a hit, as far as the text goes.
    reach = F.create_map(*[F.lit(x) for w in widths for x in (w, w - sizes[w])])[F.col("width")]
    around = F.explode(F.sequence(F.greatest(F.col("at") - reach, F.lit(0)), F.col("at"))).alias("at")
    starts_ = places.select(*TEXT_KEY, "width", around).distinct()
    starts_ = starts_.groupBy(*TEXT_KEY).agg(F.collect_list(F.struct("width", "at")).alias("c"))
    spanned = tokenized.join(starts_, list(TEXT_KEY))
    keyed = [keyed_spans("w", "c", width) for width in widths]
    candidates = spanned.select(*TEXT_KEY, F.explode_outer(F.concat(*keyed)).alias("c")).select(*TEXT_KEY, "c.*")
    known = spans.select("width", "s1", "s2").distinct()
    return candidates.join(known, ["width", "s1", "s2"], "left_semi").select(*TEXT_KEY, "at", "width", "s1", "s2")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    keys: list[str],
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    span: int = SPAN,
    k: int = K,
) -> DataFrame:
    """One row per document: `keys`, n_words, n_hit (words within any occurrence of a
    benchmark span), items (sorted ids, as strings, of the items with such spans) and
    contaminated.

    Items without words count for nothing; those with fewer than `span` words are one
    span.  Items with a null id count for hits but not in `items`; repeated items once.
    Null and empty texts have no words.  Repeated rows each have a row.  An empty
    benchmark hits nothing.  Other columns are not read.
    """
    if not 0 < k <= span:
        raise ValueError("k must be between 1 and span")
    spans = staged(item_spans(benchmark, item_id, item_text, span), "spans")
    widths, prints = printed(docs, spans, text, span, k, *keys)
    rows = prints.select(*keys, *TEXT_KEY, "n_words")
    none = F.array().cast("array<string>")
    if not widths:
        return rows.select(*keys, "n_words", F.lit(0).cast("long").alias("n_hit"), none.alias("items"), F.lit(False).alias("contaminated"))
    found = staged(shared_spans(docs, prints, spans, widths, text, span, k), "found")
    # Words in the union of a text's spans: each counts from where the earlier ones end.
    so_far = Window.partitionBy(*TEXT_KEY).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    ends = found.groupBy(*TEXT_KEY, "at").agg(F.max(F.col("at") + F.col("width")).alias("end"))
    fresh = F.greatest(F.col("end") - F.greatest(F.col("at"), F.coalesce(F.max("end").over(so_far), F.lit(0))), F.lit(0))
    n_hit = ends.select(*TEXT_KEY, fresh.alias("fresh")).groupBy(*TEXT_KEY).agg(F.sum("fresh").alias("n_hit"))
    owners = spans.select("width", "s1", "s2", F.col("item_id").cast("string").alias("item")).distinct()
    owned = found.select(*TEXT_KEY, "width", "s1", "s2").distinct().join(owners, ["width", "s1", "s2"])
    items = owned.groupBy(*TEXT_KEY).agg(F.sort_array(F.collect_set("item")).alias("items"))
    # Stored apart from the join to all rows, so that a text which very many rows have can be split.
    marks = staged(n_hit.join(items, list(TEXT_KEY), "left"), "marks")
    return rows.join(marks, list(TEXT_KEY), "left").select(
        *keys,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", none).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", span: int = SPAN, k: int = K
) -> DataFrame:
    """The documents without those that hold a benchmark span; columns stay as they are."""
    spans = staged(item_spans(benchmark, item_id, item_text, span), "spans")
    widths, prints = printed(docs, spans, text, span, k)
    if not widths:
        return docs
    found = shared_spans(docs, prints, spans, widths, text, span, k)
    marked = staged(found.select(*TEXT_KEY).distinct(), "contaminated")
    held = docs.select(F.struct("*").alias("doc"), *text_key(text))
    return held.join(marked, list(TEXT_KEY), "left_anti").select(*[F.col("doc")[name].alias(name) for name in docs.columns])
