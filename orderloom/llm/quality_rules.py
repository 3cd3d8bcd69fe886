"""Quality rules whose cutoffs come from labelled holdouts, with a guarantee.

A rule rejects a text when one of its measures exceeds a cutoff of a fixed grid.  Each
stratum's labelled texts are parted by a hash of the text.  A quarter proposes: from no
cutoffs at all, the one that most improves on it is tightened by a step, again and again,
which gives a sequence of ever stricter sets of cutoffs.  The other three quarters decide:
in the order of the sequence, a set is valid if the exact (Clopper-Pearson) upper bound
of the share of good texts that its rules reject together is at most the allowed one.  The
first set that isn't ends the test, and the last valid one is used.  Tested in a fixed
order, all sets of a stratum share one error probability undivided; strata divide it
(Bonferroni).  So with probability 1 - `error` no stratum loses more than
`max_false_rejection` of its good texts.  A stratum with too few labels gets no cutoffs,
and keeps all that the fixed base rules keep.

Trials are distinct texts: an id counts once, whatever its rows, and a text once, whatever
its copies.  Near copies are separate texts here; the bound takes them as independent, so
a corpus full of them is best deduplicated first.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .keys import TEXT_KEY, text_key
from .scratch import staged

SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
NOT_NEWLINE = ~W.byte_class((0x0A, 0x0A))
STARTS_CODE_POINT = ~W.byte_class((0x80, 0xBF))
REPEAT_WINDOW = 8
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

# Fixed before any label is seen.
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
# What a share of good texts weighs against one of bad texts, when cutoffs are proposed.
PRICE = 10
# One labelled text in so many proposes, the others decide.
PROPOSE = 4


def measure(texts: pa.Array) -> pa.Array:
    """The features of each text."""
    out = {name: np.zeros(len(texts), dtype=np.int64) for name in FEATURES}
    for rows, buffer, bounds in W.chunks(texts):
        prefix = W.Prefix(W.BYTE_VALUES[buffer])
        in_word = W.NOT_SPACE[buffer]
        words = W.runs(in_word, bounds)
        hashes = prefix.ranges(words.start, words.end)
        out["n_words"][rows] = words.counts
        out["word_chars"][rows] = W.sums(in_word & STARTS_CODE_POINT[buffer], bounds)
        out["n_symbols"][rows] = W.sums(SYMBOLS[buffer], bounds)

        lines = W.runs(NOT_NEWLINE[buffer], bounds)
        any_word = np.searchsorted(words.start, lines.end) > np.searchsorted(words.start, lines.start)
        owner = lines.docs()[any_word]
        text = prefix.ranges(lines.start[any_word], lines.end[any_word])
        out["n_dup_lines"][rows] = np.bincount(owner[repeats(owner, text, first=False)], minlength=len(bounds) - 1)

        place = W.window_starts(words, REPEAT_WINDOW)
        owner = words.docs()
        twice = repeats(owner[place], W.window_hashes(hashes, place, REPEAT_WINDOW), first=True)
        flags = W.covered(len(hashes), place[twice], REPEAT_WINDOW)
        out["n_repeat_words"][rows] = np.bincount(owner[flags], minlength=len(bounds) - 1)
    return pa.StructArray.from_arrays([pa.array(out[name]) for name in FEATURES], names=list(FEATURES))


def repeats(owner: np.ndarray, value: np.ndarray, first: bool) -> np.ndarray:
    """Flags of the values that a document has twice or more: all, or all but the first."""
    order = np.lexsort((value, owner))
    same = (value[order][1:] == value[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    flags = np.zeros(len(value), dtype=bool)
    flags[order[1:]] = same
    if first:
        flags[order[:-1]] |= same
    return flags


def features(text: str | Column) -> Column:
    """A struct of n_words, word_chars (code points in words), n_symbols, n_dup_lines
    (lines with a word that equal an earlier one) and n_repeat_words (words in windows
    of 8 words that the text has twice or more).  Null has no words."""
    return F.arrow_udf(measure, ", ".join(f"{name} long" for name in FEATURES))(text)


def base_failed(of: str = "f") -> Column:
    """The fixed rules: too short, or too much of the text in repeated windows."""
    n = F.col(f"{of}.n_words")
    return (n < MIN_WORDS) | (100 * F.col(f"{of}.n_repeat_words") > MAX_REPEAT_PERCENT * n)


# A measure rises with what is wrong with a text; the grids are in its unit.
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols": ("f.n_symbols / greatest(f.n_words, 1)", (0.02, 0.05, 0.1, 0.2, 0.4, 0.8, 1.6)),
    "dup_lines": ("f.n_dup_lines * 40D / greatest(f.n_words, 1)", (0.1, 0.2, 0.4, 0.8, 1.6)),
    "repeat_words": ("f.n_repeat_words / greatest(f.n_words, 1)", (0.02, 0.05, 0.1, 0.15, 0.2)),
    "long_words": ("f.word_chars / greatest(f.n_words, 1)", (7.0, 7.5, 8.0, 9.0, 10.0, 12.0)),
    "short_words": ("-f.word_chars / greatest(f.n_words, 1)", (-5.0, -4.5, -4.0, -3.5, -3.0)),
}


def at_most(k: int, n: int, rate: float) -> float:
    """The probability of k or fewer of n cases at a rate.  It is at most `error` just
    when the exact upper bound, at `error`, of the rate behind k of n is at most `rate`."""
    if k >= n:
        return 1.0
    log_term = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(rate) + (n - k) * math.log1p(-rate)
    term = total = 1.0
    for i in range(k, 0, -1):
        term *= i * (1 - rate) / ((n - i + 1) * rate)
        total += term
        if term < 1e-18 * total:
            break
    return min(1.0, math.exp(min(0.0, log_term + math.log(total))))


def levels() -> list[Column]:
    """For each rule, how many cutoffs of its grid a text's measure `f` exceeds."""
    found = []
    for rule, (value, grid) in RULES.items():
        over = [F.when(F.expr(f"({value}) > {cutoff}D"), 1).otherwise(0) for cutoff in grid]
        found.append(sum(over[1:], over[0]).alias(rule))
    return found


def proposed(level: np.ndarray, good: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """Ever stricter sets of cutoffs, each by rule the index in its grid (its length: none).
    `level` has a row per kind of text, by rule the cutoffs exceeded, and `n` its number."""
    sizes = np.array([len(grid) for _, grid in RULES.values()])
    n_good, n_bad = max(1, n[good].sum()), max(1, n[~good].sum())
    current, sequence = sizes.copy(), []
    rejected = np.zeros(len(level), dtype=bool)
    while True:
        best, step = 0.0, None
        for rule in range(len(sizes)):
            for cutoff in range(current[rule]):
                more = ~rejected & (level[:, rule] > cutoff)
                use = n[more & ~good].sum() / n_bad - PRICE * n[more & good].sum() / n_good
                if use > best:
                    best, step = use, (rule, cutoff)
        if step is None:
            return sequence
        current = current.copy()
        # One step of the grid at a time, so that a set between may hold where the last doesn't.
        rule, cutoff = step
        for between in range(int(current[rule]) - 1, cutoff - 1, -1):
            current = current.copy()
            current[rule] = between
            sequence.append(current)
        rejected |= level[:, rule] > cutoff


def valid_set(sequence: list[np.ndarray], level: np.ndarray, n: np.ndarray, rate: float, error: float) -> np.ndarray | None:
    """The last set of the sequence before the first that may reject more than `rate` of the
    good texts, of which `level` and `n` tell."""
    chosen = None
    for current in sequence:
        rejected = int(n[(level > current).any(axis=1)].sum())
        if at_most(rejected, int(n.sum()), rate) > error:
            break
        chosen = current
    return chosen


def cutoffs(labelled: DataFrame, max_false_rejection: float, error: float, strata: int) -> DataFrame:
    """Per stratum the cutoff of each rule, NaN where none is valid and of use.

    `labelled` has a row per distinct labelled text that the base rules keep: stratum, good,
    the features `f` and `proposes`.
    """
    # A stratum has as many rows as there are kinds of texts, a fixed number at most.
    kinds = labelled.groupBy("stratum", "proposes", "good", *levels()).agg(F.count("*").alias("n"))

    def choose(table: pd.DataFrame) -> pd.DataFrame:
        level, n = table[list(RULES)].to_numpy(dtype=int), table["n"].to_numpy(dtype=int)
        good, first = table["good"].to_numpy(dtype=bool), table["proposes"].to_numpy(dtype=bool)
        sequence = proposed(level[first], good[first], n[first])
        holdout = ~first & good
        found = valid_set(sequence, level[holdout], n[holdout], max_false_rejection, error / max(1, strata))
        chosen = {"stratum": table["stratum"].iloc[0]}
        for i, (rule, (_, grid)) in enumerate(RULES.items()):
            chosen[rule] = math.nan if found is None or found[i] == len(grid) else grid[found[i]]
        return pd.DataFrame([chosen], columns=["stratum", *RULES])

    schema = "stratum string, " + ", ".join(f"{rule} double" for rule in RULES)
    return kinds.groupBy("stratum").applyInPandas(choose, schema)


def risk_controlled(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    label: str = "quality",
    max_false_rejection: float = 0.02,
    error: float = 0.05,
) -> DataFrame:
    """One row per document: doc_id, the five features, base_failed, rejected_by (the
    rules whose cutoff it exceeds) and kept.

    Texts labelled 1 are good, those labelled 0 bad.  All labelled documents are used, each
    id once (with the least of its texts, by hash) and each text of a stratum once; an id or
    text with both labels counts as good, other labels are passed over.  Null is a stratum of
    its own.  Documents of a stratum without valid cutoffs are judged by the base rules
    alone, as are all when there are no labels.  Null and empty texts fail the base rules.
    Repeated rows are judged alike; no rows give no rows; other columns are not read.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(stratum).cast("string").alias("stratum"), features(text).alias("f"), *text_key(text)
    )
    rows = staged(rows, "features").withColumn("base_failed", base_failed())
    known = labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("doc_id")).agg((F.max(label) == 1).alias("good"))
    ids = rows.filter("NOT base_failed").join(known, "doc_id").select("doc_id", F.struct(*TEXT_KEY, "stratum", "f", "good").alias("t"))
    once = ids.groupBy("doc_id").agg(F.min_by("t", F.struct(*[f"t.{k}" for k in TEXT_KEY], F.col("t.stratum"))).alias("t")).select("t.*")
    labelled = once.groupBy("stratum", *TEXT_KEY).agg(F.first("f").alias("f"), F.max("good").alias("good"))
    labelled = labelled.withColumn("proposes", F.pmod(F.xxhash64(F.lit(6), *TEXT_KEY), F.lit(PROPOSE)) == 0)
    strata = rows.select("stratum").distinct().count()
    chosen = staged(cutoffs(labelled, max_false_rejection, error, strata), "cutoffs")
    judged = rows.alias("r").join(chosen.alias("c"), F.col("r.stratum").eqNullSafe(F.col("c.stratum")), "left")
    # No valid cutoff is NaN, which no measure exceeds.
    broken = [
        F.when(F.expr(f"({value}) > c.{rule}"), F.lit(rule)) for rule, (value, _) in RULES.items()
    ]
    return judged.select(
        "r.doc_id",
        *[F.col(f"f.{name}").alias(name) for name in FEATURES],
        "base_failed",
        F.array_compact(F.array(*broken)).alias("rejected_by"),
    ).withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))
