"""Language identification by interpolated Kneser-Ney character models.

Every language has a model of 4-grams of letters (runs of anything else are one
space).  Counts come from all texts to learn from, summed over tasks.  A model is a
set of sorted arrays: hashes of n-grams with their probabilities, and hashes of
contexts with their back-off weights.  A text gets the language whose model has the
lowest cross-entropy per character.  One text in 16 is kept out of the counts; on all of
these the scores are calibrated, and for each language the cross-entropy beyond which a
text is rejected as foreign to it.  Tasks sum up what both take: losses on a grid of
sharpnesses, and a histogram of cross-entropies by language.

No n-gram is dropped.  Models of more than about 2^22 4-grams are cut into parts by
the two middle characters of a 4-gram, so that all n-grams of 3 and 4 that a 4-gram's
probability takes are in its part; shorter ones go with every part.  Discounts are
estimated from the counts of all parts.  A task holds one part at a time.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W
from .scratch import staged

ORDER = 4
# 4-grams in a part of the models, about; parts follow the pair modulo a prime.
PART_GRAMS = 1 << 22
PART_PRIME = 1_000_003
# One text in so many is kept out of the counts, for calibration.
CALIBRATION_SHARE = 16
# Sharpnesses to choose from; steps in which bits per character are counted.
SHARPNESSES = 2.0 ** np.arange(0, 8, 0.25)
BIT_STEP = 1 / 256
REJECTED_SHARE = 0.002
# Texts of its own that a language needs for a limit of its own; others share one.
FEWEST = 500
NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
LETTER = regex.compile(r"\p{L}")
# Distinct grams whose scores a task remembers.
REMEMBERED = 1 << 20


def letters(texts: pa.Array) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Runs of rows: rows, all characters as 16-bit values, and each row's bounds.  A text
    is three spaces, its letters, and a space; one without letters has no characters."""
    for rows, buffer, bounds in W.chunks(texts):
        data, cleaned = buffer.tobytes(), []
        for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            text = data[i:j].decode()
            some = NOT_LETTERS.sub(" ", text.lower()).strip() if LETTER.search(text) else ""
            cleaned.append(f"   {some} ".encode("utf-32-le") if some else b"")
        chars = np.frombuffer(b"".join(cleaned), np.uint32)
        ends = np.cumsum([0, *map(len, cleaned)]) // 4
        yield rows, (chars ^ (chars >> np.uint32(16))).astype(np.uint16), ends


def grams(chars: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 4-grams of each text, as 4 x 16 bits, and each text's bounds among them."""
    if len(chars) < ORDER:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    c = chars.astype(np.uint64)
    packed = c[:-3] << np.uint64(48) | c[1:-2] << np.uint64(32) | c[2:-1] << np.uint64(16) | c[3:]
    n = np.maximum(np.diff(bounds) - (ORDER - 1), 0)
    inside = np.zeros(len(chars) + 1, dtype=np.int32)
    some = n > 0
    np.add.at(inside, bounds[:-1][some], 1)
    np.add.at(inside, (bounds[:-1] + n)[some], -1)
    return packed[np.cumsum(inside)[: len(packed)] > 0], np.r_[0, np.cumsum(n)]


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow on (lang, text): (lang, gram, n), summed within a task."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def rows() -> pa.RecordBatch:
        parts = [(lang, *pair) for lang, pair in held.items()]
        names = pa.array([lang for lang, codes, _ in parts for _ in range(len(codes))], pa.string())
        codes = np.concatenate([c for _, c, _ in parts]) if parts else np.zeros(0, np.uint64)
        n = np.concatenate([n for _, _, n in parts]) if parts else np.zeros(0, np.int64)
        held.clear()
        return pa.RecordBatch.from_arrays([names, pa.array(codes.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

    for batch in batches:
        named = batch.column("lang").dictionary_encode()
        names, langs = named.dictionary.to_pylist(), np.asarray(named.indices)
        for at, chars, bounds in letters(batch.column("text")):
            codes, ends = grams(chars, bounds)
            owner = np.repeat(langs[at], np.diff(ends))
            for index in np.unique(langs[at]):
                lang = names[index]
                seen, n = np.unique(codes[owner == index], return_counts=True)
                if lang in held:
                    old, m = held[lang]
                    seen, where = np.unique(np.concatenate([old, seen]), return_inverse=True)
                    n = np.bincount(where, weights=np.concatenate([m, n])).astype(np.int64)
                held[lang] = seen, n
            if sum(len(c) for c, _ in held.values()) > REMEMBERED:
                yield rows()
    yield rows()


class Model(NamedTuple):
    """hashes[n], chances[n]: of the n-grams seen; contexts[n], weights[n]: back-off
    from order n, by the hash of its context; floor: of a character never seen."""

    hashes: dict[int, np.ndarray]
    chances: dict[int, np.ndarray]
    contexts: dict[int, np.ndarray]
    weights: dict[int, np.ndarray]
    floor: float


def tail(codes: np.ndarray, order: int) -> np.ndarray:
    """The last `order` characters of 4-grams."""
    return codes & np.uint64((1 << 16 * order) - 1) if order < ORDER else codes


def hashed(codes: np.ndarray, order: int) -> np.ndarray:
    return W.mix(codes, order)


def lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default) -> np.ndarray:
    """The value at each wanted key, or the default."""
    if not len(keys):
        return np.broadcast_to(np.asarray(default, dtype=float), wanted.shape).copy()
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], default)


def estimate(once: int, twice: int) -> float:
    """Kneser and Ney's estimate from the counts of one and two, kept off its ends."""
    return float(np.clip(once / (once + 2 * twice), 0.1, 0.9)) if once else 0.5


def discount(counts: np.ndarray) -> float:
    return estimate((counts == 1).sum(), (counts == 2).sum())


def train(
    codes: np.ndarray, counts: np.ndarray, pairs: tuple[np.ndarray, np.ndarray] | None = None, known: dict[int, float] | None = None
) -> Model:
    """A language's model from its 4-grams and their counts.  Of a part: with the table of
    order 2 and the discounts of higher orders, both of all parts."""
    hashes, chances, contexts, weights = {}, {}, {}, {}
    # Lower orders count the distinct characters before an n-gram, not its occurrences.
    tables = {ORDER: (codes, counts)}
    for order in range(ORDER - 1, 0, -1):
        whole = pairs if order == 2 else None
        tables[order] = whole or np.unique(tail(tables[order + 1][0], order), return_counts=True)
    floor = 1.0 / (len(tables[1][0]) + 1)
    for order in range(1, ORDER + 1):
        grams_, n = tables[order]
        less = (known or {}).get(order) or discount(n)
        context = grams_ >> np.uint64(16)
        heads, head = np.unique(context, return_inverse=True)
        total = np.bincount(head, weights=n)
        weight = less * np.bincount(head) / total
        shorter = chance(Model(hashes, chances, contexts, weights, floor), tail(grams_, order - 1), order - 1) if order > 1 else floor
        value = (n - less) / total[head] + weight[head] * shorter
        keys = hashed(grams_, order)
        by = np.argsort(keys)
        hashes[order], chances[order] = keys[by], value[by].astype(np.float32)
        keys = hashed(heads, order)
        by = np.argsort(keys)
        contexts[order], weights[order] = keys[by], weight[by].astype(np.float32)
    return Model(hashes, chances, contexts, weights, floor)


def chance(model: Model, codes: np.ndarray, order: int) -> np.ndarray:
    """The probability of each n-gram's last character after the others."""
    value = np.full(len(codes), model.floor)
    for n in range(1, order + 1):
        part = tail(codes, n) if n < ORDER else codes
        backed = lookup(model.contexts[n], model.weights[n], hashed(part >> np.uint64(16), n), 1.0) * value
        value = lookup(model.hashes[n], model.chances[n], hashed(part, n), backed)
    return value


def part_of(codes: np.ndarray, parts: int) -> np.ndarray:
    """The part of the models that has each 4-gram."""
    return (codes >> np.uint64(16) & np.uint64(0xFFFFFFFF)) % np.uint64(PART_PRIME) % np.uint64(parts)


def part_column(parts: int) -> Column:
    """The same of the column `gram`."""
    return F.shiftrightunsigned("gram", 16).bitwiseAND(F.lit(0xFFFFFFFF)) % PART_PRIME % parts


class Scorer:
    """Cross-entropies of texts under several models, of which each part has a share of
    the n-grams; remembers the grams it has met."""

    def __init__(self, parts: list[Broadcast], models: int):
        self.parts, self.models = parts, models
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.bits = np.zeros((0, self.models), np.float32)

    def measure(self, codes: np.ndarray) -> np.ndarray:
        """Bits of each gram's last character under each model."""
        bits, place = np.empty((len(codes), self.models), np.float32), part_of(codes, len(self.parts))
        for i, part in enumerate(self.parts):
            own = np.flatnonzero(place == i)
            if len(own):
                bits[own] = np.column_stack([-np.log2(chance(Model(*m), codes[own], ORDER)) for m in part.value])
                if len(self.parts) > 1:
                    # Else the worker would keep all parts; the next use reads its file again.
                    vars(part).pop("_value", None)
        return bits

    def __call__(self, chars: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Bits per character of each text under each model; NaN for texts without any."""
        codes, ends = grams(chars, bounds)
        out = np.full((len(bounds) - 1, self.models), np.nan)
        if len(codes):
            if len(self.known) > REMEMBERED:
                self.forget()
            met = np.unique(codes)
            at = np.minimum(np.searchsorted(self.known, met), max(0, len(self.known) - 1))
            new = met[self.known[at] != met] if len(self.known) else met
            if len(new):
                known = np.concatenate([self.known, new])
                by = np.argsort(known)
                self.known, self.bits = known[by], np.concatenate([self.bits, self.measure(new)])[by]
            at = np.searchsorted(self.known, codes)
            some = np.flatnonzero(np.diff(ends))
            total = np.add.reduceat(self.bits[at], ends[some], axis=0, dtype=np.float64)
            out[some] = total / np.diff(ends)[some, None]
        return out


class Identifier(NamedTuple):
    """langs, the parts of their models, the sharpness of scores, and each language's limit."""

    langs: list[str]
    parts: list[Broadcast]
    sharpness: float
    limits: list[float]


def entropies(texts: pa.Array, scorer: Scorer) -> np.ndarray:
    parts = [scorer(chars, bounds) for _, chars, bounds in letters(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, scorer.models))


def confidence(bits: np.ndarray, sharpness: float) -> np.ndarray:
    """The share of the best language: a softmax of the cross-entropies."""
    return 1 / np.exp2(-sharpness * (bits - bits.min(axis=1, keepdims=True))).sum(axis=1)


def shared_models(spark: SparkSession, counts: DataFrame, part_grams: int = PART_GRAMS) -> tuple[list[str], list[Broadcast]]:
    """The languages of (lang, gram, n), and their models in parts of about `part_grams`
    4-grams; the driver holds one part, and the 2-grams, at a time."""

    def figures(table: DataFrame) -> dict[str, tuple[int, float]]:
        """Each language's n-grams, and their discount."""
        flags = [F.count_if(F.col("n") == k).alias(f"n{k}") for k in (1, 2)]
        found = table.groupBy("lang").agg(F.count("*").alias("size"), *flags).collect()
        return {r["lang"]: (r["size"], estimate(r["n1"], r["n2"])) for r in found}

    def shorter(table: DataFrame, order: int) -> DataFrame:
        gram = F.col("gram").bitwiseAND(F.lit((1 << 16 * order) - 1)).alias("gram")
        return table.groupBy("lang", gram).agg(F.count("*").alias("n"))

    def by_language(table: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        found = table.select("lang", "gram", "n").toPandas()
        tables = {}
        for name, own in found.groupby("lang"):
            codes = own["gram"].to_numpy().view(np.uint64)
            by = np.argsort(codes)
            tables[name] = codes[by], own["n"].to_numpy()[by]
        return tables

    threes = staged(shorter(counts, 3), "threes")
    known = {ORDER: figures(counts), 3: figures(threes)}
    langs, pairs = sorted(known[ORDER]), by_language(shorter(threes, 2))
    parts, none = -(-sum(size for size, _ in known[ORDER].values()) // part_grams), (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    shared = []
    for i in range(parts):
        own = by_language(counts.filter(part_column(parts) == i))
        less = {name: {order: known[order][name][1] for order in known} for name in langs}
        models = [tuple(train(*own.get(name, none), pairs[name], less[name])) for name in langs]
        shared.append(spark.sparkContext.broadcast(models))
    return langs, shared


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", part_grams: int = PART_GRAMS) -> Identifier:
    """An identifier from the texts of `docs`; rows with a null language are passed over, as
    are texts without a letter.  The counts cover all texts but one in 16 (by a hash of the
    text, so copies go together); all of these calibrate it.  Repeated rows count each.
    Ids are not read."""
    rows = docs.select(F.col(lang).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text")).filter("lang IS NOT NULL")
    kept_out = F.pmod(F.xxhash64("text"), F.lit(CALIBRATION_SHARE)) == 0
    counted = rows.filter(~kept_out).mapInArrow(count_grams, "lang string, gram long, n long")
    counts = staged(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    langs, parts = shared_models(docs.sparkSession, counts, part_grams)
    if not langs:
        return Identifier([], [], 1.0, [])
    summed = rows.filter(kept_out).mapInArrow(calibration_sums(langs, parts), "lang string, step long, n double")
    # A row per sharpness, and per language and step of the bits that characters take.
    found = staged(summed.groupBy("lang", "step").agg(F.sum("n").alias("n")), "calibration").toPandas()
    return calibrated(langs, parts, found)


def calibration_sums(langs: list[str], parts: list[Broadcast]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow on (lang, text): the number of a language's texts by the bits per
    character that its own model gives them, in steps; and with a null language, for each
    sharpness, the sum of the losses of all texts."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, index = Scorer(parts, len(langs)), {name: i for i, name in enumerate(langs)}
        losses, seen = np.zeros(len(SHARPNESSES)), Counter()
        for batch in batches:
            bits = entropies(batch.column("text"), scorer)
            truth = np.array([index.get(x, -1) for x in batch.column("lang").to_pylist()], dtype=int)
            usable = (truth >= 0) & ~np.isnan(bits).any(axis=1)
            bits, truth = bits[usable], truth[usable]
            own = bits[np.arange(len(bits)), truth]
            losses += [(s * (own - bits.min(axis=1, initial=np.inf)) - np.log2(confidence(bits, s))).sum() if len(own) else 0 for s in SHARPNESSES]
            seen.update(zip(truth.tolist(), np.floor(own / BIT_STEP).astype(int).tolist()))
        rows = [(None, i, loss) for i, loss in enumerate(losses.tolist())] + [(langs[t], step, float(n)) for (t, step), n in seen.items()]
        columns = [pa.array(list(c), kind) for c, kind in zip(zip(*rows), (pa.string(), pa.int64(), pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "step", "n"])

    return sums


def limit(own: pd.DataFrame) -> float:
    """Half a bit beyond what all but the worst `REJECTED_SHARE` of texts take; `own` counts
    them by steps."""
    counts = own.groupby("step")["n"].sum().sort_index()
    at = int(np.searchsorted(counts.cumsum().to_numpy(), (1 - REJECTED_SHARE) * counts.sum()))
    return float((counts.index[min(at, len(counts) - 1)] + 1) * BIT_STEP) + 0.5


def calibrated(langs: list[str], parts: list[Broadcast], found: pd.DataFrame) -> Identifier:
    """The identifier by the sums of `calibration_sums`.  A language with too few texts has
    the limit of all together, or the widest of any with its own if that is wider."""
    counts = found[found["lang"].notna()]
    if not len(counts):
        return Identifier(langs, parts, 8.0, [float("inf")] * len(langs))
    losses = found[found["lang"].isna()].sort_values("step")["n"].to_numpy()
    own = {name: rows for name, rows in counts.groupby("lang")}
    known = {name: limit(rows) for name, rows in own.items() if rows["n"].sum() >= FEWEST}
    common = max([limit(counts), *known.values()])
    return Identifier(langs, parts, float(SHARPNESSES[losses.argmin()]), [known.get(name, common) for name in langs])


def identify(spark: SparkSession, identifier: Identifier, text: str | Column = "text") -> Column:
    """A struct of lang (`und` if the text is null or has no letter, or nothing was
    learned), score (0 to 1; 0 with `und`), bits (per character; null with `und`) and
    rejected (bits above the language's limit: likely another language)."""
    langs, parts, sharpness, limits = identifier

    def guess(texts: pa.Array, scorer: Scorer) -> pa.Array:
        n = len(texts)
        lang, score, best, rejected = np.full(n, "und", dtype=object), np.zeros(n), np.full(n, np.nan), np.zeros(n, dtype=bool)
        if langs:
            bits = entropies(texts, scorer)
            some = np.flatnonzero(~np.isnan(bits).any(axis=1)) if n else []
            if len(some):
                which = bits[some].argmin(axis=1)
                lang[some] = np.array(langs, dtype=object)[which]
                score[some] = confidence(bits[some], sharpness)
                best[some] = bits[some].min(axis=1)
                rejected[some] = best[some] > np.array(limits)[which]
        return pa.StructArray.from_arrays(
            [pa.array(lang, pa.string()), pa.array(score), pa.array(best, mask=np.isnan(best)), pa.array(rejected)],
            names=["lang", "score", "bits", "rejected"],
        )

    def guesses(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # What a task has met it remembers over all its batches.
        scorer = Scorer(parts, len(langs))
        for texts in batches:
            yield guess(texts, scorer)

    return F.arrow_udf(guesses, "lang string, score double, bits double, rejected boolean")(text)
