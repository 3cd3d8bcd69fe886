"""Classifiers on made-up tasks: held-out accuracy, odd rows, empty tables."""

import random
import zlib

import numpy as np
import pyarrow as pa

from orderloom.llm import language_id as L
from orderloom.llm import quality_classifier as C
from orderloom.llm import samples
from orderloom.llm import toxicity as X

from .corpus import empty, frame, odd_corpus

LABELS = "doc_id long, quality int, toxic int"


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def made_up(seed, n, bad, length=40):
    """Rows and labels: every third document has a few of the bad words."""
    rng = random.Random(seed)
    syllables = "ka lo mi ne pu ra so ti vu we".split()
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(5, length))]
        mark = i % 3 == 0
        if mark:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), bad(rng))
        rows.append((i, " ".join(words), "en" if i % 2 else "de", "s", 0, 0.0))
        labels.append((i, int(not mark), int(mark)))
    return rows, labels


def test_folds(spark):
    got = spark.range(50).select(samples.fold("id", 3).alias("f")).collect()
    assert [r["f"] for r in got] == [fold(i, 3) for i in range(50)]


def test_toxicity_finds_held_out_texts(spark):
    rows, labels = made_up(1, 900, lambda rng: rng.choice(["scumbag", "scumlike", "scums", "vile"]))
    rows += [(5000 + i, r[1], r[2], None, 0, 0.0) for i, r in enumerate(odd_corpus(seed=2, n=10))]
    known = spark.createDataFrame(labels + [(None, 1, 1), (1, None, None)], LABELS)
    docs = frame(spark, rows)
    got = {r["doc_id"]: r for r in X.scored(docs, known).collect()}
    out = [i for i in range(900) if fold(i, 3) == 1]
    right = sum(got[i]["predicted"] == (i % 3 == 0) for i in out)
    assert right >= 0.97 * len(out)
    assert all(0 <= r["score"] <= 1 for r in got.values()) and len(got) == len(rows)
    kept = X.clean_documents(docs, known)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if not r["rejected"]}


def test_thresholds_follow_all_labelled_texts(spark, monkeypatch):
    rows, labels = made_up(6, 900, lambda rng: "vile")
    rows = [(i, t, "xx" if i % 10 < 2 else "en", *rest) for i, t, _, *rest in rows]
    rows[0] = (0, "vile " + "ka " * 5000, *rows[0][2:])
    cases, given = [], X.set_threshold
    monkeypatch.setattr(X, "PER_CLASS", 60)
    monkeypatch.setattr(X, "set_threshold", lambda *a: cases.append((a[1], a[2])) or given(*a))
    judge = X.learn(frame(spark, rows), spark.createDataFrame(labels, LABELS))
    inside = [i for i in range(900) if fold(i, 3) != 1]
    assert 0 in inside and sorted(judge.thresholds) == ["en", "xx"]
    for c in (0, 1):
        n = [cases_[truth == c].sum() for truth, cases_ in cases]
        labelled = sum((i % 3 == 0) == c for i in inside)
        # About 60 ids of a class are sampled, and four fifths of them fitted.
        assert labelled - 80 < n[0] < labelled - 20 and n[0] == n[1] + n[2]
        assert min(n) >= X.FEWEST


def test_long_texts_are_calibrated_on(spark):
    texts = ["vile " + "ka " * (X.SAMPLE_WORDS + 10), "ka lo", "mi ne"]
    docs = spark.createDataFrame([(i, "en", t) for i, t in enumerate(texts)], "doc_id long, lang string, text string")
    known = spark.createDataFrame([(0, 1), (1, 0), (2, 0), (9, 1)], "doc_id long, label int")
    fitted = spark.createDataFrame([(2,)], "doc_id long")
    raw = X.raw_logit(spark, X.fresh(np.random.default_rng(0))).alias("raw")
    got = X.logit_counts(docs.select("doc_id", "lang", raw), known, fitted)
    assert got["n1"].sum() == 1 and got["n0"].sum() == 1


def test_toxicity_scores_texts_alone(spark):
    rows, labels = made_up(2, 300, lambda rng: "vile")
    known = spark.createDataFrame(labels, LABELS)
    judge = X.learn(frame(spark, rows), known)
    texts = [r[1] for r in rows[:20]] + ["", None, "vile", "ka"]
    one = spark.createDataFrame([(t,) for t in texts], "text string").repartition(1)
    many = spark.createDataFrame([(t,) for t in texts * 2], "text string").repartition(5)
    a = {r[0]: r[1] for r in one.select("text", X.toxicity(spark, judge)).collect()}
    b = {r[0]: r[1] for r in many.select("text", X.toxicity(spark, judge)).collect()}
    assert all(abs(a[t] - b[t]) < 1e-5 for t in texts) and a[""] == a[None]


def plain_logit(net, ids):
    """One text's logit by loops: every filter at every place, its largest response, if that
    is above zero, weighed.  Places before and behind the text are padding."""
    gap = max(X.WIDTHS)
    pad = [[X.PAD] * ids.shape[1]]
    words = np.concatenate([pad, ids, pad * (gap + 1)]).astype(int)
    vectors = net.embed[words].sum(axis=1, dtype=np.float64)
    pooled = []
    for w in X.WIDTHS:
        for f in range(X.FILTERS):
            places = range(len(ids) + 1) if len(ids) else range(1)
            responses = [sum(vectors[p + j] @ net.filters[w][j][:, f] for j in range(w)) + net.offsets[w][f] for p in places]
            pooled.append(max(0.0, max(responses)))
    return float(np.dot(pooled, net.out) + net.bias)


def test_convolution_matches_plain_loops():
    rng = np.random.default_rng(2)
    net = X.fresh(rng)._replace(offsets={w: rng.normal(0, 0.1, X.FILTERS).astype(np.float32) for w in X.WIDTHS}, bias=0.3)
    texts = ["a b c d e f", "one", "two words", "", "the same the same the same"]
    (_, ids, first), = X.word_ids(pa.array(texts))
    got = X.logits(net, ids, first)
    want = [plain_logit(net, ids[a:b]) for a, b in zip(first[:-1], first[1:])]
    assert np.allclose(got, want, atol=1e-4)


def test_fitting_lowers_the_loss_as_gradients_say():
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["ka", "lo", "mi", "vile"] if i % 2 else ["ka", "lo", "mi"], 12)) for i in range(40)]
    (_, ids, first), = X.word_ids(pa.array(texts))
    own, truth = [ids[a:b] for a, b in zip(first[:-1], first[1:])], np.array([int("vile" in t) for t in texts])

    def loss(net):
        p = samples.sigmoid(X.logits(net, ids, first))
        return -np.mean(np.log(np.where(truth == 1, p, 1 - p)))

    losses = [loss(X.fit(own, truth, epochs=n)) for n in (1, 4, 12)]
    assert losses[0] > losses[1] > losses[2] and losses[2] < 0.3


def test_thresholds_are_where_f_is_best():
    rng = np.random.default_rng(5)
    raw, truth = rng.normal(0, 1, 300), (rng.random(300) < 0.3).astype(int)
    raw[truth == 1] += 1.5
    weight = cases = np.ones(300)
    at = X.set_threshold(raw, truth, cases, weight, 9.0)

    def f(t):
        hit = raw >= t
        return (1 + X.BETA**2) * (hit & (truth == 1)).sum() / (hit.sum() + X.BETA**2 * truth.sum())

    assert f(at) >= max(f(t) for t in raw) - 1e-9
    assert X.set_threshold(raw[:30], truth[:30], cases[:30], weight[:30], 9.0) == 9.0


def test_convolution_spans_no_two_texts():
    net = X.fresh(np.random.default_rng(0))
    texts = ["a b c d", "", "e", "f g"]
    (_, ids, first), = X.word_ids(pa.array(texts))
    together = X.logits(net, ids, first)
    alone = []
    for t in texts:
        (_, ids, first), = X.word_ids(pa.array([t]))
        alone.append(X.logits(net, ids, first)[0])
    assert np.allclose(together, alone, atol=1e-5)


def test_classifiers_without_labels_or_rows(spark):
    none = spark.createDataFrame([], LABELS)
    rows = odd_corpus(seed=3, n=8)
    one_class = spark.createDataFrame([(i, 1, 0) for i in range(8)], LABELS)
    for known in (none, one_class):
        for scored in (X.scored, C.scored):
            got = scored(frame(spark, rows), known).collect()
            assert len(got) == len(rows) and len({r["score"] for r in got}) == 1
    some = spark.createDataFrame([(i, i % 2, i % 2) for i in range(8)], LABELS)
    assert X.scored(empty(spark), some).collect() == [] and C.scored(empty(spark), some).collect() == []


def test_quality_finds_held_out_texts(spark):
    rows, labels = made_up(4, 900, lambda rng: "zz!! ### " * 3)
    rows += [(5000 + i, r[1], r[2], None, 0, 0.0) for i, r in enumerate(odd_corpus(seed=2, n=10))]
    got = {r["doc_id"]: r for r in C.scored(frame(spark, rows), spark.createDataFrame(labels, LABELS)).collect()}
    out = [i for i in range(900) if fold(i, 4) == 2]
    right = sum(got[i]["predicted"] == (i % 3 != 0) for i in out)
    assert right >= 0.97 * len(out)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_contexts_match_brute_force():
    texts = ["a b! c", "", "B a a", None]
    (_, buffer, bounds), = W_chunks(texts)
    rows, hashes, first = C.tokens(buffer, bounds)
    assert np.diff(first).tolist() == [4, 0, 3, 0]
    table = np.zeros(C.ROWS * C.SIZE)
    C.add_contexts(table, rows, hashes, first)
    want = np.zeros_like(table).reshape(C.ROWS, C.SIZE)
    index = np.zeros((len(rows), C.SIZE))
    for place, sign in C.index_vectors(hashes):
        index[np.arange(len(rows)), place] += sign
    for a, b in zip(first[:-1], first[1:]):
        for i in range(a, b):
            for j in range(max(a, i - 2), min(b, i + 3)):
                if i != j:
                    want[rows[i]] += index[j]
    assert np.array_equal(table.reshape(C.ROWS, C.SIZE), want)


def test_sums_up_a_deep_tree(spark, monkeypatch):
    docs = spark.createDataFrame([(t,) for _, t, *_ in odd_corpus(seed=12)], "text string").repartition(23)
    monkeypatch.setattr(C, "FAN_IN", 3)
    deep = C.word_vectors(docs)
    assert np.array_equal(deep, C.word_vectors(docs.coalesce(1)))
    monkeypatch.setattr(C, "LEVELS", 1)
    assert np.array_equal(deep, C.word_vectors(docs))


def plain_features(vectors, text):
    """One document's features, token by token."""
    (_, buffer, bounds), = W_chunks([text])
    rows, hashes, _ = C.tokens(buffer, bounds)
    n = len(rows)
    if not n:
        return np.zeros(C.features())
    index = np.zeros((n, C.SIZE))
    for place, sign in C.index_vectors(hashes):
        for i in range(n):
            index[i, place[i]] += sign[i]
    mean = sum(vectors[r].astype(float) for r in rows) / n
    alike = sum(float(vectors[a] @ vectors[b]) for a, b in zip(rows[1:], rows[:-1])) / n
    again = sum(a == b for a, b in zip(hashes[1:], hashes[:-1])) / n
    kinds = np.searchsorted(np.cumsum(C.REGIONS), rows, side="right")
    shares = [float(np.mean(kinds == k)) for k in range(len(C.REGIONS))]
    return np.array([*mean, np.linalg.norm(mean), np.linalg.norm(index.mean(axis=0)), alike, again, *shares, np.log(n)])


def test_features_match_plain_loops():
    texts = ["a b! c", "", "LOUD words LOUD words ###", None, "same same same", "!!"]
    vectors = C.unit(np.random.default_rng(6).normal(size=(C.ROWS, C.SIZE))).astype(np.float32)
    got = C.pooled(vectors, pa.array(texts, pa.string()))
    assert np.allclose(got, [plain_features(vectors, t) for t in texts], atol=1e-5)


def test_the_networks_gradient():
    rng = np.random.default_rng(7)
    x, truth = rng.normal(size=(200, 5)), rng.integers(0, 2, 200)
    x[:, 0] += 2 * truth
    net = C.fit(x, truth, epochs=30)
    p = samples.sigmoid(C.logits(net, x))
    assert np.mean((p > 0.5) == truth) > 0.8

    def loss(w):
        p = samples.sigmoid(C.logits(net._replace(w2=w), x))
        weight = np.where(truth == 1, 0.5 / truth.mean(), 0.5 / (1 - truth.mean()))
        return -np.mean(weight * np.log(np.where(truth == 1, p, 1 - p))) + 0.5e-4 * (w**2).sum()

    # Near a minimum of the loss whose gradient the steps follow.
    base = loss(net.w2)
    for _ in range(10):
        step = rng.normal(size=net.w2.shape)
        assert loss(net.w2 + 0.5 * step) > base - 1e-3


def W_chunks(texts):
    from orderloom.llm import words

    return words.chunks(pa.array(texts, pa.string()))


def languages(seed, n):
    rng = random.Random(seed)
    parts = {"aa": "ka lo mi ne pu", "bb": "str ung ich acht ein", "ñç": "éa oí ñu ão él"}
    rows = []
    for i in range(n):
        lang = list(parts)[i % 3]
        text = " ".join("".join(rng.choice(parts[lang].split()) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(3, 30)))
        rows.append((i, text.title(), lang, "s", 0, 0.0))
    return rows


def test_languages_of_held_out_texts(spark):
    rows = languages(1, 600)
    odd = [(9000, None), (9001, ""), (9002, "12 34 !!"), (9003, "²½ ₁"), (9004, "K"), (9005, "日本")]
    docs = frame(spark, rows + [(i, t, None, "s", 0, 0.0) for i, t in odd])
    identifier = L.learn(docs.filter(samples.fold("doc_id", 4) != 2))
    assert identifier.langs == ["aa", "bb", "ñç"]
    got = {r["doc_id"]: r["g"] for r in docs.select("doc_id", L.identify(spark, identifier).alias("g")).collect()}
    out = [r for r in rows if fold(r[0], 4) == 2]
    assert sum(got[r[0]]["lang"] == r[2] for r in out) >= 0.98 * len(out)
    assert all(got[i]["lang"] == "und" and got[i]["score"] == 0 for i in (9000, 9001, 9002, 9003))
    assert all(got[i]["lang"] in identifier.langs and 0 <= got[i]["score"] <= 1 for i in (9004, 9005))
    assert got[9005]["rejected"] and sum(got[r[0]]["rejected"] for r in out) < 0.1 * len(out)


def test_kneser_ney_is_a_distribution():
    text = "   the cat sat on the mat and the rat ate "
    chars = np.array([ord(c) for c in text], dtype=np.uint16)
    codes, _ = L.grams(chars, np.array([0, len(chars)]))
    seen, counts = np.unique(codes, return_counts=True)
    model = L.train(seen, counts)
    letters = sorted(set(text[3:]))
    for context in ("the", "cat", " xq", "   "):
        followers = np.array([sum(ord(c) << 16 * (3 - i) for i, c in enumerate(context + w)) for w in letters], dtype=np.uint64)
        total = L.chance(model, followers, 4).sum()
        assert 0.9 < total <= 1 + 1e-6  # the rest is for characters never seen
    for order in model.hashes:
        assert (np.diff(model.hashes[order].astype(object)) > 0).all()


def kneser_ney(text_counts, discounts):
    """Probabilities by dictionaries, straight from the definition: orders 1 to 4 of
    interpolated models, lower orders counting the characters before an n-gram."""
    tables = {4: dict(text_counts)}
    for order in (3, 2, 1):
        before = {}
        for gram in tables[order + 1]:
            before[gram[1:]] = before.get(gram[1:], 0) + 1
        tables[order] = before
    floor = 1 / (len(tables[1]) + 1)

    def probability(gram):
        value = floor
        for order in range(1, 5):
            own = gram[4 - order :]
            context = {g: n for g, n in tables[order].items() if g[:-1] == own[:-1]}
            if context:
                total, less = sum(context.values()), discounts[order]
                weight = less * len(context) / total
                value = max(context.get(own, 0) - less, 0) / total + weight * value
        return value

    return probability


def test_models_match_a_dictionary_kneser_ney():
    rng = random.Random(9)
    text = "   " + "".join(rng.choice("aab c") for _ in range(300)) + " "
    counts = {}
    for i in range(len(text) - 3):
        counts[text[i : i + 4]] = counts.get(text[i : i + 4], 0) + 1
    chars = np.array([ord(c) for c in text], dtype=np.uint16)
    seen, n = np.unique(L.grams(chars, np.array([0, len(chars)]))[0], return_counts=True)
    model = L.train(seen, n)
    tables = {4: n}
    codes = seen
    for order in (3, 2, 1):
        codes, tables[order] = np.unique(L.tail(codes, order), return_counts=True)
    want = kneser_ney(counts, {order: L.discount(t) for order, t in tables.items()})
    probes = ["".join(rng.choice("abc xz") for _ in range(4)) for _ in range(200)] + list(counts)
    packed = np.array([sum(ord(c) << 16 * (3 - i) for i, c in enumerate(p)) for p in probes], dtype=np.uint64)
    assert np.allclose(L.chance(model, packed, 4), [want(p) for p in probes], rtol=1e-5)


def test_all_kept_out_texts_calibrate_by_language(spark, monkeypatch):
    monkeypatch.setattr(L, "FEWEST", 5)
    rows = languages(4, 900)
    docs = frame(spark, rows + [(7000 + i, t, "rare", "s", 0, 0.0) for i, t in enumerate(["ka lo", "12"])])
    sums, found = [], L.calibrated
    monkeypatch.setattr(L, "calibrated", lambda *a: sums.append(a) or found(*a))
    identifier = L.learn(docs)
    (langs, parts, table), = sums
    kept = {r["text"]: r["lang"] for r in docs.filter("pmod(xxhash64(text), 16) = 0 AND lang IS NOT NULL").collect()}
    counted = table[table["lang"].notna()]
    assert counted["n"].sum() == sum(L.LETTER.search(t) is not None for t in kept) > 30
    # The same from every text's bits.
    bits = L.entropies(pa.array(list(kept)), L.Scorer(parts, len(langs)))
    usable = ~np.isnan(bits).any(axis=1)
    bits, truth = bits[usable], np.array([langs.index(x) for x in kept.values()])[usable]
    own = bits[np.arange(len(bits)), truth]
    losses = [np.mean(s * (own - bits.min(axis=1)) - np.log2(L.confidence(bits, s))) for s in L.SHARPNESSES]
    assert identifier.sharpness == L.SHARPNESSES[int(np.argmin(losses))]
    for i, name in enumerate(langs):
        mine = np.sort(own[truth == i])
        if len(mine) >= 5:
            assert mine[-1] + 0.5 <= identifier.limits[i] <= mine[-1] + 0.5 + L.BIT_STEP
    assert np.isfinite(identifier.limits).all()


def test_language_id_of_odd_rows(spark):
    rows = languages(5, 300)
    odd = [(None, t, lang, "s", 0, 0.0) for _, t, lang, *_ in rows[:3]] + rows[:5] + [(800, "ka lo " * 60_000, "aa", "s", 0, 0.0)]
    docs = frame(spark, rows + odd + [(801, None, "aa", None, 0, 0.0), (802, "x", None, None, 0, 0.0)])
    identifier = L.learn(docs)
    got = docs.select("doc_id", "text", L.identify(spark, identifier).alias("g")).collect()
    assert len(got) == len(rows) + len(odd) + 2
    by_text = {}
    for r in got:
        by_text.setdefault(r["text"], set()).add(tuple(r["g"]))
    assert all(len(x) == 1 for x in by_text.values())
    assert next(iter(by_text["ka lo " * 60_000]))[0] == "aa" and next(iter(by_text[None]))[0] == "und"


def test_no_gram_is_dropped_in_any_number_of_parts(spark):
    seen = {"aa": {}, "bb": {}}
    rng = random.Random(7)
    for lang, letters in (("aa", "abcdefg "), ("bb", "efghijkl ")):
        for _ in range(800):
            gram = sum(ord(rng.choice(letters)) << 16 * i for i in range(4))
            seen[lang][gram] = seen[lang].get(gram, 0) + rng.choice([1, 1, 2, 5, 100_000])
    counts = spark.createDataFrame([(lang, g, n) for lang, own in seen.items() for g, n in own.items()], "lang string, gram long, n long")
    wanted = np.array(sorted({g for own in seen.values() for g in own} | {ord("z")}), dtype=np.uint64)
    want = []
    for own in seen.values():
        codes = np.array(sorted(own), dtype=np.uint64)
        n = np.array([own[int(c)] for c in codes])
        model = L.train(codes, n)
        assert len(model.hashes[4]) == len(own) and L.discount(n) != 0.5
        want.append(-np.log2(L.chance(model, wanted, 4)))
    for size, parts in ((1 << 22, 1), (200, None)):
        langs, shared = L.shared_models(spark, counts, size)
        assert langs == ["aa", "bb"] and (len(shared) == parts if parts else len(shared) > 4)
        grams = [sum(len(m[0][4]) for m in part) for part in (b.value for b in shared)]
        assert sum(grams) == sum(map(len, seen.values()))
        assert np.allclose(L.Scorer(shared, 2).measure(wanted), np.column_stack(want), atol=1e-4)


def test_models_in_parts_name_the_same_languages(spark):
    docs = frame(spark, languages(3, 300))
    whole, cut = L.learn(docs), L.learn(docs, part_grams=50)
    assert len(whole.parts) == 1 < len(cut.parts) and np.allclose(whole.limits, cut.limits, atol=1e-4)
    pairs = docs.select(L.identify(spark, whole).alias("a"), L.identify(spark, cut).alias("b")).collect()
    assert all(r["a"]["lang"] == r["b"]["lang"] and abs(r["a"]["bits"] - r["b"]["bits"]) < 1e-4 for r in pairs)


def test_language_id_without_rows(spark):
    identifier = L.learn(empty(spark))
    rows = languages(2, 6)
    got = frame(spark, rows).select(L.identify(spark, identifier).alias("g")).collect()
    assert {r["g"]["lang"] for r in got} == {"und"}
    full = L.learn(frame(spark, rows))
    assert empty(spark).select(L.identify(spark, full).alias("g")).collect() == []
