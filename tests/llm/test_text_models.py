"""Toxicity, language model, repeated substrings and captures."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posloom.llm import language_model, substring, toxicity, warc
from posloom.llm.common import Scratch
from posloom.session import BROADCAST_LIMIT_KEY
from corpus_texts import prose


# --- toxicity ---------------------------------------------------------------

def test_folding():
    assert toxicity.folded("Іd10t ＩＤＩＯＴ st­upid") == "idiot idiot stupid"
    assert toxicity.folded("M0R0N! in 2024, 100% of 3 days") == "moron! in 2024, 100% of 3 days"
    assert toxicity.folded("") == ""


def test_matcher_counts_whole_words_and_beginnings():
    matcher = toxicity.Matcher({"trash": 2.0, "stem*": 3.0, "stemming": 5.0}, exceptions=("trash can",))
    assert matcher.hits("Trash trashy tr4sh") == (3, 2, 4.0)
    assert matcher.hits("the trash can, trash") == (4, 1, 2.0)
    assert matcher.hits("stem stems stemming") == (3, 2, 8.0)  # a beginning needs a longer word; the larger weight counts
    assert matcher.hits(None) == (0, 0, 0.0)


@pytest.fixture(scope="module")
def labelled_texts(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for n in range(1200):
        words = prose(1000 + n, rng.randint(3, 120)).split()
        toxic = n % 6 == 0
        if toxic:
            for _ in range(max(1, len(words) // 25)):
                words.insert(rng.randrange(len(words)), rng.choice(["nastyword", "vileword", "grimwordly", "grimwordish"]))
        rows.append((n, " ".join(words)))
        if n % 2 == 0 or n % 3 == 0:
            labels.append((n, int(toxic)))
    # Copies of one toxic text must not turn its words into terms.
    rows += [(5000 + k, "copied " + prose(77, 80) + " vileword") for k in range(60)]
    labels += [(5000 + k, 1) for k in range(60)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_lexicon_is_learned_and_holds_out(spark, labelled_texts):
    docs, labels = labelled_texts
    model = toxicity.train(docs, labels)
    words = ["nastyword", "vileword", "grimwordly", "grimwordish"]
    assert all(any(t == w or (t[-1] == "*" and w.startswith(t[:-1])) for t in model.lexicon) for w in words)
    assert not set(prose(77, 80).split()) & set(model.lexicon)
    scored = toxicity.scored(docs, model).collect()
    right = sum((r["toxicity"] >= toxicity.THRESHOLD) == (r["doc_id"] % 6 == 0) for r in scored if r["doc_id"] < 5000)
    assert right > 0.97 * 1200
    assert all(0 <= r["toxicity"] <= 1 for r in scored)


def _lexicon(spark, rows):
    docs = spark.createDataFrame([(n, t) for n, (t, _) in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(n, y) for n, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    return {r["term"]: r["weight"] for r in toxicity.learn_lexicon(toxicity.labelled(docs, labels)).collect()}


def _weight(lexicon, word):
    return toxicity.Matcher(lexicon).hits(word)[2]


def _uses(term, count, befores, seed):
    """Different texts that use a term after one of ``befores`` words."""
    rng = random.Random(seed)
    return [f"{prose(rng.random(), 20)} before{rng.choice('abcdefghijklmnopqrst')}{'x' * rng.randrange(befores // 20)} {term}" for _ in range(count)]


def test_verdict_on_a_term_does_not_depend_on_input_size(spark):
    weights = []
    for times in (1, 12):
        toxic, clean = _uses("rudeword", 200 * times, 40, 1), _uses("rudeword", 12 * times, 40, 2)
        other = [prose(10_000 + n, 22) for n in range(600 * times)]
        lexicon = _lexicon(spark, [(t, 1) for t in toxic] + [(t, 0) for t in [*clean, *other]])
        weights.append(_weight(lexicon, "rudeword"))
    assert abs(weights[0] - weights[1]) < 0.4


def test_copies_count_once_under_either_label(spark):
    rows = [(t, 1) for t in _uses("rudeword", 150, 40, 3)] + [(prose(20_000 + n, 22), 0) for n in range(600)]
    quote = "someone wrote: R-u-d-e? No, RUDEWORD was the word."
    once = _lexicon(spark, [*rows, (quote, 0)])
    # The copies differ in case and signs only; none is a copy of a toxic row.
    copies = [(quote.lower() if n % 2 else quote.replace("?", "!"), 0) for n in range(400)]
    many = _lexicon(spark, [*rows, *copies])
    assert _weight(once, "rudeword") and abs(_weight(once, "rudeword") - _weight(many, "rudeword")) < 0.1


def test_no_term_that_passes_is_lost(spark):
    """Eight thousand toxic words, none the beginning of another: all are terms, or have one that weighs as much."""
    rng = random.Random(11)
    bad = ["".join(rng.choices("abcdefghijklmnop", k=9)) for _ in range(8000)]
    rows, before = [], defaultdict(set)
    for turn in range(8):
        rng.shuffle(bad)
        for at in range(0, len(bad), 20):
            words = []
            for k, word in enumerate(bad[at : at + 20]):
                context = "context" + "qrstuvwx"[turn] + "qrstuvwx"[k % 8]
                if zlib.crc32(str(len(rows)).encode()) % 4 != 2:  # not held out
                    before[word].add(zlib.crc32(context.encode()) & 63)
                words += [context, word]
            rows.append((" ".join(words), 1))
    rows += [(prose(40_000 + n, 400), 0) for n in range(2000)]
    lexicon = _lexicon(spark, rows)
    assert len(lexicon) > 5000
    matcher = toxicity.Matcher(lexicon)
    passing = [w for w in bad if len(before[w]) >= toxicity.MIN_CONTEXTS]
    assert len(passing) > 5000 and all(matcher.hits(w)[2] > 0 for w in passing)


def test_implied_terms_change_no_weight(spark):
    rng = random.Random(3)
    terms = {}
    for _ in range(400):
        word = "".join(rng.choices("ab", k=rng.randint(3, 12)))
        terms[word if rng.random() < 0.5 or len(word) not in toxicity.PREFIXES else word + "*"] = rng.choice([1.0, 2.0, 3.0])
    kept = toxicity.without_implied(spark.createDataFrame(list(terms.items()), "term string, weight double"))
    few = {r["term"]: r["weight"] for r in kept.collect()}
    assert len(few) < len(terms) and few.items() <= terms.items()
    words = ["".join(rng.choices("ab", k=rng.randint(1, 14))) for _ in range(2000)]
    for word in words:
        assert toxicity.Matcher(few).hits(word) == toxicity.Matcher(terms).hits(word)


def test_a_large_lexicon_is_joined_with_the_same_result(spark, edge, nothing, labels, labelled_texts):
    docs, known = labelled_texts
    sent = toxicity.train(docs, known)
    spark.conf.set(BROADCAST_LIMIT_KEY, "1")
    try:
        joined = toxicity.train(docs, known)
        assert isinstance(joined.lexicon, DataFrame) and isinstance(sent.lexicon, dict)
        assert np.allclose(joined.curve, sent.curve)
        for table in (docs.union(spark.createDataFrame([(9000, "a trash can vileword TRASH CAN"), (9001, None)], docs.schema)), edge, nothing):
            pairs = [sorted((str(r["doc_id"]), round(r["toxicity"], 9)) for r in toxicity.scored(table, m).collect()) for m in (sent, joined)]
            assert pairs[0] == pairs[1]
        assert sorted(map(str, toxicity.drop_toxic(edge, labels).columns)) == sorted(edge.columns)
    finally:
        spark.conf.unset(BROADCAST_LIMIT_KEY)


def test_scores_equal_plain_python(labelled_texts):
    """Folding aside, a score worked out word by word from the lexicon and the curve."""
    docs, known = labelled_texts
    model = toxicity.train(docs, known)
    for row in toxicity.scored(docs.limit(200), model).collect():
        words = row["text"].split()
        best = [max([w for t, w in model.lexicon.items() if word == t or (t[-1] == "*" and word.startswith(t[:-1]) and len(word) > len(t) - 1)], default=0.0) for word in words]
        weight, hits, size = sum(best), sum(b > 0 for b in best), len(words)
        z = np.dot(model.curve, [1, math.log1p(weight), math.log1p(100 * weight / size), math.log1p(hits), (hits > 0) * math.log(size)])
        assert abs(row["toxicity"] - 1 / (1 + math.exp(-z))) < 1e-9


def test_toxicity_edges(edge, nothing, labels, labelled_texts, spark):
    kept = toxicity.drop_toxic(edge, labels)
    assert kept.columns == edge.columns
    no_labels = labels.limit(0)
    assert toxicity.drop_toxic(edge, no_labels).count() == edge.count()
    assert toxicity.drop_toxic(nothing, labels).collect() == []
    model = toxicity.train(*labelled_texts)
    scores = {r["doc_id"]: r["toxicity"] for r in toxicity.scored(edge, model).collect()}
    assert scores[5] == scores[6] == scores[7]


# --- language model ---------------------------------------------------------

def test_probabilities_add_up_and_base_is_exact(spark, edge, tmp_path):
    got = language_model.scored(edge, known_words=40).collect()
    assert len(got) == edge.count()
    texts = [(r["doc_id"], language_model.tokens((r["text"] or "").encode())) for r in edge.collect()]
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in texts}
    counts = Counter(w for i, words in texts if not held[i] for w in words)
    total, distinct = sum(counts.values()), len(counts)
    want = Counter()
    for i, words in texts:
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        want[i, held[i], len(words), sum(counts[w] > 0 for w in words), total, round(base, 4)] += 1
    assert Counter((*tuple(r)[:5], round(r["base_score"], 4)) for r in got) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)


def test_model_is_a_distribution_over_next_words(spark, tmp_path):
    """Scores of 'a b X' over every known X, and one unknown per tail class, add up to the score of 'a b'."""
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(90)]
    weights = [1 / (k + 1) for k in range(90)]
    train = [(k, " ".join(rng.choices(vocabulary, weights, k=60))) for k in range(150)]
    unseen: dict[int, str] = {}
    k = 0
    while len(unseen) < language_model.TAIL_CLASSES:
        word = f"zz{k:03d}"
        unseen.setdefault(language_model.tail_class(word.encode()), word)
        k += 1
    # The probes are held out, so they do not change what is learned.
    ids = (n for n in range(10**6, 10**7) if zlib.crc32(str(n).encode()) % 7 == 2)
    probes = {next(ids): f"w1 w2 {w}" for w in [*vocabulary, *unseen.values()]}
    spark.createDataFrame([*train, *probes.items()], "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))  # stored once: both runs below train alike
    rows = {r["doc_id"]: r for r in language_model.scored(docs, known_words=70).collect()}
    counted_ = {w for i, t in train if zlib.crc32(str(i).encode()) % 7 != 2 for w in t.split()}
    assert counted_ == set(vocabulary)
    # The end after X is scored with X as context: take it out by scoring with the model itself.
    words, sizes, known = _model(docs, 70)
    total = 0.0
    for i, text in probes.items():
        total += 10 ** (rows[i]["score"] - _end_score(text, *known))
    end = 10 ** _prefix_score("w1 w2", *known)
    stop = 10 ** (_text_score("w1 w2", *known))
    assert abs((total + stop) / end - 1) < 1e-3


def _model(docs, known_words):
    scratch = Scratch(docs.sparkSession)
    from posloom.llm.common import KEY, row_keyed, top_rows

    keyed = row_keyed(docs, scratch).select(F.col("doc_id").alias("id"), *KEY, F.col("text").cast("binary").alias("data"))
    training = keyed.filter(~language_model.held_out())
    counts = language_model.counted(training).orderBy(F.desc("n"), "word").collect()
    top = top_rows(language_model.counted(training), "n", known_words, "word")
    assert 64 <= len(top) <= known_words and top == counts[: len(top)]
    words, sizes = [bytes(r["word"]) for r in top], [r["n"] for r in top]
    weights = language_model.train(training, words, sizes, scratch)
    tail = np.ones(language_model.TAIL_CLASSES)
    for r in counts[language_model.HEAD_CLASSES * language_model.CLASS_WORDS :]:
        tail[language_model.tail_class(bytes(r["word"]))] += r["n"] + 1
    exact = {bytes(r["word"]): r["n"] for r in counts}
    return words, sizes, (language_model.Vocabulary(words, sizes), weights, tail, exact)


def _logs(text, vocabulary, weights, tail, exact):
    words = language_model.tokens(text.encode())
    _, code, group, place, sizes, _, _ = vocabulary.read([text.encode()])
    found = language_model.features(code, sizes)
    out = []
    for k, w in enumerate(words):
        one, mine = found[k : k + 1], group[k : k + 1]
        logs = language_model._classes(weights, language_model._class_rows(one))[0, group[k]]
        if place[k] >= 0:
            logs += language_model._words(weights, language_model._word_rows(one, mine), mine, vocabulary.filled)[0, place[k]]
            out.append(logs / math.log(10))
        else:
            own = (exact.get(w, 0) + 1) / tail[group[k] - language_model.HEAD_CLASSES]
            out.append(logs / math.log(10) + math.log10(own))
    return out


def _end_score(text, *known):
    return _logs(text, *known)[-1]


def _prefix_score(text, *known):
    return sum(_logs(text, *known)[:-1])


def _text_score(text, *known):
    return sum(_logs(text, *known))


def test_tokens_of_many_texts_at_once():
    texts = [b"", b" ", b"\x0b\x0c A\tb\r\nB ", b"x", "É ÀB é".encode(), b"\xff\x1f Q\x85", b"a" * 70 + b"  b"]
    units, words, sizes = language_model.coded(texts)
    words, at = words.to_pylist(), 0
    for text, size in zip(texts, sizes.tolist()):
        assert [words[k] for k in units[at : at + size].tolist()] == language_model.tokens(text)
        at += size
    assert at == len(units)


def test_a_step_moves_only_the_rows_it_uses_and_as_the_whole_gradient_says():
    lm = language_model
    rng = np.random.default_rng(3)
    n = 300
    found = rng.integers(0, 2**32, (n, 3), dtype=np.uint32)
    found[: n // 2] = found[0]  # rows used by many tokens
    group = rng.integers(0, lm.CLASSES, n)
    place = np.where(group < lm.HEAD_CLASSES, rng.integers(0, lm.CLASS_WORDS, n), -1)
    filled = np.ones((lm.HEAD_CLASSES, lm.CLASS_WORDS), bool)
    vector, squares = rng.normal(size=lm.WIDTH), np.full(lm.WIDTH, 1e-4)
    slope = np.zeros(lm.WIDTH)
    classes, words, bias = lm.split(slope)
    rows = lm._class_rows(found)
    push = np.exp(lm._classes(vector, rows))
    push[np.arange(n), group] -= 1
    for k in range(n):
        for row in rows[k]:
            classes[row] += push[k] / n
        bias[: lm.CLASSES] += push[k] / n
        if place[k] >= 0:
            own = lm._word_rows(found[k : k + 1], group[k : k + 1])
            chance = np.exp(lm._words(vector, own, group[k : k + 1], filled))[0]
            chance[place[k]] -= 1
            for row in own[0]:
                words[row] += chance / n
            low = lm.CLASSES + group[k] * lm.CLASS_WORDS
            bias[low : low + lm.CLASS_WORDS] += chance / n
    want = vector - lm.STEP * slope / np.sqrt(squares + slope * slope + 1e-8)
    got, sums = vector.copy(), squares.copy()
    lm.descend(got, sums, found, group, place, filled)
    np.testing.assert_allclose(got, want, rtol=1e-9, atol=1e-12)
    np.testing.assert_allclose(sums, squares + slope * slope, rtol=1e-9)


def test_class_of_a_word_is_the_same_in_sql_and_python(spark):
    words = [b"\n", b"a", b"ab", b"abc", "é".encode(), "naïveé".encode()]
    frame = spark.createDataFrame([(bytearray(w),) for w in words], "word binary")
    got = [r[0] for r in frame.select(F.crc32(F.substring("word", -2, 2)) % language_model.TAIL_CLASSES).collect()]
    assert got == [language_model.tail_class(w) for w in words]


def _tree(seed, words=300, sent=120, head=64):
    """A vocabulary with words that are not sent, and all words of the tail by class."""
    lm = language_model
    rng = random.Random(seed)
    counts = sorted((rng.choice([1, 2, 3, 50, 900]) for _ in range(words)), reverse=True)
    names = [f"w{k}".encode() for k in range(words)]
    width = lm.rest_buckets(words - sent)
    rest, tail = np.zeros((lm.TAIL_CLASSES, width)), np.zeros(lm.TAIL_CLASSES)
    for k, (w, n) in enumerate(zip(names, counts)):
        tail[lm.tail_class(w)] += (n + 1) * (k >= head)
        rest[lm.tail_class(w), zlib.crc32(w) % width] += (n + 1) * (k >= sent)
    return lm.Vocabulary(names[:sent], counts[:sent], rest=rest), names, counts, tail, rest


def test_all_counted_words_share_their_class_in_every_context():
    lm = language_model
    vocabulary, names, counts, tail, rest = _tree(1)
    ids, code, group, place, sizes, _, rare = vocabulary.read(names)
    told = np.cumsum(sizes) - sizes  # each text is a word and an end
    leaf = vocabulary.tree.leaves(ids, code, group)[told]
    assert [k >= 0 for k in leaf.tolist()] == [k >= 64 for k in range(len(names))] and set(names[120:]) <= set(rare)
    rng = np.random.default_rng(2)
    for weights in (np.zeros(lm.TREE_ROWS, np.float32), rng.normal(size=lm.TREE_ROWS).astype(np.float32)):
        found = np.repeat(rng.integers(0, 2**32, (1, 3), dtype=np.uint32), len(names), axis=0)
        logs = vocabulary.tree.logs(weights, leaf[64:], found[64:])
        share = np.zeros(lm.TAIL_CLASSES)
        for k, log in enumerate(logs.tolist(), 64):
            c, own = lm.tail_class(names[k]), counts[k] + 1
            if k >= 120:
                log += math.log(own / rest[c, zlib.crc32(names[k]) % rest.shape[1]])
            share[c] += math.exp(log)
            if not weights.any():
                assert abs(log - math.log(own / tail[c])) < 1e-4
        np.testing.assert_allclose(share, np.where(tail > 0, 1, 0), atol=1e-4)


def test_a_step_at_the_divisions_follows_the_gradient():
    lm = language_model
    vocabulary, names, *_ = _tree(5)
    ids, code, group, *_ = vocabulary.read(names[64:] * 3)
    leaf = vocabulary.tree.leaves(ids, code, group)
    leaf = leaf[leaf >= 0]
    rng = np.random.default_rng(6)
    found = rng.integers(0, 2**32, (len(leaf), 3), dtype=np.uint32)
    before = rng.normal(size=lm.TREE_ROWS).astype(np.float32)
    after, squares = before.copy(), np.full(lm.TREE_ROWS, 0.5, np.float32)
    vocabulary.tree.descend(after, squares, leaf, found)
    moved = np.flatnonzero(after != before)
    for row in moved[:: len(moved) // 10].tolist():
        low, high = before.copy(), before.copy()
        low[row] -= 0.01
        high[row] += 0.01
        slope = -(vocabulary.tree.logs(high, leaf, found).sum() - vocabulary.tree.logs(low, leaf, found).sum()) / 0.02
        assert abs(before[row] - after[row] - lm.TREE_STEP * slope / math.sqrt(slope * slope + 1.5)) < 2e-3
        assert abs(squares[row] - 0.5 - slope * slope) < 2e-2


@pytest.mark.parametrize("known_words", [200, 64])
def test_context_tells_rare_words_of_one_class_apart(spark, tmp_path, known_words):
    """Sent or not: after 'left' comes one of two words with equal counts and endings, after 'right' the other."""
    rng = random.Random(8)
    fill = [f"f{k}" for k in range(70)]
    texts = [" ".join([*rng.choices(fill, k=80), "left onezz", *rng.choices(fill, k=80), "right twozz"]) for _ in range(1200)]
    ids = (n for n in range(10**6, 10**7) if zlib.crc32(str(n).encode()) % 7 == 2)
    probes = {(a, b): next(ids) for a in ("left", "right") for b in ("onezz", "twozz")}
    rows = [*enumerate(texts), *((i, f"{a} {b}") for (a, b), i in probes.items())]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    got = {r["doc_id"]: r["score"] for r in language_model.scored(docs, known_words=known_words).collect()}
    score = {pair: got[i] for pair, i in probes.items()}
    gain = score["left", "onezz"] - score["left", "twozz"] + score["right", "twozz"] - score["right", "onezz"]
    assert gain > 0.5


def test_language_model_edges(nothing):
    assert language_model.scored(nothing).collect() == []


# --- repeated substrings ----------------------------------------------------

def uncovered(texts, length):
    seen = Counter(t[s : s + length] for t in texts for s in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, int)
        for s in range(len(t) - length + 1):
            if seen[t[s : s + length]] > 1:
                gone[s : s + length] = 1
        spans = int((np.diff(np.concatenate([[0], gone])) == 1).sum())
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def texts_with_repeats(seed):
    rng = random.Random(seed)
    letters = "ab" if seed % 2 else "abcdefgh é"
    passage = ["".join(rng.choices(letters, k=rng.randint(20, 120))) for _ in range(4)]
    out = []
    for _ in range(25):
        parts = ["".join(rng.choices(letters, k=rng.randint(0, 60)))]
        for _ in range(rng.randint(0, 3)):
            piece = rng.choice(passage)
            low = rng.randint(0, len(piece) // 2)
            parts += [piece[low : low + rng.randint(5, 120)], "".join(rng.choices(letters, k=rng.randint(0, 30)))]
        out.append("".join(parts))
    return [*out, out[0], out[0], "", None, "ab" * 70, "a" * 90]


@pytest.mark.parametrize("seed", range(4))
def test_repeats_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(substring, "CHUNK", 150)  # long texts are cut into overlapping stretches
    texts = texts_with_repeats(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: tuple(r)[1:5] for r in substring.without_repeats(docs, length=30, gram=8).collect()}
    want = uncovered([(t or "").encode() for t in texts], 30)
    assert [got[k] for k in range(len(texts))] == want


def test_repeats_in_edge_rows(edge, nothing):
    rows = edge.select("doc_id", "text").collect()
    got = Counter(tuple(r)[:5] for r in substring.without_repeats(edge).collect())
    assert got == Counter((r["doc_id"], *u) for r, u in zip(rows, uncovered([(r["text"] or "").encode() for r in rows], 400)))
    assert substring.without_repeats(nothing).collect() == []


# --- captures ---------------------------------------------------------------

def test_canonical_addresses(spark):
    cases = {
        "http://WWW.Example.com:80/a/?utm_source=x&b=2&a=1#top": "example.com/a?a=1&b=2",
        "HTTPS://user@example.com/a": "example.com/a",
        "example.com": "example.com",
        "https://example.com/?": "example.com",
        "https://example.com?q=1": "example.com?q=1",
        "": "",
    }
    frame = spark.createDataFrame([(u,) for u in cases], "url string")
    assert [r[0] for r in frame.select(warc.canonical(F.col("url"))).collect()] == list(cases.values())


def capture(record, kind, url, at, status, headers, profile=None):
    pairs = None if headers is None else [{"name": n, "value": v} for n, v in headers]
    return (record, kind, url, at, profile, status, pairs)


CAPTURES = "record_id string, kind string, url string, captured string, profile string, status int, " f"headers {warc.HEADERS}"


def resolve(spark, rows):
    frame = spark.createDataFrame(rows, CAPTURES).withColumn("captured", F.expr("try_cast(captured AS timestamp)"))
    return {r["record_id"]: r for r in warc.resolved(frame).collect()}


def test_revisits_take_the_latest_earlier_response(spark):
    full = [("ETag", '"a"'), ("Content-Length", "5"), ("Date", "old"), ("Set-Cookie", "1"), ("Set-Cookie", "2")]
    rows = [
        capture("r1", "response", "http://x.org/p", "2024-01-01 00:00:00", 200, full),
        capture("r2", "response", "https://www.x.org/p#f", "2024-01-05 00:00:00", 200, [("ETag", '"b"')]),
        capture("r3", "response", "http://x.org/p", "2024-01-06 00:00:00", 404, [("ETag", '"c"')]),
        capture("v1", "revisit", "http://x.org/p/", "2024-01-04 10:00:00", 304, [("etag", 'W/"a"'), ("Date", "new"), ("Content-Length", "0")]),
        capture("v2", "revisit", "http://x.org/p", "2024-01-07 00:00:00", 304, [("ETag", '"a"')]),
        capture("v3", "revisit", "http://x.org/p", "2024-01-01 00:00:00", 304, None),
        capture("v4", "revisit", None, "2024-01-09 00:00:00", 304, None),
        capture("v5", "revisit", "http://x.org/p", None, 304, None),
        capture("v6", "revisit", "http://x.org/p", "2024-01-08 00:00:00", 304, None),
        capture("v6", "revisit", "http://x.org/p", "2024-01-08 00:00:00", 304, None),
    ]
    got = resolve(spark, rows)
    assert {k: (r["outcome"], r["source_id"]) for k, r in got.items()} == {
        "v1": ("resolved", "r1"),
        "v2": ("validator_mismatch", "r2"),
        "v3": ("no_earlier_response", None),
        "v4": ("no_earlier_response", None),
        "v5": ("no_earlier_response", None),
        "v6": ("resolved", "r2"),
    }
    assert [(h["name"], h["value"]) for h in got["v1"]["merged"]] == [
        ("Content-Length", "5"), ("Set-Cookie", "1"), ("Set-Cookie", "2"), ("etag", 'W/"a"'), ("Date", "new"),
    ]
    assert resolve(spark, []) == {}


def test_as_of_join_equals_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for n in range(400):
        url = "http://hot.org/" if n % 3 else f"http://x{rng.randint(0, 5)}.org/"
        at = f"2024-01-{rng.randint(1, 4):02d} {rng.randint(0, 3):02d}:{rng.randint(0, 3):02d}:00"
        kind = rng.choice(["response", "revisit"])
        rows.append(capture(f"c{n:03d}", kind, url, at, 200 if kind == "response" else 304, []))
    got = resolve(spark, rows)
    for row in rows:
        if row[1] == "revisit":
            earlier = [(r[3], r[0]) for r in rows if r[1] == "response" and r[2] == row[2] and r[3] < row[3]]
            assert got[row[0]]["source_id"] == (max(earlier)[1] if earlier else None)


def test_files_are_read_record_by_record(spark, tmp_path):
    body = b"\x00\xff binary \r\n\r\n body"
    block = b"HTTP/1.1 200 OK\r\nETag: \"q\"\r\n\r\n" + body
    records = [
        b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <1>\r\nWARC-Target-URI: http://a/\r\n"
        b"WARC-Date: 2024-01-01T00:00:00Z\r\nContent-Length: %d\r\n\r\n" % len(block) + block,
        b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 2\r\n\r\nhi",
    ]
    (tmp_path / "one.warc").write_bytes(b"".join(r + b"\r\n\r\n" for r in records))
    got = {r["kind"]: r for r in warc.parsed(warc.read_warc(spark, str(tmp_path))).collect()}
    assert bytes(got["response"]["body"]) == body and got["response"]["status"] == 200
    assert got["response"]["headers"][0]["value"] == '"q"'
    assert bytes(got["warcinfo"]["body"]) == b"hi" and got["warcinfo"]["captured"] is None


def test_pages_with_nulls_make_captures(spark):
    pages = spark.createDataFrame([(None, None, None), (1, None, "x"), (2, "http://a/", None)], "page_id long, url string, html string")
    parsed = warc.parsed(warc.capture_records(pages)).collect()
    assert len(parsed) == 4  # a page without number has no record
    by_kind = defaultdict(list)
    for r in parsed:
        by_kind[r["kind"]].append(r["status"])
    assert by_kind == {"response": [200, 200], "revisit": [304, 304]}
