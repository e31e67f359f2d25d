"""Toxicity: a weighted lexicon found by Aho-Corasick in folded text.

Folding lowers case, maps homoglyphs to Latin letters, removes invisible
characters and undoes digits and signs that stand for letters inside a word.
Lexicon terms are whole words or beginnings of longer words. A term is learned
from training rows: it must be clearly more frequent per word in toxic texts,
and must follow several different words. Texts with the same folded words count
once per label, toxic and clean alike, so copies of one text, however many, make
no term and hide none. A word counts with the largest weight among its terms;
words inside an exception phrase do not count. A text's hits are normalised by
its length and turned into a probability by a logistic curve fitted on the
training rows.

Every term that passes the thresholds is in the lexicon, save those that cannot
change a score because a kept beginning of theirs weighs as much. A lexicon whose
measured size is within the session's broadcast limit is matched in one pass by
an automaton in every task; a larger one stays a table that the texts' words
meet in a join, with the same result.

Bounds: the curve is fitted on about ``FIT_ROWS`` training rows chosen by a hash
of the id. Counts are made over all different training texts, combined per batch
and before the shuffle; of copies the row stored first is counted, found by 128
bits of a hash of the words.

Defined cases: null and empty texts have no words and get the score of a text
without hits; without labels, or with one class only, the lexicon is empty and
every score is the share of toxic labels (0 without labels); of several labels
for a document the largest counts; a null id has no label and is not held out;
repeated rows are scored each; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from posloom.llm.common import KEY, Scratch, read_table, row_keyed
from posloom.operators.lookup import measured_bytes
from posloom.session import broadcast_limit

THRESHOLD = 0.3
FIT_ROWS = 100_000
PREFIXES = (4, 5, 6, 7, 8)
MIN_CONTEXTS = 5  # far below 64, so 64 bits can tell it
MIN_RATIO = 4.0
MIN_SIGMA = 5.0
FLUSH_TERMS = 200_000

# Look-alike letters, and digits and signs used for letters.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h",
    "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "ӏ": "l", "ԛ": "q", "ԝ": "w",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "γ": "y", "η": "n",
    "ı": "i", "ɩ": "i", "ɑ": "a", "ɡ": "g",
    "​": "", "‌": "", "‍": "", "⁠": "", "﻿": "", "­": "",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
# Phrases in which a term is harmless.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "sore loser board", "pond scum")

_GLYPHS = {ord(k): v for k, v in HOMOGLYPHS.items()}
_ODD = re.compile("[" + "".join(map(re.escape, HOMOGLYPHS)) + "！-～]")
_SIGNS = re.compile(r"[0134578@$!]+(?=[^\W\d_])")
_AFTER = re.compile(r"(?<=[^\W\d_])[013457]+(?![\w@$!])")
_SIGN_LETTERS = str.maketrans(SUBSTITUTES)
_WORD = re.compile(r"[^\W\d_]+")


def folded(text: str) -> str:
    """Lower case, look-alikes and substitutes undone. 'Іd10t' and 'ＩＤＩＯＴ' become 'idiot'."""
    if not text.isascii() and _ODD.search(text := text.lower()):
        text = unicodedata.normalize("NFKC", text).translate(_GLYPHS)
    text = text.lower()
    text = _SIGNS.sub(_inner, text)
    return _AFTER.sub(lambda m: m[0].translate(_SIGN_LETTERS), text)


def _inner(found: re.Match) -> str:
    """Signs before a letter stand for letters if a letter precedes them too, or a lone sign begins a word."""
    at = found.start()
    before = found.string[at - 1] if at else " "
    if before.isalpha() or (len(found[0]) == 1 and before.isspace()):
        return found[0].translate(_SIGN_LETTERS)
    return found[0]


def _evidence(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per term: occurrences by label and the words before toxic ones, as 64 bits."""
    counts: dict[str, list[int]] = {}
    totals = [0, 0]

    def flushed() -> pd.DataFrame:
        merged: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0])
        for word, found in counts.items():
            for term in (word, *[word[:k] + "*" for k in PREFIXES if len(word) > k]):
                have = merged[term]
                have[0] += found[0]
                have[1] += found[1]
                have[2] |= found[2]
        merged[""] = [*totals, 0]
        out = pd.DataFrame.from_dict(merged, orient="index", columns=["clean", "toxic", "after"])
        out["toxic_after"] = out["after"].astype(np.uint64).to_numpy().view(np.int64)
        counts.clear()
        totals[:] = [0, 0]
        return out.drop(columns="after").rename_axis("term").reset_index()

    for frame in frames:
        for text, toxic in zip(frame["text"], frame["toxic"]):
            words = _WORD.findall(folded(text or ""))
            totals[toxic] += len(words)
            before = ""
            for word in words:
                have = counts.get(word)
                if have is None:
                    have = counts[word] = [0, 0, 0]
                have[toxic] += 1
                if toxic:
                    have[2] |= 1 << (zlib.crc32(before.encode()) & 63)
                before = word
        if len(counts) > FLUSH_TERMS:
            yield flushed()
    yield flushed()


@F.pandas_udf(BinaryType())
def _words_hash(texts: pd.Series) -> pd.Series:
    """128 bits that are equal for texts with the same folded words."""
    return texts.map(lambda t: hashlib.md5(" ".join(_WORD.findall(folded(t or ""))).encode()).digest())


def distinct_texts(training: DataFrame, scratch: Scratch) -> DataFrame:
    """Training rows (row-keyed) without copies: of the same words and label the row stored first."""
    marks = scratch.stage(training.select(*KEY, "toxic", _words_hash("text").alias("words")))
    copied = marks.groupBy("words", "toxic").agg(F.min(F.struct(*KEY)).alias("first"), F.count("*").alias("n")).filter("n > 1")
    copies = scratch.stage(marks.join(copied, ["words", "toxic"]).filter(F.struct(*KEY) != F.col("first")).select(*KEY))
    if measured_bytes(copies) <= broadcast_limit(training.sparkSession):
        copies = F.broadcast(copies)
    return training.join(copies, KEY, "left_anti")


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Training rows: row key, id, text and label; a remainder of 2 is held out."""
    known = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    if measured_bytes(known) <= broadcast_limit(labels.sparkSession):
        known = F.broadcast(known)
    rows = row_keyed(docs.select("doc_id", "text"), Scratch(docs.sparkSession))
    return rows.filter(~held_out()).join(known, "doc_id").filter("toxic IN (0, 1)")


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn_lexicon(training: DataFrame) -> DataFrame:
    """``term`` and ``weight``; a term that ends in ``*`` is the beginning of a longer word."""
    scratch = Scratch(training.sparkSession)
    evidence = (
        distinct_texts(training, scratch)
        .select("text", "toxic")
        .mapInPandas(_evidence, "term string, clean long, toxic long, toxic_after long")
        .groupBy("term")
        .agg(
            F.sum("clean").alias("clean"),
            F.sum("toxic").alias("toxic"),
            F.bit_count(F.expr("bit_or(toxic_after)")).alias("contexts"),
        )
    )
    evidence = evidence.filter((F.col("term") == "") | ((F.col("contexts") >= MIN_CONTEXTS) & (F.col("toxic") >= MIN_CONTEXTS)))
    # One row, then rows tested against it: both are read from one staged table.
    evidence = scratch.stage(evidence)
    whole = evidence.filter("term = ''").first()
    clean, toxic = (whole["clean"], whole["toxic"]) if whole else (0, 0)
    if not toxic or not clean:
        return evidence.select("term", F.lit(0.0).alias("weight")).limit(0)
    share = toxic / (clean + toxic)
    expected = (F.col("clean") + F.col("toxic")) * share
    ratio = (F.col("toxic") / toxic) / ((F.col("clean") + 0.5) / clean)
    passed = (
        evidence.filter("term <> ''")
        .withColumn("weight", F.log(ratio))
        .withColumn("sigma", (F.col("toxic") - expected) / F.sqrt(expected))
        .filter((F.col("weight") >= math.log(MIN_RATIO)) & (F.col("sigma") >= MIN_SIGMA))
        .select("term", "weight")
    )
    return scratch.stage(without_implied(scratch.stage(passed)))


def without_implied(terms: DataFrame) -> DataFrame:
    """Terms that decide a weight: none whose beginning is a term of at least its weight.

    A word counts with its largest weight, so the others change no score.
    """
    bare = F.regexp_replace("term", r"\*$", "")
    longer = F.filter(F.array(*[F.lit(k) for k in PREFIXES]), lambda k: F.length(bare) > k)
    begun = terms.select("term", "weight", F.explode(F.transform(longer, lambda k: F.concat(F.substring(bare, F.lit(1), k), F.lit("*")))).alias("start"))
    starts = terms.select(F.col("term").alias("start"), F.col("weight").alias("over"))
    implied = begun.join(starts, "start").filter(F.col("over") >= F.col("weight")).select("term").distinct()
    return terms.join(implied, "term", "left_anti")


class Matcher:
    """Hits of a lexicon in folded text, found in one pass."""

    def __init__(self, lexicon: dict[str, float], exceptions=EXCEPTIONS):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for term, weight in lexicon.items():
            pattern = " " + (term[:-1] if term.endswith("*") else term + " ")
            had = self.automaton.get(pattern, None)
            self.automaton.add_word(pattern, (len(pattern), max(weight, had[1] if had else weight), term.endswith("*")))
        for phrase in exceptions:
            self.automaton.add_word(f" {phrase} ", (len(phrase) + 2, None, False))
        self.automaton.make_automaton()
        self.empty = not lexicon

    def hits(self, text: str | None) -> tuple[int, int, float]:
        """Words, words hit, and the sum of their weights."""
        words = _WORD.findall(folded(text or ""))
        if self.empty or not words:
            return len(words), 0, 0.0
        line = f" {' '.join(words)} "
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (size, weight, starts) in self.automaton.iter(line):
            at = end - size + 1
            if weight is None:
                spared.append((at, end))
            elif not starts or line[end + 1] != " ":
                best[at] = max(weight, best.get(at, 0.0))
        for low, high in spared:
            for at in [a for a in best if low <= a < high]:
                del best[at]
        return len(words), len(best), sum(best.values())


def _features(words: np.ndarray, hits: np.ndarray, weight: np.ndarray) -> np.ndarray:
    size = np.maximum(words, 1)
    return np.stack(
        [np.ones(len(size)), np.log1p(weight), np.log1p(100 * weight / size), np.log1p(hits), (hits > 0) * np.log(size)], axis=1
    )


def fit_curve(features: np.ndarray, labels: np.ndarray, penalty: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge."""
    weights = np.zeros(features.shape[1])
    ridge = penalty * np.eye(features.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(features @ weights, -30, 30)))
        slope = features.T @ (labels - p) - ridge @ weights
        curve = (features * (p * (1 - p))[:, None]).T @ features + ridge
        step = np.linalg.solve(curve, slope)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return weights


class Model:
    """Lexicon and curve. ``lexicon`` is a dictionary where it fits every task, else a table."""

    def __init__(self, lexicon: dict[str, float] | DataFrame, curve: np.ndarray):
        self.lexicon, self.curve = lexicon, curve


def fitting(lexicon: DataFrame) -> dict[str, float] | DataFrame:
    """The lexicon as a dictionary if its measured size allows it to be sent to every task."""
    if measured_bytes(lexicon) > broadcast_limit(lexicon.sparkSession):
        return lexicon
    return {r["term"]: float(r["weight"]) for r in lexicon.collect()}


def train(docs: DataFrame, labels: DataFrame) -> Model:
    training = labelled(docs, labels)
    lexicon = fitting(learn_lexicon(training))
    share = min(1.0, FIT_ROWS / max(1, labels.count()))  # documented bound of the curve's sample
    sample = training.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * share))
    rows = counted(sample.select("toxic", "text", *KEY), lexicon, "toxic").toPandas()
    if not len(rows):
        return Model({}, np.asarray([-30.0, 0, 0, 0, 0]))
    toxic = rows["toxic"].to_numpy(float)
    found = rows[["words", "hits", "weight"]].to_numpy(float)
    if not found[:, 1].any() or toxic.min() == toxic.max():
        odds = min(max(toxic.mean(), 1e-9), 1 - 1e-9)
        return Model({}, np.asarray([math.log(odds / (1 - odds)), 0, 0, 0, 0]))
    return Model(lexicon, fit_curve(_features(*found.T), toxic))


COUNTS = "words long, hits long, weight double"


def counted(docs: DataFrame, lexicon: dict[str, float] | DataFrame, *keep: str) -> DataFrame:
    """Words, words hit and their summed weight of each text, beside the columns to keep.

    ``docs`` has ``text``; for a lexicon that is a table also the row key.
    """
    kept = [docs.schema[c] for c in keep]
    if isinstance(lexicon, DataFrame):
        return _counted_by_join(docs, lexicon, *keep)
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(sent.value)
        for frame in frames:
            out = pd.DataFrame([matcher.hits(t) for t in frame["text"]], columns=["words", "hits", "weight"])
            for name in keep:
                out[name] = frame[name].to_numpy()
            yield out

    spec = ", ".join([COUNTS, *[f"`{f.name}` {f.dataType.simpleString()}" for f in kept]])
    return docs.select("text", *keep).mapInPandas(run, spec)


def _counted_by_join(docs: DataFrame, lexicon: DataFrame, *keep: str) -> DataFrame:
    """The same through a join of the texts' different words with the lexicon's table."""

    def words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        spare = ahocorasick.Automaton()
        for phrase in EXCEPTIONS:
            spare.add_word(f" {phrase} ", len(phrase) + 2)
        spare.make_automaton()
        for frame in frames:
            for at in range(0, len(frame), 200):
                rows = []
                for file, row, text in frame.iloc[at : at + 200][[*KEY, "text"]].itertuples(index=False):
                    found, counts = _WORD.findall(folded(text or "")), defaultdict(int)
                    line, place = f" {' '.join(found)} ", 0
                    spared = [(end - size + 1, end) for end, size in spare.iter(line)]
                    for word in found:
                        if not any(low <= place < high for low, high in spared):
                            counts[word] += 1
                        place += len(word) + 1
                    rows += [(file, row, len(found), w, n) for w, n in (counts or {"": 0}).items()]
                yield pd.DataFrame(rows, columns=[*KEY, "words", "word", "n"])

    spoken = docs.select(*KEY, "text").mapInPandas(words, "_file long, _row long, words long, word string, n long")
    starts = F.transform(
        F.filter(F.array(*[F.lit(k) for k in PREFIXES]), lambda k: F.length("word") > k),
        lambda k: F.concat(F.substring(F.col("word"), F.lit(1), k), F.lit("*")),
    )
    different = spoken.select("word").distinct().select("word", F.explode(F.concat(F.array("word"), starts)).alias("term"))
    weights = different.join(lexicon, "term").groupBy("word").agg(F.max("weight").alias("weight"))
    totals = (
        spoken.join(weights, "word", "left")
        .groupBy(*KEY)
        .agg(
            F.max("words").alias("words"),
            F.coalesce(F.sum(F.when(F.col("weight").isNotNull(), F.col("n"))), F.lit(0)).alias("hits"),
            F.coalesce(F.sum(F.col("n") * F.col("weight")), F.lit(0.0)).alias("weight"),
        )
    )
    return docs.select(*keep, *KEY).join(totals, KEY).select("words", "hits", "weight", *keep)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` (with ``text``) and ``toxicity``, the model's score, in place of any column of that name."""
    docs = docs.drop("toxicity")
    if isinstance(model.lexicon, DataFrame):
        scratch = Scratch(docs.sparkSession)
        keyed = row_keyed(docs.select(F.struct(*docs.columns).alias("doc"), "text"), scratch)
        found = counted(keyed, model.lexicon, *KEY)
        curve = model.curve

        @F.pandas_udf("double")
        def probability(words: pd.Series, hits: pd.Series, weight: pd.Series) -> pd.Series:
            return pd.Series(_probability(_features(*(x.to_numpy(float) for x in (words, hits, weight))), curve))

        marked = found.select(*KEY, probability("words", "hits", "weight").alias("toxicity"))
        return keyed.join(marked, KEY).select("doc.*", "toxicity")
    sent = docs.sparkSession.sparkContext.broadcast((model.lexicon, model.curve))

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lexicon, curve = sent.value
        matcher = Matcher(lexicon)
        for batch in texts:
            found = np.asarray([matcher.hits(t) for t in batch], dtype=float).reshape(-1, 3)
            yield pd.Series(_probability(_features(*found.T), curve))

    return docs.withColumn("toxicity", score("text"))


def _probability(features: np.ndarray, curve: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(features @ curve, -30, 30)))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the texts scored at or over the threshold; columns unchanged."""
    model = train(docs, labels)
    own = docs.select(F.struct(*docs.columns).alias("doc"), "text")  # names in docs cannot clash with ours
    return scored(own, model).filter(F.col("toxicity") < THRESHOLD).select("doc.*")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs, read_table(spark, sf_dir, "labels"))
    return scored(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"),
    )
