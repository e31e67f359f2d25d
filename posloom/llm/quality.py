"""Quality rules: a threshold table compiled into one projection, no user functions.

Measures come from whole texts. Words are runs of anything but ASCII white
space, windows are three words long, lines end at a line feed. A null text has
no words. ``RULES`` is the table: name, measure as SQL over the base measures,
lowest and highest value allowed; a null value (nothing to measure) passes.

Defined cases: null, empty and blank texts have zero in all measures and fail
the base; repeated rows are judged one by one; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from posloom.llm.common import GAP, WORD_CHAR, read_table, words_of

WINDOW = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Frequent function words of the four languages.
STOP_WORDS = [
    "the", "of", "and", "to", "in", "is", "that", "it", "was", "for", "on", "are", "with", "as", "be", "at", "by", "from",
    "der", "die", "das", "und", "ist", "nicht", "ein", "eine", "zu", "den", "von", "mit", "auf", "für", "im", "dem", "des",
    "le", "la", "les", "et", "un", "une", "est", "pour", "que", "qui", "dans", "du", "sur", "par", "au", "en",
    "el", "los", "las", "y", "una", "es", "con", "por", "para", "se", "lo", "al", "su",
]

# name, measure, lowest, highest
RULES: list[tuple[str, str, float | None, float | None]] = [
    ("words", "n_words", 50, 1_000_000),
    ("mean_word_chars", "word_chars / n_words", 2.0, 14.0),
    ("symbols_per_word", "n_symbols / n_words", None, 0.3),
    ("stop_word_share", "n_stop_words / n_words", 0.01, None),
    ("duplicate_line_share", "n_dup_lines / n_lines", None, 0.5),
    ("repeated_word_share", "n_repeat_words / n_words", None, 0.5),
]


def repeated_words(words: Column) -> Column:
    """Words inside a window of three words that occurs twice or more in the text.

    Window hashes are sorted with their positions, so equal windows stand side
    by side; the starts found are sorted again and each covers the words up to
    the next start, three at most. No step is quadratic in the text's length.
    """
    windows = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - (WINDOW - 1), F.lit(0))),
        lambda w, i: F.struct(
            F.xxhash64(w, *[F.get(words, i + k) for k in range(1, WINDOW)]).alias("h"), i.alias("i")
        ),
    )
    return F.sort_array(windows)


def _repeated_starts(ordered: Column) -> Column:
    def start(w: Column, k: Column) -> Column:
        twin = (F.get(ordered, k - 1)["h"] == w["h"]) | (F.get(ordered, k + 1)["h"] == w["h"])
        return F.when(F.coalesce(twin, F.lit(False)), w["i"])

    return F.array_sort(F.array_compact(F.transform(ordered, start)))


def _covered(starts: Column) -> Column:
    gaps = F.transform(starts, lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - s, F.lit(WINDOW))))
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)


def measures(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        *keep,
        words_of(text).alias("_words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD_CHAR)).alias("_lines"),
        F.length(F.regexp_replace(text, GAP, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
    )
    counted = base.select(
        *keep,
        "word_chars",
        "n_symbols",
        F.size("_words").cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("_words", lambda w: w.isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        repeated_words(F.col("_words")).alias("_ordered"),
    )
    starts = counted.select(
        *[c for c in counted.columns if c != "_ordered"], _repeated_starts(F.col("_ordered")).alias("_starts")
    )
    return starts.select(*[c for c in starts.columns if c != "_starts"], _covered(F.col("_starts")).alias("n_repeat_words"))


def compiled(rules=RULES) -> dict[str, Column]:
    """The threshold table as one boolean column per rule."""
    out = {}
    for name, measure, low, high in rules:
        value = F.expr(measure.replace(" / n_words", " / nullif(n_words, 0)").replace(" / n_lines", " / nullif(n_lines, 0)"))
        test = F.lit(True)
        if low is not None:
            test = test & (value >= low)
        if high is not None:
            test = test & (value <= high)
        out[name] = F.coalesce(test, F.lit(True))
    return out


def judged(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), rules=RULES) -> DataFrame:
    """Measures, base verdict, names of the rules a text broke, and the verdict."""
    tests = compiled(rules)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    passed = ~failed
    for test in tests.values():
        passed = passed & test
    broken = F.array_compact(F.array(*[F.when(~test, F.lit(name)) for name, test in tests.items()]))
    return measures(docs, text_col, keep).withColumns(
        {"base_failed": failed, "kept": passed, "broken_rules": broken}
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _rule_sql(measure: str, low: float | None, high: float | None) -> str:
    value = measure.replace(" / n_words", " / nullif(n_words, 0)").replace(" / n_lines", " / nullif(n_lines, 0)")
    tests = [f"{value} >= {low}" if low is not None else "", f"{value} <= {high}" if high is not None else ""]
    return f"coalesce({' AND '.join(t for t in tests if t)}, TRUE)"


_STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)
OP4_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, w[i:i + 2] AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM repeated) GROUP BY doc_id
), m AS (
  SELECT d.doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, len(lines) AS n_lines,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
         len(list_filter(w, lambda x: x IN ({_STOP_SQL}))) AS n_stop_words
  FROM d LEFT JOIN covered c USING (doc_id)
), b AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(_rule_sql(m, lo, hi) for _, m, lo, hi in RULES)} AS kept
FROM b
"""
