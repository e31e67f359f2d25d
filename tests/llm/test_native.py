"""Mixing, quality rules and sharding against plain Python."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from posloom.llm import mixing, quality, sharding
from posloom.llm.common import KEY, Scratch, row_keyed


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_quality_measures_equal_plain_python(edge):
    got = Counter(
        tuple(r)
        for r in quality.judged(edge)
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        .collect()
    )
    want = Counter()
    for row in edge.collect():
        text = row["text"] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = Counter(zip(words, words[1:], words[2:]))
        covered = {i + d for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for d in range(3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        symbols = sum(c in "#*$%&|<>" for c in text)
        want[row["doc_id"], len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed] += 1
    assert got == want


def test_quality_rules_are_one_projection(edge, nothing):
    text = plan(quality.judged(edge))
    assert "Exchange" not in text and "Python" not in text and "Join" not in text
    assert quality.judged(nothing).collect() == []
    rules = [("few_lines", "n_lines", None, 1), ("long_words", "word_chars / n_words", 4.0, None)]
    for r in quality.judged(edge, rules=rules).collect():
        broken = [n for n, ok in (("few_lines", r["n_lines"] <= 1), ("long_words", not r["n_words"] or r["word_chars"] / r["n_words"] >= 4)) if not ok]
        assert r["broken_rules"] == broken and r["kept"] == (not r["base_failed"] and not broken)


def test_shards_are_exact_and_gapless(edge, nothing):
    got = sharding.into_shards(edge, shards=7).select("doc_id", "shard", "slot").collect()
    assert len(got) == edge.count()
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.into_shards(nothing).collect() == []


def test_shard_blocks_and_repeatability(edge):
    scratch = Scratch(edge.sparkSession)
    rows = scratch.stage(row_keyed(edge.select("doc_id"), scratch))
    one = sharding.assigned(rows, 3, part_rows=5).collect()
    assert sorted(map(str, one)) == sorted(map(str, sharding.assigned(rows.repartition(5), 3, part_rows=5).collect()))
    slots = defaultdict(list)
    for r in one:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_communication_matrix_is_uniform():
    """Margins are exact; a cell's mean and variance are those of a uniform shuffle."""
    cells = []
    for seed in range(3000):
        m = sharding.communication_matrix([4, 6, 2], [5, 4, 3], seed)
        assert m.sum(axis=1).tolist() == [4, 6, 2] and m.sum(axis=0).tolist() == [5, 4, 3]
        cells.append(m[1, 0])
    mean, variance = 6 * 5 / 12, 6 * 5 / 12 * (7 / 12) * (6 / 11)
    assert abs(sum(cells) / 3000 - mean) < 0.06
    assert abs(sum((c - mean) ** 2 for c in cells) / 3000 - variance) < 0.06


def fill(caps, weights, budget):
    """Water filling by hand: cap who is full, share the rest again."""
    given, open_ = {}, set(caps)
    while open_:
        rest = budget - sum(given.values())
        total = sum(weights[k] for k in open_)
        full = [k for k in open_ if total and caps[k] <= rest * weights[k] / total]
        if not full:
            given |= {k: rest * weights[k] / total if total else 0.0 for k in open_}
            break
        given |= {k: caps[k] for k in full}
        open_ -= set(full)
    return given


def test_budgets_go_to_siblings_first(spark):
    leaves = {("0", "en", "a"): 100, ("0", "en", "b"): 900, ("0", "de", "a"): 500, ("1", "en", "c"): 50, ("1", None, "c"): 20, ("1", None, None): 0}
    frame = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "domain string, lang string, source string, tokens long")
    weights = {"domain": {"0": 1.0, "1": 2.0}, "lang": {"en": 3.0}, "source": {"b": 0.5}}
    got = {tuple(r)[:3]: r["given"] for r in mixing.budgets(frame, F.lit(600.0), 2, weights).collect()}

    def split(level, prefix, budget):
        name = mixing.LEVELS[level]
        caps = defaultdict(float)
        for path, n in leaves.items():
            if path[:level] == prefix:
                caps[path[level]] += 2 * n
        given = fill(dict(caps), {k: weights[name].get(k, 1.0) for k in caps}, budget)
        for k, v in given.items():
            if level == 2:
                want[*prefix, k] = v
            else:
                split(level + 1, (*prefix, k), v)

    want: dict = {}
    split(0, (), min(600.0, 2 * sum(leaves.values())))
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-6 for k in want)


@pytest.mark.parametrize("share, epochs", [(1.0, 3), (0.5, 1), (0.9, 1), (5.0, 2), (0.0, 2)])
def test_mix_takes_prefixes_of_epochs(edge, share, epochs):
    got = mixing.mixed(edge, share, epochs, slice_rows=4).collect()
    assert len(got) == edge.count()
    leaves = defaultdict(list)
    for r in got:
        leaves[r["domain"], r["lang"], r["source"]].append(r)
    for rows in leaves.values():
        tokens, budget = sum(r["tokens"] for r in rows), rows[0]["budget"]
        whole = budget // tokens if tokens else 0
        assert {r["times"] for r in rows} <= {whole, whole + 1}
        taken = sum(r["tokens"] * r["times"] for r in rows)
        assert taken >= budget if whole < epochs else taken == budget
        extra = [r["tokens"] for r in rows if r["times"] > whole]
        assert taken - budget <= max(extra, default=0)  # the prefix ends with the text that reaches the budget
        assert whole <= epochs
    assert sum(rows[0]["budget"] for rows in leaves.values()) <= share * sum(r["tokens"] for r in got) + 1e-6


def test_mix_does_not_depend_on_slices(edge):
    one = mixing.mixed(edge, 0.6, 1, slice_rows=3).collect()
    other = mixing.mixed(edge, 0.6, 1, slice_rows=1000).collect()
    assert sorted(map(str, one)) == sorted(map(str, other))


def test_mix_stage(edge, nothing, unchanged):
    drawn = mixing.draw_mix(edge, 1.0, 3)
    unchanged(drawn)
    assert drawn.columns == edge.columns
    times = Counter(r["text"] for r in drawn.select("text").collect())
    want = Counter()
    joined = mixing.mixed(edge, 1.0, 3)
    scratch = Scratch(edge.sparkSession)
    for r in row_keyed(edge.select("text"), scratch).join(joined, KEY).select("text", "times").collect():
        want[r["text"]] += r["times"]
    assert times == +want
    assert mixing.draw_mix(nothing, 1.0, 2).collect() == []


@pytest.mark.parametrize("room, others, need", [(5, 7, 6), (1, 3, 4), (3, 0, 2), (0, 4, 2), (10**10, 3 * 10**11, 30), (10**9, 1, 9), (300, 500, 400)])
def test_drawn_law_equals_exact_binomials(room, others, need):
    low, weights = sharding.hypergeometric_law(room, others, need)
    exact = [math.comb(room, k) * math.comb(others, need - k) for k in range(low, low + len(weights))]
    whole = math.comb(room + others, need)
    assert np.allclose(weights / weights.sum(), [float(Fraction(x, whole)) for x in exact], rtol=1e-9, atol=1e-30)
    assert float(1 - Fraction(sum(exact), whole)) < 1e-15


def test_communication_matrix_keeps_the_law_beyond_a_billion_rows():
    none = [sharding.communication_matrix([10], [2 * 10**8, 18 * 10**8], seed)[0, 0] == 0 for seed in range(4000)]
    assert abs(np.mean(none) - 0.9**10) < 0.03
    wide = [sharding.communication_matrix([500_000], [10**8, 4 * 10**9], seed)[0, 0] for seed in range(1000)]
    share = 1 / 41
    assert abs(np.mean(wide) - 500_000 * share) < 20
    assert abs(np.std(wide) / math.sqrt(500_000 * share * (1 - share)) - 1) < 0.1


def test_shard_digests(edge, spark, tmp_path):
    edge.write.parquet(str(tmp_path / "documents.parquet"))
    got = Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in sharding.op8_shard_shuffle(spark, str(tmp_path)).collect())
    data = [(r["doc_id"], (r["text"] or "").encode()) for r in edge.collect()]
    assert got == Counter((i, len(b) + 16, zlib.crc32(b)) for i, b in data)
