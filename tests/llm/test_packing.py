from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from posloom.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_round_trip_of_pieces(edge, tokenizer):
    capacity = 256
    want = Counter()
    for row in edge.select("doc_id", "text").collect():
        ids = np.asarray([*tokenizer.encode(row["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        count, start = -(-len(ids) // capacity), 0
        for piece in range(count):
            length = len(ids) - capacity * (count - 1) if piece == 0 else capacity
            want[row["doc_id"], piece, start, length, zlib.crc32(ids[start : start + length].tobytes())] += 1
            start += length
    got = packing.packed(edge, capacity=capacity).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity


def test_empty_table(nothing):
    assert packing.packed(nothing).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_bins_hold_every_piece_once(seed):
    rng = random.Random(seed)
    histogram = {rng.randint(1, 100): rng.randint(1, 60) for _ in range(rng.randint(1, 40))}
    bins = packing.plan_bins(histogram, 100)
    held = Counter()
    for config, count in bins:
        assert sum(config) <= 100 and count > 0
        for x in config:
            held[x] += count
    assert held == histogram
    bound = -(-sum(x * n for x, n in histogram.items()) // 100)
    halves = sum(n for x, n in histogram.items() if x > 50)
    assert sum(n for _, n in bins) <= max(bound, halves) * 1.1 + 2


def skewed_lengths():
    """Many short, some long, and a few lengths that a third of the pieces have."""
    rng = np.random.default_rng(6)
    drawn = np.minimum(rng.geometric(1 / 160, 6000), 500)
    histogram = Counter(drawn.tolist())
    histogram[37] += 2000
    return {x: n for x, n in histogram.items() if x < 512}


def test_most_pieces_are_placed_by_the_program_close_to_its_bound():
    histogram = skewed_lengths()
    plan = packing.planned(histogram, 512)
    assert plan.ratio <= 1 + packing.GAP
    assert plan.by_program >= 0.75 * plan.pieces
    assert plan.bound <= plan.sequences <= 1.01 * plan.bound + 1


def test_bound_is_below_every_packing():
    """Exact optima of small histograms, by search over all configurations."""
    from functools import lru_cache

    rng = random.Random(2)
    for _ in range(12):
        lengths = sorted(rng.sample(range(2, 11), 3))
        counts = tuple(rng.randint(1, 4) for _ in lengths)

        def configs(room, at=0):
            if at == len(lengths):
                return [()]
            return [(k, *rest) for k in range(room // lengths[at] + 1) for rest in configs(room - k * lengths[at], at + 1)]

        every = [c for c in configs(12) if any(c)]

        @lru_cache(None)
        def fewest(left):
            if not any(left):
                return 0
            return 1 + min(fewest(tuple(max(0, a - b) for a, b in zip(left, c))) for c in every if any(min(a, b) for a, b in zip(left, c)))

        plan = packing.planned(dict(zip(lengths, counts)), 12)
        assert plan.bound <= fewest(counts) <= plan.sequences <= fewest(counts) + 1


def test_knapsack_is_optimal():
    rng = np.random.default_rng(1)
    for _ in range(20):
        lengths = np.unique(rng.integers(1, 25, 6))
        values = rng.random(len(lengths))
        got = packing.knapsack(lengths, values, 30)
        assert sum(got) <= 30
        best = np.zeros(31)
        for room in range(1, 31):
            best[room] = max([best[room - 1], *[v + best[room - x] for x, v in zip(lengths, values) if x <= room]])
        assert np.isclose(sum(values[list(lengths).index(x)] for x in got), best[30])
