from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np

from posloom.llm import exact_dedup, near_dedup


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_groups_equal_brute_force(edge):
    groups = defaultdict(list)
    for row in edge.collect():
        groups[normal(row["text"])].append(row["doc_id"])
    for hash_all in (True, False):
        got = exact_dedup.exact_groups(edge, hash_all=hash_all).collect()
        assert len(got) == edge.count()
        rows = defaultdict(list)
        for r in got:
            rows[r["keep_id"], r["group_size"]].append(r)
        for text, ids in groups.items():
            known = [i for i in ids if i is not None]
            keep = min(known) if known else None
            sha = hashlib.sha256(text.encode()).hexdigest()
            mine = [r for r in rows[keep, len(ids)] if r["text_sha256"] in (sha, None)]
            if len(ids) > 1:
                assert sorted(map(str, ids)) == sorted(str(r["doc_id"]) for r in mine if r["text_sha256"] == sha)
            if hash_all:
                assert sum(r["kept"] for r in mine if r["text_sha256"] == sha) == 1
        assert sum(r["kept"] for r in got) == len(groups)


def test_exact_stage_keeps_columns(edge, nothing, unchanged):
    kept = exact_dedup.drop_exact(edge)
    unchanged(kept)
    assert kept.columns == edge.columns
    texts = [normal(r["text"]) for r in kept.select("text").collect()]
    assert len(texts) == len(set(texts)) == len({normal(r["text"]) for r in edge.select("text").collect()})
    assert exact_dedup.drop_exact(nothing).collect() == []
    assert exact_dedup.exact_groups(nothing, hash_all=True).collect() == []


def bags(texts):
    out = []
    for text in texts:
        words = (text or "").encode().split()
        out.append(Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else Counter())
    return out


def classes(texts):
    """Components of pairs with a weighted Jaccard similarity of 0.8 or more."""
    found, parent = bags(texts), list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(texts)), 2):
        both = sum((found[a] & found[b]).values())
        either = sum((found[a] | found[b]).values())
        if 5 * both >= 4 * either:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return [root(x) for x in range(len(texts))]


def test_near_classes_equal_brute_force(edge, monkeypatch):
    rows = edge.select("doc_id", "text").collect()
    # Small limits, so that groups, blocks and pairs are all used.
    monkeypatch.setattr(near_dedup, "SMALL_BUCKET", 6)
    monkeypatch.setattr(near_dedup, "BLOCK_UNITS", 900)
    want = Counter(Counter(classes([r["text"] for r in rows])).values())
    got = near_dedup.near_classes(edge).collect()
    assert len(got) == len(rows)
    sizes = Counter(r["class_size"] for r in got)
    assert sizes == Counter({size: size * n for size, n in want.items()})
    by_text = defaultdict(set)
    for r, c in zip(rows, classes([r["text"] for r in rows])):
        by_text[c].add(r["doc_id"])
    firsts = {c: min((i for i in ids if i is not None), default=None) for c, ids in by_text.items()}
    ids = {r["doc_id"]: firsts[c] for r, c in zip(rows, classes([r["text"] for r in rows])) if r["doc_id"] is not None}
    assert {r["doc_id"]: r["class_id"] for r in got if r["doc_id"] is not None} == ids
    assert sum(r["kept"] for r in got) == len(by_text)


def test_near_stage(edge, nothing, unchanged):
    kept = near_dedup.drop_near(edge)
    unchanged(kept)
    assert kept.columns == edge.columns
    assert kept.count() == len(set(classes([r["text"] for r in edge.collect()])))
    assert near_dedup.drop_near(nothing).collect() == []


def test_hub_edges_connect_what_buckets_connect(spark):
    """Few edges even where every text has many buckets, and the same components."""
    rng = np.random.default_rng(7)
    buckets = {b: rng.choice(400, 60, replace=False) + 1000 * (b % 3) for b in range(24)}
    names = [str(x).zfill(6).encode() for x in range(4000)]
    rows = [(names[t], b, names[min(texts)]) for b, texts in buckets.items() for t in texts.tolist()]
    members = spark.createDataFrame(rows, "node binary, bucket long, hub binary")
    edges = near_dedup._hub_edges(members).collect()
    texts = {bytes(r[0]) for r in rows}
    assert len(edges) <= len(texts) + len(buckets) ** 2

    def together(pairs):
        parent = {t: t for t in texts}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in pairs:
            x, y = sorted((root(bytes(a)), root(bytes(b))))
            parent[y] = x
        return {t: root(t) for t in texts}

    assert together((e["a"], e["b"]) for e in edges) == together((r[0], r[2]) for r in rows)


def test_later_links_join_labels(spark):
    from posloom.llm.common import Scratch

    scratch = Scratch(spark)
    labels = spark.createDataFrame([(b"a", b"a"), (b"b", b"a"), (b"c", b"c"), (b"d", b"c"), (b"e", b"e"), (b"f", b"e")], "node binary, label binary")
    links = spark.createDataFrame([(b"b", b"d"), (b"x", b"f"), (b"y", b"z"), (b"a", b"b")], "a binary, b binary")
    got = {bytes(r["node"]): bytes(r["label"]) for r in near_dedup._relabelled(labels, links, scratch).collect()}
    assert got == {b"a": b"a", b"b": b"a", b"c": b"a", b"d": b"a", b"e": b"e", b"f": b"e", b"x": b"e", b"y": b"y", b"z": b"y"}


def test_signatures_estimate_weighted_similarity():
    """Agreement of registers is close to the weighted similarity, heavy weights included."""
    rng = np.random.default_rng(3)
    code = rng.integers(1, 2**63, 60, dtype=np.uint64)
    errors = []
    for _ in range(40):
        a, b = rng.integers(0, 40, 60), rng.integers(0, 40, 60)
        text = np.concatenate([np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)])
        codes = np.concatenate([code[a > 0], code[b > 0]]) ^ rng.integers(1, 2**63, dtype=np.uint64)
        got = near_dedup.bag_signatures(text, codes, np.concatenate([a[a > 0], b[b > 0]]), 2)
        errors.append((got[0] == got[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.08


def test_signature_depends_on_the_text_alone():
    texts = [b"a b c d e f g h i j", b"one two", b"", b"x " * 500]
    together = near_dedup.bag_signatures(*near_dedup.shingles(texts), len(texts))
    for k, text in enumerate(texts):
        alone = near_dedup.bag_signatures(*near_dedup.shingles([text]), 1)
        assert (alone[0] == together[k]).all()
