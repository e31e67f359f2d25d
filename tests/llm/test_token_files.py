from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from posloom.llm import token_files, tokens
from posloom.session import shared_dir


class Memory:
    """A file's bytes that counts what is read."""

    def __init__(self, data: bytes):
        self.data, self.read = data, 0

    def read_at(self, size: int, offset: int) -> bytes:
        self.read += size
        return self.data[offset : offset + size]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


ODD = [
    "", " ", "  ", "a  b", " lead", "trail ", "a \n b", "\t\tx y", "it's we'll 'tis, x!? y.. z'.", "x  y", "x\x1f y", "\n y z",
    "café naïve 你好 \U0001f600", "12 345, ²; ½: Ⅷ!", "<|endoftext|>", "a <|endoftext|>. b<|endoftext|>, c", "\x00 \x7f", "a" * 300 + " " + "b" * 70 + ",",
]


@pytest.mark.parametrize("entries", [40, 100_000])
def test_encoder_equals_the_tokenizer(tokenizer, entries):
    rng = random.Random(5)
    texts = [*ODD, *["".join(rng.choices("ab' \n\té 1!.,;你<|>²\x1f", k=40)) for _ in range(400)]]
    encoder = tokens.Encoder(entries=entries)
    for at in range(0, len(texts), 9):
        some = texts[at : at + 9]
        ids, counts = encoder.encode(some)
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in some]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])
    assert encoder.encode([])[0].tolist() == []


@pytest.mark.parametrize("top", [1, 2, 300, 50_257, 2**32])
def test_any_token_by_itself(top):
    rng = np.random.default_rng(top % 1000)
    ids = np.minimum(rng.geometric(1 / max(2, top // 40), 20_000), top - 1).astype(np.uint32)
    ids[7::501] = top - 1
    data = token_files.encoded(ids, pa.table({"id": [1, None], "n_tokens": [7, len(ids) - 7]}))
    file = token_files.TokenFile(Memory(data))
    assert file.tokens_count == len(ids) and file.documents().column("id").to_pylist() == [1, None]
    for place in [0, 511, 512, 513, len(ids) - 1, *rng.integers(0, len(ids), 200).tolist()]:
        before = file.source.read
        assert file.token(place) == ids[place]
        assert file.source.read - before <= 120 * len(file.levels)  # no block is read
    for low, high in [(0, len(ids)), (5, 5), (511, 1025), (len(ids) - 1, len(ids))]:
        assert file.tokens(low, high).tolist() == ids[low:high].tolist()
    with pytest.raises(IndexError):
        file.token(len(ids))


def test_widths_are_the_cheapest():
    rng = np.random.default_rng(1)
    ids = rng.geometric(1 / 30, 5000).astype(np.uint32)
    chosen = token_files.chunk_widths(ids)

    def cost(widths):
        total, low = 0.0, 0
        for k, width in enumerate(widths):
            there = len(ids) if low == 0 else int((ids >> np.uint32(low)).astype(bool).sum())
            total += there * (width + (1 + 64 / 512) * (k < len(widths) - 1))
            low += width
        return total

    def splits(left):
        return [[]] if not left else [[k, *rest] for k in range(1, left + 1) for rest in splits(left - k)]

    top = int(ids.max()).bit_length()
    assert sum(chosen) == top
    assert abs(cost(chosen) - min(map(cost, splits(top)))) < 1e-6


def test_damaged_file_is_refused():
    with pytest.raises(ValueError):
        token_files.TokenFile(Memory(b"x" * 40))


@pytest.mark.parametrize("file_tokens", [500, 1 << 23])
def test_files_hold_all_documents_in_order(edge, tokenizer, spark, file_tokens, monkeypatch):
    monkeypatch.setattr(token_files, "TEXT_AT_ONCE", 2000)
    root = f"{shared_dir(spark)}/tokens-test-{file_tokens}"
    manifest = token_files.write_tokens(edge, root, file_tokens=file_tokens)
    got = [tuple(r) for r in token_files.read_tokens(manifest, root, file_tokens).collect()]
    rows = edge.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    want = {}
    for row in rows:
        ids = np.asarray([*tokenizer.encode(row["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        want.setdefault(row["doc_id"], []).append((len(ids), zlib.crc32(ids.tobytes())))
    got.sort(key=lambda r: r[1])
    ids = [r[0] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is None, i))
    start = 0
    for doc, begin, count, _ in got:
        assert begin == start
        start += count
    for doc, pairs in want.items():
        assert sorted(pairs) == sorted((r[2], r[3]) for r in got if r[0] == doc)
    files = manifest.collect()
    assert sum(r["tokens"] for r in files) == start and (len(files) > 5) == (file_tokens == 500)


def test_token_files_of_an_empty_table(nothing, spark):
    root = f"{shared_dir(spark)}/tokens-test-none"
    assert token_files.read_tokens(token_files.write_tokens(nothing, root), root).collect() == []


def test_query_reads_its_files_back(spark, tmp_path, edge):
    edge.write.parquet(str(tmp_path / "documents.parquet"))
    got = token_files.op11_token_files(spark, str(tmp_path))
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() == edge.count()


def test_new_words_are_encoded_side_by_side(tokenizer):
    rng = random.Random(9)
    words = sorted({"".join(rng.choices("abcdéß1'-", k=9)) + rng.choice([".", ",", "!?", ""]) for _ in range(3000)})
    encoder, calls = tokens.Encoder(), []
    plain = encoder.plain
    encoder.plain = lambda text: calls.append(text) or plain(text)
    ids, _ = encoder.encode([" ".join(words)])
    assert ids.tolist() == tokenizer.encode(" ".join(words), add_special_tokens=False).ids
    assert len(calls) < 20  # not one for each word


def test_letters_go_to_the_merges_only_where_no_token_crosses():
    assert tokens.Encoder().apart
    assert tokens.crosses("d,") and tokens.crosses(",Ġ") and tokens.crosses("ĠdĠ")
    assert not tokens.crosses("Ġd") and not tokens.crosses("Ġ,.")
